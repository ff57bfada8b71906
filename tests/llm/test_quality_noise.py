"""Noise that the limits must reject, beside prose that they must keep."""

import base64
import random
import string

import zstandard

from trawl.llm import quality_bands as qb


def words(r, letters, n):
    out = []
    while sum(map(len, out)) + len(out) < n:
        out.append("".join(r.choices(letters, k=r.randint(2, 9))))
    return " ".join(out)[:n]


def prose(r, n):
    """Words of a fixed vocabulary, frequent ones more often, as in a language."""
    vocab = ["".join(r.choices("etaoinshrdlucmfwyp", k=r.randint(3, 9))) for _ in range(1500)]
    return " ".join(r.choices(vocab, [1 / (i + 20) for i in range(1500)], k=n // 3))[:n]


def kept(text):
    return qb.measure(text, zstandard.ZstdCompressor(level=3))[-1]


def test_encoded_blobs_and_random_words_are_rejected():
    r = random.Random(3)
    for n in (4500, 6000, 20_000, 100_000):
        blob = base64.encodebytes(r.randbytes(n)).decode()[:n]
        assert not kept(blob), n
        assert not kept(words(r, string.ascii_letters + string.digits, n)), n
        assert not kept(words(r, string.ascii_lowercase, n)), n
        text = prose(r, n)
        half = [x for i, line in enumerate(blob.split("\n")) for x in (text[76 * i:76 * i + 76], line)]
        assert not kept("\n".join(half)), n
        assert not kept(prose(r, n) + "\n" + blob), n
        assert kept(prose(r, n)), n
    for n in (2000, 4000):
        assert not kept(words(r, string.ascii_letters + string.digits, n)) and kept(prose(r, n)), n


def test_last_partial_chunk_is_judged():
    r = random.Random(4)
    text = prose(r, 4096) + base64.b64encode(r.randbytes(2500)).decode()
    n_chunks, n_bad = qb.measure(text, zstandard.ZstdCompressor(level=3))[-3:-1]
    assert (n_chunks, n_bad) == (2, 1) and not kept(text)
    assert kept(prose(r, 4096) + " x")
