import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from trawl.llm import bpe_tree as bt
from trawl.llm.queries import QUERIES

RANKS = bt.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def slow_merge(raw, ranks):
    parts = [raw[i:i + 1] for i in range(len(raw))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_every_character_as_the_library():
    codec = bt.TreeCodec(RANKS, public_tokenizers.PATTERN)
    for base in range(0, 0x110000, 512):
        text = "".join(f"x{chr(i)}y {chr(i)}1{chr(i)}{chr(i)} " for i in range(base, base + 512) if not 0xD800 <= i <= 0xDFFF)
        assert codec.encode(text).tolist() == LIBRARY.encode_ordinary(text), hex(base)


@pytest.mark.parametrize("leaf", [1, 2, 7, 64])
def test_long_pieces_as_the_library(leaf):
    r = random.Random(leaf)
    codec = bt.TreeCodec(RANKS, public_tokenizers.PATTERN, leaf)
    for alphabet in ["a", "ab", "aA", "the", "0123456789", "éèêa", "日本語中", " ", "\n ", "-=", "ing", "abcdefghijklmnopqrstuvwxyz", " a", "'s"]:
        for n in (1, 2, 3, 50, 700):
            text = "".join(r.choice(alphabet) for _ in range(n))
            ids = codec.encode(text)
            assert ids.tolist() == LIBRARY.encode_ordinary(text), (alphabet, n)
            assert codec.decode(ids) == text.encode()


def test_joins_on_random_vocabularies():
    """Vocabularies with merges that depend on their order, against the plain loop."""
    r = random.Random(5)
    for _ in range(60):
        ranks = {bytes([97 + i]): i for i in range(3)}
        while len(ranks) < r.randint(5, 40):
            a, b = r.choice(list(ranks)), r.choice(list(ranks))
            ranks.setdefault(a + b, len(ranks))
        codec = bt.TreeCodec(ranks, "[a-c]+", 1)
        for _ in range(20):
            raw = bytes(r.choice(b"abc") for _ in range(r.randint(0, 90)))
            right = slow_merge(raw, ranks)
            assert codec.merge(raw) == codec._merge_long(raw) == codec.encode_bytes(raw) == right
            at = r.randint(0, len(raw))
            assert codec.join(codec.merge(raw[:at]), codec.merge(raw[at:])) == right


def test_query_over_edge_cases(spark, make_dir):
    long_word, long_text = "ab" * 60_000, "word, Wort 12! " * 20_000
    rows = [(1, None), (2, ""), (3, " "), (4, "Grüße\r\n\tan alle\x00\U0001f600"), (5, "<|endoftext|>"), (6, long_word), (7, long_text),
            (8, "twice"), (8, "twice"), (None, "no id")]
    got = {(x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in QUERIES["op11_bpe_tree"](spark, make_dir(rows)).collect()}
    want = set()
    for i, t in rows:
        ids = LIBRARY.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want


def test_columns_and_round_trip(spark, make_docs):
    docs = make_docs([(1, "one two"), (2, None)]).withColumn("n_tokens", F.lit("old")).withColumn("__encoded", F.lit(7))
    got = {x.doc_id: x for x in bt.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert bytes(got[1].decoded) == b"one two" and got[1].n_tokens == len(LIBRARY.encode_ordinary("one two")) and got[1]["__encoded"] == 7
    assert got[2].n_tokens == 0 and bytes(got[2].ids) == b"" and got[2].text is None
    assert bt.encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
