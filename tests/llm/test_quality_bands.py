import random
import re
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from trawl.llm import quality_bands as qb
from trawl.llm.queries import QUERIES


def expected(text):
    """The rule read off its statement, one word and window at a time."""
    t = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = t.split("\n")
    dup = sum(bool(re.search("[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return *base, failed


def texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgéßhijklmnopq") for _ in range(r.randint(1, 9)))
    out = [None, "", " \n\t ", "a", "x" * 9000, "one two\n" * 400, "   wide blanks here"]
    out += [" ".join(word() for _ in range(n)) for n in (49, 50, 51, 300, 3000, 40_000)]
    out += ["\n".join(" ".join(r.choice(["a#", "b|", "c", "dd"]) for _ in range(3)) for _ in range(60))]
    out += ["".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(4000)) + " w" * 60]
    return out


def test_matches_the_statement(spark, make_dir):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = QUERIES["op1_compression_bands"](spark, make_dir(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected(t), i
        raw = (t or "").encode()
        ratio = len(zstandard.ZstdCompressor(level=3).compress(raw)) / len(raw) if raw else 0.0
        assert r.ratio == ratio
        low, high = next((lo, hi) for n, lo, hi in qb.BANDS if len(raw) <= n)
        assert not (r.kept and (r.base_failed or not low <= ratio <= high))


def test_bands_reject_repeats_and_noise(spark, make_docs):
    r = random.Random(1)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    prose = " ".join(r.choice(vocab) for _ in range(900))
    period = " ".join(vocab[:400])
    near_repeat = " ".join(f"{period} {i}" for i in range(40))
    noise = " ".join("".join(chr(r.randint(33, 126)) for _ in range(7)) for _ in range(900))
    half = prose * 1 + " " + " ".join(f"item{i % 7}" for i in range(12_000))
    got = {x.doc_id: x.kept for x in qb.compression_bands(
        make_docs([(1, prose), (2, near_repeat), (3, noise), (4, half)])).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_empty_table_repeats_and_clashing_columns(spark, make_docs):
    assert qb.compression_bands(make_docs([]).limit(0)).count() == 0
    docs = make_docs([(1, "a b"), (1, "a b"), (None, None)]).withColumn("Kept", F.lit("old")).withColumn("ratio", F.lit(7))
    out = qb.compression_bands(docs)
    assert [c.lower() for c in out.columns].count("kept") == 1 and out.columns.count("ratio") == 1
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in out.collect()) == [(0, 0, False), (1, 2, False), (1, 2, False)]
