import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import substring_dedup as sd
from trawl.llm.queries import QUERIES

WORD = "[^\x20\x09-\x0D]+"


def expected(rows, width=13):
    first = {}
    for i, t in rows:
        w = re.findall(WORD, t or "")
        if i is not None:
            for k in range(len(w) - width + 1):
                key = tuple(w[k:k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w, gone = re.findall(WORD, t or ""), set()
        if i is not None:
            for k in range(len(w) - width + 1):
                if first[tuple(w[k:k + width])] < i:
                    gone |= set(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def sample():
    r = random.Random(9)
    word = lambda: r.choice("abcdeé𝒳") + str(r.randint(0, 400))
    passages = [[word() for _ in range(r.randint(10, 60))] for _ in range(6)]
    rows = []
    for i in range(80):
        w = [word() for _ in range(r.randint(0, 90))]
        if i % 3 == 0:
            at = r.randint(0, len(w))
            w[at:at] = r.choice(passages)
        if i % 7 == 0:
            w = w + w
        rows.append((r.randint(0, 60), r.choice([" ", "\n", "  \t"]).join(w)))
    rows += [(70, rows[0][1]), (70, rows[0][1]), (None, rows[0][1]), (None, rows[3][1]), (71, None), (72, ""), (73, "w " * 500), (74, "w " * 20),
             (75, " ".join(f"x{i}" for i in range(13))), (76, " ".join(f"x{i}" for i in range(13))), (-5, " ".join(passages[0]))]
    return rows


@pytest.mark.parametrize("group,shard", [(sd.GROUP_WORDS, sd.SHARD_WINDOWS), (150, 64)])
def test_query_against_all_windows(spark, make_dir, monkeypatch, group, shard):
    """The same result with one group and with many small groups, shards and buckets."""
    monkeypatch.setattr(sd.packed, "__defaults__", (group,))
    monkeypatch.setattr(sd, "SHARD_WINDOWS", shard)
    rows = sample()
    got = QUERIES["op8_countmin_windows"](spark, make_dir(rows)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected(rows)


def test_blocks_round_trip():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 2**63, 1000, dtype=np.uint64), r.integers(-5, 5, 1000)
    x, y = sd.unpack(sd.pack(a, b), "<u8", "<i8")
    assert (x == a).all() and (y == b).all()
    assert all(len(z) == 0 for z in sd.unpack(sd.pack(a[:0], b[:0]), "<u8", "<i8"))


def test_pieces_keep_words(monkeypatch):
    monkeypatch.setattr(sd, "PIECE_BYTES", 7)
    raw = "aa bbb\ncccccccccccccc dd   é ".encode() * 20
    assert [w for p in sd._pieces(raw) for w in p] == raw.split()
    whole = sd.word_hashes(raw)
    monkeypatch.setattr(sd, "PIECE_BYTES", 1 << 20)
    assert (whole == sd.word_hashes(raw)).all()


def test_columns_and_empty(spark, make_docs):
    text = " ".join(f"y{i}" for i in range(20))
    docs = make_docs([(1, text), (2, "intro " + text + " end")]).withColumn("n_words", F.lit("x")).withColumn("g", F.lit(1)).withColumn("blob", F.lit(2))
    out = {r.doc_id: r for r in sd.remove_repeats(docs).collect()}
    assert (out[1].kept_text, out[1].n_removed) == (text, 0)
    assert (out[2].kept_text, out[2].n_removed, out[2].n_words, out[2].g) == ("intro end", 20, 22, 1)
    assert sd.remove_repeats(docs.limit(0)).count() == 0
