import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trawl.llm import simhash as sh
from trawl.llm.components import connected_components
from trawl.llm.queries import QUERIES


def slow_print(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, radius=3):
    """Smallest reachable position for each, by repeated sweeps over all pairs."""
    label = list(range(len(prints)))
    moved = True
    while moved:
        moved = False
        for i, x in enumerate(prints):
            for j, y in enumerate(prints):
                if label[j] > label[i] and (x ^ y).bit_count() <= radius:
                    label[j], moved = label[i], True
    return label


def test_spark_hash_agrees(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("ab cé d")).alias("h")).first().h
    assert got % 2**64 == xxhash.xxh64_intdigest("ab cé d".encode(), seed=42)


def test_query_against_all_pairs(spark, make_dir):
    r = random.Random(3)
    words = [f"w{i}é" for i in range(400)]
    rows = [(100 + i, " ".join(r.choice(words) for _ in range(r.randint(1, 300)))) for i in range(60)]
    for i in range(60):
        base = r.choice(rows)[1].split()
        for _ in range(r.randint(0, 2)):
            base[r.randrange(len(base))] = "other"
        rows.append((r.randint(0, 90), " ".join(base).upper() if i % 9 == 0 else "  ".join(base)))
    rows += [(3, None), (2, ""), (1, " \t\n"), (500, rows[0][1]), (500, rows[0][1]), (None, rows[0][1])]
    got = QUERIES["op3_simhash_vantage"](spark, make_dir(rows)).collect()
    prints = [slow_print(t) for _, t in rows]
    label = slow_classes(prints)
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        least[c] = min(x for x in (least.get(c), i) if x is not None) if (least.get(c), i) != (None, None) else None
    want = sorted((i if i is not None else -1, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, label, strict=True))
    assert sorted((x.doc_id if x.doc_id is not None else -1, x.fingerprint, x.component_id) for x in got) == want


@pytest.mark.parametrize("ring", [sh.MAX_SHARD, 40])
def test_links_keep_every_class(spark, monkeypatch, ring):
    """Families of near fingerprints among random ones, also with split shards."""
    monkeypatch.setattr(sh, "MAX_SHARD", ring)
    monkeypatch.setattr(sh, "LEAF", 16)
    monkeypatch.setattr(sh, "SHARD_ROWS", 50)
    r = random.Random(8)
    prints = {r.getrandbits(64) for _ in range(300)}
    for _ in range(8):
        x = r.getrandbits(64)
        for _ in range(60):
            for b in r.sample(range(64), r.randint(1, 3)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long").repartition(5)
    links = sh.near_links(df)
    rows = links.collect()
    assert all((x.a ^ x.b) != 0 or x.a == x.b for x in rows)
    roots = {x.node: x.root for x in connected_components(links).collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    got, want = {}, {}
    for s, c in zip(signed, slow_classes(prints), strict=True):
        got.setdefault(roots.get(s, s), set()).add(s)
        want.setdefault(c, set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_local_tree_is_exact():
    r = np.random.default_rng(2)
    base = r.integers(0, 2**64, 3000, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base[:500] ^ np.uint64(0b101), base[:200] ^ np.uint64(1 << 63)]))
    heads, members = sh.local_stars(values)
    assert (members != heads).all() and len(set(members.tolist())) == len(members)
    tree = sh._Tree(values)
    for x in values[:50]:
        near = np.flatnonzero(np.bitwise_count(values ^ x) <= 3)
        assert sorted(tree.near(x, 3, np.ones(len(values), bool)).tolist()) == near.tolist()


def test_keep_one(spark, make_docs):
    long = " ".join(f"t{i}" for i in range(200))
    docs = make_docs([(5, long), (2, long), (2, long), (9, "quite another text here"), (None, ""), (None, None), (7, "")])
    got = sorted((r.doc_id, r.text) for r in sh.keep_one(docs).collect())
    assert got == [(2, long), (7, ""), (9, "quite another text here")]
    assert sh.keep_one(docs).columns == docs.columns
    assert sh.keep_one(docs.limit(0)).count() == 0
