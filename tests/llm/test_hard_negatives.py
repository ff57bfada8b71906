import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import hard_negatives as hn
from trawl.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows):
    """The query's rows, every anchor against every row."""
    known = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (a, label, v) in enumerate(known):
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), r, kind) for j, (r, kind, w) in enumerate(known) if j != i]
        for p, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted(x for x in scored if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)[:5]
            out += [(a, positive, n + 1, x[1], -p, -x[0]) for n, x in enumerate(fit)]
    return sorted(out)


def answer(spark, folder):
    got = QUERIES["op13_rtree_negatives"](spark, folder).collect()
    return sorted((x.anchor_id, x.positive_id, x["rank"], x.negative_id, x.positive_score, x.negative_score) for x in got)


def vectors(r, n, d, copies=0.0, labels=4):
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows, family = [], [r.gauss(0, 1) for _ in range(d)]
    for i in range(n):
        c = r.choice(centres)
        v = family if r.random() < copies else [x + r.gauss(0, 0.3) for x in c]
        rows.append((i, [float(np.float32(x)) for x in v], r.randrange(labels)))
    return rows


@pytest.mark.parametrize("shard,leaf,block,copies,broadcast", [(4096, 64, 512, 0.0, 1 << 15), (40, 4, 2, 0.0, 1 << 15), (64, 8, 3, 0.4, 0)])
def test_against_brute_force(spark, tmp_path, monkeypatch, shard, leaf, block, copies, broadcast):
    for name, value in (("SHARD_ROWS", shard), ("LEAF_ROWS", leaf), ("ANCHORS_PER_BLOCK", block), ("BROADCAST_ROWS", broadcast), ("FANOUT", 3)):
        monkeypatch.setattr(hn, name, value)
    r = random.Random(shard)
    rows = vectors(r, 700, 6, copies)
    rows += [(None, [1.0] * 6, 1), (701, None, 1), (702, [1.0, None] * 3, 1), (703, [float("nan")] * 6, 1), (704, [float("inf")] * 6, 1),
             (705, [1.0] * 6, None), (706, [], 2), (707, [0.5], 3), (800, [2.0, 1.0], 3), rows[100], rows[100], rows[5]]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("r")).withColumn("tile", F.lit(1)).repartition(3)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert answer(spark, str(tmp_path)) == slow(rows)


def test_few_rows_and_none(spark, tmp_path):
    for k, rows in enumerate([[], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, [1.0], 1), (3, [1.0], 1)], [(100, [1.0], 1), (3, [1.0], 1), (4, [0.9], 2)],
                              [(100, [1.0], 1), (3, [-1.0], 1), (4, [-0.9], 2)], [(100, [0.0], 1), (3, [1.0], 1), (4, [-0.9], 2), (5, [0.0], 2)]]):
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
        assert answer(spark, folder) == slow(rows)


def test_queue_prunes_what_cannot_count():
    """Of well separated clusters the queue scores the leaves of one only."""
    r = np.random.default_rng(3)
    m = np.concatenate([c * 1000 + r.integers(-20, 20, (64, 3)) for c in np.array([[1, 0, 0], [0, 1, 0], [0, 0, 1], [-1, -1, -1]])])
    m = m[hn._tiled(m, 16, 2)].astype(float)
    tree, seen = hn._Tree(m, 16, 2), []
    intervals = [(a[0], b[0]) for a, b in tree.intervals(np.array([[1000.0, 0, 0]]))]

    def score(leaf):
        seen.append(leaf)
        part = slice(leaf * 16, leaf * 16 + 16)
        return m[part] @ [1000.0, 0, 0], np.arange(len(m))[part]

    best = hn._best_first(intervals, score, [-(1 << 62)], [1 << 62], 5, 2)
    assert [-s for s, _ in best[0]] == sorted(m @ [1000.0, 0, 0])[::-1][:5]
    assert len(seen) <= 4 and len(tree.boxes[0][0]) == 16
    seen.clear()
    assert hn._best_first(intervals, score, [10**9], [1 << 62], 5, 2) == [[]] and not seen


def test_wide_numbers_are_exact(spark):
    big = 1 << 28
    rows = [(0, 1, [big, 1]), (1, 1, [big, 3]), (2, 1, [big, 2]), (3, 2, [big, -1]), (4, 2, [big - 1, 0])]
    got = hn.mine(spark.createDataFrame(rows, "vec_id long, label long, q array<long>"), F.col("vec_id") == 0, 2, 2).collect()
    assert sorted((x.positive_id, x["rank"], x.negative_id, x.negative_score) for x in got) == [
        (1, 1, 3, big * big - 1), (1, 2, 4, big * big - big), (2, 1, 3, big * big - 1), (2, 2, 4, big * big - big)]
    with pytest.raises(Exception, match="62 bits"):
        hn.mine(spark.createDataFrame([(0, 1, [1 << 40]), (1, 1, [1 << 40])], "vec_id long, label long, q array<long>"), F.col("vec_id") == 0).collect()
