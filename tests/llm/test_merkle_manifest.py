import hashlib
import random

import pytest
from pyspark.sql import functions as F

from trawl.llm import merkle_manifest as mm
from trawl.llm.queries import QUERIES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_tree(leaves):
    """Top and, for each leaf, its siblings as (digest, stands right) from below."""
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, k in enumerate(at):
            ways[i].append((nodes[k ^ 1], k % 2 == 0) if k ^ 1 < len(nodes) else None)
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        at = [k // 2 for k in at]
    return nodes[0], ways


def slow_leaf(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def slow_fold(node, way):
    for sibling in way:
        node = H(node) if sibling is None else H(node, sibling[0]) if sibling[1] else H(sibling[0], node)
    return node


def slow(rows):
    import zlib

    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = [], []
    for lang in order:
        listed = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, slow_leaf(*r)))
        trees.append((listed, *slow_tree([slow_leaf(*r) for r in listed])))
    root, upper = slow_tree([t[1] for t in trees])
    for (listed, subroot, ways), up in zip(trees, upper):
        for r, way in zip(listed, ways):
            path = way + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            folded = slow_fold(slow_leaf(*(r[:3] + (r[3] + 1,) + r[4:] if bad else r)), path)
            out.append((r[0], slow_leaf(*r), subroot, root, H(*[s[0] for s in path if s]), folded, folded == root))
    return sorted(out, key=str)


def answer(spark, folder):
    got = QUERIES["op12_merkle_manifest"](spark, folder).collect()
    return sorted(((x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256, x.folded_root, x.verified) for x in got), key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("stride", [2, 3, mm.STRIDE])
def test_against_brute_force(spark, tmp_path, monkeypatch, stride):
    monkeypatch.setattr(mm, "STRIDE", stride)
    r = random.Random(stride)
    rows = [(r.choice([None, 3, i, i, i]), r.choice([None, "", "s"]), r.choice([None, "", "en", "en", "é", "z"]), r.choice([None, 0, i]),
             r.choice([None, "", "Grüße", f"text {i}"])) for i in range(130)]
    rows += rows[:9] + [(7000 + i, "s", "one" if i == 0 else f"l{i}", 1, "x" * i) for i in range(5)] + [(1, "s", "en", 3, "long " * 50_000)]
    spark.createDataFrame(rows, DOCS).withColumn("tree", F.lit(1)).withColumn("place", F.lit("p")).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert answer(spark, str(tmp_path)) == slow(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 16, 17])
def test_sizes_around_powers_of_two(spark, tmp_path, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert answer(spark, str(tmp_path)) == slow(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert answer(spark, str(tmp_path)) == []


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mm, "BROADCAST_ROWS", 0)
    leaves = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("lang"),
                                     mm.leaf_digest(F.col("id")).alias("leaf"), F.lit(5).alias("more"), F.lit("x").alias("segment"))
    got = mm.manifest(leaves).withColumn("f", mm.folded_root(F.col("leaf")))
    assert got.where("f = root and more = 5 and segment = 'x'").count() == 200
