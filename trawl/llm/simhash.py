"""Near-duplicates by SimHash, pairs found in a forest of vantage-point trees.

A text's fingerprint has 64 bits, one per bit of its shingles' hashes by majority.
Fingerprints that differ in at most ``RADIUS`` = 3 bits are linked; a document's
class is all it reaches over links.

Search.  Of four 16-bit blocks at least one is equal in both fingerprints of a
link, as three differing bits cannot touch four blocks.  So there is one tree per
block, whose upper levels measure the Hamming distance of that block to one
vantage point each.  By the triangle bound a pair that is equal in the block has
equal distances at every level: the list of distances is the shard, and no shard
overlaps another there.  The number of levels follows from the number of distinct
fingerprints.  Random fingerprints lie 32 +- 4 bits from any vantage point, so
trees over all 64 bits alone, searched with radius 3, would visit nearly every
branch.  Shards over ``MAX_SHARD`` rows (families of very many near copies) are
split further into rings of the full 64-bit distance to more vantage points;
there the ball of radius 3 crosses rings, and a fingerprint also goes into the next
ring if its ball reaches it.  Inside a shard a local vantage-point tree finds the
neighbours, exactly, and only a spanning star per local class leaves the task.

Defined results: null and empty texts and texts without words have fingerprint 0
and are linked like any other; equal texts share a fingerprint and so a class; a
class without any doc_id has component_id null; an empty table gives an empty
result; columns that carry the names of results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from trawl.llm.common import free_name, stored
from trawl.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
BLOCKS, BLOCK_BITS = 4, 16
#: Vantage points of the block trees, one per level: fixed values, spread over the block's values.
VANTAGE = (0x0000, 0x00FF, 0x0F0F, 0x3333, 0x5555, 0x1E66, 0x6A3C)
#: Part of all pairs of random 16-bit blocks with equal distance to a vantage point (sum of squared binomials).
SAME_DISTANCE = sum((math.comb(BLOCK_BITS, k) / 2**BLOCK_BITS) ** 2 for k in range(BLOCK_BITS + 1))
SHARD_ROWS = 1000
MAX_SHARD = 20_000
LEAF = 1024


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats counted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends - size + 1
    n = max(1, len(words) - width + 1)
    ends = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = zip(starts[at:min(n, at + (1 << 16))].tolist(), ends[at:at + (1 << 16)].tolist(), strict=True)
        h = np.fromiter((digest(joined[s:e], 42) for s, e in part), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, name: str, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in column ``name``."""
    @F.pandas_udf(LongType())
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(x, width) for x in s], np.uint64).view(np.int64))

    return docs.withColumn(name, of(F.col(text)))


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


class _Tree:
    """Vantage-point tree over an array of fingerprints; nodes hold the radius of
    the inner half, leaves hold positions."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.root = self._build(np.arange(len(values)))

    def _build(self, at: np.ndarray) -> tuple:
        if len(at) <= LEAF:
            return (at,)
        vantage = self.values[at[len(at) // 2]]
        d = np.bitwise_count(self.values[at] ^ vantage)
        cut = int(np.median(d))
        inner = d <= cut
        if inner.all():
            inner = d < cut
            cut -= 1
        if not inner.any() or inner.all():
            return (at,)
        return vantage, cut, self._build(at[inner]), self._build(at[~inner])

    def near(self, x: np.uint64, radius: int, open_: np.ndarray) -> np.ndarray:
        """Positions still ``open_`` whose value is within ``radius`` of ``x``."""
        found, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if len(node) == 1:
                at = node[0][open_[node[0]]]
                found.append(at[np.bitwise_count(self.values[at] ^ x) <= radius])
                continue
            vantage, cut, inner, outer = node
            d = int(np.bitwise_count(x ^ vantage))
            if d - radius <= cut:
                todo.append(inner)
            if d + radius > cut:
                todo.append(outer)
        return np.concatenate(found)


def local_stars(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (first of its class, member) of the classes inside one shard."""
    tree, open_ = _Tree(values), np.ones(len(values), bool)
    heads, members = [], []
    for first in range(len(values)):
        if not open_[first]:
            continue
        open_[first] = False
        todo = [first]
        while todo:
            got = tree.near(values[todo.pop()], radius, open_)
            open_[got] = False
            todo.extend(got.tolist())
            heads.append(np.full(len(got), first))
            members.append(got)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *heads]), np.concatenate([empty, *members])


def _rings(shards: DataFrame, radius: int) -> DataFrame:
    """Shards over ``MAX_SHARD`` rows, split by the distance to three of their own
    members; a row also goes into the next ring if its ball reaches into it."""
    big = stored(shards.groupBy("shard").agg(
        F.count("*").alias("n"), F.min("fp").alias("p0"), F.max("fp").alias("p1"),
        F.min_by("fp", F.xxhash64("fp")).alias("p2")).where(F.col("n") > MAX_SHARD), "simhash-big")
    if big.isEmpty():
        return shards.withColumn("ring", F.lit(0))
    out = shards.join(big, "shard", "left").withColumn("ring", F.lit(0))
    width = radius + 1
    for p in ("p0", "p1", "p2"):
        d = F.coalesce(F.bit_count(F.col("fp").bitwiseXOR(F.col(p))), F.lit(0))
        reach = F.when(F.col(p).isNull(), F.lit(0)).otherwise(F.floor((d + radius) / width))
        out = (out.withColumn("r", F.explode(F.array_distinct(F.array(F.floor(d / width), reach))))
               .withColumn("ring", (F.col("ring") * 17 + F.col("r")).cast("int")).drop("r"))
    return out.select("fp", "shard", "ring")


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links ``(a, b)`` between the distinct fingerprints ``fps(fp)``: two
    of them are connected by the result exactly if they are by links of at most
    ``radius`` (at most 3) bits."""
    if not 0 <= radius < BLOCKS:
        raise ValueError("the block trees hold for up to three differing bits")
    n = fps.count()
    levels = min(len(VANTAGE), max(1, math.ceil(math.log(max(n, 1) / SHARD_ROWS, 1 / SAME_DISTANCE))
                                   if n > SHARD_ROWS else 1))
    paths = []
    for b in range(BLOCKS):
        block = F.shiftrightunsigned("fp", BLOCK_BITS * b).bitwiseAND(F.lit(2**BLOCK_BITS - 1))
        path = F.lit(b).cast("long")
        for v in VANTAGE[:levels]:
            path = path * (BLOCK_BITS + 1) + F.bit_count(block.bitwiseXOR(F.lit(v)))
        paths.append(path)
    shards = fps.select("fp", F.explode(F.array(*paths)).alias("shard"))

    def stars(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        heads, members = local_stars(values, radius)
        return pd.DataFrame({"a": values[heads].view(np.int64), "b": values[members].view(np.int64)})

    return _rings(shards, radius).groupBy("shard", "ring").applyInPandas(stars, "a long, b long")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                           width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, th, fp, class_fp, component_id)``, one row per row of ``docs``: ``th``
    is the text's hash, ``class_fp`` names the class, ``component_id`` is its smallest doc_id."""
    work = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _text_hash(text).alias("th"))
    marked = stored(with_fingerprints(work, "fp", "text", width).select("doc_id", "th", "fp"), "simhash-fp")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("class_fp"))
    least = placed.groupBy("class_fp").agg(F.min("first_id").alias("component_id"))
    classes = placed.join(least, "class_fp").select("fp", "class_fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "th", "fp", "class_fp", "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each class: the one with the smallest doc_id (among rows that share
    it, the smallest text hash, then any one).  Columns as in ``docs``.  Texts move
    once, to meet the keepers by doc_id, of which no class has more than one; a second
    time only if the table has rows that are equal in doc_id and text."""
    classes = stored(near_duplicate_classes(docs, width=width, radius=radius), "simhash-classes")
    keepers = stored(classes.groupBy("class_fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")).alias("k"))
        .select("k.doc_id", "k.th"), "simhash-keepers")
    th = free_name(docs, "__th")
    marked = docs.withColumn(th, _text_hash("text"))
    same = marked["doc_id"].eqNullSafe(keepers["doc_id"]) & (marked[th] == keepers["th"])
    kept = marked.join(keepers, same, "left_semi")
    if not classes.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", th])
    return kept.drop(th)
