"""Hard negatives by inner product, found with an STR-packed R-tree.

Rows are tiled by sort-tile-recursive packing: cut into four slabs of equal size along the
coordinate that varies most, each slab again along the next one, until a tile holds some
``SHARD_ROWS`` rows.  The cuts are percentiles over all rows of a slab.  A tile that ties
keep too large is dealt into several shards.  Each shard is packed once into one stored
row: its vectors in the order of the same recursion, ``LEAF_ROWS`` a leaf, and its bounding
box.  Leaf boxes and those of ``FANOUT`` nodes each above make up the shard's R-tree.

A box bounds each coordinate, so it gives each coordinate's product with a query an
interval, and their sums the score's.  Anchors are packed into blocks, neighbours
together, and a block meets a shard if their boxes allow a score inside the windows asked
for.  Inside, each anchor walks the tree by a best-first queue and leaves out boxes whose
interval misses all its windows or whose highest score is strictly below the k-th found.
Every block first searches the shard that promises it most; the k-th scores found there
are floors for its search of all others, so little more than the answers leaves a task.

Positives are the best ``k`` other rows of an anchor's label.  Negatives are then the best
``k`` rows of other labels between ``low`` and ``high`` hundredths of each positive's score.
The search is exact.  What boxes cannot rule out is scored: in many dimensions without
clusters that is most pairs of an anchor and a row, in blocks and without a shuffle of pairs.

Defined results: rows with a null id, label or vector, or a null or non-finite component,
take no part; a shorter vector ends in zeros; equal rows are rows each, as anchors, positives
and negatives; ties go by id; an anchor without positives, and a positive below zero (no
score lies in its window), have no rows; an empty table gives an empty result; further
columns are ignored.  Scores are exact integers; vectors whose products may pass 62 bits are an error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import small, stored
from trawl.operators.distribute import ordered_position

SHARD_ROWS = 4096
LEAF_ROWS = 64
FANOUT = 8
SLABS = 4
ANCHORS_PER_BLOCK = 512
#: Rows of a table of cuts or anchors' blocks that may be broadcast.
BROADCAST_ROWS = 1 << 15

PACKED = "n long, lo array<long>, hi array<long>, kind string, vectors binary, ids binary, labels binary, rows binary"
WINDOWS = "n_windows long, lows binary, highs binary"
FOUND = "row long, w long, other_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components as integers, ``floor(scale * x)``; null for vectors that take no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


# ---------------------------------------------------------------- packing

def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists as the rows of a matrix, short ones ending in zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    ends = lists.offsets.to_numpy()
    flat, sizes = lists.values.to_numpy(zero_copy_only=False), np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat[ends[0]:ends[-1]]
    return out


def _tiled(m: np.ndarray, leaf: int, slabs: int) -> np.ndarray:
    """Sort-tile-recursive order of the rows of ``m``, widest coordinates first."""
    widest = np.argsort(-m.std(axis=0), kind="stable") if m.size else np.zeros(0, np.int64)

    def order(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or depth >= len(widest):
            return [rows]
        rows = rows[np.argsort(m[rows, widest[depth]], kind="stable")]
        step = leaf * -(-leaves // slabs)
        return [x for at in range(0, len(rows), step) for x in order(rows[at:at + step], depth + 1)]

    return np.concatenate([np.zeros(0, np.int64), *order(np.arange(len(m)), 0)])


def _packed(m: np.ndarray, columns: dict[str, np.ndarray], order: np.ndarray) -> dict:
    m = m[order]
    most = int(max(m.max(initial=0), -m.min(initial=0)))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return {"n": len(m), "lo": m.min(axis=0).tolist(), "hi": m.max(axis=0).tolist(), "kind": kind, "vectors": m.astype(kind).tobytes(),
            **{name: x[order].astype("<i8").tobytes() for name, x in columns.items()}}


def _columns(t: pa.Table) -> dict[str, np.ndarray]:
    return {new: t[old].to_numpy().astype(np.int64) for old, new in (("vec_id", "ids"), ("label", "labels"), ("row", "rows"))}


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def pack_shards(placed: DataFrame) -> DataFrame:
    """``(tile, part)`` and the columns of ``PACKED``: a stored row for each shard."""
    leaf, slabs, schema = LEAF_ROWS, SLABS, _arrow("tile long, part long, " + PACKED)

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        m = _matrix(t["q"])
        row = {"tile": key[0].as_py(), "part": key[1].as_py(), **_packed(m, _columns(t), _tiled(m, leaf, slabs))}
        return pa.Table.from_pylist([row], schema)

    return stored(placed.groupBy("tile", "part").applyInArrow(pack, "tile long, part long, " + PACKED), "str-shards")


def pack_anchors(anchors: DataFrame) -> DataFrame:
    """``block`` and the columns of ``PACKED`` and ``WINDOWS``: a stored row for each block of
    ``anchors(block, row, vec_id, label, q, lows, highs)``."""
    schema = _arrow(f"block long, {PACKED}, {WINDOWS}")

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        lows, highs = t["lows"].to_pylist(), t["highs"].to_pylist()
        width = max(map(len, lows))
        none = [(1 << 62, -(1 << 62))] * width  # a window that nothing fits
        pairs = np.array([([*zip(a, b, strict=True)] + none)[:width] for a, b in zip(lows, highs, strict=True)], np.int64).reshape(-1, width, 2)
        row = {"block": key[0].as_py(), **_packed(_matrix(t["q"]), _columns(t), np.arange(t.num_rows)), "n_windows": width,
               "lows": np.ascontiguousarray(pairs[:, :, 0]).tobytes(), "highs": np.ascontiguousarray(pairs[:, :, 1]).tobytes()}
        return pa.Table.from_pylist([row], schema)

    return stored(anchors.groupBy("block").applyInArrow(pack, f"block long, {PACKED}, {WINDOWS}"), "str-anchors")


# ---------------------------------------------------------------- search inside a shard

class _Tree:
    """R-tree over packed rows: ``boxes[0]`` of the leaves, each next of ``FANOUT`` nodes below."""

    def __init__(self, m: np.ndarray, leaf: int, fanout: int):
        starts = np.arange(0, len(m), leaf)
        self.boxes = [(np.minimum.reduceat(m, starts), np.maximum.reduceat(m, starts))]
        while len(self.boxes[-1][0]) > 1:
            lo, hi = self.boxes[-1]
            starts = np.arange(0, len(lo), fanout)
            self.boxes.append((np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)))

    def intervals(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level the smallest and largest score of every anchor (row) in every box (column)."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T) for lo, hi in self.boxes]


def _best_first(intervals, score, low, high, k: int, fanout: int) -> list[list[tuple[int, int]]]:
    """For each window the best ``k`` as (-score, id).  ``intervals``: (smallest, largest) of one
    anchor by level and node; ``score(leaf)``: scores and ids of the rows that count."""
    found: list[list[tuple[int, int]]] = [[] for _ in low]
    kth = list(low)  # nothing below counts any more
    top = len(intervals) - 1
    queue = [(-intervals[top][1][0], top, 0)]
    while queue:
        largest, level, node = heapq.heappop(queue)
        largest, smallest = -largest, intervals[level][0][node]
        if largest < min(kth):
            break
        if not any(largest >= a and smallest <= b for a, b in zip(kth, high)):
            continue
        if level:
            below = intervals[level - 1][1]
            for child in range(node * fanout, min((node + 1) * fanout, len(below))):
                if below[child] >= min(kth):
                    heapq.heappush(queue, (-below[child], level - 1, child))
            continue
        scores, ids = score(node)
        for w, (a, b) in enumerate(zip(kth, high)):
            if largest < a or smallest > b:
                continue
            hits = np.flatnonzero((scores >= a) & (scores <= b))
            if len(hits):
                found[w] = heapq.nsmallest(k, found[w] + [(-int(scores[i]), int(ids[i])) for i in hits])
                if len(found[w]) == k:
                    kth[w] = -found[w][-1][0]
    return found


def _unpacked(row: dict, d: int, prefix: str = "") -> tuple[np.ndarray, ...]:
    n = row[prefix + "n"]
    m = np.frombuffer(row[prefix + "vectors"], row[prefix + "kind"]).reshape(n, -1).astype(np.int64)
    return np.pad(m, ((0, 0), (0, d - m.shape[1]))), *(np.frombuffer(row[prefix + c], "<i8") for c in ("ids", "labels", "rows"))


def _search_pair(row: dict, same: bool, k: int, leaf: int, fanout: int) -> list[dict]:
    """All anchors of a block against all rows of a shard."""
    d = max(len(row["lo"]), len(row["a_lo"]))
    m, ids, labels, rows = _unpacked(row, d)
    anchors, _, anchor_labels, anchor_rows = _unpacked(row, d, "a_")
    most = d * int(np.abs(m).max(initial=0)) * int(np.abs(anchors).max(initial=0))
    if most < 1 << 53:  # exact as doubles, which multiply faster
        m, anchors = m.astype(np.float64), anchors.astype(np.float64)
    width = row["a_n_windows"]
    lows, highs = (np.frombuffer(row[c], "<i8").reshape(-1, width).tolist() for c in ("a_lows", "a_highs"))
    tree = _Tree(m, leaf, fanout)
    levels = tree.intervals(anchors)
    out = []
    for i, vector in enumerate(anchors):
        def score(node: int, i: int = i, vector: np.ndarray = vector) -> tuple[np.ndarray, np.ndarray]:
            part = slice(node * leaf, (node + 1) * leaf)
            counts = (labels[part] == anchor_labels[i]) & (rows[part] != anchor_rows[i]) if same else labels[part] != anchor_labels[i]
            return (m[part] @ vector)[counts], ids[part][counts]

        found = _best_first([(a[i], b[i]) for a, b in levels], score, lows[i], highs[i], k, fanout)
        out += [{"row": int(anchor_rows[i]), "w": w, "other_id": other, "score": -s} for w, best in enumerate(found) for s, other in best]
    return out


# ---------------------------------------------------------------- search over all shards

def tiles(rows: DataFrame) -> DataFrame:
    """``rows(row, ..., q)`` with ``tile, part``, the shard of each."""
    n = rows.count()
    d = rows.agg(F.max(F.size("q"))).first()[0] or 0
    coordinate = lambda i: F.coalesce(F.get("q", F.lit(i)), F.lit(0))
    spread = rows.agg(*[F.stddev_pop(coordinate(i)).alias(f"c{i}") for i in range(d)]).first() if d and n > SHARD_ROWS else ()
    widest = sorted(range(len(spread)), key=lambda i: (-spread[i], i))
    placed = rows.withColumn("tile", F.lit(0).cast("long"))
    fraction = [i / SLABS for i in range(1, SLABS)]
    for depth, i in enumerate(widest):
        if SLABS ** depth * SHARD_ROWS >= n:
            break
        cuts = stored(placed.groupBy("tile").agg(F.percentile_approx(coordinate(i), fraction, 1000).alias("cuts")), "str-cuts")
        slab = F.size(F.expr(f"filter(cuts, c -> c < coalesce(get(q, {i}), 0))"))
        placed = placed.join(small(cuts, BROADCAST_ROWS), "tile").withColumn("tile", F.col("tile") * SLABS + slab).drop("cuts")
    placed = stored(placed, "str-placed")
    parts = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("parts"))
    return placed.join(small(stored(parts, "str-parts"), BROADCAST_ROWS), "tile").withColumn(
        "part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")


def _reach() -> tuple[Column, Column]:
    """Smallest and largest score between a block's box (a_lo, a_hi) and a shard's (lo, hi), a little widened."""
    sides = F.arrays_zip("lo", "hi", "a_lo", "a_hi")

    def total(pick) -> Column:
        def add(acc: Column, x: Column) -> Column:
            v = {c: F.coalesce(x[c], F.lit(0)).cast("double") for c in ("lo", "hi", "a_lo", "a_hi")}
            return acc + pick(*[v[a] * v[b] for a in ("lo", "hi") for b in ("a_lo", "a_hi")])
        return F.aggregate(sides, F.lit(0.0), add)

    slack = F.abs(total(F.greatest)) * 1e-9 + F.abs(total(F.least)) * 1e-9 + 1
    return total(F.least) - slack, total(F.greatest) + slack


def _search(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, same: bool, k: int) -> DataFrame:
    """The columns of ``FOUND`` for all ``pairs(block, tile, part)``, a group each."""
    leaf, fanout, schema = LEAF_ROWS, FANOUT, _arrow(FOUND)
    theirs = blocks.select("block", *[F.col(c).alias(f"a_{c}") for c in blocks.columns if c != "block"])
    spark = pairs.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = pairs.join(shards, ["tile", "part"]).join(theirs, "block").repartition(width, "block", "tile", "part")

    def run(t: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([x for row in t.to_pylist() for x in _search_pair(row, same, k, leaf, fanout)], schema)

    return both.groupBy("block", "tile", "part").applyInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "w").orderBy(F.col("score").desc(), "other_id", "copy")
    return (found.withColumn("copy", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).drop("copy"))


def nearest(anchors: DataFrame, shards: DataFrame, same: bool, k: int) -> DataFrame:
    """``FOUND`` and ``rank``: for each window of ``anchors(block, row, vec_id, label, q, lows, highs)``
    the best ``k`` rows of the ``same`` label (other than the anchor), or of other labels."""
    blocks = pack_anchors(anchors)
    n_blocks = blocks.agg(F.max("block")).first()[0]
    if n_blocks is None:
        return anchors.sparkSession.createDataFrame([], FOUND + ", rank int")
    asked = anchors.groupBy("block").agg(F.min(F.array_min("lows")).alias("least"), F.max(F.array_max("highs")).alias("most"))
    edges = blocks.select("block", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi")).join(asked, "block")
    smallest, largest = _reach()
    # The anchors are a stated query set: each of their blocks meets each shard's box, not its rows.
    meets = (shards.select("tile", "part", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(n_blocks))).alias("block"))
             .join(edges, "block").select("block", "tile", "part", smallest.alias("smallest"), largest.alias("largest"), "least", "most"))
    pairs = stored(meets.where("largest >= least and smallest <= most"), "str-pairs")
    home = stored(pairs.groupBy("block").agg(F.max_by(F.struct("tile", "part"), F.struct("largest", "tile", "part")).alias("x"))
                  .select("block", "x.*"), "str-home")
    first = stored(_search(home, blocks, shards, same, k), "str-first")
    # The k-th score found so far is the least that still counts.
    floors = (_best(first, k).where(F.col("rank") == k).groupBy("row")
              .agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth")))
    raised = anchors.join(floors, "row", "left").withColumn("lows", F.expr(
        "transform(lows, (x, w) -> greatest(x, coalesce(element_at(kth, cast(w as bigint)), x)))")).drop("kth")
    raised = stored(raised, "str-raised")
    least = raised.groupBy("block").agg(F.min(F.array_min("lows")).alias("floor"))
    rest = pairs.join(home, ["block", "tile", "part"], "left_anti").join(least, "block").where("largest >= floor").select("block", "tile", "part")
    second = _search(rest, pack_anchors(raised), shards, same, k)
    return stored(_best(first.unionAll(second), k), "str-found")


def mine(vectors: DataFrame, anchor: Column, k_positives: int = 5, k_negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for
    ``vectors(vec_id, label, q)``, q integers (see ``quantised``), and the rows where ``anchor`` holds."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "q",
                          F.coalesce(anchor, F.lit(False)).alias("anchor")).dropna()
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "str-rows")
    most, d = rows.agg(F.max(F.greatest(F.array_max("q").cast("double"), -F.array_min("q").cast("double"))), F.max(F.size("q"))).first()
    if (most or 0.0) ** 2 * (d or 0) >= 2.0 ** 62:
        raise ArithmeticError("inner products of these vectors may not fit 62 bits")
    rows = tiles(rows)
    shards = pack_shards(rows)
    anchors = ordered_position(rows.where("anchor"), [], ["tile", "part", "row"], out="place").select(
        F.floor((F.col("place") - 1) / ANCHORS_PER_BLOCK).alias("block"), "row", "vec_id", "label", "q")
    anchors = stored(anchors, "str-queries")
    free = lambda v: F.array(F.lit(v).cast("long"))
    positives = nearest(anchors.withColumns({"lows": free(-(1 << 62)), "highs": free(1 << 62)}), shards, True, k_positives)
    bound = lambda c, pct, up: F.expr(f"cast((cast({c} as decimal(20,0)) * {pct} + {99 if up else 0}) div 100 as bigint)")
    asked = positives.where("score >= 0").withColumns({"low": bound("score", low, True), "high": bound("score", high, False)})
    windows = asked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("x")).select(
        "row", F.col("x.low").alias("lows"), F.col("x.high").alias("highs"))
    negatives = nearest(stored(anchors.join(windows, "row"), "str-windows"), shards, False, k_negatives)
    return (negatives.withColumnsRenamed({"other_id": "negative_id", "score": "negative_score"})
            .join(positives.select("row", (F.col("rank") - 1).cast("long").alias("w"), F.col("other_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["row", "w"])
            .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
