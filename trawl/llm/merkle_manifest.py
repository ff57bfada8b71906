"""Merkle manifest of a dataset, its inclusion proofs found by pointer jumping.

Every row is a leaf.  The leaves of a language, by doc_id, are the bottom of a binary tree
whose top is the language's subroot; the subroots, by language, are the bottom of one more
tree, whose top is the root.  A node without a neighbour is hashed alone.

Trees are built in strides: a group holds the ``2 ** STRIDE`` nodes below one node and
hashes all their levels by array functions, so a tree of ``n`` leaves takes
``log2(n) / STRIDE`` shuffles, each ``2 ** STRIDE`` times smaller than the one before.

Proofs: each node holds a pointer to an ancestor and the segment of siblings on the way
there, at first its own sibling and its parent.  One self-join lets every node take over
the pointer of the node it points to and append that node's segment, which doubles the
distance; after ``log2`` of the depth every leaf points to its top.  Nodes that no leaf can
point to any more drop out, so beside the leaves only ``n / 2 ** distance`` nodes are joined.
A leaf then takes over the segment of its language's subroot, found in the same way.

Defined results: a null lang is a language of its own, before all others; rows that share a
doc_id are ordered by their leaves (null doc_ids first), and equal rows by chance, which no
value shows; a null value is ``-``, an empty one ``0:``; an empty table gives an empty
result; further columns are carried, those named like a result are replaced.  A language with most of
the rows is numbered over all tasks and hashed in many groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import small, stored
from trawl.operators.distribute import ordered_position

#: Levels that a group hashes at once; it holds two to this power digests.
STRIDE = 10
#: Rows of a table of pointers or languages that may be broadcast; a row has a segment of some hundred bytes.
BROADCAST_ROWS = 1 << 15


def digest(*parts: Column) -> Column:
    """H: lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*values: Column) -> Column:
    """H of the values, each ``-`` if null, else its bytes' count, ``:`` and the value."""
    def field(value: Column) -> Column:
        s = value.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return digest(*map(field, values))


def fold(leaf: Column, place: Column, siblings: Column) -> Column:
    """The top that a leaf's digest (hex) and the siblings (binary, null: none) lead to."""
    def step(node: Column, sibling: Column) -> Column:
        other = F.lower(F.hex(sibling["hash"]))
        return F.when(other.isNull(), digest(node)).when(sibling["right"], digest(node, other)).otherwise(digest(other, node))

    numbered = F.transform(siblings, lambda s, i: F.struct(
        s.alias("hash"), (F.call_function("shiftright", place, i) % 2 == 0).alias("right")))
    return F.aggregate(numbered, leaf, step)


def proof_digest(siblings: Column) -> Column:
    """H of the siblings that there are, from the leaf up."""
    return F.sha2(F.array_join(F.transform(F.filter(siblings, lambda s: s.isNotNull()), lambda s: F.lower(F.hex(s))), ""), 256)


@dataclass(frozen=True)
class _Trees:
    nodes: DataFrame   # (tree, level, place, sibling) of all nodes but the tops
    tops: DataFrame    # (tree, top), hex
    depth: int         # levels of the deepest tree


def _parents(nodes: Column, count: Column) -> Column:
    pair = lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))
    return F.transform(F.sequence(F.lit(0), count - 1), pair)


def _build(leaves: DataFrame) -> _Trees:
    """The trees over ``leaves(tree, place, hash)``, places from 0 without gaps."""
    bits = F.length(F.bin(F.max("place")))
    sizes = stored(leaves.groupBy("tree").agg(F.when(F.max("place") == 0, 0).otherwise(bits).alias("depth")), "manifest-trees")
    deepest = sizes.agg(F.max("depth")).first()[0] or 0
    level, base, strides = leaves, 0, []
    while not strides or base < deepest:
        group = (level.groupBy("tree", F.shiftright("place", STRIDE).alias("group"))
                 .agg(F.array_sort(F.collect_list(F.struct("place", "hash"))).alias("found"))
                 .join(small(sizes, BROADCAST_ROWS), "tree").withColumn("l0", F.col("found.hash")))
        for j in range(1, STRIDE + 1):
            parents = _parents(F.col(f"l{j - 1}"), F.expr(f"(size(l{j - 1}) + 1) div 2"))
            group = group.withColumn(f"l{j}", F.when(F.col("depth") >= base + j, parents))

        def rows(j: int, base: int = base) -> Column:
            nodes = F.col(f"l{j}")
            last = F.lit(j == STRIDE) | (F.col("depth") == base + j)  # no sibling in this group
            return F.coalesce(F.transform(nodes, lambda h, i: F.struct(
                F.lit(base + j).alias("level"), (F.shiftleft("group", STRIDE - j) + i).alias("place"),
                F.when(last, F.unhex(h)).alias("hash"), F.when(~last, F.unhex(F.get(nodes, i + 1 - 2 * (i % 2)))).alias("sibling"))), F.array())

        listed = group.select("tree", "depth", F.explode(F.concat(*[rows(j) for j in range(STRIDE + 1)])).alias("node"))
        strides.append(stored(listed.select("tree", "depth", "node.*"), "manifest-nodes"))
        base += STRIDE
        level = strides[-1].where((F.col("level") == base) & (F.col("depth") > base)).select(
            "tree", "place", F.lower(F.hex("hash")).alias("hash"))
    nodes = tops = None
    for k, s in enumerate(strides):
        inner = s.where((F.col("level") < F.col("depth")) & (F.col("level") < (k + 1) * STRIDE)).select("tree", "level", "place", "sibling")
        top = s.where(F.col("level") == F.col("depth")).where(F.col("hash").isNotNull()).select("tree", F.lower(F.hex("hash")).alias("top"))
        nodes, tops = (inner, top) if nodes is None else (nodes.unionAll(inner), tops.unionAll(top))
    return _Trees(nodes, tops, deepest)


def _jump(leaves: DataFrame, trees: _Trees) -> DataFrame:
    """``leaves(tree, place, ...)`` with ``siblings``, the segment from the leaf to its tree's top."""
    pointers = trees.nodes.withColumn("segment", F.array("sibling")).drop("sibling")
    own = pointers.where("level = 0").select("tree", "place", "segment")
    out = leaves.join(own, ["tree", "place"], "left").withColumnRenamed("segment", "siblings")
    out = out.withColumn("siblings", F.coalesce("siblings", F.array().cast("array<binary>")))
    above, distance = pointers.where("level > 0"), 1
    while distance < trees.depth:
        # What a node at a multiple of twice the distance points to stands at an odd multiple.
        met = above.where(F.col("level") % (2 * distance) == distance).withColumnsRenamed({"place": "at", "segment": "more"})
        met = small(stored(met, "manifest-pointers"), BROADCAST_ROWS)

        def double(nodes: DataFrame, level: Column, segment: str, met: DataFrame = met, distance: int = distance) -> DataFrame:
            reach = nodes.withColumn("level", level + distance).withColumn("at", F.shiftright("place", distance))
            joined = reach.join(met, ["tree", "level", "at"], "left").withColumn("level", F.col("level") - distance).drop("at")
            return joined.withColumn(segment, F.concat(segment, F.coalesce("more", F.array()))).drop("more")

        out = double(out, F.lit(0), "siblings").drop("level")
        above = double(above.where(F.col("level") % (2 * distance) == 0), F.col("level"), "segment")
        distance *= 2
    return out


def manifest(leaves: DataFrame) -> DataFrame:
    """Proofs of ``leaves(doc_id, lang, leaf, ...)``, leaf a digest in hex: the same rows with

    ``place, siblings``            position in the language and the way to the subroot,
    ``lang_place, lang_siblings``  position of the language and the way to the root,
    ``subroot, root``              the tops.

    Siblings are ``array<binary>`` from below, null where a node is hashed alone."""
    result = ["place", "siblings", "lang_place", "lang_siblings", "subroot", "root"]
    rows = leaves.drop(*[c for c in leaves.columns if c.lower() in result])
    # A null lang comes first, and the mark keeps the order of the others.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    named = rows.select(tree.alias("tree"), "doc_id", "leaf", F.rand(1).alias("tie"), F.struct("*").alias("row"))
    placed = ordered_position(named, ["tree"], ["doc_id", "leaf", "tie"], out="place").select("tree", (F.col("place") - 1).alias("place"), "leaf", "row")
    trees = _build(placed.select("tree", "place", F.col("leaf").alias("hash")))
    langs = stored(ordered_position(trees.tops, [], ["tree"], out="place").select(
        F.lit("").alias("tree"), (F.col("place") - 1).alias("place"), F.col("top").alias("hash"), F.col("tree").alias("of")), "manifest-langs")
    upper = _build(langs.select("tree", "place", "hash"))
    found = upper.tops.first()
    ways = _jump(langs, upper).select(F.col("of").alias("tree"), F.col("hash").alias("subroot"), F.col("place").alias("lang_place"),
                                      F.col("siblings").alias("lang_siblings"))
    ways = small(stored(ways, "manifest-ways"), BROADCAST_ROWS)
    return _jump(placed.drop("leaf"), trees).join(ways, "tree").select("row.*", *result[:-1], F.lit(found and found.top).alias("root"))


def folded_root(leaf: Column) -> Column:
    """The root that ``leaf`` and the proof columns of ``manifest`` lead to."""
    return fold(fold(leaf, F.col("place"), F.col("siblings")), F.col("lang_place"), F.col("lang_siblings"))
