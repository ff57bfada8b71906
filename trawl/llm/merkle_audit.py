"""Fixity audit of WARC replicas by Merkle trees over offset ranges.

A replica is a table of records ``(file, offset, length, record_id, digest)``.  Its tree
has a node for every offset range of a file: at level 1 ranges of ``RANGE_BYTES``, each
level above covers ``FANOUT`` ranges of the one below, up to one root per file.  A
node's hash is that of its children's hashes in offset order, a level-1 node's that of
its records.  The audit joins the roots of two replicas, then at each level only the
children of nodes that differ, and at the end the records of the level-1 ranges that
differ.  Levels are written once, so the descent reads a level's hashes and nothing
else; record contents are read only to hash them.

``audit`` compares what stands at each offset.  ``damage`` tells moved records apart: in the
differing ranges records of the same id and digest are matched, and all that moved by the
same distance within a file are one result row; what is left is changed, missing or extra.
So a shortened record near the start of a file is two rows, however long the file is.

A range holds a bounded number of records and a node ``FANOUT`` children, so a file with
a third of all records is many keys; the number of levels follows from the largest file.

Defined results: a null file counts as the empty name, a null offset as -1; records that
share file and offset are compared as a sorted list; replicas without any difference
give an empty result, and so do two empty ones; a file that only one replica has is
missing or extra record by record; further columns are ignored.  ``damage`` takes a null
record_id for one id, matches repeated records in the order of their offsets, and equal
ids whose contents differ likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import stored
from trawl.operators.distribute import ordered_position

RANGE_BYTES = 1 << 18
FANOUT = 16
FILE_RECORDS = 500


def warc_record(url: Column, record_id: Column, payload: Column) -> Column:
    """The text of a response record."""
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "))
    body = F.coalesce(payload, F.lit(""))
    return F.concat(head, F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """A replica's records: ``pages(page_id, url, html)`` as WARC records, those of
    ``file_records`` consecutive page_ids one after the other in a file."""
    record = warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    number = F.coalesce(F.floor(F.col("page_id") / file_records), F.lit(-1))
    hashed = pages.select(F.format_string("pages-%08d.warc", number).alias("file"), F.col("page_id").alias("record_id"),
                          F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))
    return _placed(hashed)


def _placed(records: DataFrame) -> DataFrame:
    """``records(file, record_id, length, digest)`` with ``offset``, one after the other in their
    file.  Rows are dealt by ranges, summed inside each and shifted by the sums of the
    ranges before, so a file with a third of all records is many tasks."""
    order = ["file", "record_id", "digest"]
    dealt = stored(records.withColumn("_tie", F.rand(1)).repartitionByRange(*order, "_tie").sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)).drop("_tie"), "warc-records")
    inside = Window.partitionBy("file", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("file", "_part").agg(F.sum("length").alias("_bytes"))
    before = Window.partitionBy("file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("file", "_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"))
    return (dealt.withColumn("_inside", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(starts, ["file", "_part"])
            .withColumn("offset", F.col("_start") + F.col("_inside")).drop("_at", "_part", "_inside", "_start"))


def _levels(records: DataFrame, range_bytes: int, fanout: int, top: int) -> list[DataFrame]:
    """``(file, node, hash)`` of level 1 to ``top``, each written."""
    at = F.floor(F.col("offset") / range_bytes)
    leaf = F.concat_ws("|", "offset", "length", "digest")
    out = []
    rows = records.select("file", at.alias("node"), F.struct("offset", leaf.alias("hash")).alias("child"))
    for level in range(1, top + 1):
        nodes = rows.groupBy("file", "node").agg(F.array_sort(F.collect_list("child")).alias("children")).select(
            "file", "node", F.sha2(F.array_join(F.col("children.hash"), "\n"), 256).alias("hash"))
        out.append(stored(nodes, f"merkle-level{level}"))
        rows = out[-1].select("file", F.floor(F.col("node") / fanout).alias("node"), F.struct(F.col("node").alias("at"), "hash").alias("child"))
    return out


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.join(b.withColumnRenamed("hash", "other"), ["file", "node"], "full")
    return both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")


def _held(first: DataFrame, second: DataFrame, range_bytes: int, fanout: int) -> list[DataFrame]:
    """The records of both replicas in the level-1 ranges that differ."""
    def clean(r: DataFrame) -> DataFrame:
        return stored(r.select(F.coalesce("file", F.lit("")).alias("file"), F.coalesce("offset", F.lit(-1)).cast("long").alias("offset"),
                               F.col("length").cast("long").alias("length"), "record_id", "digest"), "merkle-records")

    sides = [clean(first), clean(second)]
    longest = max(r.agg(F.max("offset")).first()[0] or 0 for r in sides)
    top = 1
    while longest // range_bytes // fanout ** (top - 1) > 0 or top < 2:
        top += 1
    trees = [_levels(r, range_bytes, fanout, top) for r in sides]
    suspects = stored(_differing(trees[0][-1], trees[1][-1]), "merkle-suspects")
    for level in range(top - 2, -1, -1):
        parents = suspects.withColumnRenamed("node", "parent")
        below = [t[level].withColumn("parent", F.floor(F.col("node") / fanout)).join(parents, ["file", "parent"], "left_semi")
                 .select("file", "node", "hash") for t in trees]
        suspects = stored(_differing(*below), "merkle-suspects")
    at = F.floor(F.col("offset") / range_bytes)
    return [r.withColumn("node", at).join(suspects, ["file", "node"], "left_semi").drop("node") for r in sides]


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """``(file, offset, status, first_records, second_records)`` for every offset at
    which the replicas differ; ``status`` is changed, missing (not in the second) or
    extra (not in the first); the records are ``array<struct<record_id, length, digest>>``."""
    held = [r.groupBy("file", "offset").agg(
        F.array_sort(F.collect_list(F.struct("record_id", "length", "digest"))).alias(name))
        for r, name in zip(_held(first, second, range_bytes, fanout), ("first_records", "second_records"), strict=True)]
    both = held[0].join(held[1], ["file", "offset"], "full").where(~F.col("first_records").eqNullSafe(F.col("second_records")))
    status = F.when(F.col("second_records").isNull(), "missing").when(F.col("first_records").isNull(), "extra").otherwise("changed")
    return both.select("file", "offset", status.alias("status"), "first_records", "second_records")


def _copies(rows: DataFrame, keys: list[str], offset: str) -> DataFrame:
    """``rows`` with ``copy``, which row of its ``keys`` it is by ``offset``.  Few keys repeat; only
    their rows are numbered, over many tasks however often one does."""
    rows = stored(rows, "merkle-rows")
    again = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "merkle-again")
    many = ordered_position(rows.join(again, keys, "left_semi"), keys, [offset], out="copy")
    return rows.join(again, keys, "left_anti").withColumn("copy", F.lit(1).cast("long")).unionByName(many)


def damage(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """``(file, status, offset, last_offset, shift, n_records, record_id, ids_sum)``.

    ``moved``: the records of a file that stand ``shift`` bytes further in the second replica:
    how many, the first and last offset, and ``ids_sum``, the sum of the first eight hex digits
    of their ids' md5.  ``changed``: a record whose content differs; ``missing`` and ``extra``:
    one that only the first or second has (shift 0).  Offsets are the first replica's, an extra
    record's the second's."""
    key = F.coalesce(F.col("record_id").cast("string"), F.lit(""))
    sides = []
    for r, offset in zip(_held(first, second, range_bytes, fanout), ("offset", "other"), strict=True):
        named = r.select("file", key.alias("key"), "digest", F.col("offset").alias(offset))
        sides.append(_copies(named, ["file", "key", "digest"], offset))
    both = stored(sides[0].join(sides[1], ["file", "key", "digest", "copy"], "full"), "merkle-matches")
    id_hash = F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("long")
    moved = (both.where("offset <> other").groupBy("file", (F.col("other") - F.col("offset")).alias("shift")).agg(
        F.min("offset").alias("offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("n_records"),
        F.sum(id_hash).alias("ids_sum")).withColumn("status", F.lit("moved")).withColumn("record_id", F.lit("")))
    lone = [_copies(both.where(F.col(there).isNull()).select("file", "key", offset), ["file", "key"], offset)
            for there, offset in (("other", "offset"), ("offset", "other"))]
    single = lone[0].join(lone[1], ["file", "key", "copy"], "full")
    status = F.when(F.col("other").isNull(), "missing").when(F.col("offset").isNull(), "extra").otherwise("changed")
    at = F.coalesce("offset", "other")
    columns = ["file", "status", "offset", "last_offset", "shift", "n_records", "record_id", "ids_sum"]
    return moved.select(*columns).unionByName(single.select(
        "file", status.alias("status"), at.alias("offset"), at.alias("last_offset"), F.coalesce(F.col("other") - F.col("offset"), F.lit(0)).alias("shift"),
        F.lit(1).cast("long").alias("n_records"), F.col("key").alias("record_id"), id_hash.alias("ids_sum")))
