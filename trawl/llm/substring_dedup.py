"""Substring de-duplication: a count-min prefilter, then exact groups.

A window is ``WIDTH`` consecutive words of a document.  A word is removed if a window
over it has a word sequence that also starts in a document with a smaller doc_id.

1. Documents are packed into groups of about ``GROUP_WORDS`` words, written once, one
   row each: what a group learns comes back to it by its name.
2. Each group sketches its windows: per hash row the sorted list of the cells it hits,
   those hit twice or more marked.  That is a count-min sketch stored sparsely, about a
   byte and a half per window and row, cut into shards of cells.  A shard's lists are
   merged, and each group gets back those of its cells that were hit more than once.
   The sketch has ``CELLS_PER_WINDOW`` cells for every window of the corpus, so the part
   of windows that is overestimated stays the same however large the corpus is.
3. Second pass: a group sends out the exact keys (128 bits) of only those windows whose
   cells were hit more than once in every row.  A repeated window hits its cells at
   least twice, so none is lost.  The keys are grouped exactly; a group sends a key once,
   with its smallest doc_id, so a passage that very many documents share is one entry
   per group.  A group learns the smallest doc_id of the keys that start earlier
   elsewhere, and cuts the words.

Defined results: null and empty texts have no words; rows without doc_id neither lose
words nor make others lose any; rows with the same doc_id do not remove from each
other; within a document nothing is removed on its own account; equal rows get equal
results; an empty table gives an empty result; columns with the names of results are
replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trawl.llm.common import stored

WIDTH = 13
DEPTH = 2
CELLS_PER_WINDOW = 8
GROUP_WORDS = 1_000_000
SHARD_WINDOWS = 2_000_000
PIECE_BYTES = 1 << 20
SPOOL_LEVEL = 6
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words, in lists of about ``PIECE_BYTES``."""
    at = 0
    while at < len(raw):
        end = at + PIECE_BYTES
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[at:end].split()
        at = end


def word_hashes(raw: bytes) -> np.ndarray:
    """Two 64-bit hashes of each word."""
    digest = xxhash.xxh3_128_digest
    parts = [np.frombuffer(b"".join([digest(w) for w in words]), "<u8").reshape(-1, 2) for words in _pieces(raw)]
    return np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)


def window_keys(hashes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of every ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    out = []
    for side, odd in enumerate(ODD):
        column = np.ascontiguousarray(hashes[:, side])
        total, factor = np.zeros(n, np.uint64), 1
        for k in range(width):
            factor = factor * odd % 2**64
            total += column[k:k + n] * np.uint64(factor)
        total ^= total >> np.uint64(32)
        total *= np.uint64(ODD[1 - side])
        total ^= total >> np.uint64(29)
        out.append(total)
    return out[0], out[1]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as a compressed block, byte by byte of the values."""
    n = len(arrays[0])
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(n, a.dtype.itemsize).T.tobytes() for a in arrays]
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(block: bytes, *kinds: str) -> list[np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(block[8:])
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * size
    return out


def _cells_block(cells: np.ndarray, again: np.ndarray) -> bytes:
    """Sorted cells as differences, each with a mark if it was hit more than once."""
    return pack(np.diff(cells, prepend=np.uint64(0)).astype("<u4"), again.astype(np.uint8))


def _cells_of(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, again = unpack(block, "<u4", "u1")
    return np.cumsum(steps, dtype=np.uint64), again.astype(bool)


class _Group:
    """A packed group: its rows, their words' hashes and windows."""

    def __init__(self, blob: bytes, id_column: int, text_column: int, width: int) -> None:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        self.rows = pa.ipc.open_stream(raw).read_all().combine_chunks()
        self.ids = self.rows.column(id_column).to_pylist()
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in self.rows.column(text_column).to_pylist()]
        hashes = [word_hashes(t) for t in self.texts]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        a, b = window_keys(np.concatenate([*hashes, np.zeros((0, 2), np.uint64)]), width)
        at = np.arange(len(a))
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)[:len(a)]
        known = np.array([i is not None for i in self.ids], bool)
        whole = (at + width <= (self.first + self.sizes)[doc]) & known[doc]
        self.at = at[whole]
        self.keys = a[whole], b[whole]
        self.doc_id = np.array([i if i is not None else 0 for i in self.ids], np.int64)[doc[whole]]


def packed(docs: DataFrame, text: str, group_words: int = GROUP_WORDS) -> DataFrame:
    """``(g, blob, n_words)``: rows of ``docs`` in groups of about ``group_words`` words."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[pa.RecordBatch], n: int) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema) as w:
                for r in rows:
                    w.write_batch(r)
            blob = zstandard.ZstdCompressor(level=SPOOL_LEVEL).compress(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_pydict({"g": [uuid.uuid4().hex], "blob": [blob], "n_words": [n]})

        held, n = [], 0
        for batch in batches:
            begin = 0
            for i, value in enumerate(batch.column(at)):
                n += sum(map(len, _pieces((value.as_py() or "").encode("utf-8", "surrogatepass"))))
                if n >= group_words:
                    yield flush([*held, batch.slice(begin, i + 1 - begin)], n)
                    held, n, begin = [], 0, i + 1
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield flush(held, n)

    return docs.mapInArrow(run, "g string, blob binary, n_words long")


def _merge_cells(lists: pa.Table) -> pa.Table:
    """Of each group's cells of one shard those that were hit more than once in all."""
    cells = [_cells_of(b) for b in lists.column("blob").to_pylist()]
    every = np.sort(np.concatenate([*(c for c, _ in cells), *(c[m] for c, m in cells)]))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out: dict[str, list] = {"g": [], "shard": [], "blob": []}
    for g, shard, (c, _) in zip(lists.column("g").to_pylist(), lists.column("shard").to_pylist(), cells, strict=True):
        own = c[_within(c, twice)]
        if len(own):
            out["g"].append(g)
            out["shard"].append(shard)
            out["blob"].append(_cells_block(own, np.zeros(len(own))))
    return pa.table(out, pa.schema([("g", pa.string()), ("shard", pa.int64()), ("blob", pa.binary())]))


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _keys_block(a: np.ndarray, b: np.ndarray, at: np.ndarray, least: np.ndarray, most: np.ndarray) -> bytes:
    """Keys with a place and their doc_ids, in the order of the places: those and the
    doc_ids then differ little from one to the next and take about a byte together."""
    order = np.argsort(at, kind="stable")
    at, least, most = at[order], least[order], most[order]
    return pack(a[order], b[order], np.diff(at, prepend=0).astype("<u4"), np.diff(least, prepend=0), most - least)


def _keys_of(block: bytes) -> tuple[np.ndarray, ...]:
    a, b, at, least, more = unpack(block, "<u8", "<u8", "<u4", "<i8", "<i8")
    least = np.cumsum(least)
    return a, b, np.cumsum(at, dtype=np.int64), least, least + more


def _least_ids(lists: pa.Table) -> pa.Table:
    """Exact groups of one bucket: for each group of documents the windows whose key
    also starts in a smaller doc_id than the group's largest, with the smallest."""
    parts = [_keys_of(b) for b in lists.column("blob").to_pylist()]
    a, b, _, least, _ = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((least, b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    smallest = np.empty(len(order), np.int64)
    smallest[order] = least[order][new][np.cumsum(new) - 1]
    out: dict[str, list] = {"g": [], "blob": []}
    begin = 0
    for g, (x, _, at, _, most) in zip(lists.column("g").to_pylist(), parts, strict=True):
        own = smallest[begin:begin + len(x)]
        begin += len(x)
        later = own < most
        if later.any():
            out["g"].append(g)
            out["blob"].append(pack(np.diff(at[later], prepend=0).astype("<u4"), np.diff(own[later], prepend=0)))
    return pa.table(out, pa.schema([("g", pa.string()), ("blob", pa.binary())]))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (the words that
    stay, joined by one blank).  ``doc_id`` is an integer column."""
    result = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())]
    carried = [c for c in docs.columns if c.lower() not in {f.name for f in result}]
    docs = docs.select(*carried)
    i, t = carried.index(doc_id), carried.index(text)
    schema = StructType([*docs.schema.fields, *result])
    spool = stored(docs.transform(packed, text), "substring-groups")
    n_windows = max(1, spool.agg(F.sum("n_words")).first()[0] or 0)
    bits = max(10, (CELLS_PER_WINDOW * n_windows - 1).bit_length())
    shard_bits = min(32, max(1, (CELLS_PER_WINDOW * SHARD_WINDOWS).bit_length() - 1))
    n_buckets = -(-n_windows // SHARD_WINDOWS)
    drop, low = np.uint64(64 - bits), np.uint64(shard_bits)

    def cells_of(group: _Group, row: int) -> np.ndarray:
        return group.keys[row] >> drop

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, blob in zip(batch.column("g").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                group = _Group(blob, i, t, width)
                out: dict[str, list] = {"shard": [], "g": [], "blob": []}
                for row in range(DEPTH):
                    cells, hits = np.unique(cells_of(group, row), return_counts=True)
                    shards, starts = np.unique(cells >> low, return_index=True)
                    for s, c, h in zip(shards, np.split(cells, starts[1:]), np.split(hits, starts[1:]), strict=True):
                        out["shard"].append(row + DEPTH * int(s))
                        out["g"].append(g)
                        out["blob"].append(_cells_block(c - (s << low), h > 1))
                yield pa.RecordBatch.from_pydict(out, pa.schema([("shard", pa.int64()), ("g", pa.string()), ("blob", pa.binary())]))

    def suspects(spool_rows: pa.Table, lists: pa.Table) -> pa.Table:
        out: dict[str, list] = {"bucket": [], "g": [], "blob": []}
        for g, blob in zip(spool_rows.column("g").to_pylist(), spool_rows.column("blob").to_pylist(), strict=True):
            group = _Group(blob, i, t, width)
            hit = np.ones(len(group.at), bool)
            known = sorted(zip(lists.column("shard").to_pylist(), lists.column("blob").to_pylist(), strict=True))
            for row in range(DEPTH):
                again = [(np.uint64(s // DEPTH) << low) + _cells_of(b)[0] for s, b in known if s % DEPTH == row]
                hit &= _within(cells_of(group, row), np.concatenate([*again, np.zeros(0, np.uint64)]))
            a, b, at, ids = (x[hit] for x in (*group.keys, group.at, group.doc_id))
            bucket = (b % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((ids, b, a, bucket))
            a, b, at, ids, bucket = (x[order] for x in (a, b, at, ids, bucket))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(a)) - 1 if len(first) else first
            buckets, starts = np.unique(bucket[first], return_index=True)
            columns = a[first], b[first], at[first], ids[first], ids[last]
            for n, k in enumerate(buckets):
                part = slice(starts[n], starts[n + 1] if n + 1 < len(starts) else None)
                out["bucket"].append(int(k))
                out["g"].append(g)
                out["blob"].append(_keys_block(*(c[part] for c in columns)))
        return pa.table(out, pa.schema([("bucket", pa.int64()), ("g", pa.string()), ("blob", pa.binary())]))

    def cut(spool_rows: pa.Table, lists: pa.Table) -> pa.Table:
        done = []
        for blob in spool_rows.column("blob").to_pylist():
            group = _Group(blob, i, t, width)
            told = [[np.cumsum(c, dtype=np.int64) for c in unpack(x, "<u4", "<i8")] for x in lists.column("blob").to_pylist()]
            gone = np.zeros(int(group.sizes.sum()) + width, np.int64)
            if told:
                at, least = (np.concatenate(x) for x in zip(*told, strict=True))
                a, b = group.keys
                where = np.searchsorted(group.at, at)
                order = np.lexsort((b[where], a[where]))
                where, least = where[order], least[order]
                # A window's key among those told, found by its first half and confirmed by its second.
                lo = np.searchsorted(a[where], a, "left")
                hi = np.searchsorted(a[where], a, "right")
                for shift in range(int((hi - lo).max(initial=0))):
                    k = np.minimum(lo + shift, len(where) - 1)
                    later = (lo + shift < hi) & (b[where][k] == b) & (least[k] < group.doc_id)
                    np.add.at(gone, group.at[later], 1)
                    np.add.at(gone, group.at[later] + width, -1)
            covered = np.cumsum(gone) > 0
            texts, n_removed = [], []
            for raw, first, size in zip(group.texts, group.first, group.sizes, strict=True):
                mask = covered[first:first + size]
                n_removed.append(int(mask.sum()))
                words = [w for piece in _pieces(raw) for w in piece]
                kept = [w for w, out in zip(words, mask, strict=True) if not out] if mask.any() else words
                texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            new = [pa.array(group.sizes), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())]
            done.append(pa.table([*group.rows.columns, *new], names=schema.names))
        return pa.concat_tables(done)

    def empty_safe(fn, none: pa.Schema):
        return lambda left, right: fn(left, right) if left.num_rows else none.empty_table()

    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(schema)
    keyed = pa.schema([("bucket", pa.int64()), ("g", pa.string()), ("blob", pa.binary())])
    groups = spool.select("g", "blob").groupBy("g")
    cells = spool.select("g", "blob").mapInArrow(sketch, "shard long, g string, blob binary")
    hit_twice = cells.groupBy("shard").applyInArrow(_merge_cells, "g string, shard long, blob binary")
    keys = groups.cogroup(hit_twice.groupBy("g")).applyInArrow(
        empty_safe(suspects, keyed), "bucket long, g string, blob binary")
    earlier = keys.groupBy("bucket").applyInArrow(_least_ids, "g string, blob binary")
    return groups.cogroup(earlier.groupBy("g")).applyInArrow(empty_safe(cut, out_schema), schema)
