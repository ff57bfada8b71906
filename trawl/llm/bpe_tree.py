"""Byte-level BPE encoding and decoding by tree reduction.

Encodings form a monoid: ``join`` makes the encoding of ``a + b`` out of those of ``a``
and ``b``.  A long piece is cut in halves down to ``LEAF_BYTES``, leaves are encoded by
plain merges, and neighbours are joined up the tree.  A join re-encodes a window around
the boundary that grows, to either side, until the tokens outside are stable.

When they are: call two tokens fitting if merging their joint bytes gives just these two
again.  A token list whose neighbours all fit is the encoding of its bytes.  (Merges go by
smallest rank, then leftmost.  Take the first merge that would cross a token's end.  Until
then the two tokens at that end have gone through the same merges as when they are encoded
by themselves, so it would have happened there too, and they would not fit.)  All
neighbours inside an encoding fit for the same reason.  So a window is stable when its
first and last tokens fit the tokens next to it outside, and a window over both whole
lists is the encoding itself.

Texts are first cut by the tokenizer's pattern, and pieces are encoded one by one, so the
lists of two neighbouring pieces are joined as they are.  Decoding concatenates the bytes
of the tokens up the same kind of tree.

Defined results: a null text counts as empty and has no tokens; a piece that is itself a
token is that token, whatever its merges give, as in the public libraries; equal texts get
equal results, each its own row; texts of any length are read whole (a piece of n bytes
costs n log n merges at worst); an empty table gives an empty result; input columns with
the names of result columns are replaced by the results.  Vocabularies are read on the
driver from the given path and travel with the task (tens of thousands of entries).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from trawl.llm.common import free_name

#: A piece of at most so many bytes is encoded by plain merges.
LEAF_BYTES = 64
#: Pieces or tokens at a leaf of the tree over a whole text.
LEAF_ITEMS = 4096
#: Entries of a worker's table of pieces seen and of fitting pairs; a full table starts anew.
MEMO = 1 << 19

RESULT = "n_tokens long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """A ``.tiktoken`` file: a line per token, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class _Pieces(dict):
    """Ids of pieces as little-endian bytes; a piece not seen yet is encoded, a long one not kept."""

    def __init__(self, codec: TreeCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = self.codec.encode_piece(piece)
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LEAF_BYTES:
            self[piece] = ids
        return ids


class _Pairs(dict):
    """Rank of the token that two tokens merge to, by ``first << 32 | second``."""

    def __init__(self, codec: TreeCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, pair: int) -> int:
        if len(self) >= MEMO:
            self.clear()
        codec = self.codec
        self[pair] = rank = codec.ranks.get(codec.vocabulary[pair >> 32] + codec.vocabulary[pair & 0xFFFFFFFF], codec._none)
        return rank


class TreeCodec:
    """Encoder and decoder of one vocabulary ``ranks``; ``pattern`` cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_bytes: int = LEAF_BYTES):
        self.ranks, self.leaf_bytes = ranks, leaf_bytes
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self._known, self._pairs = _Pieces(self), _Pairs(self)
        self._none = 1 << 62  # no token
        self._bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        self._fits: dict[tuple[int, int], bool] = {}

    def merge(self, raw: bytes) -> list[int]:
        """The encoding of ``raw`` by plain merges: smallest rank first, then leftmost."""
        if len(raw) > LEAF_BYTES:
            return self._merge_long(raw)
        pairs, none = self._pairs, self._none
        ids = [self._bytes[b] for b in raw]
        ranks = [pairs[a << 32 | b] for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i] = best  # a token's id is its rank
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = pairs[best << 32 | ids[i + 1]]
            if i:
                ranks[i - 1] = pairs[ids[i - 1] << 32 | best]
        return ids

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same by a queue of merges, for windows of any length."""
        n = len(raw)
        parts: list[bytes | None] = [raw[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or len(parts[i]) + len(parts[j]) != size:  # one of the two has been merged since
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(parts[i] + parts[k])) is not None:
                    heapq.heappush(heap, (r, i, size + len(parts[k])))
            if (h := before[i]) >= 0 and (r := rank(parts[h] + parts[i])) is not None:
                heapq.heappush(heap, (r, h, len(parts[h]) + size))
        return [self.ranks[p] for p in parts if p is not None]

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def fits(self, a: int, b: int) -> bool:
        pair = (a, b)
        found = self._fits.get(pair)
        if found is None:
            if len(self._fits) >= MEMO:
                self._fits.clear()
            found = self._fits[pair] = self.merge(self.bytes_of([a, b])) == [a, b]
        return found

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of two texts one after the other, from their encodings."""
        if not a or not b or self.fits(a[-1], b[0]):
            return a + b
        left = right = 1
        while True:
            left, right = min(left, len(a)), min(right, len(b))
            cut = len(a) - left
            window = self.merge(self.bytes_of(a[cut:] + b[:right]))
            stable_left = left == len(a) or self.fits(a[cut - 1], window[0])
            stable_right = right == len(b) or self.fits(window[-1], b[right])
            if stable_left and stable_right:
                return a[:cut] + window + b[right:]
            left, right = left * (1 if stable_left else 2), right * (1 if stable_right else 2)

    def encode_bytes(self, raw: bytes) -> list[int]:
        """Halves, encoded by themselves and joined."""
        if len(raw) <= self.leaf_bytes:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join(self.encode_bytes(raw[:half]), self.encode_bytes(raw[half:]))

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        return [whole] if whole is not None else self.encode_bytes(raw)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text.  Neighbouring pieces do not merge, so their lists are joined as they are."""
        return np.frombuffer(_up_the_tree(self.pieces(text), self._leaf, bytes.__add__), "<u4")

    def _leaf(self, pieces: list[str]) -> bytes:
        if len(self._known) >= MEMO:
            self._known.clear()
        return b"".join(map(self._known.__getitem__, pieces))

    def decode(self, ids: np.ndarray) -> bytes:
        return _up_the_tree(ids.tolist(), self.bytes_of, bytes.__add__)


def _up_the_tree(items: list, leaf, join):
    if len(items) <= LEAF_ITEMS:
        return leaf(items)
    half = len(items) // 2
    return join(_up_the_tree(items[:half], leaf, join), _up_the_tree(items[half:], leaf, join))


def _batches(b: pa.RecordBatch, column: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with some 16 MB of text, so that results of long texts go out bit by bit."""
    size = start = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()):
        if size and size + n > 1 << 24:
            yield start, i - start
            size, start = 0, i
        size += n
    if start < b.num_rows:
        yield start, b.num_rows - start


def _run(docs: DataFrame, text: str, ranks: dict[bytes, int], pattern: str, result: str, values) -> DataFrame:
    """``docs`` with the columns of ``result``, which ``values(ids, decoded)`` gives for a text."""
    own = StructType.fromDDL(result)
    taken = {f.name.lower() for f in own}
    carried = [c for c in docs.columns if c.lower() not in taken]
    source = docs.select(*carried, docs[text].alias(free_name(docs, "__encoded")))
    out = StructType([*docs.select(*carried).schema.fields, *own.fields])
    n_carried = len(carried)
    arrow = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    kinds = [arrow[f.dataType.simpleString()] for f in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(ranks, pattern)
        for whole in batches:
            for start, n in _batches(whole, n_carried):
                b = whole.slice(start, n)
                rows = []
                for x in b.column(n_carried):
                    ids = codec.encode(x.as_py() or "")
                    rows.append(values(ids, codec.decode(ids)))
                new = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[:n_carried], *new], names=[*out.names])

    return source.mapInArrow(run, out)


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``RESULT``: the ids as little-endian unsigned 32-bit
    numbers, and the bytes that decoding them gives.  One pass, no shuffle."""
    return _run(docs, text, ranks, pattern, RESULT, lambda ids, decoded: (len(ids), ids.tobytes(), decoded))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and the sha256 of ids and decoded bytes, made where they arise."""
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    return _run(docs, text, ranks, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                lambda ids, decoded: (len(ids), sha(ids.tobytes()), sha(decoded)))
