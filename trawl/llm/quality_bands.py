"""Quality rule: compression bands.

A text is compressed with zstandard as a whole and in fixed chunks.  A low ratio
(compressed bytes / bytes) means repetition, a high one means noise.  Both limits
depend on the length, as short texts always compress worse.  The last chunk may be
shorter and has the band of its own length.

Defined results: null and empty texts have no words and fail the base rule; texts
of any length are read whole; equal rows get equal verdicts, each its own row; an
empty table gives an empty result; input columns with the names of result columns
are replaced by the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from trawl.llm.common import free_name

#: Texts of at most so many bytes -> smallest and largest ratio of the whole text.
#: The largest lie above prose in several languages at the short end of each length and below
#: base64 and random alphanumeric words at its long end.
BANDS: tuple[tuple[float, float, float], ...] = (
    (256, 0.20, 0.95),
    (512, 0.40, 0.84),
    (1024, 0.41, 0.79),
    (2048, 0.43, 0.71),
    (4096, 0.415, 0.63),
    (8192, 0.40, 0.58),
    (16384, 0.385, 0.55),
    (65536, 0.365, 0.52),
    (float("inf"), 0.33, 0.49),
)
CHUNK_BYTES = 4096
#: Smallest and largest ratio of a full chunk (a shorter last one has the band of its
#: length), and the largest share of a text's bytes in chunks outside.
CHUNK_BAND = (0.30, 0.63)
BAD_CHUNKS = 0.25
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = b"#*$%&|<>"

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, kept boolean")


def _dup_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            dup += line in seen
            seen.add(line)
    return dup


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more.  Windows are numbers made
    of their words' numbers, exactly, a few bytes each however long the text is."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 21:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    again = counts[which] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k:k + n] |= again
    return int(hit.sum())


def _band(n_bytes: int) -> tuple[float, float]:
    return next((lo, hi) for upto, lo, hi in BANDS if n_bytes <= upto)


def _inside(ratio: float, band: tuple[float, float]) -> bool:
    return band[0] <= ratio <= band[1]


def measure(text: str | None, packer: zstandard.ZstdCompressor) -> tuple:
    """The values of ``RESULT`` for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text or "") - sum(raw.count(c) for c in b" \t\n\x0b\x0c\r")
    symbols = sum(raw.count(c) for c in SYMBOLS)
    repeat = _repeat_words(words)
    base_failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
    ratio = len(packer.compress(raw)) / len(raw) if raw else 0.0
    chunks = [raw[i:i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
    bad = [len(c) for c in chunks if not _inside(len(packer.compress(c)) / len(c), CHUNK_BAND if len(c) == CHUNK_BYTES else _band(len(c)))]
    kept = not base_failed and _inside(ratio, _band(len(raw))) and sum(bad) <= BAD_CHUNKS * len(raw)
    return n, word_chars, symbols, _dup_lines(raw), repeat, base_failed, ratio, len(chunks), len(bad), kept


def compression_bands(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``RESULT``; ``kept`` is the verdict.  One pass
    over Arrow batches, no shuffle."""
    result = StructType.fromDDL(RESULT)
    own = {f.name.lower() for f in result}
    carried = [c for c in docs.columns if c.lower() not in own]
    source = docs.select(*carried, docs[text].alias(free_name(docs, "__measured")))
    out = StructType([*docs.select(*carried).schema.fields, *result.fields])
    n_carried = len(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
        for b in batches:
            rows = [measure(x.as_py(), packer) for x in b.column(n_carried)]
            cols = zip(*rows, strict=True) if rows else [()] * len(kinds)
            new = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_carried], *new], names=[*out.names])

    return source.mapInArrow(run, out)
