"""Shared pieces of the training-data operators: scans, cuts, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_dir

# A word is a maximal run of characters outside this set (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
# Text handled at a time by the numpy helpers, in bytes.
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a table every executor can reach, so a lost executor
    costs a re-read only.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    _STASHED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STASHED: list[str] = []


def drop_stashed(spark: SparkSession) -> int:
    """Delete the tables stashed so far, once no result is read from them any more."""
    dropped = 0
    while _STASHED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STASHED.pop())
        dropped += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return dropped


def source_key(column) -> F.Column:
    """A non-null text that tells null from every string."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c.cast("string")))


# --- text as bytes -----------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bijection on 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    out = []
    for base in (int(_MULT), pow(int(_MULT), -1, 1 << 64)):
        step = np.full(n, base, dtype=np.uint64)
        step[:1] = 1
        out.append(np.multiply.accumulate(step))
    return out[0], out[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each (a longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of its first word per row.

    ``offsets`` are row bounds into ``raw``; words never span rows.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    inside = ~_SPACE[raw[lo:hi]]
    first = np.zeros(hi - lo + 1, dtype=bool)
    first[(offsets[:-1] - lo)] = True
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1])) + lo
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + lo + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, from prefix sums of byte values."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lo, hi = int(starts[0]), int(ends[-1])
    data = raw[lo:hi]
    if lower:
        data = _LOWER[data]
    power, inverse = _powers(hi - lo)
    total = np.empty(hi - lo + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUE[data] * power, out=total[1:])
    s = starts - lo
    return mix64((total[ends - lo] - total[s]) * inverse[s] + (ends - starts).astype(np.uint64) * _MIX1)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles per row, with row bounds.

    ``bounds`` are the rows' positions in ``words``. A row of fewer than ``n``
    words has its whole sequence as one shingle; a row without words has none.
    """
    count = np.diff(bounds)
    total = len(words)
    run = np.zeros(total, dtype=np.uint64)
    for k in range(min(n, total)):
        part = words[k:] * np.uint64(int(_MULT) * (2 * k + 3) % (1 << 64))
        run[:total - k] += part if k == 0 else mix64(part)
    per_row = np.where(count >= n, count - n + 1, 0)
    row = np.repeat(np.arange(len(count)), per_row)
    out_bounds = np.concatenate([[0], np.cumsum(np.where(count >= n, count - n + 1, np.minimum(count, 1)))])
    out = np.empty(int(out_bounds[-1]), dtype=np.uint64)
    first = np.cumsum(per_row) - per_row
    within = np.arange(len(row)) - first[row]
    out[out_bounds[:-1][row] + within] = run[bounds[:-1][row] + within]
    for r in np.flatnonzero((count > 0) & (count < n)):
        value = np.array([count[r]], dtype=np.uint64)
        for w in words[bounds[r]:bounds[r + 1]]:
            value = mix64(value * _MULT + w)
        out[out_bounds[r]] = value[0]
    return mix64(out), out_bounds


# --- held-out rows -------------------------------------------------------------

FOLDS = 5


def held_out():
    """Rows whose id falls in the fold that nothing is learned from; a null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sorted_features(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of column ``x`` (32-bit floats) ordered by id and content, and that order."""
    column = table.column("x").combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    ids = table.column("doc_id").to_pylist()
    # Rows of one id are told apart by a weighted sum of their values.
    content = x @ np.linspace(1.0, 2.0, width, dtype=np.float32)
    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], content[i])), dtype=np.int64)
    return x[order], order
