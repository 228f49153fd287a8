"""Operator 8: document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases into longer phrases, and so
on. On each level, runs of one name become one name; then deterministic coin
tossing (each name is replaced by the place and value of its lowest bit that
differs from its left neighbour's, repeated until few values remain) marks
local maxima, and a phrase begins at each mark. A phrase is named by a hash of its
content, so equal substrings get equal names inside, whatever stands before
them: where a phrase begins depends on a bounded number of neighbours only.

A fingerprint is, for each of the levels ``LEVELS``, the ``KEEP`` smallest
distinct phrase hashes, written in hexadecimal; two fingerprints are compared
by the mean, over the levels that either has, of the share of equal hashes
among the smallest of their union: an estimate of the share of common phrases, whose error a level
is about 0.1 for texts of more than ``KEEP`` phrases. A text shorter than a level's phrases
has its topmost phrase there. A last part is a 64-bit digest of the whole top level
in order, so that texts which differ anywhere have different fingerprints however long they are.

Defined results: a null text is empty; an empty text has an empty fingerprint,
and two empty ones are alike with 1.0; documents are ordered by descending
``doc_id`` (null last), equal ids by text hash, so repeated rows follow each
other; a single document is its own successor; an empty table gives an empty
result; only ``doc_id`` (an integer) and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import mix64, row_chunks, text_buffers

LEVELS = (2, 3, 4)
KEEP = 24
ROUNDS = 3

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_NAME = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)


# Odd multipliers by place in a phrase; a phrase has far fewer than 64 parts.
_PLACE = mix64(np.arange(1, 65, dtype=np.uint64) * _ODD) | np.uint64(1)


def _phrase_names(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Name of each phrase, from its parts and their places in it."""
    size = np.diff(np.append(starts, len(names)))
    place = (np.arange(len(names)) - np.repeat(starts, size)) & 63
    total = np.add.reduceat(names * _PLACE[place], starts)
    return mix64(total + size.astype(np.uint64) * _ODD)


def _collapse(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one name within a row become one name that holds their length."""
    first = np.ones(len(names), dtype=bool)
    first[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    if first.all():
        return names, row
    starts = np.flatnonzero(first)
    size = np.diff(np.append(starts, len(names))).astype(np.uint64)
    out = names[starts]
    return np.where(size > 1, mix64(out ^ (size * _ODD)), out), row[starts]


# Index of a lowest bit by multiplication with a de Bruijn sequence (fixed value).
_DE_BRUIJN = np.uint64(0x03F79D71B4CB0A89)
_BIT = np.zeros(64, dtype=np.uint8)
for _k in range(64):
    _BIT[(int(_DE_BRUIJN) << _k & (1 << 64) - 1) >> 58] = _k


def _toss_table(values: int) -> np.ndarray:
    """Toss of every (label, left label) below ``values``: 2 * lowest differing bit + the bit."""
    out = np.zeros((values, values), dtype=np.uint8)
    for x in range(values):
        for y in range(values):
            bit = ((x ^ y) & -(x ^ y)).bit_length() - 1 if x != y else 7
            out[x, y] = 2 * bit + (x >> bit & 1)
    return out


_TOSS = _toss_table(256).ravel()


def phrase_starts(names: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where phrases begin: at each row's start and at local maxima of the coin tosses."""
    n = len(names)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = row[1:] != row[:-1]
    differ = np.empty_like(names)
    differ[0] = 1
    differ[1:] = names[1:] ^ names[:-1]
    # A row's first name tosses for its first bit.
    differ[fresh] = 1
    bit = _BIT[((differ & (~differ + np.uint64(1))) * _DE_BRUIJN) >> np.uint64(58)]
    label = bit * np.uint8(2) + ((names >> bit) & np.uint64(1)).astype(np.uint8)
    for _ in range(ROUNDS - 1):
        at = label.astype(np.uint16) << np.uint16(8)
        at[1:] |= label[:-1]
        at[fresh] = (at[fresh] & np.uint16(0xFF00)) | (label[fresh] ^ np.uint8(1))
        label = _TOSS[at]
    rise = np.ones(n, dtype=bool)
    rise[1:] = label[1:] > label[:-1]
    mark = np.zeros(n, dtype=bool)
    mark[:-1] = rise[:-1] & ~rise[1:]
    mark[-1] = rise[-1]
    # The next row's start ends a row's last rise; a mark right after a start would leave a phrase of one name.
    ends = np.append(fresh[1:], True)
    mark = (mark | (rise & ends)) & ~fresh
    mark[1:] &= ~fresh[:-1]
    return np.flatnonzero(mark | fresh)


def parse_levels(raw: np.ndarray, offsets: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(phrase names, row) for the levels 1 to ``top``; a row of one phrase keeps it above."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    names = _BYTE_NAME[raw[lo:hi]]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out = []
    for _ in range(top):
        if len(names):
            names, row = _collapse(names, row)
            starts = phrase_starts(names, row)
            size = np.diff(np.append(starts, len(names)))
            made = _phrase_names(names, starts)
            # A row that is one name already stays as it is.
            alone = (size == 1) & _single(row[starts])
            names, row = np.where(alone, names[starts], made), row[starts]
        out.append((names, row))
    return out


def _single(row: np.ndarray) -> np.ndarray:
    """Whether a row has one entry only."""
    same = np.zeros(len(row), dtype=bool)
    same[1:] |= row[1:] == row[:-1]
    same[:-1] |= row[:-1] == row[1:]
    return ~same


def sketches(raw: np.ndarray, offsets: np.ndarray) -> list[list[np.ndarray]]:
    """Per level and row the smallest distinct phrase hashes, ascending, as unsigned 32-bit; last the whole parse's digest."""
    rows = len(offsets) - 1
    out = []
    levels = parse_levels(raw, offsets, max(LEVELS))
    for level in LEVELS:
        names, row = levels[level - 1]
        key = (row.astype(np.uint64) << np.uint64(32)) | (mix64(names) >> np.uint64(32))
        key = np.unique(key)
        owner = (key >> np.uint64(32)).astype(np.int64)
        at = np.searchsorted(owner, np.arange(rows + 1))
        small = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        out.append([small[at[i]:min(at[i] + KEEP, at[i + 1])] for i in range(rows)])
    out.append(_digests(*levels[-1], rows))
    return out


def _digests(names: np.ndarray, row: np.ndarray, rows: int) -> list[np.ndarray]:
    """Digest of each row's names and their places, as two halves; none for an empty row."""
    size = np.bincount(row, minlength=rows)
    starts = np.cumsum(size) - size
    filled = np.flatnonzero(size)
    if not len(filled):
        return [np.zeros(0, np.uint32)] * rows
    place = (np.arange(len(names)) - starts[row] + 1).astype(np.uint64)
    total = np.add.reduceat(mix64(names ^ mix64(place * _ODD)), starts[filled])
    digest = np.zeros(rows, np.uint64)
    digest[filled] = mix64(total + size[filled].astype(np.uint64) * _ODD)
    halves = np.stack([digest >> np.uint64(32), digest & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
    return [halves[i] if size[i] else halves[i][:0] for i in range(rows)]


def write_fingerprint(parts: list[np.ndarray]) -> str:
    return "-".join(p.astype(">u4").tobytes().hex() for p in parts) if any(len(p) for p in parts) else ""


def read_fingerprint(text: str) -> list[np.ndarray]:
    return [np.frombuffer(bytes.fromhex(p), dtype=">u4") for p in text.split("-")] if text else [np.zeros(0, np.uint32)] * (len(LEVELS) + 1)


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """Mean over the levels of the estimated share of common phrases (the digests take no part)."""
    a, b = a[:len(LEVELS)], b[:len(LEVELS)]
    if not any(len(p) for p in a) and not any(len(p) for p in b):
        return 1.0
    total = 0.0
    for p, q in zip(a, b):
        if not len(p) or not len(q):
            continue
        p, q = set(p.tolist()), set(q.tolist())
        lowest = sorted(p | q)[:KEEP]
        total += sum(x in p and x in q for x in lowest) / len(lowest)
    return total / len(LEVELS)


def _all_sketches(texts: list[str]) -> list[list[np.ndarray]]:
    out: list[list[np.ndarray]] = []
    raw, offsets = text_buffers(pa.array(texts, pa.large_string()))
    for lo, hi in row_chunks(offsets):
        out.extend(list(parts) for parts in zip(*sketches(raw, offsets[lo:hi + 1])))
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in descending order; a row's successor follows it in its partition.

    The last row of a partition is a guest: it only serves as the successor.
    """
    waiting = None
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = part.column("doc_id")
            texts = [t or "" for t in part.column("text").to_pylist()]
            guest = part.column("guest").to_pylist()
            own = _all_sketches(texts)
            if waiting is not None:
                ids = pa.concat_arrays([waiting[0], ids])
                texts, guest, own = [waiting[1], *texts], [waiting[2], *guest], [waiting[3], *own]
            last = len(texts) - 1
            waiting = (ids.slice(last, 1), texts[last], guest[last], own[last])
            if last == 0:
                continue
            edited = []
            for i in range(last):
                half = len(texts[i]) // 2
                edited.append(texts[i][:len(texts[i]) - half] + texts[i + 1][:half])
            after = _all_sketches(edited)
            keep = [i for i in range(last) if not guest[i]]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())), pa.array([len(texts[i]) for i in keep], pa.int64()),
                 pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep], pa.string()),
                 pa.array([write_fingerprint(own[i]) for i in keep], pa.string()),
                 pa.array([write_fingerprint(after[i]) for i in keep], pa.string()),
                 pa.array([likeness(own[i], after[i]) for i in keep], pa.float64()),
                 pa.array([likeness(own[i], own[i + 1]) for i in keep], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _range_of(starts: np.ndarray):
    @F.pandas_udf("int")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts[1:], key.to_numpy(), side="right").astype(np.int32))
    return find


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Texts move once: rows are dealt to ranges of ids, whose borders come from
    the ids alone (one per partition), and the first row of each range also goes
    to the range before it, to be the successor of its last row.
    """
    spark = docs.sparkSession
    # The complement of an id ascends as the id descends; null comes last.
    rank = F.coalesce(F.bitwise_not(F.col("doc_id").cast("bigint")), F.lit((1 << 63) - 1))
    docs = docs.select("doc_id", "text", rank.alias("rank"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranges = (docs.select("rank").repartitionByRange(parts, "rank").groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min("rank").alias("start")).toPandas())
    starts = np.sort(ranges["start"].to_numpy(np.int64))
    range_of = _range_of(starts)
    rows = docs.withColumn("range", range_of("rank")).withColumn("guest", F.lit(False))
    heads = docs.join(F.broadcast(spark.createDataFrame([(int(x),) for x in starts], "rank long")), "rank", "left_semi")
    heads = heads.groupBy("rank").agg(F.min_by(F.struct("doc_id", "text"), F.xxhash64("text")).alias("h"))
    guests = heads.select("h.doc_id", "h.text", "rank", F.pmod(range_of("rank") - 1, F.lit(max(1, len(starts)))).cast("int").alias("range"),
                          F.lit(True).alias("guest"))
    dealt = (rows.unionByName(guests).withColumn("tie", F.xxhash64("text")).repartition(max(1, len(starts)), "range")
             .sortWithinPartitions("range", "guest", "rank", "tie"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return dealt.select("doc_id", "text", "guest").mapInArrow(
        _fingerprints, f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                       "near_edited double, near_next double")
