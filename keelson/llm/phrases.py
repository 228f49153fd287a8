"""Operator 12: phrase collocation mining by a multikey quicksort of suffixes.

Texts are lower-cased (A-Z), split into pieces and words; every word starts a
suffix of at most ``DEPTH`` words that ends with its piece. Counting goes down
the suffixes' leading words:

* words are counted by language; a suffix whose leading words hold an infrequent
  one is abandoned, and so is one whose leading pair is infrequent. Tasks know
  frequent words and pairs by bitmaps of fixed size, which never turn a frequent one
  away; what they let through besides only costs work;
* phrases of two words have their exact counts from the pairs. Longer ones end where
  they cannot be frequent any more: every task adds up its runs of three to ``DEPTH`` words
  in hashed cells, the cells are summed over all tasks, and a run whose cell stays
  below the threshold is infrequent (Park, Chen and Yu's hash filter);
* each task joins equal suffixes of three words or more (a few tasks a core, so that
  a suffix comes once from each of them, however long the table), and what is left is routed over the cluster by
  a range partitioning on the leading words, so that a hot lead is cut between
  its continuations;
* each range is sorted by a three-way multikey quicksort of pointers to its
  suffixes: pointers whose word at the current depth equals the pivot's form one
  partition, whose size is the count of the phrase so far, and the sort goes on one
  word deeper; a partition below the threshold is abandoned with all it holds. Only
  partitions that touch the ends of a range go on whatever their size, and their
  sizes are added up across ranges.

Phrases of 2 to ``DEPTH`` words with a count of at least ``least`` are candidates. A cut
after the first k words gives l and r, the counts of both parts, and the score
floor(1000 * count * n / (l * r)), n being all words of the language, in decimals
of 38 digits (exact for counts below 10^16); the lowest cut counts, the
smallest k among equals. A candidate that lies in a longer one with at least ``cover``
percent of its count is dropped.

Defined results: null texts and texts without words add nothing; a null
language is ``und``; repeated rows count each; ties in score go by count, then by
the phrase in UTF-8 byte order; an empty table gives no rows; texts of any
length are read whole, a piece has no longest length; extra columns are
ignored. Words are compared by 64-bit hashes whose collisions are looked for: if two
words of a language share one, everything is counted again under another seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import mix64, row_chunks, span_hashes, stash, text_buffers

DEPTH = 5
LEAST, TOP, COVER = 100, 2000, 100
UNKNOWN = "und"
# Bits of the bitmaps of frequent words and pairs, as powers of two.
WORD_BITS, PAIR_BITS = 25, 27
# Cells that runs of three words or more are added up in, as a power of two, and the slices they are summed in.
RUN_BITS, SLICE_BITS = 26, 5
# Runs a task holds before it hands on their cells.
HELD_RUNS = 4_000_000
# Suffixes of one range, and text joined at a time by a task.
RANGE_ROWS, BLOCK_BYTES = 1_500_000, 8 << 20
# Distinct suffixes a task holds while it joins those of several blocks.
HELD_ROWS = 600_000
# Tasks a core that joins suffixes has: more text a task, fewer copies of one suffix.
TASKS_A_CORE = 2
SEEDS = 4

# What ends a piece, and what separates words besides.
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
COLS = [f"w{k}" for k in range(1, DEPTH + 1)]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte, piece and row of every word."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    if lo == hi:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    data = raw[lo:hi]
    inside = ~_GAP[data]
    first = np.zeros(hi - lo + 1, dtype=bool)
    first[offsets - lo] = True
    starts = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | first[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | first[1:])) + 1
    piece = np.cumsum(_BREAK[data] | first[:-1], dtype=np.int32)[starts]
    row = np.searchsorted(offsets - lo, starts, side="right") - 1
    return starts + lo, ends + lo, piece, row


def word_keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray, seed: int) -> np.ndarray:
    """64-bit key of every word with its language; never 0."""
    h = span_hashes(raw, starts, ends)
    key = mix64(h ^ mix64(lang.view(np.uint64) + np.uint64(seed) * _STEP))
    return np.where(key == 0, np.uint64(1), key)


def pair_keys(key: np.ndarray) -> np.ndarray:
    """Key of every word with the word after it (the last pairs with nothing)."""
    return mix64(key[:-1] * _STEP + key[1:])


def run_cells(key: np.ndarray, good: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first words, cells of 2^bits) of all runs of 3, 4, ... ``DEPTH`` words whose pairs are all ``good``."""
    at = np.flatnonzero(good)
    h = mix64(key[at] * _STEP + key[at + 1])
    for k in range(2, DEPTH):
        more = good[at + k - 1]
        at = at[more]
        h = mix64(h[more] * _STEP + key[at + k])
        yield at, (h >> np.uint64(64 - bits)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], seed: int):
    """(bytes, starts, ends, keys, piece ids, rows, batch) of about ``BLOCK_BYTES`` of text at a time."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        lang = batch.column("lang_hash").to_numpy()
        for lo, hi in row_chunks(offsets, BLOCK_BYTES):
            starts, ends, piece, row = words(raw, offsets[lo:hi + 1])
            if len(starts):
                # Keys are prefix sums over the bytes at hand: taken in smaller steps they stay in cache.
                key = np.concatenate([word_keys(raw, starts[a:a + 65536], ends[a:a + 65536], lang[lo + row[a:a + 65536]], seed)
                                      for a in range(0, len(starts), 65536)])
                yield raw, starts, ends, key, piece, lo + row, batch


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw, starts, ends, key, _, row, batch in _blocks(batches, seed):
            uniq, at, code, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            # Words as strings, cut from the lower-cased bytes of one mention of each.
            size = ends[at] - starts[at]
            bound = np.concatenate([[0], np.cumsum(size)])
            take = np.repeat(starts[at] - bound[:-1], size) + np.arange(bound[-1])
            text = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(bound.astype(np.int64).tobytes()),
                                                                      pa.py_buffer(_LOWER[raw[take]].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(row[at])).cast(pa.string()), pa.array(uniq.view(np.int64)), text.cast(pa.string()),
                 pa.array(n)], ["lang", "key", "word", "n"])
            odd = _other_words(raw, starts, ends, at[code])
            if len(odd):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").take(pa.array(row[odd])).cast(pa.string()), pa.array(key[odd].view(np.int64)),
                     pa.array([_LOWER[raw[a:b]].tobytes().decode() for a, b in zip(starts[odd], ends[odd])], pa.string()),
                     pa.array(np.zeros(len(odd), np.int64))], ["lang", "key", "word", "n"])
    return run


def _other_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Mentions that are not, byte by byte, the word of mention ``like``: their keys clash."""
    odd = [np.zeros(0, np.int64)]
    for lo in range(0, len(starts), 65536):
        one = np.arange(lo, min(lo + 65536, len(starts)))
        size = ends[one] - starts[one]
        same = size == ends[like[one]] - starts[like[one]]
        odd.append(one[~same])
        one, size = one[same], size[same]
        bound = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(bound, size)
        differ = _LOWER[raw[np.repeat(starts[one], size) + step]] != _LOWER[raw[np.repeat(starts[like[one]], size) + step]]
        odd.append(one[np.add.reduceat(differ, bound) > 0] if len(one) else one)
    return np.concatenate(odd)


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of column ``key``, two of ``2^bits`` bits a key, as 32-bit words.

    Spark sets and joins the bits; at most 2^(bits-5) words reach the driver.
    """
    mask = (1 << bits) - 1
    bit = F.explode(F.array(F.shiftrightunsigned("key", 64 - bits).bitwiseAND(F.lit(mask)), F.col("key").bitwiseAND(F.lit(mask))))
    found = (keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("slot"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("value"))).toArrow()
    data = np.zeros(1 << (bits - 5), dtype=np.uint32)
    data[found.column("slot").to_numpy()] = found.column("value").to_numpy().astype(np.uint32)
    return data


def in_bitmap(data: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys may be in the bitmap; none that is in it is missed."""
    bits = len(data).bit_length() + 4
    out = np.ones(len(key), dtype=bool)
    for shift in (64 - bits, 0):
        bit = (key >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
        out &= (data[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
    return out


def _count_pairs(seed: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, key, piece, _, _ in _blocks(batches, seed):
            known = in_bitmap(frequent.value, key)
            at = np.flatnonzero(known[:-1] & known[1:] & (piece[:-1] == piece[1:]))
            table, n = join_equal(np.stack([key[at], key[at + 1]], axis=1).view(np.int64), np.ones(len(at), dtype=np.int64))
            # Pairs of one first word together are shuffled in fewer bytes.
            order = np.argsort(table[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(table[order, 0]), pa.array(table[order, 1]), pa.array(n[order])], ["w1", "w2", "n"])
    return run


def _pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = np.stack([batch.column(c).to_numpy() for c in ("w1", "w2")], axis=1).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(mix64(both[:, 0] * _STEP + both[:, 1]).view(np.int64))], ["key"])


def _good_pairs(key: np.ndarray, piece: np.ndarray, pairs) -> np.ndarray:
    """Whether each word and the word after it may be a frequent pair of one piece."""
    good = np.zeros(len(key), dtype=bool)
    good[:-1] = (piece[:-1] == piece[1:]) & in_bitmap(pairs.value, pair_keys(key))
    return good


def _cell_batch(cells: np.ndarray, bits: int) -> pa.RecordBatch:
    """One row a slice: its cells, 32 bits each, and how often each was met."""
    cell, n = np.unique(cells, return_counts=True)
    wide = bits - SLICE_BITS
    part, at = np.unique(cell >> wide, return_index=True)
    bound = (np.append(at, len(cell)) * 4).astype(np.int32)
    packed = [pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(bound.tobytes()), pa.py_buffer(x.astype(np.uint32).tobytes())])
              for x in (cell & ((1 << wide) - 1), n)]
    return pa.RecordBatch.from_arrays([pa.array(part), *packed], ["slice", "cells", "n"])


def _count_runs(seed: int, pairs, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, _, _, key, piece, _, _ in _blocks(batches, seed):
            for _, cells in run_cells(key, _good_pairs(key, piece, pairs), bits):
                held.append(cells)
                size += len(cells)
            if size >= HELD_RUNS:
                yield _cell_batch(np.concatenate(held), bits)
                held, size = [], 0
        if size:
            yield _cell_batch(np.concatenate(held), bits)
    return run


def _sum_cells(least: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells, n in zip(*(batch.column(c).to_pylist() for c in ("slice", "cells", "n"))):
                if part not in total:
                    total[part] = np.zeros(1 << (bits - SLICE_BITS), dtype=np.int64)
                total[part][np.frombuffer(cells, dtype=np.uint32)] += np.frombuffer(n, dtype=np.uint32)
        for part, n in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([np.packbits(n >= least, bitorder="little").tobytes()])], ["slice", "bits"])
    return run


def run_bitmap(texts: DataFrame, seed: int, pairs, least: int, bits: int) -> np.ndarray:
    """Bitmap of the 2^bits cells: whose runs of words number at least ``least``, as bytes.

    Tasks sum the cells slice by slice; 2^bits bits reach the driver. A task hands on one row a
    slice and at most ``DEPTH`` - 2 cells a word.
    """
    cells = texts.mapInArrow(_count_runs(seed, pairs, bits), "slice long, cells binary, n binary")
    found = (cells.repartition(1 << SLICE_BITS, "slice").mapInArrow(_sum_cells(least, bits), "slice long, bits binary")).toArrow()
    data = np.zeros((1 << SLICE_BITS, 1 << (bits - SLICE_BITS - 3)), dtype=np.uint8)
    for part, bits in zip(found.column("slice").to_pylist(), found.column("bits").to_pylist()):
        data[part] = np.frombuffer(bits, dtype=np.uint8)
    return data.reshape(-1)


def join_equal(table: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``table`` and their summed weights; rows whose hashes clash stay apart."""
    h = np.zeros(len(table), dtype=np.uint64)
    for k in range(table.shape[1]):
        h = mix64(h * _STEP + table[:, k].view(np.uint64))
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    same = (table == table[first[code]]).all(axis=1)
    total = np.bincount(code[same], weights=weight[same], minlength=len(first)).astype(np.int64)
    return np.concatenate([table[first], table[~same]]), np.concatenate([total, weight[~same]])


def _suffix_batch(table: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.array(table[:, k].copy()) for k in range(DEPTH)], pa.array(n)], [*COLS, "n"])


def _suffixes(seed: int, pairs, runs=None):
    """Suffixes while their pairs may all be frequent; with ``runs``, those of three words or more while they may be as a whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Equal suffixes of all blocks of a task are joined, not only those of one.
        held, weight = np.zeros((0, DEPTH), np.int64), np.zeros(0, np.int64)
        for _, _, _, key, piece, _, _ in _blocks(batches, seed):
            good = _good_pairs(key, piece, pairs)
            length = np.where(good, 2, 0)
            for k, (at, cell) in enumerate(run_cells(key, good, 10 if runs is None else len(runs.value).bit_length() + 2), 3):
                if runs is not None:
                    at = at[((runs.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1)]
                    at = at[length[at] == k - 1]
                length[at] = k
            alive = np.flatnonzero(length >= (2 if runs is None else 3))
            table = np.zeros((len(alive), DEPTH), dtype=np.int64)
            for k in range(DEPTH):
                going = length[alive] > k
                table[going, k] = key[alive[going] + k].view(np.int64)
            table, n = join_equal(table, np.ones(len(table), dtype=np.int64))
            held, weight = join_equal(np.concatenate([held, table]), np.concatenate([weight, n])) if len(held) else (table, n)
            if len(held) >= HELD_ROWS:
                yield _suffix_batch(held, weight)
                held, weight = held[:0], weight[:0]
        yield _suffix_batch(held, weight)
    return run


def quicksort_counts(table: np.ndarray, weight: np.ndarray, least: int, keep_ends: bool = False) -> list[tuple[int, int, int]]:
    """(row, depth, weight) of every group of rows that share their first ``depth`` >= 2 words.

    Multikey three-way quicksort: pointers are parted around a pivot word at the
    current depth; the equal part is one phrase and is sorted one word deeper.
    A part that weighs less than ``least`` is abandoned, unless it holds the
    first or last row in order and ``keep_ends`` is set. 0 stands for no word.
    """
    rows, depth_of = table.shape
    found = []
    ends = set()
    if keep_ends and rows:
        order = [np.arange(rows), np.arange(rows)]
        for k in range(depth_of):
            for j, pick in enumerate((np.min, np.max)):
                order[j] = order[j][table[order[j], k] == pick(table[order[j], k])]
        ends = {int(order[0][0]), int(order[1][0])}
    guard = np.zeros(rows, dtype=bool)
    guard[list(ends)] = True
    stack = [(np.arange(rows), 0)] if rows else []
    while stack:
        part, depth = stack.pop()
        column = table[part, depth]
        pivot = np.sort(column[[0, len(column) // 2, -1]])[1]
        equal = column == pivot
        lower = column < pivot
        for mask, deeper in ((lower, False), (~(lower | equal), False), (equal, True)):
            some = part[mask]
            if not len(some):
                continue
            total = int(weight[some].sum())
            if total < least and not guard[some].any():
                continue
            if not deeper:
                stack.append((some, depth))
            elif pivot != 0:
                if depth >= 1:
                    found.append((int(some[0]), depth + 1, total))
                if depth + 1 < depth_of:
                    stack.append((some, depth + 1))
    return found


def _sort_range(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        held = pa.Table.from_batches(held)
        table = np.stack([held.column(c).to_numpy() for c in COLS], axis=1)
        # Phrases of two words are counted before; here only those that go on are at hand.
        found = [f for f in quicksort_counts(table, held.column("n").to_numpy(), least, keep_ends=True) if f[1] > 2]
        for at in range(0, len(found), 100_000):
            some = found[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([table[r, :d].tolist() for r, d, _ in some], pa.list_(pa.int64())),
                 pa.array([n for _, _, n in some], pa.int64())], ["words", "a"])
    return run


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, key, word, n; totals: lang, n; phrases: words, a) of all frequent words and phrases."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    texts = docs.select("text", lang.alias("lang")).filter("text is not null").withColumn("lang_hash", F.xxhash64("lang"))
    for seed in range(SEEDS):
        counted = stash(texts.mapInArrow(_count_words(seed), "lang string, key long, word string, n long")
                        .groupBy("lang", "key", "word").agg(F.sum("n").alias("n")), "phrase-words")
        clash = counted.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        if clash.isEmpty():
            break
    else:
        raise RuntimeError("no seed tells all words apart")
    totals = stash(counted.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    frequent = counted.filter(F.col("n") >= least)
    known = spark.sparkContext.broadcast(bitmap(frequent, WORD_BITS))
    pairs = stash(texts.mapInArrow(_count_pairs(seed, known), "w1 long, w2 long, n long")
                  .groupBy("w1", "w2").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-pairs")
    good = spark.sparkContext.broadcast(bitmap(pairs.mapInArrow(_pair_keys, "key long"), PAIR_BITS))
    runs = spark.sparkContext.broadcast(run_bitmap(texts, seed, good, least, RUN_BITS))
    layout = ", ".join(f"{c} long" for c in COLS) + ", n long"
    # A frequent suffix comes once from every task that meets it: tasks go with the cores here, not with the text.
    fewer = texts.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    suffixes = stash(fewer.mapInArrow(_suffixes(seed, good, runs), layout), "phrase-suffixes")
    ranges = max(1, -(-suffixes.count() // RANGE_ROWS))
    sorted_out = (suffixes.repartitionByRange(ranges, *COLS).mapInArrow(_sort_range(least), "words array<long>, a long"))
    longer = sorted_out.groupBy("words").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    phrases = stash(pairs.select(F.array("w1", "w2").alias("words"), F.col("n").alias("a")).unionByName(longer), "phrases")
    return frequent, totals, phrases


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases."""
    frequent, totals, phrases = count_phrases(docs, least)
    single = frequent.select(F.array("key").alias("words"), F.col("n").alias("a"))
    counts = single.unionByName(phrases)
    size = F.size("words")
    # Dropped: what lies in a longer candidate with nearly the same count.
    inner = phrases.filter(size > 2).select("a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("k")).select(
        "a", "words", "k", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1)).alias("i")).select(
        F.slice("words", F.col("i"), F.col("k")).alias("words"), "a").groupBy("words").agg(F.max("a").alias("longer"))
    kept = (phrases.join(inner, "words", "left")
            .filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cover) * F.col("a"))).drop("longer"))
    kept = stash(kept, "phrases-kept")
    left = counts.select(F.col("words").alias("first"), F.col("a").alias("l"))
    right = counts.select(F.col("words").alias("rest"), F.col("a").alias("r"))
    cuts = kept.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = cuts.join(left, "first").join(right, "rest").select("words", "a", "k", "l", "r")
    # Words and language of each phrase, by its places.
    places = kept.select("words", F.posexplode("words").alias("at", "key"))
    named = (places.join(frequent.select("key", "lang", "word"), "key").groupBy("words", "lang")
             .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
             .filter(F.size("spelt") == size)
             .select("words", "lang", F.array_join(F.col("spelt.word"), " ").alias("phrase")))
    exact = "cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    scored = (cuts.join(named, "words").join(F.broadcast(totals) if _few(totals) else totals, "lang")
              .withColumn("score", F.expr(exact).cast("long"))
              .groupBy("words", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
              .select("words", "lang", "phrase", "a", "n", "low.l", "low.r", "low.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each of 64 parts of a language, so that no task takes a language whole.
    part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = scored.withColumn("part", F.pmod(F.xxhash64("words"), F.lit(64))).withColumn("at", part).filter(F.col("at") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return best.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _few(totals: DataFrame, most: int = 10_000) -> bool:
    """Whether the languages number at most ``most``."""
    return totals.limit(most + 1).count() <= most
