"""Operator 4: best-fit packing by a grouping genetic algorithm on islands.

Texts become token ids in Arrow batches; only the pieces' lengths and digests
go on. Pieces of full length are sequences of their own. The others are dealt
into shards of bounded size; every shard evolves on several islands, and
between epochs each island receives its neighbour's elite. A crossover injects
whole well-filled bins of one parent into the other, removes the bins that
hold an injected piece a second time, and puts the displaced pieces back by
best fit. Bins that a shard leaves poorly filled are opened again, and their
pieces are packed together on the next level, until one shard holds them.

Defined results: a null text is empty and gives one piece, the end token;
repeated rows and null ids are packed as rows of their own; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stash

END_TOKEN = 0
SHARD_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 3
# Bins filled below this share are opened again on the next level.
WELL_FILLED = 0.995
# Words kept per task, with their ids.
CACHE_WORDS = 300_000

# The byte-level pre-tokeniser's pattern (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space other than blank and line feed.
_OTHER_SPACE = [chr(c) for c in (0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680,
                                 *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
# Below this code point the character classes of all Unicode versions agree.
_SETTLED = "\u0250"


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder(dict):
    """Token ids (little-endian unsigned 32-bit) of words, cached; and of texts.

    A text may be cut before a blank, and around a line feed, that stands
    between two other characters: no token of the pattern spans such a place.
    Words of settled characters go to the fast BPE with the vocabulary's own
    merge ranks; all else goes to the vocabulary's own tokeniser.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()
                 if all(c in byte for c in token)}
        ranks = {k: v for k, v in ranks.items() if not k.startswith(b"<|endoftext")}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.whole = path, None
        self.line_feed = self._encode("\n")

    def _encode(self, text: str) -> bytes:
        if not text:
            return b""
        if max(text) < _SETTLED:
            ids = self.fast.encode_ordinary(text)
        else:
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.path)
                self.whole.encode_special_tokens = True
            ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = self._encode(" " + word)
        return out

    def encode(self, text: str) -> bytes:
        if ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in " \n"
                or text[-1:] in " \n" or any(c in text for c in _OTHER_SPACE)):
            return self._encode(text)
        lines = []
        for line in text.split("\n"):
            first, *words = line.split(" ")
            lines.append(b"".join([self._encode(first), *map(self.__getitem__, words)]))
        return self.line_feed.join(lines)


def _pieces(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(path)
            row, piece, start, size, crc = [], [], [], [], []
            for i in range(batch.num_rows):
                ids = encoder.encode(batch.column(1)[i].as_py() or "") + END_TOKEN.to_bytes(4, "little")
                n = len(ids) // 4
                at, end = 0, n % length or length
                for k in range(-(-n // length)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    size.append(end - at)
                    crc.append(zlib.crc32(ids[4 * at:4 * end]))
                    at, end = end, end + length
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str, length: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer, length), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


# --- the genetic algorithm on one island ------------------------------------

def best_fit(sizes: np.ndarray, order, bins: np.ndarray, free: list[int], capacity: int) -> None:
    """Put the items of ``order`` into the fullest bin that takes them.

    ``bins`` and ``free`` are changed. Bins are kept by free space; a bit mask
    names the spaces in use, so finding the best one is one shift.
    """
    by_free: dict[int, list[int]] = {}
    mask = 0
    for b, f in enumerate(free):
        by_free.setdefault(f, []).append(b)
        mask |= 1 << f
    for item in order:
        size = int(sizes[item])
        above = mask >> size
        if above:
            space = (above & -above).bit_length() - 1 + size
            stack = by_free[space]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << space)
        else:
            space, b = capacity, len(free)
            free.append(capacity)
        left = space - size
        free[b] = left
        by_free.setdefault(left, []).append(b)
        mask |= 1 << left
        bins[item] = b


def _renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the sum of squared fills."""
    fill = np.bincount(bins, weights=sizes) / capacity
    return -len(fill), float((fill * fill).sum())


def construct(sizes: np.ndarray, capacity: int, noise: float, rng: np.random.Generator) -> np.ndarray:
    """Best fit in decreasing order, the order disturbed by ``noise``."""
    keys = sizes * (1.0 + noise * rng.standard_normal(len(sizes))) if noise else sizes
    bins = np.empty(len(sizes), dtype=np.int64)
    best_fit(sizes, np.argsort(-keys, kind="stable").tolist(), bins, [], capacity)
    return bins


def crossover(sizes: np.ndarray, base: np.ndarray, donor: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """``base`` with whole well-filled bins of ``donor`` injected."""
    fill = np.bincount(donor, weights=sizes)
    # Binary tournaments for the fuller bin choose a tenth of the donor's bins.
    tries = rng.integers(0, len(fill), size=(max(1, len(fill) // 10), 2))
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[np.where(fill[tries[:, 0]] >= fill[tries[:, 1]], tries[:, 0], tries[:, 1])] = True
    injected = chosen[donor]
    hit = np.zeros(int(base.max()) + 1, dtype=bool)
    hit[base[injected]] = True
    # The worst-filled bins of the base are opened as well.
    worst = np.argsort(np.bincount(base, weights=sizes), kind="stable")[:max(1, len(hit) // 50)]
    hit[worst] = True
    displaced = hit[base] & ~injected
    child = np.where(injected, donor + len(hit), base)
    kept = ~displaced
    child[kept] = _renumber(child[kept])
    free = (capacity - np.bincount(child[kept], weights=sizes[kept]).astype(np.int64)).tolist() if kept.any() else []
    items = np.flatnonzero(displaced)
    best_fit(sizes, items[np.argsort(-sizes[items], kind="stable")].tolist(), child, free, capacity)
    return _renumber(child)


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, generations: int,
           rng: np.random.Generator) -> np.ndarray:
    """The best individual after ``generations`` of crossover."""
    bound = -(-int(sizes.sum()) // capacity)
    scored = sorted(((fitness(sizes, p, capacity), k, p) for k, p in enumerate(population)), key=lambda t: t[:2], reverse=True)
    for g in range(generations):
        if -scored[0][0][0] <= bound:
            break
        a, b = rng.permutation(len(scored))[:2] if len(scored) > 1 else (0, 0)
        child = crossover(sizes, scored[min(a, b)][2], scored[max(a, b)][2], capacity, rng)
        score = fitness(sizes, child, capacity)
        if score > scored[-1][0]:
            scored[-1] = (score, len(population) + g, child)
            scored.sort(key=lambda t: t[:2], reverse=True)
    return scored[0][2]


def _epoch(level: int, epoch: int, capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, island = (int(k) for k in key)
        rows = rows.sort_values("uid")
        sizes = rows["length"].to_numpy()
        rng = np.random.default_rng([level, epoch, shard, island])
        if epoch == 0:
            population = [construct(sizes, capacity, 0.0 if island == 0 and k == 0 else 0.05 * (k + island), rng)
                          for k in range(POPULATION)]
        else:
            population = [_renumber(rows["own"].to_numpy()), _renumber(rows["elite"].to_numpy()),
                          construct(sizes, capacity, 0.02, rng)]
        bins = evolve(sizes, population, capacity, GENERATIONS, rng)
        return pd.DataFrame({"shard": shard, "uid": rows["uid"].to_numpy(), "length": sizes, "island": island, "bin": bins})
    return run


def _reopened(bins: np.ndarray, fill: np.ndarray, capacity: int) -> np.ndarray:
    """Pieces of the bins that the next level packs again: the worst-filled ones, with at most half of the pieces.

    So every level has at most half of the pieces of the one before it, and levels go on until one shard is left.
    """
    worst = np.argsort(fill, kind="stable")
    pieces = np.bincount(bins, minlength=len(fill))[worst]
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[worst[np.cumsum(pieces) <= len(bins) // 2]] = True
    return (chosen & (fill < WELL_FILLED * capacity))[bins]


def _finish(level: int, capacity: int, last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        sizes = rows["length"].to_numpy()
        options = [np.array(x) for x in np.stack(rows["bins"].to_numpy()).T]
        bins = _renumber(max(options, key=lambda b: fitness(sizes, _renumber(b), capacity)))
        fill = np.bincount(bins, weights=sizes)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        offset = np.empty(len(sizes), dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(fill)[:-1]]).astype(np.int64)
        offset[order] = before - first[bins[order]]
        return pd.DataFrame({"uid": rows["uid"].to_numpy(), "length": sizes, "offset": offset,
                             "sequence_id": (level << 56) + (int(key[0]) << 24) + bins,
                             "open": False if last else _reopened(bins, fill, capacity)})
    return run


def _pack_level(items: DataFrame, count: int, level: int, capacity: int, last: bool) -> DataFrame:
    shards = -(-count // SHARD_PIECES)
    dealt = items.select(F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(shards)).cast("int").alias("shard"), "uid", "length")
    islands = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))
    schema = "shard int, uid long, length long, island int, bin long"
    state = dealt.withColumn("island", islands).groupBy("shard", "island").applyInPandas(_epoch(level, 0, capacity), schema)
    gather = [F.max(F.when(F.col("island") == i, F.col("bin"))).alias(f"b{i}") for i in range(ISLANDS)]
    for epoch in range(1, EPOCHS):
        wide = state.groupBy("shard", "uid", "length").agg(*gather)
        # Each island gets the elite of the one before it.
        moved = F.explode(F.array(*[F.struct(F.lit(i).alias("island"), F.col(f"b{i}").alias("own"),
                                             F.col(f"b{(i - 1) % ISLANDS}").alias("elite")) for i in range(ISLANDS)]))
        state = (wide.select("shard", "uid", "length", moved.alias("m")).select("shard", "uid", "length", "m.*")
                 .groupBy("shard", "island").applyInPandas(_epoch(level, epoch, capacity), schema))
    wide = state.groupBy("shard", "uid", "length").agg(*gather)
    return wide.select("shard", "uid", "length", F.array(*[f"b{i}" for i in range(ISLANDS)]).alias("bins")).groupBy("shard").applyInPandas(
        _finish(level, capacity, last), "uid long, length long, offset long, sequence_id long, open boolean")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    pieces = stash(token_pieces(docs, tokenizer, length), "pack-pieces").withColumn("__uid", F.monotonically_increasing_id())
    pieces = stash(pieces, "pack-uids")
    items = pieces.filter(F.col("length") < length).select(F.col("__uid").alias("uid"), "length")
    count, level, placed = items.count(), 0, None
    while count:
        last = count <= SHARD_PIECES
        packed = stash(_pack_level(items, count, level, length, last), "pack-level")
        items = packed.filter("open").select("uid", "length")
        settled = packed.filter("not open").select(F.col("uid").alias("__uid"), "sequence_id", "offset")
        placed = settled if placed is None else placed.unionByName(settled)
        count = 0 if last else items.count()
        level += 1
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.filter(F.col("length") == length).withColumns({
        "sequence_id": F.col("__uid") + F.lit(1 << 62), "offset": F.lit(0).cast("bigint")}).select(out)
    if placed is None:
        return full
    return pieces.filter(F.col("length") < length).join(placed, "__uid").select(out).unionByName(full)
