"""Operator 3: MinHash near-duplicates by a signature-coordinate inverted join.

Documents with equal shingle sets become one class. A class has one minimum
per hash function; it is posted under each (coordinate, value) pair. Values
that only one class has cannot collide. The others are ordered by frequency,
rarest first: two classes that agree in at least ``MATCHES`` of ``COORDS``
coordinates share one of the first ``COORDS - MATCHES + 1`` of each (values of
one class included), so only that prefix is kept in the lists. Pairs from the
lists have their collisions counted over both whole signatures, and those above the
threshold are confirmed on the documents' full shingle sets.

Lists are merged with skipping: a member that already is in a component with
another need not meet it. First, list blocks of bounded size pair every
member with the block's hub and with its successor; confirmed links merge components.
Then, in the lists that still hold several components, the members outside the
largest one are held against all others in tiles, and each offers the partner
of another component with which it collides most. Once such a round confirms
little, every pair across components that collides often enough is tested on
the full sets inside the tiles, which return links only: no pair is left
untested, and a group of copies never expands into all its pairs. A pair counts
only in the first list that both prefixes share.

Defined results: a null text, or one without words, has an empty set, links
with nothing and is kept; a text of fewer words than a shingle is one shingle;
repeated rows and ids are members of the class like others; null ids join a class but
do not name it. Only ``doc_id`` and ``text`` are read; other columns are carried
by ``drop_duplicates`` as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import mix64, row_chunks, shingle_hashes, span_hashes, stash, text_buffers, word_spans
from keelson.llm.components import connected_components

COORDS = 64
# At similarity 0.8 fewer than 36 of 64 coordinates agree with a probability of 1e-5.
MATCHES = 36
BLOCK = 128
MAX_ROUNDS = 8
TILE = 512
# When a round confirms less than this share of its pairs, few members of the
# open lists belong together, and all remaining pairs are tried.
LEAST_YIELD = 0.05
# Sets of at most this many shingles are named by their words as well.
SMALL_SET = 8

_LIST = ["coord", "value"]

_SEEDS = mix64(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MUL, _ADD = _SEEDS[:COORDS] | np.uint64(1), _SEEDS[COORDS:]


def _order(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Order of (row, hash) pairs, by one sort on the row and the hash's upper bits where these tell all apart."""
    bits = max(1, int(rows).bit_length())
    key = (row.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits))
    order = np.argsort(key)
    key, h = key[order], hashes[order]
    if ((key[1:] == key[:-1]) & (h[1:] != h[:-1])).any():
        return np.lexsort((hashes, row))
    return order


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every distinct shingle of each row, in order, and a second hash of each row's words."""
    starts, ends, bounds = word_spans(raw, offsets)
    words = span_hashes(raw, starts, ends)
    hashes, at = shingle_hashes(words, bounds, n)
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(at))
    order = _order(row, hashes, rows)
    row, hashes = row[order], hashes[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    place = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
    mixed = mix64(words + mix64(place.astype(np.uint64) + np.uint64(0x5EED)))
    text = np.zeros(rows, dtype=np.uint64)
    full = np.diff(bounds) > 0
    if full.any():
        text[full] = np.add.reduceat(mixed, bounds[:-1][full])
    return row[fresh], hashes[fresh], text


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The minima of ``COORDS`` hash functions per non-empty row, as int32."""
    out = np.empty((len(bounds) - 1, COORDS), dtype=np.int32)
    if len(bounds) == 1:
        return out
    for k in range(COORDS):
        low = np.minimum.reduceat(hashes * _MUL[k] + _ADD[k], bounds[:-1])
        out[:, k] = (low >> np.uint64(16)).astype(np.uint32).view(np.int32)
    return out


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            for lo, hi in row_chunks(offsets):
                rows = hi - lo
                row, hashes, words = shingle_sets(raw, offsets[lo:hi + 1], n)
                bounds = np.searchsorted(row, np.arange(rows + 1))
                count = np.diff(bounds)
                full = count > 0
                packed = np.concatenate([bounds[:-1][full], bounds[-1:]])
                sig = signatures(hashes, packed)
                # Order-free sums of two independent hashes name the set.
                name = np.zeros((rows, 2), dtype=np.uint64)
                for k, salt in enumerate((np.uint64(0xA5), np.uint64(0x5A5A))):
                    if full.any():
                        name[full, k] = np.add.reduceat(mix64(hashes ^ salt), packed[:-1])
                # A small set is named by its words as well: one clash of shingle hashes must not join texts.
                # Equal sets of other texts then are two classes with a similarity of 1, which link like any two.
                small = full & (count <= SMALL_SET)
                name[small, 1] = mix64(name[small, 1] ^ words[small])
                at = np.concatenate([[0], np.cumsum(np.where(full, COORDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, rows), batch.column("text_hash").slice(lo, rows), pa.array(count.astype(np.int64)),
                     pa.array(name[:, 0].view(np.int64)), pa.array(name[:, 1].view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(sig.ravel()))],
                    ["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "sig"])
    return run


def _confirm(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            (raw_a, off_a), (raw_b, off_b) = (text_buffers(batch.column(c)) for c in ("text_a", "text_b"))
            for lo, hi in row_chunks(off_a + off_b):
                left, h_left, _ = shingle_sets(raw_a, off_a[lo:hi + 1], n)
                right, h_right, _ = shingle_sets(raw_b, off_b[lo:hi + 1], n)
                row, h = np.concatenate([left, right]), np.concatenate([h_left, h_right])
                order = _order(row, h, hi - lo)
                row, h = row[order], h[order]
                twice = row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])]
                count = lambda rows: np.bincount(rows, minlength=hi - lo)  # noqa: B023, E731
                both = count(twice)
                keep[lo:hi] = 100 * both >= percent * (count(left) + count(right) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))
    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash, kept`` for every row of ``docs``."""
    docs = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = stash(docs.mapInArrow(_sketch(shingle), f"doc_id {id_type}, text_hash long, n_shingles long, set_a long, set_b long, "
                                                   "sig array<int>"), "minhash-rows")
    classes = stash(rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles")
                    .agg(F.min(F.struct("doc_id", "text_hash")).alias("r"), F.first("sig").alias("sig"))
                    .select("set_a", "set_b", "n_shingles", F.xxhash64("set_a", "set_b", "n_shingles").alias("rep"),
                            "r.doc_id", "r.text_hash", "sig"), "minhash-classes")
    links = _links(docs, classes, shingle, percent)
    named = stash(classes.select("set_a", "set_b", "n_shingles", "rep", "doc_id").join(
        links.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")), "minhash-named")
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    member = stash(named.join(lowest, "component").select(
        F.col("set_a").alias("__a"), F.col("set_b").alias("__b"), F.col("n_shingles").alias("__n"), "component_id"), "minhash-member")
    some = rows.filter("n_shingles > 0").join(
        member, (F.col("set_a") == F.col("__a")) & (F.col("set_b") == F.col("__b")) & (F.col("n_shingles") == F.col("__n")), "left")
    out = some.select("doc_id", "n_shingles", "component_id", "text_hash").unionByName(
        rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates; documents without words all stay.

    Of kept rows that share an id (repeated rows), the one with the smallest text hash stays.
    """
    found = stash(near_duplicates(docs, shingle, percent).select("doc_id", "n_shingles", "text_hash", "kept"), "minhash-found")
    out = found.filter("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    # The documents' own columns travel as one, whatever their names.
    hashed = docs.select("doc_id", F.xxhash64("text").alias("__text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    rest = hashed.join(out, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_anti")
    repeated = stash(found.filter("kept and n_shingles > 0 and doc_id is not null").groupBy("doc_id")
                     .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("__id")), "minhash-repeated")
    if repeated.isEmpty():
        return rest.select("__row.*")
    again = F.col("doc_id") == F.col("__id")
    once = (rest.join(repeated, again, "left_semi").groupBy("doc_id")
            .agg(F.min(F.struct("__text", "__row")).alias("r")).select("r.__row.*"))
    return rest.join(repeated, again, "left_anti").select("__row.*").unionByName(once)


def _links(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Components (``node, component``) of the classes' confirmed links."""
    posts = classes.select("rep", F.posexplode("sig").alias("coord", "value"))
    shared = stash(posts.groupBy("coord", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "minhash-shared")
    ranked = (posts.join(shared, ["coord", "value"]).groupBy("rep")
              .agg(F.sort_array(F.collect_list(F.struct("n", "coord", "value"))).alias("p"))
              .filter(F.size("p") >= MATCHES))
    # Values of one class come first in the order; they fill the prefix from the left.
    prefix = stash(ranked.select("rep", F.slice("p", F.lit(1), F.size("p") - MATCHES + 1).alias("p")), "minhash-prefix")
    lists = prefix.select("rep", F.explode("p").alias("p")).select("rep", "p.coord", "p.value")
    mask = F.aggregate("p", F.lit(0).cast("bigint"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x.coord)))
    alive = stash(classes.select("rep", "doc_id", "text_hash", "sig").join(
        prefix.select("rep", mask.alias("mask")), "rep"), "minhash-alive")
    # One text per class, that of the row which names it.
    own = alive.select("rep", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    texts = stash(docs.join(own, (F.col("doc_id") == F.col("__id")) & (F.col("text_hash") == F.col("__hash")))
                  .groupBy("doc_id", "text_hash", "rep").agg(F.first("text").alias("text")).select("rep", "text"), "minhash-texts")
    alive = alive.select("rep", "sig", "mask")

    label = prefix.select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    edges, yield_, state = None, 1.0, stash(lists.withColumn("comp", F.col("rep")), "minhash-state")
    for turn in range(MAX_ROUNDS + 1):
        # Lists whose members all are in one component are done.
        sizes = state.groupBy(*_LIST, "comp").agg(F.count(F.lit(1)).alias("c"))
        open_ = stash(sizes.groupBy(*_LIST).agg(
            F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("m"), F.count(F.lit(1)).alias("k")).filter("k > 1")
            .select(*_LIST, "all", (F.col("all") - F.col("m.c")).alias("few"), F.col("m.comp").alias("largest")), "minhash-open")
        if open_.isEmpty():
            break
        members = state.join(open_, _LIST)
        last = turn == MAX_ROUNDS or yield_ < LEAST_YIELD
        if last:
            found = _remaining(members, alive, texts, shingle, percent)
            edges = stash(edges.unionByName(found), "minhash-edges")
            break
        pairs = stash(_by_hub(members, turn) if turn == 0 else _best_partners(members, alive), "minhash-pairs")
        found = _verify(pairs, alive, texts, shingle, percent)
        edges = found if edges is None else stash(edges.unionByName(found), "minhash-edges")
        yield_ = found.count() / max(1, pairs.count())
        label = connected_components(edges)
        state = stash(state.drop("comp").join(label.withColumnRenamed("node", "rep"), "rep", "left")
                      .withColumn("comp", F.coalesce("component", "rep")).drop("component"), "minhash-state")
    if edges is None:
        return label
    return connected_components(edges)


def _by_hub(members: DataFrame, turn: int) -> DataFrame:
    """In blocks of bounded size: each member with the block's hub and its successor."""
    blocks = F.ceil(F.col("all") / F.lit(BLOCK)).cast("int")
    dealt = (members.withColumn("order", F.xxhash64(F.lit(turn), "rep"))
             .withColumn("block", F.pmod(F.xxhash64(F.lit(-1 - turn), "rep"), blocks)))
    within = Window.partitionBy(*_LIST, "block").orderBy("order", "rep")
    near = dealt.select("rep", "comp",
                        F.first(F.struct("rep", "comp")).over(within).alias("hub"),
                        F.lead(F.struct("rep", "comp")).over(within).alias("next"))
    pairs = near.select(F.col("rep").alias("x"), F.col("comp").alias("cx"), F.explode(F.array("hub", "next")).alias("o"))
    return pairs.filter("o is not null and o.comp <> cx").select(
        F.least("x", "o.rep").alias("a"), F.greatest("x", "o.rep").alias("b")).distinct()


def _members(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.StructArray]:
    """Class, component, prefix mask and signature of a block's members, and the block."""
    rows = column.slice(i, 1).flatten()
    get = lambda k: rows.field(k).to_numpy(zero_copy_only=False)
    return get(0), get(1), get(2).view(np.uint64), rows.field(3).flatten().to_numpy().reshape(len(rows), COORDS), rows


def collisions(coord: int, left: tuple, right: tuple) -> np.ndarray:
    """Collisions of each pair that belongs to this list, reaches the threshold and joins two components; else 0."""
    (_, ca, ma, sa, _), (_, cb, mb, sb, _) = left, right
    hits = np.zeros((len(ca), len(cb)), dtype=np.int16)
    earlier = np.zeros((len(ca), len(cb)), dtype=bool)
    for k in range(COORDS):
        same = sa[:, k][:, None] == sb[:, k][None, :]
        hits += same
        if k < coord:
            bit = np.uint64(1 << k)
            earlier |= same & ((ma & bit) > 0)[:, None] & ((mb & bit) > 0)[None, :]
    hits[earlier | (ca[:, None] == cb[None, :]) | (hits < MATCHES)] = 0
    return hits


def _each_tile(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple, tuple, np.ndarray]]:
    coord = batch.column("coord").to_numpy()
    for i in range(batch.num_rows):
        left, right = (_members(batch.column(c), i) for c in ("few_members", "all_members"))
        yield i, left, right, collisions(int(coord[i]), left, right)


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, left, right, hits in _each_tile(batch):
            x = np.flatnonzero(hits.any(axis=1))
            y = hits[x].argmax(axis=1)
            a.append(np.minimum(left[0][x], right[0][y]))
            b.append(np.maximum(left[0][x], right[0][y]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _contested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with a partner to test, once per tile and side."""
    for batch in batches:
        row, rep, few = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for i, left, right, hits in _each_tile(batch):
            for side, axis in ((left, 1), (right, 0)):
                found = side[0][hits.any(axis=axis)]
                row.append(np.full(len(found), i))
                rep.append(found)
                few.append(np.full(len(found), axis == 1))
        row = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_arrays(
            [batch.column("coord").take(row), batch.column("value").take(row), pa.array(np.concatenate(rep)),
             pa.array(np.concatenate(few))], ["coord", "value", "rep", "few"])


def intersections(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Sizes of the intersections of all sets of one side with all of the other."""
    (va, na), (vb, nb) = ((x.flatten().to_numpy(), np.diff(x.offsets.to_numpy())) for x in (left, right))
    shared = np.intersect1d(va, vb)
    out = np.zeros((len(na), len(nb)), dtype=np.float64)
    (ra, ia), (rb, ib) = (_places(v, n, shared) for v, n in ((va, na), (vb, nb)))
    width = 4096
    for lo in range(0, len(shared), width):
        dense = []
        for r, i, n in ((ra, ia, len(na)), (rb, ib, len(nb))):
            at = (i >= lo) & (i < lo + width)
            m = np.zeros((n, width), dtype=np.float32)
            m[r[at], i[at] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _places(values: np.ndarray, counts: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(shared):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
    there = shared[at] == values
    return np.repeat(np.arange(len(counts)), counts)[there], at[there]


def _exact_tiles(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, left, right, hits in _each_tile(batch):
                if not hits.any():
                    continue
                sets = left[4].field(4), right[4].field(4)
                na, nb = (np.diff(s.offsets.to_numpy()) for s in sets)
                both = intersections(*sets)
                x, y = np.nonzero((hits > 0) & (100 * both >= percent * (na[:, None] + nb[None, :] - both)))
                a.append(np.minimum(left[0][x], right[0][y]))
                b.append(np.maximum(left[0][x], right[0][y]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
    return run


def _full_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            for i in range(batch.num_rows):
                keys = np.sort(shingle_sets(raw, offsets[i:i + 2], n)[1].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys))],
                    ["rep", "shingles"])
    return run


def _tiles(few: DataFrame, every: DataFrame, columns: list[str], weight: str) -> DataFrame:
    """Blocks of the members outside a list's largest component against blocks of all.

    A block holds about ``TILE`` units of ``weight``, of which the list's sums
    are in ``few_<weight>`` and ``all_<weight>``.
    """
    def blocks(rows: DataFrame, total: str, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("rep"), F.ceil(F.col(total) / F.lit(TILE)).cast("int"))
        return (rows.groupBy(*_LIST, block.alias("block")).agg(F.collect_list(F.struct(*columns)).alias(name)).drop("block"))
    return blocks(few, f"few_{weight}", "few_members").join(blocks(every, f"all_{weight}", "all_members"), _LIST).select(
        *_LIST, "few_members", "all_members")


_MEMBER = ["rep", "comp", "mask", "sig"]


def _sig_tiles(members: DataFrame, alive: DataFrame) -> DataFrame:
    full = stash(members.join(alive, "rep").withColumnsRenamed({"few": "few_rows", "all": "all_rows"}), "minhash-members")
    return _tiles(full.filter("comp <> largest"), full, _MEMBER, "rows")


def _best_partners(members: DataFrame, alive: DataFrame) -> DataFrame:
    """For each member outside its list's largest component the partner it collides with most, per tile."""
    return _sig_tiles(members, alive).mapInArrow(_best, "a long, b long").distinct()


def _remaining(members: DataFrame, alive: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links among all pairs across components that collide often enough."""
    to_test = stash(_sig_tiles(members, alive).mapInArrow(_contested, "coord int, value int, rep long, few boolean").distinct(),
                    "minhash-contested")
    sets = stash(texts.join(to_test.select("rep").distinct(), "rep", "left_semi")
                 .mapInArrow(_full_sets(shingle), "rep long, shingles array<long>"), "minhash-sets")
    # A long set counts as several members, so that tiles stay bounded.
    heavy = F.ceil(F.size("shingles") / F.lit(1000)).cast("bigint")
    full = (to_test.join(members.select(*_LIST, "rep", "comp"), [*_LIST, "rep"])
            .join(alive, "rep").join(sets, "rep").withColumn("w", heavy))
    full = stash(full, "minhash-heavy")
    sums = stash(full.groupBy(*_LIST).agg(F.sum(F.when(F.col("few"), F.col("w")).otherwise(0)).alias("few_w"),
                                          F.sum(F.when(~F.col("few"), F.col("w")).otherwise(0)).alias("all_w")), "minhash-weights")
    full = full.join(sums, _LIST)
    tiles = _tiles(full.filter("few"), full.filter("not few"), [*_MEMBER, "shingles"], "w")
    return stash(tiles.mapInArrow(_exact_tiles(percent), "a long, b long").distinct(), "minhash-links")


def _verify(pairs: DataFrame, alive: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs with enough collisions whose full sets are similar enough."""
    sig = lambda s: alive.select(F.col("rep").alias(s), F.col("sig").alias(f"sig_{s}"))
    same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    hits = stash(pairs.join(sig("a"), "a").join(sig("b"), "b")
                 .filter(same >= MATCHES).select("a", "b"), "minhash-hits")
    text = lambda s: texts.select(F.col("rep").alias(s), F.col("text").alias(f"text_{s}"))
    both = hits.join(text("b"), "b").join(text("a"), "a").select("a", "b", "text_a", "text_b")
    return stash(both.mapInArrow(_confirm(shingle, percent), "a long, b long"), "minhash-links")
