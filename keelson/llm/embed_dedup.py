"""Operator 10: embedding near-duplicates by int8 tiles with error bounds.

Equal vectors of a label become one class. The classes of a label are dealt
into blocks; each block is one row holding int8 codes, scales and norms of its
unit vectors, and every pair of blocks is one tile, multiplied in one task.
For unit vectors x = s q + e with |e| known exactly, the product of two codes
differs from the cosine by at most |e_x| |y| + |x^| |e_y|. Pairs whose interval
lies above the threshold are links, those below are none, and only the pairs
in between are recomputed in double precision from the vectors themselves.

A tile returns per vector the weighted number of certain links and a spanning
set of them, so its output grows with its rows, not with its pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of different
length never link; repeated rows link like different vectors; a repeated
``vec_id`` has its rows counted as separate vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stash
from keelson.llm.components import connected_components

BLOCK_ROWS = 1024
# Room for rounding in the bounds themselves.
SLACK = 1e-9
_UNSURE, _COUNT, _EDGE = 0, 1, 2


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and exact residual norms of the rows of ``unit``."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pack_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    codes, scale, rest = quantise(_unit(np.stack(rows["embedding"].to_numpy()).astype(np.float64)))
    return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "block": [key[2]], "blocks": [key[3]],
                         "reps": [rows["rep"].to_numpy(np.int64).tobytes()],
                         "copies": [rows["copies"].to_numpy(np.int64).tobytes()], "codes": [codes.tobytes()],
                         "scale": [scale.tobytes()], "rest": [rest.tobytes()]})


def tile_bounds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all cosines between two quantised blocks."""
    (qa, sa, ea), (qb, sb, eb) = a, b
    # Products of int8 codes stay exact in float64, and in float32 for up to 1,000 components.
    kind = np.float32 if qa.shape[1] <= 1000 else np.float64
    near = (qa.astype(kind) @ qb.astype(kind).T).astype(np.float64) * np.outer(sa, sb)
    norm_a = sa * np.linalg.norm(qa.astype(np.float64), axis=1)
    err = np.outer(norm_a, eb) + ea[:, None] * (1.0 + SLACK) + SLACK
    return near - err, near + err


def _tiles(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for t in pdf.itertuples(index=False):
                sides = []
                for s in ("a", "b"):
                    scale = np.frombuffer(getattr(t, f"scale_{s}"))
                    codes = np.frombuffer(getattr(t, f"codes_{s}"), dtype=np.int8).reshape(len(scale), -1)
                    sides.append((codes, scale, np.frombuffer(getattr(t, f"rest_{s}"))))
                ra, rb = (np.frombuffer(x, dtype=np.int64) for x in (t.reps_a, t.reps_b))
                ca, cb = (np.frombuffer(x, dtype=np.int64) for x in (t.copies_a, t.copies_b))
                low, high = tile_bounds(*sides)
                sure, maybe = low >= threshold, high >= threshold
                if t.i == t.j:
                    maybe = np.triu(maybe, 1)
                    sure &= ~np.eye(len(ra), dtype=bool)
                out = []
                x, y = np.nonzero(maybe & ~sure)
                out.append(pd.DataFrame({"kind": _UNSURE, "a": ra[x], "b": rb[y], "n": ca[x], "m": cb[y]}))
                n = sure @ cb
                out.append(pd.DataFrame({"kind": _COUNT, "a": ra, "b": ra, "n": n, "m": 0})[n > 0])
                if t.i != t.j:
                    n = ca @ sure
                    out.append(pd.DataFrame({"kind": _COUNT, "a": rb, "b": rb, "n": n, "m": 0})[n > 0])
                x, y = _spanning(sure, t.i == t.j)
                out.append(pd.DataFrame({"kind": _EDGE, "a": ra[x], "b": rb[y], "n": 0, "m": 0}))
                yield pd.concat(out)
    return run


def _spanning(links: np.ndarray, square: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that connect whatever ``links`` connects, few of them."""
    n = links.shape[0]
    root = np.arange(n + (0 if square else links.shape[1]))

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    x, y, off = [], [], 0 if square else n
    for r in np.flatnonzero(links.any(axis=1)):
        here = find(int(r))
        for c in np.flatnonzero(links[r]):
            there = find(int(c) + off)
            if there != here:
                root[there] = here
                x.append(r)
                y.append(c)
    return np.array(x, dtype=np.int64), np.array(y, dtype=np.int64)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite
                        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    # The digest of the vector's exact text names its class.
    rows = rows.withColumn("__class", F.when(usable, F.sha2(F.concat_ws(",", F.col("embedding").cast("array<string>")), 256)))
    classes = (rows.filter("__class is not null").groupBy("label", "__class")
               .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"),
                    F.min("embedding").alias("embedding")))
    classes = stash(classes.withColumn("rep", F.monotonically_increasing_id())
                    .withColumn("dim", F.size("embedding")), "emb-classes")
    per = stash(classes.groupBy("label", "dim").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks")), "emb-labels")
    dealt = classes.join(per, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("__class"), "blocks").cast("int"))
    label_type = vectors.schema["label"].dataType.simpleString()
    blocks = stash(dealt.select("label", "dim", "block", "blocks", "rep", "copies", "embedding")
                   .groupBy("label", "dim", "block", "blocks")
                   .applyInPandas(_pack_block, f"label {label_type}, dim int, block int, blocks int, reps binary, "
                                               "copies binary, codes binary, scale binary, rest binary"), "emb-blocks")
    parts = ["reps", "copies", "codes", "scale", "rest"]
    left = blocks.select("label", "dim", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"),
                         *[F.col(c).alias(f"{c}_a") for c in parts])
    right = blocks.select("label", "dim", F.col("block").alias("j"), F.explode(F.sequence(F.lit(0), "block")).alias("i"),
                          *[F.col(c).alias(f"{c}_b") for c in parts])
    tiles = left.join(right, ["label", "dim", "i", "j"])
    found = stash(tiles.select("i", "j", *[f"{c}_{s}" for c in parts for s in "ab"])
                  .mapInPandas(_tiles(threshold), "kind int, a long, b long, n long, m long"), "emb-tiles")

    vec = classes.select("rep", "embedding")
    unsure = (found.filter(F.col("kind") == _UNSURE)
              .join(vec.select(F.col("rep").alias("a"), F.col("embedding").alias("x")), "a")
              .join(vec.select(F.col("rep").alias("b"), F.col("embedding").alias("y")), "b"))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    exact = stash(unsure.filter(dot("x", "y") / F.sqrt(dot("x", "x")) / F.sqrt(dot("y", "y")) >= threshold)
                  .select("a", "b", "n", "m"), "emb-exact")
    links = (found.filter(F.col("kind") == _COUNT).select("a", "n")
             .unionByName(exact.select("a", F.col("m").alias("n")))
             .unionByName(exact.select(F.col("b").alias("a"), "n"))
             .groupBy("a").agg(F.sum("n").alias("n")))
    roots = connected_components(found.filter(F.col("kind") == _EDGE).select("a", "b").unionByName(exact.select("a", "b")))
    named = (classes.select("rep", "label", "__class", "first", "copies")
             .join(links.withColumnRenamed("a", "rep"), "rep", "left")
             .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")))
    named = stash(named, "emb-named")
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    member = stash(named.join(lowest, "component").select(
        F.col("label").alias("__l"), F.col("__class").alias("__c"), "component_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "emb-member")
    some = rows.filter("__class is not null").join(
        member, (F.col("label") == F.col("__l")) & (F.col("__class") == F.col("__c")), "left")
    none = rows.filter("__class is null").withColumns({"n_links": F.lit(0).cast("bigint"),
                                                       "component_id": F.col("vec_id").cast("bigint")})
    cols = ["vec_id", "n_links", "component_id"]
    return (some.select(cols).unionByName(none.select(cols))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
