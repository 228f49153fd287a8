import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import whitening
from keelson.llm.common import read
from tests.conftest import SF_ORACLE


def brute(rows, components=16):
    """Covariance of the distinct integer vectors by numpy, in exact integers first."""
    x = {i: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for i, v in rows.items()}
    fit = np.array(sorted(set(x.values())), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums).astype(float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    white = {i: ((n * np.array(v) - sums) / n @ vectors) / np.sqrt(values) for i, v in x.items()}
    return n, values, values / (y * y).sum() * n, deviation, white


def check(got, rows, components=16):
    n, values, explained, deviation, white = brute(rows, components)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_id) == set(rows) and len(got) == len(rows) * len(values)
    mine = np.array([[by_id[i][k + 1].whitened for k in range(len(values))] for i in rows])
    theirs = np.array([white[i] for i in rows])
    sign = np.sign((mine * theirs).sum(axis=0))
    assert np.abs(mine - theirs * sign).max() < 1e-6
    for r in got:
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and 0 <= r.identity_error < 1e-9


def test_whitening_equals_numpy_on_the_whole_table(spark):
    table = read(spark, SF_ORACLE, "embeddings")
    rows = {r.vec_id: r.embedding for r in table.collect()
            if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)}
    check(whitening.whiten(table.repartition(5)).collect(), rows)


def test_tree_of_many_spectra(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = {i: (rng.normal(size=7) * [9, 5, 3, 2, 1, 1, 0.5]).astype(np.float32).tolist() for i in range(300)}
    table = spark.createDataFrame([(i, v) for i, v in rows.items()], "vec_id long, embedding array<float>")
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 5)
    # One spectrum a partition: adaptive execution would join so few rows.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(whitening.whiten(table).collect(), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("d", [1, 2, 5, 24])
def test_rank_one_updates_equal_eigh(d):
    rng = np.random.default_rng(d)
    values, vectors, full = np.zeros(d), np.eye(d), np.zeros((d, d))
    for k in range(60):
        y = rng.normal(size=d) * 10.0 ** rng.integers(-6, 4)
        if k % 5 == 1:
            y = np.zeros(d) if k % 10 == 1 else vectors[:, -1] * 3       # nothing, or along a known direction
        if k % 7 == 2:
            y = np.where(rng.random(d) < 0.7, 0.0, y)                    # most components deflate
        values, vectors = whitening.rank_one(values, vectors, y)
        full = full + np.outer(y, y)
        want = np.linalg.eigvalsh(full)
        assert np.all(np.diff(values) >= 0)
        assert np.abs(values - want).max() <= 1e-12 * max(want.max(), 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-11
        assert np.abs(vectors * values @ vectors.T - full).max() <= 1e-11 * max(np.abs(full).max(), 1e-300)


def test_blocks_and_merges_give_one_scatter():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 900, (777, 6)) + 1_000_000
    x[:, 5] = x[:, 0]                                                     # a direction without spread
    state = {"n": 0}
    for part in np.array_split(x, [1, 3, 9, 300]):
        state = whitening.add_block(state, part)
    halves = [whitening.add_block({"n": 0}, h) for h in (x[:500], x[500:])]
    y = x - x.mean(axis=0)
    for s in (state, whitening.merge(*halves), whitening.merge(halves[1], halves[0])):
        assert s["n"] == 777 and (s["sums"] == x.sum(axis=0)).all()
        assert np.allclose(s["vectors"] * s["values"] @ s["vectors"].T, y.T @ y, rtol=1e-10, atol=1e-6)


def test_whitening_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = {0: [0.1, 0.5, -1.0], 1: [0.3, 2.0, 0.0], 2: [-5.0, 0.25, 1.0], 3: [-5.0, 0.25, 1.0], 4: [7.0, 0.125, 1.5], 5: [100.0, 3.0, 2.0]}
    bad = [(10, None), (11, [None, 1.0, 2.0]), (12, [nan, 1.0, 2.0]), (13, [inf, 1.0, 2.0]), (14, []), (15, [1.0, 2.0]), (16, [3e38, 0.0, 0.0])]
    rows = list(good.items()) + bad
    table = spark.createDataFrame([(i, v, 7, "c") for i, v in rows], "vec_id long, embedding array<float>, x int, c string")
    table = table.withColumn("sums", F.lit(1)).withColumn("n", F.lit("n")).withColumn("component", F.lit(3))
    got = whitening.whiten(table).collect()
    check(got, good, components=3)
    assert {abs(r.whitened) for r in got if r.vec_id == 2} == {abs(r.whitened) for r in got if r.vec_id == 3}
    null_id = table.union(table.filter("vec_id = 1").withColumn("vec_id", F.lit(None).cast("long")))
    assert whitening.whiten(null_id).filter("vec_id is null").count() == 3
    # One distinct vector, none, and vectors on one line.
    assert whitening.whiten(table.filter("vec_id in (2, 3)")).collect() == []
    assert whitening.whiten(table.limit(0)).collect() == [] and whitening.whiten(table.filter("vec_id >= 10 and vec_id < 14")).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(line).collect()} == {1}
