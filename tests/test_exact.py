import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keelson.operators import clean, exact, scale
from tests.conftest import SF_SMALL


def values():
    rng = np.random.default_rng(5)
    wild = rng.standard_normal(3000) * 2.0 ** rng.integers(-300, 400, 3000)
    borders = [s * 2.0 ** e * f for e in range(-96, 97) for s in (1, -1) for f in (1.0, 1 - 2.0 ** -53, 1 + 2.0 ** -52)]
    return [*wild.tolist(), *(-wild[:1000]).tolist(), *borders, 0.0, -0.0, 0.1, 1e16, -1e16, 3.0]


def test_moments_are_the_exact_ones(spark):
    xs = values()
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "x double").repartition(5)
    got = exact.exact_moments(df, ["x"])["x"]
    total, squares = sum(map(Fraction, xs)), sum(Fraction(x) ** 2 for x in xs)
    assert (got.n, got.total, got.squares) == (len(xs), total, squares)
    assert got.mean == float(total / len(xs)) and got.mean == pytest.approx(math.fsum(xs) / len(xs))
    assert (got.min, got.max) == (min(xs), max(xs))


def test_fits_are_equal_bit_for_bit_at_any_partitioning(spark):
    rows = [(float(x), i) for i, x in enumerate(values())]
    df = spark.createDataFrame(rows, "x double, i int").withColumn("y", F.sin("i") * 1e6)
    seen = set()
    for n in (1, 4, 7):
        stats = scale.fit_scaler(df.repartition(n, "i"), ["x", "y"], exact=True)
        means = exact.exact_means(df.repartition(n), ["x", "y"])
        assert means == {c: st.mean for c, st in stats.items()}
        seen.add(tuple((st.n, st.min, st.max, st.mean, st.std) for st in stats.values()))
    assert len(seen) == 1


def test_exact_and_plain_fits_agree(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    plain, found = scale.fit_scaler(li, cols), scale.fit_scaler(li, cols, exact=True)
    for c in cols:
        a, b = plain[c], found[c]
        assert (a.n, a.min, a.max) == (b.n, b.min, b.max)
        assert a.mean == pytest.approx(b.mean, rel=1e-12) and a.std == pytest.approx(b.std, rel=1e-9)


def test_missing_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 2.5, 1), (None, 2.5, 2)], "a double, b double, k int")
    st = scale.fit_scaler(df, ["a", "b"], exact=True)
    assert (st["a"].n, st["a"].mean, st["a"].std) == (0, None, None)
    assert (st["b"].mean, st["b"].std) == (2.5, 0.0)
    assert exact.exact_means(df.limit(0), ["a", "b"]) == {"a": None, "b": None}
    filled = clean.impute_mean(df, ["a", "b"], exact.exact_means(df, ["a", "b"])).collect()
    assert [(r.a, r.b) for r in filled] == [(None, 2.5)] * 2


def test_values_without_exact_parts_stop_the_job(spark):
    for x in (float("inf"), 1e200, 1e-200):
        df = spark.createDataFrame([(1.0,), (x,)], "x double")
        with pytest.raises(PySparkException, match="no exact sum"):
            exact.exact_moments(df, ["x"])


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, "n")], "task double, place double, bin double, moment string")
    got = exact.exact_moments(df, ["task", "place", "bin"])
    assert [m.mean for m in got.values()] == [1.0, 2.0, 3.0]
