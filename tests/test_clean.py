import math

import pytest
from pyspark.sql import functions as F

from keelson.operators import clean


def test_null_and_nan_are_both_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert clean.fit_means(df, ["x"]) == {"x": 2.0}
    out = [r.x for r in clean.impute_mean(df, ["x"]).collect()]
    assert sorted(out) == [1.0, 2.0, 2.0, 3.0]


def test_column_without_present_value_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert [r.x for r in clean.impute_mean(df, ["x"]).collect()] == [None, None]


def test_recode_listed_values_and_unlisted_handling(spark):
    df = spark.createDataFrame([("male",), ("female",), (None,)], "Sex string")
    got = [r.Sex for r in clean.recode_values(df, "Sex", {"male": 0, "female": 1}).collect()]
    assert got == [0, 1, None]
    bad = spark.createDataFrame([("male",), ("other",)], "Sex string")
    with pytest.raises(Exception):
        clean.recode_values(bad, "Sex", {"male": 0, "female": 1}).collect()
    got = [r.Sex for r in clean.recode_values(bad, "Sex", {"male": 0, "female": 1}, unlisted="null").collect()]
    assert got == [0, None]


@pytest.mark.parametrize("size", [16, 17])
def test_dictionary_size_changes_nothing(spark, size):
    mapping = {f"v{i}": i for i in range(size)} | {"v3": None}
    df = spark.createDataFrame([("v3",), ("v7",), (None,)], "c string")
    assert [r.c for r in clean.recode_values(df, "c", mapping).collect()] == [None, 7, None]
    numbers = spark.createDataFrame([("3",), ("7",)], "c string")
    assert [r.c for r in clean.recode_values(numbers, "c", {i: i * 10 for i in range(size)}).collect()] == [30, 70]


def test_unlisted_values_can_stay(spark):
    df = spark.createDataFrame([("male",), ("other",), (None,)], "c string")
    got = [r.c for r in clean.recode_values(df, "c", {"male": "m"}, unlisted="keep", out_type="string").collect()]
    assert got == ["m", "other", None]


def test_recode_and_impute_of_one_column(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "x int, s string")
    out = clean.clean_features(df, recode={"x": {1: 10, 2: 20}, "s": {"a": 1, "b": 4}}, impute=["x", "s"])
    assert [tuple(r) for r in out.collect()] == [(10.0, 1.0), (20.0, 4.0), (15.0, 2.5)]


def test_large_dictionary(spark):
    mapping = {f"v{i}": i for i in range(100)}
    df = spark.createDataFrame([("v7",), ("v99",), ("zz",)], "c string")
    got = [r.c for r in clean.recode_values(df, "c", mapping, unlisted="null").collect()]
    assert got == [7, 99, None]
    with pytest.raises(Exception):
        clean.recode_values(df, "c", mapping).collect()


def test_drop_unknown_column_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        clean.drop_columns(df, ["nope"])
    assert clean.drop_columns(df, ["a"]).columns == ["b"]


def test_union_aligns_by_name_with_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y",)], "b string")
    rows = clean.union_by_name([a, b]).collect()
    assert [(r.a, r.b) for r in rows] == [(1, "x"), (None, "y")]


def test_clean_features_fits_once_and_applies_given_means(spark):
    df = spark.createDataFrame([("male", 10.0, "n1"), ("female", None, "n2")], "Sex string, Age double, Name string")
    out = clean.clean_features(df, recode={"Sex": {"male": 0, "female": 1}}, drop=["Name"], impute=["Age"])
    assert out.columns == ["Sex", "Age"]
    assert [tuple(r) for r in out.collect()] == [(0, 10.0), (1, 10.0)]
    out2 = clean.clean_features(df, impute=["Age"], means={"Age": 5.0})
    assert [r.Age for r in out2.collect()] == [10.0, 5.0]
    assert not math.isnan(out2.agg(F.sum("Age")).first()[0])


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], "Sex string, Age double")
    out = clean.clean_features(df, recode={"Sex": {"male": 0}}, impute=["Age"])
    assert out.count() == 0
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "double"]


@pytest.mark.parametrize("unlisted", ["error", "null", "keep"])
def test_large_dictionaries_recode_as_small_ones(spark, unlisted, monkeypatch):
    mapping = {f"v{i}": (None if i == 7 else i) for i in range(60)} | {None: 5, 3: 9}
    values = ["v1", "v7", None, "v59", "v1"] + ([] if unlisted == "error" else ["odd"])
    df = spark.createDataFrame([(k, v, "x") for k, v in enumerate(values)], "k int, c string, `a.b` string")
    out_type = "string" if unlisted == "keep" else "int"
    joined = clean.recode_values(df, "c", mapping, unlisted, out_type)
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString() and joined.columns == df.columns
    monkeypatch.setattr(clean, "EXPR_ENTRIES", 1000)
    small = clean.recode_values(df, "c", mapping, unlisted, out_type)
    assert "Join" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(joined.collect()) == sorted(small.collect()) and joined.schema["c"].dataType == small.schema["c"].dataType


def test_join_recode_faults_types_and_repeats(spark):
    mapping = {i: i * 2 for i in range(100_000)} | {"5": 1, 2**40: 3}
    df = spark.range(0, 200_000, 1).select((F.col("id") % 100_000).alias("c"))
    out = clean.recode_values(df, "c", mapping)
    assert out.count() == 200_000 and out.agg(F.sum("c")).first()[0] == 2 * 2 * sum(range(100_000))
    with pytest.raises(Exception, match="unlisted value in c: 100001"):
        clean.recode_values(spark.range(100_000, 100_002).select(F.col("id").alias("c")), "c", mapping | {100_000: 1}).collect()
    with pytest.raises(ValueError):
        clean.recode_values(df, "c", mapping, unlisted="odd")
