import pytest
from pyspark.sql import functions as F

from keelson.operators import scale


def test_constant_column_maps_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert [r.x for r in scale.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0, 0.0]
    assert [r.x for r in scale.standard_scale(df, ["x"]).collect()] == [0.0, 0.0, 0.0]


def test_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    got = sorted(r.x for r in scale.standard_scale(df, ["x"]).collect())
    assert got == pytest.approx([-1.2247449, 0.0, 1.2247449], abs=1e-6)
    assert sorted(r.x for r in scale.minmax_scale(df, ["x"]).collect()) == [0.0, 0.5, 1.0]


def test_feature_matrix_layout_and_train_stats(spark):
    train = spark.createDataFrame([(1, 0.0, 10.0), (2, 10.0, 30.0)], "k int, a double, b double")
    test = spark.createDataFrame([(3, 5.0, None)], "k int, a double, b double")
    st = scale.fit_scaler(train, ["a", "b"])
    out = scale.scaled_feature_matrix(test, ["a", "b"], st)
    assert out.columns == ["mm_a", "mm_b", "std_a", "std_b", "k"]
    r = out.first()
    assert (r.mm_a, r.mm_b, r.std_a, r.std_b, r.k) == (0.5, None, 0.0, None, 3)


def test_stats_frame_is_one_row_per_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, float("nan"))], "a double, b double")
    rows = {r.column_name: r for r in scale.scaler_stats(df, ["a", "b"]).collect()}
    assert rows["a"].n == 2 and rows["a"].mean == 2.0 and rows["a"].std == 1.0
    assert rows["b"].n == 1 and rows["b"].std == 0.0


def test_apply_is_a_projection(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    out = scale.scaled_feature_matrix(df, ["x"], scale.fit_scaler(df, ["x"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
