import duckdb
from pyspark.sql import functions as F

from keelson.operators import profile
from tests.conftest import SF_SMALL


def test_validate_input_reports_faults(spark):
    df = spark.createDataFrame([(1, None, True), (2, None, True)], "k int, x double, y boolean")
    report = profile.validate_input(df, label="y")
    rows = {r.column_name: r for r in report.collect()}
    assert rows["x"].all_missing and rows["x"].n_missing == 2
    assert rows["y"].n_label_classes == 1 and rows["y"].is_constant
    faults = profile.input_faults(report, "y")
    assert any("no present value" in f for f in faults)
    assert any("fewer than two classes" in f for f in faults)


def test_validate_input_passes_clean_frame(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 1)], "k int, x double, y int")
    assert profile.input_faults(profile.validate_input(df, "y"), "y") == []


def test_counts_shapes_and_head(spark):
    a = spark.range(10)
    b = spark.range(3).withColumn("z", F.lit(0))
    shapes = {r.frame: (r.n_rows, r.n_cols) for r in profile.shape_profile({"a": a, "b": b}).collect()}
    assert shapes == {"a": (10, 1), "b": (3, 2)}
    assert [r.id for r in profile.head_rows(a, "id", 5).collect()] == [0, 1, 2, 3, 4]
    r = profile.key_range(a, "id").first()
    assert (r.key_min, r.key_max, r.n_keys) == (0, 9, 10)


def test_large_distinct_keys_are_not_constant_and_empty_input_is_reported(spark):
    big = 2 ** 60
    df = spark.createDataFrame([(big, "a", 1), (big + 1, "a", 0)], "k bigint, s string, y int")
    rows = {r.column_name: r for r in profile.validate_input(df, "y").collect()}
    assert not rows["k"].is_constant and rows["s"].is_constant
    empty = spark.createDataFrame([], "k bigint, y int")
    assert profile.input_faults(profile.validate_input(empty, "y"), "y") == ["input has no rows"]


def test_column_shapes_of_made_columns(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") % 7).alias("few"), F.when(F.col("id") % 30 == 0, F.lit("b")).otherwise(F.lit("a")).alias("mostly"),
        F.exp(F.col("id") / 100.0).alias("steep"), F.lit(None).cast("double").alias("none"), F.lit(float("nan")).alias("nan"),
        F.concat(F.lit("k"), F.least(F.col("id"), F.lit(1920))).alias("near_border"), (F.col("id") % 2 == 0).alias("flag"))
    rows = {r.column_name: r for r in profile.column_shapes(df).collect()}
    assert {c for c, r in rows.items() if r.id_like} == {"id", "steep", "near_border"}
    assert {c for c, r in rows.items() if r.near_constant} == {"mostly"} and rows["mostly"].top_count == 1933
    assert {c for c, r in rows.items() if r.skewed} == {"steep"}
    assert rows["none"].n_present == rows["nan"].n_present == 0
    empty = profile.column_shapes(df.limit(0)).collect()
    assert len(empty) == 8 and not any(r.id_like or r.near_constant or r.skewed for r in empty)


def test_distinct_sketch_keeps_its_error_on_every_given_table(spark):
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels"):
        path = f"{SF_SMALL}/{t}.parquet"
        found = profile.column_shapes(spark.read.parquet(path)).collect()
        names = ", ".join(f'count(DISTINCT "{r.column_name}")' for r in found)
        for r, exact in zip(found, duckdb.sql(f"SELECT {names} FROM '{path}'").fetchone()):
            assert abs(r.distinct_estimate - exact) <= 4 * profile.SKETCH_ERROR * exact, (t, r.column_name)
