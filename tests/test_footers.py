"""Counts and ranges from file footers, and feature tables bucketed by key."""

import pytest
from pyspark.sql import functions as F

from keelson.operators import profile
from keelson.operators.keys import PrimaryKeyError
from keelson.operators.lookup import FeatureLookup, lookup
from keelson.sinks import tables
from keelson.sources.files import scan_footers


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_and_ranges_read_no_column_data(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("half")).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    df = scan_footers(spark, path)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    counts, span = profile.row_counts({"t": df}), profile.key_range(df, "half")
    assert counts.first().n_rows == 1000 and tuple(span.first()) == (0, 998, 500)
    assert "PushedAggregation: [COUNT(*)]" in plan_of(counts)
    assert "PushedAggregation: [MIN(half), MAX(half), COUNT(half)]" in plan_of(span)
    # Anything else is an ordinary scan.
    assert profile.row_counts({"t": df.filter("half > 500")}).first().n_rows == 249
    assert df.agg(F.sum("id")).first()[0] == 499500


def test_an_empty_table_has_no_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0).write.parquet(path)
    df = scan_footers(spark, path)
    assert profile.row_counts({"t": df}).first().n_rows == 0 and tuple(profile.key_range(df, "id").first()) == (None, None, 0)


@pytest.fixture
def bucketed(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2.5).alias("v"))
    tables.drop_table(spark, "bucketed_features")
    tables.create_feature_table(spark, "bucketed_features", "k", rows.schema, "by bucket", str(tmp_path / "f"), buckets=8)
    tables.write_feature_table(spark, "bucketed_features", rows)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    tables.drop_table(spark, "bucketed_features")


def feature_side_moves(spark, name: str, features=("v",)) -> bool:
    base = spark.range(2000).select((F.col("id") % 600).alias("x"))
    out = lookup(base, FeatureLookup(name, list(features), "x", "k"))
    rows = {r.x: r for r in out.collect()}
    assert len(rows) == 600 and rows[0].v == 0.0 and rows[499].v == 1247.5 and rows[500].v is None
    # One exchange, of the base rows.
    plan = plan_of(out).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan
    return plan.count("Exchange hashpartitioning") > 1


def test_lookup_moves_the_base_rows_only(spark, bucketed):
    assert not feature_side_moves(spark, "bucketed_features")
    plain = "plain_features"
    tables.drop_table(spark, plain)
    tables.create_feature_table(spark, plain, "k", bucketed.schema)
    tables.write_feature_table(spark, plain, bucketed)
    assert feature_side_moves(spark, plain)
    tables.drop_table(spark, plain)


def test_overwrites_keep_the_buckets(spark, bucketed):
    tables.write_feature_table(spark, "bucketed_features", bucketed)
    assert not feature_side_moves(spark, "bucketed_features")
    wider = bucketed.withColumn("w", F.col("v") + 1)
    tables.write_feature_table(spark, "bucketed_features", wider)
    assert spark.table("bucketed_features").columns == ["k", "v", "w"]
    assert not feature_side_moves(spark, "bucketed_features", ("v", "w"))
    assert tables.table_primary_keys(spark, "bucketed_features") == ["k"]
    assert not [t.name for t in spark.catalog.listTables() if "__stage" in t.name]


def test_appended_rows_are_found_in_their_buckets(spark, bucketed):
    more = spark.range(1000, 1020).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))
    tables.write_feature_table(spark, "bucketed_features", more, mode="append")
    assert not feature_side_moves(spark, "bucketed_features")
    out = lookup(spark.createDataFrame([(1005,), (3,)], "x long"), FeatureLookup("bucketed_features", ["v"], "x", "k"))
    assert {r.x: r.v for r in out.collect()} == {1005: 1.0, 3: 7.5}


def test_a_bad_key_leaves_the_old_rows(spark, bucketed):
    with pytest.raises(PrimaryKeyError):
        tables.write_feature_table(spark, "bucketed_features", bucketed.union(bucketed))
    assert spark.table("bucketed_features").count() == 500
    assert not [t.name for t in spark.catalog.listTables() if "__stage" in t.name]
