import pytest
from pyspark.sql import functions as F

from keelson.operators.keys import PrimaryKeyError, pk_violations
from keelson.operators.lookup import FeatureLookup, lookup, training_set
from keelson.plans.queries import lineitem_training_set


def test_unmatched_and_null_keys_keep_every_row(spark):
    base = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "k int, tag string")
    feat = spark.createDataFrame([(1, 10.0)], "id int, f double")
    for salt in (False, True):
        out = lookup(base, FeatureLookup(feat, ["f"], "k", "id"), salt_null_keys=salt)
        rows = sorted(out.collect(), key=lambda r: r.tag)
        assert [(r.k, r.tag, r.f) for r in rows] == [(1, "a", 10.0), (9, "b", None), (None, "c", None)]
        assert out.columns == ["k", "tag", "f"]


def test_duplicate_or_null_primary_key_fails_before_join(spark):
    base = spark.createDataFrame([(1,)], "k int")
    for keys in ([(1, 1.0), (1, 2.0)], [(1, 1.0), (None, 2.0)]):
        feat = spark.createDataFrame(keys, "id int, f double")
        with pytest.raises(PrimaryKeyError):
            lookup(base, FeatureLookup(feat, ["f"], "k", "id"))


def test_feature_name_collision_needs_rename(spark):
    base = spark.createDataFrame([(1, 30)], "k int, age int")
    feat = spark.createDataFrame([(1, 40)], "k int, age int")
    with pytest.raises(ValueError):
        lookup(base, FeatureLookup(feat, ["age"], "k"))
    out = lookup(base, FeatureLookup(feat, ["age"], "k", rename={"age": "feat_age"}))
    assert out.collect()[0].asDict() == {"k": 1, "age": 30, "feat_age": 40}


def test_training_set_keeps_row_count_and_label_last(spark):
    from tests.conftest import SF_SMALL
    ts = lineitem_training_set(spark, SF_SMALL)
    assert ts.columns[-1] == "label"
    assert ts.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_training_set_skips_fully_excluded_lookup(spark):
    base = spark.createDataFrame([(1, True)], "k int, label boolean")
    feat = spark.createDataFrame([(1, 2.0)], "k int, f double")
    out = training_set(base, [FeatureLookup(feat, ["f"], "k")], label="label", exclude_columns=["f"])
    assert out.columns == ["k", "label"]


def test_pk_violations_counts_repeats(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = {(r.k, r.n_rows, r.has_null) for r in pk_violations(df, "k").collect()}
    assert got == {(1, 2, False), (None, 1, True)}


def test_lookup_plan_prunes_and_broadcasts_small_feature_tables(spark):
    from tests.conftest import SF_SMALL
    plan = lineitem_training_set(spark, SF_SMALL, check_keys=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<s_suppkey:bigint,s_acctbal:double>" in plan
    assert "CartesianProduct" not in plan


def test_null_key_salt_spreads_shuffle_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
        feat = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("f"))
        out = lookup(base, FeatureLookup(feat, ["f"], "k"), salt_null_keys=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert out.count() == 200
        assert out.where(F.col("f").isNotNull()).count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_training_set_is_the_same_at_any_partition_count(spark):
    from tests.conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("label", F.col("l_returnflag") == "R")
    sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    specs = [FeatureLookup(sup, ["s_acctbal"], "l_suppkey", "s_suppkey"),
             FeatureLookup(part, ["p_size"], "l_partkey", "p_partkey")]
    want = sorted(map(tuple, training_set(li, specs, label="label").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sort-merge joins too
    try:
        for n in (1, 4, 7):
            got = training_set(li.repartition(n), [FeatureLookup(s.table.repartition(n), s.feature_names,
                                                                 s.lookup_key, s.primary_key) for s in specs],
                               label="label")
            assert sorted(map(tuple, got.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_lookup_key_is_split_by_adaptive_execution(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # key 7 holds a third of the base rows
        base = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"), "id")
        feat = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("f"))
        out = lookup(base, FeatureLookup(feat, ["f"], "k"))
        assert len(out.collect()) == 60000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k in conf:
            spark.conf.unset(k)
