from pyspark.sql import functions as F

from keelson.sources import synth
from keelson.sources.files import spread


def test_spread_adds_no_shuffle_to_a_well_partitioned_input(spark):
    wide = spark.range(0, 1000, 1, 16)
    assert spread(wide, 8) is wide
    narrow = spark.range(0, 1000, 1, 1)
    assert spread(narrow, 8).rdd.getNumPartitions() == 8


def test_synthetic_columns_do_not_depend_on_partitioning(spark):
    gen = {"age": synth.UniformInt(20, 100), "salary": synth.Stepped(10000, 1, 19), "flag": synth.Coin(),
           "pick": synth.Choice(("a", "b", "c"))}
    one = sorted(map(tuple, synth.synth_range(spark, 500, "id", gen).collect()))
    many = sorted(map(tuple, synth.synth_table(spark.range(0, 500, 1, 7), "id", gen).collect()))
    assert one == many
    ages = [r[1] for r in one]
    assert min(ages) >= 20 and max(ages) <= 100
    assert {r[2] for r in one} <= {10000 * k for k in range(1, 20)}
    assert {r[4] for r in one} == {"a", "b", "c"}


def test_values_source_is_a_local_relation(spark):
    df = synth.values_source(spark, [("x", 1), ("y", 2)], "k string, v int")
    assert sorted(map(tuple, df.collect())) == [("x", 1), ("y", 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
    assert df.where(F.col("v") > 1).count() == 1


def test_wide_generator_ranges(spark):
    from keelson.sources import synth
    df = synth.synth_range(spark, 20_000, "k", {"wide": synth.UniformInt(0, 6_000_000_000), "step": synth.Stepped(1_000_000, 1, 9_000),
                                                "small": synth.UniformInt(20, 100)})
    types = dict(df.dtypes)
    assert (types["wide"], types["step"], types["small"]) == ("bigint", "bigint", "int")
    top = df.selectExpr("max(wide) w", "max(step) s").first()
    assert 4_500_000_000 < top.w <= 6_000_000_000 and top.s > 1 << 32
