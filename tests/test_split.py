from collections import Counter

from pyspark.sql import functions as F

from keelson.operators import split


def _strata(spark):
    rows, k = [], 0
    for label, n in (("a", 1), ("b", 2), ("c", 3), ("d", 10), (None, 5)):
        for _ in range(n):
            rows.append((k, label))
            k += 1
    return spark.createDataFrame(rows, "id int, y string")


def test_tiny_strata_and_null_label(spark):
    out = split.stratified_split(_strata(spark), "y", "id", 0.2, seed=42)
    assert out.count() == 21
    test = Counter(r.y for r in out.where(F.col("split") == "test").collect())
    assert test == Counter({"c": 1, "d": 2, None: 1})


def test_same_split_at_any_partition_count(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("y"))
    want = sorted((r.id, r.split) for r in split.stratified_split(df, "y", "id").collect())
    for n in (1, 4, 7):
        got = sorted((r.id, r.split) for r in split.stratified_split(df.repartition(n), "y", "id").collect())
        assert got == want
    sizes = Counter((i % 3, s) for i, s in want)
    for y in range(3):
        n = sizes[(y, "test")] + sizes[(y, "train")]
        assert sizes[(y, "test")] == int(n * 0.2 + 0.5)


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, y string")
    out = split.stratified_split(df, "y", "id")
    assert out.count() == 0 and out.columns == ["id", "y", "split"]


def test_no_window_over_all_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("y"))
    plan = split.stratified_split(df, "y", "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan


def test_hash_split_and_folds_are_partition_independent(spark):
    df = spark.range(20000)
    a = split.hash_split(df, "id", (0.8, 0.2))
    b = split.hash_split(df.repartition(7), "id", (0.8, 0.2))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    frac = a.where(F.col("split") == "test").count() / 20000
    assert 0.18 < frac < 0.22
    folds = Counter(r.fold for r in split.assign_folds(df, "id", 5).collect())
    assert set(folds) == set(range(5)) and min(folds.values()) > 3500
    train, test = split.random_split(df, "id", (0.8, 0.2))
    assert train.count() + test.count() == 20000


def test_same_split_whatever_the_rank_strategy(spark, monkeypatch):
    from keelson.operators import rank
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 2).alias("y"))
    want = sorted((r.id, r.split) for r in split.stratified_split(df, "y", "id").collect())
    monkeypatch.setattr(rank, "MAX_GROUP_ROWS", 0)
    got = sorted((r.id, r.split) for r in split.stratified_split(df, "y", "id").collect())
    assert got == want


def test_many_small_classes(spark):
    df = spark.range(3000).select("id", (F.col("id") % 600).alias("y"))  # 600 classes of 5 rows
    out = split.stratified_split(df, "y", "id")
    sizes = Counter(r.y for r in out.where(F.col("split") == "test").collect())
    assert sum(sizes.values()) == 600 and set(sizes.values()) == {1}


def test_small_hold_out_has_its_share(spark):
    df = spark.range(2_000_000)
    out = split.hash_split(df, "id", (0.99996, 0.00004))
    assert 45 < out.where(F.col("split") == "test").count() < 125


def test_nested_split_is_independent(spark):
    train = split.hash_split(spark.range(40_000), "id", (0.8, 0.2)).where(F.col("split") == "train").drop("split")
    n = train.count()
    test = split.hash_split(train, "id", (0.75, 0.25)).where(F.col("split") == "test").count()
    assert 0.23 * n < test < 0.27 * n


def test_copies_of_one_key_straddle_the_threshold(spark):
    df = spark.createDataFrame([(1, "a", i % 3) for i in range(100)] + [(i, "b", 0) for i in range(50)], "id int, y string, z int")
    for n in (1, 5):
        out = split.stratified_split(df.repartition(n), "y", "id", 0.3)
        assert out.count() == 150
        sizes = Counter(r.y for r in out.where(F.col("split") == "test").collect())
        assert sizes == Counter({"a": 30, "b": 15})


def test_more_classes_than_any_table_is_shipped_for(spark):
    df = spark.range(21_000).select("id", (F.col("id") % 10_500).alias("y"))
    out = split.stratified_split(df, "y", "id", 0.5)
    assert out.where(F.col("split") == "test").groupBy("y").count().where("count = 1").count() == 10_500
