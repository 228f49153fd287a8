"""The reference's flows end to end on the smallest driver tables."""

from pyspark.sql import functions as F

from keelson.operators import registry as reg
from keelson.plans import jobs
from keelson.session import scratch_dir
from keelson.sources.files import table_path
from tests.conftest import SF_SMALL

PRIORITY = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


def test_featurize_and_stratified_split_flow(spark):
    root = scratch_dir(spark, "registry")
    for i in range(3):  # the same upload registered three times
        jobs.register_source(spark, root, f"feature_set_{i + 1}", table_path(SF_SMALL, "orders"))
    out = jobs.run_featurize(spark, ["feature_set_1", "feature_set_2", "feature_set_3"],
                             scratch_dir(spark, "featurized"), root, "featurized",
                             {"o_orderpriority": PRIORITY}, ["o_custkey"], ["o_totalprice"],
                             run_id="run-1", feature_table="feat_jobs.orders_featurized")
    df = spark.read.parquet(out["path"])
    n = spark.read.parquet(table_path(SF_SMALL, "orders")).count()
    assert out["shapes"]["featurized"] == (3 * n, 6)
    assert out["shapes"]["feature_set_1"] == (n, 6)
    assert df.count() == 3 * n
    assert df.select("id").distinct().count() == 3 * n
    assert spark.table("feat_jobs.orders_featurized").count() == 3 * n
    sp = jobs.run_featurize_split(spark, ["feature_set_1", "feature_set_2", "feature_set_3"],
                                  scratch_dir(spark, "split"), root, ("orders_train", "orders_test"),
                                  {"o_orderpriority": PRIORITY}, ["o_custkey"], ["o_totalprice"], "o_orderstatus")
    train, test = (spark.read.parquet(sp[s]["path"]) for s in ("train", "test"))
    assert train.count() + test.count() == 3 * n
    assert train.where(F.col("o_totalprice").isNull()).count() == 0
    # every split row keeps its id, and no id is on both sides
    assert train.join(test, "id").count() == 0
    ds = reg.read_registry(spark, f"{root}/{jobs.DATASETS}", reg.DATASET_SCHEMA)
    inputs = {r.input_text for r in reg.lineage_inputs(ds.where(F.col("name") == "orders_train")).collect()}
    assert inputs == {"feature_set_1: 1", "feature_set_2: 1", "feature_set_3: 1"}


def test_base_tables_lookup_split_train_select(spark):
    root = scratch_dir(spark, "registry")
    jobs.prepare_base_tables(spark, "ft_jobs", 300, 200, 1000)
    sp = jobs.run_lookup_split(spark, "ft_jobs", scratch_dir(spark, "ts"), root, ("ts_train", "ts_test"))
    train = spark.read.parquet(sp["train"]["path"])
    test = spark.read.parquet(sp["test"]["path"])
    assert train.count() + test.count() == 1000
    assert sp["rows"]["ground_truth"] == sp["rows"]["training_set"] == 1000
    ds = reg.read_registry(spark, f"{root}/{jobs.DATASETS}", reg.DATASET_SCHEMA)
    lineage = {(r.input_name, r.input_version) for r in reg.lineage_inputs(ds.where(F.col("name") == "ts_train")).collect()}
    assert lineage == {("ft_jobs.network", 1), ("ft_jobs.customers", 1), ("ft_jobs.ground_truth", 1)}
    assert ds.where(F.col("name") == "ft_jobs.ground_truth").count() == 1
    assert set(train.columns) == {"customer", "network", "label", "failure", "salary", "age", "id"}
    res = jobs.run_train(spark, root, "ts_train", "label", "clf", scratch_dir(spark, "model"))
    assert res["version"] == 1 and len(res["coefficients"]) == 11
    sel = jobs.run_select(spark, root, "ts_train", "ts_test", "label", "id", "clf_cv",
                          scratch_dir(spark, "cv_model"), scratch_dir(spark, "cv_metrics"),
                          [{"regParam": 0.001}, {"regParam": 1.0}], folds=3)
    assert 0.0 <= sel["test_auc"] <= 1.0
    models = reg.read_registry(spark, f"{root}/{jobs.MODELS}", reg.MODEL_SCHEMA).where(F.col("name") == "clf_cv")
    ds = reg.read_registry(spark, f"{root}/{jobs.DATASETS}", reg.DATASET_SCHEMA)
    roles = {(r.role, r.dataset_name) for r in reg.model_datasets(models, ds).collect()}
    assert roles == {(reg.ROLE_TRAIN, "ts_train"), (reg.ROLE_TEST, "ts_test")}


def test_changed_table_is_registered_again(spark):
    root = scratch_dir(spark, "registry")
    jobs.prepare_base_tables(spark, "ft_again", 20, 20, 20)
    assert jobs.table_version(spark, root, "ft_again.network") == 1
    assert jobs.table_version(spark, root, "ft_again.network") == 1
    more = spark.createDataFrame([(99, True)], "network_id int, failure boolean")
    jobs.tables.append_rows(spark, "ft_again.network", more)
    assert jobs.table_version(spark, root, "ft_again.network") == 2


def test_csv_dataset_through_the_whole_flow(spark):
    root, path = scratch_dir(spark, "registry"), scratch_dir(spark, "orders-csv")
    orders = spark.read.parquet(table_path(SF_SMALL, "orders"))
    orders.write.option("header", "true").csv(path)
    jobs.register_source(spark, root, "fs", path, fmt="csv", options={"header": "true"})
    (_, _, back), = jobs.resolve_inputs(spark, root, ["fs"])
    assert back.columns == orders.columns and back.count() == orders.count()
    assert dict(back.dtypes)["o_totalprice"] == "double"
    names = ("csv_train", "csv_test")
    sp = jobs.run_featurize_split(spark, ["fs"], scratch_dir(spark, "split"), root, names, {"o_orderpriority": PRIORITY},
                                  ["o_custkey"], ["o_totalprice"], "o_orderstatus", feature_tables=("feat_csv.train", "feat_csv.test"))
    for side, name in zip(("train", "test"), names):
        assert spark.table(f"feat_csv.{side}").count() == spark.read.parquet(sp[side]["path"]).count()
    again = scratch_dir(spark, "featurized")
    for mode in ("errorifexists", "overwrite"):
        out = jobs.run_featurize(spark, ["fs"], again, root, "csv_feat", {}, ["o_custkey"], [], mode=mode, fmt="orc")
    assert out["version"] == 2 and spark.read.orc(again).count() == orders.count()


def test_tiny_input_with_an_empty_side(spark):
    root, path = scratch_dir(spark, "registry"), scratch_dir(spark, "two")
    spark.createDataFrame([("a", 1.0), ("a", 2.0)], "y string, x double").write.parquet(path)
    jobs.register_source(spark, root, "two", path)
    sp = jobs.run_featurize_split(spark, ["two"], scratch_dir(spark, "split"), root, ("t1", "t2"), {}, [], ["x"], "y")
    assert spark.read.parquet(sp["train"]["path"]).count() == 2
    assert spark.read.parquet(sp["test"]["path"]).count() == 0
