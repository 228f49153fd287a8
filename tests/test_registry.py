from keelson.operators import registry as reg
from keelson.session import scratch_dir
from keelson.sources.catalog import scan_registered


def test_versions_lineage_and_scan(spark):
    reg_path = scratch_dir(spark, "reg")
    data = spark.range(10)
    paths = []
    for i in range(2):
        p = scratch_dir(spark, f"ds{i}")
        data.limit(5 * (i + 1)).write.parquet(p)
        paths.append(p)
        e = reg.dataset_entry(spark, "feat", p, data.schema, [("raw", 3)], run_id=f"r{i}")
        got = reg.register(spark, reg_path, e, reg.DATASET_SCHEMA).first()
        assert got.version == i + 1
    datasets = reg.read_registry(spark, reg_path, reg.DATASET_SCHEMA)
    assert scan_registered(spark, datasets, "feat").count() == 10
    assert scan_registered(spark, datasets, "feat", version=1).count() == 5
    texts = {r.input_text for r in reg.lineage_inputs(datasets).collect()}
    assert texts == {"raw: 3"}
    fields = [(r.field_name, r.field_type) for r in reg.field_rows(datasets.where("version = 1")).collect()]
    assert fields == [("id", "bigint")]

    model_path = scratch_dir(spark, "models")
    m = reg.model_entry(spark, "clf", "/models/clf", [(reg.ROLE_TRAIN, "feat", 2), (reg.ROLE_TEST, "feat", 1)])
    reg.register(spark, model_path, m, reg.MODEL_SCHEMA)
    models = reg.read_registry(spark, model_path, reg.MODEL_SCHEMA)
    md = {(r.role, r.dataset_version, r.dataset_run_id) for r in reg.model_datasets(models, datasets).collect()}
    assert md == {(reg.ROLE_TRAIN, 2, "r1"), (reg.ROLE_TEST, 1, "r0")}
    back = {(r.dataset_version, r.model_name) for r in reg.dataset_models(models, datasets).collect()}
    assert back == {(1, "clf"), (2, "clf")}
    lin = [(r.dataset_version, r.input_name, r.input_version) for r in reg.model_lineage(models, datasets).collect()]
    assert lin == [(2, "raw", 3)]


def test_empty_registry_reads_empty(spark):
    assert reg.read_registry(spark, scratch_dir(spark, "nothing"), reg.DATASET_SCHEMA).count() == 0


def test_half_of_the_roles_name_one_dataset(spark):
    n = 400
    ds = spark.createDataFrame([(f"d{i}", 1) for i in range(n)] + [("shared", 1)], "name string, version int")
    ds = ds.selectExpr("name", "version", "concat('/p/', name) as path", "'r' as run_id")
    models = spark.range(n).selectExpr("concat('m', id) as name", "1 as version", """array(
        named_struct('role', 'train', 'name', concat('d', id), 'version', 1),
        named_struct('role', 'test', 'name', 'shared', 'version', 1),
        named_struct('role', 'old', 'name', 'gone', 'version', 1)) as datasets""")
    got = reg.model_datasets(models, ds).collect()
    assert len(got) == 3 * n
    assert {r.dataset_path for r in got if r.role == "test"} == {"/p/shared"}
    assert all(r.dataset_path == f"/p/{r.dataset_name}" for r in got if r.role == "train")
    assert {r.dataset_path for r in got if r.role == "old"} == {None}
    assert reg.dataset_models(models, ds).count() == 2 * n


def test_broken_registry_is_not_read_as_empty(spark):
    path = scratch_dir(spark, "broken")
    spark.range(1).write.parquet(path)
    import pytest
    with pytest.raises(Exception):
        reg.read_registry(spark, path, "name string, version nonsense").count()
