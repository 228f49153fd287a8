import pytest
from pyspark.sql import functions as F

from keelson.operators.keys import PrimaryKeyError
from keelson.operators.lookup import FeatureLookup, lookup
from keelson.session import scratch_dir
from keelson.sinks import files, tables


@pytest.fixture()
def db(spark):
    tables.create_schema(spark, "t_feat", location=scratch_dir(spark, "t_feat.db"))
    return "t_feat"


def test_feature_table_keeps_key_and_description_across_schema_change(spark, db):
    name = f"{db}.customers"
    df = spark.createDataFrame([(1, 30, 10000), (2, 40, 20000)], "id int, age int, salary int")
    tables.drop_table(spark, name)
    tables.create_feature_table(spark, name, "id", df.schema, "Customer features",
                                location=scratch_dir(spark, "customers"))
    tables.write_feature_table(spark, name, df.select("salary", "age", "id"))  # by name, not position
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 30, 10000), (2, 40, 20000)]
    wider = df.withColumn("band", F.col("age") / 10)
    tables.write_feature_table(spark, name, wider)
    assert tables.table_primary_keys(spark, name) == ["id"]
    assert tables.table_comment(spark, name) == "Customer features"
    assert "band" in spark.table(name).columns
    with pytest.raises(PrimaryKeyError):
        tables.write_feature_table(spark, name, wider.unionByName(wider))


def test_register_table_checks_key_and_lookup_trusts_it(spark, db):
    name = f"{db}.network"
    tables.drop_table(spark, name)
    net = spark.createDataFrame([(0, True), (1, False)], "network_id int, failure boolean")
    tables.save_table(net, name, location=scratch_dir(spark, "network"))
    tables.register_feature_table(spark, name, "network_id", "Network features")
    base = spark.createDataFrame([(7, 1), (8, 5)], "customer int, network int")
    out = lookup(base, FeatureLookup(name, ["failure"], "network"))
    assert sorted(map(tuple, out.collect())) == [(7, 1, False), (8, 5, None)]
    dup = f"{db}.dup"
    tables.drop_table(spark, dup)
    tables.save_table(net.unionByName(net), dup, location=scratch_dir(spark, "dup"))
    with pytest.raises(PrimaryKeyError):
        tables.register_feature_table(spark, dup, "network_id")


def test_append_and_ddl(spark, db):
    name = f"{db}.ground_truth"
    tables.drop_table(spark, name)
    tables.create_table(spark, name, "customer INT, network INT, label BOOLEAN",
                        location=scratch_dir(spark, "gt"))
    rows = spark.createDataFrame([(True, 1, 2)], "label boolean, network int, customer int")
    tables.append_rows(spark, name, rows)
    tables.append_rows(spark, name, rows)
    assert [tuple(r) for r in spark.table(name).collect()] == [(2, 1, True)] * 2


def test_parquet_sink_refuses_existing_path_and_overwrite_replaces_schema(spark):
    path = scratch_dir(spark, "sink")
    df = spark.range(3)
    files.write_parquet(df, path)
    with pytest.raises(Exception):
        files.write_parquet(df, path)
    files.overwrite_with_schema(df.withColumn("x", F.lit("a")), path)
    assert spark.read.parquet(path).columns == ["id", "x"]


def test_split_pair_is_one_write(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 20, "test").otherwise("train"))
    paths = files.write_split(df, scratch_dir(spark, "pair"))
    assert spark.read.parquet(paths["test"]).count() == 20
    assert spark.read.parquet(paths["train"]).count() == 80


def test_feature_table_can_be_rewritten_from_itself(spark, db):
    name = f"{db}.self_rewrite"
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, x double")
    tables.drop_table(spark, name)
    tables.create_feature_table(spark, name, "id", df.schema, "self", location=scratch_dir(spark, "self"))
    tables.write_feature_table(spark, name, df)
    tables.write_feature_table(spark, name, spark.table(name).withColumn("x", F.col("x") * 2))
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 20.0), (2, 40.0)]
    tables.write_feature_table(spark, name, spark.table(name).withColumn("y", F.col("x") + 1))
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 20.0, 21.0), (2, 40.0, 41.0)]
    assert tables.table_primary_keys(spark, name) == ["id"]


def test_append_keeps_the_key_contract(spark, db):
    name = f"{db}.appended"
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, x double")
    tables.drop_table(spark, name)
    tables.create_feature_table(spark, name, "id", df.schema, location=scratch_dir(spark, "appended"))
    tables.write_feature_table(spark, name, df)
    more = spark.createDataFrame([(3, 30.0)], "id int, x double")
    tables.append_rows(spark, name, more)
    for write in (lambda d: tables.append_rows(spark, name, d), lambda d: tables.write_feature_table(spark, name, d, mode="append")):
        for bad in (df.limit(1), more.withColumn("id", F.lit(9)).unionByName(more.withColumn("id", F.lit(9)))):
            with pytest.raises(PrimaryKeyError):
                write(bad)
    base = spark.createDataFrame([(1,), (3,), (7,)], "id int")
    assert sorted(map(tuple, lookup(base, FeatureLookup(name, ["x"], "id")).collect()), key=str) == [(1, 10.0), (3, 30.0), (7, None)]


def test_schema_change_keeps_location_properties_and_description(spark, db):
    name, where = f"{db}.wider", scratch_dir(spark, "wider")
    df = spark.createDataFrame([(1, 10.0)], "id int, x double")
    tables.drop_table(spark, name)
    tables.create_feature_table(spark, name, "id", df.schema, "the words", location=where)
    spark.sql(f"ALTER TABLE {tables.quote_name(name)} SET TBLPROPERTIES ('owner_team' = 'features')")
    tables.write_feature_table(spark, name, df)
    tables.write_feature_table(spark, name, df.withColumn("y", F.col("x") + 1))
    # Snapshots lie beside the folder the table was created with.
    assert tables.table_location(spark, name).split(":")[-1].startswith(f"{where}.snapshots/")
    assert tables.table_comment(spark, name) == "the words"
    assert tables.table_properties(spark, name)["owner_team"] == "features"
    assert tables.table_primary_keys(spark, name) == ["id"]
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 10.0, 11.0)]
    files = spark.read.parquet(tables.table_location(spark, name))
    assert [tuple(r) for r in files.select("id", "x", "y").collect()] == [(1, 10.0, 11.0)]


def test_empty_side_of_a_split_can_be_read(spark):
    df = spark.range(3).withColumn("split", F.lit("train"))
    paths = files.write_split(df, scratch_dir(spark, "one-sided"))
    assert spark.read.parquet(paths["test"]).count() == 0
    assert spark.read.parquet(paths["test"]).columns == ["id"]


class Killed(BaseException):
    pass


def _fail(*_, **__):
    raise Killed


def _feature_table(spark, db, name, managed):
    name = f"{db}.{name}"
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id int, x double")
    tables.drop_table(spark, name)
    tables.create_feature_table(spark, name, "id", df.schema, "kept", location=None if managed else scratch_dir(spark, "crash"))
    tables.write_feature_table(spark, name, df)
    return name, df


def _failing(df):
    return df.withColumn("x", F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("x")))


@pytest.mark.parametrize("managed", [False, True])
@pytest.mark.parametrize("wider", [False, True])
@pytest.mark.parametrize("step", ["rows", "keys", "_write_snapshot", "assert_primary_key", "_set_location", "create_table", "_rename_table",
                                  "second rename", "drop of the old table"])
def test_an_overwrite_that_fails_leaves_the_old_rows(spark, db, monkeypatch, managed, wider, step):
    if (wider and step == "_set_location") or (not wider and step in ("create_table", "_rename_table", "second rename", "drop of the old table")):
        pytest.skip("not a step of this write")
    name, df = _feature_table(spark, db, f"crash_{int(managed)}", managed)
    new = df.withColumn("x", F.col("x") + 1)
    new = new.withColumn("y", F.lit("n")) if wider else new
    real, calls = tables._rename_table, []

    def second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise Killed
        return real(*args)

    with monkeypatch.context() as m:
        if step == "rows":
            new = _failing(new)
        elif step == "keys":
            new = new.unionByName(new)
        elif step == "second rename":
            m.setattr(tables, "_rename_table", second)
        elif step == "drop of the old table":
            drop = tables.drop_table
            m.setattr(tables, "drop_table", lambda s, n: _fail() if n.endswith("__prev") else drop(s, n))
        else:
            m.setattr(tables, step, _fail)
        with pytest.raises((Exception, Killed)):
            tables.write_feature_table(spark, name, new)
    rows = sorted(tuple(r)[:2] for r in spark.table(name).collect())
    # Only after the new table is in place are its rows the ones to see.
    assert rows == [(1, 11.0), (2, 21.0), (3, 31.0)] if step == "drop of the old table" else rows == [(1, 10.0), (2, 20.0), (3, 30.0)]
    assert tables.table_primary_keys(spark, name) == ["id"] and tables.table_comment(spark, name) == "kept"
    # The next write works, whatever was left behind.
    tables.write_feature_table(spark, name, df.withColumn("x", F.lit(0.0)).withColumn("z", F.lit(1)))
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, 0.0, 1), (2, 0.0, 1), (3, 0.0, 1)]
    assert not spark.catalog.tableExists(name + "__prev") and not spark.catalog.tableExists(name + "__next")


def test_a_writer_killed_between_the_renames_is_undone(spark, db):
    name, df = _feature_table(spark, db, "killed", False)
    tables._rename_table(spark, name, name + "__prev")
    assert tables.recover_table(spark, name) and not tables.recover_table(spark, name)
    assert spark.table(name).count() == 3
    tables._rename_table(spark, name, name + "__prev")
    tables.write_feature_table(spark, name, df.limit(1))
    assert spark.table(name).count() == 1


def test_one_earlier_snapshot_is_kept_for_its_readers(spark, db):
    from keelson.sinks import commits
    name, df = _feature_table(spark, db, "history", False)
    base = tables.table_properties(spark, name)[tables.BASE_PROPERTY]
    reader = spark.table(name)
    tables.write_feature_table(spark, name, df.withColumn("x", F.lit(5.0)))
    assert sorted(r.x for r in reader.collect()) == [10.0, 20.0, 30.0]
    for k in range(3):
        tables.write_feature_table(spark, name, df.withColumn("x", F.lit(float(k))))
    assert len(commits.children(spark, f"{base}.snapshots")) == 2
    tables.append_rows(spark, name, df.withColumn("id", F.col("id") + 10))
    assert spark.table(name).count() == 6


@pytest.mark.parametrize("step", ["rows", "first rename", "second rename", "delete"])
def test_a_path_overwrite_that_fails_leaves_the_old_rows(spark, monkeypatch, step):
    path = scratch_dir(spark, "crash-path")
    files.write_parquet(spark.range(3), path)
    new = spark.read.parquet(path).withColumn("x", F.lit("n"))
    real, calls = files.commits.rename, []

    def nth(n):
        def run(*args):
            calls.append(args)
            return _fail() if len(calls) == n else real(*args)
        return run

    with monkeypatch.context() as m:
        if step == "rows":
            new = new.withColumn("x", F.when(F.col("id") == 1, F.raise_error(F.lit("no"))).otherwise(F.lit("n")))
        elif step == "delete":
            m.setattr(files.commits, "delete", _fail)
        else:
            m.setattr(files.commits, "rename", nth(1 if step == "first rename" else 2))
        with pytest.raises((Exception, Killed)):
            files.overwrite_with_schema(new, path)
    assert spark.read.parquet(path).columns == (["id", "x"] if step == "delete" else ["id"])
    assert spark.read.parquet(path).count() == 3
    files.overwrite_with_schema(spark.read.parquet(path).withColumn("z", F.lit(1)), path)
    assert spark.read.parquet(path).columns[-1] == "z" and not files.recover_path(spark, path)


def test_a_path_overwrite_killed_between_the_renames_is_undone(spark):
    from keelson.sinks import commits
    path = scratch_dir(spark, "killed-path")
    files.write_parquet(spark.range(3), path)
    commits.rename(spark, path, f"{path}.prev")
    assert files.recover_path(spark, path) and spark.read.parquet(path).count() == 3
