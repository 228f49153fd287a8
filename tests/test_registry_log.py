"""Registration by several writers, lineage to any depth."""

import json
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from keelson.operators import registry as reg
from keelson.session import scratch_dir
from keelson.sinks import commits

ROOT = Path(__file__).resolve().parent.parent


def _entry(spark, name, run):
    return reg.dataset_entry(spark, name, f"/p/{run}", spark.range(1).schema, run_id=run)


def test_put_if_absent_is_won_once(spark):
    path = f"{scratch_dir(spark, 'log')}/0000000001.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: commits.put_if_absent(spark, path, json.dumps({"k": k})), range(24)))
    assert sum(won) == 1
    assert commits.read_log(spark, path.rsplit("/", 1)[0]) == [{"k": won.index(True)}]
    assert commits.children(spark, path.rsplit("/", 1)[0]) == ["0000000001.json"]


def test_writers_at_the_same_time_get_dense_versions(spark):
    path = scratch_dir(spark, "shared-registry")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: reg.register(spark, path, _entry(spark, "feat", f"r{k}"), reg.DATASET_SCHEMA).first()["version"], range(8)))
    assert sorted(got) == list(range(1, 9))
    rows = reg.read_registry(spark, path, reg.DATASET_SCHEMA).collect()
    assert sorted((r.version, r.run_id) for r in rows) == sorted((v, f"r{k}") for k, v in enumerate(got))


WRITER = """
import sys
sys.path.insert(0, {root!r})
from keelson.session import get_session
from keelson.operators import registry as reg
spark = get_session("local[1]", shuffle_partitions=2)
for k in range(3):
    e = reg.dataset_entry(spark, "feat", "/p", spark.range(1).schema, run_id=sys.argv[1] + str(k))
    reg.register(spark, {path!r}, e, reg.DATASET_SCHEMA)
"""


def test_two_processes_register_one_name(spark):
    path = scratch_dir(spark, "two-processes")
    code = WRITER.format(root=str(ROOT), path=path)
    runs = [subprocess.Popen([sys.executable, "-c", code, who], stderr=subprocess.DEVNULL) for who in "ab"]
    assert [r.wait(timeout=300) for r in runs] == [0, 0]
    rows = reg.read_registry(spark, path, reg.DATASET_SCHEMA).collect()
    assert sorted(r.version for r in rows) == [1, 2, 3, 4, 5, 6]
    assert {r.run_id for r in rows} == {f"{w}{k}" for w in "ab" for k in range(3)}


def test_lost_race_and_unfinished_writer(spark, monkeypatch):
    path = scratch_dir(spark, "raced")
    reg.register(spark, path, _entry(spark, "feat", "first"), reg.DATASET_SCHEMA)
    # A batch without its commit (its writer died) is not registered.
    _entry(spark, "feat", "dead").selectExpr("* except (version)", "2 as version").select(*reg.DATASET_SCHEMA.fieldNames()).write.parquet(f"{path}/batch=dead")
    assert [r.run_id for r in reg.read_registry(spark, path, reg.DATASET_SCHEMA).collect()] == ["first"]
    real, lost = commits.commit, []

    def race(spark_, folder, number, entry):
        if not lost:
            lost.append(number)
            monkeypatch.setattr(commits, "commit", real)
            reg.register(spark, path, _entry(spark, "feat", "faster"), reg.DATASET_SCHEMA)
        return real(spark_, folder, number, entry)

    monkeypatch.setattr(commits, "commit", race)
    assert reg.register(spark, path, _entry(spark, "feat", "slower"), reg.DATASET_SCHEMA).first()["version"] == 3
    assert sorted((r.version, r.run_id) for r in reg.read_registry(spark, path, reg.DATASET_SCHEMA).collect()) == [(1, "first"), (2, "faster"), (3, "slower")]
    monkeypatch.setattr(commits, "commit", lambda *a: False)
    monkeypatch.setattr(reg, "COMMIT_TRIES", 2)
    with pytest.raises(RuntimeError, match="other writers"):
        reg.register(spark, path, _entry(spark, "feat", "never"), reg.DATASET_SCHEMA)


def test_registry_without_a_log_is_taken_over(spark):
    path = scratch_dir(spark, "older")
    old = _entry(spark, "feat", "old").selectExpr("* except (version)", "1 as version").select(*reg.DATASET_SCHEMA.fieldNames())
    old.write.parquet(f"{path}/batch=old")
    assert reg.read_registry(spark, path, reg.DATASET_SCHEMA).count() == 1
    assert reg.register(spark, path, _entry(spark, "feat", "new"), reg.DATASET_SCHEMA).first()["version"] == 2
    assert sorted(r.run_id for r in reg.read_registry(spark, path, reg.DATASET_SCHEMA).collect()) == ["new", "old"]


def _datasets(spark, edges):
    nodes = {}
    for a, b in edges:
        nodes.setdefault(a, []).append(b)
        nodes.setdefault(b, [])
    rows = [(n, 1, [(b, 1) for b in ins]) for n, ins in nodes.items()]
    return spark.createDataFrame(rows, "name string, version int, inputs array<struct<name:string,version:int>>")


def test_ancestors_of_any_depth_and_shortest_paths(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(21)]
    ds = _datasets(spark, [*chain, ("c0", "c5"), ("x", "c20"), ("x", "c20")])
    got = {(r.name, r.ancestor_name): r.distance for r in reg.dataset_ancestors(ds).collect()}
    dist = {(f"c{i}", f"c{j}"): j - i for i in range(22) for j in range(i + 1, 22)}
    dist |= {("c0", f"c{j}"): j - 4 for j in range(5, 22)} | {("x", "c20"): 1, ("x", "c21"): 2}
    assert got == dist and reg.lineage_cycles(reg.dataset_ancestors(ds)).isEmpty()
    models = spark.createDataFrame([("m", 1, [(reg.ROLE_TRAIN, "c0", 1), (reg.ROLE_TEST, "x", 1)]), ("k", 2, [(reg.ROLE_TRAIN, "gone", 1)])],
                                   "name string, version int, datasets array<struct<role:string,name:string,version:int>>")
    behind = {(r.model_name, r.ancestor_name): r.distance for r in reg.model_ancestors(models, ds).collect()}
    assert behind == {("m", "c0"): 1, ("k", "gone"): 1} | {("m", b): d + 1 for (a, b), d in dist.items() if a == "c0"}


def test_cycles_are_reported_and_not_followed(spark):
    ds = _datasets(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("s", "s")])
    far = reg.dataset_ancestors(ds)
    assert {(r.name, r.length) for r in reg.lineage_cycles(far).collect()} == {("a", 3), ("b", 3), ("c", 3), ("s", 1)}
    models = spark.createDataFrame([("m", 1, [(reg.ROLE_TRAIN, "a", 1)])], "name string, version int, datasets array<struct<role:string,name:string,version:int>>")
    assert {(r.ancestor_name, r.distance) for r in reg.model_ancestors(models, ds).collect()} == {("a", 1), ("b", 2), ("c", 3), ("d", 4)}
    assert reg.dataset_ancestors(ds.limit(0)).isEmpty()


def test_lineage_of_a_training_set_that_a_third_of_all_models_share(spark):
    n = 300
    ds = _datasets(spark, [("shared", "raw"), *[(f"d{i}", "raw") for i in range(n)]])
    models = spark.range(n).selectExpr("concat('m', id) as name", "1 as version", f"""array(named_struct('role', '{reg.ROLE_TRAIN}',
        'name', if(id % 3 = 0, 'shared', concat('d', id)), 'version', 1)) as datasets""")
    lineage = reg.model_lineage(models, ds)
    assert lineage.count() == n and {r.input_name for r in lineage.collect()} == {"raw"}
    assert "__salt" in lineage._jdf.queryExecution().optimizedPlan().toString()


def test_ancestors_shuffle_lists_and_leave_finished_versions_alone(spark, monkeypatch):
    # A chain of 9 beside many short ones: only what still grows is written again.
    ds = _datasets(spark, [*[(f"c{i}", f"c{i + 1}") for i in range(9)], *[(f"s{i}", "raw") for i in range(40)]])
    rows, stored = [], reg.stored
    monkeypatch.setattr(reg, "stored", lambda df, label: rows.append(df.count()) or stored(df, label))
    far = {(r.name, a.name): a.distance for r in reg.ancestor_lists(ds).collect() for a in r.far}
    assert far == {(f"c{i}", f"c{j}"): j - i for i in range(10) for j in range(i + 1, 10)} | {(f"s{i}", "raw"): 1 for i in range(40)}
    assert rows[0] == 49 and rows[1] == 49 and max(rows[2:]) <= 8


def test_ancestors_of_models_with_several_training_sets_and_repeated_rows(spark):
    ds = _datasets(spark, [("a", "b"), ("b", "c"), ("d", "c"), ("d", "e")])
    kind = "name string, version int, datasets array<struct<role:string,name:string,version:int>>"
    train = reg.ROLE_TRAIN
    models = spark.createDataFrame([("m", 1, [(train, "a", 1), (train, "d", 1)]), ("m", 1, [(train, "c", 1)]), (None, 2, [(train, None, 1)])], kind)
    got = sorted((str(r.model_name), str(r.ancestor_name), r.distance) for r in reg.model_ancestors(models, ds).collect())
    assert got == [("None", "None", 1), ("m", "a", 1), ("m", "b", 2), ("m", "c", 1), ("m", "d", 1), ("m", "e", 2)]
