"""End-to-end jobs: the reference's flows as single Spark applications.

* ``featurize``: feature sets -> union -> clean (recode, drop, mean-impute)
  -> row ids -> Parquet -> dataset version (+ feature table).
* ``featurize_split``: the same, then an exact stratified split written as a
  train/test pair, both registered.
* ``prepare_base_tables``: schema + typed tables of synthetic customers,
  networks and ground truth; the two feature tables get their keys.
* ``lookup_split``: ground truth + feature lookups -> training set -> hashed
  split written as a pair, both registered.
* ``train``: registered training set -> scalers fitted on it -> logistic
  regression -> saved model -> model version linked to its dataset.
* ``select``: hashed k-fold model selection over a grid -> metrics table +
  best model, registered with its train/test datasets.

Each job reads and writes through the DataFrame API only; the driver handles
paths, schemas and a few fitted numbers. Run ``python -m keelson.plans.jobs
<job> --help``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import clean, model, profile, registry, rowid, scale, split
from keelson.operators.lookup import FeatureLookup, training_set
from keelson.session import checkpoint_root, get_session
from keelson.sinks import files as sinks
from keelson.sinks import tables
from keelson.sources import synth
from keelson.sources.catalog import scan_registered
from keelson.sources.files import scan_parquet, spread

DATASETS = "dataset_versions"
MODELS = "model_versions"


def _registry_paths(registry_root: str) -> tuple[str, str]:
    root = registry_root.rstrip("/")
    return f"{root}/{DATASETS}", f"{root}/{MODELS}"


def register_dataset(spark: SparkSession, registry_root: str, name: str, path: str, df: DataFrame,
                     inputs: Sequence[tuple[str, int]], run_id: str | None,
                     feature_table: str | None = None, fmt: str = "parquet",
                     options: Mapping[str, str] | None = None) -> int:
    ds_path, _ = _registry_paths(registry_root)
    entry = registry.dataset_entry(spark, name, path, df.schema, inputs, fmt=fmt, feature_table=feature_table,
                                   run_id=run_id, options=options)
    return registry.register(spark, ds_path, entry, registry.DATASET_SCHEMA).first()["version"]


def _table_stamp(spark: SparkSession, location: str | None) -> str:
    """Changes when the files of a table do: their number, bytes and the folder's time."""
    if not location:
        return ""
    at = spark._jvm.org.apache.hadoop.fs.Path(location)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(at)
    return f"{size.getFileCount()} files, {size.getLength()} bytes, {fs.getFileStatus(at).getModificationTime()}"


def table_version(spark: SparkSession, registry_root: str, table: str, run_id: str | None = None) -> int:
    """Registered version of a catalog table as it is now.

    Lineage then names every input with a real version: a table is registered
    on first use, and again once its files have changed.
    """
    ds_path, _ = _registry_paths(registry_root)
    reg = registry.read_registry(spark, ds_path, registry.DATASET_SCHEMA)
    location = tables.table_location(spark, table)
    stamp = _table_stamp(spark, location)
    try:
        entry = registry.resolve_dataset(reg, table)
        if (entry["options"] or {}).get("stamp") == stamp:
            return entry["version"]
    except KeyError:
        pass
    return register_dataset(spark, registry_root, table, location or table, spark.table(table), [], run_id,
                            options={"stamp": stamp})


def resolve_inputs(spark: SparkSession, registry_root: str, names: Sequence[str]) -> list[tuple[str, int, DataFrame]]:
    """Latest version of each registered input, with its rows (lazy)."""
    ds_path, _ = _registry_paths(registry_root)
    reg = registry.read_registry(spark, ds_path, registry.DATASET_SCHEMA)
    out = []
    for n in names:
        entry = registry.resolve_dataset(reg, n)
        out.append((n, entry["version"], scan_registered(spark, reg, n, entry["version"])))
    return out


def featurize(spark: SparkSession, frames: Sequence[DataFrame], recode: Mapping[str, Mapping[str, int]],
              drop: Sequence[str], impute: Sequence[str], id_col: str = "id",
              unique_fast_path: bool = False) -> DataFrame:
    """Union -> clean -> row ids (the featurize step)."""
    union = clean.union_by_name(list(frames))
    cleaned = clean.clean_features(union, recode=recode, drop=drop, impute=impute)
    return rowid.add_row_id(cleaned, id_col, unique_fast_path=unique_fast_path)


def write_feature_table(spark: SparkSession, name: str, df: DataFrame, key: str, description: str) -> None:
    """Create the feature table if needed, then write it (key checked)."""
    schema, _ = name.split(".", 1) if "." in name else ("default", name)
    tables.create_schema(spark, schema)
    if not spark.catalog.tableExists(name):
        tables.create_feature_table(spark, name, key, df.schema, description)
    tables.write_feature_table(spark, name, df)


def run_featurize(spark: SparkSession, inputs: Sequence[str], output: str, registry_root: str, name: str,
                  recode: Mapping[str, Mapping[str, int]], drop: Sequence[str], impute: Sequence[str],
                  run_id: str | None = None, feature_table: str | None = None,
                  unique_fast_path: bool = False, fmt: str = "parquet", mode: str = "errorifexists") -> dict:
    """Featurize registered inputs; ``mode="overwrite"`` replaces the output, schema included."""
    resolved = resolve_inputs(spark, registry_root, inputs)
    feats = featurize(spark, [df for _, _, df in resolved], recode, drop, impute,
                      unique_fast_path=unique_fast_path)
    if mode == "overwrite":
        sinks.overwrite_with_schema(feats, output, fmt=fmt)
    else:
        sinks.write_parquet(feats, output, mode=mode, fmt=fmt)
    written = scan_parquet(spark, output, fmt=fmt)
    shapes = _shapes({n: df for n, _, df in resolved} | {name: written})
    if mode != "append" and shapes[name][0] != sum(shapes[n][0] for n in dict.fromkeys(inputs)):
        raise RuntimeError(f"the union did not keep every row: {shapes}")
    version = register_dataset(spark, registry_root, name, output, written,
                               [(n, v) for n, v, _ in resolved], run_id, feature_table, fmt=fmt)
    if feature_table:
        write_feature_table(spark, feature_table, written, "id", f"{name} featurized data")
    return {"name": name, "version": version, "path": output, "shapes": shapes}


def _shapes(frames: Mapping[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """A3: (rows, columns) of every frame, in one job."""
    rows = {r["frame"]: (r["n_rows"], r["n_cols"]) for r in profile.shape_profile(frames).collect()}
    return {n: rows[n] for n in frames}


def run_featurize_split(spark: SparkSession, inputs: Sequence[str], output: str, registry_root: str,
                        names: tuple[str, str], recode: Mapping[str, Mapping[str, int]], drop: Sequence[str],
                        impute: Sequence[str], label: str, test_fraction: float = 0.2, seed: int = 42,
                        run_id: str | None = None, fit_on: str = "train", fmt: str = "parquet",
                        mode: str = "errorifexists", feature_tables: tuple[str, str] | None = None) -> dict:
    """Featurize, then an exact stratified split written in one pass.

    ``feature_tables`` names a feature table (key ``id``) for each side.

    ``fit_on="train"`` (default) fits the imputation means on the training
    side only and applies them to both sides, so nothing about the test rows
    leaks into the features; ``fit_on="all"`` fits them on every row before
    the split, as the original flow did.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    resolved = resolve_inputs(spark, registry_root, inputs)
    if fit_on == "all":
        feats = featurize(spark, [df for _, _, df in resolved], recode, drop, impute)
        parts = split.stratified_split(feats, label, "id", test_fraction, seed)
    else:
        union = clean.union_by_name([df for _, _, df in resolved])
        coded = rowid.add_row_id(clean.clean_features(union, recode=recode, drop=drop))
        parts = split.stratified_split(coded, label, "id", test_fraction, seed)
        if impute:
            # The split feeds the fit and the write: materialise it once.
            checkpoint_root(spark)
            parts = parts.checkpoint(eager=True)
            means = clean.fit_means(parts.where(F.col("split") == "train"), impute)
            parts = clean.impute_mean(parts, impute, means)
    paths = sinks.write_split(parts, output, fmt=fmt, mode=mode)
    out = {}
    for i, (side, ds_name) in enumerate(zip(("train", "test"), names)):
        df = scan_parquet(spark, paths[side], fmt=fmt)
        table = feature_tables[i] if feature_tables else None
        if table:
            write_feature_table(spark, table, df, "id", f"{ds_name} featurized data")
        v = register_dataset(spark, registry_root, ds_name, paths[side], df,
                             [(n, v) for n, v, _ in resolved], run_id, table, fmt=fmt)
        out[side] = {"name": ds_name, "version": v, "path": paths[side]}
    return out


def prepare_base_tables(spark: SparkSession, schema: str, n_customers: int = 1000, n_networks: int = 1000,
                        n_ground_truth: int = 1000, seed: int = 42, ground_truth: str = "ground_truth") -> None:
    """Typed tables of synthetic rows; customers and network become feature tables."""
    tables.create_schema(spark, schema)
    cust = synth.synth_range(spark, n_customers, "id", {"age": synth.UniformInt(20, 100),
                                                          "salary": synth.Stepped(10000, 1, 19)}, seed)
    net = synth.synth_range(spark, n_networks, "network_id", {"failure": synth.Coin()}, seed)
    gt = synth.synth_range(spark, n_ground_truth, "gt_id", {
        "customer": synth.UniformInt(0, n_customers - 1),
        "network": synth.UniformInt(0, n_networks - 1),
        "label": synth.Coin()}, seed).drop("gt_id")
    ddl = {"customers": ("id INT, age INT, salary INT", cust.select(F.col("id").cast("int"), "age", "salary")),
           "network": ("network_id INT, failure BOOLEAN",
                       net.select(F.col("network_id").cast("int"), "failure")),
           ground_truth: ("customer INT, network INT, label BOOLEAN", gt)}
    for tname, (cols, df) in ddl.items():
        full = f"{schema}.{tname}"
        tables.drop_table(spark, full)
        tables.create_table(spark, full, cols)
        tables.append_rows(spark, full, df)
    tables.register_feature_table(spark, f"{schema}.customers", "id", "Customer features")
    tables.register_feature_table(spark, f"{schema}.network", "network_id", "Network features")


def run_lookup_split(spark: SparkSession, schema: str, output: str, registry_root: str,
                     names: tuple[str, str], ground_truth: str = "ground_truth",
                     weights: tuple[float, float] = (0.8, 0.2), seed: int = 42,
                     run_id: str | None = None) -> dict:
    """Ground truth + lookups -> training set -> hashed split -> pair -> registrations."""
    base = spark.table(f"{schema}.{ground_truth}")
    lookups = [FeatureLookup(f"{schema}.network", ["failure"], "network"),
               FeatureLookup(f"{schema}.customers", ["salary", "age"], "customer")]
    ts = training_set(base, lookups, label="label")
    # Equal rows get ids of their own, so every row falls on a side by itself.
    parts = split.hash_split(rowid.add_row_id(ts, "id"), "id", weights, seed=seed)
    paths = sinks.write_split(parts, output)
    inputs = [(t, table_version(spark, registry_root, t, run_id))
              for t in (f"{schema}.network", f"{schema}.customers", f"{schema}.{ground_truth}")]
    out: dict = {}
    sides = {side: spark.read.parquet(paths[side]) for side in ("train", "test")}
    # A2: sizes of the base, the training set and both sides. The training set
    # is counted from what was written, so the lookups do not run again.
    counts = {r["frame"]: r["n_rows"] for r in profile.row_counts({"ground_truth": base, **sides}).collect()}
    counts["training_set"] = counts["train"] + counts["test"]
    if counts["training_set"] != counts["ground_truth"]:
        raise RuntimeError(f"lookups changed the row count: {counts}")
    for side, ds_name in zip(("train", "test"), names):
        v = register_dataset(spark, registry_root, ds_name, paths[side], sides[side], inputs, run_id)
        out[side] = {"name": ds_name, "version": v, "path": paths[side]}
    out["rows"] = counts
    return out


def _numeric_features(df: DataFrame, label: str, exclude: Sequence[str]) -> list[str]:
    from pyspark.sql.types import BooleanType, NumericType
    return [f.name for f in df.schema.fields if f.name not in set(exclude) | {label}
            and isinstance(f.dataType, (NumericType, BooleanType))]


def run_train(spark: SparkSession, registry_root: str, dataset: str, label: str, model_name: str,
              model_path: str, exclude: Sequence[str] = ("id",), run_id: str | None = None) -> dict:
    """Scale (both scalers, fitted on the training rows) -> logistic regression -> register."""
    (name, version, df), = resolve_inputs(spark, registry_root, [dataset])
    feats = _numeric_features(df, label, exclude)
    df = spread(df.select(*feats, label).withColumns({f: F.col(f).cast("double") for f in feats}))
    faults = profile.input_faults(profile.validate_input(df, label), label)
    if faults:
        raise ValueError("; ".join(faults))
    stats = scale.fit_scaler(df, feats)
    matrix = scale.scaled_feature_matrix(df, feats, stats, passthrough=[label])
    cols = [c for c in matrix.columns if c != label]
    fitted = model.fit_logreg(matrix, cols, label)
    model.save_model(fitted, model_path)
    _, models_path = _registry_paths(registry_root)
    entry = registry.model_entry(spark, model_name, model_path, [(registry.ROLE_DATA, name, version)],
                                 description="logistic regression", run_id=run_id)
    mv = registry.register(spark, models_path, entry, registry.MODEL_SCHEMA).first()["version"]
    return {"model": model_name, "version": mv, "coefficients": model.coefficients(fitted, cols)}


def run_select(spark: SparkSession, registry_root: str, train_ds: str, test_ds: str, label: str,
               key: str, model_name: str, model_path: str, metrics_path: str,
               grid: Sequence[Mapping[str, float]], folds: int = 5, exclude: Sequence[str] = ("id",),
               run_id: str | None = None) -> dict:
    """k-fold selection on the training set, AUC on the test set, register."""
    (tn, tv, train), (sn, sv, test) = resolve_inputs(spark, registry_root, [train_ds, test_ds])
    feats = _numeric_features(train, label, list(exclude) + [key])
    train = spread(train.withColumns({f: F.col(f).cast("double") for f in feats}))
    test = test.withColumns({f: F.col(f).cast("double") for f in feats})
    stats = scale.fit_scaler(train, feats)
    keep = [key, label]
    tm = scale.scaled_feature_matrix(train, feats, stats, passthrough=keep)
    sm = scale.scaled_feature_matrix(test, feats, stats, passthrough=keep)
    cols = [c for c in tm.columns if c not in keep]
    best, metrics = model.cross_validate(tm, cols, label, key, grid, folds)
    test_auc = model.area_under_roc(model.score(best, sm, keep=[label]), label)
    metrics.withColumn("test_auc", F.when(F.col("best"), F.lit(test_auc))).write.parquet(metrics_path)
    model.save_model(best, model_path)
    _, models_path = _registry_paths(registry_root)
    entry = registry.model_entry(spark, model_name, model_path,
                                 [(registry.ROLE_TRAIN, tn, tv), (registry.ROLE_TEST, sn, sv)],
                                 description="cross-validated logistic regression", run_id=run_id)
    mv = registry.register(spark, models_path, entry, registry.MODEL_SCHEMA).first()["version"]
    return {"model": model_name, "version": mv, "test_auc": test_auc}


def register_source(spark: SparkSession, registry_root: str, name: str, path: str, fmt: str = "parquet",
                    run_id: str | None = None, schema: str | None = None,
                    options: Mapping[str, str] | None = None) -> int:
    """Register an existing folder (any installed format) as a dataset version.

    ``schema`` (DDL) declares the columns; without it a text format is inferred
    here, once, and the columns found are recorded. ``options`` (header,
    separator, ...) are recorded and used by every later read.
    """
    options = dict(options or {})
    reader = spark.read.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return register_dataset(spark, registry_root, name, path, reader.load(path), [], run_id, fmt=fmt, options=options)


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="keelson.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    reg = sub.add_parser("register")
    reg.add_argument("--name", required=True)
    reg.add_argument("--path", required=True)
    reg.add_argument("--format", default="parquet")
    reg.add_argument("--schema", dest="columns", help="DDL of the columns; without it a CSV is inferred once")
    reg.add_argument("--option", action="append", default=[], help="read option, e.g. header=true")
    fz = sub.add_parser("featurize")
    fz.add_argument("--input", action="append", required=True)
    fz.add_argument("--output", required=True)
    fz.add_argument("--name", required=True)
    fz.add_argument("--feature-table")
    fz.add_argument("--unique-fast-path", action="store_true",
                    help="hash pre-pass: unique rows get their id without a full-row shuffle")
    fs = sub.add_parser("featurize_split")
    fs.add_argument("--input", action="append", required=True)
    fs.add_argument("--output", required=True)
    fs.add_argument("--names", nargs=2, required=True)
    fs.add_argument("--label", required=True)
    fs.add_argument("--fit-on", choices=("train", "all"), default="train")
    fs.add_argument("--feature-tables", nargs=2)
    for p in (fz, fs):
        p.add_argument("--format", default="parquet")
        p.add_argument("--mode", default="errorifexists", choices=("errorifexists", "overwrite"))
        p.add_argument("--recode", default="{}", help='JSON: {"Sex": {"male": 0, "female": 1}}')
        p.add_argument("--drop", default="")
        p.add_argument("--impute", default="")
    pb = sub.add_parser("prepare_base_tables")
    pb.add_argument("--schema", required=True)
    pb.add_argument("--rows", type=int, default=1000)
    ls = sub.add_parser("lookup_split")
    ls.add_argument("--schema", required=True)
    ls.add_argument("--output", required=True)
    ls.add_argument("--names", nargs=2, required=True)
    tr = sub.add_parser("train")
    tr.add_argument("--dataset", required=True)
    tr.add_argument("--label", required=True)
    tr.add_argument("--model-name", required=True)
    tr.add_argument("--model-path", required=True)
    se = sub.add_parser("select")
    se.add_argument("--train", required=True)
    se.add_argument("--test", required=True)
    se.add_argument("--label", required=True)
    se.add_argument("--key", required=True)
    se.add_argument("--model-name", required=True)
    se.add_argument("--model-path", required=True)
    se.add_argument("--metrics-path", required=True)
    se.add_argument("--grid", default='[{"regParam": 0.001}, {"regParam": 0.1}]')
    se.add_argument("--folds", type=int, default=5)
    for p in sub.choices.values():
        p.add_argument("--registry", default=None)
        p.add_argument("--run-id", default=None)
    a = ap.parse_args(argv)
    spark = get_session()
    if a.job == "prepare_base_tables":
        prepare_base_tables(spark, a.schema, a.rows, a.rows, a.rows)
        print(json.dumps({"schema": a.schema}))
        return
    if not a.registry:
        ap.error("--registry is required")
    if a.job == "register":
        out = {"version": register_source(spark, a.registry, a.name, a.path, a.format, a.run_id, a.columns,
                                          dict(o.split("=", 1) for o in a.option))}
    elif a.job == "featurize":
        out = run_featurize(spark, a.input, a.output, a.registry, a.name, json.loads(a.recode),
                            [c for c in a.drop.split(",") if c], [c for c in a.impute.split(",") if c],
                            a.run_id, a.feature_table, a.unique_fast_path, a.format, a.mode)
    elif a.job == "featurize_split":
        out = run_featurize_split(spark, a.input, a.output, a.registry, tuple(a.names), json.loads(a.recode),
                                  [c for c in a.drop.split(",") if c], [c for c in a.impute.split(",") if c],
                                  a.label, run_id=a.run_id, fit_on=a.fit_on, fmt=a.format, mode=a.mode,
                                  feature_tables=tuple(a.feature_tables) if a.feature_tables else None)
    elif a.job == "lookup_split":
        out = run_lookup_split(spark, a.schema, a.output, a.registry, tuple(a.names), run_id=a.run_id)
    elif a.job == "select":
        out = run_select(spark, a.registry, a.train, a.test, a.label, a.key, a.model_name, a.model_path,
                         a.metrics_path, json.loads(a.grid), a.folds, run_id=a.run_id)
    else:
        out = run_train(spark, a.registry, a.dataset, a.label, a.model_name, a.model_path, run_id=a.run_id)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
