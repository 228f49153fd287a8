"""Dataset and model registry with lineage, kept as two tables.

``dataset_versions``: one row per registered version of a dataset: where it
is, its format, the datasets it was made from, its schema, the feature table
it feeds, the run that made it and when.
``model_versions``: one row per registered model version with the datasets
it was trained and tested on, by role.

Registration appends rows; versions are dense per name (previous maximum + 1,
then in registration order within a batch). Lineage questions are joins and
explodes over the two tables, so they are ordinary Spark jobs whatever the
registry grows to.

Writers may run at the same time: a batch is written to a folder of its own, which
nobody reads before the numbered commit file that names it (``sinks.commits``).
A writer whose number is taken assigns its versions again on what the others
committed, so versions stay distinct and dense.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, MapType, StringType, StructField, StructType,
                               TimestampNTZType)

from keelson.functions.text import name_version
from keelson.operators.rank import rank_within_groups
from keelson.session import checkpoint_root, stored
from keelson.sinks import commits

INPUT_T = StructType([StructField("name", StringType()), StructField("version", IntegerType())])
FIELD_T = StructType([StructField("name", StringType()), StructField("type", StringType())])
ROLE_T = StructType([StructField("role", StringType()), StructField("name", StringType()),
                     StructField("version", IntegerType())])

DATASET_SCHEMA = StructType([
    StructField("name", StringType(), False),
    StructField("version", IntegerType()),
    StructField("description", StringType()),
    StructField("format", StringType()),
    StructField("path", StringType()),
    StructField("inputs", ArrayType(INPUT_T)),
    StructField("fields", ArrayType(FIELD_T)),
    StructField("feature_table", StringType()),
    StructField("run_id", StringType()),
    StructField("registered_at", TimestampNTZType()),
    # How to read the files (header, separator, ...); null means the format's defaults.
    StructField("options", MapType(StringType(), StringType())),
])

MODEL_SCHEMA = StructType([
    StructField("name", StringType(), False),
    StructField("version", IntegerType()),
    StructField("description", StringType()),
    StructField("path", StringType()),
    StructField("datasets", ArrayType(ROLE_T)),
    StructField("run_id", StringType()),
    StructField("registered_at", TimestampNTZType()),
])

# Fixed role names of model datasets.
ROLE_DATA = "featurized data"
ROLE_TRAIN = "featurized training data"
ROLE_TEST = "featurized test data"


def schema_fields(schema: StructType) -> list[tuple[str, str]]:
    """(name, type) of every column of a frame's schema."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def empty_datasets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DATASET_SCHEMA)


def empty_models(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MODEL_SCHEMA)


def dataset_entry(spark: SparkSession, name: str, path: str, schema: StructType,
                  inputs: Sequence[tuple[str, int]] = (), description: str | None = None,
                  fmt: str = "parquet", feature_table: str | None = None,
                  run_id: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """One registration request (version still unassigned, time = now)."""
    row = (name, None, description if description is not None else f"{name} featurized data", fmt, path,
           [tuple(i) for i in inputs], schema_fields(schema), feature_table, run_id, None,
           dict(options) if options else None)
    return (spark.createDataFrame([row], DATASET_SCHEMA)
            .withColumn("registered_at", F.localtimestamp()))


def model_entry(spark: SparkSession, name: str, path: str, datasets: Sequence[tuple[str, str, int]],
                description: str | None = None, run_id: str | None = None) -> DataFrame:
    row = (name, None, description, path, [tuple(d) for d in datasets], run_id, None)
    return spark.createDataFrame([row], MODEL_SCHEMA).withColumn("registered_at", F.localtimestamp())


def assign_versions(registry: DataFrame, batch: DataFrame,
                    order_cols: Sequence[str] = ("registered_at",),
                    largest: int | None = None) -> DataFrame:
    """Give each new registration the next version of its name.

    version = (largest registered version of the name, or 0) + the request's
    rank among the batch's requests for that name, in ``order_cols`` order
    (remaining plain columns break ties). The rank is computed without a
    per-name window, so a name with a huge batch of registrations is spread
    over many tasks. ``largest`` (an upper bound on the requests per name in
    the batch) spares the size check when the caller knows it.
    """
    prior = registry.groupBy("name").agg(F.max("version").alias("__prior"))
    simple = [f.name for f in batch.schema.fields
              if f.name not in ("name", "version", *order_cols)
              and not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    ranked = rank_within_groups(batch.drop("version"), ["name"], [*order_cols, *simple], "__rank",
                                largest=largest)
    return (ranked.join(prior, "name", "left")
            .withColumn("version", (F.coalesce(F.col("__prior"), F.lit(0)) + F.col("__rank")).cast("int"))
            .drop("__prior", "__rank"))


def register(spark: SparkSession, registry_path: str, batch: DataFrame, schema: StructType,
             order_cols: Sequence[str] = ("registered_at",)) -> DataFrame:
    """Append a batch to the registry table at ``registry_path``, also beside other writers.

    Returns the registered rows (read back from what was written). After
    ``COMMIT_TRIES`` lost races it gives up and leaves nothing registered.
    """
    root = registry_path.rstrip("/")
    for attempt in range(COMMIT_TRIES):
        log = commits.read_log(spark, f"{root}/{LOG}")
        # Batches of a registry older than its log belong to the first commit.
        before = [] if log else [n for n in commits.children(spark, root) if n.startswith("batch=")]
        current = _committed(spark, root, log, schema) if log else _uncommitted(spark, root, schema)
        new = assign_versions(current, batch, order_cols).select(*schema.fieldNames())
        name = f"batch={uuid.uuid4().hex}"
        new.write.mode("errorifexists").parquet(f"{root}/{name}")
        if commits.commit(spark, f"{root}/{LOG}", len(log) + 1, {"batches": [*before, name]}):
            return spark.read.schema(schema).parquet(f"{root}/{name}")
        commits.delete(spark, f"{root}/{name}")
        time.sleep(random.uniform(0, 0.05 * 2 ** min(attempt, 6)))
    raise RuntimeError(f"{registry_path}: other writers were faster {COMMIT_TRIES} times")


# The log's folder, hidden from readers of the rows, and how often a writer tries.
LOG = "_commits"
COMMIT_TRIES = 50


def read_registry(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All committed registrations under ``path`` (empty before the first one)."""
    log = commits.read_log(spark, f"{path.rstrip('/')}/{LOG}")
    return _committed(spark, path.rstrip("/"), log, schema) if log else _uncommitted(spark, path, schema)


def _committed(spark: SparkSession, root: str, log: list[dict], schema: StructType) -> DataFrame:
    names = [b for entry in log for b in entry["batches"]]
    return spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in names])


def _uncommitted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A registry without a log: every file counts."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # Nothing registered yet.
        return spark.createDataFrame([], schema)


def latest_versions(registry: DataFrame) -> DataFrame:
    """Per name, the latest version and its registration row fields."""
    best = F.max_by(F.struct("version", "path", "format", "registered_at"), F.col("version"))
    return (registry.groupBy("name").agg(best.alias("__latest"))
            .select("name", F.col("__latest.version").alias("latest_version"),
                    F.col("__latest.path").alias("path"), F.col("__latest.format").alias("format"),
                    F.col("__latest.registered_at").alias("registered_at")))


def resolve_dataset(registry: DataFrame, name: str, version: int | None = None) -> Row:
    """One registry row for ``name`` (latest version unless given)."""
    rows = registry.where(F.col("name") == F.lit(name))
    if version is not None:
        rows = rows.where(F.col("version") == F.lit(version))
    hit = rows.select("version", "path", "format", "fields", "options").agg(
        F.max_by(F.struct("version", "path", "format", "fields", "options"), "version").alias("r")).first()["r"]
    if hit is None:
        raise KeyError(f"dataset {name!r} version {version} is not registered")
    return hit


def lineage_inputs(datasets: DataFrame) -> DataFrame:
    """D3: one row per (dataset version, input) with the "name: version" text."""
    return (datasets.select("name", "version", F.explode("inputs").alias("i"))
            .select("name", "version", F.col("i.name").alias("input_name"),
                    F.col("i.version").alias("input_version"),
                    name_version(F.col("i.name"), F.col("i.version")).alias("input_text")))


def field_rows(datasets: DataFrame) -> DataFrame:
    """D4 as rows: (name, version, position, field_name, field_type)."""
    return (datasets.select("name", "version", F.posexplode("fields").alias("position", "f"))
            .select("name", "version", F.col("position").cast("int").alias("position"),
                    F.col("f.name").alias("field_name"), F.col("f.type").alias("field_type")))


def _model_roles(models: DataFrame) -> DataFrame:
    return (models.select(F.col("name").alias("model_name"), F.col("version").alias("model_version"),
                          F.explode("datasets").alias("d"))
            .select("model_name", "model_version", F.col("d.role").alias("role"),
                    F.col("d.name").alias("dataset_name"), F.col("d.version").alias("dataset_version")))


# A dataset version named by more than this share of all roles is hot: there are
# at most 1 / HOT_SHARE of them, whatever the registry's size.
HOT_SHARE = 0.001
SALTS = 64


def _join_roles(roles: DataFrame, datasets: DataFrame, how: str) -> DataFrame:
    """Roles joined to dataset versions; roles of a hot version are spread by a salt.

    Every model of a project may carry the same test dataset: its roles would
    all meet in one task. The hot versions are found by a partial aggregate;
    their roles get one of ``SALTS`` salts and their registry rows all of them.
    """
    ref = ["dataset_name", "dataset_version"]
    checkpoint_root(roles.sparkSession)
    # Roles by dataset version: once, for the total and for the hot ones.
    named = roles.groupBy(*ref).agg(F.count(F.lit(1)).alias("__n")).checkpoint(eager=True)
    least = max((named.agg(F.sum("__n")).first()[0] or 0) * HOT_SHARE, SALTS)
    hot = named.filter(F.col("__n") > least).select(*[F.col(c).alias(f"__{c}") for c in ref])
    is_hot = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ref]

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), is_hot, "left").drop(*[f"__{c}" for c in ref])

    salted = marked(roles).withColumn("__salt", F.when(F.col("__hot"), F.pmod(
        F.xxhash64("model_name", "model_version", "role"), F.lit(SALTS))).otherwise(0).cast("int")).drop("__hot")
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = marked(datasets).withColumn("__salt", F.explode(
        F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0))))).drop("__hot")
    return salted.join(copies, [*ref, "__salt"], how).drop("__salt")


def model_datasets(models: DataFrame, datasets: DataFrame) -> DataFrame:
    """Model version -> its datasets by role -> their registry rows."""
    ds = datasets.select(F.col("name").alias("dataset_name"), F.col("version").alias("dataset_version"),
                         F.col("path").alias("dataset_path"), F.col("run_id").alias("dataset_run_id"))
    return _join_roles(_model_roles(models), ds, "left")


def dataset_models(models: DataFrame, datasets: DataFrame) -> DataFrame:
    """Dataset version -> the model versions that used it, and in which role."""
    ds = datasets.select(F.col("name").alias("dataset_name"), F.col("version").alias("dataset_version"))
    return _join_roles(_model_roles(models), ds, "inner").select(
        "dataset_name", "dataset_version", "model_name", "model_version", "role")


def model_lineage(models: DataFrame, datasets: DataFrame, role: str = ROLE_TRAIN) -> DataFrame:
    """Model -> dataset in ``role`` -> that dataset's inputs (depth 2)."""
    used = _model_roles(models).where(F.col("role") == F.lit(role))
    ins = lineage_inputs(datasets).select(F.col("name").alias("dataset_name"),
                                          F.col("version").alias("dataset_version"),
                                          "input_name", "input_version")
    return _join_roles(used, ins, "inner").drop("role")


# --- lineage to any depth ---------------------------------------------------------

_NODE = ("name", "version")


def _merged(lists: DataFrame, *key: str) -> DataFrame:
    """One list ``far`` per key: every (name, version) in any of its lists, once, with its least distance."""
    flat = lists.groupBy(*key).agg(F.sort_array(F.flatten(F.collect_list("far"))).alias("__all"))

    def first_of_its_name(x, i):
        before = F.get("__all", i - 1)
        return (i == 0) | ~(x["name"].eqNullSafe(before["name"]) & x["version"].eqNullSafe(before["version"]))

    return flat.select(*key, F.filter("__all", first_of_its_name).alias("far"))


def _further(far, more: int):
    return F.transform(far, lambda x: F.struct(x["name"].alias("name"), x["version"].alias("version"),
                                               (x["distance"] + F.lit(more)).alias("distance")))


def ancestor_lists(datasets: DataFrame) -> DataFrame:
    """Every ancestor of every dataset version that has one: ``name, version, far``, an array of (name, version, distance).

    Lists are doubled: a round appends the lists of the versions at the full reach so far, so the rounds
    grow with the logarithm of the longest lineage, and a path is made from its middle only. Ancestors travel
    as lists, as names that a lineage repeats then pack well, and a version without an ancestor at the
    full reach has all of them: it stays where it is written. ``distance`` is the shortest path. A version
    that is its own ancestor (a cycle, which a registry should not hold) ends the rounds all the same: it
    appears at most once for each descendant, and as an ancestor of itself, which ``lineage_cycles`` lists.
    """
    ends = [F.col(c).isNotNull() for c in ("name", "version", "input_name", "input_version")]
    edges = lineage_inputs(datasets).filter(ends[0] & ends[1] & ends[2] & ends[3])
    one = F.struct(F.col("input_name").alias("name"), F.col("input_version").alias("version"), F.lit(1).alias("distance"))
    lists = _merged(edges.select(*_NODE, F.array(one).alias("far")), *_NODE)
    settled, reach = None, 1
    while True:
        growing = stored(lists, "ancestors")
        known = growing if settled is None else settled.unionByName(growing)
        at_reach = F.filter("far", lambda x: x["distance"] == reach)
        last = growing.select(*_NODE, F.explode(at_reach).alias("end")).select(
            *_NODE, F.col("end.name").alias("via_name"), F.col("end.version").alias("via_version"))
        # Paths of the last round's full reach are new; without one, none can grow further.
        if last.isEmpty():
            return known
        tail = known.select(F.col("name").alias("via_name"), F.col("version").alias("via_version"), "far")
        longer = last.join(tail, ["via_name", "via_version"]).select(*_NODE, _further("far", reach).alias("far"))
        lists = _merged(growing.filter(F.size(at_reach) > 0).unionByName(longer), *_NODE)
        ended = growing.filter(F.size(at_reach) == 0)
        settled = ended if settled is None else settled.unionByName(ended)
        reach *= 2


def dataset_ancestors(datasets: DataFrame) -> DataFrame:
    """Every ancestor of every dataset version: ``name, version, ancestor_name, ancestor_version, distance``."""
    return ancestor_lists(datasets).select(*_NODE, F.explode("far").alias("a")).select(
        *_NODE, F.col("a.name").alias("ancestor_name"), F.col("a.version").alias("ancestor_version"), F.col("a.distance").alias("distance"))


def lineage_cycles(ancestors: DataFrame) -> DataFrame:
    """Dataset versions that are their own ancestors, with the length of the shortest cycle."""
    own = (F.col("name") == F.col("ancestor_name")) & (F.col("version") == F.col("ancestor_version"))
    return ancestors.filter(own).select("name", "version", F.col("distance").alias("length"))


def model_ancestors(models: DataFrame, datasets: DataFrame, role: str = ROLE_TRAIN) -> DataFrame:
    """D9 to any depth: every dataset version behind a model, the one it names at distance 1.

    Of several paths the shortest counts. A dataset on a cycle is not followed round it.
    """
    used = _model_roles(models).where(F.col("role") == F.lit(role))
    others = F.filter("far", lambda x: (x["name"] != F.col("name")) | (x["version"] != F.col("version")))
    far = ancestor_lists(datasets).select(F.col("name").alias("dataset_name"), F.col("version").alias("dataset_version"),
                                          _further(others, 1).alias("far"))
    near = F.array(F.struct(F.col("dataset_name").alias("name"), F.col("dataset_version").alias("version"), F.lit(1).alias("distance")))
    model = ["model_name", "model_version"]
    behind = _join_roles(used, far, "left").select(
        *model, F.when(F.col("far").isNull(), near).otherwise(F.concat(near, F.col("far"))).alias("far"))
    # Lists of a model with one training set are whole and distinct as they are.
    if not used.groupBy(*model).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        behind = _merged(behind, *model)
    return behind.select(*model, F.explode("far").alias("a")).select(
        *model, F.col("a.name").alias("ancestor_name"), F.col("a.version").alias("ancestor_version"), F.col("a.distance").alias("distance"))
