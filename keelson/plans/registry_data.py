"""Registry contents derived from ``orders``, for the lineage queries.

Each order stands for one registration of the dataset ``cust_<o_custkey>``
made at ``o_orderdate``, and registers a
model version ``model_<o_custkey>`` trained on that dataset version. The
registry therefore grows with the data, and the lineage queries are real
joins over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import registry as reg
from keelson.session import stored

ORDERS_FIELDS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
                 ("o_orderpriority", "string")]
# Registrations before this date form the registry's first batch.
FIRST_BATCH_BEFORE = "1995-06-17"


def dataset_requests(orders: DataFrame) -> DataFrame:
    name = F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))
    fields = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in ORDERS_FIELDS])
    return orders.select(
        name.alias("name"), F.lit(None).cast("int").alias("version"),
        F.concat(name, F.lit(" featurized data")).alias("description"),
        F.lit("parquet").alias("format"),
        F.concat(F.lit("/datasets/"), name, F.lit("/"), F.col("o_orderkey").cast("string")).alias("path"),
        F.array().cast(reg.DATASET_SCHEMA["inputs"].dataType).alias("inputs"),
        fields.alias("fields"),
        F.concat(F.lit("features."), name).alias("feature_table"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderdate").alias("registered_at"),
        "o_orderkey", "o_orderstatus", "o_custkey")


def with_inputs(versions: DataFrame) -> DataFrame:
    """Inputs: the orders table, and the dataset's previous version if any."""
    base = F.struct(F.lit("orders").alias("name"), F.lit(1).alias("version"))
    prev = F.struct(F.col("name").alias("name"), (F.col("version") - 1).alias("version"))
    return versions.withColumn("inputs", F.when(F.col("version") > 1, F.array(base, prev))
                               .otherwise(F.array(base)))


def most_orders_per_customer(orders: DataFrame) -> int:
    """Upper bound on registrations per name in any batch (one aggregate)."""
    return orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def registered_datasets(orders: DataFrame, largest: int | None = None) -> DataFrame:
    """D1 in two batches: everything before the cut date, then the rest."""
    req = dataset_requests(orders)
    order = ("registered_at", "o_orderkey")
    first = stored(reg.assign_versions(reg.empty_datasets(orders.sparkSession),
                                       req.where(F.col("registered_at") < F.lit(FIRST_BATCH_BEFORE)), order,
                                       largest), "registry-first")
    second = reg.assign_versions(first, req.where(F.col("registered_at") >= F.lit(FIRST_BATCH_BEFORE)),
                                 order, largest)
    return with_inputs(first.unionByName(second))


def registered_models(datasets: DataFrame, largest: int | None = None) -> DataFrame:
    """One model version per order, trained on that dataset version."""
    name = F.concat(F.lit("model_"), F.col("o_custkey").cast("string"))
    roles = F.array(
        F.struct(F.lit(reg.ROLE_TRAIN).alias("role"), F.col("name").alias("name"), F.col("version").alias("version")),
        F.struct(F.lit(reg.ROLE_TEST).alias("role"), F.lit("orders").alias("name"), F.lit(1).alias("version")))
    req = datasets.select(name.alias("name"), F.lit(None).cast("int").alias("version"),
                      F.lit("classification model").alias("description"),
                      F.concat(F.lit("/models/"), name, F.lit("/"), F.col("o_orderkey").cast("string")).alias("path"),
                      roles.alias("datasets"), F.col("run_id"), F.col("registered_at"), "o_orderkey")
    return reg.assign_versions(reg.empty_models(datasets.sparkSession), req, ("registered_at", "o_orderkey"),
                               largest)
