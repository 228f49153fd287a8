"""File scans (S1 delimited files, S2 Parquet, S3 other table formats).

All scans are lazy: column pruning and filters written after the scan reach
the reader (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def scan_parquet(spark: SparkSession, path: str, fmt: str = "parquet",
                 columns: list[str] | None = None) -> DataFrame:
    """Scan a directory, file or glob of a columnar format.

    ``fmt`` names any installed data source (``parquet``, ``orc``, ``delta``
    when its package is on the classpath); Parquet is the default.
    """
    reader = spark.read.format(fmt)
    df = reader.load(path)
    return df.select(*columns) if columns else df


def scan_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet scan whose plain counts, minima and maxima come from the files' footers.

    The newer reader pushes ``count``, and ``min`` and ``max`` of numbers and dates, of a whole table into
    the scan when ``spark.sql.parquet.aggregatePushdown`` is set (here, for the session: other
    readers do not look at it), so no column data is read. Any other use of the frame is an ordinary scan.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    classic = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in classic.split(",") if s.strip().lower() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", classic)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Rebalance a scan that yields fewer tasks than the cluster has cores.

    A Parquet file splits only at row-group boundaries, so a small table
    written as one row group scans as one task and every narrow step after
    it (hashing, broadcast lookups, projections) runs on one core. When the
    scan has fewer partitions than ``spark.default.parallelism``, rows are
    spread round-robin over that many partitions (one small shuffle). A large
    input already has more scan partitions than cores, so for it this is a
    no-op and adds no shuffle. Worth it only before CPU-heavy or repeated work
    (an iterative fit); for one cheap pass the shuffle costs more than it saves.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def read_table(spark: SparkSession, root: str, name: str, rebalance: bool = False) -> DataFrame:
    df = spark.read.parquet(table_path(root, name))
    return spread(df) if rebalance else df


def scan_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, sep: str = ",", null_value: str = "") -> DataFrame:
    """Delimited-file scan with a declared schema.

    Inference is refused on purpose: it costs an extra pass over the files
    and narrows types (bigint read back as int, timestamp_ntz as timestamp).
    """
    return (spark.read.schema(schema)
            .option("header", str(header).lower())
            .option("sep", sep)
            .option("nullValue", null_value)
            .option("mode", "FAILFAST")
            .csv(path))
