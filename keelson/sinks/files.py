"""File sinks (K1 Parquet write, K2 overwrite with a new schema, K8 a pair).

Writes are plain DataFrame writer calls; adaptive execution sizes the final
partitions, and ``max_records_per_file`` bounds file sizes on large outputs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from keelson.sinks import commits

SPLIT_COLUMN = "split"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet",
                  partition_by: Sequence[str] = (), max_records_per_file: int | None = None) -> str:
    """K1: write a frame; by default refuse a path that already exists."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.save(path)
    return path


def overwrite_with_schema(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K2: replace what is at ``path``, schema included.

    The rows are written beside it first (``<path>.next-...``), so the frame may read
    from ``path`` itself; two renames put them in place, the old folder waiting as
    ``<path>.prev`` in between, and it is deleted last. A failure leaves the old
    rows at ``path``; after a killed job ``recover_path`` does, and so does the next overwrite.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    recover_path(spark, path)
    following, previous = f"{path}.next-{uuid.uuid4().hex[:12]}", f"{path}.prev"
    try:
        df.write.mode("errorifexists").format(fmt).save(following)
        if commits.exists(spark, path):
            commits.rename(spark, path, previous)
        commits.rename(spark, following, path)
    except BaseException:
        recover_path(spark, path)
        commits.delete(spark, following)
        raise
    commits.delete(spark, previous)
    return path


def recover_path(spark: SparkSession, path: str) -> bool:
    """Undo an overwrite that was killed between its two renames; True if there was one."""
    previous = f"{path.rstrip('/')}.prev"
    if not commits.exists(spark, previous):
        return False
    if commits.exists(spark, path):
        commits.delete(spark, previous)       # the new rows are in place: only the last step was missing
        return False
    commits.rename(spark, previous, path)
    return True


def write_split(df: DataFrame, path: str, sides: Sequence[str] = ("train", "test"),
                split_col: str = SPLIT_COLUMN, fmt: str = "parquet",
                mode: str = "errorifexists", max_records_per_file: int | None = None) -> dict[str, str]:
    """K8: write every side of a split in one pass, one folder per side.

    The split column becomes the folder name (``<path>/split=train``), so the
    plan that produced the split (joins, hashing) runs once instead of once per
    output, and nothing has to be cached. Returns side -> folder. A side with
    no rows gets a folder with an empty file of the same columns.
    """
    w = df.write.mode(mode).format(fmt).partitionBy(split_col)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.save(path)
    folders = {s: f"{path.rstrip('/')}/{split_col}={s}" for s in sides}
    spark = df.sparkSession
    for folder in folders.values():
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            empty = spark.createDataFrame([], df.drop(split_col).schema)
            empty.coalesce(1).write.format(fmt).save(folder)
    return folders


def write_pair(train: DataFrame, test: DataFrame, train_path: str, test_path: str,
               fmt: str = "parquet", mode: str = "errorifexists") -> tuple[str, str]:
    """K8 when the two sides are separate frames: two writes."""
    write_parquet(train, train_path, mode=mode, fmt=fmt)
    write_parquet(test, test_path, mode=mode, fmt=fmt)
    return train_path, test_path
