"""Exact rank within a group that survives a group holding most of the rows.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task; it is used only after checking that the largest group is
bounded. Otherwise the rows are range-partitioned on (g, o) by a global sort (sample-based bounds, so a hot group spans many partitions), and
each row's rank is

    rank = (rows of g in earlier partitions) + (position of the row among
           the rows of g in its own partition) + 1.

The sorted rows are checkpointed once with a monotonically increasing id
(partition index in the high bits, position in the low bits), so every later
step sees one fixed order. Per (g, partition) counts are tiny (one row per
group and partition it touches); their running sum per group gives the
offsets, which are joined back on (g, partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import checkpoint_root

_GID, _PID = "__gid", "__pid"


# Groups up to this many rows are ranked by a plain window (one task each).
MAX_GROUP_ROWS = 1_000_000


def rank_within_groups(df: DataFrame, group: Sequence[str], order: Sequence[str],
                       rank_col: str = "rank", max_group_rows: int | None = None,
                       largest: int | None = None) -> DataFrame:
    """1-based rank of each row within its group under ``order`` (make it total).

    The size of the largest group is checked first (one aggregate with
    map-side combining). If every group fits in ``max_group_rows``, a window
    ranks them, one group per task. Beyond that bound the sort-based path
    below is used, so no task ever holds a whole hot group. A caller that
    already knows the largest group's size passes it as ``largest``.
    """
    g, o = list(group), list(order)
    bound = MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    if largest is None:
        largest = df.groupBy(*g).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0]
    if largest is None or largest <= bound:
        w = Window.partitionBy(*g).orderBy(*o)
        return df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
    return _rank_by_global_sort(df, g, o, rank_col)


def _rank_by_global_sort(df: DataFrame, g: list[str], o: list[str], rank_col: str) -> DataFrame:
    checkpoint_root(df.sparkSession)
    ordered = (df.orderBy(*g, *o)
               .withColumn(_GID, F.monotonically_increasing_id())
               .withColumn(_PID, F.shiftright(F.col(_GID), 33))
               .checkpoint(eager=True))
    per_part = (ordered.groupBy(*g, _PID)
                .agg(F.count(F.lit(1)).alias("__n"), F.min(_GID).alias("__first")))
    before = Window.partitionBy(*g).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"__g{i}" for i in range(len(g))]
    offsets = (per_part.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
               .select(*[F.col(c).alias(k) for c, k in zip(g, keys)], F.col(_PID).alias("__p"),
                       "__offset", "__first"))
    cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(g, keys)] + [F.col(_PID) == F.col("__p")]
    joined = ordered.join(offsets, cond, "inner")
    rank = F.col("__offset") + (F.col(_GID) - F.col("__first")) + 1
    return joined.select(*df.columns, rank.cast("bigint").alias(rank_col))
