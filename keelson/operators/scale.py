"""Feature scaling (A5 statistics, M1 min-max, M2 standard, M3 both, M4 reuse).

Fit = one aggregate computing min, max, mean and population standard
deviation of every chosen column at once (partial aggregation per executor,
one row at the end). Apply = a projection with the statistics as literals; no
join and no shuffle of data rows, so it fuses with the scan in one codegen
stage. Fitting on one frame (training rows) and applying to another (test
rows) is how leakage is avoided.

Semantics follow the usual scaler definitions, not MLlib's:

* min-max maps to [0, 1]; a constant column maps to 0 (MLlib gives 0.5);
* standardisation divides by the *population* standard deviation (MLlib uses
  the sample one); a constant column maps to 0;
* missing values (null or NaN) are ignored by the fit and stay null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.clean import missing_as_null
from keelson.operators.exact import exact_moments

STAT_NAMES = ("n", "min", "max", "mean", "std")


@dataclass(frozen=True)
class ColumnStats:
    n: int
    min: float | None
    max: float | None
    mean: float | None
    std: float | None


def _stat_aggs(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    aggs = []
    for c in cols:
        x = missing_as_null(df, c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return aggs


def fit_scaler(df: DataFrame, columns: Sequence[str], exact: bool = False) -> dict[str, ColumnStats]:
    """A5: one pass, one row back to the driver.

    ``exact`` takes the sums of ``operators.exact``: equal to the last bit at any partitioning.
    """
    cols = list(columns)
    if exact:
        return {c: ColumnStats(m.n, m.min, m.max, m.mean, m.std) for c, m in exact_moments(df, cols).items()}
    row = df.agg(*_stat_aggs(df, cols)).first()
    return {c: ColumnStats(int(row[f"{c}__n"]), row[f"{c}__min"], row[f"{c}__max"],
                           row[f"{c}__mean"], row[f"{c}__std"]) for c in cols}


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A5 as a frame: one row per column (column_name, n, min, max, mean, std).

    Lazy: the wide one-row aggregate is turned long on the executor side.
    """
    cols = list(columns)
    wide = df.agg(*_stat_aggs(df, cols))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              F.col(f"{c}__n").cast("bigint").alias("n"),
                              F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                              F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
                     for c in cols])
    return wide.select(F.inline(rows))


def minmax_expr(df: DataFrame, column: str, st: ColumnStats) -> Column:
    x = missing_as_null(df, column).cast("double")
    if st.min is None:
        return x
    span = st.max - st.min
    if span == 0:
        return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
    return (x - F.lit(st.min)) / F.lit(span)


def standard_expr(df: DataFrame, column: str, st: ColumnStats) -> Column:
    x = missing_as_null(df, column).cast("double")
    if st.mean is None:
        return x
    if not st.std:
        return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
    return (x - F.lit(st.mean)) / F.lit(st.std)


def minmax_scale(df: DataFrame, columns: Sequence[str],
                 stats: Mapping[str, ColumnStats] | None = None) -> DataFrame:
    """M1: replace each column by its min-max scaled value."""
    st = dict(stats) if stats is not None else fit_scaler(df, columns)
    return df.withColumns({c: minmax_expr(df, c, st[c]) for c in columns})


def standard_scale(df: DataFrame, columns: Sequence[str],
                   stats: Mapping[str, ColumnStats] | None = None) -> DataFrame:
    """M2: replace each column by its standardised value."""
    st = dict(stats) if stats is not None else fit_scaler(df, columns)
    return df.withColumns({c: standard_expr(df, c, st[c]) for c in columns})


def scaled_feature_matrix(df: DataFrame, columns: Sequence[str],
                          stats: Mapping[str, ColumnStats] | None = None,
                          passthrough: Sequence[str] | None = None,
                          minmax_prefix: str = "mm_", standard_prefix: str = "std_") -> DataFrame:
    """M3: both scalers on the same columns, side by side, then passthrough.

    Output order: min-max block, standard block, then the other columns
    (all of them unless ``passthrough`` names a subset).
    """
    cols = list(columns)
    st = dict(stats) if stats is not None else fit_scaler(df, cols)
    rest = [c for c in df.columns if c not in cols] if passthrough is None else list(passthrough)
    return df.select(*[minmax_expr(df, c, st[c]).alias(minmax_prefix + c) for c in cols],
                     *[standard_expr(df, c, st[c]).alias(standard_prefix + c) for c in cols],
                     *rest)
