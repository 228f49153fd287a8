"""Counts, shapes, key ranges, class counts, first rows and input checks
(A2-A4, A7, F1, F6).

All of them are aggregates with partial aggregation, so they shuffle at most
one row per group per map task. Each returns a lazy DataFrame; the few
helpers that return Python values read back one bounded row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from keelson.operators.clean import missing_as_null


def row_count(df: DataFrame, name: str, name_col: str = "frame") -> DataFrame:
    """A2 as a one-row frame (name, n_rows)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias(name_col), _counted("n_rows"))


def _counted(column: str) -> Column:
    """A count; one taken from the footers of a table without rows arrives as null and is zero."""
    return F.greatest(F.col(column), F.lit(0)).cast("bigint").alias(column)


def row_counts(frames: Mapping[str, DataFrame], name_col: str = "frame") -> DataFrame:
    """A2 for several frames: one row each, computed in one job."""
    return reduce(DataFrame.unionByName, [row_count(df, n, name_col) for n, df in frames.items()])


def shape_profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """A3: (frame, n_rows, n_cols) per frame; the column count is schema metadata."""
    parts = [row_count(df, n).withColumn("n_cols", F.lit(len(df.columns))) for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def key_range(df: DataFrame, key: str) -> DataFrame:
    """A4: (key_min, key_max, n_keys) of a key column."""
    return df.agg(F.min(key).alias("key_min"), F.max(key).alias("key_max"),
                  F.count(key).alias("n_keys")).select("key_min", "key_max", _counted("n_keys"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value (null is a class of its own)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def head_rows(df: DataFrame, order_by: Sequence[str] | str, n: int = 5) -> DataFrame:
    """first ``n`` rows under a total order (top-n, not a full sort)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).limit(n)


def _present(df: DataFrame, column: str) -> Column:
    dt = df.schema[column].dataType
    return missing_as_null(df, column) if isinstance(dt, NumericType) else F.col(column)


def _comparable(df: DataFrame, column: str) -> Column:
    """Value whose min and max decide constancy, with a fixed-width type.

    Numbers compare as themselves. Other types compare through a 64-bit hash
    of the value, which keeps the whole profile a hash aggregate (min/max of
    strings would force a sort-based one).
    """
    dt = df.schema[column].dataType
    if isinstance(dt, NumericType):
        return missing_as_null(df, column)
    return F.when(F.col(column).isNotNull(), F.xxhash64(F.col(column)))


def validate_input(df: DataFrame, label: str | None = None) -> DataFrame:
    """one row per column: rows, missing values, constancy, label classes.

    Columns of the result: ``column_name, dtype, n_rows, n_missing,
    all_missing, is_constant, n_label_classes`` (the last only on the label's
    row, null elsewhere). One job: per-label partial profiles (hash
    aggregate, combined map-side), then one global row; the number of label
    groups is the exact class count (null counts as a class).
    """
    cols = df.columns
    parts: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = _comparable(df, c)
        parts += [F.count(_present(df, c)).alias(f"__p{i}"), F.min(x).alias(f"__lo{i}"),
                  F.max(x).alias(f"__hi{i}")]
    merge: list[Column] = [F.sum("__rows").alias("__rows")]
    for i in range(len(cols)):
        merge += [F.sum(f"__p{i}").alias(f"__p{i}"), F.min(f"__lo{i}").alias(f"__lo{i}"),
                  F.max(f"__hi{i}").alias(f"__hi{i}")]
    if label is not None:
        wide = df.groupBy(label).agg(*parts).agg(*merge, F.count(F.lit(1)).alias("__classes"))
    else:
        wide = df.agg(*parts)
    entries = []
    for i, c in enumerate(cols):
        rows = F.coalesce(F.col("__rows"), F.lit(0)).cast("bigint")
        n_missing = (rows - F.coalesce(F.col(f"__p{i}"), F.lit(0))).cast("bigint")
        constant = F.coalesce(F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.lit(False))
        classes = F.col("__classes").cast("bigint") if label is not None and c == label \
            else F.lit(None).cast("bigint")
        entries.append(F.struct(F.lit(c).alias("column_name"),
                                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                                rows.alias("n_rows"),
                                n_missing.alias("n_missing"),
                                ((rows > 0) & (n_missing == rows)).alias("all_missing"),
                                constant.alias("is_constant"),
                                classes.alias("n_label_classes")))
    return wide.select(F.inline(F.array(*entries)))


# Relative standard error of the distinct-count sketch, and how many of them a decision must stay clear of.
SKETCH_ERROR, SKETCH_MARGIN = 0.01, 4


def column_shapes(df: DataFrame, id_share: float = 0.95, constant_share: float = 0.95, skewed_from: float = 2.0) -> DataFrame:
    """columns that look like ids, are nearly constant or are skewed; one row per column.

    Result: ``column_name, n_present, distinct_estimate, top_count, skewness, id_like, near_constant, skewed``.
    The first aggregate holds mergeable sketches of all columns: a distinct-count sketch (standard
    error ``SKETCH_ERROR``) and a quantile sketch, whose median is the only value that more
    than half of the rows can share (a value with 51 percent is always found). The second counts that value exactly in ``top_count`` (at least one
    row's value, not the most frequent one where none has half of the rows),
    and counts distinct values exactly where the estimate is within ``SKETCH_MARGIN`` errors of the
    border, so the three flags are exact but for a sketch that errs by more than that. Null and
    NaN are missing; a column without a value, of an empty table too, has no flag set. Shares are of present values;
    ``constant_share`` must be above 0.51. Skewness is the population's, of numbers only.
    """
    if not 0.51 < constant_share <= 1:
        raise ValueError("constant_share must be above 0.51 and at most 1")
    numeric = [isinstance(df.schema[c].dataType, NumericType) for c in df.columns]
    # Sketches see one double a value: a number itself, or 52 bits of a hash.
    cells = [missing_as_null(df, c).cast("double") if number else F.pmod(_comparable(df, c), F.lit(1 << 52)).cast("double")
             for c, number in zip(df.columns, numeric)]
    plain = df.select(*[x.alias(f"x{i}") for i, x in enumerate(cells)],
                      *[_present(df, c).alias(f"p{i}") for i, c in enumerate(df.columns)])
    aggs = []
    for i, number in enumerate(numeric):
        aggs += [F.count(f"x{i}").alias(f"n{i}"), F.approx_count_distinct(f"p{i}", SKETCH_ERROR).alias(f"d{i}"),
                 F.percentile_approx(f"x{i}", 0.5, F.lit(1000)).alias(f"m{i}"),
                 (F.skewness(f"x{i}") if number else F.lit(None).cast("double")).alias(f"s{i}")]
    first = plain.agg(*aggs).first()
    exact = []
    for i in range(len(cells)):
        n, d, median = first[f"n{i}"], first[f"d{i}"], first[f"m{i}"]
        exact.append(F.count_if(F.col(f"x{i}") == F.lit(median)).alias(f"t{i}") if median is not None else F.lit(0).alias(f"t{i}"))
        if n and abs(d / n - id_share) <= SKETCH_MARGIN * SKETCH_ERROR * d / n:
            exact.append(F.count_distinct(f"p{i}").alias(f"e{i}"))
    wide = plain.agg(*exact)
    rows = []
    for i, c in enumerate(df.columns):
        n, skew = first[f"n{i}"], first[f"s{i}"]
        distinct = F.col(f"e{i}") if f"e{i}" in wide.columns else F.lit(first[f"d{i}"])
        top = F.coalesce(F.col(f"t{i}"), F.lit(0)).cast("bigint")
        skew = None if skew is None or skew != skew else float(skew)
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("bigint").alias("n_present"),
                             F.lit(first[f"d{i}"]).cast("bigint").alias("distinct_estimate"), top.alias("top_count"),
                             F.lit(skew).cast("double").alias("skewness"),
                             ((F.lit(n) > 0) & (distinct >= F.lit(id_share) * n)).alias("id_like"),
                             ((F.lit(n) > 0) & (top >= F.lit(constant_share) * n)).alias("near_constant"),
                             F.lit(skew is not None and abs(skew) >= skewed_from).alias("skewed")))
    return wide.select(F.inline(F.array(*rows)))


def input_faults(report: DataFrame, label: str | None = None) -> list[str]:
    """Faults in a ``validate_input`` report (bounded: one row per column)."""
    faults = []
    for r in report.collect():
        if r["n_rows"] == 0:
            faults.append("input has no rows")
            break
        if r["all_missing"]:
            faults.append(f"column {r['column_name']} has no present value")
        if label is not None and r["column_name"] == label:
            if r["n_missing"]:
                faults.append(f"label {label} has {r['n_missing']} missing values")
            if r["n_label_classes"] is not None and r["n_label_classes"] < 2:
                faults.append(f"label {label} has fewer than two classes")
    return faults
