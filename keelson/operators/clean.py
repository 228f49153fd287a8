"""Union and cleaning of feature sets.

Everything here is a projection or a union, so it stays inside whole-stage
codegen and never shuffles. Mean imputation is a fit/apply pair: the fit is
one aggregate over all chosen columns at once (partial aggregation on every
executor, one row at the end); the apply is a projection with the means as
literals, which is what a fitted model holds anyway.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, NumericType


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Stack frames by column name, keeping duplicates.

    A column absent from some frame is null there; the column order is that of
    the first frame, then new columns in order of appearance.
    """
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop named columns; an unknown name is an error unless ``strict=False``."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    if strict:
        unknown = [c for c in cols if c not in df.columns]
        if unknown:
            raise KeyError(f"columns not found: {unknown}")
    return df.drop(*cols)


def _is_floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (DoubleType, FloatType))


def missing_as_null(df: DataFrame, column: str) -> Column:
    """NaN and null both mean 'missing' (as in pandas); make both null."""
    c = F.col(column)
    return F.nanvl(c, F.lit(None).cast(df.schema[column].dataType)) if _is_floating(df, column) else c


def recode_expr(df: DataFrame, column: str, mapping: Mapping[object, object], unlisted: str = "error",
                out_type: str = "int") -> Column:
    """P2 as an expression: listed values become their codes; exact match.

    The dictionary is an array of (value, code) pairs typed to the column and
    to ``out_type``, searched from its start for every row: for the handful of values
    of a category. ``recode_values`` joins larger dictionaries instead, with the
    same results. A code of None gives null. ``unlisted``: ``"error"`` fails the job on a value not in
    the dictionary, ``"null"`` turns it into null, ``"keep"`` leaves it as it
    is. A null input stays null either way.
    """
    if unlisted not in ("error", "null", "keep"):
        raise ValueError("unlisted must be 'error', 'null' or 'keep'")
    if not mapping:
        raise ValueError("empty dictionary")
    dtype = df.schema[column].dataType
    c = F.col(column)
    if unlisted == "error":
        fallback = F.raise_error(F.concat(F.lit(f"unlisted value in {column}: "), c.cast("string"))).cast(out_type)
    else:
        fallback = c.cast(out_type) if unlisted == "keep" else F.lit(None).cast(out_type)
    # Keys that cannot be a value of the column (after conversion) match nothing.
    pairs = [(F.lit(k).try_cast(dtype), F.lit(v).cast(out_type)) for k, v in mapping.items() if k is not None]
    keys = F.array(*[k for k, _ in pairs])
    place = F.array_position(keys, c)
    codes = F.array(*[v for _, v in pairs])
    return F.when(c.isNull(), F.lit(None).cast(out_type)).when(
        place > 0, F.element_at(codes, F.greatest(place, F.lit(1)).cast("int"))).otherwise(fallback)


def recode_values(df: DataFrame, column: str, mapping: Mapping[object, object],
                  unlisted: str = "error", out_type: str = "int") -> DataFrame:
    """Replace a column in place by its codes (see ``recode_expr`` for the semantics).

    Up to ``EXPR_ENTRIES`` entries are an expression; more are a left join with a code table, one
    row a value, which the optimiser sends everywhere or shuffles by its size. The join
    also finds unlisted values: their rows have no match.
    """
    if len(mapping) <= EXPR_ENTRIES:
        return df.withColumn(column, recode_expr(df, column, mapping, unlisted, out_type))
    if unlisted not in ("error", "null", "keep"):
        raise ValueError("unlisted must be 'error', 'null' or 'keep'")
    codes = code_table(df.sparkSession, mapping, df.schema[column].dataType, out_type)
    key, code = "__recode_key", "__recode_code"
    joined = df.join(codes.select(F.col("value").alias(key), F.struct("code").alias(code)), F.col(column) == F.col(key), "left")
    c = F.col(column)
    if unlisted == "error":
        missing = F.raise_error(F.concat(F.lit(f"unlisted value in {column}: "), c.cast("string"))).cast(out_type)
    else:
        missing = c.cast(out_type) if unlisted == "keep" else F.lit(None).cast(out_type)
    new = F.when(c.isNull(), F.lit(None).cast(out_type)).when(F.col(code).isNotNull(), F.col(f"{code}.code")).otherwise(missing)
    return joined.select(*[new.alias(column) if name == column else F.col(f"`{name}`") for name in df.columns])


# Largest dictionary that is searched row by row.
EXPR_ENTRIES = 32


def code_table(spark: SparkSession, mapping: Mapping[object, object], dtype: DataType, out_type: str) -> DataFrame:
    """``value`` (typed as the column) and ``code`` of every entry; of entries that are equal once typed, the first.

    Entries are shipped as rows of their own types and cast as literals would be; one that cannot be a
    value of the column matches nothing.
    """
    kinds: dict[tuple[str, str], list[tuple]] = {}
    for place, (k, v) in enumerate(mapping.items()):
        if k is not None:
            kinds.setdefault((_literal_type(k), _literal_type(v)), []).append((place, k, v))
    parts = []
    for (k_type, v_type), rows in kinds.items():
        raw = spark.createDataFrame(rows, f"place int, k {k_type}, v {v_type}")
        parts.append(raw.select("place", F.col("k").try_cast(dtype).alias("value"), F.col("v").cast(out_type).alias("code")))
    whole = reduce(DataFrame.unionByName, parts).filter("value is not null")
    return whole.groupBy("value").agg(F.min_by(F.struct("code"), "place").alias("first")).select("value", "first.code")


def _literal_type(value: object) -> str:
    """The SQL type Spark gives a Python value as a literal."""
    if value is None:
        return "void"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "int" if -2**31 <= value < 2**31 else "bigint"
    if isinstance(value, float):
        return "double"
    if isinstance(value, str):
        return "string"
    return {"Decimal": "decimal(38,18)", "date": "date", "datetime": "timestamp"}[type(value).__name__]


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """A1: mean of each column over present values (NaN and null skipped).

    One aggregate job for all columns; the result is one row.
    """
    cols = list(columns)
    for c in cols:
        if not isinstance(df.schema[c].dataType, NumericType):
            raise TypeError(f"column {c} is not numeric")
    row = df.agg(*[F.avg(missing_as_null(df, c)).alias(c) for c in cols]).first()
    return {c: (None if row[c] is None else float(row[c])) for c in cols}


def impute_mean_exprs(df: DataFrame, means: Mapping[str, float | None]) -> dict[str, Column]:
    out = {}
    for c, m in means.items():
        present = missing_as_null(df, c).cast("double")
        out[c] = present if m is None else F.coalesce(present, F.lit(float(m)))
    return out


def impute_mean(df: DataFrame, columns: Sequence[str],
                means: Mapping[str, float | None] | None = None) -> DataFrame:
    """Fill missing values with the column mean (fit on ``df`` unless given).

    Filled columns become double. A column with no present value stays null.
    """
    fitted = dict(means) if means is not None else fit_means(df, columns)
    return df.withColumns(impute_mean_exprs(df, {c: fitted.get(c) for c in columns}))


def label_features(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> tuple[list[str], str]:
    """P5: names of the feature columns and of the label.

    In Spark a row stays whole through a split, so nothing is separated and
    re-attached; callers select ``features + [label]`` where they need it.
    """
    if label not in df.columns:
        raise KeyError(f"label {label!r} not found")
    skip = set(exclude) | {label}
    return [c for c in df.columns if c not in skip], label


def clean_features(df: DataFrame, recode: Mapping[str, Mapping[object, object]] | None = None,
                   drop: Sequence[str] = (), impute: Sequence[str] = (),
                   means: Mapping[str, float | None] | None = None,
                   unlisted: str = "error") -> DataFrame:
    """P7 = P2 + P1 + P3 in one projection.

    ``means`` lets a job fit on its training rows and apply the same values to
    every other frame; without it the means are fitted on ``df``.
    """
    out = drop_columns(df, drop) if drop else df
    # A column that is recoded and imputed gets the mean of its codes.
    for c, mapping in (recode or {}).items():
        out = recode_values(out, c, mapping, unlisted)
    return impute_mean(out, impute, means) if impute else out
