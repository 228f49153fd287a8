"""Reproducible splits and folds (X1 stratified, X2 hashed random, X3 k-fold).

Every row draws a 60-bit hash of (purpose, seed, key); nothing depends on
partitioning, task retries or ``rand()``. The purpose holds the side names and
weights (or the fraction, or the number of folds), so splitting one side of a
split again is independent of the first split; repeating a split with equal
arguments needs a new seed.

X2 and X3 are projections: side borders are thresholds on the full hash, so
a hold-out of a few rows in a billion has its share.

X1, exact stratified split, without a window over the data:

1. histogram: rows per (class, first 16 bits), with partial aggregation; a
   running sum per class finds the bucket of the class's last test row;
2. the rows of these buckets (about n/65,536 per class) are counted by full hash, and
   a running sum gives the hash of the last test row: one threshold per class;
3. one projection over the input compares each row's hash with its class's
   threshold (a plain join with one row per class).

Only rows whose hash equals the threshold (copies of one key) can be split by
it; if there are more of them than the class still needs, these few are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

from keelson.functions.hashing import HASH_BITS, HASH_SPACE, hash60, keyed_text
from keelson.operators.rank import rank_within_groups
from keelson.session import checkpoint_root

BUCKET_SHIFT = HASH_BITS - 16

_H, _B, _CUT, _NEED, _RN = "__h", "__b", "__cut", "__need", "__rn"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def split_hash(df: DataFrame, key: str | Sequence[str], purpose: str, seed: int = 42) -> Column:
    return hash60(keyed_text(df, _keys(key), purpose, seed))


def side_bounds(weights: Sequence[float]) -> list[int]:
    """Upper hash bound of every side but the last."""
    parts = [Fraction(w) for w in weights]
    total = sum(parts)
    if total <= 0 or any(w < 0 for w in parts):
        raise ValueError("weights must be non-negative with a positive sum")
    return [round(sum(parts[:i + 1]) / total * HASH_SPACE) for i in range(len(parts) - 1)]


def split_purpose(weights: Sequence[float], names: Sequence[str]) -> str:
    return "split " + ",".join(f"{n}={w:g}" for n, w in zip(names, weights))


def hash_split(df: DataFrame, key: str | Sequence[str], weights: Sequence[float] = (0.8, 0.2),
               names: Sequence[str] = ("train", "test"), seed: int = 42,
               split_col: str = "split") -> DataFrame:
    """Independent per-row assignment, sizes approximate.

    A row goes to the first side whose hash bound lies above its hash. A
    projection; no shuffle.
    """
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    drawn = split_hash(df, key, split_purpose(weights, names), seed)
    expr = None
    for bound, name in zip(side_bounds(weights), names):
        below = drawn < F.lit(bound).cast("bigint")
        expr = F.when(below, F.lit(name)) if expr is None else expr.when(below, F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn(split_col, last if expr is None else expr.otherwise(last))


def random_split(df: DataFrame, key: str | Sequence[str], weights: Sequence[float] = (0.8, 0.2),
                 seed: int = 42) -> list[DataFrame]:
    """X2 in the shape of ``randomSplit``: one frame per weight."""
    names = [str(i) for i in range(len(weights))]
    tagged = hash_split(df, key, weights, names, seed, "__side")
    return [tagged.where(F.col("__side") == n).drop("__side") for n in names]


def assign_folds(df: DataFrame, key: str | Sequence[str], k: int = 5, seed: int = 42,
                 fold_col: str = "fold") -> DataFrame:
    """Fold number in 0..k-1 from the row hash."""
    if k < 2:
        raise ValueError("k must be at least 2")
    return df.withColumn(fold_col, F.pmod(split_hash(df, key, f"fold {k}", seed), F.lit(k)).cast("int"))


def _orderable(df: DataFrame, skip: set[str]) -> list[str]:
    bad = (ArrayType, MapType, StructType, BinaryType)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, bad)]


def stratified_split(df: DataFrame, label: str, key: str | Sequence[str],
                     test_fraction: float = 0.2, seed: int = 42, split_col: str = "split",
                     names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Each class (null included) sends exactly round(n_c * f) rows to test.

    The target per class is ``floor(n_c * f + 0.5)``; rows are taken in hash
    order, key and remaining columns breaking ties between rows that share a
    hash, so the chosen set is the same on every run.
    """
    if not 0.0 <= test_fraction <= 1.0:
        raise ValueError("test_fraction must be in [0, 1]")
    keys = _keys(key)
    train_name, test_name = names
    drawn = split_hash(df, keys, f"stratified {test_fraction:g}", seed)
    last = _last_test_rows(df.select(F.col(label).alias("__label"), drawn.alias(_H)), test_fraction)

    tagged = (df.withColumn(_H, drawn)
              .join(last, F.col(label).eqNullSafe(F.col("__label")), "left"))
    at_end = F.col(_H) == F.col(_CUT)
    out = tagged.withColumn(split_col, F.when(F.col(_H) <= F.col(_CUT), F.lit(test_name)).otherwise(F.lit(train_name)))
    result = [*df.columns, split_col]
    if last.filter("__at > __need").isEmpty():
        return out.select(*result)
    # Copies of a key straddle a threshold: rank these rows only.
    order = [F.col(k) for k in keys] + [F.col(c) for c in _orderable(df, set(keys) | {label})]
    ranked = rank_within_groups(tagged.where(at_end), [label], order, _RN).withColumn(
        split_col, F.when(F.col(_RN) <= F.col(_NEED), F.lit(test_name)).otherwise(F.lit(train_name)))
    return out.where(~F.coalesce(at_end, F.lit(False))).select(*result).unionByName(ranked.select(*result))


def _last_test_rows(hashes: DataFrame, fraction: float) -> DataFrame:
    """Per class with test rows: the hash of its last one (``__cut``), how many
    rows have that hash (``__at``) and how many of them are test (``__need``)."""
    checkpoint_root(hashes.sparkSession)
    bucket = F.shiftright(F.col(_H), BUCKET_SHIFT)
    by_class = Window.partitionBy("__label")
    hist = hashes.groupBy("__label", bucket.alias(_B)).agg(F.count(F.lit(1)).alias("__n"))
    upto = by_class.orderBy(_B).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (hist.withColumn("__cum", F.sum("__n").over(upto))
           .withColumn("__target", F.floor(F.sum("__n").over(by_class) * F.lit(fraction) + F.lit(0.5)))
           .where((F.col("__cum") >= F.col("__target")) & (F.col("__cum") - F.col("__n") < F.col("__target")))
           .select(F.col("__label").alias("__l"), F.col(_B).alias("__bucket"),
                   (F.col("__target") - (F.col("__cum") - F.col("__n"))).alias("__left")))
    inside = (hashes.withColumn(_B, bucket)
              .join(cut, F.col("__label").eqNullSafe(F.col("__l")) & (F.col(_B) == F.col("__bucket")))
              .groupBy("__label", _H, "__left").agg(F.count(F.lit(1)).alias("__at")))
    run = by_class.orderBy(_H).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (inside.withColumn("__cum", F.sum("__at").over(run))
            .where((F.col("__cum") >= F.col("__left")) & (F.col("__cum") - F.col("__at") < F.col("__left")))
            .select("__label", F.col(_H).alias(_CUT), "__at",
                    (F.col("__left") - (F.col("__cum") - F.col("__at"))).alias(_NEED))
            .checkpoint(eager=True))


def split_frames(df: DataFrame, split_col: str = "split",
                 names: Sequence[str] = ("train", "test")) -> list[DataFrame]:
    return [df.where(F.col(split_col) == n).drop(split_col) for n in names]

