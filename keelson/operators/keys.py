"""Primary-key contract of a feature table.

A key is valid when no key column is null and no key value repeats. The check
is one partial-then-final aggregate on the key: the map side combines each
key before the shuffle, so even a key that holds a third of all rows moves
one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PrimaryKeyError(ValueError):
    pass


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def pk_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values that break the contract, with their row counts.

    Columns: the key columns, ``n_rows`` (bigint) and ``has_null`` (boolean).
    """
    ks = _keys(keys)
    missing = [k for k in ks if k not in df.columns]
    if missing:
        raise PrimaryKeyError(f"key columns not in frame: {missing}")
    any_null = F.lit(False)
    for k in ks:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*ks)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("has_null", any_null)
            .where((F.col("n_rows") > 1) | F.col("has_null")))


def assert_primary_key(df: DataFrame, keys: str | Sequence[str], name: str = "table") -> None:
    """Raise before any join if the key is not a primary key.

    One aggregate job counts the violating keys (``take`` would scan the
    shuffle output in several rounds when, as usual, there are none); a
    sample is fetched only for the error message.
    """
    violations = pk_violations(df, keys)
    if violations.agg(F.count(F.lit(1))).first()[0]:
        bad = violations.take(3)
        sample = ", ".join(str(tuple(r)) for r in bad)
        raise PrimaryKeyError(
            f"{name}: {list(_keys(keys))} is not a primary key (null or repeated), e.g. {sample}")
