"""Deterministic hashes shared by splits, folds, row ids and synthetic data.

``hash60(text)`` is the first 60 bits of the MD5 digest of a text, read as a
non-negative long. It depends only on the value, never on partitioning, the
session time zone or task retries, and has a one-line SQL twin in other engines
(``('0x' || substr(md5(text), 1, 15))::BIGINT``), which is what the oracle
tests rely on. Everything stays a built-in expression, so it runs inside
whole-stage codegen.

The hashed text starts with a purpose and a seed, so draws for different
purposes (another split, a fold, a column) are independent of each other. Every
field follows with its length in front (``-1:`` for null): two different
rows never give one text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, TimestampType

HASH_BITS = 60
HASH_SPACE = 1 << HASH_BITS
NULL_FIELD = "-1:"


def field_text(df: DataFrame, column: str) -> Column:
    """A column's value as text that no other value of it shares, with its length in front."""
    dtype, c = df.schema[column].dataType, F.col(column)
    if isinstance(dtype, TimestampType):
        # Microseconds since the epoch: the text form follows the session time zone.
        c = F.unix_micros(c)
    elif isinstance(dtype, BinaryType):
        c = F.hex(c)
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_FIELD))


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.concat(*[field_text(df, c) for c in columns])


def keyed_text(df: DataFrame, columns: Sequence[str], purpose: str, seed: int | str = 0) -> Column:
    """``purpose/seed|`` and the fields of a key."""
    return F.concat(F.lit(f"{purpose}/{seed}|"), row_text(df, columns))


def hash60(text: Column) -> Column:
    """First 60 bits of md5(text) as a bigint in [0, 2**60)."""
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")
