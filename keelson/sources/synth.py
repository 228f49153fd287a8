"""Literal rows (S6) and synthetic tables.

Synthetic columns are pure functions of (seed, column name, row key), so a
table can be generated for any number of keys on the executors, comes out
the same at any partition count, and can be reproduced in SQL. The row keys
come either from ``spark.range(n)`` or from the key column of an existing
table (so the synthetic table grows with it).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keelson.functions.hashing import hash60, keyed_text
from keelson.functions.literal import literal_frame


def values_source(spark: SparkSession, rows: Sequence[Sequence[object]],
                  schema: StructType | str) -> DataFrame:
    """A frame from literal rows (a code table, a handful of settings).

    The rows become a local relation inside the JVM (like SQL ``VALUES``), so
    a join against it can broadcast a table whose size is known up front.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return literal_frame(spark, list(rows), st)


def _fitting(expr: Column, lo: int, hi: int) -> Column:
    """``int`` if every value fits one, else ``bigint`` (which the hash fills to 2**60 values)."""
    return expr.cast("int" if -(1 << 31) <= lo and hi < 1 << 31 else "bigint")


@dataclass(frozen=True)
class UniformInt:
    """Uniform integer in the closed range [lo, hi]."""
    lo: int
    hi: int

    def expr(self, h: Column) -> Column:
        drawn = F.lit(self.lo).cast("bigint") + F.pmod(h, F.lit(self.hi - self.lo + 1).cast("bigint"))
        return _fitting(drawn, self.lo, self.hi)


@dataclass(frozen=True)
class Choice:
    """Uniform choice from a fixed list of values."""
    values: tuple

    def expr(self, h: Column) -> Column:
        arr = F.array(*[F.lit(v) for v in self.values])
        return F.element_at(arr, (F.pmod(h, F.lit(len(self.values))) + 1).cast("int"))


@dataclass(frozen=True)
class Stepped:
    """Uniform choice from {step * k : k = first..last}."""
    step: int
    first: int
    last: int

    def expr(self, h: Column) -> Column:
        k = F.lit(self.first).cast("bigint") + F.pmod(h, F.lit(self.last - self.first + 1).cast("bigint"))
        ends = sorted((self.step * self.first, self.step * self.last))
        return _fitting(F.lit(self.step).cast("bigint") * k, *ends)


@dataclass(frozen=True)
class Coin:
    """Fair boolean."""

    def expr(self, h: Column) -> Column:
        return F.pmod(h, F.lit(2)) == F.lit(1)


Generator = UniformInt | Choice | Stepped | Coin


def draw(df: DataFrame, key: str, column: str, gen: Generator, seed: int = 42) -> Column:
    return gen.expr(hash60(keyed_text(df, [key], f"column {column}", seed)))


def synth_table(keys: DataFrame, key: str, columns: Mapping[str, Generator], seed: int = 42,
                key_alias: str | None = None) -> DataFrame:
    """One row per key of ``keys``, each column drawn by its generator."""
    out = keys.select(F.col(key).alias(key_alias or key))
    k = key_alias or key
    return out.select(k, *[draw(out, k, name, gen, seed).alias(name) for name, gen in columns.items()])


def synth_range(spark: SparkSession, n: int, key: str, columns: Mapping[str, Generator],
                seed: int = 42) -> DataFrame:
    """S7 over a dense key 0..n-1 generated on the executors."""
    ids = spark.range(n).select(F.col("id").alias(key))
    return synth_table(ids, key, columns, seed)
