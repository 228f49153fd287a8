"""Sums of doubles that do not depend on partitioning (A1, A5).

Floating-point addition is not associative, so means and deviations move in their last
digits with the order in which tasks finish. Here every value is cut into whole numbers: the
exponents are cut into bins of ``BIN`` and a value in bin ``b`` is
``(whole + middle * 2**-27 + low * 2**-54) * 2**(BIN * b)`` exactly. Whole numbers add up in any order.
Squares take part as the rounded square and its rounding error (Dekker's product), both doubles.

The parts are summed as longs within a task's rows and as 38-digit decimals across tasks;
at most ``3 * columns * bins`` rows come back, whose rational sum is rounded once. So the mean is the
double nearest to the true mean of the column, and the deviation comes from the exact variance.

Defined results: null and NaN are missing, as in the other fits; a column without a present
value has no mean; an empty table has ``n = 0``. A value outside ``2**-400 .. 2**480`` in
magnitude (infinities too) stops the job with an error, since its square has no exact double parts.
Columns are cast to double first: a wider long or decimal is rounded there, once, by itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from keelson.operators.clean import missing_as_null

BIN = 32
LEAST, MOST = -400, 480
_PART = 27
# Splits a double into two halves of at most 26 bits (fixed value: 2**27 + 1).
_SPLIT = 134217729.0


@dataclass(frozen=True)
class ExactMoments:
    """Exact count, sum and sum of squares of a column, with its smallest and largest value."""

    n: int
    total: Fraction
    squares: Fraction
    min: float | None
    max: float | None

    @property
    def mean(self) -> float | None:
        return float(self.total / self.n) if self.n else None

    @property
    def std(self) -> float | None:
        """Population deviation."""
        if not self.n:
            return None
        return math.sqrt(float(self.squares / self.n - (self.total / self.n) ** 2))


def _square_error(x: Column) -> Column:
    """``x * x`` minus its rounded value, exactly."""
    big = x * F.lit(_SPLIT)
    high = big - (big - x)
    low = x - high
    return ((high * high - x * x) + F.lit(2.0) * high * low) + low * low


def _cell(place: int, moment: str, x: Column) -> Column:
    """A value's bin and its three whole parts."""
    # The logarithm may be off near a power of two; the parts have a bit to spare on either side.
    bin_ = F.coalesce(F.floor(F.log2(F.abs(x)) / F.lit(float(BIN))), F.lit(0)).cast("int")
    scaled = x * F.pow(F.lit(2.0), F.lit(-BIN) * bin_)
    whole = F.floor(scaled)
    rest = (scaled - whole) * F.lit(2.0 ** _PART)
    middle = F.floor(rest)
    low = (rest - middle) * F.lit(2.0 ** _PART)
    return F.struct(F.lit(place).alias("place"), F.lit(moment).alias("moment"), bin_.alias("bin"), x.alias("x"),
                    whole.alias("whole"), middle.alias("middle"), low.cast("bigint").alias("low"))


def _checked(df: DataFrame, column: str) -> Column:
    x = missing_as_null(df, column).cast("double")
    size = F.abs(x)
    fits = (size == 0) | ((size >= F.lit(2.0 ** LEAST)) & (size <= F.lit(2.0 ** MOST)))
    fault = F.raise_error(F.concat(F.lit(f"column {column}: no exact sum of a value of this size: "), x.cast("string")))
    return F.when(x.isNull() | fits, x).otherwise(fault.cast("double"))


def exact_cells(df: DataFrame, columns: Sequence[str], squares: bool = True) -> DataFrame:
    """The accumulator: (place, moment, bin, n, lowest, highest, whole, middle, low), one row a used cell.

    Cells of two frames add up, so a total can be kept and extended by new rows.
    """
    for c in columns:
        if not isinstance(df.schema[c].dataType, NumericType):
            raise TypeError(f"column {c} is not numeric")
    values = df.select(*[_checked(df, c).alias(f"v{i}") for i, c in enumerate(columns)], F.spark_partition_id().alias("task"))
    cells = []
    for i in range(len(columns)):
        x = F.col(f"v{i}")
        cells.append(_cell(i, "sum", x))
        if squares:
            cells += [_cell(i, "square", x * x), _cell(i, "square", _square_error(x))]
    parts = values.select("task", F.inline(F.array(*cells))).filter("x is not null")
    # Longs hold the sums of a task: 2**30 rows of parts below 2**33.
    by_task = parts.groupBy("task", "place", "moment", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lowest"), F.max("x").alias("highest"),
        *[F.sum(p).alias(p) for p in ("whole", "middle", "low")])
    return by_task.groupBy("place", "moment", "bin").agg(
        F.sum("n").alias("n"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        *[F.sum(F.col(p).cast("decimal(28,0)")).alias(p) for p in ("whole", "middle", "low")])


def exact_moments(df: DataFrame, columns: Sequence[str], squares: bool = True) -> dict[str, ExactMoments]:
    """Exact moments of all columns from one aggregate (without ``squares`` their sum is zero)."""
    cols = list(columns)
    found: dict[int, list] = {i: [0, Fraction(0), Fraction(0), None, None] for i in range(len(cols))}
    for r in exact_cells(df, cols, squares).collect():
        value = Fraction((int(r["whole"]) << 2 * _PART) + (int(r["middle"]) << _PART) + int(r["low"])) \
            * Fraction(2) ** (BIN * r["bin"] - 2 * _PART)
        at = found[r["place"]]
        if r["moment"] == "square":
            at[2] += value
            continue
        at[0] += r["n"]
        at[1] += value
        at[3] = r["lowest"] if at[3] is None else min(at[3], r["lowest"])
        at[4] = r["highest"] if at[4] is None else max(at[4], r["highest"])
    return {c: ExactMoments(*found[i]) for i, c in enumerate(cols)}


def exact_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """A1, to be given to ``impute_mean``: the doubles nearest to the true means."""
    return {c: m.mean for c, m in exact_moments(df, columns, squares=False).items()}
