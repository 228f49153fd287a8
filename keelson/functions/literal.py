"""Small frames of literal rows built inside the JVM.

``createDataFrame`` on a Python list ships the rows through Python workers;
for a handful of driver-side values (a cut table, a code table) a literal
array of structs expanded with ``inline`` is planned as a local relation and
never leaves the JVM. Only for bounded row counts: every value becomes part
of the plan, so beyond ``LITERAL_MAX_ROWS`` the rows are shipped as data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Above this many rows, literals would bloat the plan; ship the rows instead.
LITERAL_MAX_ROWS = 256


def literal_frame(spark: SparkSession, rows: Sequence[Sequence[object]], schema: StructType) -> DataFrame:
    if not rows or len(rows) > LITERAL_MAX_ROWS:
        return spark.createDataFrame([tuple(r) for r in rows], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
