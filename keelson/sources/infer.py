"""Types and bad rows of delimited files (S1): one lattice pass, then typed rows and rejects.

A field is text until it is known to fit something narrower. The lattice is

    null < int < bigint < double < string
    null < boolean < string
    null < date < timestamp < string

and the type of a column is the join of its fields' types. Joins are
commutative, associative and idempotent, so a column's type is carried as a small set of
flags ("some field is not a bigint", ...): one partial aggregate over all files at
once gives every column, whatever the order of files, and two inferences merge into the
one of their files together (``merge_facts``).

Reading with the inferred (or a given) schema keeps every row: rows whose fields
all parse come back typed, the others as rejects with the file, the raw line and what
is wrong with it. A line with too many or too few fields is a reject; a field that is empty (or
the null text) is null in any type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keelson.session import scratch_dir

# Which texts are read as which type.
_INT = r"^[+-]?[0-9]{1,18}$"
_DOUBLE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
_BOOLEAN = r"^(?i)(true|false)$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"

# The types that a column may turn out to have, narrowest first, as far as they are ordered.
TYPES = ("int", "bigint", "double", "boolean", "date", "timestamp_ntz")

_RAW, _FILE = "__line", "__file"


def _fits(text: Column, kind: str) -> Column:
    """Whether a non-null text is a value of ``kind``."""
    if kind in ("int", "bigint"):
        return text.rlike(_INT) & text.try_cast(kind).isNotNull()
    if kind == "double":
        return text.rlike(_DOUBLE)
    if kind == "boolean":
        return text.rlike(_BOOLEAN)
    pattern = {"date": _DATE, "timestamp_ntz": f"{_DATE}|{_TIMESTAMP}"}[kind]
    return text.rlike(pattern) & text.try_cast(kind).isNotNull()


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).select(F.col("value").alias(_RAW), F.col("_metadata.file_path").alias(_FILE))


def _fields(lines: DataFrame, names: Sequence[str], sep: str, null_text: str) -> DataFrame:
    """Lines with their fields as texts; ``__extra`` holds what does not fit the columns."""
    layout = StructType([*[StructField(n, StringType()) for n in names], StructField("__extra", StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__extra", "nullValue": null_text, "emptyValue": null_text}
    # The JVM's own parser; a record with a wrong number of fields is named in __extra.
    return lines.withColumn("__f", F.from_csv(_RAW, _ddl(layout), options))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _header(spark: SparkSession, path: str | Sequence[str], sep: str) -> tuple[str, list[str]]:
    """The header line (that of the first file in name order) and its names."""
    first = _lines(spark, path).groupBy(_FILE).agg(F.first(_RAW).alias("h")).orderBy(_FILE).first()
    if first is None:
        raise ValueError("no files, or only empty ones, to infer columns from")
    row = spark.createDataFrame([(first["h"],)], "h string").select(
        F.from_csv("h", ", ".join(f"c{i} string" for i in range(first["h"].count(sep) + 1)), {"sep": sep}).alias("n")).select("n.*").first()
    names = [n for n in row if n is not None]
    if len(set(names)) != len(names):
        raise ValueError(f"repeated column names in the header: {names}")
    return first["h"], names


def _data(spark: SparkSession, path: str | Sequence[str], sep: str, names: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """Data lines (no headers, no blank lines) and the column names: ``names`` for files without headers."""
    lines = _lines(spark, path).filter(F.length(F.trim(_RAW)) > 0)
    if names is not None:
        return lines, list(names)
    header, found = _header(spark, path, sep)
    return lines.filter(F.col(_RAW) != F.lit(header)), found


def column_facts(spark: SparkSession, path: str | Sequence[str], sep: str = ",", null_text: str = "",
                 names: Sequence[str] | None = None) -> DataFrame:
    """The lattice facts of every column over all files: one row a column.

    ``column, position, n_rows, n_present`` and for each type how many fields do not fit it. Rows of a
    wrong width say nothing about types and are not counted. ``names`` are the columns of files
    without a header line.
    """
    lines, names = _data(spark, path, sep, names)
    rows = _fields(lines, names, sep, null_text).filter("__f.__extra is null")
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, n in enumerate(names):
        text = F.col(f"__f.`{n}`")
        aggs.append(F.count(text).alias(f"p{i}"))
        aggs += [F.count_if(text.isNotNull() & ~_fits(text, t)).alias(f"{t}{i}") for t in TYPES]
    wide = rows.agg(*aggs)
    each = F.inline(F.array(*[F.struct(
        F.lit(n).alias("column"), F.lit(i).alias("position"), F.col("n").alias("n_rows"), F.col(f"p{i}").alias("n_present"),
        *[F.col(f"{t}{i}").alias(f"not_{t}") for t in TYPES]) for i, n in enumerate(names)]))
    return wide.select(each)


def merge_facts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Facts of the files of both: counts add up."""
    return a.unionByName(b).groupBy("column").agg(
        F.min("position").alias("position"), *[F.sum(c).alias(c) for c in ("n_rows", "n_present", *[f"not_{t}" for t in TYPES])])


def column_types(facts: DataFrame) -> DataFrame:
    """``column, position, type``: the narrowest type that all fields fit; a column without values is a string."""
    kind = F.lit("string")
    for t in reversed(TYPES):
        kind = F.when(F.col(f"not_{t}") == 0, F.lit(t)).otherwise(kind)
    return facts.select("column", "position", F.when(F.col("n_present") == 0, F.lit("string")).otherwise(kind).alias("type"))


def infer_schema(spark: SparkSession, path: str | Sequence[str], sep: str = ",", null_text: str = "") -> StructType:
    """Schema of delimited files with a header, from all their rows."""
    rows = column_types(column_facts(spark, path, sep, null_text)).orderBy("position").collect()
    return spark.createDataFrame([], ", ".join(f"`{r['column']}` {r['type']}" for r in rows)).schema


def scan_with_rejects(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, sep: str = ",",
                      null_text: str = "", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects) of delimited files; every data line is in one of them.

    Without a header line (``header=False``) the schema is needed and names the columns.

    Rejects: ``file, line, reason, column``; the reason is ``fields`` (too many or too few) or
    ``type`` with the first column that does not parse. The lines are parsed once, to a table in
    the shared folder that both results read.
    """
    if schema is None and not header:
        raise ValueError("files without a header need a schema")
    data, names = _data(spark, path, sep, None if header else schema.fieldNames())
    if schema is None:
        schema = infer_schema(spark, path, sep, null_text)
    if [f.name for f in schema.fields] != names:
        raise ValueError(f"columns {[f.name for f in schema.fields]} expected, the header has {names}")
    parsed = _fields(data, names, sep, null_text)
    wrong_width = F.col("__f.__extra").isNotNull()
    first_bad, values = F.lit(None).cast("string"), []
    for f in reversed(schema.fields):
        text, kind = F.col(f"__f.`{f.name}`"), f.dataType.simpleString()
        if not isinstance(f.dataType, StringType):
            odd = text.isNotNull() & (~_fits(text, kind) if kind in TYPES else text.try_cast(f.dataType).isNull())
            first_bad = F.when(odd, F.lit(f.name)).otherwise(first_bad)
        values.insert(0, text.try_cast(f.dataType).alias(f.name))
    marked = parsed.select(F.struct(*values).alias("__row"), _RAW, _FILE, wrong_width.alias("__width"), first_bad.alias("__bad"))
    kept = scratch_dir(spark, "delimited")
    marked.write.parquet(kept)
    marked = spark.read.schema(marked.schema).parquet(kept)
    good = ~F.col("__width") & F.col("__bad").isNull()
    rejects = marked.filter(~good).select(
        F.col(_FILE).alias("file"), F.col(_RAW).alias("line"), F.when(F.col("__width"), "fields").otherwise("type").alias("reason"),
        F.when(~F.col("__width"), F.col("__bad")).alias("column"))
    return marked.filter(good).select("__row.*"), rejects
