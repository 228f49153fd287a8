"""Catalog scans (S4) and scans of registered datasets by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.operators.registry import resolve_dataset
from keelson.sinks.tables import quote_name


# Formats whose files do not say their column types.
TEXT_FORMATS = ("csv", "json")


def scan_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """Every column of a catalog table, by (optionally schema-qualified) name."""
    full = f"{database}.{name}" if database and "." not in name else name
    return spark.table(quote_name(full))


def scan_registered(spark: SparkSession, registry: DataFrame, name: str,
                    version: int | None = None) -> DataFrame:
    """The rows of a registered dataset, latest version unless given.

    The registry lookup returns one row (path, format, options, columns); the
    data itself is scanned lazily like any other source. Text formats are read
    with the columns recorded at registration, so a later read infers nothing.
    """
    entry = resolve_dataset(registry, name, version)
    reader = spark.read.format(entry["format"]).options(**(entry["options"] or {}))
    if entry["format"] in TEXT_FORMATS:
        reader = reader.schema(", ".join(f"`{f['name']}` {f['type']}" for f in entry["fields"]))
    return reader.load(entry["path"])
