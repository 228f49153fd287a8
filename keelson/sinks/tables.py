"""Catalog tables and feature tables (K3-K7, table DDL).

A feature table is an ordinary catalog table plus two facts stored with it:
its primary key (table property ``primary_keys``, comma-separated) and a
description (the table comment). The key contract (see ``keys``) is checked
whenever rows are written or a table is adopted, so lookups can trust it.

An overwrite writes its rows as a snapshot, a folder of its own beside the table's
first one, checks the key on what was written and then switches the table to it: one
change of the table's location in the catalog. Until then the table holds its old
rows, whatever fails; a snapshot that was not switched to is removed, the
one before the current is kept for readers that still use it, older ones go. So the
input is computed once and a table can be rewritten from its own rows.

A new schema cannot be switched by a location alone. The new table is made
complete under another name (``<name>__next``) with the old one's comment, format
and properties, and two renames put it in place, the old table waiting as
``<name>__prev`` in between. A writer that fails there renames it back; after a
killed one the next write does, or ``recover_table``.

Appended rows are staged and checked likewise, then inserted;
``insertInto`` matches columns by position, so the frame is put in the table's
column order by name.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from keelson.operators.keys import PrimaryKeyError, assert_primary_key
from keelson.session import scratch_dir
from keelson.sinks import commits

PK_PROPERTY = "primary_keys"
# Properties that the catalog keeps for itself.
_OWN_PROPERTIES = ("spark.sql.", "transient_", "EXTERNAL", "TRANSLATED_TO_EXTERNAL", "numFiles", "totalSize", "bucketing_version")


def quote_name(name: str) -> str:
    """`schema`.`table` from schema.table (a name part may not hold a dot)."""
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    loc = f" LOCATION {_sql_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_name(schema)}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(name)}")


def create_table(spark: SparkSession, name: str, schema: StructType | str,
                 comment: str | None = None, properties: dict[str, str] | None = None,
                 location: str | None = None, fmt: str = "parquet",
                 if_not_exists: bool = True, buckets: tuple[int, Sequence[str]] | None = None) -> None:
    """CREATE TABLE with typed columns (K6); ``buckets`` is a number and the columns that deal and sort the rows."""
    cols = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = [f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{quote_name(name)} ({cols})",
             f"USING {fmt}"]
    if buckets:
        by = ", ".join(f"`{k}`" for k in buckets[1])
        parts.append(f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets[0]} BUCKETS")
    if comment is not None:
        parts.append(f"COMMENT {_sql_text(comment)}")
    if location:
        parts.append(f"LOCATION {_sql_text(location)}")
    if properties:
        props = ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({props})")
    spark.sql("\n".join(parts))


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote_name(name)}").collect()}


def table_primary_keys(spark: SparkSession, name: str) -> list[str]:
    value = table_properties(spark, name).get(PK_PROPERTY, "")
    return [k.strip() for k in value.split(",") if k.strip()]


def table_location(spark: SparkSession, name: str) -> str | None:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect():
        if r["col_name"] == "Location":
            return r["data_type"]
    return None


def table_comment(spark: SparkSession, name: str) -> str | None:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect():
        if r["col_name"] == "Comment":
            return r["data_type"]
    return None


def set_feature_metadata(spark: SparkSession, name: str, primary_keys: str | Sequence[str],
                         description: str | None) -> None:
    keys = ",".join(_keys(primary_keys))
    spark.sql(f"ALTER TABLE {quote_name(name)} SET TBLPROPERTIES "
              f"({_sql_text(PK_PROPERTY)} = {_sql_text(keys)})")
    if description is not None:
        spark.sql(f"COMMENT ON TABLE {quote_name(name)} IS {_sql_text(description)}")


def create_feature_table(spark: SparkSession, name: str, primary_keys: str | Sequence[str],
                         schema: StructType, description: str | None = None,
                         location: str | None = None, buckets: int | None = None) -> None:
    """K3: empty table from a schema, with key and description.

    With ``buckets`` rows are dealt to that many files by the key and sorted by it, on every
    overwrite. A lookup then joins without moving the feature side, if there are at least
    as many buckets as ``spark.sql.shuffle.partitions`` (Spark moves both sides otherwise).
    """
    keys = _keys(primary_keys)
    missing = [k for k in keys if k not in schema.fieldNames()]
    if missing:
        raise ValueError(f"primary key columns {missing} are not in the schema")
    create_table(spark, name, schema, comment=description,
                 properties={PK_PROPERTY: ",".join(keys)}, location=location,
                 buckets=(buckets, keys) if buckets else None)


def _in_table_order(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    cols = spark.table(name).columns
    missing = [c for c in cols if c not in df.columns]
    extra = [c for c in df.columns if c not in cols]
    if missing or extra:
        raise ValueError(f"frame does not match table {name}: missing {missing}, extra {extra}")
    return df.select(*cols)


def _same_schema(a: StructType, b: StructType) -> bool:
    return sorted((f.name, f.dataType.simpleString()) for f in a.fields) == \
        sorted((f.name, f.dataType.simpleString()) for f in b.fields)


def assert_new_keys(spark: SparkSession, name: str, df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if appending ``df`` would break the table's key: in itself or with the rows there."""
    assert_primary_key(df, keys, name=name)
    known = df.select(*keys).join(spark.table(name).select(*keys), list(keys), "left_semi")
    hit = known.take(3)
    if hit:
        raise PrimaryKeyError(f"{name}: keys to append are in the table already, e.g. {', '.join(str(tuple(r)) for r in hit)}")


def write_feature_table(spark: SparkSession, name: str, df: DataFrame, mode: str = "overwrite",
                        check_keys: bool = True) -> None:
    """K4: write rows into a feature table after checking its key.

    Same schema: the rows replace the table's rows, or extend them if no key is
    there yet. A new schema with ``mode="overwrite"`` replaces the table with its
    key, description and other properties kept. Whatever step fails, the old rows stay.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    recover_table(spark, name)
    keys = table_primary_keys(spark, name)
    if not keys:
        raise ValueError(f"{name} is not a feature table (no {PK_PROPERTY} property)")
    same = _same_schema(spark.table(name).schema, df.schema)
    if not same and mode != "overwrite":
        raise ValueError(f"schema of the frame differs from {name}; only mode='overwrite' may replace it")
    if mode == "append":
        path = scratch_dir(spark, "staged")
        try:
            rows = _write_snapshot(_in_table_order(spark, name, df), path, "parquet")
            assert_new_keys(spark, name, rows, keys)
            rows.write.insertInto(quote_name(name), overwrite=False)
        finally:
            commits.delete(spark, path)
        return
    facts = _facts(spark, name)
    fmt = facts.get("Provider", "parquet")
    base = table_properties(spark, name).get(BASE_PROPERTY) or facts["Location"]
    path = f"{base.rstrip('/')}.snapshots/{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    try:
        buckets = _buckets(facts, keys)
        ordered = _in_table_order(spark, name, df) if same else df
        rows = _write_buckets(ordered, name, path, fmt, buckets) if buckets else _write_snapshot(ordered, path, fmt)
        if check_keys:
            assert_primary_key(rows, keys, name=name)
        if same:
            if BASE_PROPERTY not in table_properties(spark, name):
                _set_property(spark, name, BASE_PROPERTY, base)
            _set_location(spark, name, path)
        else:
            _swap_in(spark, name, df.schema, path, fmt, facts, base)
    except BaseException:
        if not _is_at(spark, name, path):
            commits.delete(spark, path)
        raise
    _drop_old_snapshots(spark, base, keep={path, facts["Location"]})


# Where a table's snapshots lie beside: the location it was created with.
BASE_PROPERTY = "snapshot_base"
_NEXT, _PREV = "__next", "__prev"


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect()}


def _write_snapshot(df: DataFrame, path: str, fmt: str) -> DataFrame:
    df.write.mode("errorifexists").format(fmt).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def _buckets(facts: dict[str, str], keys: Sequence[str]) -> tuple[int, Sequence[str]] | None:
    """Number of buckets and their columns, for a table dealt by its key."""
    number = int(facts.get("Num Buckets", -1))
    return (number, keys) if number > 0 else None


def _write_buckets(df: DataFrame, name: str, path: str, fmt: str, buckets: tuple[int, Sequence[str]]) -> DataFrame:
    """A snapshot of one sorted file a bucket. Spark writes buckets through a table only: one that exists for this write."""
    spark, (number, keys) = df.sparkSession, buckets
    stage = f"{name}__stage{uuid.uuid4().hex[:8]}"
    try:
        (df.repartition(number, *keys).write.format(fmt).bucketBy(number, *keys).sortBy(*keys)
         .option("path", path).saveAsTable(quote_name(stage)))
    finally:
        drop_table(spark, stage)
    return spark.read.schema(df.schema).format(fmt).load(path)


def _set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {quote_name(name)} SET TBLPROPERTIES ({_sql_text(key)} = {_sql_text(value)})")


def _set_location(spark: SparkSession, name: str, path: str) -> None:
    """The switch: one change in the catalog."""
    spark.sql(f"ALTER TABLE {quote_name(name)} SET LOCATION {_sql_text(path)}")


def _rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quote_name(old)} RENAME TO {quote_name(new)}")


def _is_at(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the table reads from ``path`` (in doubt yes, so that nothing in use is removed)."""
    try:
        return not spark.catalog.tableExists(name) or (table_location(spark, name) or "").endswith(path.split(":")[-1])
    except Exception:
        return True


def _swap_in(spark: SparkSession, name: str, schema: StructType, path: str, fmt: str, facts: dict[str, str], base: str) -> None:
    """Put a table over the files at ``path`` in the place of ``name``; see the module text."""
    following, previous = name + _NEXT, name + _PREV
    properties = {k: v for k, v in table_properties(spark, name).items() if not k.startswith(_OWN_PROPERTIES)} | {BASE_PROPERTY: base}
    drop_table(spark, following)
    create_table(spark, following, schema, comment=facts.get("Comment"), properties=properties, location=path, fmt=fmt,
                 buckets=_buckets(facts, table_primary_keys(spark, name)))
    if facts.get("Type") != "EXTERNAL":
        # Renames and drops move or delete the files of a managed table; this one's files must stay.
        _detach(spark, name)
    try:
        _rename_table(spark, name, previous)
        _rename_table(spark, following, name)
    except BaseException:
        recover_table(spark, name)
        drop_table(spark, following)
        raise
    drop_table(spark, previous)


def _detach(spark: SparkSession, name: str) -> None:
    """Make a managed table external, its files where they are."""
    catalog = spark._jsparkSession.sessionState().catalog()
    schema, table = (["default", name] if "." not in name else [p.strip("`") for p in name.split(".")][-2:])
    identifier = spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier(table, spark._jvm.scala.Option.apply(schema))
    old = catalog.getTableMetadata(identifier)
    external = spark._jvm.org.apache.spark.sql.catalyst.catalog.CatalogTableType.EXTERNAL()
    fields = [getattr(old, f"copy$default${k}")() for k in range(1, old.productArity() + 1)]
    fields[1] = external
    catalog.alterTable(old.copy(*fields))


def recover_table(spark: SparkSession, name: str) -> bool:
    """Undo a replacement that was killed between its two renames; True if there was one."""
    previous = name + _PREV
    if not spark.catalog.tableExists(previous):
        return False
    if spark.catalog.tableExists(name):
        drop_table(spark, previous)       # the new table is in place: only the last step was missing
        return False
    _rename_table(spark, previous, name)
    return True


def _drop_old_snapshots(spark: SparkSession, base: str, keep: set[str]) -> None:
    folder = f"{base.rstrip('/')}.snapshots"
    kept = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    for child in commits.children(spark, folder):
        if child not in kept and int(child.split("-")[0]) < min((int(k.split("-")[0]) for k in kept if "-" in k and k.split("-")[0].isdigit()), default=0):
            commits.delete(spark, f"{folder}/{child}")


def register_feature_table(spark: SparkSession, name: str, primary_keys: str | Sequence[str],
                           description: str | None = None, check_keys: bool = True) -> None:
    """K5: adopt an existing table as a feature table."""
    if check_keys:
        assert_primary_key(spark.table(name), primary_keys, name=name)
    set_feature_metadata(spark, name, primary_keys, description)


def append_rows(spark: SparkSession, name: str, df: DataFrame) -> None:
    """K7: append rows, matching columns by name; a feature table's key is checked."""
    keys = table_primary_keys(spark, name)
    if keys:
        write_feature_table(spark, name, df, mode="append")
        return
    _in_table_order(spark, name, df).write.insertInto(quote_name(name), overwrite=False)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
               location: str | None = None) -> None:
    """K2 for tables: replace a table and its schema from a frame."""
    w = df.write.mode(mode).format(fmt)
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)
