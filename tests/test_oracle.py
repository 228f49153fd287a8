"""Every catalogue query against its DuckDB twin (row count, names, values)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from keelson.plans.queries import QUERIES
from keelson.sources.files import TABLES, table_path
from tools.check_oracle import normalise, value_hash

SF = os.environ.get("KEELSON_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert value_hash(normalise(got)) == value_hash(normalise(want))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "label"


@pytest.mark.parametrize("name", ["format_timestamp", "scan_csv", "register_versions", "head_rows"])
def test_time_bearing_queries_do_not_depend_on_the_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = entry.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert value_hash(normalise(got)) == value_hash(normalise(want))
