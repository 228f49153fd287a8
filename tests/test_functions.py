import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from keelson.functions.hashing import hash60, keyed_text
from keelson.functions.text import format_timestamp, name_version, relative_path
from keelson.session import scratch_dir
from keelson.sources.files import scan_csv


def _py_hash60(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_hash60_is_the_first_60_bits_of_md5(spark):
    df = spark.createDataFrame([(0, "a"), (42, None), (123456789012, "")], "k bigint, s string")
    got = df.select("k", "s", hash60(keyed_text(df, ["k", "s"], "test", 7)).alias("h")).collect()
    for r in got:
        fields = f"{len(str(r.k))}:{r.k}" + ("-1:" if r.s is None else f"{len(r.s)}:{r.s}")
        assert r.h == _py_hash60(f"test/7|{fields}")
        assert 0 <= r.h < 2 ** 60


def test_text_helpers(spark):
    df = spark.createDataFrame([("http://a.example.com/x", dt.datetime(2024, 1, 2, 3, 4, 5, 600000), "ds", 3),
                                ("no-marker", dt.datetime(1999, 12, 31, 23, 59, 59), "ds", 1)],
                               "url string, ts timestamp_ntz, name string, v int")
    rows = df.select(relative_path("url", "://").alias("p"), format_timestamp("ts").alias("t"),
                     name_version("name", "v").alias("nv")).collect()
    assert [(r.p, r.t, r.nv) for r in rows] == [("a.example.com/x", "2024-01-02 03:04:05", "ds: 3"),
                                                 (None, "1999-12-31 23:59:59", "ds: 1")]


def test_csv_scan_uses_the_declared_schema_and_fails_fast(spark):
    path = scratch_dir(spark, "csv")
    spark.createDataFrame([("1", "a"), ("x", "b")], "k string, v string").write.option("header", "true").csv(path)
    df = scan_csv(spark, path, "k bigint, v string")
    assert df.schema.simpleString() == "struct<k:bigint,v:string>"
    with pytest.raises(Exception):
        df.collect()
    assert scan_csv(spark, path, "k string, v string").where(F.col("k") == "x").count() == 1
