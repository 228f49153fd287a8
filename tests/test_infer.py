from pathlib import Path

import pytest

from keelson.sources import infer


def _files(tmp_path, *texts):
    for k, text in enumerate(texts):
        Path(tmp_path, f"part-{k}.csv").write_text(text)
    return str(tmp_path)


def test_types_are_the_join_over_all_files(spark, tmp_path):
    path = _files(tmp_path, "a,b,c,d,e,f,g,h\n1,2,1.5,true,2024-01-02,x,,2024-01-02 03:04:05\n",
                  "a,b,c,d,e,f,g,h\n-7,3000000000,2,FALSE,2024-02-30x,1,,2024-01-03\n,5,-.5e3,,2024-01-01,,,\n")
    facts = infer.column_facts(spark, path)
    got = {r["column"]: r["type"] for r in infer.column_types(facts).collect()}
    assert got == {"a": "int", "b": "bigint", "c": "double", "d": "boolean", "e": "string", "f": "string", "g": "string", "h": "timestamp_ntz"}
    parts = [infer.column_facts(spark, f"{path}/part-{k}.csv") for k in (0, 1)]
    merged = {r["column"]: r["type"] for r in infer.column_types(infer.merge_facts(*parts)).collect()}
    assert merged == got
    assert infer.infer_schema(spark, path).fieldNames() == list("abcdefgh")


def test_every_line_is_typed_or_rejected(spark, tmp_path):
    path = _files(tmp_path, 'id,when,what\n1,2024-01-02,"a, b"\n2,2024-13-02,c\nx,2024-01-02,d\n3,2024-01-02\n4,2024-01-02,e,more\n\n,,\n')
    schema = spark.createDataFrame([], "id int, when date, what string").schema
    rows, rejects = infer.scan_with_rejects(spark, path, schema)
    assert {(r.id, r.what) for r in rows.collect()} == {(1, "a, b"), (None, None)}
    assert {(r.line, r.reason, r.column) for r in rejects.collect()} == {
        ("2,2024-13-02,c", "type", "when"), ("x,2024-01-02,d", "type", "id"), ("3,2024-01-02", "fields", None), ("4,2024-01-02,e,more", "fields", None)}
    with pytest.raises(ValueError, match="header"):
        infer.scan_with_rejects(spark, path, spark.createDataFrame([], "id int").schema)
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(ValueError, match="no files"):
        infer.infer_schema(spark, _files(empty, ""))
