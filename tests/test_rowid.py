from keelson.operators.rowid import add_row_id


def _ids(df):
    return sorted((tuple(r[:-1]), r[-1]) for r in df.collect())


def test_exact_copies_get_distinct_stable_ids(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, None)], "x int, y string")
    first = _ids(add_row_id(df))
    assert len({i for _, i in first}) == 4
    assert all(len(i) == 32 for _, i in first)
    assert first == _ids(add_row_id(df))


def test_ids_do_not_depend_on_partitioning_or_chunking(spark):
    df = spark.createDataFrame([(i % 7, f"s{i % 3}") for i in range(300)], "x int, y string")
    want = _ids(add_row_id(df))
    for n in (1, 4, 7):
        assert _ids(add_row_id(df.repartition(n))) == want
    # a hot content split into chunks of 5 ordinals gives the same ids
    assert _ids(add_row_id(df, chunk=5)) == want


def test_null_fields_do_not_collide(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "p string, q string")
    assert len({r.id for r in add_row_id(df).collect()}) == 2


def test_natural_key_needs_no_shuffle(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    out = add_row_id(df, key="k")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_unique_rows_skip_the_counting_path_with_the_same_ids(spark):
    rows = [(i, f"u{i}") for i in range(200)] + [(7, "dup")] * 4
    df = spark.createDataFrame(rows, "x int, y string")
    fast = _ids(add_row_id(df, unique_fast_path=True))   # unique rows by broadcast anti join
    slow = _ids(add_row_id(df))                          # every row through the counts
    assert _ids(add_row_id(df, unique_fast_path=True, broadcast_max=0)) == slow
    assert fast == slow
    assert len({i for _, i in fast}) == 204


def test_ids_follow_the_documented_formula(spark):
    import hashlib
    from collections import defaultdict

    rows = [(1, "a"), (1, "a"), (None, "b"), (2, None), (1, "a")]
    df = spark.createDataFrame(rows, "x int, y string")
    seen = defaultdict(int)
    want = []
    for r in rows:
        text = "".join("-1:" if v is None else f"{len(str(v))}:{v}" for v in r)
        seen[text] += 1
        want.append((r, hashlib.md5(f"{text}#{seen[text]}".encode()).hexdigest()))
    got = [((r.x, r.y), r.id) for r in add_row_id(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ids_do_not_collide_on_separators_or_nulls(spark):
    rows = [(None, "a"), ("\u0000", "a"), ("x\u001fy", "z"), ("x", "y\u001fz"), ("-1:", "a"), ("", "a"), ("1:a", ""), ("1", ":a")]
    ids = [r.id for r in add_row_id(spark.createDataFrame(rows, "x string, y string")).collect()]
    assert len(set(ids)) == len(rows)


def test_ids_do_not_depend_on_the_session_time_zone(spark):
    df = spark.sql("select timestamp_micros(1700000000123456 + id * 3600000000) as t, id from range(5)")
    got = []
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got.append(sorted((r.n, r.id) for r in add_row_id(df.withColumnRenamed("id", "n")).select("n", "id").collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1]
