"""Property test: exact per-class test sizes for arbitrary class mixes."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.operators import split

sizes = st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(class_sizes=sizes, null_rows=st.integers(min_value=0, max_value=7),
       fraction=st.sampled_from([0.1, 0.2, 0.5]))
def test_each_class_sends_its_rounded_share_to_test(spark, class_sizes, null_rows, fraction):
    rows, k = [], 0
    for label, n in enumerate(class_sizes):
        for _ in range(n):
            rows.append((k, f"c{label}"))
            k += 1
    for _ in range(null_rows):
        rows.append((k, None))
        k += 1
    df = spark.createDataFrame(rows, "id int, y string")
    out = split.stratified_split(df, "y", "id", fraction, seed=7).collect()
    assert sorted(r.id for r in out) == list(range(k))  # every row once
    total = Counter(r.y for r in out)
    test = Counter(r.y for r in out if r.split == "test")
    for label, n in total.items():
        assert test[label] == int(n * fraction + 0.5)
    assert set(r.split for r in out) <= {"train", "test"}
    assert df.where(F.col("y").isNull()).count() == null_rows
