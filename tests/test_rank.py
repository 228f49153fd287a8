from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators.rank import rank_within_groups


def test_rank_matches_row_number_with_a_hot_group(spark):
    # group 0 holds about a third of the rows; nulls form a group of their own
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise(F.col("id") % 50).alias("g"),
        F.col("id"), (F.col("id") * 7919 % 1000).alias("o"))
    want = {(r.id, r.rn) for r in df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("g").orderBy("o", "id"))).collect()}
    for n in (1, 4, 7):
        for bound in (10, 1_000_000):  # sort-based path and window path
            got = rank_within_groups(df.repartition(n), ["g"], ["o", "id"], "rn", max_group_rows=bound)
            assert {(r.id, r.rn) for r in got.collect()} == want
