"""Skew-safe numbering equals the plain window, also when one group holds most rows."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators.ranking import day_slice, number_within_groups


def test_numbering_matches_window_with_a_hot_group(spark):
    rows = [(i, 1 if i % 10 else 2 + i % 3, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 50) if i % 7 else None)
            for i in range(400)]  # group 1 holds 90% of the rows, over three days plus nulls
    df = spark.createDataFrame(rows, "id long, g long, ts timestamp_ntz")
    order = [F.col("ts").asc_nulls_last(), F.col("id").asc()]
    got = number_within_groups(df, ["g"], order, day_slice("ts"), next_of="ts")
    w = Window.partitionBy("g").orderBy(*order)
    want = df.select("id", F.row_number().over(w).alias("rn"), F.lead("ts").over(w).alias("next_ts"),
                     F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_rows"))
    assert sorted(got.select("id", "rn", "next_ts", "group_rows").collect()) == sorted(want.collect())
