"""The month-partitioned log table: what is kept, what is read, what retention drops."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.operators import log_table as T

MONTHS = [dt.datetime(2023, 10, 30), dt.datetime(2023, 11, 2), dt.datetime(2023, 11, 25), dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 2, 1)]


@pytest.fixture
def table(spark, tmp_path):
    rows = [(k, ts, '{"k": 1}') for k in range(3) for ts in MONTHS]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, context string")
    t = T.LogTable(spark, str(tmp_path / "logs"))
    t.append(df)
    return t


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_context_keeps_types(spark):
    ctx = {"n": "42", "x": "1.5", "b": "true", "s": "a b", "o": '{"p":[1,2]}', "none": None, "q": 'say "hi"'}
    row = spark.createDataFrame([(ctx,)], "c map<string,string>").select(T.typed_context(F.col("c")).alias("v"))
    got = row.select(*[F.schema_of_variant(F.variant_get("v", p, "variant")).alias(n) for n, p in
                       [("n", "$.n"), ("x", "$.x"), ("b", "$.b"), ("s", "$.s"), ("o", "$.o.p[1]")]],
                     F.variant_get("v", "$.q", "string").alias("q"), F.variant_get("v", "$.o.p[1]", "int").alias("one")).first().asDict()
    assert got == {"n": "BIGINT", "x": "DECIMAL(2,1)", "b": "BOOLEAN", "s": "STRING", "o": "BIGINT", "q": 'say "hi"', "one": 2}
    assert spark.createDataFrame([(None,)], "c map<string,string>").select(T.typed_context(F.col("c")).alias("v")).first()["v"] is None


def test_reads_prune_months(spark, table):
    part = table.read(F.lit("2023-11-10").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz"))
    assert part.count() == 6 and {r["month"].month for r in part.collect()} == {11, 1}
    scans = [line for line in plan(part).splitlines() if "PartitionFilters" in line]
    assert scans and "2023-11-01" in scans[0] and "month" in scans[0]


def test_counts_come_from_footers(spark, table):
    counts = table.month_counts()
    assert counts == {dt.date(2023, 10, 1): 3, dt.date(2023, 11, 1): 6, dt.date(2024, 1, 1): 3, dt.date(2024, 2, 1): 3}
    assert "PushedAggregation: [COUNT(*)]" in plan(table.month_counts_frame())
    months = {r["start"]: r["rows"] for r in table.calendar(dt.date(2024, 2, 15), 2).collect()}
    assert list(months.values()) == [3, 6, 0, 3, 3, 0, 0] and list(months)[-1] == dt.date(2024, 4, 1)


def test_retention_drops_whole_months_once(spark, table):
    as_of = dt.datetime(2024, 2, 3)
    plan_rows = {r["month"]: (r["drop"], r["rows_lost_early"]) for r in table.retention(as_of, 75).collect()}
    assert plan_rows == {dt.date(2023, 10, 1): (True, 0), dt.date(2023, 11, 1): (True, 3), dt.date(2024, 1, 1): (False, 0), dt.date(2024, 2, 1): (False, 0)}
    assert table.read().count() == 15 and table.dropped() == []
    assert table.apply_retention(as_of, 75) == [dt.date(2023, 10, 1), dt.date(2023, 11, 1)]
    assert table.apply_retention(as_of, 75) == [] and table.read().count() == 6
    assert table.month_counts() == {dt.date(2024, 1, 1): 3, dt.date(2024, 2, 1): 3}
    table.append(spark.createDataFrame([(9, MONTHS[0], "{}"), (9, MONTHS[4], "{}")], "event_id long, ts timestamp_ntz, context string"))
    assert table.read().count() == 7          # late rows of a dropped month stay out


def test_month_starts_at_the_cutoff_are_kept(table):
    assert table.apply_retention(dt.datetime(2023, 11, 11), 10) == [dt.date(2023, 10, 1)]
