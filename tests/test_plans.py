"""Physical-plan checks: pushdown, pruning, partition pruning, top-k, broadcast of bounded dimensions."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.functions.time import time_range
from tidemill.operators import clients as CL
from tidemill.operators import features as FE
from tidemill.operators import logs as L
from tidemill.operators import messages as MS
from tidemill.operators import partitions as P
from tidemill.operators import tenants as T
from tidemill.plans import registry
from tidemill.plans.params import as_of_ntz
from tidemill.sources import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_stats_pushes_time_filter_and_prunes_columns(spark):
    df = L.log_stats(fx.logs(spark, SF_SMALL), as_of_ntz(), 24)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    # only the columns the job needs reach the scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_time_range_prunes_month_partitions(spark, tmp_path):
    logs = fx.logs(spark, SF_SMALL)
    path = str(tmp_path / "logs")
    P.with_month(logs).write.partitionBy("month").parquet(path)
    back = spark.read.parquet(path)
    lo = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    hi = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    p = plan(time_range(back, "ts", lo, hi, month_col="month"))
    assert "PartitionFilters: [isnotnull(month" in p
    assert time_range(back, "ts", lo, hi, "month").count() == logs.filter(
        (F.col("ts") >= lo) & (F.col("ts") < hi)).count()


def test_last_errors_is_a_top_k(spark):
    p = plan(L.last_errors(fx.logs(spark, SF_SMALL), "messenger"))
    assert "TakeOrderedAndProject(limit=20" in p


def test_stream_trim_limits_before_the_shuffle(spark):
    raw = fx.raw_messages(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(MS.newest_per_stream(raw, 10))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_calendar_dimensions_are_broadcast(spark):
    d = FE.daily_demand(fx.sales(spark, SF_SMALL), ["client_id"])
    assert "BroadcastHashJoin" in plan(FE.weather_features(d, fx.weather(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in plan(FE.seasonality(d, fx.holidays(spark, SF_SMALL)))


def test_client_fold_uses_partial_aggregation(spark):
    df = registry.queries()["clients_upsert"](spark, SF_SMALL)
    p = plan(df)
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 2


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_messages_are_decoded_once_under_later_filters(spark):
    q = registry.queries()
    decodes = optimized(q["message_outcomes"](spark, SF_SMALL)).count("from_json")
    assert decodes > 0
    for key in ("dead_letters", "pending_messages", "consumer_lag"):
        assert optimized(q[key](spark, SF_SMALL)).count("from_json") <= decodes, key


def test_weather_rows_that_repeat_a_day_do_not_repeat_demand(spark):
    day = dt.date(2024, 1, 1)
    daily = spark.createDataFrame([(1, day, "a", 2.0)], "client_id int, ds date, site string, qty double")
    weather = spark.createDataFrame([(day, "a", 1.0, 0.0, 3.0), (day, "a", 2.0, 0.0, 1.0), (day, "b", 9.0, 0.0, 1.0)],
                                    "ds date, site string, temperature double, precipitation double, wind double")
    assert [r["temperature"] for r in FE.weather_features(daily, weather).collect()] == [9.0]
    assert [r["temperature"] for r in FE.weather_features(daily, weather, site="site").collect()] == [2.0]


def test_latency_levels_are_exact(spark):
    days = [(dt.date(2024, 1, d), [((7 * k * d) % 31) / 4 for k in range(n)]) for d, n in ((1, 1), (2, 2), (3, 99), (4, 100))]
    rows = [(len(str(v)) % 3, d, v) for d, values in days for v in values]
    odd = [(0, dt.date(2024, 1, 4), None), (0, dt.date(2024, 1, 5), None)]
    usage = spark.createDataFrame(rows + odd, "tenant_id int, day date, latency_ms double")
    p95, median = T.latency_levels(usage)
    assert {r["day"]: r["cluster_median"] for r in median.collect()} == {d: statistics.median(values) for d, values in days}
    want = {}
    for tenant, d, v in rows:
        want.setdefault((tenant, d), []).append(v)
    found = {(r["tenant_id"], r["day"]): r["p95"] for r in p95.collect()}
    assert found.keys() == want.keys()
    for key, values in want.items():
        values.sort()
        at = 0.95 * (len(values) - 1)
        low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
        assert found[key] == pytest.approx(low + (at - int(at)) * (high - low))


def test_gates_and_state_after_aggregation(spark):
    clients = spark.createDataFrame([(1, "active", True), (2, "active", None), (3, "archived", True)],
                                    "id int, status string, config_confirmed boolean")
    day = lambda d: dt.date(2024, 1, d)
    rows = spark.createDataFrame([(1, day(3)), (1, day(5)), (2, day(2)), (3, day(1)), (4, day(4)), (4, None), (None, day(1))],
                                 "client_id int, ds date")
    held = {r["client_id"]: (r["n_rows"], r["reason"]) for r in CL.gate_blocked(rows, clients).collect()}
    assert held == {2: (1, "not_confirmed"), 3: (1, "inactive"), 4: (2, "not_found"), None: (1, "not_found")}
    state = spark.createDataFrame([(1, day(4)), (2, day(9)), (5, None)], "client_id int, last_processed_at date")
    now = {r["client_id"]: r["last_processed_at"] for r in CL.advance_state(rows, state).collect()}
    assert now == {1: day(5), 2: day(9), 3: day(1), 4: day(4), 5: None, None: day(1)}


def test_a_sale_moves_once_with_its_components(spark):
    from tidemill.operators import bom as B
    sales = spark.createDataFrame([(7, 3, "2024-01-05", 2.0), (7, 4, "2024-01-05", 1.0)], "client_id long, product_id long, ds string, qty double")
    exploded = spark.createDataFrame([(3, 1, 2.0), (3, 2, 1.0), (4, 1, 0.5)], "root long, component long, qty double")
    demand = B.component_demand(sales, exploded, 20 * B.SALES_PER_TASK)
    plan = demand._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("component" in line for line in moves) and any("ds" in line and ", 20)" in line for line in moves)
    assert {tuple(r) for r in demand.collect()} == {(7, 1, "2024-01-05", 4.5), (7, 2, "2024-01-05", 2.0)}


def test_windows_get_more_tasks_with_more_rows(spark):
    from tidemill.operators import features as FE
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(10)
    assert FE.spread_by_key(rows, ["id"], (few + 7) * FE.DAYS_PER_TASK).rdd.getNumPartitions() == few + 7
    assert FE.spread_by_key(rows, ["id"], 10).rdd.getNumPartitions() == few
