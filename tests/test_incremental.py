"""Incremental feature runs against full recomputation, and what a run reads and writes."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import features as FE
from tidemill.operators import incremental as INC

SCHEMA = "client_id long, ds date, qty double"
DAY0 = dt.date(2024, 1, 1)


def facts_of(rng, n, clients=4, span=500):
    return [(rng.randrange(clients), DAY0 + dt.timedelta(days=rng.randrange(span)), float(rng.randrange(1, 20))) for _ in range(n)]


def rows(df):
    return sorted(tuple(r) for r in df.select("client_id", "ds", "qty", "n_obs", "ema", "ma", "std").collect())


def full(spark, facts, **kw):
    return rows(FE.rolling_features(FE.daily_demand(spark.createDataFrame(facts, SCHEMA), ["client_id"]), ["client_id"], **kw))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("strategy", ["decay", "drop"])
def test_runs_equal_a_full_recomputation(spark, tmp_path, strategy):
    """New, late, corrected and removed days; a repeated run changes nothing."""
    rng = random.Random(11)
    kw = dict(window_days=30, min_samples=3, nan_strategy=strategy)
    facts = facts_of(rng, 300, span=400)
    store = str(tmp_path / "store")
    df = lambda x: spark.createDataFrame(x, SCHEMA)
    INC.feature_run(df(facts), df(facts), store, **kw)
    assert rows(INC.stored_features(spark, store)) == full(spark, facts, **kw)
    late = [(1, DAY0 + dt.timedelta(days=k), 3.0) for k in (50, 51, 200)] + [(9, DAY0 + dt.timedelta(days=20), 4.0)]
    newer = [(c, DAY0 + dt.timedelta(days=400 + k), 2.0) for c in range(3) for k in range(8)]
    gone = [f for f in facts if f[0] == 2][:4]
    fixed = [(c, d, q + 1) if c == 3 and d.month == 2 else (c, d, q) for c, d, q in facts if (c, d) not in {(g[0], g[1]) for g in gone}]
    changed = late + newer + gone + [f for f in facts if f[0] == 3 and f[1].month == 2]
    facts = fixed + late + newer
    for _ in range(2):
        INC.feature_run(df(facts), df(changed), store, **kw)
        assert rows(INC.stored_features(spark, store)) == full(spark, facts, **kw)
    state = {r.client_id: r.last_processed_at for r in INC.stored_state(spark, store).collect()}
    assert state[0] == DAY0 + dt.timedelta(days=407) and state[9] == DAY0 + dt.timedelta(days=20)


def test_a_late_day_rewrites_only_the_months_of_its_window(spark, tmp_path):
    store = str(tmp_path / "store")
    facts = [(c, DAY0 + dt.timedelta(days=k), 1.0 + k) for c in (1, 2) for k in range(360)]
    df = spark.createDataFrame(facts, SCHEMA)
    INC.feature_run(df, df, store, window_days=30, min_samples=3)
    before = files(store + "/features")
    late = [(1, dt.date(2024, 5, 20), 500.0)]
    months = INC.feature_run(spark.createDataFrame(facts + late, SCHEMA), spark.createDataFrame(late, SCHEMA), store, window_days=30, min_samples=3)
    assert months == [dt.date(2024, 5, 1), dt.date(2024, 6, 1)]
    after = files(store + "/features")
    assert {p for p in before if "2024-05" not in p and "2024-06" not in p} <= after.keys()
    assert all(after[p] == t for p, t in before.items() if p in after and "2024-05" not in p and "2024-06" not in p)
    assert rows(INC.stored_features(spark, store)) == full(spark, facts + late, window_days=30, min_samples=3)


def test_the_series_is_read_by_month(spark, tmp_path):
    """Partition filters stand in the plan of what a run reads."""
    path = str(tmp_path / "daily")
    spark.createDataFrame([(1, DAY0 + dt.timedelta(days=k), 1.0) for k in range(200)], SCHEMA).withColumn(
        "month", F.trunc("ds", "month")).write.partitionBy("month").parquet(path)
    dirty = INC.dirty_intervals(spark.createDataFrame([(1, dt.date(2024, 3, 5))], "client_id long, ds date"), 10)
    months = INC.months_between(dirty)
    assert months == [dt.date(2024, 3, 1)]
    plan = spark.read.parquet(path).filter(F.col("month").isin(months))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2024-03-01" in plan


def test_dirty_intervals_coalesce(spark):
    days = [(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 11)), (1, dt.date(2024, 1, 22)), (2, dt.date(2024, 1, 5))]
    got = INC.dirty_intervals(spark.createDataFrame(days, "client_id long, ds date"), 10)
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, dt.date(2024, 1, 1), dt.date(2024, 1, 20)), (1, dt.date(2024, 1, 22), dt.date(2024, 1, 31)), (2, dt.date(2024, 1, 5), dt.date(2024, 1, 14))]


def test_blocked_clients_wait_for_their_confirmation(spark, tmp_path):
    store = str(tmp_path / "store")
    facts = [(c, DAY0 + dt.timedelta(days=k), 1.0) for c in (1, 2, 3) for k in range(20)]
    df = spark.createDataFrame(facts, SCHEMA)
    table = lambda *ok: spark.createDataFrame([(c, "active", c in ok) for c in (1, 2, 3)], "id long, status string, config_confirmed boolean")
    INC.feature_run(df, df, store, table(1))
    assert {r.client_id for r in INC.stored_features(spark, store).select("client_id").distinct().collect()} == {1}
    assert {r.client_id for r in INC.stored_state(spark, store).collect()} == {1}
    more = spark.createDataFrame([(1, DAY0 + dt.timedelta(days=20))], "client_id long, ds date")
    facts = facts + [(1, DAY0 + dt.timedelta(days=20), 5.0)]
    INC.feature_run(spark.createDataFrame(facts, SCHEMA), more, store, table(1, 2))
    assert rows(INC.stored_features(spark, store)) == full(spark, [f for f in facts if f[0] != 3])
    assert INC.new_days(spark.createDataFrame(facts, SCHEMA), INC.stored_state(spark, store)).select("client_id").distinct().count() == 1


def test_fill_zero_is_refused(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        INC.feature_run(df, df, str(tmp_path / "s"), nan_strategy="fill_zero")


def test_single_days_are_joined_by_equality(spark):
    rows = spark.createDataFrame([(1, "2024-01-05"), (1, "2024-01-06"), (2, "2024-01-05")], "client_id long, ds string")
    days = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-01-07")], "client_id long, lo string")
    for how, want in (("left_semi", {(1, "2024-01-05")}), ("left_anti", {(1, "2024-01-06"), (2, "2024-01-05")})):
        assert {tuple(r) for r in INC.within(rows, days, how=how).collect()} == want
