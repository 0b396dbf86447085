"""Incremental feature runs: gate, new and late days, features of the dirty days, state.

A feature row of day ``t`` reads the days ``[t - W + 1, t]``, so a changed day ``d`` makes the rows of
``[d, d + W - 1]`` dirty and nothing else. A run

1. holds back the changes of clients that are not active and confirmed (they wait in ``held`` and
   come back with the next run),
2. recomputes the changed days' totals from the facts, so that a repeated run gives the same days,
3. coalesces the dirty days of every client into intervals and reads the stored series only for
   these, plus ``W - 1`` days before each, from the months they touch,
4. recomputes the features of the dirty days, rewrites the touched months and no other, and
5. advances the clients' ``last_processed_at``.

The store is a folder with ``daily`` and ``features`` (by month), ``state`` and ``held`` (a folder a
run). Days whose facts are gone stay as rows without quantity, which readers leave out. State is
written last: a run that fails is repeated with the same changes and overwrites what it had written.
One run at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.time import month_key
from tidemill.operators import clients as CL
from tidemill.operators import features as FE
from tidemill.session import scratch_path

KEY = "client_id"
#: Strategies whose features depend on the frame's days only; ``fill_zero`` also on the series' ends.
FRAME_STRATEGIES = ("decay", "drop")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None where nothing is written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and reread: a table cannot be read while it is rewritten."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dirty_intervals(changed: DataFrame, window_days: int, key: str = KEY) -> DataFrame:
    """(key, lo, hi): the days whose features a change of the days in ``changed`` (key, ds) touches.

    Intervals of one key neither overlap nor touch; a key has at most one changed row per day.
    """
    w = Window.partitionBy(key).orderBy("ds")
    apart = F.datediff("ds", F.lag("ds").over(w)) > window_days
    run = F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(w)
    return (changed.select(key, "ds").distinct().select(key, "ds", run.alias("_run"))
                   .groupBy(key, "_run").agg(F.min("ds").alias("lo"), F.date_add(F.max("ds"), window_days - 1).alias("hi"))
                   .drop("_run"))


def months_between(intervals: DataFrame) -> list:
    """The months that the intervals touch; one value per calendar month, whatever the number of keys."""
    last = F.col("hi" if "hi" in intervals.columns else "lo")
    days = F.sequence(month_key(F.col("lo")), month_key(last), F.expr("interval 1 month"))
    return [r[0] for r in intervals.select(F.explode(days).alias("m")).distinct().orderBy("m").collect()]


def within(rows: DataFrame, intervals: DataFrame, key: str = KEY, how: str = "left_semi") -> DataFrame:
    """Rows (key, ds) inside (``left_semi``) or outside (``left_anti``) every interval of their key.

    Intervals without ``hi`` are single days, joined by equality: a key's rows are not compared with all its days.
    """
    if "hi" not in intervals.columns:
        return rows.join(intervals.select(key, F.col("lo").alias("ds")), [key, "ds"], how).select(rows.columns)
    i = intervals.select(F.col(key).alias("_key"), "lo", "hi")
    return rows.join(i, (F.col(key) == F.col("_key")) & F.col("ds").between(F.col("lo"), F.col("hi")), how)


def replace_days(spark: SparkSession, path: str, rows: DataFrame, intervals: DataFrame, key: str = KEY) -> list:
    """Put ``rows`` in place of the stored rows inside ``intervals``; returns the months rewritten.

    Only the months of ``rows`` and of stored rows inside the intervals are read and written; the other
    rows of these months are carried over.
    """
    months = months_between(intervals)
    out = rows.withColumn("month", month_key(F.col("ds")))
    old = _stored(spark, path)
    if old is not None:
        kept = within(old.filter(F.col("month").isin(months)), intervals, key, "left_anti").select(out.columns)
        hit = [r[0] for r in out.select("month").distinct().collect()]
        out = out.unionByName(kept.filter(F.col("month").isin(hit)))
    out = _staged(out, "days")
    order = ["month", key, "ds"]
    (out.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
    return [r[0] for r in out.select("month").distinct().orderBy("month").collect()]


def _last_run(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the newest run folder, read by partition value."""
    have = _stored(spark, path)
    if have is None:
        return None
    last = have.agg(F.max("run")).first()[0]
    return None if last is None else have.filter(F.col("run") == last)


def changed_days(facts: DataFrame, days: DataFrame, key: str = KEY) -> DataFrame:
    """(key, ds, qty): today's total of every (key, ds) of ``days``; null where no fact is left."""
    total = FE.daily_demand(facts.join(days.select(key, "ds").distinct(), [key, "ds"], "left_semi"), [key])
    return days.select(key, "ds").distinct().join(total, [key, "ds"], "left").select(key, "ds", F.col("qty").cast("double"))


def feature_run(facts: DataFrame, changed: DataFrame, store: str, clients: DataFrame | None = None,
                window_days: int = FE.DEFAULT_WINDOW_DAYS, alpha: float = FE.DEFAULT_ALPHA,
                min_samples: int = FE.DEFAULT_MIN_SAMPLES, nan_strategy: str = "decay", key: str = KEY) -> list:
    """One run over the changed days ``changed`` (key, ds); returns the feature months rewritten.

    ``facts`` (key, ds, qty) is the whole fact table, of which only the changed days are aggregated.
    With ``clients`` (id, status, config_confirmed) the gate applies. New, late, corrected and removed
    days are all just changed days.
    """
    if nan_strategy not in FRAME_STRATEGIES:
        raise ValueError(f"incremental runs need a strategy out of {FRAME_STRATEGIES}")
    spark = facts.sparkSession
    todo = changed.select(key, F.to_date("ds").alias("ds"))
    held = _last_run(spark, f"{store}/held")
    if held is not None:
        todo = todo.unionByName(held.select(key, "ds"))
    todo = _staged(todo.filter(F.col("ds").isNotNull()).distinct(), "todo")
    ready = todo
    if clients is not None:
        ready = _staged(CL.gate_eligible(todo, clients, key), "ready")
    days = _staged(changed_days(facts, ready, key), "changed")
    exact = days.select(key, F.col("ds").alias("lo"))
    replace_days(spark, f"{store}/daily", days, exact, key)

    dirty = _staged(dirty_intervals(days, window_days, key), "dirty")
    before = dirty.withColumn("lo", F.date_sub("lo", window_days - 1))
    daily = _stored(spark, f"{store}/daily")
    daily = daily.filter(F.col("month").isin(months_between(before))) if daily is not None else days
    series = within(daily, before, key).filter(F.col("qty").isNotNull()).select(key, "ds", "qty")
    feats = FE.rolling_features(series, [key], window_days, alpha, min_samples, nan_strategy)
    fresh = within(feats, dirty, key)
    gone = days.filter(F.col("qty").isNull()).select(key, "ds", *[F.lit(None).cast(feats.schema[c].dataType).alias(c)
                                                                  for c in feats.columns if c not in (key, "ds")])
    written = replace_days(spark, f"{store}/features", fresh.unionByName(gone), dirty, key)

    run = uuid.uuid4().hex
    state = _last_run(spark, f"{store}/state")
    number = 0 if state is None else state.select("run").first()[0] + 1
    old = state.select(key, "last_processed_at") if state is not None else spark.createDataFrame(
        [], days.select(key, F.col("ds").alias("last_processed_at")).schema)
    blocked = todo.join(ready, [key, "ds"], "left_anti")
    for name, rows in (("held", blocked), ("state", CL.advance_state(days, old, key))):
        _staged(rows, f"{name}-{run}").withColumn("run", F.lit(number)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{store}/{name}")
    return written


def stored_features(spark: SparkSession, store: str) -> DataFrame:
    """The feature rows of the store, without days whose facts are gone."""
    return spark.read.parquet(f"{store}/features").filter(F.col("qty").isNotNull()).drop("month")


def stored_state(spark: SparkSession, store: str, key: str = KEY) -> DataFrame:
    """(key, last_processed_at) after the last run."""
    return _last_run(spark, f"{store}/state").select(key, "last_processed_at")


def new_days(facts: DataFrame, state: DataFrame | None, late: Sequence[DataFrame] = (), key: str = KEY) -> DataFrame:
    """(key, ds) to process: days newer than the client's state, and the ``late`` ones reported."""
    days = facts.select(key, F.to_date("ds").alias("ds"))
    out = (days if state is None else CL.new_rows(days, state, key)).distinct()
    for more in late:
        out = out.unionByName(more.select(key, F.to_date("ds").alias("ds")))
    return out.distinct()
