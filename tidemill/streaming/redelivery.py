"""Deliveries with retries (K3, C5): pending until handled, given up after a fatal error.

A message is attempted when it arrives. A retryable failure keeps it pending, to be attempted again in
the first batch whose clock has passed its due time, which doubles with every attempt; a fatal failure,
or the last attempt allowed, acknowledges it and writes a dead letter.

The pending set is a table: batch ``n`` reads the set that batch ``n - 1`` of the same query left and
writes its own, so a repeated batch sees the same state and replaces the same rows. Its size is that of
the pending messages, not of the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.streaming.sinks import query_id, read_batches, write_batch

#: Results of a handler.
OK, RETRY, FATAL = "ok", "retryable", "fatal"
STATE = ["attempts", "next_due"]


def retry_sink(path: str, handle: Callable[[DataFrame, int], DataFrame], max_attempts: int | None = 5,
               backoff_seconds: int = 60, clock: Column | None = None):
    """``foreachBatch`` function keeping ``acked``, ``dead`` and ``pending`` under ``path``.

    ``handle(messages, batch_id)`` returns the messages (all their columns) with ``result`` (``ok``,
    ``retryable`` or ``fatal``) and ``reason``; it may be called again for a repeated batch. ``clock`` is an
    aggregate over the arriving messages that gives the batch's time (default: their newest
    ``event_ts``); an empty batch attempts nothing. A message that arrives again while pending is not
    attempted twice in one batch. ``max_attempts`` None never gives up.
    """
    clock = F.max("event_ts") if clock is None else clock

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, query_id(batch)
        now = batch.agg(clock.cast("timestamp_ntz")).first()[0]
        if now is None:
            return
        now = F.lit(now).cast("timestamp_ntz")
        fresh = batch.withColumn("attempts", F.lit(0)).withColumn("next_due", F.lit(None).cast("timestamp_ntz"))
        left = read_batches(spark, f"{path}/pending")
        waiting = None
        if left is not None:
            left = left.filter((F.col("query") == query) & (F.col("batch") < batch_id))
            last = left.agg(F.max("batch")).first()[0]
            if last is not None:
                left = left.filter((F.col("batch") == last) & F.col("event_id").isNotNull()).select(*fresh.columns)
                due = F.col("next_due") <= now
                waiting = left.filter(~due)
                fresh = left.filter(due).unionByName(fresh.join(left.select("event_id"), "event_id", "left_anti").select(*fresh.columns))
        judged = handle(fresh.withColumn("attempts", F.col("attempts") + 1), batch_id).persist()
        try:
            again = F.col("result") == RETRY
            if max_attempts is not None:
                again = again & (F.col("attempts") < max_attempts)
            write_batch(judged.filter(F.col("result") == OK).select("event_id", "attempts", "reason"), f"{path}/acked", query, batch_id)
            spent = F.when(F.col("result") == RETRY, F.concat(F.lit("retries_exhausted: "), F.col("reason"))).otherwise(F.col("reason"))
            write_batch(judged.filter((F.col("result") != OK) & ~again).withColumn("reason", spent), f"{path}/dead", query, batch_id)
            wait = F.make_dt_interval(secs=F.lit(backoff_seconds) * F.pow(F.lit(2), F.col("attempts") - 1))
            pending = judged.filter(again).drop("result", "reason").withColumn("next_due", now + wait)
            if waiting is not None:
                pending = pending.unionByName(waiting)
            # One row without id marks the batch, so that an empty pending set is told from no batch.
            mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in pending.schema])
            write_batch(pending.unionByName(mark), f"{path}/pending", query, batch_id)
        finally:
            judged.unpersist()
    return sink


def pending_now(spark: SparkSession, path: str) -> DataFrame:
    """Messages that wait after the last batch of each query."""
    rows = read_batches(spark, f"{path}/pending")
    last = rows.groupBy("query").agg(F.max("batch").alias("batch"))
    return rows.join(F.broadcast(last), ["query", "batch"], "left_semi").filter(F.col("event_id").isNotNull())


def delivery_state(spark: SparkSession, path: str) -> DataFrame:
    """(event_id, status, attempts, reason): acked before dead before pending, over all queries."""
    parts = [(0, "acked", read_batches(spark, f"{path}/acked")), (1, "dead", read_batches(spark, f"{path}/dead")),
             (2, "pending", pending_now(spark, path).withColumn("reason", F.lit(None).cast("string")))]
    rows = None
    for order, status, df in parts:
        if df is None:
            continue
        part = df.select("event_id", F.struct(F.lit(order).alias("o"), F.lit(status).alias("status"), F.col("attempts"), "reason").alias("s"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("event_id").agg(F.min("s").alias("s")).select("event_id", "s.status", "s.attempts", "s.reason")
