"""Per-batch message handling (K2, K3).

* ``dedup_stream``: duplicates by ``event_id`` are dropped within a watermark
  (``dropDuplicatesWithinWatermark``) before additive sinks; the client fold
  itself is idempotent and needs no dedup.
* ``outcome_sink``: each micro-batch is decoded once, cached for the batch,
  and written to two tables: acknowledged outcomes and dead letters, by query and batch, so that a
  retried batch replaces its own rows and a new checkpoint leaves older ones alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import clients as CL
from tidemill.operators import messages as MS
from tidemill.streaming.sinks import query_id, write_batch


def dedup_stream(raw_messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Keep the first copy of each ``event_id`` seen within ``delay`` of event time.

    ``withWatermark`` needs a ``timestamp`` column, so the NTZ event time is cast
    (session zone UTC).
    """
    return (raw_messages.withColumn("_wm", F.col("event_ts").cast("timestamp"))
                        .withWatermark("_wm", delay)
                        .dropDuplicatesWithinWatermark(["event_id"])
                        .drop("_wm"))


def outcome_sink(outcomes_path: str, dead_path: str, as_of: Column):
    """``foreachBatch`` function: outcomes (acknowledged) and dead letters (failed) per batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        norm = MS.normalise_messages(batch, handled_only=True).persist()
        try:
            _, err = CL.client_fields(F.col("p"), as_of)
            out = MS.message_outcomes(norm, err)
            for rows, path in ((F.col("outcome") != "failed", outcomes_path), (F.col("outcome") == "failed", dead_path)):
                write_batch(out.filter(rows), path, query_id(batch), batch_id)
        finally:
            norm.unpersist()
    return sink
