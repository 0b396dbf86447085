"""Continuous client fold (K1): the batch fold as a stateful streaming aggregation.

``groupBy(id).agg(max_by, min_by)`` keeps one state row per client in the
state store (checkpointed in the shared folder), so replays and restarts give
the same table as the batch fold. Each trigger emits the rows that changed
(``update`` mode) and ``foreachBatch`` writes them as a new version folder;
readers fold the versions on read (latest arrival wins), which never
rewrites a folder that someone may be reading. Sales notifications are
enriched against that table by a stream of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import clients as CL
from tidemill.operators import messages as MS
from tidemill.streaming.sinks import each_batch


def client_fold_stream(raw_messages: DataFrame, as_of: Column) -> DataFrame:
    """Streaming fold of ``clients_updated`` messages: ``clients_upsert`` with ``first_seq`` and ``last_seq``."""
    rows = CL.client_rows(MS.normalise_messages(raw_messages), as_of)
    return CL.clients_upsert(rows, with_seq=True)


def write_versions(folded: DataFrame, path: str, mode: str = "update"):
    """Writer of each micro-batch's changed client rows, by query and batch (``sinks.write_batch``)."""
    return folded.writeStream.outputMode(mode).foreachBatch(each_batch(path, lambda batch: batch))


def _folded(versions: DataFrame) -> DataFrame:
    """One row per id: the version of the last arrival, ``created_at`` of the first.

    Versions are ordered by the arrival they hold, not by query or batch: files out of order and a new
    checkpoint, whose batch numbers start again, give the same table.
    """
    cols = [c for c in versions.columns if c not in ("id", "created_at", "n_events", "first_seq", "last_seq", "query", "batch")]
    return (versions.groupBy("id").agg(F.max_by(F.struct(*cols), "last_seq").alias("r"), F.min_by("created_at", "first_seq").alias("created_at"),
                                       F.max("n_events").alias("n_events"), F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"))
                    .select("id", *[F.col(f"r.{c}").alias(c) for c in cols], "created_at", "n_events", "first_seq", "last_seq"))


def _newer(versions: DataFrame, since: dict[str, int] | None) -> DataFrame:
    """Version rows after the last batch of each query in ``since`` (partition values only)."""
    for query, batch in (since or {}).items():
        versions = versions.filter((F.col("query") != query) | (F.col("batch") > batch))
    return versions


def read_current(spark, path: str, base: str | None = None, since: dict[str, int] | None = None) -> DataFrame:
    """Current client table across the version folders.

    With ``base`` (a folder written by ``compact``) only batches after those in ``since`` are read
    (partition pruning), so reads do not grow with the number of micro-batches already compacted.
    """
    v = _newer(spark.read.parquet(path), since).drop("query", "batch")
    if base is not None:
        v = v.unionByName(spark.read.parquet(base))
    return _folded(v)


def compact(spark, path: str, out: str, base: str | None = None, since: dict[str, int] | None = None) -> dict[str, int]:
    """Fold the version folders (and an older base) into a new base folder ``out``.

    Returns the last batch of each query folded in; pass it as ``since`` together with ``base=out`` to
    later reads. ``out`` must be a new folder: the folder being read is never rewritten. Batches written
    while this runs are left to the next call.
    """
    v = spark.read.parquet(path)
    last = {r["query"]: r["batch"] for r in v.groupBy("query").agg(F.max("batch").alias("batch")).collect()}
    known = F.lit(False)
    for query, batch in last.items():
        known = known | ((F.col("query") == query) & (F.col("batch") <= batch))
    v = _newer(v.filter(known), since).drop("query", "batch")
    if base is not None:
        v = v.unionByName(spark.read.parquet(base))
    _folded(v).write.mode("errorifexists").parquet(out)
    return {**(since or {}), **last}


def enrich_stream(raw_messages: DataFrame, versions: str, out: str):
    """Writer of sales notifications with client name and status (C1): the client table is read anew in
    every micro-batch from the versions folder, so a batch sees the clients folded up to then."""
    def of(batch: DataFrame) -> DataFrame:
        notes = MS.sales_notifications(MS.normalise_messages(batch))
        return CL.sales_enriched(notes, read_current(batch.sparkSession, versions))
    return raw_messages.writeStream.foreachBatch(each_batch(out, of))
