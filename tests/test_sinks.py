"""Sinks: monthly rewrite semantics, tenant split reconciliation, stream = batch."""

import os
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tests.conftest import SF_SMALL
from tidemill.operators import partitions as P
from tidemill.operators import tenants as T
from tidemill.plans import registry
from tidemill.sources import fixtures as fx


def test_rerun_replaces_only_the_months_it_writes(spark, tmp_path):
    path = str(tmp_path / "features")
    rows = [(1, dt.date(2024, 1, 5), 1.0), (2, dt.date(2024, 1, 6), 2.0), (1, dt.date(2024, 2, 5), 3.0)]
    df = spark.createDataFrame(rows, "client_id long, ds date, qty double")
    P.write_monthly(df, path, ts_col="ds", cluster_by=("client_id",))
    rerun = spark.createDataFrame([(1, dt.date(2024, 2, 7), 9.0)], "client_id long, ds date, qty double")
    P.write_monthly(rerun, path, ts_col="ds", cluster_by=("client_id",))
    got = sorted((r.client_id, r.ds, r.qty) for r in spark.read.parquet(path).collect())
    assert got == [(1, dt.date(2024, 1, 5), 1.0), (1, dt.date(2024, 2, 7), 9.0), (2, dt.date(2024, 1, 6), 2.0)]


def test_rerun_of_one_client_keeps_the_others_of_its_month(spark, tmp_path):
    path = str(tmp_path / "features")
    schema = "client_id long, ds date, qty double"
    first = spark.createDataFrame([(1, dt.date(2024, 2, 5), 1.0), (2, dt.date(2024, 2, 6), 2.0)], schema)
    P.write_monthly(first, path, ts_col="ds", cluster_by=("client_id",), unit=("client_id",))
    rerun = spark.createDataFrame([(1, dt.date(2024, 2, 7), 9.0)], schema)
    P.write_monthly(rerun, path, ts_col="ds", cluster_by=("client_id",), unit=("client_id",))
    got = sorted((r.client_id, r.ds, r.qty) for r in spark.read.parquet(path).collect())
    assert got == [(1, dt.date(2024, 2, 7), 9.0), (2, dt.date(2024, 2, 6), 2.0)]


def test_tenant_split_reconciles(spark, tmp_path):
    out = T.split_tenant(fx.tenant_usage(spark, SF_SMALL), 3, str(tmp_path / "t3")).collect()
    assert out and all(r.match for r in out)


def test_stream_fold_equals_batch_fold(spark):
    q = registry.queries()
    stream = {tuple(r) for r in q["stream_clients"](spark, SF_SMALL).collect()}
    batch = {tuple(r) for r in q["clients_upsert"](spark, SF_SMALL).collect()}
    assert stream == batch and len(batch) > 0


def test_log_stream_writes_every_row(spark):
    got = {r.month: r.rows for r in registry.queries()["logs_append"](spark, SF_SMALL).collect()}
    want = {r.month: r.rows for r in P.partition_counts(fx.logs(spark, SF_SMALL)).collect()}
    assert got == want


def test_dedup_stream_keeps_one_copy_per_event(spark, tmp_path):
    from tidemill.streaming.messages_stream import dedup_stream
    from tidemill.streaming.runner import run_available, stream_table
    events = stream_table(spark, SF_SMALL, "events")
    raw = fx.raw_messages(spark, SF_SMALL, events)
    doubled = raw.unionByName(raw)                       # every message delivered twice
    out = str(tmp_path / "dedup")
    w = dedup_stream(doubled, "3650 days").writeStream.format("parquet").option("path", out)
    run_available(w, str(tmp_path / "ckpt"))
    got = spark.read.parquet(out)
    assert got.count() == fx.raw_messages(spark, SF_SMALL).count()
    assert got.select("event_id").distinct().count() == got.count()


def test_outcome_sink_splits_dead_letters(spark, tmp_path):
    import datetime as dt
    from tidemill.streaming.messages_stream import outcome_sink
    rows = [("1", 1, "clients-updates", "clients_updated", None, dt.datetime(2024, 1, 1),
             '{"id": "00000000-0000-4000-8000-000000000001"}'),
            ("2", 2, "clients-updates", "clients_updated", None, dt.datetime(2024, 1, 1), '{"id": "bad"}'),
            ("3", 3, "sales-updates", "sales_updated", "x", dt.datetime(2024, 1, 1), "{}")]
    src = str(tmp_path / "src")
    spark.createDataFrame(rows, "event_id string, arrival_seq long, stream string, event_type string, "
                                "client_id string, event_ts timestamp_ntz, data string").write.parquet(src)
    from tidemill.sources.messages import MESSAGE_SCHEMA
    stream = spark.readStream.schema(StructType([*MESSAGE_SCHEMA.fields, StructField("stream", StringType())])).parquet(src)
    ok_path, dead_path = str(tmp_path / "ok"), str(tmp_path / "dead")
    sink = outcome_sink(ok_path, dead_path, F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))
    from tidemill.streaming.runner import run_available
    run_available(stream.writeStream.foreachBatch(sink), str(tmp_path / "ckpt"))
    assert sorted(r.event_id for r in spark.read.parquet(ok_path).collect()) == ["1"]
    assert sorted((r.event_id, r.reason) for r in spark.read.parquet(dead_path).collect()) == [
        ("2", "invalid_id"), ("3", "invalid_client_id")]


def test_read_streams_tags_and_unions(spark, tmp_path):
    from tidemill.sources.messages import read_batches, read_streams
    from tidemill.streaming.runner import run_available
    raw = fx.raw_messages(spark, SF_SMALL)
    paths = {}
    for name in ("clients-updates", "sales-updates"):
        paths[name] = str(tmp_path / name)
        raw.filter(F.col("stream") == name).drop("stream").write.parquet(paths[name])
    out = str(tmp_path / "merged")
    run_available(read_streams(spark, paths, max_files_per_trigger=1).writeStream.format("parquet")
                  .option("path", out), str(tmp_path / "ckpt"))
    got = {r.stream: r.n for r in spark.read.parquet(out).groupBy("stream").agg(F.count("*").alias("n")).collect()}
    want = {r.stream: r.n for r in raw.filter(F.col("stream").isin(*paths)).groupBy("stream")
            .agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert read_batches(spark, paths).count() == sum(want.values())


def test_client_versions_compaction(spark, tmp_path):
    from tidemill.plans.params import as_of_ntz
    from tidemill.streaming import clients_stream as CS
    from tidemill.streaming.runner import run_available, stream_table
    events = stream_table(spark, SF_SMALL, "events")
    out = str(tmp_path / "versions")
    run_available(CS.write_versions(CS.client_fold_stream(fx.raw_messages(spark, SF_SMALL, events), as_of_ntz()),
                                    out), str(tmp_path / "ckpt"))
    before = {tuple(r) for r in CS.read_current(spark, out).collect()}
    last = CS.compact(spark, out, str(tmp_path / "base"))
    after = {tuple(r) for r in CS.read_current(spark, out, str(tmp_path / "base"), last).collect()}
    assert before == after and len(before) > 0




def test_retries_wait_for_their_time_and_end(spark, tmp_path):
    """Backoff by the batches' clock, give-up, a fatal failure, an empty batch, a repeated batch."""
    from tidemill.streaming import redelivery as RD
    from tidemill.streaming import sinks as SK
    at = lambda h: dt.datetime(2024, 1, 1, h)
    schema = "event_id string, arrival_seq long, event_ts timestamp_ntz"
    open_from = {"a": 0, "b": 3, "c": 99, "d": -1}           # hour from which the handler succeeds; -1 never, fatal

    def handle(rows, batch_id):
        hour = batch_id * 2                                  # batch n arrives at hour 2n
        known = spark.createDataFrame(list(open_from.items()), "event_id string, since int")
        return (rows.join(F.broadcast(known), "event_id", "left").withColumn("result", F.when(F.col("since") < 0, RD.FATAL)
                .when(F.coalesce("since", F.lit(0)) <= hour, RD.OK).otherwise(RD.RETRY)).withColumn("reason", F.lit("closed")).select(*rows.columns, "result", "reason"))

    path, tried = str(tmp_path / "deliveries"), []
    sink = RD.retry_sink(path, lambda rows, n: tried.append((n, sorted(r[0] for r in rows.select("event_id").collect()))) or handle(rows, n), 3, 3600)
    SK_query, RD.query_id = RD.query_id, lambda batch: "q"
    try:
        batches = [[("a", 1, at(0)), ("b", 2, at(0)), ("c", 3, at(0)), ("d", 4, at(0))], [("e", 5, at(2))], [], [("f", 6, at(6)), ("c", 3, at(0))]]
        for n, rows in enumerate(batches):
            for _ in range(2 if n == 1 else 1):
                sink(spark.createDataFrame(rows, schema), n)
    finally:
        RD.query_id = SK_query
    assert tried == [(0, ["a", "b", "c", "d"]), (1, ["b", "c", "e"]), (1, ["b", "c", "e"]), (3, ["b", "c", "f"])]
    state = {r.event_id: (r.status, r.attempts, r.reason) for r in RD.delivery_state(spark, path).collect()}
    assert state == {"a": ("acked", 1, "closed"), "b": ("acked", 3, "closed"), "c": ("dead", 3, "retries_exhausted: closed"),
                     "d": ("dead", 1, "closed"), "e": ("acked", 1, "closed"), "f": ("acked", 1, "closed")}
    assert RD.pending_now(spark, path).count() == 0
    assert SK.read_batches(spark, str(tmp_path / "nothing")) is None


def test_a_new_checkpoint_keeps_older_outcomes(spark, tmp_path):
    """Both queries write their batch 0; neither replaces the other's rows."""
    from tidemill.sources.messages import MESSAGE_SCHEMA
    from tidemill.streaming.messages_stream import outcome_sink
    from tidemill.streaming.runner import run_available
    schema = StructType([*MESSAGE_SCHEMA.fields, StructField("stream", StringType())])
    ok, dead = str(tmp_path / "ok"), str(tmp_path / "dead")
    sink = outcome_sink(ok, dead, F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))
    for n in (1, 2):
        src = str(tmp_path / f"src{n}")
        rows = [(str(n * 10 + k), k, "sales_updated", "00000000-0000-4000-8000-000000000001" if k else "bad", dt.datetime(2024, 1, 1), "{}", "s") for k in (0, 1)]
        spark.createDataFrame(rows, schema).write.parquet(src)
        run_available(spark.readStream.schema(schema).parquet(src).writeStream.foreachBatch(sink), str(tmp_path / f"ckpt{n}"))
    assert sorted(r.event_id for r in spark.read.parquet(ok).collect()) == ["11", "21"]
    assert sorted(r.event_id for r in spark.read.parquet(dead).collect()) == ["10", "20"]


def test_parts_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """A part has as many files as its rows ask for, and a micro-batch of the stream is still one part."""
    from tidemill.plans import q_streams as QS
    from tidemill.streaming.runner import run_available
    monkeypatch.setattr(QS, "ROWS_PER_FILE", 50)
    files = QS.files_per_part(spark, SF_SMALL)
    assert files > 1
    src, seen = str(tmp_path / "parts"), []
    QS.write_parts(spark, SF_SMALL, src, [2, 0], files)
    assert len([f for f in os.listdir(src) if f.endswith(".parquet")]) == 2 * files
    run_available(QS.parts_stream(spark, SF_SMALL, src, files).writeStream.foreachBatch(
        lambda batch, _: seen.append({r[0] for r in batch.select(QS._part()).distinct().collect()})), str(tmp_path / "ckpt"))
    assert seen == [{2}, {0}]
