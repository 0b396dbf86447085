"""Registered streaming and sink queries.

Each runs a real streaming query (file source over the driver table,
``availableNow`` trigger, checkpoint in the shared folder) or a real write,
then reads the written table back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.text import canonical_uuid
from tidemill.operators import clients as CL
from tidemill.operators import features as FE
from tidemill.operators import incremental as INC
from tidemill.operators import messages as MS
from tidemill.operators import partitions as P
from tidemill.operators import tenants as T
from tidemill.plans import q_clients
from tidemill.plans.params import as_of_ntz
from tidemill.plans.q_features import DECAY_SQL, KEYS, _daily
from tidemill.plans.q_messages import norm_with
from tidemill.plans.registry import register
from tidemill.plans.views import VIEWS, with_views
from tidemill.sources import fixtures as fx
from tidemill.sources import messages as SM
from tidemill.streaming import clients_stream as CS
from tidemill.streaming import logs_sink as LS
from tidemill.streaming import messages_stream as MQ
from tidemill.streaming import redelivery as RD
from tidemill.streaming import sinks as SK
from tidemill.streaming.runner import run_available, stream_table


#: Parts that the registered streams read, one a micro-batch, by event time; rows of one file of a part.
PARTS, ROWS_PER_FILE = 4, 50_000


def _part():
    return F.floor((F.dayofmonth("event_ts") - 1) * PARTS / 31).cast("int")


def files_per_part(spark, sf_dir: str) -> int:
    """Files of every part: the same number for all, so that a stream that takes as many reads whole parts."""
    counts = {r[0]: r[1] for r in fx.raw_messages(spark, sf_dir).groupBy(_part()).count().collect()}
    return max(1, min(counts.get(k, 0) for k in range(PARTS)) // ROWS_PER_FILE)


def write_parts(spark, sf_dir: str, folder: str, order, files: int = 1) -> None:
    """Append the given parts of the messages to ``folder``, ``files`` files each (none empty), in this order."""
    raw = fx.raw_messages(spark, sf_dir)
    for k in order:
        raw.filter(_part() == k).repartition(files).write.mode("append").parquet(folder)


def parts_stream(spark, sf_dir: str, folder: str, files: int = 1):
    """The parts in ``folder`` as a stream, a part a micro-batch, oldest first."""
    return (spark.readStream.schema(fx.raw_messages(spark, sf_dir).schema).option("maxFilesPerTrigger", files).parquet(folder))


@register("stream_clients", sql=with_views(f"""
with {norm_with(q_clients.ROWS_SQL.strip(), q_clients.FOLD_SQL.strip())} select * from clients_fold""",
    "raw_messages"))
def q_stream_clients(spark, sf_dir):
    """Files newest first, a restart in between, and a second checkpoint that reads all of them again."""
    src, out = T.scratch_dir(spark, "messages"), T.scratch_dir(spark, "clients-versions")
    files = files_per_part(spark, sf_dir)
    write_parts(spark, sf_dir, src, [3, 2], files)
    folded = CS.client_fold_stream(parts_stream(spark, sf_dir, src, files), as_of_ntz())
    run_available(CS.write_versions(folded, out), out + "-ckpt")
    write_parts(spark, sf_dir, src, [1, 0], files)
    folded = CS.client_fold_stream(parts_stream(spark, sf_dir, src, files), as_of_ntz())
    run_available(CS.write_versions(folded, out), out + "-ckpt")
    run_available(CS.write_versions(folded, out), out + "-ckpt-new")
    return q_clients._fold_out(CS.read_current(spark, out))


@register("logs_append", sql=with_views("""
select cast(date_trunc('month', ts) as date) as month, count(*) as rows from logs group by 1""", "logs"))
def q_logs_append(spark, sf_dir):
    events = stream_table(spark, sf_dir, "events")
    out = T.scratch_dir(spark, "logs")
    run_available(LS.log_sink(fx.logs(spark, sf_dir, events), out, interval=None), out + "-ckpt")
    written = spark.read.schema(P.with_month(fx.logs(spark, sf_dir)).schema).parquet(out)
    return written.groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


@register("features_month_counts", sql=with_views("""
select client_id, cast(date_trunc('month', ds) as date) as month, count(*) as rows
from (select client_id, ds from sales group by 1, 2) d group by 1, 2""", "sales"))
def q_features_month_counts(spark, sf_dir):
    feats = FE.rolling_features(_daily(spark, sf_dir), KEYS)
    out = T.scratch_dir(spark, "features")
    P.write_monthly(feats, out, ts_col="ds", cluster_by=("client_id",), unit=("client_id",))
    back = spark.read.schema(P.with_month(feats, "ds").schema).parquet(out)
    return back.groupBy("client_id", "month").agg(F.count(F.lit(1)).alias("rows"))


@register("result_events", sql=f"""
with f as ({DECAY_SQL.strip()})
select client_id, 'features_updated' as event_type, count(*) as features_count,
  'ema,ma,std' as feature_types, count(ema) as ema_rows,
  cast(to_json({{'client_id': client_id, 'features_count': count(*), 'feature_types': ['ema', 'ma', 'std']}}) as varchar) as data
from f group by client_id""")
def q_result_events(spark, sf_dir):
    feats = FE.rolling_features(_daily(spark, sf_dir), KEYS)
    return FE.result_events(feats, {"ema": "ema", "ma": "ma", "std": "std"})


@register("stream_sales_enriched", sql=q_clients.ENRICHED_SQL)
def q_stream_sales_enriched(spark, sf_dir):
    """Clients folded by one stream, notifications enriched by another; both read several files."""
    src, versions, out = (T.scratch_dir(spark, n) for n in ("messages", "clients-versions", "enriched"))
    files = files_per_part(spark, sf_dir)
    write_parts(spark, sf_dir, src, range(PARTS), files)
    run_available(CS.write_versions(CS.client_fold_stream(parts_stream(spark, sf_dir, src, files), as_of_ntz()), versions), versions + "-ckpt")
    run_available(CS.enrich_stream(parts_stream(spark, sf_dir, src, files), versions, out), out + "-ckpt")
    return SK.read_batches(spark, out).drop("query", "batch")


@register("stream_outcomes", sql=with_views(f"""
with {norm_with()} select event_id, arrival_seq, stream, event_type, route, outcome, reason, outcome = 'failed' as dead from outcomes""",
    "raw_messages"))
def q_stream_outcomes(spark, sf_dir):
    """Two queries, each with a checkpoint of its own, write half of the files to one pair of tables (K3)."""
    done, dead = T.scratch_dir(spark, "outcomes"), T.scratch_dir(spark, "dead")
    files = files_per_part(spark, sf_dir)
    for half in (range(PARTS // 2), range(PARTS // 2, PARTS)):
        src = T.scratch_dir(spark, "messages")
        write_parts(spark, sf_dir, src, half, files)
        run_available(parts_stream(spark, sf_dir, src, files).writeStream.foreachBatch(MQ.outcome_sink(done, dead, as_of_ntz())), src + "-ckpt")
    return (SK.read_batches(spark, done).withColumn("dead", F.lit(False))
            .unionByName(SK.read_batches(spark, dead).withColumn("dead", F.lit(True))).drop("query", "batch"))


@register("stream_dedup", sql=with_views("select event_id, arrival_seq, event_type from raw_messages", "raw_messages"))
def q_stream_dedup(spark, sf_dir):
    """Every message delivered twice, read from one folder a stream (A1), kept once (K2)."""
    raw, out = fx.raw_messages(spark, sf_dir), T.scratch_dir(spark, "dedup")
    src = T.scratch_dir(spark, "streams")
    raw.write.partitionBy("stream").parquet(src)
    names = [r[0] for r in spark.read.parquet(src).select("stream").distinct().collect()]
    merged = SM.read_streams(spark, {n: f"{src}/stream={n}" for n in names})
    run_available(MQ.dedup_stream(merged.unionByName(merged), "3650 days").select("event_id", "arrival_seq", "event_type")
                  .writeStream.format("parquet").option("path", out), out + "-ckpt")
    return spark.read.parquet(out)


#: Redelivery in the registered query: attempts allowed, and seconds until the second one.
ATTEMPTS, BACKOFF = 3, 86_400


def known_client_handler(clients: str):
    """Handler of messages: rule failures are fatal, a sales notification of a client that no
    ``clients_updated`` message has named so far is retried. Client rows are kept under ``clients``."""
    def handle(messages, batch_id):
        norm = MS.normalise_messages(messages, handled_only=True)
        _, err = CL.client_fields(F.col("p"), as_of_ntz())
        out = MS.message_outcomes(norm, err).select("event_id", "arrival_seq", "route", "outcome", F.col("reason").alias("_why"))
        rows = CL.client_rows(norm, as_of_ntz()).filter(F.col("error").isNull()).select("id").distinct()
        SK.write_batch(rows, clients, SK.query_id(messages), batch_id)
        known = SK.read_batches(messages.sparkSession, clients).select(F.col("id").alias("_id")).distinct()
        joined = (messages.join(out, ["event_id", "arrival_seq"]).join(known, canonical_uuid(F.col("client_id")) == F.col("_id"), "left"))
        missing = (F.col("route") == "sales") & (F.col("outcome") == "processed") & F.col("_id").isNull()
        return joined.select(*messages.columns,
                             F.when(F.col("outcome") == "failed", RD.FATAL).when(missing, RD.RETRY).otherwise(RD.OK).alias("result"),
                             F.when(missing, "client_not_found").otherwise(F.col("_why")).alias("reason"))
    return handle


# Each sales notification of an unknown client is attempted in its batch and in later ones once due.
DELIVERY_SQL = with_views(f"""
with recursive {norm_with()},
parts as (select event_id, cast(floor((extract(day from event_ts) - 1) * {PARTS} / 31) as int) as part, event_ts, client_id from raw_messages),
clocks as (select part, row_number() over (order by part) as b, max(event_ts) as clock from parts group by part),
arrived as (
  select o.event_id, c.b, o.route, o.outcome, o.reason, lower(replace(p.client_id, '-', '')) as cid
  from outcomes o join parts p using (event_id) join clocks c using (part)),
known as (
  select lower(replace(j->>'id', '-', '')) as cid, min(b) as since from cl join parts using (event_id) join clocks using (part)
  where event_type = 'clients_updated' and c_reason is null group by 1),
tried(event_id, cid, b, attempts, due, status, reason) as (
  select a.event_id, a.cid, a.b, 1,
    case when retry then clock + interval '{BACKOFF} seconds' end, case when outcome = 'failed' then 'dead' when retry then 'pending' else 'acked' end,
    case when retry then null else a.reason end
  from (select a.*, c.clock, a.route = 'sales' and a.outcome = 'processed' and (k.since is null or k.since > a.b) as retry
        from arrived a join clocks c using (b) left join known k on k.cid = a.cid) a
  union all
  select t.event_id, t.cid, c.b,
    t.attempts + case when c.clock >= t.due then 1 else 0 end,
    case when c.clock >= t.due then c.clock + interval '{BACKOFF} seconds' * 2 ** t.attempts else t.due end,
    case when c.clock < t.due then 'pending' when k.since <= c.b then 'acked' when t.attempts + 1 >= {ATTEMPTS} then 'dead' else 'pending' end,
    case when c.clock >= t.due and not coalesce(k.since <= c.b, false) and t.attempts + 1 >= {ATTEMPTS} then 'retries_exhausted: client_not_found' end
  from tried t join clocks c on c.b = t.b + 1 left join known k on k.cid = t.cid where t.status = 'pending')
select event_id, status, attempts, reason from tried t
where status <> 'pending' or b = (select max(b) from clocks)""", "raw_messages")


@register("stream_deliveries", sql=DELIVERY_SQL)
def q_stream_deliveries(spark, sf_dir):
    """Messages in several batches, retried until their client is known or the attempts are spent."""
    src, out = T.scratch_dir(spark, "messages"), T.scratch_dir(spark, "deliveries")
    files = files_per_part(spark, sf_dir)
    write_parts(spark, sf_dir, src, range(PARTS), files)
    sink = RD.retry_sink(out, known_client_handler(out + "-clients"), ATTEMPTS, BACKOFF)
    run_available(parts_stream(spark, sf_dir, src, files).writeStream.foreachBatch(sink), out + "-ckpt")
    return RD.delivery_state(spark, out)


@register("features_incremental", sql=f"""
with f as ({DECAY_SQL.strip()})
select f.*, max(ds) over (partition by client_id) as last_processed_at from f
where client_id in (select id from ({VIEWS['clients'].strip()}) c where status = 'active' and config_confirmed)""")
def q_features_incremental(spark, sf_dir):
    """Gate, first load, then a new period together with late days of an old one; features and state."""
    store = T.scratch_dir(spark, "feature-store")
    facts, clients = fx.sale_lines(spark, sf_dir), fx.clients(spark, sf_dir)
    late = (F.col("product_id") % 20 == 0) & F.col("ds").between("1995-03-01", "1995-04-30")
    first = facts.filter((F.col("ds") < "1997-01-01") & ~late)
    INC.feature_run(first, INC.new_days(first, None), store, clients)
    changed = INC.new_days(facts.join(clients.select(F.col("id").alias("client_id")), "client_id", "left_semi"),
                           INC.stored_state(spark, store), [facts.filter(late)])
    INC.feature_run(facts, changed, store, clients)
    return INC.stored_features(spark, store).join(INC.stored_state(spark, store), "client_id")
