"""Registered message queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import clients as CL
from tidemill.operators import messages as MS
from tidemill.operators import tenants as T
from tidemill.plans.params import as_of_ntz
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.sources import fixtures as fx
from tidemill.sources import messages as src

# DuckDB: decoded payload, kind and truthiness, mirroring normalise_messages.
NORM_SQL = """
norm0 as (
  select event_id, arrival_seq, stream, event_type, client_id, event_ts, data,
    case when data is null then 'missing'
         when not json_valid(data) then 'invalid'
         when json_type(data::json) = 'OBJECT' then 'object'
         when json_type(data::json) = 'ARRAY' then 'array'
         when json_type(data::json) = 'NULL' then 'null'
         else 'scalar' end as payload_kind
  from raw_messages),
norm as (
  select *, case when payload_kind = 'object' then data::json else '{}'::json end as j,
    case when payload_kind = 'object' then json_array_length(json_keys(data::json)) > 0
         when payload_kind = 'array' then json_array_length(data::json) > 0
         when payload_kind = 'scalar' then data::json::varchar not in ('false', '0', '""', '0.0')
         else false end as payload_truthy
  from norm0),
cl as (
  select *,
    case when not payload_truthy then 'empty_data'
         when payload_kind <> 'object' then 'payload_not_object'
         when json_type(j, '$.created_at') not in ('VARCHAR', 'NULL') then 'created_at_not_text'
         when json_type(j, '$.updated_at') not in ('VARCHAR', 'NULL') then 'updated_at_not_text'
         when json_type(j, '$.config_confirmed_at') not in ('VARCHAR', 'NULL') then 'config_confirmed_at_not_text'
         when json_type(j, '$.id') is null then 'missing_id'
         when json_type(j, '$.id') <> 'VARCHAR'
           or not regexp_matches(regexp_replace(replace(replace(lower(j->>'id'), 'urn:', ''), 'uuid:', ''), '^[{}]+|[{}]+$|-', '', 'g'), '^[0-9a-f]{32}$')
           then 'invalid_id'
         when json_type(j, '$.features_enabled') is not null and json_type(j, '$.features_enabled') <> 'OBJECT' then 'features_enabled_not_object'
         when length(coalesce(j->>'name', '')) > 255 then 'name_too_long'
         else null end as c_reason,
    case when coalesce(client_id, '') = '' then 'missing_client_id'
         when payload_kind not in ('object', 'invalid', 'missing') then 'payload_not_object'
         when not regexp_matches(lower(client_id), '^(\\{[0-9a-f]{4}(-?[0-9a-f]{4}){7}\\}|[0-9a-f]{4}(-?[0-9a-f]{4}){7})$') then 'invalid_client_id'
         else null end as s_reason
  from norm),
outcomes as (
  select event_id, arrival_seq, stream, event_type,
    case event_type when 'clients_updated' then 'clients' when 'sales_updated' then 'sales' else 'unknown' end as route,
    case event_type
      when 'clients_updated' then case when c_reason = 'empty_data' then 'skipped' when c_reason is not null then 'failed' else 'processed' end
      when 'sales_updated' then case when s_reason = 'missing_client_id' then 'skipped' when s_reason is not null then 'failed' else 'processed' end
      else 'unknown' end as outcome,
    case event_type when 'clients_updated' then c_reason when 'sales_updated' then s_reason else 'unknown_event_type' end as reason
  from cl)"""


def norm_with(*more: str) -> str:
    return ",\n".join([NORM_SQL.strip(), *more])


def _norm(spark, sf_dir):
    return MS.normalise_messages(fx.raw_messages(spark, sf_dir))


def _outcomes(spark, sf_dir):
    norm = MS.normalise_messages(fx.raw_messages(spark, sf_dir), handled_only=True)
    _, err = CL.client_fields(F.col("p"), as_of_ntz())
    return MS.message_outcomes(norm, err)


@register("messages_by_stream", sql=with_views("""
select stream, count(*) as n, min(arrival_seq) as first_id, max(arrival_seq) as last_id
from raw_messages group by stream""", "raw_messages"))
def q_messages_by_stream(spark, sf_dir):
    # A1: streams as the data names them; one folder a stream, read back as one input.
    raw, folder = fx.raw_messages(spark, sf_dir), T.scratch_dir(spark, "streams")
    raw.write.partitionBy("stream").parquet(folder)
    names = [r[0] for r in spark.read.parquet(folder).select("stream").distinct().collect()]
    merged = src.read_batches(spark, {n: f"{folder}/stream={n}" for n in names})
    return merged.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.min("arrival_seq").alias("first_id"),
                                        F.max("arrival_seq").alias("last_id"))


@register("parsed_messages", sql=with_views(f"""
with {norm_with()}
select event_id, arrival_seq, stream, event_type, client_id, event_ts, payload_kind, payload_truthy,
  cast(json_array_length(json_keys(j)) as int) as payload_size
from norm""", "raw_messages"))
def q_parsed_messages(spark, sf_dir):
    n = _norm(spark, sf_dir)
    return n.select(*MS.ENVELOPE, "payload_kind", "payload_truthy", "payload_size")


@register("message_outcomes", sql=with_views(f"with {norm_with()} select * from outcomes", "raw_messages"))
def q_message_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@register("route_counts", sql=with_views(f"""
with {norm_with()} select route, outcome, count(*) as n from outcomes group by 1, 2""", "raw_messages"))
def q_route_counts(spark, sf_dir):
    return MS.route_counts(_outcomes(spark, sf_dir))


SALES_SQL = """
sales_n as (
  select event_id, arrival_seq, client_id,
    case when json_type(j, '$.table_name') is null then 'unknown' else j->>'table_name' end as table_name,
    regexp_replace(case when json_type(j, '$.table_name') is null then 'unknown' else j->>'table_name' end, '^c[0-9]+_', '') as "table",
    case when json_type(j, '$.record_count') is null then '0' else j->>'record_count' end as record_count,
    case when json_type(j, '$.updated_at') is null then event_ts
         else cast(timezone('UTC', try_cast(j->>'updated_at' as timestamptz)) as timestamp) end as updated_at
  from cl where event_type = 'sales_updated' and s_reason is null)"""


@register("sales_notifications", sql=with_views(f"with {norm_with(SALES_SQL.strip())} select * from sales_n",
                                                 "raw_messages"))
def q_sales_notifications(spark, sf_dir):
    return MS.sales_notifications(_norm(spark, sf_dir))


@register("dead_letters", sql=with_views(f"""
with {norm_with()} select event_id, arrival_seq, stream, event_type, reason as error from outcomes where outcome = 'failed'""",
    "raw_messages"))
def q_dead_letters(spark, sf_dir):
    return MS.failed_messages(_outcomes(spark, sf_dir))


@register("pending_messages", sql=with_views(f"""
with {norm_with()}
select m.event_id, m.arrival_seq, m.stream, m.event_type from raw_messages m
where not exists (select 1 from outcomes o where o.event_id = m.event_id and o.outcome <> 'failed')""",
    "raw_messages"))
def q_pending_messages(spark, sf_dir):
    delivered = fx.raw_messages(spark, sf_dir).select("event_id", "arrival_seq", "stream", "event_type")
    acked = _outcomes(spark, sf_dir).filter(F.col("outcome") != "failed")
    return MS.pending_messages(delivered, acked)


@register("stream_length", sql=with_views("select stream, count(*) as length from raw_messages group by 1",
                                          "raw_messages"))
def q_stream_length(spark, sf_dir):
    return MS.stream_length(fx.raw_messages(spark, sf_dir))


@register("consumer_lag", sql=with_views(f"""
with {norm_with()},
marks as (select stream, max(arrival_seq) as last_id,
            max(arrival_seq) filter (where outcome <> 'failed') as last_processed_id from outcomes group by 1)
select k.stream, k.last_id, k.last_processed_id,
  count(*) filter (where o.arrival_seq > coalesce(k.last_processed_id, -1)) as lag
from outcomes o join marks k on k.stream = o.stream group by 1, 2, 3""", "raw_messages"))
def q_consumer_lag(spark, sf_dir):
    return MS.consumer_lag(fx.raw_messages(spark, sf_dir), _outcomes(spark, sf_dir))


# Fixed value: retention length of a stream.
STREAM_MAXLEN = 10_000


@register("stream_trim", sql=with_views(f"""
select event_id, arrival_seq, stream, event_type from (
  select *, row_number() over (partition by stream order by arrival_seq desc) as rn from raw_messages)
where rn <= {STREAM_MAXLEN}""", "raw_messages"))
def q_stream_trim(spark, sf_dir):
    raw = fx.raw_messages(spark, sf_dir).select("event_id", "arrival_seq", "stream", "event_type")
    return MS.newest_per_stream(raw, STREAM_MAXLEN)


@register("last_messages", sql=with_views("""
select event_id, arrival_seq, stream, event_type from raw_messages
where stream = 'sales-updates' order by arrival_seq desc limit 10""", "raw_messages"))
def q_last_messages(spark, sf_dir):
    raw = fx.raw_messages(spark, sf_dir).select("event_id", "arrival_seq", "stream", "event_type")
    return raw.filter(F.col("stream") == "sales-updates").orderBy(F.col("arrival_seq").desc()).limit(10)


@register("dedup_messages", sql=with_views("""
select event_id, min(arrival_seq) as arrival_seq, count(*) as copies
from (select * from raw_messages union all select * from raw_messages) r
group by event_id""", "raw_messages"))
def q_dedup_messages(spark, sf_dir):
    # K2: the whole stream delivered twice; the dedup keeps one copy per event_id.
    raw = fx.raw_messages(spark, sf_dir)
    replay = raw.unionByName(raw)
    return (replay.groupBy("event_id")
                  .agg(F.min("arrival_seq").alias("arrival_seq"), F.count(F.lit(1)).alias("copies")))
