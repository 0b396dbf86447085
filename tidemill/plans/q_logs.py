"""Registered log queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemill.operators import logs as L
from tidemill.plans.params import AS_OF_SQL, as_of_ntz
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.sources import fixtures as fx

# The reports' time windows reach from the newest row back over the oldest one, whatever the rows' dates.
_HOURS_SQL = "(select cast(ceil(epoch(max(ts) - min(ts)) / 3600) as int) + 1 from logs)"
_NEWEST_SQL = "(select max(ts) from logs)"


def _window(logs):
    """(time of the newest row, hours back that cover all rows), from one aggregate of two values."""
    span = logs.agg(F.max("ts").cast("timestamp_ntz").alias("hi"), F.min("ts").cast("timestamp_ntz").alias("lo")).first()
    if span["hi"] is None:
        return as_of_ntz(), 24
    return F.lit(span["hi"]).cast("timestamp_ntz"), math.ceil((span["hi"] - span["lo"]).total_seconds() / 3600) + 1


@register("log_stats", sql=with_views(f"""
select service_name as service, environment, level, count(*) as count,
  case when count(duration_ms) > 0 then
    cast(sign(sum(duration_ms)) * ((abs(sum(duration_ms)) * 200 + count(duration_ms)) // (2 * count(duration_ms))) as double) / 100
  end as avg_duration_ms
from logs where ts >= {_NEWEST_SQL} - to_hours({_HOURS_SQL})
group by 1, 2, 3 order by count desc""", "logs"))
def q_log_stats(spark, sf_dir):
    logs = fx.logs(spark, sf_dir)
    return L.log_stats(logs, *_window(logs))


from tidemill.operators import partitions as P  # noqa: E402
LOG_COLS = "ts, service_name, environment, level, category, trace_id, message, duration_ms, event_id"


def _logs(spark, sf_dir):
    return fx.logs(spark, sf_dir)


@register("normalised_logs", sql=with_views("""
select ts, service_name, environment, level,
  case when event_id % 7 = 0 then 'security' else category end as category, trace_id, message,
  'k=' || coalesce(context->>'k', 'base') || ';service=' || service_name as context, duration_ms,
  case event_id % 3 when 0 then 'src/handlers/event_handler.py' when 1 then 'site.py' else 'main.py' end as file_path,
  case when level in ('error', 'fatal', 'panic') then 'Traceback ' || cast(event_id as varchar) end as stack_trace,
  event_id
from logs""", "logs"))
def q_normalised_logs(spark, sf_dir):
    n = L.normalise_logs(fx.log_calls(spark, sf_dir))
    return n.withColumn("context", L.context_text(F.col("context")))


@register("severe_logs", sql=with_views(f"""
select {LOG_COLS} from logs where level in ('error', 'fatal', 'panic') order by ts desc, event_id desc""", "logs"))
def q_severe_logs(spark, sf_dir):
    return L.severe_logs(_logs(spark, sf_dir)).drop("context")


@register("logs_for_trace", sql=with_views(f"select {LOG_COLS} from logs where trace_id = 'trace-42'", "logs"))
def q_logs_for_trace(spark, sf_dir):
    return L.logs_for_trace(_logs(spark, sf_dir), "trace-42").drop("context")


@register("logs_for_client", sql=with_views(f"select {LOG_COLS} from logs where context->>'k' = '42'", "logs"))
def q_logs_for_client(spark, sf_dir):
    return L.logs_for_context(_logs(spark, sf_dir), "k", "42").drop("context")


@register("recent_logs", sql=with_views(f"""
select {LOG_COLS} from logs where category = 'messenger' and ts > {_NEWEST_SQL} - to_hours({_HOURS_SQL})
order by ts desc, event_id desc""", "logs"))
def q_recent_logs(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    as_of, hours = _window(logs)
    return L.recent_logs(logs, "messenger", as_of, 60 * hours).drop("context")


@register("last_errors", sql=with_views(f"""
select {LOG_COLS} from logs where category = 'messenger' and level = 'error'
order by ts desc, event_id desc limit 20""", "logs"))
def q_last_errors(spark, sf_dir):
    return L.last_errors(_logs(spark, sf_dir), "messenger").drop("context")


@register("logs_by_month", sql=with_views("""
select cast(date_trunc('month', ts) as date) as month, count(*) as rows from logs group by 1""", "logs"))
def q_logs_by_month(spark, sf_dir):
    return P.partition_counts(_logs(spark, sf_dir))


@register("month_calendar", sql=with_views(f"""
with c as (select cast(date_trunc('month', ts) as date) as month, count(*) as rows from logs group by 1),
cal as (select cast(unnest(generate_series(cast(date_trunc('month', {AS_OF_SQL}) as date),
          cast(date_trunc('month', {AS_OF_SQL}) + interval 3 month as date), interval 1 month)) as date) as month)
select 'logs_' || strftime(cal.month, '%Y_%m') as partition, cal.month as start,
  cast(cal.month + interval 1 month as date) as "end", coalesce(c.rows, 0) as rows
from cal left join c on c.month = cal.month""", "logs"))
def q_month_calendar(spark, sf_dir):
    return P.month_calendar(_logs(spark, sf_dir), as_of_ntz(), 3)


RETENTION_DAYS = 10


@register("retention_plan", sql=with_views(f"""
with cut as (select cast({AS_OF_SQL} - interval {RETENTION_DAYS} day as date) as d)
select 'logs_' || strftime(month, '%Y_%m') as partition, month, rows, month < (select d from cut) as "drop",
  case when month < (select d from cut) then after else 0 end as rows_lost_early
from (select cast(date_trunc('month', ts) as date) as month, count(*) as rows,
        count(*) filter (where cast(ts as date) >= (select d from cut)) as after from logs group by 1) m""", "logs"))
def q_retention_plan(spark, sf_dir):
    return P.retention_plan(_logs(spark, sf_dir), as_of_ntz(), RETENTION_DAYS)


import datetime as dt  # noqa: E402
import uuid  # noqa: E402

from tidemill.operators import log_table as T  # noqa: E402
from tidemill.plans.params import AS_OF_TEXT  # noqa: E402
from tidemill.session import scratch_path  # noqa: E402

_FROM, _TO = "2023-11-10 06:00:00", "2024-01-15 12:00:00"
_AS_OF = dt.datetime.fromisoformat(AS_OF_TEXT)
KEEP_DAYS = 75


def _table(spark, sf_dir) -> T.LogTable:
    table = T.LogTable(spark, scratch_path(spark, f"logs_{uuid.uuid4().hex}"))
    table.append(T.log_records(fx.log_records(spark, sf_dir)))
    return table


def _shown(rows):
    """Log rows with two fields of the typed context instead of the whole."""
    field = lambda path, kind: F.try_variant_get("context", path, kind)
    return (rows.withColumns({"context_k": field("$.k", "bigint"), "context_service": field("$.service", "string")})
                .drop("context", "month"))


@register("log_records", sql=with_views("select * from log_table", "log_table"))
def q_log_records(spark, sf_dir):
    """All 19 columns, written to the month-partitioned table and read back."""
    return _shown(_table(spark, sf_dir).read())


@register("logs_in_range", sql=with_views(f"select * from log_table where ts >= '{_FROM}' and ts < '{_TO}'", "log_table"))
def q_logs_in_range(spark, sf_dir):
    return _shown(_table(spark, sf_dir).read(F.lit(_FROM).cast("timestamp_ntz"), F.lit(_TO).cast("timestamp_ntz")))


@register("logs_for_request", sql=with_views("select * from log_table where request_id = 'req-41'", "log_table"))
def q_logs_for_request(spark, sf_dir):
    return _shown(T.logs_for_request(_table(spark, sf_dir).read(), "req-41"))


@register("logs_with_context", sql=with_views("select * from log_table where context_k = 42", "log_table"))
def q_logs_with_context(spark, sf_dir):
    return _shown(T.logs_with_context(_table(spark, sf_dir).read(), "$.k", F.lit(42), "bigint"))


@register("log_calendar", sql=with_views(f"""
with c as (select cast(date_trunc('month', ts) as date) as month, count(*) as rows from log_table group by 1),
cal as (select cast(unnest(generate_series((select min(month) from c),
          cast(date_trunc('month', {AS_OF_SQL}) + interval 3 month as date), interval 1 month)) as date) as month)
select 'logs_' || strftime(cal.month, '%Y_%m') as partition, cal.month as start,
  cast(cal.month + interval 1 month as date) as "end", coalesce(c.rows, 0) as rows
from cal left join c on c.month = cal.month""", "log_table"))
def q_log_calendar(spark, sf_dir):
    """Months from metadata, gaps included."""
    return _table(spark, sf_dir).calendar(_AS_OF.date())


@register("log_retention", sql=with_views(f"""
with cut as (select cast({AS_OF_SQL} - interval {KEEP_DAYS} day as date) as d)
select 'logs_' || strftime(month, '%Y_%m') as partition, month, rows, month < (select d from cut) as "drop",
  case when month < (select d from cut) then after else 0 end as rows_lost_early
from (select cast(date_trunc('month', ts) as date) as month, count(*) as rows,
        count(*) filter (where cast(ts as date) >= (select d from cut)) as after from log_table group by 1) m""", "log_table"))
def q_log_retention(spark, sf_dir):
    return _table(spark, sf_dir).retention(_AS_OF, KEEP_DAYS)


@register("logs_after_retention", sql=with_views(f"""
select * from log_table
where date_trunc('month', ts) >= cast({AS_OF_SQL} - interval {KEEP_DAYS} day as date)""", "log_table"))
def q_logs_after_retention(spark, sf_dir):
    table = _table(spark, sf_dir)
    table.apply_retention(_AS_OF, KEEP_DAYS)
    return _shown(table.read())
