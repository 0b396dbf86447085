"""Registered client queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import clients as CL
from tidemill.operators import messages as MS
from tidemill.plans.params import AS_OF_SQL, as_of_ntz
from tidemill.plans.q_messages import SALES_SQL, norm_with
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.sources import fixtures as fx

# Rows of the clients_updated messages, as DuckDB text (fixture payloads only
# carry string / boolean / object values, so this covers every case they show).
ROWS_SQL = f"""
rows as (
  select event_id, arrival_seq,
    regexp_replace(replace(replace(lower(j->>'id'), 'urn:', ''), 'uuid:', ''), '^[{{}}]+|[{{}}]+$|-', '', 'g') as h,
    case when json_type(j, '$.name') is null then '' else j->>'name' end as name,
    case when json_type(j, '$.organization_id') is null then '' else j->>'organization_id' end as organization_id,
    j->>'contact_email' as contact_email, j->>'contact_phone' as contact_phone,
    case when json_type(j, '$.status') is null then 'active' else j->>'status' end as status,
    case when json_type(j, '$.config_confirmed') is null then false
         else cast(j->>'config_confirmed' as boolean) end as config_confirmed,
    j->>'config_confirmed_by' as config_confirmed_by,
    cast(timezone('UTC', try_cast(j->>'config_confirmed_at' as timestamptz)) as timestamp) as config_confirmed_at,
    j->>'source' as source,
    coalesce(cast(timezone('UTC', try_cast(j->>'created_at' as timestamptz)) as timestamp), {AS_OF_SQL}) as created_at,
    coalesce(cast(timezone('UTC', try_cast(j->>'updated_at' as timestamptz)) as timestamp), {AS_OF_SQL}) as updated_at,
    {AS_OF_SQL} as synced_at,
    coalesce(array_to_string(list_sort(list_filter(json_keys(j->'features_enabled'),
        lambda k: json_extract_string(j->'features_enabled', '$."' || k || '"') = 'true')), ','), '') as enabled_features,
    c_reason as error
  from cl where event_type = 'clients_updated' and payload_truthy and payload_kind = 'object'),
typed as (
  select * exclude (h), case when regexp_matches(h, '^[0-9a-f]{{32}}$') then
    substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
    || substr(h, 17, 4) || '-' || substr(h, 21, 12) end as id from rows)"""

FOLD_SQL = """
fold as (
  select id, arg_max({'name': name, 'organization_id': organization_id, 'status': status,
                      'config_confirmed': config_confirmed, 'updated_at': updated_at,
                      'enabled_features': enabled_features, 'source': source}, arrival_seq) as l,
    arg_min(created_at, arrival_seq) as created_at, count(*) as n_events
  from typed where error is null group by id),
clients_fold as (
  select id, l.name as name, l.organization_id as organization_id, l.status as status,
    l.config_confirmed as config_confirmed, l.updated_at as updated_at, l.enabled_features as enabled_features,
    l.source as source, created_at, n_events from fold)"""


def _rows(spark, sf_dir, raw=None):
    raw = fx.raw_messages(spark, sf_dir) if raw is None else raw
    return CL.client_rows(MS.normalise_messages(raw), as_of_ntz())


def _fold_out(df):
    return df.select("id", "name", "organization_id", "status", "config_confirmed", "updated_at",
                     F.array_join(CL.enabled_list(F.from_json("features_enabled", "map<string,variant>")), ",")
                      .alias("enabled_features"),
                     "source", "created_at", "n_events")


@register("client_rows", sql=with_views(f"""
with {norm_with(ROWS_SQL.strip())}
select event_id, arrival_seq, id, name, organization_id, contact_email, contact_phone, status, config_confirmed,
  config_confirmed_by, config_confirmed_at, source, created_at, updated_at, synced_at, enabled_features, error
from typed""", "raw_messages"))
def q_client_rows(spark, sf_dir):
    r = _rows(spark, sf_dir)
    return r.select("event_id", "arrival_seq", "id", "name", "organization_id", "contact_email", "contact_phone",
                    "status", "config_confirmed", "config_confirmed_by", "config_confirmed_at", "source",
                    "created_at", "updated_at", "synced_at",
                    F.array_join(CL.enabled_list(F.col("features_enabled")), ",").alias("enabled_features"),
                    "error")


@register("client_timestamps", sql=with_views(f"""
with {norm_with(ROWS_SQL.strip())}
select event_id, created_at, updated_at, config_confirmed_at, synced_at from typed""", "raw_messages"))
def q_client_timestamps(spark, sf_dir):
    return _rows(spark, sf_dir).select("event_id", "created_at", "updated_at", "config_confirmed_at", "synced_at")


@register("enabled_features", sql=with_views(f"""
with {norm_with(ROWS_SQL.strip())}
select event_id, id, enabled_features, cast(len(string_split(nullif(enabled_features, ''), ',')) as int) as features_count,
  coalesce(json_extract_string(j_fe, '$.bom_explosion') = 'true', false) as bom_explosion_enabled
from (select t.*, c.j->'features_enabled' as j_fe from typed t join cl c using (event_id)) x
where error is null""", "raw_messages"))
def q_enabled_features(spark, sf_dir):
    e = CL.enabled_features(_rows(spark, sf_dir))
    return e.select("event_id", "id", F.array_join("enabled_features", ",").alias("enabled_features"),
                    F.col("features_count").cast("int").alias("features_count"), "bom_explosion_enabled")


@register("clients_upsert", sql=with_views(f"""
with {norm_with(ROWS_SQL.strip(), FOLD_SQL.strip())} select * from clients_fold""", "raw_messages"))
def q_clients_upsert(spark, sf_dir):
    return _fold_out(CL.clients_upsert(_rows(spark, sf_dir)))


@register("client_by_id", sql=with_views("select * from clients where id = 42", "clients"))
def q_client_by_id(spark, sf_dir):
    return CL.client_by_id(fx.clients(spark, sf_dir), 42)


@register("active_clients", sql=with_views("select * from clients where status = 'active' order by name, id",
                                           "clients"))
def q_active_clients(spark, sf_dir):
    return CL.active_clients(fx.clients(spark, sf_dir))


@register("clients_with_feature", sql=with_views("""
select * from clients
where status = 'active'
  and coalesce(regexp_matches(lower(trim(features_enabled->>'forecast')), '^(t|tr|tru|true|y|ye|yes|on|1)$'), false)
order by name, id""", "clients"))
def q_clients_with_feature(spark, sf_dir):
    return CL.clients_with_feature(fx.clients(spark, sf_dir), "forecast")


ENRICHED_SQL = with_views(f"""
with {norm_with(SALES_SQL.strip(), ROWS_SQL.strip(), FOLD_SQL.strip())}
select s.event_id, s.client_id, s.table_name, s.record_count,
  coalesce(f.name, 'unknown') as client_name, coalesce(f.status, 'not_found') as client_status
from sales_n s left join clients_fold f on f.id = lower(s.client_id)""", "raw_messages")


@register("sales_enriched", sql=ENRICHED_SQL)
def q_sales_enriched(spark, sf_dir):
    raw = fx.raw_messages(spark, sf_dir)
    clients = CL.clients_upsert(_rows(spark, sf_dir, raw))
    return CL.sales_enriched(MS.sales_notifications(MS.normalise_messages(raw)), clients)


@register("bom_status_report", sql=with_views("""
select c.id, c.name, c.organization_id, s.last_processed_at, s.records_processed
from clients c left join bom_explosion_status s on c.id = s.client_id
where c.status = 'active' order by s.last_processed_at desc nulls first, c.id""", "clients", "bom_explosion_status"))
def q_bom_status_report(spark, sf_dir):
    return CL.bom_status_report(fx.clients(spark, sf_dir), fx.bom_explosion_status(spark, sf_dir))


@register("gate_eligible", sql=with_views("""
select * from sales s where exists (select 1 from clients c where c.id = s.client_id and c.status = 'active'
                                    and coalesce(c.config_confirmed, false))""", "sales", "clients"))
def q_gate_eligible(spark, sf_dir):
    return CL.gate_eligible(fx.sales(spark, sf_dir), fx.clients(spark, sf_dir))


@register("gate_blocked", sql=with_views("""
with ok as (select id from clients where status = 'active' and coalesce(config_confirmed, false)),
held as (select client_id, count(*) as n_rows from sales s where client_id not in (select id from ok) group by 1)
select h.client_id, h.n_rows,
  case when c.status is null then 'not_found' when c.status <> 'active' then 'inactive' else 'not_confirmed' end as reason
from held h left join clients c on c.id = h.client_id""", "sales", "clients"))
def q_gate_blocked(spark, sf_dir):
    return CL.gate_blocked(fx.sales(spark, sf_dir), fx.clients(spark, sf_dir))


@register("new_rows", sql=with_views("""
select s.* from sales s left join client_state c on c.client_id = s.client_id
where s.ds > coalesce(c.last_processed_at, date '0001-01-01')""", "sales", "client_state"))
def q_new_rows(spark, sf_dir):
    return CL.new_rows(fx.sales(spark, sf_dir), fx.client_state(spark, sf_dir))


@register("advance_state", sql=with_views("""
with n as (select s.client_id, max(s.ds) as new_last from sales s left join client_state c on c.client_id = s.client_id
           where s.ds > coalesce(c.last_processed_at, date '0001-01-01') group by 1)
select coalesce(c.client_id, n.client_id) as client_id, coalesce(n.new_last, c.last_processed_at) as last_processed_at
from client_state c full join n on n.client_id = c.client_id""", "sales", "client_state"))
def q_advance_state(spark, sf_dir):
    return CL.advance_state(fx.sales(spark, sf_dir), fx.client_state(spark, sf_dir))
