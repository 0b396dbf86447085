"""DuckDB text of the fixture views (FIXTURES.md §2), for the oracle queries.

``with_views(body, *names)`` prefixes a query with the CTEs it needs, so each
oracle is one self-contained statement over the pre-registered driver tables.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "raw_messages": """
select cast(event_id as varchar) as event_id, event_id as arrival_seq, ts as event_ts,
  case event_type when 'signup' then 'clients-updates' when 'purchase' then 'sales-updates'
       else 'other-updates' end as stream,
  case event_type when 'signup' then 'clients_updated' when 'purchase' then 'sales_updated'
       when 'click' then 'stock_updated' when 'view' then 'bom_updated' else 'mystery' end as event_type,
  case when event_id % 40 = 7 then null when event_id % 40 = 9 then 'not-a-uuid'
       else '00000000-0000-4000-8000-' || lpad(cast(user_id as varchar), 12, '0') end as client_id,
  case when event_id % 50 = 0 then 'not json' when event_id % 50 = 1 then '{}' when event_id % 50 = 2 then '[1]'
       when event_id % 50 = 3 then '{"id":"nope","name":"x","organization_id":"1"}'
       when event_id % 50 = 4 then '{"name":"x","organization_id":"1"}'
       when event_type = 'signup' then
         '{"id":"00000000-0000-4000-8000-' || lpad(cast(user_id as varchar), 12, '0')
         || '","name":"client ' || cast(user_id as varchar)
         || '","organization_id":"' || cast(user_id % 7 as varchar)
         || '","status":"' || case when event_id % 5 = 0 then 'suspended' else 'active' end
         || '","features_enabled":{"feature_engineering":true,"bom_explosion":'
         || case when event_id % 2 = 0 then 'true' else 'false' end
         || '},"config_confirmed":' || case when event_id % 3 = 0 then 'false' else 'true' end
         || ',"created_at":"2024-01-' || lpad(cast(1 + event_id % 28 as varchar), 2, '0') || 'T00:00:00Z"}'
       else '{"table_name":"c' || cast(user_id % 7 as varchar) || '_sales","record_count":'
         || cast(event_id % 90 as varchar) || '}' end as data
from events""",
    "clients": """
select c_custkey as id, c_name as name, cast(c_nationkey as varchar) as organization_id,
  case c_mktsegment when 'HOUSEHOLD' then 'suspended' when 'MACHINERY' then 'archived' else 'active' end as status,
  c_acctbal > 2000 as config_confirmed,
  case c_custkey % 3 when 0 then 'prefixed_tables' when 1 then 'dedicated_db' else 'shared' end as tenant_mode,
  case c_custkey % 7 when 0 then '{"forecast":true}' when 1 then '{"forecast":false}'
    when 2 then '{"forecast":"yes"}' when 3 then '{"forecast":"on"}' when 4 then '{"forecast":"abc"}'
    when 5 then '{"forecast":null}' else '{}' end as features_enabled
from customer""",
    "logs": """
select ts, 'svc-' || cast(user_id % 3 as varchar) as service_name,
  case event_id % 3 when 0 then 'dev' when 1 then 'stage' else 'prod' end as environment,
  case event_type when 'error' then 'error' when 'click' then 'info' when 'view' then 'debug'
       when 'signup' then 'warn' else 'fatal' end as level,
  case event_id % 4 when 0 then 'messenger' when 1 then 'database' when 2 then 'starrocks' end as category,
  'trace-' || cast(event_id % 100 as varchar) as trace_id,
  'message ' || cast(event_id as varchar) as message, props as context,
  case when event_id % 10 = 0 then null else cast(floor(value) as int) end as duration_ms, event_id
from events""",
    "log_table": """
select ts - to_days(cast(case event_id % 5 when 0 then 92 when 1 then 61 else 0 end as int)) as ts, service_name,
  'i-' || (event_id % 6) as instance_id, case when event_id % 4 <> 0 then 'node-' || (event_id % 4) end as node_name, environment, level,
  case when event_id % 7 = 0 then 'security' else category end as category, trace_id,
  lpad(lower(to_hex(event_id)), 16, '0') as span_id, case when event_id % 3 <> 0 then 'req-' || (event_id % 50) end as request_id,
  'run_' || (event_id % 8) as function_name,
  case event_id % 3 when 0 then 'src/handlers/event_handler.py' when 1 then 'site.py' else 'main.py' end as file_path,
  cast(1 + event_id % 300 as int) as line_number, message, case when level = 'error' then 'failed ' || event_id end as error_message,
  case when level in ('error', 'fatal', 'panic') then 'Traceback ' || event_id end as stack_trace,
  try_cast(context->>'k' as bigint) as context_k, service_name as context_service, duration_ms,
  ts + interval 2 second as ingestion_time, event_id
from logs""",
    "sales": """
select l_suppkey as client_id, l_partkey as product_id, cast(l_shipdate as date) as ds, sum(l_quantity) as qty
from lineitem group by 1, 2, 3""",
    "bom": """
select p_partkey as parent, cast(floor(p_partkey / 3) as bigint) as component,
  (1 + p_partkey % 4) * cast(0.25 as double) as qty, 'site-' || cast(p_partkey % 5 as varchar) as produced_at
from part where p_partkey >= 1
union all
select p_partkey, cast(floor(p_partkey / 7) as bigint), (1 + p_partkey % 3) * cast(0.5 as double),
  'site-' || cast(p_partkey % 5 as varchar)
from part where p_partkey >= 1 and floor(p_partkey / 7) <> floor(p_partkey / 3)""",
    "bom_cyclic": """
select * from bom union all select cast(0 as bigint), cast(5 as bigint), cast(1 as double), 'site-0'""",
    "feature_configs": """
select o_orderkey as id, o_custkey as client_id,
  case o_orderkey % 3 when 0 then 'ema' when 1 then 'lags' else 'seasonality' end as feature_type,
  o_orderdate as created_at, o_orderstatus <> 'F' as is_active,
  cast(30 + o_orderkey % 400 as int) as window_days, cast(o_orderkey % 10 as int) as min_samples,
  case o_orderkey % 4 when 0 then 'decay' when 1 then 'fill_zero' when 2 then 'drop' else 'bogus' end as nan_strategy
from orders""",
    "bom_configs": """
select o_orderkey as id, o_custkey as client_id,
  case when o_orderkey % 29 = 0 then null else cast(o_orderkey % 13 as int) end as max_levels,
  o_orderkey % 2 = 0 as include_produced_at, o_orderkey % 3 <> 0 as cycle_detection,
  o_orderstatus <> 'F' as is_active, o_orderdate as created_at
from orders""",
    "bom_profile": """
select c.client_id, case when b.id is null then 5 else b.max_levels end as max_levels,
  coalesce(b.include_produced_at, true) as include_produced_at, coalesce(b.cycle_detection, true) as cycle_detection,
  case when b.id is not null and (b.max_levels is null or b.max_levels < 1 or b.max_levels > 10) then 'max_levels_range' end as error_message
from (select s_suppkey as client_id from supplier union all select -1 - s_suppkey from supplier) c
left join (select * from bom_configs where is_active
           qualify row_number() over (partition by client_id order by created_at desc nulls first, id desc) = 1) b
  on b.client_id = c.client_id""",
    "bom_explosion_status": """
select o_custkey as client_id, max(o_orderdate) as last_processed_at, count(*) as records_processed
from orders where o_custkey % 3 <> 0 group by o_custkey""",
    "client_state": """
select s_suppkey as client_id, case when s_suppkey % 4 = 0 then null else date '2000-01-01' end as last_processed_at
from supplier""",
    "tenant_usage": """
select user_id % 10 as tenant_id, cast(ts as date) as day, value as latency_ms, event_id * 10 as bytes from events""",
    "promos": """
select p_partkey as product_id, date '1998-01-01' + cast(p_partkey % 365 as int) as start_ds,
  date '1998-01-01' + cast(p_partkey % 365 + 13 as int) as end_ds
from part where p_partkey % 5 = 0""",
    "weather": """
select distinct cast(l_shipdate as date) as ds, cast(5 + extract(day from l_shipdate) % 20 as int) as temperature,
  cast(extract(month from l_shipdate) % 4 as int) as precipitation, cast(1 + extract(day from l_shipdate) % 9 as int) as wind
from lineitem""",
    "holidays": """
select distinct cast(l_shipdate as date) as ds from lineitem
where (extract(month from l_shipdate) = 1 and extract(day from l_shipdate) <= 7)
   or (extract(month from l_shipdate) = 5 and extract(day from l_shipdate) in (1, 9))""",
}

# Views that are built on other views.
DEPENDS = {"bom_cyclic": ("bom",), "bom_profile": ("bom_configs",), "log_table": ("logs",)}


def with_views(body: str, *names: str) -> str:
    """``WITH <views> <body>``; dependencies are added before their users."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in DEPENDS.get(name, ()):
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    body = body.strip()
    low = body.lower()
    if low.startswith("with recursive "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if low.startswith("with "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
