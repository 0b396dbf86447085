"""Registered tenant queries."""

from __future__ import annotations

from tidemill.operators import tenants as T
from tidemill.plans.params import AS_OF_SQL, as_of_ntz
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.sources import fixtures as fx


@register("param_sql", sql=with_views("""
select service_name, level, count(*) as n, cast(sum(duration_ms) as bigint) as total_ms
from logs where level = 'error' and environment = 'prod' group by 1, 2""", "logs"))
def q_param_sql(spark, sf_dir):
    return T.run_sql(spark, """
        SELECT service_name, level, count(*) AS n, sum(duration_ms) AS total_ms
        FROM {logs} WHERE level = :level AND environment = :env GROUP BY service_name, level""",
                     {"level": "error", "env": "prod"}, logs=fx.logs(spark, sf_dir))


@register("tenant_routes", sql=with_views("""
select id, organization_id, tenant_mode, data_type,
  case when tenant_mode = 'dedicated_db' then 'client_' || organization_id else 'shared' end as database,
  case when tenant_mode = 'prefixed_tables' then 'c' || organization_id || '_' || data_type else data_type end as "table",
  case when tenant_mode = 'shared' then 'tenant_id = ' || organization_id end as row_filter
from clients, (values ('features'), ('bom'), ('timeseries')) t(data_type)""", "clients"))
def q_tenant_routes(spark, sf_dir):
    return T.tenant_routes(fx.clients(spark, sf_dir))


@register("tenant_split_check", sql=with_views("""
select 3 as tenant_id, cast(date_trunc('month', day) as date) as month, count(*) as source_rows,
  count(*) as written_rows, true as match
from tenant_usage where tenant_id = 3 group by 2""", "tenant_usage"))
def q_tenant_split_check(spark, sf_dir):
    return T.split_tenant(fx.tenant_usage(spark, sf_dir), 3, T.scratch_dir(spark, "tenant-split"))


@register("slo_volume", sql=with_views(f"""
with d as (select tenant_id, day, sum(bytes) as day_bytes from tenant_usage
           where day > cast({AS_OF_SQL} as date) - 90 group by 1, 2)
select tenant_id, cast(sum(day_bytes) as bigint) as bytes_90d, cast(max(day_bytes) as bigint) as max_day_bytes,
  sum(day_bytes) > 300000000000 as volume_flag, max(day_bytes) > 2000000000000 as ingress_flag
from d group by 1""", "tenant_usage"))
def q_slo_volume(spark, sf_dir):
    return T.volume_signals(fx.tenant_usage(spark, sf_dir), as_of_ntz())


@register("slo_p95_breach", sql=with_views("""
with p as (select tenant_id, day, quantile_cont(latency_ms, 0.95) as p95 from tenant_usage group by 1, 2),
m as (select day, median(latency_ms) as cluster_median from tenant_usage group by 1),
b as (select p.tenant_id, p.day from p join m using (day) where p.p95 > 2.0 * m.cluster_median),
r as (select tenant_id, day, day - cast(row_number() over (partition by tenant_id order by day) as int) as grp from b)
select tenant_id, min(day) as start_day, max(day) as end_day, count(*) as days
from r group by tenant_id, grp having count(*) >= 3""", "tenant_usage"))
def q_slo_p95_breach(spark, sf_dir):
    return T.p95_breaches(fx.tenant_usage(spark, sf_dir))


@register("slo_share", sql=with_views("""
select tenant_id, cast(bytes as bigint) as bytes, round(bytes / sum(bytes) over (), 6) as share,
  round(bytes / sum(bytes) over (), 6) > 0.25 as share_flag
from (select tenant_id, sum(bytes) as bytes from tenant_usage group by 1) t""", "tenant_usage"))
def q_slo_share(spark, sf_dir):
    return T.compute_share(fx.tenant_usage(spark, sf_dir))
