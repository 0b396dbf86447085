"""Registered BOM queries (H1-H6). Oracles: a recursive walk over explicit paths."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.operators import bom as B
from tidemill.operators import bom_clients as BC
from tidemill.operators import bom_delta as BD
from tidemill.operators import configs as C
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.session import scratch_path
from tidemill.sources import fixtures as fx

LEVELS = 5


def _walk(edges: str) -> str:
    return f"""
walk(root, node, path, q, lvl, site) as (
  select parent, component, [parent, component], qty, 1, produced_at from {edges} where component <> parent
  union all
  select w.root, e.component, list_append(w.path, e.component), w.q * e.qty, w.lvl + 1, e.produced_at
  from walk w join {edges} e on e.parent = w.node
  where w.lvl < {LEVELS} and not list_contains(w.path, e.component))"""


def _explode_sql(edges: str, site: bool) -> str:
    key = "root, node, site" if site else "root, node"
    sel = "root, node as component, site as produced_at" if site else "root, node as component"
    return f"""
with recursive {_walk(edges).strip()}
select {sel}, sum(q) as qty, cast(count(*) as bigint) as paths,
  cast(min(lvl) as int) as min_level, cast(max(lvl) as int) as max_level
from walk group by {key}"""


@register("bom_explode", sql=with_views(_explode_sql("bom", False), "bom"))
def q_bom_explode(spark, sf_dir):
    return B.bom_explode(fx.bom(spark, sf_dir), LEVELS, include_produced_at=False)


@register("bom_by_site", sql=with_views(_explode_sql("bom", True), "bom"))
def q_bom_by_site(spark, sf_dir):
    return B.bom_explode(fx.bom(spark, sf_dir), LEVELS, include_produced_at=True)


@register("bom_explode_cyclic", sql=with_views(_explode_sql("bom_cyclic", False), "bom_cyclic"))
def q_bom_explode_cyclic(spark, sf_dir):
    return B.bom_explode(fx.bom(spark, sf_dir, with_cycle=True), LEVELS, include_produced_at=False)


@register("bom_unchecked", sql=with_views(f"""
with recursive walk(root, node, q, lvl) as (
  select parent, component, qty, 1 from bom_cyclic
  union all
  select w.root, e.component, w.q * e.qty, w.lvl + 1 from walk w join bom_cyclic e on e.parent = w.node where w.lvl < {LEVELS})
select root, node as component, sum(q) as qty, cast(count(*) as bigint) as paths,
  cast(min(lvl) as int) as min_level, cast(max(lvl) as int) as max_level
from walk group by root, node""", "bom_cyclic"))
def q_bom_unchecked(spark, sf_dir):
    """Cycle detection switched off: walks up to the depth cap."""
    return B.bom_explode(fx.bom(spark, sf_dir, with_cycle=True), LEVELS, include_produced_at=False, cycle_detection=False)


@register("bom_cycles", sql=with_views(f"""
with recursive {_walk("bom_cyclic").strip()}
select root, parent, component, cast(sum(paths) as bigint) as paths, cast(min(level) as int) as level from (
  select w.root, w.node as parent, e.component, count(*) as paths, min(w.lvl + 1) as level
  from walk w join bom_cyclic e on e.parent = w.node
  where w.lvl < {LEVELS} and list_contains(w.path, e.component) group by 1, 2, 3
  union all
  select parent, parent, component, count(*), 1 from bom_cyclic where parent = component group by 1, 2, 3) b
group by 1, 2, 3""", "bom_cyclic"))
def q_bom_cycles(spark, sf_dir):
    return B.bom_cycles(fx.bom(spark, sf_dir, with_cycle=True), LEVELS)


@register("bom_truncated", sql=with_views(f"""
with recursive {_walk("bom").strip()}
select root, node as component, cast(count(*) as bigint) as paths from walk
where lvl = {LEVELS} and node in (select parent from bom) group by 1, 2""", "bom"))
def q_bom_truncated(spark, sf_dir):
    return B.bom_truncated(fx.bom(spark, sf_dir), LEVELS)


_DEMAND = f"""
with recursive {_walk("bom").strip()},
ex as (select root, node as component, sum(q) as per_unit from walk group by 1, 2),
dem as (select s.client_id, ex.component, s.ds, round(sum(s.qty * ex.per_unit), 4) as demand
        from sales s join ex on ex.root = s.product_id group by 1, 2, 3)"""


def _demand(spark, sf_dir):
    exploded = B.bom_explode(fx.bom(spark, sf_dir), LEVELS, include_produced_at=False)
    return B.component_demand(fx.sales(spark, sf_dir), exploded, fx.sale_lines(spark, sf_dir).count())


@register("component_demand", sql=with_views(f"{_DEMAND} select * from dem", "bom", "sales"))
def q_component_demand(spark, sf_dir):
    d = _demand(spark, sf_dir)
    return d.withColumn("demand", F.round("demand", 4))


@register("bom_run_status", sql=with_views(f"""{_DEMAND}
select client_id, count(*) as records_processed, max(ds) as last_processed_at,
  case when count(*) > 0 then 'ok' else 'empty' end as status, cast(null as varchar) as error_message
from dem group by 1""", "bom", "sales"))
def q_bom_run_status(spark, sf_dir):
    d = _demand(spark, sf_dir)
    return B.bom_run_status(d)


@register("bom_config_current", sql=with_views("""
select * from bom_configs where is_active
qualify row_number() over (partition by client_id order by created_at desc nulls first, id desc) = 1""", "bom_configs"))
def q_bom_config_current(spark, sf_dir):
    return C.config_current(fx.bom_configs(spark, sf_dir), ["client_id"])


@register("bom_config_violations", sql=with_views("""
select id, client_id, 'max_levels_range' as rule from bom_configs
where max_levels is null or max_levels < 1 or max_levels > 10""", "bom_configs"))
def q_bom_config_violations(spark, sf_dir):
    return BC.bom_violations(fx.bom_configs(spark, sf_dir))


# All walks of up to ten edges; ``simple`` ones meet no node twice.
_PROFILES = """
with recursive walk(root, node, path, simple, q, lvl, site) as (
  select parent, component, [parent, component], component <> parent, qty, 1, produced_at from bom_cyclic
  union all
  select w.root, e.component, list_append(w.path, e.component), w.simple and not list_contains(w.path, e.component),
    w.q * e.qty, w.lvl + 1, e.produced_at
  from walk w join bom_cyclic e on e.parent = w.node where w.lvl < 10),
levels as (select root, node, site, lvl, simple, sum(q) as q, count(*) as n from walk group by all),
needs as (select distinct s.product_id as root, p.max_levels, p.include_produced_at, p.cycle_detection
          from sales s join bom_profile p on p.client_id = s.client_id where p.error_message is null),
ex as (select n.root, n.max_levels, n.include_produced_at, n.cycle_detection, l.node as component,
    case when n.include_produced_at then l.site end as produced_at, sum(l.q) as qty, cast(sum(l.n) as bigint) as paths,
    cast(min(l.lvl) as int) as min_level, cast(max(l.lvl) as int) as max_level
  from needs n join levels l on l.root = n.root and l.lvl <= n.max_levels and (l.simple or not n.cycle_detection)
  group by 1, 2, 3, 4, 5, 6)"""
_OWN_DEMAND = f"""{_PROFILES},
dem as (select s.client_id, ex.component, ex.produced_at, s.ds, round(sum(s.qty * ex.qty), 4) as demand
  from sales s join bom_profile p on p.client_id = s.client_id and p.error_message is null
  join ex on ex.root = s.product_id and ex.max_levels = p.max_levels
    and ex.include_produced_at = p.include_produced_at and ex.cycle_detection = p.cycle_detection
  group by 1, 2, 3, 4),
status as (select p.client_id, d.last_processed_at, coalesce(d.n, 0) as records_processed,
  case when p.error_message is not null then 'error' when d.n > 0 then 'ok' else 'empty' end as status, p.error_message
  from bom_profile p left join (select client_id, count(*) as n, max(ds) as last_processed_at from dem group by 1) d
    on d.client_id = p.client_id)"""
_OWN_VIEWS = ("bom_cyclic", "sales", "bom_profile")


def _profiles(spark, sf_dir):
    return BC.client_profiles(fx.bom_clients(spark, sf_dir), fx.bom_configs(spark, sf_dir))


def _reached(spark, sf_dir):
    return BC.reached_below(fx.bom(spark, sf_dir, with_cycle=True), BC.profiles_in_use(fx.sale_lines(spark, sf_dir), _profiles(spark, sf_dir)))


def _own_demand(spark, sf_dir):
    return BC.demand_by_profile(fx.sales(spark, sf_dir), _profiles(spark, sf_dir), _reached(spark, sf_dir), fx.sale_lines(spark, sf_dir).count())


@register("bom_profiles", sql=with_views(f"{_PROFILES} select * from ex", *_OWN_VIEWS))
def q_bom_profiles(spark, sf_dir):
    """The explosion under every client's own depth cap, site key and cycle switch."""
    return BC.profile_rows(_reached(spark, sf_dir))


@register("component_demand_by_config", sql=with_views(f"{_OWN_DEMAND} select * from dem", *_OWN_VIEWS))
def q_component_demand_by_config(spark, sf_dir):
    return _own_demand(spark, sf_dir).withColumn("demand", F.round("demand", 4))


@register("bom_status_by_client", sql=with_views(f"{_OWN_DEMAND} select * from status", *_OWN_VIEWS))
def q_bom_status_by_client(spark, sf_dir):
    """Run status of all clients: failed, empty and served ones."""
    return BC.run_status(_profiles(spark, sf_dir), _own_demand(spark, sf_dir))


@register("bom_exploded_events", sql=with_views(f"""{_OWN_DEMAND}
select client_id, 'bom-exploded' as stream, 'bom_exploded' as event_type,
  '{{"records_processed":' || records_processed || ',"status":"' || status || '"}}' as data
from status where status <> 'error'""", *_OWN_VIEWS))
def q_bom_exploded_events(spark, sf_dir):
    return BC.bom_exploded_events(BC.run_status(_profiles(spark, sf_dir), _own_demand(spark, sf_dir)))


@register("bom_incremental", sql=with_views(_explode_sql("bom", True), "bom"))
def q_bom_incremental(spark, sf_dir):
    """A stored explosion of earlier edges, brought up to date for the roots that changed edges reach."""
    store = BD.BomStore(spark, scratch_path(spark, f"bom_store_{uuid.uuid4().hex}"), buckets=16, max_levels=LEVELS)
    before = fx.bom_before(spark, sf_dir)
    store.create(before)
    store.apply(before, fx.bom(spark, sf_dir))
    return store.read()
