"""Registered config queries."""

from __future__ import annotations

import uuid

from tidemill.operators import configs as C
from tidemill.operators.config_store import ConfigStore
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.session import scratch_path
from tidemill.sources import fixtures as fx

_ORDER = "order by created_at asc nulls last, id asc"


@register("config_current", sql=with_views("""
select id, client_id, feature_type, created_at, is_active, window_days, min_samples, nan_strategy from (
  select *, row_number() over (partition by client_id, feature_type order by created_at desc nulls first, id desc) as rn
  from feature_configs where is_active) c where rn = 1""", "feature_configs"))
def q_config_current(spark, sf_dir):
    return C.config_current(fx.feature_configs(spark, sf_dir))


@register("config_history", sql=with_views(f"""
select id, client_id, feature_type, created_at,
  row_number() over (partition by client_id, feature_type {_ORDER}) as version,
  lead(created_at) over (partition by client_id, feature_type {_ORDER}) as valid_to
from feature_configs order by client_id, feature_type, version desc""", "feature_configs"))
def q_config_history(spark, sf_dir):
    return C.config_history(fx.feature_configs(spark, sf_dir))


@register("config_versions", sql=with_views(f"""
select id, client_id, feature_type, created_at, is_active,
  lead(id) over (partition by client_id, feature_type {_ORDER}) is null as is_current
from feature_configs""", "feature_configs"))
def q_config_versions(spark, sf_dir):
    return C.config_versions(fx.feature_configs(spark, sf_dir))


@register("active_configs", sql=with_views("""
select id, client_id, feature_type, created_at, window_days, min_samples, nan_strategy
from feature_configs where is_active order by client_id, feature_type, id""", "feature_configs"))
def q_active_configs(spark, sf_dir):
    return C.active_configs(fx.feature_configs(spark, sf_dir))


@register("config_dupes", sql=with_views("""
select client_id, feature_type, count(*) as n_active from feature_configs where is_active
group by 1, 2 having count(*) > 1""", "feature_configs"))
def q_config_dupes(spark, sf_dir):
    return C.config_dupes(fx.feature_configs(spark, sf_dir))


@register("config_violations", sql=with_views("""
select id, client_id, feature_type, 'window_days_range' as rule from feature_configs
  where window_days is null or window_days <= 0 or window_days > 365
union all
select id, client_id, feature_type, 'min_samples_positive' from feature_configs where min_samples is null or min_samples <= 0
union all
select id, client_id, feature_type, 'nan_strategy_unknown' from feature_configs
  where nan_strategy is null or nan_strategy not in ('decay', 'fill_zero', 'drop')""", "feature_configs"))
def q_config_violations(spark, sf_dir):
    return C.config_violations(fx.feature_configs(spark, sf_dir))


@register("config_merge", sql=with_views(f"""
select *, lead(id) over (partition by client_id, feature_type {_ORDER}) is null as is_current
from feature_configs""", "feature_configs"))
def q_config_merge(spark, sf_dir):
    """Versions that arrive in three parts, out of order and partly twice, merged into stored flags."""
    store = ConfigStore(spark, scratch_path(spark, f"configs_{uuid.uuid4().hex}"), buckets=16)
    configs = fx.feature_configs(spark, sf_dir)
    for arriving in ("id % 4 in (1, 2)", "id % 4 = 0", "id % 4 in (2, 3)"):
        store.merge(configs.filter(arriving))
    return store.read()
