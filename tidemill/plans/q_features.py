"""Registered feature queries.

Series key: ``client_id`` (the dense per-client daily series); promo uses the
sparse (client, product) series. Oracles recompute every feature by a
self-join on key and day range, independent of the window formulation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import configs as C
from tidemill.operators import features as FE
from tidemill.plans.registry import register
from tidemill.plans.views import with_views
from tidemill.sources import fixtures as fx

KEYS = ["client_id"]

_DAILY = "daily as (select client_id, ds, sum(qty) as qty from sales group by 1, 2)"


def _daily(spark, sf_dir):
    return FE.daily_demand(fx.sale_lines(spark, sf_dir), KEYS)     # one aggregation of the facts


def _rolling_sql(series: str, weight: str, n_expr: str = "count(b.obs)") -> str:
    """Self-join oracle for EMA/MA/STD over 90 days with min_samples 7."""
    return f"""
with {_DAILY},
{series}
select a.client_id, a.ds, a.qty, {n_expr} as n_obs,
  case when {n_expr} >= 7 then round(sum(b.qty * pow(0.5, {weight})) / sum(pow(0.5, {weight})), 4) end as ema,
  case when {n_expr} >= 7 then round(avg(b.qty), 4) end as ma,
  case when {n_expr} >= 7 then round(stddev_samp(b.qty), 4) end as std
from s a join s b on a.client_id = b.client_id and b.dn between a.dn - 89 and a.dn
group by a.client_id, a.ds, a.qty"""


_SPARSE = "s as (select client_id, ds, qty, qty as obs, ds - date '1970-01-01' as dn, row_number() over (partition by client_id order by ds) as rk from daily)"
_DENSE = """span as (select client_id, min(ds) as lo, max(ds) as hi from daily group by 1),
dense as (select client_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as ds from span),
s as (select d.client_id, d.ds, coalesce(x.qty, 0.0) as qty, x.qty as obs, d.ds - date '1970-01-01' as dn
      from dense d left join daily x on x.client_id = d.client_id and x.ds = d.ds)"""

DECAY_SQL = with_views(_rolling_sql(_SPARSE, "a.dn - b.dn"), "sales")
DROP_SQL = with_views(_rolling_sql(_SPARSE, "a.rk - b.rk"), "sales")
FILL_SQL = with_views(_rolling_sql(_DENSE, "a.dn - b.dn"), "sales")


def _one(sql: str, col: str) -> str:
    return f"select client_id, ds, {col} from ({sql.strip()}) f"


@register("daily_demand", sql=with_views(f"with {_DAILY} select client_id, ds, qty from daily", "sales"))
def q_daily_demand(spark, sf_dir):
    return _daily(spark, sf_dir)


def _decay(spark, sf_dir):
    return FE.rolling_features(_daily(spark, sf_dir), KEYS, nan_strategy="decay")


@register("feat_ema", sql=_one(DECAY_SQL, "ema"))
def q_feat_ema(spark, sf_dir):
    return _decay(spark, sf_dir).select("client_id", "ds", "ema")


@register("feat_ma", sql=_one(DECAY_SQL, "ma"))
def q_feat_ma(spark, sf_dir):
    return _decay(spark, sf_dir).select("client_id", "ds", "ma")


@register("feat_std", sql=_one(DECAY_SQL, "std"))
def q_feat_std(spark, sf_dir):
    return _decay(spark, sf_dir).select("client_id", "ds", "std")


@register("feat_ema_decay", sql=DECAY_SQL)
def q_feat_ema_decay(spark, sf_dir):
    return _decay(spark, sf_dir)


@register("feat_ema_drop", sql=DROP_SQL)
def q_feat_ema_drop(spark, sf_dir):
    return FE.rolling_features(_daily(spark, sf_dir), KEYS, nan_strategy="drop")


@register("feat_ema_fill_zero", sql=FILL_SQL)
def q_feat_ema_fill_zero(spark, sf_dir):
    return FE.rolling_features(_daily(spark, sf_dir), KEYS, nan_strategy="fill_zero")


@register("feat_lags", sql=with_views(f"""
with {_DAILY}
select a.client_id, a.ds, a.qty, l1.qty as lag_1, l7.qty as lag_7, l14.qty as lag_14, l28.qty as lag_28,
  lag(a.qty, 1) over (partition by a.client_id order by a.ds) as obs_lag_1
from daily a
left join daily l1 on l1.client_id = a.client_id and l1.ds = a.ds - 1
left join daily l7 on l7.client_id = a.client_id and l7.ds = a.ds - 7
left join daily l14 on l14.client_id = a.client_id and l14.ds = a.ds - 14
left join daily l28 on l28.client_id = a.client_id and l28.ds = a.ds - 28""", "sales"))
def q_feat_lags(spark, sf_dir):
    return FE.lag_features(_daily(spark, sf_dir), KEYS)


@register("feat_seasonality", sql=with_views(f"""
with {_DAILY}
select d.client_id, d.ds, d.qty, cast(isodow(d.ds) - 1 as int) as day_of_week, cast(month(d.ds) as int) as month,
  h.ds is not null as is_holiday
from daily d left join holidays h on h.ds = d.ds""", "sales", "holidays"))
def q_feat_seasonality(spark, sf_dir):
    return FE.seasonality(_daily(spark, sf_dir), fx.holidays(spark, sf_dir))


@register("feat_weather", sql=with_views(f"""
with {_DAILY}
select d.client_id, d.ds, d.qty, w.temperature, w.precipitation, w.wind
from daily d left join weather w on w.ds = d.ds""", "sales", "weather"))
def q_feat_weather(spark, sf_dir):
    return FE.weather_features(_daily(spark, sf_dir), fx.weather(spark, sf_dir))


@register("feat_promo", sql=with_views("""
with pd as (select distinct product_id, cast(unnest(generate_series(start_ds, end_ds, interval 1 day)) as date) as ds from promos)
select s.client_id, s.product_id, s.ds, s.qty, pd.product_id is not null as on_promo
from sales s left join pd on pd.product_id = s.product_id and pd.ds = s.ds""", "sales", "promos"))
def q_feat_promo(spark, sf_dir):
    return FE.promo_features(fx.sales(spark, sf_dir), fx.promos(spark, sf_dir))


@register("feature_metadata", sql=f"""
with f as ({DECAY_SQL.strip()})
select feature, feature_type, count(*) as n_rows, count(*) filter (where v is null) as n_null,
  round(count(*) filter (where v is null) / count(*), 4) as null_share
from (select 'ema' as feature, 'ema' as feature_type, ema as v from f
      union all select 'ma', 'ma', ma from f
      union all select 'std', 'std', std from f) u
group by 1, 2""")
def q_feature_metadata(spark, sf_dir):
    return FE.feature_metadata(_decay(spark, sf_dir), {"ema": "ema", "ma": "ma", "std": "std"})


_EMA_PARAMS_SQL = """
cur as (select client_id, window_days, min_samples, nan_strategy from (
          select *, row_number() over (partition by client_id, feature_type
                                       order by created_at desc nulls first, id desc) as rn
          from feature_configs where is_active) c
        where rn = 1 and feature_type = 'ema'
          and window_days > 0 and window_days <= 365 and min_samples > 0
          and nan_strategy in ('decay', 'fill_zero', 'drop'))"""


@register("feat_ema_by_config", sql=with_views(f"""
with {_DAILY}, {_EMA_PARAMS_SQL.strip()},
s0 as (select d.client_id, d.ds, d.qty, coalesce(c.window_days, 90) as w, coalesce(c.min_samples, 7) as ms,
         coalesce(c.nan_strategy, 'decay') as strat
       from daily d left join cur c on c.client_id = d.client_id),
span as (select client_id, w, ms, strat, min(ds) as lo, max(ds) as hi from s0 where strat = 'fill_zero' group by 1, 2, 3, 4),
dense as (select client_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as ds, w, ms, strat from span),
s1 as (select d.client_id, d.ds, coalesce(x.qty, 0.0) as qty, x.qty is not null as o, d.w, d.ms, d.strat
       from dense d left join daily x on x.client_id = d.client_id and x.ds = d.ds
       union all select client_id, ds, qty, true, w, ms, strat from s0 where strat <> 'fill_zero'),
s as (select *, ds - date '1970-01-01' as dn,
        sum(case when o then 1 else 0 end) over (partition by client_id order by ds rows unbounded preceding) as rk
      from s1)
select a.client_id, a.ds, a.qty, a.w as window_days, a.ms as min_samples, a.strat as nan_strategy,
  count(*) filter (where b.o) as n_obs,
  case when count(*) filter (where b.o) >= a.ms then round(
    case when a.strat = 'drop'
         then sum(b.qty * pow(0.5, a.rk - b.rk)) / sum(pow(0.5, a.rk - b.rk))
         else sum(b.qty * pow(0.5, a.dn - b.dn)) / sum(pow(0.5, a.dn - b.dn)) end, 4) end as ema,
  case when count(*) filter (where b.o) >= a.ms then round(avg(b.qty), 4) end as ma
from s a join s b on a.client_id = b.client_id and b.dn > a.dn - a.w and b.dn <= a.dn
group by a.client_id, a.ds, a.qty, a.w, a.ms, a.strat""",
    "sales", "feature_configs"))
def q_feat_ema_by_config(spark, sf_dir):
    params = C.valid_ema_params(C.config_current(fx.feature_configs(spark, sf_dir)))
    return FE.per_key_rolling(_daily(spark, sf_dir), KEYS, params, rows=fx.sale_lines(spark, sf_dir).count()).drop("std")


_ALPHA_PARAMS_SQL = """
cur as (select client_id, window_days, min_samples, nan_strategy, alpha from (
          select *, case when id % 13 = 0 then null when id % 17 = 0 then 1.5::double else (id % 11)::double / 10.0 end as alpha,
            row_number() over (partition by client_id, feature_type order by created_at desc nulls first, id desc) as rn
          from feature_configs where is_active) c
        where rn = 1 and feature_type = 'ema' and window_days > 0 and window_days <= 365 and min_samples > 0
          and nan_strategy in ('decay', 'fill_zero', 'drop') and coalesce(alpha between 0 and 1, true))"""


@register("feat_alpha_by_config", sql=with_views(f"""
with {_DAILY}, {_ALPHA_PARAMS_SQL.strip()},
s0 as (select d.client_id, d.ds, d.qty, coalesce(c.window_days, 90) as w, coalesce(c.min_samples, 7) as ms,
         coalesce(c.nan_strategy, 'decay') as strat, coalesce(c.alpha, 0.5) as al
       from daily d left join cur c on c.client_id = d.client_id),
span as (select client_id, w, ms, strat, al, min(ds) as lo, max(ds) as hi from s0 where strat = 'fill_zero' group by 1, 2, 3, 4, 5),
dense as (select client_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as ds, w, ms, strat, al from span),
s1 as (select d.client_id, d.ds, coalesce(x.qty, 0.0) as qty, x.qty is not null as o, d.w, d.ms, d.strat, d.al
       from dense d left join daily x on x.client_id = d.client_id and x.ds = d.ds
       union all select client_id, ds, qty, true, w, ms, strat, al from s0 where strat <> 'fill_zero'),
s as (select *, ds - date '1970-01-01' as dn,
        sum(case when o then 1 else 0 end) over (partition by client_id order by ds rows unbounded preceding) as rk
      from s1)
select a.client_id, a.ds, a.qty, a.w as window_days, a.ms as min_samples, a.strat as nan_strategy, a.al as alpha,
  count(*) filter (where b.o) as n_obs,
  case when count(*) filter (where b.o) >= a.ms then round(
    case when a.strat = 'drop'
         then sum(b.qty * pow(1 - a.al, a.rk - b.rk)) / sum(pow(1 - a.al, a.rk - b.rk))
         else sum(b.qty * pow(1 - a.al, a.dn - b.dn)) / sum(pow(1 - a.al, a.dn - b.dn)) end, 4) end as ema,
  case when count(*) filter (where b.o) >= a.ms then round(avg(b.qty), 4) end as ma,
  case when count(*) filter (where b.o) >= a.ms then round(stddev_samp(b.qty), 4) end as std
from s a join s b on a.client_id = b.client_id and b.dn > a.dn - a.w and b.dn <= a.dn
group by a.client_id, a.ds, a.qty, a.w, a.ms, a.strat, a.al""",
    "sales", "feature_configs"))
def q_feat_alpha_by_config(spark, sf_dir):
    """Every client's own window, samples, strategy and alpha (E12), with STD."""
    configs = fx.feature_configs(spark, sf_dir).withColumn("alpha", fx.config_alpha())
    params = C.valid_ema_params(C.config_current(configs))
    return FE.per_key_rolling(_daily(spark, sf_dir), KEYS, params, rows=fx.sale_lines(spark, sf_dir).count())
