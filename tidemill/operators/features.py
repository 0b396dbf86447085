"""Demand features over daily series: EMA, MA, STD, lags, seasonality, weather, promo.

Layout of every job:

1. ``daily_demand`` pre-aggregates the facts to one row per key and day
   (hash aggregation with map-side combine, so a hot client is collapsed
   before the shuffle).
2. Rolling features are range windows over the day number, partitioned by
   the series key. One key holds at most one row per calendar day, so a
   window partition is bounded by the calendar span, not by fact volume.
3. Dimensions that are bounded by the calendar (weather, holidays) are
   broadcast; the promo calendar grows with products and is a shuffle join.

Definitions (fixed for the reference's documented-only features): with
``r = 1 - alpha`` and ``O`` the observed days in ``[t-W+1, t]``

* decay:     EMA_t = sum(x_i r^(t-i)) / sum(r^(t-i)) over O
* drop:      same with t-i replaced by the difference of observation ranks
* fill_zero: missing days between the key's first and last day are 0 and
             are rows of their own; MA/STD/EMA use the dense series
* MA = mean, STD = sample stddev; fewer than ``min_samples`` real
  observations in the frame -> null (all three).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import partitions_for

# Documented defaults of the feature configuration.
DEFAULT_WINDOW_DAYS = 90
DEFAULT_ALPHA = 0.5
DEFAULT_MIN_SAMPLES = 7
NAN_STRATEGIES = ("decay", "fill_zero", "drop")
MAX_WINDOW_DAYS = 365
# Our choice of lags (the reference lists none).
DEFAULT_LAGS = (1, 7, 14, 28)

ROUND = 4


def daily_demand(facts: DataFrame, keys: Sequence[str], ts_col: str = "ds",
                 qty_col: str = "qty") -> DataFrame:
    """``sum(qty)`` per key and calendar day."""
    return (facts.groupBy(*[F.col(k) for k in keys], F.to_date(ts_col).alias("ds"))
                 .agg(F.sum(qty_col).alias("qty")))


#: Rows of a series that one task's windows hold, about.
DAYS_PER_TASK = 100_000


def spread_by_key(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Hash-partition by the series key into ``spark.sql.shuffle.partitions`` parts, or more of
    ``DAYS_PER_TASK`` rows each if ``rows`` (about how many there are) asks for them.

    The window needs this exchange anyway; giving it an explicit number keeps
    AQE from merging the stage into a few partitions by byte size (window
    work is per row and per frame item, not per byte: merged, a few tasks do
    all of it).
    """
    return df.repartition(partitions_for(df.sparkSession, rows or 0, DAYS_PER_TASK), *keys)


def _day(col: str = "ds") -> Column:
    return F.unix_date(F.col(col))


def _dense(daily: DataFrame, keys: Sequence[str], fill: Column | None = None) -> DataFrame:
    """Every day from each key's first to its last observed day; ``obs`` is null on filled days.

    Each observed row emits itself and the empty days up to the next
    observation (``lead`` + ``explode``): no join, and the key partitioning of
    the input carries over to the rolling window. With ``fill`` only rows where
    it holds get filler days; other columns of ``daily`` are carried along.
    """
    w = Window.partitionBy(*keys).orderBy("ds")
    with_next = daily.withColumn("_next", F.lead("ds").over(w))
    last = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("ds"))
    if fill is not None:
        last = F.when(fill, last).otherwise(F.col("ds"))
    carried = [c for c in daily.columns if c not in (*keys, "ds", "qty")]
    gaps = with_next.select(*keys, "ds", "qty", *carried, F.explode(F.sequence(F.col("ds"), last)).alias("_day"))
    real = F.col("_day") == F.col("ds")
    return gaps.select(*keys, F.col("_day").alias("ds"),
                       F.when(real, F.col("qty")).otherwise(F.lit(0.0)).alias("qty"),
                       F.when(real, F.col("qty")).alias("obs"), *carried)


def _rebase_plan(alpha: float, window_days: int) -> tuple[float, int, int]:
    """(r, E, M) for the rebased EMA sums.

    EMA is a ratio, so the common factor ``r^(t - E*e_t)`` cancels: each item
    is weighted ``r^(E*e_i - pos_i)`` relative to the start of its own epoch of
    ``E`` positions (at most ``r^-(E-1)`` <= 1e250, so nothing overflows) and
    items of ``M`` consecutive epochs are kept in separate sums, rescaled by
    ``r^(E*k)`` for the ``k``-th previous epoch. ``M`` covers the frame.
    """
    r = 1.0 - alpha
    if r <= 0.0 or r >= 1.0:
        return r, 1, 1
    epoch = max(1, int(250.0 / -math.log10(r)))
    return r, epoch, math.ceil(window_days / epoch) + 1


def _rebased_ema(pos: Column, value: Column, weight: Column, w: Window, alpha: float,
                 window_days: int) -> tuple[list[Column], Column]:
    """Window sums (over ``w``) and the expression that turns them into the EMA.

    Returns ``(sum_columns, ema)``: the sums must be selected (they are window
    expressions); ``ema`` refers to them by name. ``weight`` is 1 for items in
    the denominator (0 otherwise); ``pos`` is the day or the observation rank.
    """
    r, epoch, classes = _rebase_plan(alpha, window_days)
    if r <= 0.0:                        # alpha = 1: only the current item has weight
        return [], value
    if r >= 1.0:                        # alpha = 0: plain mean of the frame
        sums = [F.sum(value).over(w).alias("_n0"), F.sum(weight).over(w).alias("_d0")]
        return sums, F.col("_n0") / F.col("_d0")
    e = F.floor(pos / F.lit(epoch))
    own = F.pow(F.lit(r), F.lit(epoch) * e - pos)
    cls = F.pmod(e, F.lit(classes))
    sums, num, den = [], F.lit(0.0), F.lit(0.0)
    for c in range(classes):
        sel = cls == c
        sums.append(F.sum(F.when(sel, value * own)).over(w).alias(f"_n{c}"))
        sums.append(F.sum(F.when(sel, weight * own)).over(w).alias(f"_d{c}"))
        back = F.pmod(F.col("_e") - F.lit(c), F.lit(classes))          # epochs back to class c
        scale = F.pow(F.lit(r), F.lit(epoch) * back)
        num = num + F.coalesce(F.col(f"_n{c}"), F.lit(0.0)) * scale
        den = den + F.coalesce(F.col(f"_d{c}"), F.lit(0.0)) * scale
    return [e.alias("_e"), *sums], F.try_divide(num, den)


def _fill_zero_features(base: DataFrame, keys: Sequence[str], window_days: int, alpha: float,
                        min_samples: int) -> DataFrame:
    """``fill_zero`` features without a frame per dense day.

    Between two events (a day entering the window, or leaving it ``W`` days
    later) the observed items in a dense day's window do not change, so only
    event rows get window frames. For a dense day ``t`` after event ``e``
    (``m`` = dense days in the frame, ``n`` observed items in it):

    * n_obs = n, MA = sum / m;
    * STD from the observed items' mean and M2 joined with ``m - n`` zeros
      (parallel-variance formula, all terms non-negative);
    * EMA = r^(t-e) * numerator(e) / ((1 - r^m) / (1 - r)).

    ``base`` is the key-partitioned daily series (``keys, ds, qty``).
    """
    r, epoch, _ = _rebase_plan(alpha, window_days)
    first = F.min("ds").over(Window.partitionBy(*keys))
    last = F.max("ds").over(Window.partitionBy(*keys))
    obs = base.select(*keys, "ds", "qty", first.alias("_first"), last.alias("_last"))
    # every observation is an event on its day and an exit event W days later (inside the span)
    ev = obs.select(*keys, "_first", "_last", F.explode(F.array(
        F.struct(F.col("ds").alias("day"), F.col("qty").alias("q")),
        F.struct(F.date_add("ds", window_days).alias("day"), F.lit(None).cast("double").alias("q")),
    )).alias("e")).select(*keys, "_first", "_last", "e.day", "e.q").filter(F.col("day") <= F.col("_last"))
    ev = ev.withColumn("_d", F.unix_date("day")).withColumn("_pos", F.col("_d").cast("double"))
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(-(window_days - 1), 0)
    sums, ema_ratio = _rebased_ema(F.col("_pos"), F.col("q"), F.col("q").isNotNull().cast("double"), w,
                                   alpha, window_days)
    agg = ev.select(
        *keys, "_first", "_last", "day", "q", "_d", *sums,
        F.count("q").over(w).alias("_n"), F.sum("q").over(w).alias("_s"),
        F.avg("q").over(w).alias("_mean"), F.var_pop("q").over(w).alias("_vp"),
    )
    # numerator of day e in absolute terms: the class sums are relative to the start of e's epoch
    if 0.0 < r < 1.0:
        num_e = F.lit(0.0)
        classes = len(sums) // 2
        for c in range(classes):
            back = F.pmod(F.col("_e") - F.lit(c), F.lit(classes))
            num_e = num_e + F.coalesce(F.col(f"_n{c}"), F.lit(0.0)) * F.pow(F.lit(r), F.lit(epoch) * back)
        num_e = num_e * F.pow(F.lit(r), F.col("_d") - F.lit(epoch) * F.col("_e"))
    elif r >= 1.0:
        num_e = F.coalesce(F.col("_n0"), F.lit(0.0))
    else:
        num_e = F.coalesce(F.col("q"), F.lit(0.0))
    # one row per event day (an exit may fall on an observation day): keep the observation
    dedup = Window.partitionBy(*keys, "day").orderBy(F.col("q").isNull())
    agg = (agg.withColumn("_num", num_e)
              .withColumn("_k", F.row_number().over(dedup)).filter(F.col("_k") == 1))
    nxt = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    spans = agg.withColumn("_next", nxt)
    upto = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("day"))
    dense = spans.select("*", F.explode(F.sequence(F.col("day"), upto)).alias("ds"))
    gap = F.datediff(F.col("ds"), F.col("day"))
    m = F.least(F.lit(window_days), F.datediff(F.col("ds"), F.col("_first")) + 1).cast("double")
    n = F.col("_n").cast("double")
    is_obs = (gap == 0) & F.col("q").isNotNull()
    mean = F.coalesce(F.col("_mean"), F.lit(0.0))
    m2 = F.coalesce(F.col("_vp"), F.lit(0.0)) * n + mean * mean * n * (m - n) / m
    if 0.0 < r < 1.0:
        den = (F.lit(1.0) - F.pow(F.lit(r), m)) / F.lit(1.0 - r)
        ema = F.col("_num") * F.pow(F.lit(r), gap) / den
    elif r >= 1.0:
        ema = F.col("_num") / m
    else:
        ema = F.when(is_obs, F.col("q")).otherwise(F.lit(0.0))
    ok = F.col("_n") >= F.lit(min_samples)
    return dense.select(
        *keys, "ds", F.when(is_obs, F.col("q")).otherwise(F.lit(0.0)).alias("qty"),
        F.col("_n").alias("n_obs"),
        F.when(ok, F.round(ema, ROUND)).alias("ema"),
        F.when(ok, F.round(F.coalesce(F.col("_s"), F.lit(0.0)) / m, ROUND)).alias("ma"),
        F.when(ok & (m > 1), F.round(F.sqrt(F.greatest(m2, F.lit(0.0)) / (m - 1)), ROUND)).alias("std"),
    )


def rolling_features(daily: DataFrame, keys: Sequence[str],
                     window_days: int = DEFAULT_WINDOW_DAYS, alpha: float = DEFAULT_ALPHA,
                     min_samples: int = DEFAULT_MIN_SAMPLES, nan_strategy: str = "decay",
                     dense_frames: bool = False) -> DataFrame:
    """EMA, MA and STD with the ``min_samples`` gate.

    ``fill_zero`` is computed from event rows (``_fill_zero_features``);
    ``dense_frames=True`` computes it over explicit filler rows instead (the
    slower reference the tests compare against).

    Returns ``keys, ds, qty, n_obs, ema, ma, std``; ``qty`` is 0.0 on days
    filled by ``fill_zero``. All features are aggregates over one range frame
    ``[t - W + 1, t]`` of one window operator (partitioned by the series key,
    ordered by day); the EMA is a handful of rebased sums, not an array per row.
    """
    if nan_strategy not in NAN_STRATEGIES:
        raise ValueError(f"nan_strategy must be one of {NAN_STRATEGIES}")
    if not 0 < window_days <= MAX_WINDOW_DAYS:
        raise ValueError("window_days must be in 1..365")
    if min_samples <= 0:
        raise ValueError("min_samples must be > 0")
    if not 0.0 <= alpha <= 1.0:
        raise ValueError("alpha must be in [0, 1]")
    base = spread_by_key(daily.select(*keys, "ds", F.col("qty").cast("double").alias("qty")), keys)
    if nan_strategy == "fill_zero" and not dense_frames:
        return _fill_zero_features(base, keys, window_days, alpha, min_samples)
    if nan_strategy == "fill_zero":
        series = _dense(base, keys)
    else:
        series = base.withColumn("obs", F.col("qty"))
    series = series.withColumn("_d", _day())
    order_w = Window.partitionBy(*keys).orderBy("_d")
    if nan_strategy == "drop":
        series = series.withColumn("_pos", F.row_number().over(order_w).cast("double"))
    else:
        series = series.withColumn("_pos", F.col("_d").cast("double"))
    w = order_w.rangeBetween(-(window_days - 1), 0)
    # decay/drop weigh observed days only; fill_zero weighs every dense day
    sums, ema = _rebased_ema(F.col("_pos"), F.col("qty"), F.lit(1.0), w, alpha, window_days)
    if nan_strategy != "fill_zero" and alpha >= 1.0:
        ema = F.col("qty")
    feats = series.select(
        *keys, "ds", F.col("qty"), "_pos", *sums,
        F.count("obs").over(w).alias("n_obs"),
        F.avg("qty").over(w).alias("_ma"),
        F.stddev_samp("qty").over(w).alias("_std"),
    )
    ok = F.col("n_obs") >= F.lit(min_samples)
    return feats.select(
        *keys, "ds", "qty", "n_obs",
        F.when(ok, F.round(ema, ROUND)).alias("ema"),
        F.when(ok, F.round("_ma", ROUND)).alias("ma"),
        F.when(ok, F.round("_std", ROUND)).alias("std"),
    )


def lag_features(daily: DataFrame, keys: Sequence[str], lags: Sequence[int] = DEFAULT_LAGS) -> DataFrame:
    """Calendar lags ``lag_k`` (value k days earlier, null if that day has no data)
    and observation lag ``obs_lag_1`` (previous observed value) (E9)."""
    series = spread_by_key(daily, keys).withColumn("_d", _day())
    base = Window.partitionBy(*keys).orderBy("_d")
    cols = [F.max("qty").over(base.rangeBetween(-k, -k)).alias(f"lag_{k}") for k in lags]
    return series.select(*keys, "ds", "qty", *cols, F.lag("qty", 1).over(base).alias("obs_lag_1"))


# ``day / W`` orders each key's rows so that every key's W-day window is the same frame:
# day gaps of W-1 or less give at most 1 - 1/365, a gap of W gives exactly 1.
_UNIT_FRAME = "range between 0.998630137 preceding and current row"


def per_key_rolling(daily: DataFrame, keys: Sequence[str], params: DataFrame, alpha: float = DEFAULT_ALPHA,
                    default_window: int = DEFAULT_WINDOW_DAYS,
                    default_min_samples: int = DEFAULT_MIN_SAMPLES, rows: int | None = None) -> DataFrame:
    """EMA/MA/STD/count with per-key ``window_days`` / ``min_samples`` / ``nan_strategy`` / ``alpha``.

    ``params`` has ``keys, window_days, min_samples, nan_strategy`` and maybe ``alpha`` in [0, 1] (one row
    per key, already validated; keys without parameters, or without an alpha, use the defaults and
    ``decay``). A window spec needs a literal frame, but the window length is
    constant within a key: ordering each key's rows by ``day / W`` maps every
    key's W-day window onto the same frame. The EMA uses the rebased sums of
    ``rolling_features`` on a per-key weight axis (day, or observation rank for
    ``drop``); ``fill_zero`` keys get exit events and dense days as in
    ``_fill_zero_features``. The length of an epoch follows from the key's alpha; the number of sums kept
    apart is that of the largest alpha below 1, found by one aggregate over ``params``. Alpha 1 leaves the
    day's own value, alpha 0 the mean. STD comes from the frame's centred second moment, joined with the
    empty days' zeros for ``fill_zero``. ``rows`` (about as many as ``daily`` has) sets the number of tasks.
    """
    if not 0.0 <= alpha <= 1.0:
        raise ValueError("alpha must be in [0, 1]")
    own_alpha = "alpha" in params.columns
    largest = alpha if alpha < 1.0 else 0.0
    if own_alpha:
        largest = max(largest, params.agg(F.max(F.when(F.col("alpha") < 1.0, F.col("alpha")))).first()[0] or 0.0)
    _, _, classes = _rebase_plan(largest, MAX_WINDOW_DAYS)
    p = params.select(*keys, "window_days", "min_samples", "nan_strategy",
                      (F.col("alpha") if own_alpha else F.lit(None)).cast("double").alias("alpha"))
    joined = (daily.select(*keys, "ds", F.col("qty").cast("double").alias("qty"))
                   .join(p, list(keys), "left"))
    strat = F.coalesce(F.col("nan_strategy"), F.lit("decay"))
    base = spread_by_key(joined.select(
        *keys, "ds", "qty",
        F.coalesce(F.col("window_days"), F.lit(default_window)).alias("window_days"),
        F.coalesce(F.col("min_samples"), F.lit(default_min_samples)).alias("min_samples"),
        F.when(strat.isin(*NAN_STRATEGIES), strat).otherwise(F.lit("decay")).alias("nan_strategy"),
        F.coalesce(F.col("alpha"), F.lit(alpha)).alias("alpha")), keys, rows)
    whole = Window.partitionBy(*keys)
    obs = base.select("*", F.min("ds").over(whole).alias("_first"), F.max("ds").over(whole).alias("_last"),
                      F.row_number().over(Window.partitionBy(*keys).orderBy("ds")).alias("_rk"))
    fz = F.col("nan_strategy") == "fill_zero"
    carried = [*keys, "window_days", "min_samples", "nan_strategy", "alpha", "_first", "_last"]
    ev = (obs.select(*carried, F.explode(F.array(
              F.struct(F.col("ds").alias("day"), F.col("qty").alias("q"), F.col("_rk").alias("rk")),
              F.struct(F.date_add("ds", F.col("window_days")).alias("day"), F.lit(None).cast("double").alias("q"),
                       F.lit(None).cast("int").alias("rk")))).alias("e"))
             .select(*carried, "e.day", "e.q", "e.rk")
             .filter(F.col("q").isNotNull() | (fz & (F.col("day") <= F.col("_last")))))
    d = F.unix_date("day")
    wp = F.when(F.col("nan_strategy") == "drop", F.col("rk")).otherwise(d).cast("double")
    # alpha 0 weighs all alike and alpha 1 the day alone: the sums of the latter are not used
    r = F.when(F.col("alpha") < 1.0, F.lit(1.0) - F.col("alpha")).otherwise(F.lit(1.0))
    epoch = F.when(r < 1.0, F.greatest(F.lit(1.0), F.floor(F.lit(250.0) / -F.log10(r)).cast("double"))).otherwise(F.lit(1e9))
    ev = ev.select("*", d.alias("_d"), wp.alias("_wp"), r.alias("_r"), epoch.alias("_epoch"))
    r, epoch = F.col("_r"), F.col("_epoch")
    e = F.floor(F.col("_wp") / epoch)
    own = F.pow(r, epoch * e - F.col("_wp"))
    cls = F.pmod(e, F.lit(classes))
    ev = ev.select("*", e.alias("_e"),
                   (F.col("_d").cast("decimal(20,0)") / F.col("window_days")).cast("decimal(30,12)").alias("_pos"),
                   *[F.when(cls == c, F.col("q") * own).alias(f"_a{c}") for c in range(classes)],
                   *[F.when((cls == c) & F.col("q").isNotNull(), own).alias(f"_b{c}") for c in range(classes)])
    over = "over (partition by " + ", ".join(f"`{k}`" for k in keys) + f" order by _pos {_UNIT_FRAME})"
    agg = ev.select(
        "*", F.expr(f"count(q) {over}").alias("_n"), F.expr(f"sum(q) {over}").alias("_s"),
        F.expr(f"avg(q) {over}").alias("_mean"), F.expr(f"var_pop(q) {over}").alias("_vp"),
        *[F.expr(f"sum(_a{c}) {over}").alias(f"_S{c}") for c in range(classes)],
        *[F.expr(f"sum(_b{c}) {over}").alias(f"_D{c}") for c in range(classes)],
    )
    num, den = F.lit(0.0), F.lit(0.0)
    for c in range(classes):
        scale = F.pow(r, epoch * F.pmod(F.col("_e") - F.lit(c), F.lit(classes)))
        num = num + F.coalesce(F.col(f"_S{c}"), F.lit(0.0)) * scale
        den = den + F.coalesce(F.col(f"_D{c}"), F.lit(0.0)) * scale
    agg = agg.withColumn("_ratio", F.try_divide(num, den)) \
             .withColumn("_num", num * F.pow(r, F.col("_wp") - epoch * F.col("_e")))
    dedup = Window.partitionBy(*keys, "day").orderBy(F.col("q").isNull())
    agg = agg.withColumn("_k", F.row_number().over(dedup)).filter(F.col("_k") == 1)
    nxt = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    spans = agg.withColumn("_next", nxt)
    upto = F.when(fz, F.coalesce(F.date_sub(F.col("_next"), 1), F.col("day"))).otherwise(F.col("day"))
    dense = spans.select("*", F.explode(F.sequence(F.col("day"), upto)).alias("ds"))
    gap = F.datediff(F.col("ds"), F.col("day"))
    m = F.least(F.col("window_days"), F.datediff(F.col("ds"), F.col("_first")) + 1).cast("double")
    is_obs = (gap == 0) & F.col("q").isNotNull()
    weights = F.when(r < 1.0, (F.lit(1.0) - F.pow(r, m)) / (F.lit(1.0) - r)).otherwise(m)
    ema = (F.when(F.col("alpha") >= 1.0, F.when(is_obs, F.col("q")).otherwise(F.lit(0.0)))
            .when(fz, F.col("_num") * F.pow(r, gap) / weights).otherwise(F.col("_ratio")))
    n = F.col("_n").cast("double")
    items = F.when(fz, m).otherwise(n)                     # days in the frame, empty ones with fill_zero
    mean = F.coalesce(F.col("_mean"), F.lit(0.0))
    m2 = F.coalesce(F.col("_vp"), F.lit(0.0)) * n + F.when(fz, mean * mean * n * (m - n) / m).otherwise(F.lit(0.0))
    ma = F.when(fz, F.coalesce(F.col("_s"), F.lit(0.0)) / m).otherwise(F.col("_mean"))
    ok = F.col("_n") >= F.col("min_samples")
    return dense.select(
        *keys, "ds", F.when(is_obs, F.col("q")).otherwise(F.lit(0.0)).alias("qty"),
        "window_days", "min_samples", "nan_strategy", *(["alpha"] if own_alpha else []), F.col("_n").alias("n_obs"),
        F.when(ok, F.round(ema, ROUND)).alias("ema"),
        F.when(ok, F.round(ma, ROUND)).alias("ma"),
        F.when(ok & (items > 1), F.round(F.sqrt(F.greatest(m2, F.lit(0.0)) / (items - 1)), ROUND)).alias("std"),
    )


def seasonality(daily: DataFrame, holidays: DataFrame, include_day_of_week: bool = True,
                include_month: bool = True, include_holidays: bool = True) -> DataFrame:
    """Day of week (Monday=0), month, holiday flag; each switchable.

    The holiday dimension has at most one row per calendar day, so it is
    broadcast (its size is bounded by the calendar, not by the data).
    """
    out = daily
    if include_day_of_week:
        out = out.withColumn("day_of_week", F.weekday("ds"))
    if include_month:
        out = out.withColumn("month", F.month("ds"))
    if include_holidays:
        h = holidays.select("ds", F.lit(True).alias("_h")).distinct()
        out = (out.join(F.broadcast(h), "ds", "left")
                  .withColumn("is_holiday", F.coalesce(F.col("_h"), F.lit(False)))
                  .drop("_h"))
    return out


def weather_features(daily: DataFrame, weather: DataFrame, site: str | None = None) -> DataFrame:
    """Attach temperature, precipitation and wind by date, or by date and ``site``.

    Repeated readings of one day (and site) count once: the largest row stays. By
    date alone the dimension is one row per calendar day and is broadcast; with
    sites it grows with them, and the join strategy is left to AQE.
    """
    keys = ["ds"] + ([site] if site else [])
    values = ["temperature", "precipitation", "wind"]
    w = weather.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_w")).select(*keys, *[F.col(f"_w.{v}") for v in values])
    return daily.join(w if site else F.broadcast(w), keys, "left")


def promo_days(promos: DataFrame) -> DataFrame:
    """Promo validity periods exploded to one row per (product, day) (no range join needed)."""
    return (promos.select("product_id", F.explode(F.sequence("start_ds", "end_ds")).alias("ds"))
                  .distinct())


def promo_features(daily: DataFrame, promos: DataFrame) -> DataFrame:
    """``on_promo`` for each (product, day) of the series (C7): an equi left join on days."""
    days = promo_days(promos).withColumn("_p", F.lit(True))
    return (daily.join(days, ["product_id", "ds"], "left")
                 .withColumn("on_promo", F.coalesce(F.col("_p"), F.lit(False)))
                 .drop("_p"))


def feature_metadata(features: DataFrame, feature_types: dict[str, str]) -> DataFrame:
    """One row per feature column: type, rows, nulls and null share.

    One aggregate counts all columns; only its single row is unpivoted.
    """
    counted = features.agg(F.count(F.lit(1)).alias("n_rows"),
                           *[F.count_if(F.col(n).isNull()).alias(f"null_{n}") for n in feature_types])
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(t).alias("feature_type"), F.col("n_rows"),
                              F.col(f"null_{n}").alias("n_null")) for n, t in feature_types.items()])
    return (counted.filter("n_rows > 0").select(F.inline(rows))
                   .withColumn("null_share", F.round(F.col("n_null") / F.col("n_rows"), ROUND)))


def result_events(features: DataFrame, feature_types: dict[str, str], key: str = "client_id") -> DataFrame:
    """``features_updated`` result event per client (A8): rows written, feature types and the
    JSON body of the event (``data``), ready to append to the result stream."""
    types = sorted(set(feature_types.values()))
    per = features.groupBy(key).agg(F.count(F.lit(1)).alias("features_count"), F.count("ema").alias("ema_rows"))
    body = F.to_json(F.struct(F.col(key), F.col("features_count"),
                              F.array(*[F.lit(t) for t in types]).alias("feature_types")))
    return per.select(key, F.lit("features_updated").alias("event_type"), "features_count",
                      F.lit(",".join(types)).alias("feature_types"), "ema_rows", body.alias("data"))
