"""Invariants of the feature and BOM jobs on small hand-made inputs."""

import datetime as dt

from pyspark.sql import functions as F

from tidemill.operators import bom as B
from tidemill.operators import features as FE

D0 = dt.date(2024, 1, 1)


def daily(spark, vals, key=1, gaps=()):
    rows = [(key, D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(vals) if i not in gaps]
    return spark.createDataFrame(rows, "client_id long, ds date, qty double")


def test_ma_with_one_day_window_is_the_value(spark):
    out = FE.rolling_features(daily(spark, [3, 1, 4, 1, 5]), ["client_id"], window_days=1, min_samples=1)
    assert [r.ma for r in out.orderBy("ds").collect()] == [3.0, 1.0, 4.0, 1.0, 5.0]


def test_fill_zero_equals_decay_without_gaps(spark):
    d = daily(spark, [3, 1, 4, 1, 5, 9, 2, 6])
    a = FE.rolling_features(d, ["client_id"], 4, 0.5, 2, "decay").orderBy("ds").collect()
    b = FE.rolling_features(d, ["client_id"], 4, 0.5, 2, "fill_zero").orderBy("ds").collect()
    assert a == b


def test_decay_vs_drop_on_a_gap(spark):
    d = daily(spark, [2, 4], gaps=()).union(
        spark.createDataFrame([(1, D0 + dt.timedelta(days=3), 8.0)], "client_id long, ds date, qty double"))
    dec = {r.ds: r.ema for r in FE.rolling_features(d, ["client_id"], 10, 0.5, 1, "decay").collect()}
    drp = {r.ds: r.ema for r in FE.rolling_features(d, ["client_id"], 10, 0.5, 1, "drop").collect()}
    t = D0 + dt.timedelta(days=3)
    # decay: weights by calendar distance 3, 2, 0; drop: by observation rank 2, 1, 0
    assert dec[t] == round((2 * .125 + 4 * .25 + 8) / (.125 + .25 + 1), 4)
    assert drp[t] == round((2 * .25 + 4 * .5 + 8) / (.25 + .5 + 1), 4)


def test_fill_zero_densifies_and_counts_real_observations(spark):
    d = daily(spark, [2, 0, 0, 6], gaps=(1, 2))
    out = FE.rolling_features(d, ["client_id"], 3, 0.5, 1, "fill_zero").orderBy("ds").collect()
    assert [r.qty for r in out] == [2.0, 0.0, 0.0, 6.0]
    assert [r.n_obs for r in out] == [1, 1, 1, 1]
    assert out[3].ma == 2.0


def test_min_samples_gate(spark):
    out = FE.rolling_features(daily(spark, [1, 2, 3]), ["client_id"], 90, 0.5, 3).orderBy("ds").collect()
    assert [r.ema is None for r in out] == [True, True, False]


def edges(spark, rows):
    return spark.createDataFrame([(p, c, float(q), "s") for p, c, q in rows],
                                 "parent long, component long, qty double, produced_at string")


def test_bom_one_level_is_the_edge_list(spark):
    e = edges(spark, [(1, 2, 3), (1, 3, 1), (2, 3, 2)])
    got = sorted((r.root, r.component, r.qty, r.paths) for r in B.bom_explode(e, 1, include_produced_at=False).collect())
    assert got == [(1, 2, 3, 1), (1, 3, 1, 1), (2, 3, 2, 1)]


def test_bom_sums_over_paths(spark):
    e = edges(spark, [(1, 2, 3), (1, 3, 1), (2, 3, 2), (3, 4, 5)])
    got = {(r.root, r.component): (r.qty, r.paths, r.min_level, r.max_level) for r in B.bom_explode(e, 5, include_produced_at=False).collect()}
    assert got[(1, 3)] == (1 + 3 * 2, 2, 1, 2)
    assert got[(1, 4)] == ((1 + 6) * 5, 2, 2, 3)


def test_bom_cycle_terminates_and_is_reported(spark):
    e = edges(spark, [(1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 4, 2), (5, 5, 1)])
    ex = {(r.root, r.component): r.paths for r in B.bom_explode(e, 10, include_produced_at=False).collect()}
    assert ex[(1, 4)] == 1 and (1, 1) not in ex
    cyc = sorted((r.root, r.parent, r.component) for r in B.bom_cycles(e, 10).collect())
    assert (1, 3, 1) in cyc and (5, 5, 5) in cyc and (2, 1, 2) in cyc


def test_dag_needs_no_path_tracking(spark):
    e = edges(spark, [(1, 2, 1), (2, 3, 1), (1, 3, 1)])
    _, blocked, frontier = B.explode_levels(e, 5)
    assert blocked == [] and "cpath" not in frontier.columns
    assert B.bom_cycles(e, 5).count() == 0


def test_truncation_flag(spark):
    e = edges(spark, [(1, 2, 1), (2, 3, 1), (3, 4, 1)])
    got = sorted((r.root, r.component) for r in B.bom_truncated(e, 2).collect())
    assert got == [(1, 3)]


def test_bom_keeps_fractions_and_large_quantities(spark):
    e = edges(spark, [(1, 2, 0.25), (2, 3, 1.5), (10, 11, 1e6), (11, 12, 1e6), (12, 13, 1e6), (13, 14, 1e6)])
    got = {(r.root, r.component): r.qty for r in B.bom_explode(e, 5).collect()}
    assert got[(1, 3)] == 0.375 and got[(10, 14)] == 1e24


def test_bom_sites_are_kept_by_default(spark):
    e = spark.createDataFrame([(1, 2, 1.0, "a"), (1, 2, 2.0, "b"), (2, 3, 1.0, "a")],
                              "parent long, component long, qty double, produced_at string")
    got = sorted((r.component, r.produced_at, r.qty) for r in B.bom_explode(e, 5).filter("root = 1").collect())
    assert got == [(2, "a", 1.0), (2, "b", 2.0), (3, "a", 3.0)]


def test_fill_zero_events_equal_dense_frames(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for key in range(6):
        day = 0
        for _ in range(rnd.randint(1, 25)):
            day += rnd.choice([1, 1, 2, 3, 5, 9, 20])
            rows.append((key, D0 + dt.timedelta(days=day), float(rnd.randint(-3, 40))))
    d = spark.createDataFrame(rows, "client_id long, ds date, qty double")
    for window, alpha, mins in [(1, 0.5, 1), (3, 0.3, 1), (7, 0.5, 2), (10, 1.0, 1), (5, 0.0, 1), (30, 0.9, 3)]:
        a = FE.rolling_features(d, ["client_id"], window, alpha, mins, "fill_zero").collect()
        b = FE.rolling_features(d, ["client_id"], window, alpha, mins, "fill_zero", dense_frames=True).collect()
        ka = {(r.client_id, r.ds): r for r in a}
        kb = {(r.client_id, r.ds): r for r in b}
        assert ka.keys() == kb.keys(), (window, alpha)
        for k in ka:
            x, y = ka[k], kb[k]
            assert (x.qty, x.n_obs) == (y.qty, y.n_obs), (window, alpha, k)
            for f in ("ema", "ma", "std"):
                u, v = getattr(x, f), getattr(y, f)
                assert (u is None) == (v is None) and (u is None or abs(u - v) <= 2e-4), (window, alpha, k, f, u, v)


def test_per_key_rolling_equals_single_key_runs(spark):
    import random
    rnd = random.Random(11)
    rows, params = [], []
    settings = [(1, 1, "decay", 0.5), (3, 2, "drop", 0.1), (7, 1, "fill_zero", 1.0), (30, 3, "decay", 0.99), (365, 2, "fill_zero", 0.25),
                (5, 1, "drop", 1.0), (40, 1, "fill_zero", 0.0), (200, 1, "decay", 0.0), (300, 1, "decay", None)]
    for key, (window, mins, strat, alpha) in enumerate(settings):
        params.append((key, window, mins, strat, alpha))
        day = 0
        for _ in range(rnd.randint(3, 30)):
            day += rnd.choice([1, 1, 2, 4, 8, 40])
            rows.append((key, D0 + dt.timedelta(days=day), float(rnd.randint(0, 30))))
    d = spark.createDataFrame(rows, "client_id long, ds date, qty double")
    p = spark.createDataFrame(params, "client_id long, window_days int, min_samples int, nan_strategy string, alpha double")
    got = {(r.client_id, r.ds): r for r in FE.per_key_rolling(d, ["client_id"], p).collect()}
    for key, (window, mins, strat, alpha) in enumerate(settings):
        one = FE.rolling_features(d.filter(F.col("client_id") == key), ["client_id"], window, 0.5 if alpha is None else alpha, mins, strat)
        for r in one.collect():
            g = got.pop((r.client_id, r.ds))
            assert (g.qty, g.n_obs) == (r.qty, r.n_obs), (key, r.ds)
            for f in ("ema", "ma", "std"):
                u, v = getattr(g, f), getattr(r, f)
                assert (u is None) == (v is None) and (u is None or abs(u - v) <= 2e-4), (key, r.ds, f, u, v)
    assert not got
