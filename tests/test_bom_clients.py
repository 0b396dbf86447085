"""Explosion with per-client parameters and maintained explosions, against plain walks in Python."""

import os
import random
from collections import defaultdict

import pytest

from tidemill.operators import bom_clients as BC
from tidemill.operators import bom_delta as BD

EDGES = "parent long, component long, qty double, produced_at string"


def random_edges(rng, nodes, n, acyclic=False):
    out = []
    for _ in range(n):
        a, b = rng.randrange(nodes), rng.randrange(nodes)
        if acyclic:
            a, b = max(a, b) + 1, min(a, b)
        out.append((a, b, rng.choice([0.25, 0.5, 1.0, 2.0]), rng.choice(["x", "y"])))
    return out


def walks(edges, root, cap, checked, site=True):
    """component, site -> [qty, paths, min level, max level], path by path."""
    below = defaultdict(list)
    for a, b, q, s in edges:
        below[a].append((b, q, s))
    out = {}
    todo = [(root, (root,), 1.0, 0)]
    while todo:
        node, path, q, level = todo.pop()
        if level == cap:
            continue
        for b, f, s in below[node]:
            if checked and b in path:
                continue
            row = out.setdefault((b, s if site else None), [0.0, 0, level + 1, level + 1])
            row[0] += q * f
            row[1] += 1
            row[2], row[3] = min(row[2], level + 1), max(row[3], level + 1)
            todo.append((b, path + (b,), q * f, level + 1))
    return out


@pytest.mark.parametrize("acyclic", [True, False])
def test_profiles_equal_walks(spark, acyclic):
    rng = random.Random(5)
    edges = random_edges(rng, 9, 12, acyclic)
    if not acyclic:
        edges += [(3, 3, 1.0, "x"), (1, 2, 0.5, "y"), (2, 1, 0.5, "x"), edges[0]]
    needs = [(r, cap, site, check) for r in range(10) for cap, site, check in [(1, True, True), (4, False, True), (5, True, False), (6, True, True)]]
    got = {}
    df = spark.createDataFrame(needs + needs[:5], "root long, max_levels int, include_produced_at boolean, cycle_detection boolean")
    for r in BC.explode_profiles(spark.createDataFrame(edges, EDGES), df).collect():
        key = (r["root"], r["max_levels"], r["include_produced_at"], r["cycle_detection"], r["component"], r["produced_at"])
        assert key not in got
        got[key] = [r["qty"], r["paths"], r["min_level"], r["max_level"]]
    want = {(*need, *k): v for need in needs for k, v in walks(edges, need[0], need[1], need[3], need[2]).items()}
    assert got == want


def test_recurring_nodes(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (0, 1), (6, 6), (5, 7)]
    df = spark.createDataFrame([(a, b, 1.0, "x") for a, b in edges], EDGES)
    assert {r["node"] for r in BC.recurring_nodes(df).collect()} == {1, 2, 3, 6}
    assert BC.recurring_nodes(df.filter("parent not in (3, 6)")) is None
    assert BC.recurring_nodes(df.limit(0)) is None


def test_status_of_failed_empty_and_served_clients(spark):
    configs = spark.createDataFrame(
        [(1, 10, 2, None, True, True, "2024-01-01"), (2, 10, 99, True, True, False, "2024-02-01"), (3, 11, 0, True, True, True, "2024-01-01")],
        "id long, client_id long, max_levels int, include_produced_at boolean, cycle_detection boolean, is_active boolean, created_at string")
    clients = spark.createDataFrame([(10,), (11,), (12,), (13,)], "client_id long")
    profiles = BC.client_profiles(clients, configs)
    by = {r["client_id"]: tuple(r)[1:] for r in profiles.collect()}
    assert by == {10: (2, True, True, None), 11: (0, True, True, "max_levels_range"), 12: (5, True, True, None), 13: (5, True, True, None)}
    edges = spark.createDataFrame([(1, 2, 0.5, "x"), (2, 3, 2.0, "x"), (3, 4, 1.0, "x")], EDGES)
    sales = spark.createDataFrame([(10, 1, "2024-01-05", 4.0), (11, 1, "2024-01-05", 1.0), (12, 1, "2024-01-06", 1.0), (13, 9, "2024-01-06", 1.0)],
                                  "client_id long, product_id long, ds string, qty double")
    exploded = BC.explode_profiles(edges, BC.profiles_in_use(sales, profiles))
    demand = BC.demand_by_profile(sales, profiles, exploded)
    assert {(r["client_id"], r["component"], r["demand"]) for r in demand.collect()} == {(10, 2, 2.0), (10, 3, 4.0), (12, 2, 0.5), (12, 3, 1.0), (12, 4, 1.0)}
    status = BC.run_status(profiles, demand)
    assert {tuple(r) for r in status.collect()} == {
        (10, "2024-01-05", 2, "ok", None), (11, None, 0, "error", "max_levels_range"), (12, "2024-01-06", 3, "ok", None), (13, None, 0, "empty", None)}
    assert {r["client_id"] for r in BC.bom_exploded_events(status).collect()} == {10, 12, 13}


def stored(store):
    return {(r["root"], r["component"], r["produced_at"]): [r["qty"], r["paths"], r["min_level"], r["max_level"]] for r in store.read().collect()}


def data_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(os.path.join(path, "data")) for f in fs if f.endswith(".parquet")}


def test_store_follows_changes(spark, tmp_path):
    """Added, removed and corrected edges, cycles opened and closed; a run leaves other buckets' files alone."""
    rng = random.Random(9)
    edges = random_edges(rng, 14, 16)
    store = BD.BomStore(spark, str(tmp_path / "bom"), buckets=8, max_levels=4)
    store.create(spark.createDataFrame(edges, EDGES))
    for step in range(3):
        after = edges[2:] if step == 0 else edges + random_edges(rng, 14, 1) if step == 1 else [(a, b, q * 2 if k == 4 else q, s) for k, (a, b, q, s) in enumerate(edges)]
        before = data_files(store.table.path)
        roots = {r["root"] for r in store.apply(spark.createDataFrame(edges, EDGES), spark.createDataFrame(after, EDGES)).collect()}
        want = {r: walks(after, r, 4, True) for r in {e[0] for e in after}}
        assert stored(store) == {(r, *k): v for r, rows in want.items() for k, v in rows.items()}
        different = {r for r in {e[0] for e in edges + after} if walks(edges, r, 4, True) != walks(after, r, 4, True)}
        assert different <= roots
        assert before.items() <= data_files(store.table.path).items()
        edges = after
    last = store.table.manifest()
    same = spark.createDataFrame(edges, EDGES)
    assert store.apply(same, same).isEmpty() and store.table.manifest() == last
    store.apply(same, same.limit(0))
    assert stored(store) == {}


def test_untouched_roots_are_not_expanded(spark):
    edges = [(k, k + 1, 1.0, "x") for k in range(20)]
    changed = edges[:15] + [(15, 16, 3.0, "x")] + edges[16:]
    roots = BD.affected_roots(spark.createDataFrame(edges, EDGES), spark.createDataFrame(changed, EDGES), 4)
    assert {r["root"] for r in roots.collect()} == {12, 13, 14, 15}


def test_rows_of_profiles_are_not_moved(spark):
    """What a root reaches is shuffled once; neither its profiles' rows nor sales are multiplied before a shuffle."""
    edges = spark.createDataFrame([(3, 2, 1.0, "x"), (2, 1, 1.0, "y"), (1, 3, 1.0, "x")], EDGES)
    needs = spark.createDataFrame([(3, cap, True, check) for cap in (1, 5) for check in (True, False)],
                                  "root long, max_levels int, include_produced_at boolean, cycle_detection boolean")
    rows = BC.explode_profiles(edges, needs)
    moves = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert moves and not any("max_levels" in line for line in moves)
    profiles = spark.createDataFrame([(7, 5, True, True, None)], "client_id long, max_levels int, include_produced_at boolean, cycle_detection boolean, error_message string")
    sales = spark.createDataFrame([(7, 3, "2024-01-05", 2.0), (7, 2, "2024-01-05", 1.0)], "client_id long, product_id long, ds string, qty double")
    demand = BC.demand_by_profile(sales, profiles, BC.reached_below(edges, needs.union(needs.withColumn("root", needs.root - 1))))
    moves = [line for line in demand._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert moves and not any("component" in line for line in moves)
    assert {tuple(r) for r in demand.collect()} == {(7, 2, "x", "2024-01-05", 2.0), (7, 1, "y", "2024-01-05", 3.0), (7, 3, "x", "2024-01-05", 1.0)}
