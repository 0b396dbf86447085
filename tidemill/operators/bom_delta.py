"""Maintaining a stored BOM explosion when edges change (H1, H6).

A changed edge alters the roots that reach its parent in at most ``max_levels - 1`` edges, before or after
the change. These are found by walking up from the changed parents; only they are expanded again.

The store keeps exploded rows in buckets of a hash of the root; a run rewrites the buckets of affected roots
only, under a manifest (``sources.bucketed``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.bom import DEFAULT_MAX_LEVELS, _validate
from tidemill.operators.bom_clients import expand, recurring_nodes
from tidemill.session import checkpointed
from tidemill.sources.bucketed import BucketedTable

EDGE = ["parent", "component", "produced_at"]


def changed_parents(old: DataFrame, new: DataFrame) -> DataFrame:
    """Parents (``node``) of edges that were added, removed or given another quantity.

    Parallel edges count as one with summed quantity, which decides all results.
    """
    sides = old.select(*EDGE, F.col("qty").cast("double").alias("qty"), F.lit(0).alias("side")).unionByName(
        new.select(*EDGE, F.col("qty").cast("double").alias("qty"), F.lit(1).alias("side")))
    of = lambda side, c: F.when(F.col("side") == side, c)
    both = sides.groupBy(*EDGE).agg(
        *[F.sum(of(s, F.col("qty"))).alias(f"q{s}") for s in (0, 1)], *[F.count(of(s, F.lit(1))).alias(f"n{s}") for s in (0, 1)])
    return both.filter(~F.col("q0").eqNullSafe(F.col("q1")) | (F.col("n0") != F.col("n1"))).select(F.col("parent").alias("node")).distinct()


def affected_roots(old: DataFrame, new: DataFrame, max_levels: int = DEFAULT_MAX_LEVELS) -> DataFrame:
    """Roots (``root``) whose explosion may differ between two edge tables."""
    _validate(max_levels)
    up = old.select("parent", "component").unionByName(new.select("parent", "component")).distinct()
    up = checkpointed(up.select(F.col("parent").alias("above"), F.col("component").alias("node")))
    seen = frontier = checkpointed(changed_parents(old, new))
    for _ in range(max_levels - 1):
        frontier = checkpointed(up.join(frontier, "node").select(F.col("above").alias("node")).distinct().join(seen, "node", "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.select(F.col("node").alias("root"))


def explode_roots(edges: DataFrame, roots: DataFrame | None = None, max_levels: int = DEFAULT_MAX_LEVELS) -> DataFrame:
    """The explosion with sites of all parents, or of those among ``roots``."""
    _validate(max_levels)
    seeds = edges.select(F.col("parent").alias("root")).distinct()
    if roots is not None:
        seeds = seeds.join(roots, "root", "left_semi")
    seeds = checkpointed(seeds).select("root", F.lit(True).alias("checked"), F.lit(False).alias("loose"), F.lit(max_levels).alias("cap"))
    levels = expand(edges, seeds, recurring_nodes(edges, max_levels))
    return (levels.select("root", "component", "level", F.inline("sites")).groupBy("root", "component", "produced_at")
            .agg(F.sum("q").alias("qty"), F.sum("n").cast("long").alias("paths"),
                 F.min("level").alias("min_level"), F.max("level").alias("max_level")))


class BomStore:
    """A stored explosion in ``path``, bucketed by root and maintained run by run."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, max_levels: int = DEFAULT_MAX_LEVELS):
        self.table, self.max_levels = BucketedTable(spark, path, ["root"], buckets), max_levels

    def create(self, edges: DataFrame) -> None:
        """The first run: everything."""
        self.table.replace(list(range(self.table.buckets)), explode_roots(edges, None, self.max_levels))

    def read(self) -> DataFrame:
        return self.table.read()

    def apply(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Brings the store from ``old`` edges to ``new`` ones; returns the affected roots.

        Nothing is written if nothing changed. Repeating a finished run is harmless: its roots are expanded
        again to the same rows.
        """
        roots = checkpointed(affected_roots(old, new, self.max_levels))
        touched = self.table.touched(roots)
        if touched:
            fresh = explode_roots(new, roots, self.max_levels)
            kept = self.table.read(touched).join(roots, "root", "left_anti")
            self.table.replace(touched, kept.unionByName(fresh))
        return roots
