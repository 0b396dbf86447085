"""Config versions merged on write (E3): arriving versions become current, older ones lose the stored flag.

The store is bucketed by the version key (client, type); a merge reads and rewrites the buckets of arriving rows
only. The flag of a group follows from one aggregate, its newest (created_at, id), so the order of arrival does
not matter: a late row with an older time is added without the flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.configs import CONFIG_KEYS
from tidemill.sources.bucketed import BucketedTable


def with_current(rows: DataFrame, keys: list[str] = CONFIG_KEYS) -> DataFrame:
    """``rows`` with ``is_current``: whether no row of the group is newer (no time counts as newest, then the larger id)."""
    rank = F.struct(F.col("created_at").isNull().alias("open"), "created_at", "id")
    newest = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(rank)["id"].alias("_newest"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(newest, on).select(*rows.columns, (F.col("id") == F.col("_newest")).alias("is_current"))


class ConfigStore:
    """Versions with stored flags in ``path``. Ids are unique; a version that arrives again changes nothing."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] = CONFIG_KEYS, buckets: int = 64):
        self.table, self.keys = BucketedTable(spark, path, keys, buckets), keys

    def merge(self, arriving: DataFrame) -> list[int]:
        """Adds versions and renews the flags of their groups; returns the rewritten buckets."""
        arriving = arriving.dropDuplicates(["id"])
        touched = self.table.touched(arriving)
        if touched:
            rows = arriving
            if self.table.manifest()[0]:
                kept = self.table.read(touched).drop("is_current")
                rows = kept.unionByName(arriving.join(kept.select("id"), "id", "left_anti"))
            self.table.replace(touched, with_current(rows, self.keys))
        return touched

    def read(self) -> DataFrame:
        return self.table.read()
