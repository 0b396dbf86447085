"""Row numbers and next-row values within groups that may be arbitrarily large.

``row_number()`` / ``lead()`` over ``partitionBy(group)`` send a whole group to
one task. Here each group is cut into slices by a coarse key that is
monotone in the sort order (for time-ordered rows: the day), rows are
numbered inside their (group, slice), and a small per-(group, slice) summary
(one row per group and day) supplies each slice's offset and the first row of
the next slice. Slices come from the data, never from physical partition
ids, so every branch of the plan agrees on them. The result equals the plain
window version row for row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi-join in which a null key meets a null key."""
    named = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return left.join(named, same).drop(*[f"_on_{c}" for c in on])


def number_within_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column,
                         next_of: str | None = None) -> DataFrame:
    """Add ``rn`` (1-based position in the group), ``group_rows`` and, with ``next_of``,
    ``next_<col>`` (that column on the following row of the group, null on the last).

    ``slice_by`` must be non-decreasing along ``order`` within a group (rows of a
    slice are contiguous in the order) and non-null.
    """
    tagged = df.withColumn("_slice", slice_by)
    w_local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = tagged.withColumn("_lrn", F.row_number().over(w_local))
    if next_of:
        local = local.withColumn("_lnext", F.lead(next_of).over(w_local))
    summary = tagged.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_cnt"))
    if next_of:
        first = (local.filter(F.col("_lrn") == 1)
                      .select(*keys, "_slice", F.col(next_of).alias("_first")))
        summary = _joined(summary, first, [*keys, "_slice"])
    w_s = Window.partitionBy(*keys).orderBy("_slice")
    summary = summary.select(
        *keys, "_slice", "_cnt",
        F.coalesce(F.sum("_cnt").over(w_s.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*keys)).alias("group_rows"),
        *([F.lead("_first").over(w_s).alias("_next_first")] if next_of else []),
    )
    out = _joined(local, summary, [*keys, "_slice"]).withColumn("rn", F.col("_off") + F.col("_lrn"))
    if next_of:
        out = out.withColumn(f"next_{next_of}",
                             F.when(F.col("_lrn") == F.col("_cnt"), F.col("_next_first")).otherwise(F.col("_lnext")))
    drop = ["_slice", "_lrn", "_cnt", "_off"] + (["_lnext", "_next_first"] if next_of else [])
    return out.drop(*drop)


def day_slice(ts_col: str) -> Column:
    """Day of ``ts_col``, nulls after every day: a slice key for ``ts ASC NULLS LAST`` orders."""
    return F.coalesce(F.to_date(F.col(ts_col)), F.lit("9999-12-31").cast("date"))
