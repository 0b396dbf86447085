"""A projection that later filters stay above."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str], cols: list[Column]) -> DataFrame:
    """``df.select(*keep, *cols)`` with ``cols`` evaluated once per row.

    The optimizer pushes a filter on a derived column below its projection by
    repeating the column's expression at every use. It does not push one below
    a generator's output, so the new columns are the fields of a one-element
    array's only entry. The generator is narrow: no shuffle, one row out per row in.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))
