"""Exact numeric helpers (JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)`` with HALF_UP on exact integers, returned as double.

    Averages of integer columns go through this so that no intermediate
    decimal scale rounds twice; ``den = 0`` gives null.
    """
    factor = 10 ** scale
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    a = F.abs(n) * (2 * factor) + d
    b = d * 2
    # floor(a / b) on exact decimals: (a - a mod b) / b divides evenly.
    units = ((a - a % b) / b).cast("decimal(38,0)") * F.signum(n).cast("decimal(1,0)")
    return F.when(d != 0, units.cast("double") / F.lit(float(factor)))
