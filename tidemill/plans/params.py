"""Fixed parameters of the registered queries (the reference's ``now()`` becomes ``as_of``).

Windows of the log reports are taken from the rows' own times.
"""

from __future__ import annotations

from pyspark.sql import functions as F

AS_OF_TEXT = "2024-02-01 00:00:00"


def as_of_ntz():
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


AS_OF_SQL = f"timestamp '{AS_OF_TEXT}'"
