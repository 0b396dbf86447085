"""A table kept in hash buckets that runs replace one by one.

A run writes whole buckets under ``data/run=<n>`` and, last, a manifest that says which run holds each bucket;
other buckets keep their files. A run that fails before its manifest leaves nothing visible and is repeated into
the same folder. Old runs' files stay until the caller removes them, so readers are never cut off.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BucketedTable:
    """``buckets`` buckets of rows by a hash of ``keys``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets that rows with the keys of ``df`` belong to (at most ``buckets`` numbers)."""
        return sorted(r["bucket"] for r in self.bucketed(df).select("bucket").distinct().collect())

    def manifest(self) -> tuple[int, dict[int, int]]:
        """The newest finished run (0: none) and, for each bucket ever written, the run that holds it."""
        try:
            runs = self.spark.read.parquet(f"{self.path}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        last = runs.agg(F.max("run")).first()[0]
        return last, {r["bucket"]: r["held_by"] for r in runs.filter(F.col("run") == last).collect()}

    def replace(self, buckets: list[int], rows: DataFrame) -> None:
        """Makes ``rows`` the whole content of ``buckets``."""
        run, held = self.manifest()
        run += 1
        (self.bucketed(rows).repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.path}/data/run={run}"))
        entries = self.spark.createDataFrame(sorted((held | dict.fromkeys(buckets, run)).items()), "bucket int, held_by int")
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/run={run}")

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The rows (of some buckets), by partition filters on run and bucket."""
        held: dict[int, list[int]] = {}
        for bucket, run in self.manifest()[1].items():
            if only is None or bucket in only:
                held.setdefault(run, []).append(bucket)
        wanted = F.lit(False)
        for run, buckets in held.items():
            wanted = wanted | ((F.col("run") == run) & F.col("bucket").isin(buckets))
        return self.spark.read.parquet(f"{self.path}/data").filter(wanted).drop("run", "bucket")
