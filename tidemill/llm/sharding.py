"""Histogram sort: shards of near-equal bytes in key order, by exact counts below probed boundaries.

Rows are ordered by (doc_id, row number of the measured table). Every round counts, in one
aggregation over the measured rows, the bytes and rows below all candidate boundaries; brackets
around each splitter shrink until its byte count meets the tolerance or no row is left between the
bracket's ends, and any cell that is still large gets probes of its own. The counts that the rounds
collected also give the rank at which every cell begins, so one exchange by cell and a row number
inside each cell yield gapless slots; no shard is ever one task.

Refinement ends only when every splitter meets the tolerance or its bracket holds one row. Boundaries
that neither hold a bracket nor keep a cell small are forgotten after each round, so the driver holds a
number of them that follows from the shards alone. Only built-in functions run on the executors.

Defined cases: a null or empty text has size 16 and checksum 0; a null ``doc_id`` sorts first;
repeated rows keep their own slots; an empty table gives no rows; shards that no row reaches stay
empty. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import common

SHARDS = 40
ROW_BYTES = 16
#: A splitter is met when its bytes differ from the target by this share of a shard.
TOLERANCE = 0.001
PROBES, CELLS_PER_SHARD = 15, 16
_LOW = -(1 << 63)
_MINOR = 1 << 63


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, major, minor) of every row, fixed in a table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return common.staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("major"),
        F.monotonically_increasing_id().alias("minor")), "shard-sizes")


def _longs(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" if v > _LOW else "-9223372036854775808L" for v in values) + ")")


def cell_of(bounds: list[int]) -> Column:
    """How many of the sorted boundaries lie at or below the row's key: a binary search over literals."""
    size = 1
    while size <= len(bounds):
        size *= 2
    top = [(1 << 63) - 1] * (size - 1 - len(bounds))
    major = _longs([b // _MINOR for b in bounds] + top)
    minor = _longs([b % _MINOR for b in bounds] + top)
    steps = F.array(*[F.lit(size >> k) for k in range(1, size.bit_length())])

    def advance(at: Column, step: Column) -> Column:
        probe = at + step - 1
        return at + F.when((F.get(F.col("_major"), probe) < F.col("major"))
                           | ((F.get(F.col("_major"), probe) == F.col("major")) & (F.get(F.col("_minor"), probe) <= F.col("minor"))),
                           step).otherwise(0)

    return major, minor, F.aggregate(steps, F.lit(0), advance)


def with_cell(rows: DataFrame, bounds: list[int]) -> DataFrame:
    if not bounds:
        return rows.withColumn("cell", F.lit(0))
    major, minor, cell = cell_of(bounds)
    return rows.withColumns({"_major": major, "_minor": minor}).withColumn("cell", cell).drop("_major", "_minor")


class Histogram:
    """Exact (bytes, rows) below every boundary probed so far."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        low, high, total, count = rows.agg(F.min("major"), F.max("major"), F.sum("size"), F.count("*")).first()
        self.total, self.count = total or 0, count
        self.low, self.high = ((low * _MINOR, (high + 1) * _MINOR) if count else (0, 0))
        self.below = {self.low: (0, 0), self.high: (self.total, self.count)}

    def probe(self, keys: set[int]) -> None:
        bounds = sorted(keys - self.below.keys())
        if not bounds:
            return
        found = {r["cell"]: (r["b"], r["n"]) for r in
                 with_cell(self.rows, bounds).groupBy("cell").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
        size = n = 0
        for k, key in enumerate(bounds):
            b, m = found.get(k, (0, 0))
            size, n = size + b, n + m
            self.below[key] = (size, n)


    def forget(self, keep: set[int], largest: int) -> None:
        """Drop boundaries outside ``keep`` whose two cells together have at most ``largest`` rows."""
        keys = sorted(self.below)
        held = keys[:1]
        for key, after in zip(keys[1:-1], keys[2:]):
            if key in keep or self.below[after][1] - self.below[held[-1]][1] > largest:
                held.append(key)
        self.below = {key: self.below[key] for key in {*held, keys[-1]}}


def _between(low: int, high: int, n: int) -> set[int]:
    return {low + (high - low) * k // (n + 1) for k in range(1, n + 1)} - {low, high}


def splitters(h: Histogram, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """``shards - 1`` boundaries whose bytes below are the nearest found to equal parts."""
    targets = [h.total * k / shards for k in range(1, shards)]
    largest_cell = max(1, h.count // (CELLS_PER_SHARD * shards))
    h.probe(_between(h.low, h.high, shards * PROBES))
    while True:
        keys = sorted(h.below)
        sizes = [h.below[k][0] for k in keys]
        ask: set[int] = set()
        ends: set[int] = set()
        for t in targets:
            at = min(max(1, bisect_left(sizes, t)), len(keys) - 1)
            a, b = keys[at - 1], keys[at]
            ends |= {a, b}
            off = min(abs(h.below[a][0] - t), abs(h.below[b][0] - t))
            if off > tolerance * h.total / shards and h.below[b][1] - h.below[a][1] > 1:
                ask |= _between(a, b, PROBES)
        for a, b in zip(keys, keys[1:]):
            if (n := h.below[b][1] - h.below[a][1]) > largest_cell:
                ask |= _between(a, b, min(PROBES, n // largest_cell + 1))
        h.forget(ends, largest_cell)
        if not ask:
            break
        h.probe(ask)
    keys = sorted(h.below)
    return sorted(min(keys, key=lambda k: (abs(h.below[k][0] - t), k)) for t in targets)


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Every row with its size, checksum, shard and slot under the law ``bytes``."""
    rows = measured(docs)
    h = Histogram(rows)
    if not h.count:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    cut = splitters(h, shards, tolerance)
    bounds = sorted(k for k in h.below if k < h.high)
    place = []
    for key in bounds:
        s = sum(c <= key for c in cut)
        place.append((s, h.below[key][1] - (h.below[cut[s - 1]][1] if s else 0)))
    numbered = (with_cell(rows, bounds)
                .withColumn("n", F.row_number().over(Window.partitionBy("cell").orderBy("major", "minor"))))
    base = [0, *range(len(bounds))]
    shard_of, first = _longs([place[k][0] for k in base]), _longs([place[k][1] for k in base])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.get(shard_of, F.col("cell")).cast("int").alias("shard"),
        (F.get(first, F.col("cell")) + F.col("n") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
