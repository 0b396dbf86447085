"""Exact top-k inner products of integer vectors, longest vectors first.

Vectors are rotated onto the singular directions of all of them, so that a few leading coordinates
hold most of every product, and cut by descending length into stripes. Each query first meets the
longest stripe, which gives it a score to beat. A query then meets a stripe only if the product of the
lengths can reach that score (Cauchy-Schwarz); inside, the product of the leading coordinates plus the
product of the lengths of the rest bounds a score from above, and only pairs whose bound reaches the
score to beat are multiplied in full, in integers.

Queries are a stated subset of the rows. They travel in groups and the vectors in stripes, both of
bounded size, so that one task holds one group and one stripe whatever the input's size. Lengths differ
little in some tables; then nearly every group meets every stripe, in as many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm import common

#: Most vectors of a stripe or queries of a group, and their most components.
STRIPE_ROWS, STRIPE_CELLS = 16_384, 1 << 21
#: Queries and vectors that are multiplied at a time.
QUERY_STEP, VECTOR_STEP = 512, 4096
#: Share of the squared lengths that the leading coordinates hold.
LEADING = 0.75
#: Integers are clamped to this size.
LARGEST = (1 << 31) - 1
_LONG = np.iinfo(np.int64)


def _points(vectors: DataFrame, is_query: Column, scale: int) -> DataFrame:
    """(row, id, asked, ints, norm) of the vectors that take part; ``row`` names the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            given = batch.column("vector").cast(pa.large_list(pa.float64()))
            flat = given.flatten()
            values = flat.fill_null(math.nan).to_numpy(zero_copy_only=False)
            sizes = np.asarray(given.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            bad = common.per_document(~np.isfinite(values), offsets) > 0
            keep = ~bad & given.is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                ints = np.clip(np.nan_to_num(np.floor(scale * values)), -LARGEST, LARGEST).astype(np.int32)
            raw = [ints[offsets[k]:offsets[k + 1]].tobytes() for k in np.flatnonzero(keep)]
            norm = np.sqrt(np.array([float((np.frombuffer(r, np.int32).astype(np.float64) ** 2).sum()) for r in raw]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(raw)), pa.int64()), batch.column("id").filter(pa.array(keep)),
                 batch.column("asked").filter(pa.array(keep)), pa.array(raw, pa.binary()), pa.array(norm, pa.float64())],
                names=["row", "id", "asked", "ints", "norm"])
            row += len(raw)

    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asked"),
                          F.col("embedding").alias("vector"))
    return common.staged(rows.mapInArrow(run, "row long, id long, asked boolean, ints binary, norm double"), "points")


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    """Vectors one a row; the missing components of shorter ones are 0."""
    out = np.zeros((len(raw), width), np.int32)
    for k, r in enumerate(raw):
        v = np.frombuffer(r, np.int32)
        out[k, :v.size] = v
    return out


def _rotation(points: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """The singular directions of all vectors as columns, and how many of them lead.

    Every task adds up its own products of components; the sums, one number a pair of components, are
    all that reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("ints").to_pylist(), width).astype(np.float64)
            total += m.T @ m
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a * width + b, pa.int64()), pa.array(total[a, b], pa.float64())], names=["cell", "x"])

    gram = np.zeros(width * width)
    for cell, x in points.select("ints").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x")).collect():
        gram[cell] = x
    energy, basis = np.linalg.eigh(gram.reshape(width, width))
    energy, basis = energy[::-1].clip(0), basis[:, ::-1].copy()
    held = np.cumsum(energy)
    return basis, min(width, int(np.searchsorted(held, LEADING * held[-1])) + 1)


@dataclass
class Search:
    """What every task knows: vector width, directions, leading coordinates, k, whether products fit a double."""

    width: int
    basis: np.ndarray
    lead: int
    k: int
    exact: bool

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """All inner products as longs; where a double might round, Python integers are used and clamped."""
        if self.exact:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return np.clip(a.astype(object) @ b.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of rows with equal numbers."""
        if self.exact:
            return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
        return np.clip((a.astype(object) * b.astype(object)).sum(axis=1), _LONG.min, _LONG.max).astype(np.int64)

    def split(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leading coordinates, length of the rest, length) of every row."""
        turned = m.astype(np.float64) @ self.basis
        return turned[:, :self.lead].copy(), np.sqrt((turned[:, self.lead:] ** 2).sum(axis=1)), np.sqrt((turned ** 2).sum(axis=1))

    def best(self, q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, m: np.ndarray, beat: np.ndarray,
             beat_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of each query's best ``k``, as positions, vectors by descending length.

        A pair counts if it scores over the query's ``beat``, or equals it with an id below ``beat_id``.
        """
        found = [(np.zeros(0, np.int64),) * 3]
        lead, rest, length = self.split(m)
        for at in range(0, len(q), QUERY_STEP):
            mine = slice(at, at + QUERY_STEP)
            need, need_id = beat[mine].copy(), beat_id[mine].copy()
            q_lead, q_rest, q_length = self.split(q[mine])
            have = (np.zeros(0, np.int64),) * 3
            for lo in range(0, len(m), VECTOR_STEP):
                cut = slice(lo, lo + VECTOR_STEP)
                slack = 1e-9 * q_length * length[lo]
                alive = np.flatnonzero(q_length * length[lo] + slack >= need)
                if not alive.size:
                    break                                   # later vectors are shorter still
                bound = q_lead[alive] @ lead[cut].T
                bound += q_rest[alive, None] * rest[None, cut]
                bound += slack[alive, None]
                hit = bound >= need[alive, None]
                _, at_query, at_vector = np.intersect1d(q_rows[mine][alive], rows[cut], assume_unique=True, return_indices=True)
                hit[at_query, at_vector] = False            # a query is no candidate of its own
                if not hit.any():
                    continue
                if hit.mean() > 1 / 8:
                    score = self.products(q[mine][alive], m[cut])
                    score[~hit] = _LONG.min
                    if score.shape[1] > self.k:
                        kth = np.partition(score, score.shape[1] - self.k, axis=1)[:, -self.k]
                        hit &= score >= kth[:, None]
                    r, c = np.nonzero(hit)
                    s = score[r, c]
                else:
                    r, c = np.nonzero(hit)
                    s = self.pairs(q[mine][alive[r]], m[cut][c])
                r = alive[r]
                good = (s > need[r]) | ((s == need[r]) & (ids[lo + c] < need_id[r]))
                have = self._merged(have, (r[good], lo + c[good], s[good]), ids)
                full = np.bincount(have[0], minlength=len(q_lead)) >= self.k
                last = np.searchsorted(have[0], np.arange(len(q_lead)), side="right") - 1
                need[full] = have[2][last[full]]
                need_id[full] = ids[have[1][last[full]]]
            found.append((have[0] + at, have[1], have[2]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _merged(self, a: tuple, b: tuple, ids: np.ndarray) -> tuple:
        r, c, s = (np.concatenate(x) for x in zip(a, b))
        order = np.lexsort((ids[c], ~s, r))
        r, c, s = r[order], c[order], s[order]
        rank = np.arange(r.size) - np.searchsorted(r, r)
        keep = rank < self.k
        return r[keep], c[keep], s[keep]


def _packed(points: DataFrame, parts: int, name: str, width: int) -> DataFrame:
    """(name, top, rows, ids, ints): one row a range of lengths, longest first; equal lengths go by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = [b for b in batches if b.num_rows]
        if not have:
            return
        have = pa.Table.from_batches(have)
        ints = _matrix(have.column("ints").to_pylist(), width)
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()),
             pa.array([have.column("norm")[0].as_py()], pa.float64()), one(have.column("row")), one(have.column("id")),
             pa.array([ints.tobytes()], pa.binary())], names=[name, "top", "rows", "ids", "ints"])

    order = [F.desc("norm"), F.asc_nulls_last("id"), F.asc("row")]
    dealt = points.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("row", "id", "ints", "norm")
    return dealt.mapInArrow(run, f"{name} long, top double, rows array<long>, ids array<long>, ints binary")


def _ids(values: pa.Array) -> np.ndarray:
    """Ids for comparison; a null id stands behind all others."""
    return values.fill_null(_LONG.max).to_numpy(zero_copy_only=False)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """The ``k`` best rows by inner product for every row with ``is_query``: (query_id, rank, vec_id, score).

    ``vectors`` has ``vec_id`` and ``embedding``; a component x counts as floor(scale * x). All rows but
    the query's own are candidates, rows with the same id or vector included; equal scores go by smaller
    ``vec_id``, a null id last. A row whose vector is null or holds a null or non-finite component takes
    no part; ``is_query`` null is false. Shorter vectors are filled up with 0, an empty one scores 0.
    Integers are clamped to 32 bits and scores to a long. Fewer candidates than ``k`` give fewer rows, an
    empty table none. Other columns are not read.
    """
    spark = vectors.sparkSession
    out = "query long, query_id long, vec_id long, score long"
    points = _points(vectors, is_query, scale)
    n, asked, width, longest = points.agg(F.count("*"), F.count_if("asked"), F.max(F.length("ints")), F.max("norm")).first()
    if not asked or n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, width // 4)
    size = max(64, min(STRIPE_ROWS, STRIPE_CELLS // width))
    basis, lead = _rotation(points, width)
    search = Search(width, basis, lead, k, longest * longest < 2 ** 52)
    stripes = common.staged(_packed(points, math.ceil(n / size), "stripe", width), "stripes")
    first, last = stripes.agg(F.min("stripe"), F.max("stripe")).first()

    def unpacked(batch: pa.RecordBatch | pa.Table, at: int, prefix: str = "") -> tuple[np.ndarray, pa.Array, np.ndarray]:
        rows = batch.column(prefix + "rows")[at].values.to_numpy(zero_copy_only=False)
        ints = np.frombuffer(batch.column(prefix + "ints")[at].as_py(), np.int32).reshape(-1, width)
        return rows, batch.column(prefix + "ids")[at].values, ints

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                q_rows, q_ids, q = unpacked(batch, at)
                order = np.argsort(q_rows)                     # rows ascend inside a group from here on
                q_rows, q_ids, q = q_rows[order], q_ids.take(pa.array(order)), q[order]
                rows, ids, m = unpacked(batch, at, "head_")
                r, c, s = search.best(q_rows, q, rows, _ids(ids), m, np.full(len(q), _LONG.min), np.full(len(q), _LONG.max))
                beat, beat_id = np.full(len(q), _LONG.min), np.full(len(q), _LONG.max)
                full = np.bincount(r, minlength=len(q)) >= k
                end = np.searchsorted(r, np.arange(len(q)), side="right") - 1
                beat[full], beat_id[full] = s[end[full]], _ids(ids)[c[end[full]]]
                length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
                with np.errstate(all="ignore"):
                    need = np.where(length > 0, beat / np.maximum(length, 1e-300), np.where(beat > 0, math.inf, -math.inf))
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                long = lambda x: pa.array(x, pa.int64())
                hits = pa.StructArray.from_arrays([long(q_rows[r]), q_ids.take(long(r)), ids.take(long(c)), long(s)],
                                                  names=["query", "query_id", "vec_id", "score"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grp").slice(at, 1), pa.array([float(need.min())], pa.float64()),
                     one(long(q_rows)), one(q_ids), pa.array([q.tobytes()], pa.binary()), one(long(beat)), one(long(beat_id)), one(hits)],
                    names=["grp", "need", "rows", "ids", "ints", "beat", "beat_id", "hits"])

    head = stripes.where(F.col("stripe") == first).select("stripe", *[F.col(c).alias(f"head_{c}") for c in ("rows", "ids", "ints")])
    groups = _packed(points.where("asked"), math.ceil(asked / size), "grp", width).withColumn("stripe", F.lit(first))
    seeded = common.staged(groups.join(F.broadcast(head), "stripe").mapInArrow(
        seed, "grp long, need double, rows array<long>, ids array<long>, ints binary, beat array<long>, beat_id array<long>, "
              f"hits array<struct<{out.replace(' long', ': long')}>>"), "seeded")
    found = seeded.select(F.explode("hits").alias("h")).select("h.*")

    if last > first:
        # Cells (group, stripe) where a query's length times the stripe's longest vector can reach its score.
        needs = seeded.select("grp", "need", F.explode(F.sequence(F.lit(first + 1), F.lit(last))).alias("stripe"))
        cells = common.staged(needs.join(stripes.select("stripe", "top"), "stripe").where("top * (1 + 1e-9) >= need")
                              .select("grp", "stripe"), "cells")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            q_rows, q_ids, q = unpacked(left, 0)
            rows, ids, m = unpacked(right, 0)
            known = [left.column(c)[0].values.to_numpy(zero_copy_only=False) for c in ("beat", "beat_id")]
            r, c, s = search.best(q_rows, q, rows, _ids(ids), m, *known)
            return pa.table({"query": pa.array(q_rows[r], pa.int64()), "query_id": q_ids.take(pa.array(r, pa.int64())),
                             "vec_id": ids.take(pa.array(c, pa.int64())), "score": pa.array(s, pa.int64())})

        asking = cells.join(seeded.select("grp", "rows", "ids", "ints", "beat", "beat_id"), "grp").repartition(parts, "grp", "stripe")
        asked_of = (cells.join(stripes.select("stripe", "rows", "ids", "ints"), "stripe")
                    .select(F.col("grp").alias("of_grp"), F.col("stripe").alias("of_stripe"), "rows", "ids", "ints").repartition(parts, "of_grp", "of_stripe"))
        found = found.unionByName(asking.groupBy("grp", "stripe").cogroup(asked_of.groupBy("of_grp", "of_stripe")).applyInArrow(cell, out))

    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
