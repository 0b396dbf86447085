"""N-gram Jaccard join: count-vector R-trees over groups that share a rare shingle.

A document's set holds the hashes of its distinct shingles. Documents with one set form a class, and
everything after the first pass works on classes. Two sets that are similar enough share one of their
rarest shingles (the prefix of each set under one fixed order; a sketch of shingle counts of fixed
size puts common shingles last, and any order gives the same pairs). Classes that share such a
shingle form a group:

1. every class of a group is held against one class of it, the hub, so near copies of one text, however
   many, give as many pairs as there are members; verified links are joined into components;
2. groups that still hold several components get the index: tokens are hashed into ``DIMENSIONS``
   token groups, a class is the point of its counts, and a bulk-loaded R-tree is joined with itself,
   descending only where the overlap bound (the sum of the coordinates' minima) reaches what the
   sizes ask for; the tree works on coordinates folded by ``FOLD``, its results are held against all. Groups above ``BLOCK`` classes are cut into blocks, and every pair of blocks is one
   task's work, so no group is collected whole;
3. surviving pairs are verified on the full sets.

Nothing is capped: a pair is left out of this only if it shares no prefix shingle, fails the bound, or
its ends are already known to be connected, so the components are exact. Every link lies inside a
component; ``join`` counts them all and ``links`` gives them out: a component's classes are cut into
blocks, and the trees of each pair of blocks are joined and the surviving pairs verified on the full
sets. Counting gives a row a class and block pair, never a row a link.

Defined cases: a text without words (or null) has an empty set and is linked with nothing; fewer words
than a shingle make one shingle; equal texts, and repeated rows, are one class; a null ``doc_id`` never
names a component unless all its members are null. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import common
from tidemill.llm.components import components

SHINGLE, PERCENT = 5, 80
#: Counters of the shingle sketch; a power of two. 2 to this many.
SKETCH_BITS = 18
SKETCH_ROWS = 16
#: Token groups, that is coordinates of a point, and how many of them the index folds into one.
DIMENSIONS, FOLD = 128, 4
#: The largest count a coordinate holds; it stands for any number from there on.
MOST = (1 << 15) - 1
#: Children of an R-tree node, and classes of one block.
FANOUT, BLOCK = 16, 1024
#: Classes, and shingles of all of them, of one block when links are counted.
LINK_BLOCK, LINK_SHINGLES = 1024, 1 << 20
#: Prefix shingles as common as this share of all counted shingles (2 to the minus this) are dealt in
#: ``SALTS`` parts first.
HOT_BITS, SALTS = 12, 64
#: Orders from which groups take their hub: near copies of one text meet about that many hubs, so that most
#: of them are connected before the index is asked.
HUBS = 8
#: Bytes of text whose sets a task holds at once.
SET_BYTES = 2 << 20
#: Bits of the filter that tells which rows' sets a verification needs (2 to this many); false hits cost their hashing only.
FILTER_BITS = 23
_U = np.uint64


def sets_of(part: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row's text."""
    raw, offsets = common.text_buffer(part.column("text"))
    w = common.words(common.lower_ascii(raw), offsets)
    inside = common.starts_inside(w.offsets, size)
    codes = common.grams(w.hashes, size)[inside]
    n = np.diff(w.offsets)
    at = np.concatenate(([0], np.cumsum(np.maximum(n - size + 1, 0))))
    out = []
    for k, count in enumerate(n.tolist()):
        if count >= size:
            out.append(np.unique(codes[at[k]:at[k + 1]]))
        elif count:
            out.append(common.grams(w.hashes[w.offsets[k]:w.offsets[k + 1]], count) ^ _U(count))
        else:
            out.append(codes[:0])
    return out


def identity(codes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    mixed = common.mix(codes)
    both = np.array([mixed.sum(dtype=np.uint64) + _U(codes.size),
                     common.mix(codes ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], dtype=np.uint64).view(np.int64)
    return int(both[0]), int(both[1])


def points_of(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """How many of the set's tokens fall into each token group."""
    counts = np.bincount((codes >> _U(40)).astype(np.int64) % dimensions, minlength=dimensions)
    return np.minimum(counts, MOST).astype(np.int16)


def fine_point(codes: np.ndarray) -> bytes:
    """The set's counts over about half as many token groups as it has tokens, one byte each; 255 bounds nothing."""
    dims = 1 << max(6, (codes.size // 2).bit_length())
    counts = np.bincount((codes >> _U(16)).astype(np.int64) & (dims - 1), minlength=dims)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def overlap_bound(a: bytes, b: bytes) -> int:
    """The most tokens two sets can share, by the summed minima of their fine counts."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(x.size, y.size)
    if (x == 255).any() or (y == 255).any():
        x, y = (np.where(v == 255, 1 << 30, v.astype(np.int64)) for v in (x, y))
    x, y = (v.reshape(-1, size).sum(axis=0, dtype=np.int64) for v in (x, y))     # token groups modulo the smaller number
    return int(np.minimum(x, y).sum())


def unfolded(points: np.ndarray) -> np.ndarray:
    """Counts to compute with: a full coordinate bounds nothing."""
    return np.where(points == MOST, 1 << 30, points.astype(np.int64))


def _first_pass(docs: DataFrame, size: int) -> DataFrame:
    """A row per document (``slot`` -1) and the task's shingle counts in ``SKETCH_ROWS`` rows."""
    names = ["slot", "doc_id", "n", "c1", "c2", "row_hash", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        mask = _U((1 << SKETCH_BITS) - 1)
        for part in common.slices(batches, most=SET_BYTES):
            sets = sets_of(part, size)
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            counts += np.bincount((every & mask).astype(np.int64), minlength=counts.size)
            ids = [identity(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array([-1] * len(sets), pa.int32()), part.column("doc_id").cast(pa.int64()),
                pa.array([s.size for s in sets], pa.int64()), pa.array([a for a, _ in ids], pa.int64()),
                pa.array([b for _, b in ids], pa.int64()), part.column("row_hash"), pa.nulls(len(sets), pa.binary())], names=names)
        cut = np.split(counts, SKETCH_ROWS)
        nothing = pa.nulls(SKETCH_ROWS, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_ROWS), pa.int32()), nothing, nothing, nothing, nothing, nothing,
                                          pa.array([c.tobytes() for c in cut], pa.binary())], names=names)

    return docs.select("doc_id", "text", _row_hash()).mapInArrow(run, "slot int, doc_id long, n long, c1 long, c2 long, row_hash long, counts binary")


def _sketch(first: DataFrame) -> np.ndarray:
    """Summed counters of all tasks: each slot is streamed through one task, 2**SKETCH_BITS numbers come back."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, raw in zip(batch.column("slot").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                got = np.frombuffer(raw, np.int64)
                total[slot] = total[slot] + got if slot in total else got
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             names=["slot", "counts"])

    rows = first.where("slot >= 0").select("slot", "counts").repartition(SKETCH_ROWS, "slot").mapInArrow(add, "slot int, counts binary").collect()
    out = np.zeros((SKETCH_ROWS, (1 << SKETCH_BITS) // SKETCH_ROWS), np.int64)
    for row in rows:
        out[row["slot"]] += np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def _row_hash():
    """Tells the row that gave a class from other rows, but for rows that repeat it."""
    return F.xxhash64("doc_id", "text").alias("row_hash")


def _classes(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """One row per class, with its prefix (shingle, salt) and its point; fixed in a table with a unique id."""
    total = max(1, int(counts.sum()))
    weight = np.zeros(counts.size, np.uint8)
    weight[counts > 0] = np.log2(counts[counts > 0]).astype(np.uint8) + 1
    shared = docs.sparkSession.sparkContext.broadcast((weight, (counts << HOT_BITS) > total + (64 << HOT_BITS)))
    schema = "n long, c1 long, c2 long, row_hash long, point array<smallint>, fine binary, prefix array<long>, hot array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hot = shared.value
        mask = _U((1 << SKETCH_BITS) - 1)
        for part in common.slices(batches, most=SET_BYTES):
            rows = []
            for codes, row_hash in zip(sets_of(part, size), part.column("row_hash").to_pylist(), strict=True):
                n = codes.size
                if n:
                    cell = (codes & mask).astype(np.int64)
                    order = np.argsort(weights[cell], kind="stable")[:n - -(-percent * n // 100) + 1]
                    rows.append((n, *identity(codes), row_hash, points_of(codes), fine_point(codes), codes[order].view(np.int64), hot[cell[order]]))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int16()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=[c.split()[0] for c in schema.split(", ")])

    found = docs.select("text", _row_hash()).mapInArrow(run, schema)
    return common.staged(found.dropDuplicates(["c1", "c2"]).withColumn("class", F.monotonically_increasing_id()), "classes")


def _turn():
    """Puts a group's classes in one of ``HUBS`` random orders, chosen by its shingle."""
    return F.xxhash64("class", F.pmod(F.col("key"), F.lit(HUBS)))


def _stars(rows: DataFrame) -> DataFrame:
    """(key, hub, other, members) of every run of equal (key, part) with two classes or more; rows come sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub_key, hub = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, part, cls = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "part", "class"))
            new = np.ones(key.size, bool)
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            new[0] = (int(key[0]), int(part[0])) != hub_key
            starts = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            hubs = np.where(run_of >= 0, cls[starts][np.maximum(run_of, 0)] if starts.size else hub, hub)
            other = np.flatnonzero(~new)
            if other.size:
                yield pa.RecordBatch.from_arrays([pa.array(key[other]), pa.array(hubs[other]), pa.array(cls[other])],
                                                 names=["key", "hub", "other"])
            hub_key, hub = (int(key[-1]), int(part[-1])), int(hubs[-1])

    return rows.mapInArrow(run, "key long, hub long, other long")


def _sets(wanted: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(id, codes): the full sets of the ``wanted`` classes (c1, c2, h), each once, staged; ``wanted`` may repeat a class.

    A task sends a set once, however many of its rows repeat it or are false hits of the filter.
    """
    mask = (1 << FILTER_BITS) - 1
    bit = F.col("h").bitwiseAND(F.lit(mask))
    words = (wanted.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((h & {mask}) & 63 as int))")).alias("bits")).collect())
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in words:                                          # at most 2**(FILTER_BITS - 6) rows
        bits[row["word"]] = row["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, sent = shared.value.view(np.uint64), set()
        for batch in batches:
            at = batch.column("row_hash").to_numpy(zero_copy_only=False) & mask
            hit = (have[at >> 6] >> (at & 63).astype(np.uint64)) & _U(1) == 1
            for part in common.slices(iter([batch.filter(pa.array(hit))]), most=SET_BYTES):
                rows = {identity(s): s.view(np.int64) for s in sets_of(part, size) if s.size}
                rows = [(*name, s) for name, s in rows.items() if name not in sent]
                sent.update(row[:2] for row in rows)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                        zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["c1", "c2", "codes"])

    found = (docs.select("text", _row_hash()).mapInArrow(run, "c1 long, c2 long, codes array<long>")
             .join(wanted.select("c1", "c2").distinct(), ["c1", "c2"]).dropDuplicates(["c1", "c2"]))
    return common.staged(found.select(F.struct("c1", "c2").alias("id"), "codes"), "sets")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bound reaches the threshold: by the points, then by the fine counts.

    Points of large sets bound little, as every token group holds many tokens; fine counts have about two
    a group whatever the size, and cost a sixteenth of the sets.
    """
    side = lambda name: classes.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"), F.col("point").alias(f"p_{name}"))
    least = lambda x, y: F.least(x, y).cast("int")
    bound = F.aggregate(F.zip_with("p_a", "p_b", least), F.lit(0), lambda s, x: s + F.when(x == MOST, 1 << 20).otherwise(x))
    coarse = (pairs.join(side("a"), "a").join(side("b"), "b")
              .where(100 * bound >= percent * (F.col("n_a") + F.col("n_b") - bound)).select("a", "b", "n_a", "n_b"))
    fine = lambda name: classes.select(F.col("class").alias(name), F.col("fine").alias(f"f_{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = np.array([overlap_bound(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("f_a"), batch.column("f_b"))], np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(most * (100 + percent) >= percent * n))

    both = common.staged(coarse, "coarse-pairs").join(fine("a"), "a").join(fine("b"), "b")
    return both.select("a", "b", "n_a", "n_b", "f_a", "f_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold; the bounds go first."""
    side = lambda name: classes.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"),
                                       F.struct("c1", "c2").alias(f"id_{name}"), F.col("row_hash").alias(f"h_{name}"))
    enough = lambda common_: 100 * common_ >= percent * (F.col("n_a") + F.col("n_b") - common_)
    left_over = common.staged(_bounded(pairs, classes, percent), "bounded-pairs")
    asked = common.staged(left_over.join(side("a"), "a").join(side("b"), "b")
                          .select("a", "b", "n_a", "n_b", "id_a", "id_b", "h_a", "h_b"), "pairs")
    found = _sets(asked.select(F.explode(F.array(*[F.struct(F.col(f"id_{s}.c1"), F.col(f"id_{s}.c2"), F.col(f"h_{s}").alias("h"))
                                                   for s in "ab"])).alias("c")).select("c.*"), docs, size)
    left, right = (found.select(F.col("id").alias(f"id_{s}"), F.col("codes").alias(f"s_{s}")) for s in "ab")
    both = F.size(F.array_intersect("s_a", "s_b"))
    return asked.join(left, "id_a").join(right, "id_b").where(enough(both)).select("a", "b").distinct()


class CountTree:
    """Bulk-loaded R-tree over count vectors, for a join of two trees by the overlap bound."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((points[:, 0], points.argmax(1), sizes)) if len(sizes) else np.zeros(0, np.int64)
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = []                                       # (highest counts, smallest size, largest size) of each node
        top, small, large = self.points, self.sizes, self.sizes
        while len(small) > 1 or not self.levels:
            cut = np.arange(0, len(small), FANOUT)
            top, small, large = np.maximum.reduceat(top, cut), np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut)
            self.levels.append((top, small, large))

    def join(self, other: CountTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in each tree's input) of the pairs whose bound reaches the threshold."""
        a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
        depth = max(len(self.levels), len(other.levels))
        for level in range(depth - 1, -2, -1):
            mine = self.levels[min(level, len(self.levels) - 1)] if level >= 0 else (self.points, self.sizes, self.sizes)
            theirs = other.levels[min(level, len(other.levels) - 1)] if level >= 0 else (other.points, other.sizes, other.sizes)
            if level < depth - 1:
                a, b = self._children(a, b, level < len(self.levels) - 1, level < len(other.levels) - 1, len(mine[1]), len(theirs[1]))
            keep = []
            for at in range(0, len(a), 65_536):
                x, y = a[at:at + 65_536], b[at:at + 65_536]
                most = np.minimum(mine[0][x], theirs[0][y]).sum(1)
                low = np.maximum(mine[1][x] + theirs[1][y], most)
                # overlap needed: percent / (100 + percent) of both sizes, and percent of the larger set
                keep.append((most * (100 + percent) >= percent * low) & (100 * np.minimum(mine[2][x], theirs[2][y]) >= percent * np.maximum(mine[1][x], theirs[1][y])))
            keep = np.concatenate(keep) if keep else np.zeros(0, bool)
            a, b = a[keep], b[keep]
        return self.order[a], other.order[b]

    @staticmethod
    def _children(a: np.ndarray, b: np.ndarray, open_a: bool, open_b: bool, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
        step_a = np.arange(FANOUT) if open_a else np.zeros(1, np.int64)
        step_b = np.arange(FANOUT) if open_b else np.zeros(1, np.int64)
        x = ((a[:, None] * (FANOUT if open_a else 1) + step_a)[:, :, None] + np.zeros_like(step_b)).reshape(-1)
        y = ((b[:, None] * (FANOUT if open_b else 1) + step_b)[:, None, :] + np.zeros_like(step_a)[:, None]).reshape(-1)
        real = (x < n_a) & (y < n_b)
        return x[real], y[real]


def _indexed(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components inside each group, from joined R-trees over its blocks.

    ``members``: key, class, comp, n, point, members (the group's size), keys (all keys of the class, sorted).
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    dealt = (members.withColumn("own", own).withColumn("blocks", blocks)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"low": F.least("own", "with"), "high": F.greatest("own", "with")})
             .select("key", "low", "high", "own", "class", "comp", "n", "point", "keys"))
    names = ("key", "low", "high", "own", "class", "comp", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                held.append(batch.slice(at, 20_000))
                table = pa.Table.from_batches(held)
                cut = _last_start(table)
                if cut:
                    yield _group_pairs(table.slice(0, cut), names, percent)
                    held = table.slice(cut).to_batches()
        if held:
            yield _group_pairs(pa.Table.from_batches(held), names, percent)

    order = ["key", "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long").distinct()


def _last_start(table: pa.Table) -> int:
    """Where the last group of the sorted rows begins."""
    new = _changes(table)
    at = np.flatnonzero(new)
    return int(at[-1]) if at.size else 0


def _changes(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for name in ("key", "low", "high"):
        c = table.column(name).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return new


def _first_shared(key: np.ndarray, x: np.ndarray, y: np.ndarray, keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Mask of the pairs of rows that share no key below ``key``; a row's sorted keys begin at ``begin``."""
    many = np.diff(begin)
    out = np.ones(x.size, bool)
    rows = np.unique(y)
    at = np.repeat(begin[rows] - (np.cumsum(many[rows]) - many[rows]), many[rows]) + np.arange(int(many[rows].sum()))
    owned = np.sort(common.mix(keys[at].astype(np.uint64)) + np.repeat(rows, many[rows]).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    step = 0
    live = np.arange(x.size)
    while live.size:
        live = live[many[x[live]] > step]
        mine = keys[begin[x[live]] + step]
        live, mine = live[mine < key[live]], mine[mine < key[live]]
        code = common.mix(mine.astype(np.uint64)) + y[live].astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        found = np.searchsorted(owned, code)
        hit = (found < owned.size) & (owned[np.minimum(found, owned.size - 1)] == code)
        out[live[hit]] = False
        live = live[~hit]
        step += 1
    return out


def _group_pairs(table: pa.Table, names: tuple[str, ...], percent: int) -> pa.RecordBatch:
    """The pairs of all groups of some sorted rows: a group of one leaf by its pairs' bounds, others by a tree.

    A pair that shares several keys is given out by the group of the smallest one only.
    """
    col = {k: table.column(k).to_numpy() for k in names}
    points = unfolded(table.column("point").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1))
    listed = table.column("keys").combine_chunks()
    keys, begin = listed.flatten().to_numpy(), listed.offsets.to_numpy() - listed.offsets[0].as_py()
    group = np.cumsum(_changes(table))
    size = np.bincount(group)[group]
    pairs = []
    for step in range(1, FANOUT):                              # the pairs inside a leaf
        a = np.flatnonzero((group[:-step] == group[step:]) & (size[:-step] <= FANOUT) & (col["low"][:-step] == col["high"][:-step]))
        pairs.append((a, a + step))
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    for at, to in zip(first.tolist(), np.append(first[1:], group.size).tolist()):
        if to - at > FANOUT or col["low"][at] != col["high"][at]:
            own, low, high = (col[k][at:to] for k in ("own", "low", "high"))
            one, two = at + np.flatnonzero(own == low), at + np.flatnonzero(own == high)
            if one.size and two.size:
                folded = points[at:to].reshape(to - at, -1, FOLD).sum(2)
                a, b = (CountTree(folded[x - at], col["n"][x]) for x in (one, two))
                a, b = a.join(b, percent)
                pairs.append((one[a], two[b]))
    out_a, out_b = [], []
    for a, b in pairs:
        for at in range(0, a.size, 50_000):
            x, y = a[at:at + 50_000], b[at:at + 50_000]
            x, y = (v[col["comp"][x] != col["comp"][y]] for v in (x, y))
            total = col["n"][x] + col["n"][y]
            most = np.minimum(points[x], points[y]).sum(1)
            real = np.flatnonzero(most * (100 + percent) >= percent * total)
            real = real[_first_shared(col["key"][x[real]], x[real], y[real], keys, begin)]
            out_a.append(col["class"][x[real]])
            out_b.append(col["class"][y[real]])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (out_a, out_b))
    a, b = np.minimum(a, b), np.maximum(a, b)                  # neighbouring groups often hold the same pair
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(a.size, bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.RecordBatch.from_arrays([pa.array(a[new], pa.int64()), pa.array(b[new], pa.int64())], names=["a", "b"])


def _connected(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (doc_id, n, c1, c2, row_hash), the classes, and (node, root) of the classes that have a link."""
    first = common.staged(_first_pass(docs, size), "shingle-counts")
    members = first.where("slot = -1").select("doc_id", "n", "c1", "c2", "row_hash")
    classes = _classes(docs, size, percent, _sketch(first))
    entry = (classes.select("class", F.explode(F.arrays_zip("prefix", "hot")).alias("e"))
             .select(F.col("e.prefix").alias("key"), F.when(F.col("e.hot"), F.pmod(F.col("class"), F.lit(SALTS)) + 1).otherwise(F.lit(0)).cast("int").alias("part"), "class"))
    stars = common.staged(_stars(entry.repartition("key", "part").sortWithinPartitions("key", "part", _turn(), "class")), "stars")
    # the smallest class of each part of a hot shingle stands for the part
    heads = (entry.where("part > 0").groupBy("key", "part").agg(F.min(F.struct(_turn().alias("turn"), "class"))["class"].alias("class"))
             .select("key", F.lit(0).alias("part"), "class"))
    upper = _stars(heads.repartition("key").sortWithinPartitions("key", _turn(), "class"))
    stars = stars.unionByName(common.staged(upper, "stars"))
    tried = stars.select(F.col("hub").alias("a"), F.col("other").alias("b")).distinct()
    links = common.staged(_verified(tried, classes, docs, size, percent), "links")
    found = common.staged(components(links), "components")

    grouped = stars.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    inside = (stars.join(grouped, "key").select("key", F.explode(F.array("hub", "other")).alias("class")).distinct()
              .join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("comp", F.coalesce("root", "class")))
    mixed = (inside.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members"))
             .where("lo <> hi").select("key", "members"))
    mixed = common.staged(inside.join(mixed, "key").select("key", "class", "comp", "members"), "mixed")
    own = mixed.groupBy("class").agg(F.array_sort(F.collect_list("key")).alias("keys"))      # at most a class's prefix
    left = (mixed.join(classes.select("class", "n", "point").join(own, "class"), "class")
            .select("key", "class", "comp", "n", "point", "members", "keys"))
    again = _indexed(left, percent).join(tried, ["a", "b"], "left_anti")
    more = common.staged(_verified(common.staged(again, "candidates"), classes, docs, size, percent), "links")
    return members, classes, components(links.unionByName(more))


def _of_classes(members: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """(c1, c2, class, n, row_hash, least doc_id, copies, root) of every class; ``root`` is the class itself without a link."""
    return (members.where("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
            .join(classes.select("c1", "c2", "class", "n", "row_hash"), ["c1", "c2"])
            .join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")))


def _per_document(members: DataFrame, by_class: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_shingles, component_id, n_copies and the columns ``more`` of its class; 0 there for an empty set."""
    named = (by_class.join(by_class.groupBy("root").agg(F.min("least").alias("component_id")), "root")
             .select("c1", "c2", "copies", "component_id", *more))
    known = members.where("n > 0").join(named, ["c1", "c2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("copies").alias("n_copies"), *more)
    empty = members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                          F.lit(1).cast("long").alias("n_copies"), *[F.lit(0).cast("long").alias(c) for c in more])
    return known.unionByName(empty)


def shared_codes(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many codes every set of ``one`` shares with every set of ``two``; no set holds a code twice."""
    out = np.zeros(len(one) * len(two), np.int64)
    codes = np.concatenate([*one, *two])
    row = np.repeat(np.arange(len(one) + len(two)), [s.size for s in (*one, *two)])
    order = np.argsort(codes, kind="stable")                   # of one code, the rows of ``one`` come first
    codes, row = codes[order], row[order]
    start = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if codes.size else np.zeros(0, np.int64)
    n_one = np.add.reduceat((row < len(one)).astype(np.int64), start) if start.size else start
    n_two = np.diff(np.append(start, codes.size)) - n_one
    both = n_one * n_two
    common_ = both > (out.size >> 7)                           # a column of a matrix product costs less than its pairs
    few = np.flatnonzero((both > 0) & ~common_)
    ends = np.cumsum(both[few])
    at = 0
    while at < few.size:                                       # rare codes pair by pair, some millions at a time
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 22), side="right")))
        code = np.repeat(few[at:to], both[few[at:to]])
        k = np.arange(code.size) - np.repeat(ends[at:to] - both[few[at:to]] - (ends[at - 1] if at else 0), both[few[at:to]])
        x, y = row[start[code] + k // n_two[code]], row[start[code] + n_one[code] + k % n_two[code]]
        out += np.bincount(x * len(two) + y - len(one), minlength=out.size)
        at = to
    many = np.flatnonzero(common_)
    out = out.reshape(len(one), len(two))
    for at in range(0, many.size, 2048):                       # common codes as columns; sums below 2**24 are exact
        of = many[at:at + 2048]
        size = n_one[of] + n_two[of]
        column = np.repeat(np.arange(of.size), size)
        cells = row[np.repeat(start[of] - (np.cumsum(size) - size), size) + np.arange(column.size)]
        has = np.zeros((len(one) + len(two), of.size), np.float32)
        has[cells, column] = 1
        out += (has[:len(one)] @ has[len(one):].T).astype(np.int64)
    return out


def tree_links(sets: list[np.ndarray], one: np.ndarray, two: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """(one, two, link, shared): the sets ``one`` and ``two`` (positions) with a surviving pair, which pairs link, and
    what they share.

    The trees over both sides' points are joined; only the surviving pairs are verified on the sets.
    """
    n = np.array([s.size for s in sets])
    points = unfolded(np.stack([points_of(s) for s in sets])).reshape(len(sets), -1, FOLD).sum(2)
    x, y = CountTree(points[one], n[one]).join(CountTree(points[two], n[two]), percent)
    asked = np.zeros((one.size, two.size), bool)
    asked[x, y] = True
    some, others = np.flatnonzero(asked.any(axis=1)), np.flatnonzero(asked.any(axis=0))
    one, two, asked = one[some], two[others], asked[np.ix_(some, others)]
    both = shared_codes([sets[k] for k in one], [sets[k] for k in two]) if some.size else np.zeros(asked.shape, np.int64)
    return one, two, asked & (100 * both >= percent * (n[one][:, None] + n[two] - both)) & (one[:, None] != two), both


def _block_links(by_class: DataFrame, docs: DataFrame, size: int, percent: int, counts: bool) -> DataFrame:
    """All links between classes: as pairs (a, b, n_shared), or (class, linked), the documents linked in one block pair."""
    linked = by_class.join(by_class.groupBy("root").agg(F.count("*").alias("of")).where("of > 1"), "root", "left_semi")
    found = _sets(linked.select("c1", "c2", F.col("row_hash").alias("h")), docs, size)
    # only components of several blocks come to all tasks
    blocks = (linked.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / LINK_BLOCK, F.sum("n") / LINK_SHINGLES)).cast("int").alias("blocks"))
              .where("blocks > 1"))
    dealt = (linked.join(F.broadcast(blocks), "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
             .select(F.struct("c1", "c2").alias("id"), F.col("root").alias("key"), "class", "copies", "own", "blocks").join(found, "id")
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "own", "class", "copies", "codes"))

    def of_group(own: np.ndarray, low: int, high: int, cls: np.ndarray, copies: np.ndarray, sets: list[np.ndarray]):
        one, two = np.flatnonzero(own == low), np.flatnonzero(own == high)
        if not one.size or not two.size:
            return
        one, two, link, both = tree_links(sets, one, two, percent)
        if not link.any():
            return
        if counts:
            yield cls[one], link @ copies[two]
            if low != high:
                yield cls[two], copies[one] @ link
        else:
            x, y = np.nonzero(link & (one[:, None] < two) if low == high else link)
            yield cls[one[x]], cls[two[y]], both[x, y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            own, low, high, cls, copies = (table.column(k).to_numpy() for k in ("own", "low", "high", "class", "copies"))
            first = np.flatnonzero(np.append(True, _changes(table)[1:]))
            out = []
            for at, to in zip(first.tolist(), np.append(first[1:], table.num_rows).tolist()):
                codes = [x.values.to_numpy().view(np.uint64) for x in table.column("codes").slice(at, to - at)]
                out += of_group(own[at:to], low[at], high[at], cls[at:to], copies[at:to], codes)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                table = pa.Table.from_batches(held)
                cut = _last_start(table)
                if cut:
                    yield from done(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
        if held:
            yield from done(pa.Table.from_batches(held))

    names = ["class", "linked"] if counts else ["a", "b", "n_shared"]
    order = ["key", "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), n_copies (documents with its set)
    and n_links (other documents that reach the threshold with it, those with its set included).
    """
    members, classes, roots = _connected(docs, size, percent)
    by_class = common.staged(_of_classes(members, classes, roots), "by-class")
    linked = _block_links(by_class, docs, size, percent, counts=True).groupBy("class").agg(F.sum("linked").alias("linked"))
    by_class = by_class.join(linked, "class", "left").withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("copies") - 1)
    return _per_document(members, by_class, "n_links")


def links(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Every pair of different sets that reaches the threshold, once: smallest doc_id, size and copies of both, and n_shared."""
    by_class = common.staged(_of_classes(*_connected(docs, size, percent)), "by-class")
    side = lambda name: by_class.select(F.col("class").alias(name), F.col("least").alias(f"doc_id_{name}"),
                                        F.col("n").alias(f"n_{name}"), F.col("copies").alias(f"copies_{name}"))
    return (_block_links(by_class, docs, size, percent, counts=False).join(side("a"), "a").join(side("b"), "b")
            .select("doc_id_a", "doc_id_b", "n_a", "n_b", "copies_a", "copies_b", "n_shared"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the smallest by ``doc_id``, then the set's two numbers, then the row's hash.

    Rows with one ``doc_id`` and different sets are judged apart; without words they are one document. Of
    rows that repeat ``doc_id`` and text the one with the smallest hash of all columns stays. Rows with a
    null ``doc_id`` are not compared by id and stay.
    """
    members, classes, roots = _connected(docs, size, percent)
    named = members.where("doc_id is not null")
    of = _of_classes(members, classes, roots).select("c1", "c2", "root")
    keep = (named.where("n > 0").join(of, ["c1", "c2"]).groupBy("root").agg(F.min(F.struct("doc_id", "c1", "c2", "row_hash")).alias("one"))
            .select("one.doc_id", "one.row_hash")
            .unionByName(named.where("n = 0").groupBy("doc_id").agg(F.min("row_hash").alias("row_hash"))))
    # repeated rows become one in each task before they move
    whole = (docs.where("doc_id is not null").select("doc_id", _row_hash(), F.struct(*docs.columns).alias("row"))
             .groupBy("doc_id", "row_hash").agg(F.min_by("row", F.xxhash64("row")).alias("row")))
    once = whole.join(keep.withColumnRenamed("doc_id", "id").withColumnRenamed("row_hash", "hash"),
                      (F.col("doc_id") == F.col("id")) & (F.col("row_hash") == F.col("hash")), "left_semi").select("row.*")
    return once.unionByName(docs.where("doc_id is null"))
