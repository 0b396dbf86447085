"""Ranked lexical search over max-sketches of the documents.

``index`` cuts every document into terms and keeps, for blocks of documents, the sorted term hashes with
their counts and a sketch: terms are hashed to ``COORDINATES`` coordinates and a coordinate holds the
largest count of its terms. A term's impact grows with its count and, apart from the term's weight,
depends on nothing else in one document, so the impact of the largest count bounds the impact of every
term of that coordinate from above.

``search`` looks a batch of queries up in the sketches by one matrix product a block, takes the
documents of each query by descending bound, scores them exactly from the term lists and stops at the
first bound below the score of the k-th best document found so far.

Weights need the number of documents that hold a term, over all documents; these counts are taken for
the terms of a batch of queries, which is bounded in size. Hashes have 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm import common

#: Coordinates of a sketch (a power of two), and documents of a block.
COORDINATES, BLOCK_DOCS = 1024, 2048
#: A batch of queries holds about so many bytes of text and so many rows.
BATCH_BYTES, BATCH_ROWS = 1 << 20, 512
#: Documents scored exactly at a time.
STEP = 32
#: The length part of an impact: 100 - LENGTH_SHARE + LENGTH_SHARE * length / mean length.
LENGTH_SHARE = 25

#: Bytes of a term: digits, letters, and all of a multi-byte character.
_GAP = np.ones(256, dtype=bool)
_GAP[0x30:0x3A] = _GAP[0x41:0x5B] = _GAP[0x61:0x7B] = _GAP[0x80:] = False
_SHIFT = np.uint64(64 - (COORDINATES - 1).bit_length())
_FULL = 255


def _term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, where each text's begin)."""
    raw, offsets = common.text_buffer(texts)
    found = common.words(common.lower_ascii(raw), offsets, _GAP)
    return found.hashes, found.offsets


def index(docs: DataFrame) -> DataFrame:
    """Blocks (doc_ids, lengths, offsets, terms, counts, sketch) of ``docs`` (doc_id, text), staged.

    Term hashes ascend inside a document. A null text has no terms; every row is a document of its own,
    whatever its id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in common.slices(batches):
            for at in range(0, wide.num_rows, BLOCK_DOCS):
                part = wide.slice(at, BLOCK_DOCS)
                hashes, begin = _term_hashes(part.column("text"))
                lengths = np.diff(begin)
                doc = np.repeat(np.arange(part.num_rows, dtype=np.uint16), lengths)
                order = np.argsort(hashes, kind="stable")
                order = order[np.argsort(doc[order], kind="stable")]
                hashes, doc = hashes[order], doc[order]
                first = np.flatnonzero(np.concatenate((np.ones(min(1, hashes.size), bool), (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))))
                counts = np.diff(np.append(first, hashes.size)).astype(np.uint32)
                terms, doc = hashes[first], doc[first].astype(np.int64)
                cell = doc * COORDINATES + (terms >> _SHIFT).astype(np.int64)
                sketch = np.zeros(part.num_rows * COORDINATES, np.uint8)
                if cell.size:
                    turn = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
                    sketch[cell[turn]] = np.minimum(np.maximum.reduceat(counts, turn), _FULL)
                offsets = np.searchsorted(doc, np.arange(part.num_rows + 1))
                ids = part.column("doc_id")
                binary = [pa.array([x.tobytes()], pa.binary()) for x in (lengths.astype(np.int64), offsets.astype(np.int64), terms, counts, sketch)]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *binary],
                                                 names=["doc_ids", "lengths", "offsets", "terms", "counts", "sketch"])

    return common.staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_ids array<long>, lengths binary, offsets binary, terms binary, counts binary, sketch binary"), "lexical-index")


def _numbers(batch: pa.RecordBatch, at: int, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(name)[at].as_py(), kind)


def totals(blocks: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats) over the whole index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = total = 0
        for batch in batches:
            for at in range(batch.num_rows):
                lengths = _numbers(batch, at, "lengths", np.int64)
                have, total = have + int((lengths > 0).sum()), total + int(lengths.sum())
        yield pa.RecordBatch.from_arrays([pa.array([have], pa.int64()), pa.array([total], pa.int64())], names=["n", "l"])

    got = blocks.select("lengths").mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return got[0] or 0, got[1] or 0


def _frequencies(blocks: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How many documents hold each hash of the (sorted) vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary.size, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                terms = _numbers(batch, at, "terms", np.uint64)
                where = np.searchsorted(vocabulary, terms).clip(max=vocabulary.size - 1)
                total += np.bincount(where[vocabulary[where] == terms], minlength=vocabulary.size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "n"])

    out = np.zeros(vocabulary.size, np.int64)
    if vocabulary.size:
        for term, n in blocks.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
            out[term] = n
    return out


class Batch:
    """A batch of queries: for each the distinct terms with weight times repeats, and all in one sketch matrix."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray]):
        self.terms, self.weights = terms, weights
        self.lookup = np.zeros((COORDINATES, len(terms)))
        for k, (t, w) in enumerate(zip(terms, weights)):
            np.add.at(self.lookup[:, k], (t >> _SHIFT).astype(np.int64), w)


def _impact(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's score that its weight multiplies."""
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


class _Best:
    """The best ``k`` documents of each query so far: scores, ids (null last) and the score to reach."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries
        self.reach = np.ones(queries)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores > 0
        scores, ids = np.concatenate((self.scores[q], scores[some])), np.concatenate((self.ids[q], ids[some]))
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores[q], self.ids[q] = scores[order], ids[order]
        if order.size == self.k:
            self.reach[q] = max(1, int(self.scores[q][-1]))


_NO_ID = np.iinfo(np.int64).max


def _rescored(batch: Batch, best: _Best, ids: np.ndarray, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray,
              counts: np.ndarray, bounds: np.ndarray) -> int:
    """Exact scores of one block's documents by descending bound, into ``best``; returns how many were scored."""
    scored = 0
    for q in np.flatnonzero((bounds >= best.reach).any(axis=0)):
        column = bounds[:, q]
        rows = np.flatnonzero(column >= best.reach[q])
        rows = rows[np.argsort(-column[rows], kind="stable")]
        wanted, weights = batch.terms[q], batch.weights[q]
        for at in range(0, rows.size, STEP):
            some = rows[at:at + STEP]
            if column[some[0]] < best.reach[q]:
                break
            score = np.zeros(some.size, np.int64)
            for k, row in enumerate(some):
                lo, hi = offsets[row], offsets[row + 1]
                where = lo + np.searchsorted(terms[lo:hi], wanted).clip(max=hi - lo - 1)
                held = terms[where] == wanted
                score[k] = int((weights[held] * _impact(counts[where[held]], m[row])).sum())
            scored += some.size
            best.add(q, score, ids[some])
    return scored


def _batches(queries: DataFrame, id_column: str) -> Iterator[list[tuple]]:
    """The queries in batches of bounded size; a longer text is a batch of its own."""
    rows = common.staged(queries.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text")), "queries")
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not n:
        return
    parts = max(1, math.ceil(n / (BATCH_ROWS / 2)), math.ceil(size / (BATCH_BYTES / 2)))
    numbered = common.staged(rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts))), "queries")
    for part in range(parts):
        have: list[tuple] = []
        held = 0
        for row in numbered.where(F.col("part") == part).select("id", "text").toLocalIterator():
            if have and (len(have) >= BATCH_ROWS or held + len(row["text"]) > BATCH_BYTES):
                yield have
                have, held = [], 0
            have.append((row["id"], row["text"]))
            held += len(row["text"])
        if have:
            yield have


def search(blocks: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "item_id") -> DataFrame:
    """(id, rank, doc_id, score): the ``k`` best documents of the index for every row of ``queries``.

    ``queries`` has ``id_column`` and ``text``; a term counts as often as it stands in the query. Only
    scores above 0 are listed; equal scores go by ascending doc_id, null last. A query without terms, a
    null text, an empty index give no rows; repeated query rows give repeated results.
    """
    spark = blocks.sparkSession
    id_type = queries.schema[id_column].dataType.simpleString()
    out = None
    n_docs, n_terms = totals(blocks)
    for number, chunk in enumerate(_batches(queries, id_column) if n_terms else ()):
        hashes, begin = _term_hashes(pa.array([t for _, t in chunk], pa.string()))
        vocabulary = np.unique(hashes)
        df = _frequencies(blocks, vocabulary)
        weight = np.array([math.floor(1000 * math.log(float(2 * n_docs + 2) / float(2 * n + 1))) for n in df.tolist()], np.int64)
        terms, weights = [], []
        for a, b in zip(begin[:-1], begin[1:]):
            t, repeats = np.unique(hashes[a:b], return_counts=True)
            terms.append(t)
            weights.append(repeats * weight[np.searchsorted(vocabulary, t)])
        batch = Batch(terms, weights)
        shared = spark.sparkContext.broadcast(batch)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            batch = shared.value
            best = _Best(len(batch.terms), k)
            for part in batches:
                for at in range(part.num_rows):
                    lengths = _numbers(part, at, "lengths", np.int64)
                    m = (100 - LENGTH_SHARE + (LENGTH_SHARE * n_docs * lengths.astype(object)) // n_terms).astype(np.int64)
                    sketch = _numbers(part, at, "sketch", np.uint8).reshape(-1, COORDINATES)
                    counts = sketch.astype(np.int64)
                    counts[sketch == _FULL] = 1 << 31
                    bounds = _impact(counts, m[:, None]).astype(np.float64) @ batch.lookup * (1 + 1e-12)
                    ids = part.column("doc_ids")[at].values.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                    _rescored(batch, best, ids, m, _numbers(part, at, "offsets", np.int64), _numbers(part, at, "terms", np.uint64),
                              _numbers(part, at, "counts", np.uint32).astype(np.int64), bounds)
            sizes = [s.size for s in best.scores]
            ids = np.concatenate(best.ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int64()), pa.array(ids, pa.int64(), mask=ids == _NO_ID),
                 pa.array(np.concatenate(best.scores), pa.int64())], names=["query", "doc_id", "score"])

        found = blocks.select("doc_ids", "lengths", "offsets", "terms", "counts", "sketch").mapInArrow(run, "query long, doc_id long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(chunk)], f"query long, `{id_column}` {id_type}")
        ranked = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                  .join(F.broadcast(names), "query").select(id_column, "rank", "doc_id", "score"))
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], f"`{id_column}` {id_type}, rank int, doc_id long, score long") if out is None else out
