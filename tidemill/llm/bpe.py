"""Byte-level BPE by ranks: a hierarchical-bitmap rank queue drives the merges.

The symbols of a call's distinct pre-tokens form one doubly linked list with gaps between them. Every
adjacent pair whose bytes have a rank waits in that rank's bucket of list positions. Two levels of
256-bit words mark the buckets that hold anything, so find-first-set gives the next rank in two steps;
positions whose pair has changed since are skipped when their bucket is taken. Pre-tokens do not touch,
so a bucket's pairs merge by vectorised gathers, a few by single steps. Where a merge can make a pair of
a smaller rank, a pre-token's pairs go one by one, the leftmost first, and the smaller rank goes next.
A pre-token of n bytes costs O(n log n), so very long ones are no special case.

``encoded`` adds ids per text; ``decoded`` turns ids back into bytes with vectorised gathers. Neither
shuffles. The rank file's text travels to the executors as a broadcast (under 2 MB).

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded
each on their own; a null ``doc_id`` passes through. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemill.llm import common
from tidemill.llm.pretokens import RunCache, kept, packed

#: Words of the bitmap have 2 to this many bits: Python's integers give find-first-set on any width.
WORD = 8
MASK = (1 << WORD) - 1
#: Buckets under this size merge by single steps, which cost less than vector calls there.
FEW = 96
#: Bytes of pre-tokens in one list; a longer pre-token has a list of its own.
MOST_BYTES = 1 << 21
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Priority queue over a fixed range of ranks: a bucket of list positions per rank."""

    def __init__(self, ranks: int):
        self.buckets: list[list[int] | None] = [None] * ranks
        self.low = [0] * ((ranks >> WORD) + 1)         # one bit per bucket that holds anything
        self.top = 0                                   # one bit per word of ``low``

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets[rank]
        if bucket is None:
            self.buckets[rank] = positions
            word = rank >> WORD
            if not self.low[word]:
                self.top |= 1 << word
            self.low[word] |= 1 << (rank & MASK)
        else:
            bucket.extend(positions)

    def pop(self) -> tuple[int, list[int]]:
        """The smallest rank and its positions from left to right; only while ``top`` is not zero."""
        top = self.top
        at = (top & -top).bit_length() - 1
        word = self.low[at]
        bit = word & -word
        rank = (at << WORD) + bit.bit_length() - 1
        bucket = self.buckets[rank]
        self.buckets[rank] = None
        self.low[at] = word = word ^ bit
        if not word:
            self.top = top & (top - 1)
        bucket.sort()
        return rank, bucket


class _State:
    """The linked list: symbols by first byte, neighbours, and the rank each pair waits under; with views for single steps."""

    def __init__(self, *arrays: np.ndarray):
        self.symbol, self.after, self.before, self.waits = arrays
        self.views = [memoryview(a) for a in arrays]


class Encoder:
    """Ids of byte strings under one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.gap = max(ranks.values(), default=0) + 1          # the symbol between two pre-tokens: no pair holds it
        self.base = self.gap + 1
        self.pairs = {ranks[a] * self.base + ranks[b]: rank for word, rank in ranks.items()
                      for a, b in ((word[:k], word[k:]) for k in range(1, len(word))) if a in ranks and b in ranks}
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.joined = np.array([self.pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        # Ranks after whose merge a pair of a smaller rank can appear: within a pre-token these go one by one.
        self.sinks = np.zeros(self.base, dtype=bool)
        for part in (self.keys // self.base, self.keys % self.base):
            self.sinks[part[self.joined < part]] = True
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        self.queue = RankQueue(self.gap)                       # empty again after every call

    def _rank(self, left, right) -> np.ndarray:
        """Ranks of symbol pairs; -1 where the joined bytes have none."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], np.int32(-1))

    def _merge_words(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of pre-tokens that have no rank as a whole, merged in one list with gaps between."""
        raw = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", dtype=np.uint8)
        stops = np.cumsum([0] + [len(w) + 1 for w in words])   # where the gaps are
        symbol = self.byte[raw]
        symbol[stops] = self.gap
        if symbol.min() < 0:
            raise ValueError("the rank table lacks a single byte")
        n = len(symbol)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        of = np.repeat(np.arange(len(stops), dtype=np.int32), np.diff(stops, append=n))
        waits = np.full(n, -1, dtype=np.int32)                 # the rank under which the pair at a position waits
        if len(self.keys):
            waits[:-1] = self._rank(symbol[:-1], symbol[1:])
        state = _State(symbol, after, before, waits)
        queue, sinks = self.queue, self.sinks
        start = np.flatnonzero(waits >= 0)
        order = start[np.argsort(waits[start], kind="stable")]
        found, first = np.unique(waits[order], return_index=True)
        for rank, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=False):
            queue.push(rank, order[a:b].tolist())
        while queue.top:
            rank, bucket = queue.pop()
            if len(bucket) >= FEW:
                at = np.array(bucket)
                at = at[waits[at] == rank]                     # the others are stale
                bucket = []
                if sinks[rank] and len(at):
                    word = of[at]
                    same = word[1:] == word[:-1]
                    twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
                    bucket, at = at[twice].tolist(), at[~twice]
                if len(at):
                    self._merge_all(rank, at, state)
            if bucket:
                self._merge_each(rank, bucket, state)
        alive = symbol >= 0
        left = symbol[alive]
        ends = np.flatnonzero(left == self.gap)
        packed_ids = left.astype("<u4").tobytes()
        return [packed_ids[4 * a + 4:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _merge_all(self, rank: int, at: np.ndarray, state: _State) -> None:
        """Merge many pairs of one rank at once; of pairs that share a symbol, the left one."""
        symbol, after, before, waits = state.symbol, state.after, state.before, state.waits
        chained = after[at[:-1]] == at[1:]
        if chained.any():
            index = np.arange(len(at))
            begins = np.concatenate(([True], ~chained))
            at = at[(index - np.maximum.accumulate(np.where(begins, index, 0))) & 1 == 0]
        middle = after[at]
        follows = after[middle]
        symbol[at], symbol[middle], waits[middle] = rank, -1, -1
        after[at], before[follows] = follows, at
        right = self._rank(symbol[at], symbol[follows])
        waits[at] = right
        lead = before[at]
        own = np.concatenate(([True], lead[1:] != at[:-1]))    # else the left neighbour's right pair
        lead = lead[own]
        left = self._rank(symbol[lead], symbol[at[own]])
        waits[lead] = left
        push, buckets = self.queue.push, self.queue.buckets
        for places, found in ((at, right), (lead, left)):
            some = found >= 0
            for r, p in zip(found[some].tolist(), places[some].tolist(), strict=True):
                if (bucket := buckets[r]) is None:
                    push(r, [p])
                else:
                    bucket.append(p)

    def _merge_each(self, rank: int, bucket: list[int], state: _State) -> None:
        """Merge the pairs of a bucket one by one; a smaller rank that appears goes first."""
        symbol, after, before, waits = state.views
        pairs, base, push = self.pairs.get, self.base, self.queue.push
        for k, at in enumerate(bucket):
            if waits[at] != rank:
                continue                                       # stale
            middle = after[at]
            follows, lead = after[middle], before[at]
            symbol[at], symbol[middle], waits[middle] = rank, -1, -1
            after[at], before[follows] = follows, at
            waits[at] = right = pairs(rank * base + symbol[follows], -1)
            waits[lead] = left = pairs(symbol[lead] * base + rank, -1)
            if right >= 0:
                push(right, [at])
            if left >= 0:
                push(left, [lead])
            if 0 <= right < rank or 0 <= left < rank:
                if k + 1 < len(bucket):
                    push(rank, bucket[k + 1:])
                return

    def all(self, words: list[str]) -> list[bytes]:
        """The packed ids of each pre-token."""
        raw = [w.encode() for w in words]
        out = [None if (rank := self.ranks.get(w)) is None else packed([rank]) for w in raw]
        some, size = [], 0
        for k, ids in enumerate(out):
            if ids is None:
                some.append(k)
                size += len(raw[k])
            if some and (size >= MOST_BYTES or k + 1 == len(out)):
                for place, ids in zip(some, self._merge_words([raw[p] for p in some]), strict=True):
                    out[place] = ids
                some, size = [], 0
        return out


def ranks_of(raw: bytes) -> dict[bytes, int]:
    """The table of a rank file: base-64 bytes and rank, a line each."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


class Decoder:
    """Bytes of ids by one gather."""

    def __init__(self, ranks: dict[bytes, int]):
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for word, rank in ranks.items():
            table[rank] = word
        self.size = np.array([len(w) for w in table], dtype=np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)[:-1])) if table else np.zeros(0, np.int64)
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)

    def decode(self, ids: bytes) -> bytes:
        codes = np.frombuffer(ids, dtype="<u4")
        if not codes.size:
            return b""
        size = self.size[codes]
        to = np.cumsum(size)
        shift = np.repeat(self.at[codes] - (to - size), size)
        return self.bytes[shift + np.arange(int(to[-1]))].tobytes()


def encoded(docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per document: number of ids, digests of ids and of the decoded bytes; the ids too if asked for."""
    with open(rank_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def coders() -> tuple[RunCache, Decoder]:
            ranks = ranks_of(shared.value)
            return RunCache(pattern, Encoder(ranks).all), Decoder(ranks)

        cache, decoder = kept(("ranks", hashlib.sha256(shared.value).digest(), pattern), coders)
        for part in common.slices(batches, most=1 << 22, keeping=True):
            ids = cache.encode([t or "" for t in part.column("text").to_pylist()])
            cols = [part.column("doc_id").cast(pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(decoder.decode(i)).hexdigest() for i in ids], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


def decoded(ids: DataFrame, rank_file: str) -> DataFrame:
    """(doc_id, content binary) of a table (doc_id, ids)."""
    with open(rank_file, "rb") as f:
        shared = ids.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks_of(shared.value))
        for part in batches:
            content = [decoder.decode(np.array(i or [], dtype="<u4").tobytes()) for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(content, pa.binary())],
                                             names=["doc_id", "content"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")
