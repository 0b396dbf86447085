"""Suffix-array dedup of bytes: shard Burrows-Wheeler transforms merged by interleave refinement.

A window is ``WINDOW`` bytes of one text; a byte goes if a window over it also starts in a text with a
smaller ``doc_id``. Sorting all suffixes of a corpus for that would move every byte many times, so the
work is cut down twice, without losing a window:

1. Every window has an anchor, the position inside it whose ``GRAM``-byte hash is smallest; equal
   windows have equal anchors. Neighbouring windows with one anchor form a run. Anchors that occur in
   one document only are dropped (one byte count per distinct anchor and block travels).
2. Runs with the same bytes are one entry of a block, with the smallest document there that holds it. The
   block's other holders lose all windows of the run to that one, so nothing about them travels.

In each group of anchors, the remaining runs that share an anchor with a different run are dealt into
shards. Every shard sorts its own suffixes and gives its transform; the transforms are merged by
refining one interleave, which after round k orders all suffixes by their first k bytes and marks
where neighbours differ within them (the common prefixes). After ``WINDOW`` rounds the unmarked
stretches are the repeated intervals; the smallest document of an interval decides for its windows.
No suffix is sorted again in the merge. Runs of an anchor that very many documents share are sent as
single windows by their own hash, so no anchor is one task's work.

Defined cases: a null or empty text has no bytes; texts shorter than a window keep all bytes; rows with
equal ``doc_id`` do not remove each other's bytes; a null ``doc_id`` counts as larger than any other.
Cuts may fall inside a UTF-8 character, so kept bytes are bytes. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemill.llm import blocks, common

WINDOW, GRAM = 50, 24
#: Anchors of one group, symbols merged at once, and symbols of one shard. A round reads and writes a batch's
#: arrays in the order of the suffixes, so a batch is as large as a core's cache.
GROUP, BATCH, SHARD = 250_000, 1 << 17, 1 << 15
#: Documents from which on an anchor's runs travel as single windows.
HOT = 4096
#: Window starts hashed at once, whose arrays stay in a core's cache, and bits of a place among them.
_SPAN, _PLACE = 1 << 16, 21
_LAST = np.iinfo(np.int64).max
_U = np.uint64

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def anchors(raw: np.ndarray, window: int) -> np.ndarray:
    """For every window start, the position of the smallest gram hash in the window (the first of equals)."""
    n = raw.size - window + 1
    out = np.empty(max(n, 0), np.int64)
    width = window - GRAM + 1
    for low in range(0, n, _SPAN):
        m = min(_SPAN, n - low)
        x = common.grams(common.BYTE_CODES[raw[low:low + m + window - 1]], GRAM)
        x = ((x >> _U(_PLACE)) << _U(_PLACE)) | np.arange(x.size, dtype=np.uint64)
        have = 1
        while 2 * have <= width:
            x = np.minimum(x[:-have], x[have:])
            have *= 2
        if have < width:
            x = np.minimum(x[:x.size - (width - have)], x[width - have:])
        out[low:low + m] = (x & _U((1 << _PLACE) - 1)).astype(np.int64) + low
    return out


class Runs:
    """The runs of some texts: first window, number of windows, anchor key, text number."""

    def __init__(self, texts: pa.Array, window: int):
        self.raw, self.offsets = common.text_buffer(texts)
        inside = np.flatnonzero(common.starts_inside(self.offsets, window))
        at = anchors(self.raw, window)[inside] if inside.size else inside
        new = np.ones(inside.size, bool)
        new[1:] = (at[1:] != at[:-1]) | (inside[1:] - inside[:-1] != 1)
        head = np.flatnonzero(new)
        self.first = inside[head]
        self.count = np.diff(np.append(head, inside.size))
        self.key = common.span_hashes(self.raw, at[head], at[head] + GRAM) if head.size else np.zeros(0, np.uint64)
        self.text = np.searchsorted(self.offsets, self.first, side="right") - 1
        # an empty text before shares its offset; the last one that begins here holds the bytes


def _cell(key: np.ndarray) -> np.ndarray:
    return (key >> _U(54)).astype(np.int64)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Mask of the rows that differ from the row before in any column."""
    new = np.ones(columns[0].size, bool)
    if new.size:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _keys(runs: Runs, groups: blocks.Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, key, documents up to 255, entry of each run) of a block's distinct keys, by group and key."""
    group = groups.of(_cell(runs.key), runs.key)
    order = np.lexsort((runs.text, runs.key, group))
    g, k, t = group[order], runs.key[order], runs.text[order]
    new = _heads(g, k)
    entry = np.empty(order.size, np.int64)
    entry[order] = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    docs = np.add.reduceat(_heads(g, k, t).astype(np.int64), head) if head.size else head
    return g[head], k[head], np.minimum(docs, 255).astype(np.uint8), entry


def _per_group(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.flatnonzero(_heads(group))
    return head, np.append(head[1:], group.size)


def _send_keys(table: DataFrame, groups: blocks.Groups, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts, _, _ in blocks.each_block(batches):
            group, key, docs, _ = _keys(Runs(texts, window), groups)
            a, b = _per_group(group)
            if a.size:
                yield pa.RecordBatch.from_arrays([
                    pa.array(group[a].astype(np.int32), pa.int32()), pa.array([block] * a.size, pa.int64()),
                    pa.array([key[x:y].tobytes() for x, y in zip(a, b)], pa.binary()),
                    pa.array([docs[x:y].tobytes() for x, y in zip(a, b)], pa.binary())], names=["grp", "block", "keys", "docs"])

    return table.select("block", "texts", "doc_ids").mapInArrow(run, "grp int, block long, keys binary, docs binary")


def _shared_keys(group: pa.Table) -> pa.Table:
    """For every block of a group, a byte a key: 0 in one document only, 1 in several, 2 in very many."""
    parts = [np.frombuffer(p, np.uint64) for p in group.column("keys").to_pylist()]
    key = np.concatenate(parts)
    docs = np.concatenate([np.frombuffer(p, np.uint8) for p in group.column("docs").to_pylist()]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    new = _heads(key[order])
    total = np.add.reduceat(docs[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    kind = np.empty(key.size, np.uint8)
    kind[order] = (total > 1).astype(np.uint8) + (total >= HOT)
    at = np.concatenate(([0], np.cumsum([p.size for p in parts])))
    return pa.table({"grp": group.column("grp"), "block": group.column("block"),
                     "bits": pa.array([kind[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())})


class Entries:
    """The runs of a block that matter, by group, key, bytes and document.

    ``content`` is the number of the distinct (group, key, bytes); ``least`` marks the runs of a content's
    smallest document in the block.
    """

    def __init__(self, runs: Runs, doc_ids: pa.Array, groups: blocks.Groups, shared: dict[int, bytes], window: int):
        group, key, _, entry = _keys(runs, groups)
        kind = np.zeros(key.size, np.uint8)
        for g, raw in shared.items():
            a, b = np.searchsorted(group, g), np.searchsorted(group, g, side="right")
            kind[a:b] = np.frombuffer(raw, np.uint8)
        kind = kind[entry]
        ids = doc_ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        plain, hot = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        times = runs.count[hot]
        single = np.repeat(runs.first[hot] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        first = np.concatenate([runs.first[plain], single])
        count = np.concatenate([runs.count[plain], np.ones(single.size, np.int64)])
        text = np.concatenate([runs.text[plain], np.repeat(runs.text[hot], times)])
        order = np.argsort(first + count, kind="stable")
        first, count, text = first[order], count[order], text[order]
        code = common.span_hashes(runs.raw, first, first + count + window - 1) if first.size else np.zeros(0, np.uint64)
        own = np.concatenate([runs.key[plain], np.zeros(single.size, np.uint64)])[order]
        alone = np.concatenate([np.zeros(plain.size, bool), np.ones(single.size, bool)])[order]
        own = np.where(alone, code, own)
        group = groups.of(_cell(own), own)
        order = np.lexsort((ids[text], code, own, group))
        self.group, self.key, self.code = group[order], own[order], code[order]
        self.first, self.count, self.doc = first[order], count[order], ids[text][order]
        self.new_content = _heads(self.group, self.key, self.code, self.count)
        self.content = np.cumsum(self.new_content) - 1
        self.least = self.doc == self.doc[self.new_content][self.content]


def _send_runs(joined: DataFrame, groups: blocks.Groups, window: int) -> DataFrame:
    schema = "grp int, block long, keys binary, codes binary, sizes binary, bytes binary, docs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts, doc_ids, row in blocks.each_block(batches):
            runs = Runs(texts, window)
            e = Entries(runs, doc_ids, groups, blocks.answers_of(row, "shared"), window)
            rows = []
            for a, b in zip(*_per_group(e.group)):
                head = a + np.flatnonzero(e.new_content[a:b])
                size = e.count[head] + window - 1
                at = _ranges(e.first[head], size)
                rows.append((int(e.group[a]), block, e.key[head].tobytes(), e.code[head].tobytes(), size.astype(np.uint16).tobytes(),
                             runs.raw[at].tobytes(), e.doc[head].tobytes()))
            if rows:
                kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=[c.split()[0] for c in schema.split(", ")])

    return joined.mapInArrow(run, schema)


class Shard:
    """Some strings' suffixes in order, and their Burrows-Wheeler transform. Symbol 0 ends a string.

    A symbol is a byte plus one, and fits a byte itself: UTF-8 has no byte above 0xF4.
    """

    def __init__(self, symbols: np.ndarray, string: np.ndarray, left: np.ndarray):
        # ``left``: symbols from here to the string's end, its 0 included
        n = symbols.size
        width = 8
        code = np.zeros(n, np.uint64)
        for k in range(width):                                  # eight bits a symbol, eight symbols at once
            part = np.zeros(n, np.uint64)
            part[:n - k] = symbols[k:].astype(np.uint64)
            part[left <= k] = 0
            code = (code << _U(8)) | part
        rank, order = self._ranked(code)
        while width < int(left.max(initial=0)):
            after = np.zeros(n, np.uint64)
            inner = left > width
            after[inner] = rank[np.flatnonzero(inner) + width].astype(np.uint64) + _U(1)
            rank, order = self._ranked((rank.astype(np.uint64) << _U(32)) | after)
            width *= 2
        self.order = order
        before = np.empty(n, np.uint8)
        before[1:] = symbols[:-1]                               # a string's first symbol follows a 0
        before[:1] = 0
        self.transform = before[order]
        self.strings = int((symbols == 0).sum())

    @staticmethod
    def _ranked(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(code, kind="stable")
        rank = np.empty(code.size, np.int64)
        rank[order] = np.cumsum(_heads(code[order])) - 1
        return rank, order


def merge(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each suffix in merged order, number of its class of equal first ``rounds`` symbols).

    Each round reads the transforms in the order of the interleave and sorts the interleave by the
    symbols read, which are the first symbols of the suffixes one longer.
    """
    symbols = np.concatenate([s.transform for s in shards])
    kind = np.min_scalar_type(len(shards))
    z = np.repeat(np.arange(len(shards), dtype=kind), [s.order.size for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=kind), [s.strings for s in shards])
    cls = np.zeros(z.size, np.int32)
    read = np.empty(z.size, np.uint8)
    for _ in range(rounds):
        read[np.argsort(z, kind="stable")] = symbols            # each shard's transform, in its own order
        order = np.argsort(read, kind="stable")
        first, above = read[order], cls[order]
        z = z[order]
        z[:ends.size] = ends                                    # string ends keep their order
        above[:ends.size] = 0
        before, cls = int(cls[-1]), np.cumsum(_heads(first, above), dtype=np.int32) - 1
        if int(cls[-1]) + 1 == z.size and before + 1 == z.size:
            break
    return z, cls


def _smallest_holder(strings: np.ndarray, sizes: np.ndarray, least: np.ndarray, window: int) -> np.ndarray:
    """For every window of every string, in order, the smallest document that holds it.

    ``strings``: the strings' bytes one after another, ``least``: smallest document of each.
    """
    total = sizes + 1
    to = np.cumsum(total)
    symbols = np.zeros(int(to[-1]), np.uint8)
    inner = np.ones(symbols.size, bool)
    inner[to - 1] = False
    symbols[inner] = strings + 1
    owner = np.repeat(np.arange(sizes.size, dtype=np.int32), total)
    left = (np.repeat(to, total) - np.arange(symbols.size)).astype(np.int32)
    cut = np.unique(np.append(np.searchsorted(to, np.arange(0, symbols.size, SHARD), side="left"), sizes.size))
    shards, place = [], []
    for a, b in zip(cut[:-1], cut[1:]):
        x, y = (int(to[a - 1]) if a else 0), int(to[b - 1])
        shards.append(Shard(symbols[x:y], owner[x:y], left[x:y]))
        place.append(shards[-1].order + x)
    z, cls = merge(shards, window)
    suffix = np.empty(z.size, np.int64)
    suffix[np.argsort(z, kind="stable")] = np.concatenate(place)
    real = left[suffix] > window                                # a whole window starts here
    suffix, cls = suffix[real], cls[real]
    head = np.flatnonzero(_heads(cls))
    best = np.minimum.reduceat(least[owner[suffix]], head)
    out = np.empty(symbols.size, np.int64)
    out[suffix] = np.repeat(best, np.diff(np.append(head, cls.size)))
    return out[left > window]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after another."""
    to = np.cumsum(size)
    return np.repeat(begin - (to - size), size) + np.arange(int(to[-1]) if to.size else 0)


def _batches(key: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of the sorted keys with about ``BATCH`` symbols each; a key is never divided."""
    head = np.flatnonzero(_heads(key))
    to = np.cumsum(np.add.reduceat(symbols, head))
    a = 0
    while a < head.size:
        b = max(a + 1, int(np.searchsorted(to, (to[a - 1] if a else 0) + BATCH, side="right")))
        yield int(head[a]), int(head[b]) if b < head.size else key.size
        a = b


def _decide(window: int):
    def run(group: pa.Table) -> pa.Table:
        col = lambda name, kind: [np.frombuffer(x, kind) for x in group.column(name).to_pylist()]
        key, code = np.concatenate(col("keys", np.uint64)), np.concatenate(col("codes", np.uint64))
        size = np.concatenate(col("sizes", np.uint16)).astype(np.int64)
        text = np.concatenate(col("bytes", np.uint8))
        doc_parts = col("docs", np.int64)
        doc = np.concatenate(doc_parts)
        # equal (key, bytes) of different blocks are one string
        order = np.lexsort((size, code, key))
        new = _heads(key[order], code[order], size[order])
        string = np.empty(order.size, np.int64)
        string[order] = np.cumsum(new) - 1
        one = order[new]
        n = one.size
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
        # keys with several strings go through the transforms
        k = key[one]
        head = np.flatnonzero(_heads(k))
        several = np.repeat(np.diff(np.append(head, n)) > 1, np.diff(np.append(head, n)))
        mask = np.where(least[string] < doc, _U(0xFFFFFFFFFFFFFFFF), _U(0))
        pick = np.flatnonzero(several)
        if pick.size:
            begin = (np.cumsum(size) - size)[one[pick]]
            s = size[one[pick]]
            best = np.concatenate([_smallest_holder(text[_ranges(begin[a:b], s[a:b])], s[a:b], least[pick[a:b]], window)
                                   for a, b in _batches(k[pick], s + 1)])
            n_windows = s - window + 1
            first = np.cumsum(n_windows) - n_windows
            slot = np.full(n, -1, np.int64)
            slot[pick] = np.arange(pick.size)
            asked = np.flatnonzero(slot[string] >= 0)
            for low in range(0, asked.size, 100_000):
                some = asked[low:low + 100_000]
                where = slot[string[some]]
                many = n_windows[where]
                run_to = np.cumsum(many)
                step = np.arange(int(run_to[-1])) - np.repeat(run_to - many, many)
                gone = best[np.repeat(first[where], many) + step] < np.repeat(doc[some], many)
                mask[some] = np.add.reduceat(gone.astype(np.uint64) << step.astype(np.uint64), run_to - many)
        at = np.concatenate(([0], np.cumsum([p.size for p in doc_parts])))
        return pa.table({"grp": group.column("grp"), "block": group.column("block"),
                         "bits": pa.array([mask[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())})

    return run


def _gone(runs: Runs, e: Entries, masks: dict[int, bytes], window: int) -> np.ndarray:
    """Mask over the block's bytes."""
    mask = np.zeros(int(e.new_content.sum()), np.uint64)
    held = e.group[e.new_content]
    for g, raw in masks.items():
        a, b = np.searchsorted(held, g), np.searchsorted(held, g, side="right")
        mask[a:b] = np.frombuffer(raw, np.uint64)
    mask = np.where(e.least, mask[e.content], _U(0xFFFFFFFFFFFFFFFF))
    to = np.cumsum(e.count)
    step = np.arange(int(to[-1]) if to.size else 0) - np.repeat(to - e.count, e.count)
    hit = (np.repeat(mask, e.count) >> step.astype(np.uint64)) & _U(1) == 1
    return common.covered((np.repeat(e.first, e.count) + step)[hit], window, runs.raw.size)


def _answered(docs: DataFrame, window: int) -> tuple[DataFrame, blocks.Groups]:
    if not GRAM <= window < GRAM + 64:
        raise ValueError(f"a window has {GRAM} to {GRAM + 63} bytes")
    table = blocks.blocked(docs, lambda texts: _cell(Runs(texts, window).key))
    groups = blocks.Groups(blocks.histogram(table), GROUP)
    shared = common.staged(_send_keys(table, groups, window).groupBy("grp")
                           .applyInArrow(_shared_keys, "grp int, block long, bits binary"), "shared")
    sent = _send_runs(blocks.with_answers(table, shared=shared), groups, window)
    masks = common.staged(sent.groupBy("grp").applyInArrow(_decide(window), "grp int, block long, bits binary"), "masks")
    return blocks.with_answers(table, shared=shared, masks=masks), groups


def removed(docs: DataFrame, window: int = WINDOW, with_kept: bool = False) -> DataFrame:
    """Per document: bytes, removed bytes, removed spans and the digest of the kept bytes (``SCHEMA``); the
    kept bytes themselves if asked for."""
    joined, groups = _answered(docs, window)
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["kept"] * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, doc_ids, row in blocks.each_block(batches):
            runs = Runs(texts, window)
            e = Entries(runs, doc_ids, groups, blocks.answers_of(row, "shared"), window)
            gone = _gone(runs, e, blocks.answers_of(row, "masks"), window)
            head = gone.copy()
            head[1:] &= ~gone[:-1]
            begins = runs.offsets[:-1][runs.offsets[:-1] < gone.size]
            head[begins] = gone[begins]
            n_gone = common.per_document(gone, runs.offsets)
            kept, to = runs.raw[~gone], np.cumsum(np.diff(runs.offsets) - n_gone)
            parts = [kept[b - n:b].tobytes() for b, n in zip(to.tolist(), (np.diff(runs.offsets) - n_gone).tolist(), strict=True)]
            cols = [doc_ids, pa.array(np.diff(runs.offsets), pa.int64()), pa.array(n_gone, pa.int64()),
                    pa.array(common.per_document(head, runs.offsets), pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(parts, pa.binary())] * with_kept, names=names)

    return joined.mapInArrow(run, SCHEMA + ", kept binary" * with_kept)
