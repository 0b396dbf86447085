"""Substring dedup: prefix-partitioned suffix trees over words find every window that occurs twice.

A suffix begins at a word and matters to the depth of one window. Suffixes are split by their first
words: the cells of a hash of ``PREFIX`` words are counted over all texts, neighbouring cells that
fit into ``GROUP`` suffixes together form one group. In a cell that does not fit, prefixes grow to a window's
length, and their hash deals them to as many groups as the cell needs: texts that share many words and then
differ part there, and only equal windows must stay together, of which a block sends one. A group's subtree is held as the sorted
64-bit hashes of the suffixes' paths down to the window's depth: an internal node that deep is a run
of equal paths, and its leaves are the repeated windows; neighbouring ones join into maximal repeats.

Equal windows of one block travel once, with a mark if the block holds two, so a passage that a third
of all documents share costs a group one entry a block. Texts are written once, bucketed by block, and
answers come back as one bit a window.

Defined cases: a null or empty text has no words; texts shorter than a window keep all words; repeated
rows are copies of each other, so their windows go; a null ``doc_id`` passes through. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import blocks, common

WINDOW = 35
#: Words of the short prefix, and suffixes of one group.
PREFIX, GROUP = 8, 2_000_000

SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string"


class Suffixes:
    """The window suffixes of some texts: where they start, their path (also the long prefix) and cell."""

    def __init__(self, texts: pa.Array, window: int):
        self.raw, self.offsets = common.text_buffer(texts)
        self.words = w = common.words(self.raw, self.offsets)
        short = min(PREFIX, window)
        inside = common.starts_inside(w.offsets, window)
        n = inside.size
        self.starts = np.flatnonzero(inside)
        self.path = common.grams(w.hashes, window)[self.starts] if n else np.zeros(0, np.uint64)
        self.cells = (common.grams(w.hashes, short)[:n][self.starts] >> np.uint64(54)).astype(np.int64) if n else np.zeros(0, np.int64)


def _cells(window: int):
    return lambda texts: Suffixes(texts, window).cells


def _ordered(s: Suffixes, groups: blocks.Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, path, seen twice, entry of each suffix) of a block's distinct paths, sorted by group and path."""
    group = groups.of(s.cells, s.path)
    order = np.lexsort((s.path, group))
    path = s.path[order]
    new = np.ones(path.size, bool)
    new[1:] = (path[1:] != path[:-1]) | (group[order][1:] != group[order][:-1])
    entry = np.empty(path.size, np.int64)
    entry[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    twice = np.diff(np.append(first, path.size)) > 1
    return group[order][first], path[first], twice, entry


def _send(table: DataFrame, groups: blocks.Groups, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts, _, _ in blocks.each_block(batches):
            group, path, twice, _ = _ordered(Suffixes(texts, window), groups)
            cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if group.size else np.zeros(0, np.int64)
            ends = np.append(cut[1:], group.size)
            if cut.size:
                yield pa.RecordBatch.from_arrays([
                    pa.array(group[cut].astype(np.int32), pa.int32()), pa.array([block] * cut.size, pa.int64()),
                    pa.array([path[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
                    pa.array([blocks.bits(twice[a:b]) for a, b in zip(cut, ends)], pa.binary())], names=["grp", "block", "paths", "twice"])

    return table.select("block", "texts", "doc_ids").mapInArrow(run, "grp int, block long, paths binary, twice binary")


def _deep_nodes(group: pa.Table) -> pa.Table:
    """For every block of one group: which of its paths end in an internal node, by merging the sorted paths."""
    parts = [np.frombuffer(p, np.uint64) for p in group.column("paths").to_pylist()]
    path = np.concatenate(parts)
    order = np.argsort(path, kind="stable")
    same = path[order][1:] == path[order][:-1]
    deep = np.zeros(path.size, bool)
    deep[order[1:]] |= same
    deep[order[:-1]] |= same
    answers, at = [], 0
    for part, twice in zip(parts, group.column("twice").to_pylist(), strict=True):
        answers.append(blocks.bits(deep[at:at + part.size] | blocks.flags(twice, part.size)))
        at += part.size
    return pa.table({"grp": group.column("grp"), "block": group.column("block"), "bits": pa.array(answers, pa.binary())})


class Removal:
    """What goes from each text of a block."""

    def __init__(self, texts: pa.Array, groups: blocks.Groups, answers: dict[int, bytes], window: int):
        self.s = s = Suffixes(texts, window)
        group, path, _, entry = _ordered(s, groups)
        deep = np.zeros(path.size, bool)
        for g, raw in answers.items():
            a, b = np.searchsorted(group, g), np.searchsorted(group, g, side="right")
            deep[a:b] = blocks.flags(raw, b - a)
        self.gone = common.covered(s.starts[deep[entry]], window, int(s.words.offsets[-1]))
        edge = self.gone.copy()
        edge[1:] &= ~self.gone[:-1]
        firsts = s.words.offsets[:-1]
        edge[firsts[firsts < edge.size]] = self.gone[firsts[firsts < edge.size]]
        self.heads = edge

    def kept(self, k: int) -> bytes:
        """The kept words of text ``k``, joined by one space."""
        s = self.s
        text = s.raw[s.offsets[k]:s.offsets[k + 1]].tobytes().split()
        gone = self.gone[s.words.offsets[k]:s.words.offsets[k + 1]]
        return b" ".join(compress(text, (~gone).tolist()) if gone.any() else text)

    def spared(self, k: int) -> str | None:
        """Text ``k`` without its removed runs of words, the rest of its layout unchanged; None if nothing goes."""
        s = self.s
        a, b = s.words.offsets[k], s.words.offsets[k + 1]
        gone = self.gone[a:b]
        if not gone.any():
            return None
        edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
        heads, tails = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out, at = [], int(s.offsets[k])
        for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
            out.append(s.raw[at:s.words.starts[a + head]].tobytes())
            at = int(s.words.ends[a + tail - 1])
        out.append(s.raw[at:s.offsets[k + 1]].tobytes())
        return b"".join(out).decode()


def _plan(docs: DataFrame, window: int) -> tuple[DataFrame, blocks.Groups, DataFrame]:
    table = blocks.blocked(docs, _cells(window))
    groups = blocks.Groups(blocks.histogram(table), GROUP)
    answers = (_send(table, groups, window).groupBy("grp").applyInArrow(_deep_nodes, "grp int, block long, bits binary"))
    return table, groups, common.staged(answers, "answers")


def removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: counts, number of maximal repeated runs, and the digest of its kept words (``SCHEMA``)."""
    table, groups, answers = _plan(docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, doc_ids, row in blocks.each_block(batches):
            r = Removal(texts, groups, blocks.answers_of(row, "deep"), window)
            offsets = r.s.words.offsets
            yield pa.RecordBatch.from_arrays([
                doc_ids, pa.array(np.diff(offsets), pa.int64()), pa.array(common.per_document(r.gone, offsets), pa.int64()),
                pa.array(common.per_document(r.heads, offsets), pa.int64()),
                pa.array([hashlib.sha256(r.kept(k)).hexdigest() for k in range(len(texts))], pa.string())],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    return blocks.with_answers(table, deep=answers).mapInArrow(run, SCHEMA)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all columns and rows; the words of repeated windows are cut out of ``text`` and
    ``n_chars`` (if there is one) counts what is left. A null text stays null.

    The other columns travel beside the block's texts, so rows are never matched by id.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    table = blocks.blocked(docs, _cells(window), others)
    groups = blocks.Groups(blocks.histogram(table), GROUP)
    answers = common.staged(_send(table, groups, window).groupBy("grp").applyInArrow(_deep_nodes, "grp int, block long, bits binary"), "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, doc_ids, row in blocks.each_block(batches):
            r = Removal(texts, groups, blocks.answers_of(row, "deep"), window)
            rest = row["others"].values
            left = [None if null else r.spared(k) for k, null in enumerate(row["nulls"].values.to_pylist())]
            kept = [None if null else (old if new is None else new) for old, new, null in
                    zip(texts.to_pylist(), left, row["nulls"].values.to_pylist(), strict=True)]
            cols = {"doc_id": doc_ids, "text": pa.array(kept, pa.string())} | {c: rest.field(k) for k, c in enumerate(others)}
            yield pa.RecordBatch.from_arrays([cols[c] for c in docs_columns], names=docs_columns)

    docs_columns = docs.columns
    out = blocks.with_answers(table, ["others", "nulls"], deep=answers).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in others else out
