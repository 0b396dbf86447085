"""Sum-of-squares online packing of tokenised documents into sequences of a fixed length.

Every task packs the documents it reads, in their order. A document's ids end with the id 0. Whole
sequences are cut off first; what remains is one item, placed into the fill level that makes the sum
over levels of the squared number of open sequences smallest (a new sequence is level 0). The counts
live in one array with an entry per level, so a placement is one vector expression whatever the
number of open sequences. When the input ends, the sequences still open are poured together, cutting
where one is full, and the last rest is cut into powers of two, which need no padding.

Memory: the open sequences' pieces, of which the rule keeps few. Nothing is shuffled, so a hot source
or a group of copies has no effect on the layout of the work.

Defined cases: a null or empty text is the id 0 alone; repeated rows are packed each on their own; a
null ``doc_id`` passes through. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemill.llm import common
from tidemill.llm.pretokens import RunCache, kept, packed

LENGTH = 1024
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class Packer:
    """One task's open sequences. Pieces are (document, first id, number of ids)."""

    def __init__(self, length: int):
        self.length = length
        self.count = np.zeros(length + 1, dtype=np.int64)      # open sequences by fill; full ones are not open
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)
        self.made = 0

    def level_for(self, size: int) -> int:
        """The fill level (0: a new sequence) that leaves the smallest sum of squares."""
        n, last = self.count, self.length - size
        grown = 2 * n[size:self.length + 1] + 1
        grown[-1] = 0                                          # a full sequence is closed
        change = np.where(n[:last + 1] > 0, grown - 2 * n[:last + 1] + 1, np.iinfo(np.int64).max)
        change[0] = grown[0]
        return last - int(np.argmin(change[::-1]))             # of equals, the fullest

    def place(self, piece: tuple) -> list[tuple] | None:
        """Put an item shorter than a sequence; returns the sequence's pieces if that filled it."""
        size = piece[2]
        level = self.level_for(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.length:
            return pieces
        self.count[level + size] += 1
        self.open[level + size].append(pieces)
        return None

    def rest(self) -> Iterator[list[tuple]]:
        """Close what is open: pour, cut at full sequences, and end with powers of two."""
        stream = [p for level in sorted(self.open, reverse=True) for pieces in self.open[level] for p in pieces]
        left = sum(p[2] for p in stream)
        self.open.clear()
        self.count[:] = 0
        room, pieces = 0, []
        for doc, start, size in stream:
            while size:
                if not room:
                    room = self.length if left >= self.length else 1 << (left.bit_length() - 1)
                    left -= room
                take = min(room, size)
                pieces.append((doc, start, take))
                start, size, room = start + take, size - take, room - take
                if not room:
                    yield pieces
                    pieces = []


#: Longer pre-tokens (bytes) go to the tokenizer itself, whose merging suits any length.
LONG_PIECE = 256


def byte_ranks(tokenizer_json: str) -> dict[bytes, int] | None:
    """Bytes to id of a byte-level BPE vocabulary whose merges come in the order of their ids, else None.

    There the merge of smallest rank is the one whose result has the smallest id, so ranks alone encode.
    """
    model = json.loads(tokenizer_json)["model"]
    vocab = model.get("vocab")
    if model.get("type") != "BPE" or not isinstance(vocab, dict) or model.get("ignore_merges") or model.get("dropout"):
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]      # bytes that are written as themselves
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or not all(c in byte_of for t in vocab for c in t):
        return None
    return {bytes(byte_of[c] for c in token): k for token, k in vocab.items()}


def encode_pieces(tokenizer, pieces: list[str]) -> list[bytes]:
    """The packed ids of each pre-token. Those without a line end are encoded as the lines of one text:
    the line end is a pre-token of its own there, so its id marks where each piece's ids stop.
    """
    lines = [p for p in pieces if "\n" not in p and not p.isspace()]
    found: dict[str, bytes] = {}
    if lines:
        end, ids = (e.ids for e in tokenizer.encode_batch_fast(["\n", "\n".join(lines) + "\n"], add_special_tokens=False))
        ids = np.array(ids, dtype="<u4")
        at = np.flatnonzero(ids == end[0])
        if len(end) == 1 and len(at) == len(lines):
            raw = ids.tobytes()
            for piece, a, b in zip(lines, chain((0,), (at + 1).tolist()), at.tolist(), strict=False):
                found[piece] = raw[4 * a:4 * b]
    rest = [p for p in pieces if p not in found]
    found.update((p, packed(e.ids)) for p, e in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True))
    return [found[p] for p in pieces]


def piece_encoder(tokenizer_json: str):
    """Function from pre-tokens to the packed ids of each, for a tokenizer file's content."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.encode_special_tokens = True
    ranks = byte_ranks(tokenizer_json)
    if ranks is None:
        return lambda pieces: encode_pieces(tokenizer, pieces)
    import tiktoken

    encode = tiktoken.Encoding("ranks", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def run(pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        found = [packed(encode(r)) if len(r) <= LONG_PIECE else None for r in raw]
        if None in found:
            long = [k for k, ids in enumerate(found) if ids is None]
            for k, ids in zip(long, encode_pieces(tokenizer, [pieces[k] for k in long]), strict=True):
                found[k] = ids
        return found

    return run


def pack(docs: DataFrame, tokenizer_file: str, pattern: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per piece: its place in its document and in its sequence, and its ids if asked for."""
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> RunCache:
            return RunCache(pattern, piece_encoder(shared.value))

        cache = kept(("tokenizer", hashlib.sha256(shared.value.encode()).digest(), pattern), fresh)
        packer, rows, base = Packer(length), [], TaskContext.get().partitionId() << 40

        def close(pieces: list[tuple]) -> None:
            offset = 0
            for (doc_id, ids), start, size in pieces:
                part = ids[4 * start:4 * (start + size)]
                rows.append((doc_id, start, size, zlib.crc32(part), len(ids) // 4, base + packer.made, offset, part if with_ids else None))
                offset += size
            packer.made += 1

        def flush() -> pa.RecordBatch:
            cols = [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:7]]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            if with_ids:
                cols.append(pa.array([np.frombuffer(r[7], "<u4").astype(np.int32) for r in rows], pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for part in common.slices(batches, most=1 << 20, keeping=True):
            texts = [t or "" for t in part.column("text").to_pylist()]
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), cache.encode(texts), strict=True):
                doc = (doc_id, ids + b"\0\0\0\0")
                n = len(doc[1]) // 4
                whole = n - n % length
                for start in range(0, whole, length):
                    close([(doc, start, length)])
                if n > whole and (full := packer.place((doc, whole, n - whole))):
                    close(full)
            if rows:
                yield flush()
        for pieces in packer.rest():
            close(pieces)
        if rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
