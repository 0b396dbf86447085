"""Helpers shared by the operators: shared folder, table reads, text slices, hashed word streams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemill.session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step of a task holds.
SLICE_BYTES = 8 << 20
#: Bytes hashed with one table of powers.
_SPAN = 1 << 18

#: What a Python worker keeps for later tasks of the operator that made it (see ``pretokens.kept``).
KEPT: dict[tuple, object] = {}

_U = np.uint64
#: ASCII white space; a word is a run of other bytes, `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WHITE = " \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a Parquet table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and reread: cuts the lineage and fixes the rows."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), in place on a fresh array."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    x ^= x >> _U(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or have.size < n:
        size = max(n, _SPAN)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            table_ = np.full(size, base, dtype=np.uint64)
            table_[0] = 1
            _POWERS[key] = np.multiply.accumulate(table_)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every span; spans come in order of their ends, none is empty."""
    hashes = np.empty(starts.size, dtype=np.uint64)
    at = 0
    while at < starts.size:
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + _SPAN, side="right")))
        low, high = int(starts[at:to].min()), int(ends[to - 1])
        up, down = _powers(high - low + 1)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[raw[low:high]] * up[:high - low], out=total[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = (total[e] - total[s]) * down[s]
        at = to
    return mix(hashes)


class Words:
    """The words of a slice of texts: their hashes in order, and where each document's words begin."""

    __slots__ = ("hashes", "offsets", "starts", "ends")

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.hashes, self.offsets, self.starts, self.ends = hashes, offsets, starts, ends


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset:] if offs else np.zeros(1, np.int64)
    if not len(texts):
        offsets = np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return np.frombuffer(raw.tobytes().lower(), dtype=np.uint8)


def words(raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> Words:
    """Split every text into words and hash each (64 bits, by its bytes alone); ``gap`` marks the bytes between."""
    n = raw.size
    solid = np.zeros(n + 1, dtype=bool)
    np.logical_not(gap[raw], out=solid[:n])
    first = np.zeros(n + 1, dtype=bool)          # a text begins here: no word crosses it
    first[offsets] = True
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first))
    ends = np.flatnonzero(before & (~solid | first))
    return Words(span_hashes(raw, starts, ends), np.searchsorted(starts, offsets), starts, ends)


_STEP = 0xD6E8FEB86659FD93


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` codes (order matters), by doubling; shorter input gives none."""
    if codes.size < size:
        return np.zeros(0, np.uint64)
    part, width, done, out = codes, 1, 0, None
    while True:
        if size & width:
            tail = part[done:done + codes.size - size + 1]
            out = tail.copy() if out is None else out * _U(pow(_STEP, width, 1 << 64)) + tail
            done += width
        if done == size:
            return mix(out)
        part = part[:-width] * _U(pow(_STEP, width, 1 << 64)) + part[width:]
        width *= 2


def starts_inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """Mask over all run starts: the run of ``size`` lies in one document."""
    total = int(offsets[-1])
    if total < size:
        return np.zeros(0, bool)
    end = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(total - size + 1) + size <= end[:total - size + 1]


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Mask of the positions that a run of ``size`` beginning at one of the (distinct) ``starts`` covers."""
    edge = np.zeros(total + 1, np.int32)
    edge[starts] += 1
    edge[starts + size] -= 1
    return np.cumsum(edge[:total], dtype=np.int32) > 0


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES,
           keeping: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one slice holds about ``most`` bytes of text (or one longer text).

    A worker serves one operator after another: tasks not ``keeping`` what an earlier one kept drop it first.
    """
    if not keeping:
        KEPT.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (0/1 or counts) for each document."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]
