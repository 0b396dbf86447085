"""Documents dealt into blocks of text, and bit answers sent back to them.

Operators that compare every position of every text with all others keep the texts in blocks: rows
of about ``BLOCK_BYTES`` of text, written once as a table bucketed by block id in the shared folder.
A pass over the blocks sends codes to groups, the groups answer with bits, and the answers are joined
back by block id without moving the texts again. A block's rows never change once written, so a pass
that is repeated after a lost executor sees the same positions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import common
from tidemill.session import ensure_checkpoint_dir

#: Bytes of text in a block (a longer text is a block of its own).
BLOCK_BYTES = 2 << 20
#: Cells of the histogram of codes that a block counts.
CELLS = 1024


def blocked(docs: DataFrame, cells_of: Callable[[pa.Array], np.ndarray], others: list[str] | None = None) -> DataFrame:
    """A table (block, texts, doc_ids, cells) over ``docs`` (doc_id, text), bucketed by block.

    ``cells_of`` gives the cell of every code of some texts; a block carries their histogram. With
    ``others`` (names of more columns, maybe none) it also carries those columns as a list of rows, and
    which texts are null.
    """
    spark = docs.sparkSession
    rest = others or []
    wide = others is not None
    row_type = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in rest) or "_none: int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        for part in common.slices(batches, most=BLOCK_BYTES):
            given = part.column("text").cast(pa.string())
            texts = given.fill_null("")
            counts = np.bincount(cells_of(texts), minlength=CELLS).astype(np.int64)
            cols = [pa.array([block], pa.int64()), one(texts), one(part.column("doc_id")), pa.array([counts.tobytes()], pa.binary())]
            names = ["block", "texts", "doc_ids", "cells"]
            if wide:
                fields = [part.column(c) for c in rest] or [pa.nulls(len(given), pa.int32())]
                cols += [one(pa.StructArray.from_arrays(fields, names=rest or ["_none"])), one(given.is_null())]
                names += ["others", "nulls"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
            block += 1

    name = f"blocks_{uuid.uuid4().hex}"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, texts array<string>, doc_ids array<{id_type}>, cells binary" + f", others array<struct<{row_type}>>, nulls array<boolean>" * wide
    (docs.select("doc_id", "text", *rest).mapInArrow(run, schema)
     .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option("compression", "zstd")
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name)


def histogram(table: DataFrame) -> np.ndarray:
    """The blocks' summed cell counts: one number a cell for the driver, whatever the input's size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for raw in batch.column("cells").to_pylist():
                total += np.frombuffer(raw, np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["cell", "n"])

    out = np.zeros(CELLS, np.int64)
    for row in table.select("cells").mapInArrow(add, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out


class Groups:
    """Memory-sized groups from a histogram: neighbouring small cells share one, a large cell has several.

    A code's group follows from its cell and, in a large cell, from a second hash.
    """

    def __init__(self, counts: np.ndarray, most: int):
        self.first = np.zeros(len(counts), np.int64)
        self.parts = np.ones(len(counts), np.int64)
        group, room = -1, 0
        for cell, n in enumerate(counts.tolist()):
            if n > most:
                self.parts[cell] = -(-n // most)
                self.first[cell] = group + 1
                group, room = group + int(self.parts[cell]), 0
            else:
                if n > room or group < 0:
                    group, room = group + 1, most
                self.first[cell] = group
                room -= n

    def of(self, cells: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.first[cells] + ((second >> np.uint64(20)) % self.parts[cells].astype(np.uint64)).astype(np.int64)


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, pa.Array, dict]]:
    """(block, texts, doc ids, other columns) of every row."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in batch.schema.names}
            yield row["block"].as_py(), row.pop("texts").values, row.pop("doc_ids").values, row


def with_answers(table: DataFrame, more: list[str] | None = None, **answers: DataFrame) -> DataFrame:
    """Every block (and ``more`` of its columns) with its answers by name, lists of ``(grp, bits)`` or null."""
    out = table.select("block", "texts", "doc_ids", *(more or []))
    for name, given in answers.items():
        out = out.join(given.groupBy("block").agg(F.collect_list(F.struct("grp", "bits")).alias(name)), "block", "left")
    return out


def answers_of(row: dict, name: str) -> dict[int, bytes]:
    """Group to bits of one row of ``with_answers``."""
    return {a["grp"]: a["bits"] for a in row[name].as_py() or ()}


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)
