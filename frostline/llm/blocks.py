"""Blocks: documents packed many to a row, for operators that read them often.

A block is a run of documents of one scan task, stored as one compressed Arrow
stream.  It is the unit that operators pre-aggregate over before a shuffle (a
passage repeated a thousand times within a block is sent once) and the unit to
which answers come back.  Packing happens next to the scan; the packed rows
are then dealt out by block id, about half the size of the texts, and every
further pass reads that exchange.

A block's id is the number of its task and its number within it, so tasks that
read the same rows still make blocks of their own.  The input must be a stored
table (or another source that deals the same rows to the same task when a lost
one is run again).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import give_back

#: Block size at one gigabyte of text.  It grows with the square root of the
#: input, so that the rows a block sends to each group keep their size.
BLOCK_BYTES_AT_1GB = 4 << 20
LARGEST_BLOCK = 256 << 20
SMALLEST_BLOCK = 1 << 18


class Layout:
    """Block size and group count for an input of ``text_bytes``."""

    def __init__(self, text_bytes: int):
        scale = max(text_bytes, 1) / 1e9
        self.block_bytes = int(min(LARGEST_BLOCK, max(SMALLEST_BLOCK, BLOCK_BYTES_AT_1GB * scale ** 0.5)))
        self.groups = max(8, -(-text_bytes // (4 * self.block_bytes)))


def layout_of(docs: DataFrame, text: str = "text") -> Layout:
    """One aggregate over the table; a single number reaches the driver."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"]
    return Layout(int(total or 0))


def pack(docs: DataFrame, layout: Layout, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``(block long, rows binary)``: whole documents, sorted by ``order`` within a block."""
    block_bytes = layout.block_bytes

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, block = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index(text)).to_numpy(zero_copy_only=False)
            begin = 0
            for i, value in enumerate(lengths):
                size += 64 + (len(value) if value is not None else 0)
                if size >= block_bytes:
                    held.append(batch.slice(begin, i + 1 - begin))
                    yield _row(block, held, order)
                    held, size, begin, block = [], 0, i + 1, block + 1
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield _row(block, held, order)

    packed = docs.mapInArrow(blocks, "block long, rows binary")
    return packed.repartition("block")


def _row(block: int, held: list[pa.RecordBatch], order: str) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    table = table.sort_by([(order, "ascending")])  # nulls last
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table.combine_chunks())
    data = sink.getvalue().to_pybytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["block", "rows"])


def unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def texts_of(table: pa.Table, text: str = "text") -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if v is None else v for v in table.column(text).cast(pa.binary()).to_pylist()]


def ids_of(table: pa.Table, column: str = "doc_id") -> np.ndarray:
    """Ids as int64; null comes after every id."""
    return table.column(column).cast(pa.int64()).fill_null((1 << 63) - 1).to_numpy()


def per_block(frame: DataFrame, columns: list[str], schema: str,
              work: Callable[..., Iterator[pa.RecordBatch]]) -> DataFrame:
    """``work(*values)`` for each row of ``columns``; yields the batches it makes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(columns))]
            for i in range(batch.num_rows):
                yield from work(*(a[i].as_py() for a in arrays))
                give_back()

    return frame.select(*columns).mapInArrow(run, schema)


def answers(blocks: DataFrame, frame: DataFrame, columns: list[str]) -> DataFrame:
    """Each block with what has come back for it: ``answers``, a list of structs.

    A block gets at most one answer from each group, so the list is bounded by
    the block's own size.
    """
    back = frame.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias("answers"))
    return blocks.join(back, "block", "left")
