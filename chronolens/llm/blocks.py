"""Documents in blocks of bounded size, and keys that buckets answer block by block.

A block is one row: ids ascending, texts end to end and compressed, all other columns
as an Arrow stream. Blocks are written once. A step sends each block's distinct keys
to buckets, a bucket answers every block in the block's own key order, and the block
is joined with its answers; neither texts nor positions go through a sort.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, grouped, slices, utf8, written

_LAST = np.iinfo(np.int64).max


class Block:
    """Documents of a block: ids ascending, texts end to end."""

    def __init__(self, docs: bytes, offsets: bytes, text: bytes) -> None:
        self.docs, self.offsets = np.frombuffer(docs, "<i8"), np.frombuffer(offsets, "<i8")
        self.raw = np.frombuffer(zstandard.decompress(text, max_output_size=max(1, int(self.offsets[-1]))) if len(text) else b"", np.uint8)
        self.lengths = np.diff(self.offsets)
        #: Rank of each document's id, the same for equal ids.
        self.rank = np.searchsorted(self.docs, self.docs).astype(np.int32)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return self.rank[np.searchsorted(self.offsets[1:], at, side="right")] if len(at) else np.zeros(0, np.int32)


def planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes, byte by byte, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), 1)


def unplaned(data: bytes, width: int) -> np.ndarray:
    raw = zstandard.decompress(data)
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def ascending(values: np.ndarray) -> bytes:
    """Sorted values as differences, which take few of their bytes."""
    return planes(np.diff(values, prepend=np.uint64(0)), 8)


def unascending(data: bytes) -> np.ndarray:
    return np.cumsum(unplaned(data, 8), dtype=np.uint64)


def written_blocks(docs: DataFrame, size: int, name: str) -> tuple[DataFrame, str]:
    """The table of blocks of about ``size`` bytes of text, and its path; null ids come last."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            table = table.set_column(table.schema.get_field_index("text"), "text", table.column("text").cast(pa.large_string()))
            table = table.take(pc.sort_indices(table.column("doc_id"), null_placement="at_end"))
            ids = table.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy()
            raw, offsets = utf8(table.column("text").combine_chunks())
            sink = pa.BufferOutputStream()
            others = table.drop_columns(["text"])
            with pa.ipc.new_stream(sink, others.schema) as out:
                out.write_table(others)
            shrunk = [zstandard.compress(x, 3) for x in (raw.tobytes(), sink.getvalue().to_pybytes())]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in (ids.astype("<i8").tobytes(), offsets.astype("<i8").tobytes(), *shrunk)]],
                names=["block", "docs", "offsets", "text", "rest"])

        for batch in slices(batches, most=size):
            held.append(batch)
            total += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if total >= size:
                yield packed()
                number, held, total = number + 1, [], 0
        if any(len(b) for b in held):
            yield packed()

    return written(arrow(docs.select(*rest, "text"), run, "block long, docs binary, offsets binary, text binary, rest binary"), name)


def blocks_of(batch: pa.RecordBatch, kind: type = Block):
    """(row, block) for each row of a batch; an ``answer`` column becomes a dict by bucket."""
    for i in range(len(batch)):
        row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
        if "answer" in row:
            row["answer"] = {x["bucket"]: x["bits"] for x in row["answer"] or []}
        yield row, kind(row["docs"], row["offsets"], row["text"])


def answered(keys: DataFrame, answer, name: str) -> tuple[DataFrame, str]:
    """One bucket at a time through ``answer``; then each block's answers side by side."""
    bits, path = written(grouped(keys, "bucket", answer, "block long, bucket int, bits binary"), name)
    return bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answer")), path


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose tables are written."""
    gc.collect()
    spark._jvm.System.gc()
