"""Shared helpers: the scratch folder, written tables, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Unset on a local master, as in tests: one temporary folder a process.
    Unset on a cluster: an error, since a local folder would lose rows there.
    """
    global _local_dir
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = "file://" + tempfile.mkdtemp(prefix="chronolens-llm-")
    return _local_dir


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder; returns the table and its path.

    Cuts the lineage: a lost executor costs a reread, not the work before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    write(df, path)
    return spark.read.schema(df.schema).parquet(path), path


def written_by(df: DataFrame, name: str, by: str, buckets: int) -> tuple[DataFrame, str]:
    """As ``written``, in Spark's buckets by a column: a later step by this column reads the rows without a shuffle.

    The catalog keeps no entry: a plan that was made holds what it needs."""
    spark = df.sparkSession
    own = f"{name}-{uuid.uuid4().hex}"
    path, table = f"{shared_dir(spark)}/llm/{own}", own.replace("-", "_")
    write(df, path, lambda out: out.bucketBy(buckets, by).option("path", path).saveAsTable(table))
    out = spark.table(table)
    out.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {table}")  # its files stay, as their place was given
    return out, path


def write(df: DataFrame, path: str, save=None) -> None:
    """Write Parquet files; the shuffle files that this took go as soon as it is done."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        out = df.write.format("parquet").option("compression", "zstd")
        save(out) if save else out.save(path)
    finally:
        spark.conf.set(key, before)


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove written tables that no later step reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="chronolens-code-"), "chronolens_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
    context.addPyFile(path)
    # texts differ in length by far: batches to the workers are bounded by bytes, not by rows alone
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    _shipped.add(context.applicationId)


def tidy() -> None:
    """Give back the memory that this process has freed."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors; a worker gives back the memory that a partition took."""
    ship(df.sparkSession)

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        tidy()

    return df.mapInArrow(tidied, schema)


def grouped(df: DataFrame, by: str, run, schema) -> DataFrame:
    """``applyInArrow`` for each value of ``by``; a worker gives back the memory that a group took, also while it waits for work."""
    ship(df.sparkSession)

    def tidied(table: pa.Table) -> pa.Table:
        out = run(table)
        tidy()
        return out

    return df.groupBy(by).applyInArrow(tidied, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and the n + 1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(column) else raw[:0], offsets - offsets[0]


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column out of ``data`` (any item size) cut at ``offsets`` (in items)."""
    data = np.ascontiguousarray(data)
    ends = (np.asarray(offsets, np.int64) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(text).cast(pa.large_string())).fill_null(0), np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(part)]):
            if b > a:
                yield batch.slice(a, b - a)


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words ``[^\\x20\\x09-\\x0D]+`` in texts laid end to end."""
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(raw)]
    first[cut] |= inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z in UTF-8 bytes, nothing else."""
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


_POWERS = np.ones(1, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd 64-bit base, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 1024), _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct words among some spans, which ascend and do not overlap, and which of them each span is.

    Words are told apart by their bytes, in Arrow's dictionary encoding."""
    n = len(starts)
    if not n:
        return [], np.zeros(0, np.int64)
    cuts = np.empty(2 * n, np.int64)
    cuts[::2], cuts[1::2] = starts, ends
    # words and what lies between them, in turn
    all_ = pa.Array.from_buffers(pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))])
    coded = all_.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


_SHORT = 7  # bytes of a word that a 64-bit key holds whole, with the word's length


def short_keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of words of at most 7 bytes: their bytes, and their length in the highest byte."""
    padded = np.append(raw, np.zeros(8, np.uint8))
    eight = np.ndarray((len(raw) + 1,), np.dtype("<u8"), padded, strides=(1,))[starts]
    size = (ends - starts).astype(np.uint64)
    return eight & ((np.uint64(1) << (np.uint64(8) * size)) - np.uint64(1)) | size << np.uint64(56)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word: no two alike among words of at most 7 bytes, XXH3 of the bytes of longer ones."""
    out = np.zeros(len(starts), np.uint64)
    short = ends - starts <= _SHORT
    out[short] = mixed(short_keys(raw, starts[short], ends[short]))
    words, of = distinct(raw, starts[~short], ends[~short])
    out[~short] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[of]
    return out


class Known:
    """Ids of parts, by the parts' bytes: short parts by their keys in sorted arrays, longer ones in a dict."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.places, self.longer = np.zeros(0, np.uint64), np.zeros(0, np.int32), {}
        self.at, self.size, self.ids, self.used = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32), np.zeros(1 << 16, np.uint32), 0

    def __len__(self) -> int:
        return len(self.keys) + len(self.longer)

    def find(self, keys: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Places of some short and some longer parts, -1 for those that are not here."""
        out = np.full(len(keys) + len(words), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out[:len(keys)] = np.where(self.keys[at] == keys, self.places[at], -1)
        out[len(keys):] = [self.longer.get(w, -1) for w in words]
        return out

    def add(self, keys: np.ndarray, words: list[bytes], ids: list[np.ndarray]) -> None:
        """Parts that are new; ``keys`` ascend."""
        n, own = len(self), len(ids)
        size = np.array([len(x) for x in ids], np.int64)
        more = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        if self.used + len(more) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used // 2 + len(more), np.uint32)])
        if n + own > len(self.at):
            room = n // 2 + own
            self.at, self.size = np.concatenate([self.at[:n], np.zeros(room, np.int64)]), np.concatenate([self.size[:n], np.zeros(room, np.int32)])
        self.ids[self.used:self.used + len(more)] = more
        self.at[n:n + own], self.size[n:n + own] = self.used + np.cumsum(size) - size, size
        self.used += len(more)
        by = np.argsort(merged := np.concatenate([self.keys, keys]), kind="stable")
        self.keys, self.places = merged[by], np.concatenate([self.places, np.arange(n, n + len(keys), dtype=np.int32)])[by]
        self.longer.update(zip(words, range(n + len(keys), n + own)))

    def ids_of(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int, encode) -> list[np.ndarray]:
        """The ids of each of ``rows`` rows, given the parts they are made of; ``encode`` gives those of new parts."""
        short = ends - starts <= _SHORT
        begin = starts[short]
        keys, first, of_short = np.unique(short_keys(raw, begin, ends[short]), return_index=True, return_inverse=True)
        words, of_longer = distinct(raw, starts[~short], ends[~short])
        place = self.find(keys, words)
        new = place < 0
        if new.any():
            if len(self) and len(self) + new.sum() > self.most:
                self.clear()
                new[:] = True  # all of this call's at once, be they more than ``most``
            some = np.flatnonzero(new[:len(keys)])
            texts = [raw[b:b + k].tobytes() for b, k in zip(begin[first[some]].tolist(), (keys[some] >> np.uint64(56)).tolist())]
            longer = [w for w, x in zip(words, new[len(keys):].tolist()) if x]
            self.add(keys[some], longer, encode(texts + longer))
            place = self.find(keys, words)
        of = np.empty(len(starts), np.int64)
        of[short], of[~short] = of_short, of_longer + len(keys)
        at, each = self.at[place][of], self.size[place].astype(np.int64)[of]
        stop = np.cumsum(each)
        ids = self.ids[np.arange(stop[-1] if len(stop) else 0) + np.repeat(at - (stop - each), each)]
        cuts = np.concatenate([[0], stop])[np.searchsorted(row, np.arange(rows + 1))].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]
