"""SimHash near-duplicates by anchor-point covering.

The anchors are the codewords of a covering code. The first 46 bits of a 64-bit
fingerprint are two segments of 23 bits, and each segment is covered by the
binary Golay code: every 23-bit word lies within distance 3 of exactly one
codeword. A fingerprint's home is the pair of its nearest codewords. Two
fingerprints x, y at distance t or less differ by e1 and e2 bits in the segments,
e1 + e2 <= t, so that y lies within 3 + e1 and 3 + e2 of x's home. So each
fingerprint is replicated to all anchors whose distances go beyond the covering
radius by t together (61 on average for t = 2), and homes are compared with
visitors anchor by anchor. No pair is missed and none is compared by chance.

Equal fingerprints are one row before replication, so that a group of copies of
any size is one visitor. Distinct fingerprints within distance 2 number at most
2,080, so that links grow with the number of fingerprints and never with the
square of a group.

Defined results: null and empty texts have no words and fingerprint zero, linked
like any other; texts with fewer words than the shingle length have one shingle;
repeated rows are repeated; null doc_ids count as larger than any and get a null
component_id only if nothing else is in their component; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, slices, written
from .components import components

SHINGLE, SEED, DISTANCE = 3, 42, 2
_PIECE = 1 << 16  # hashes whose bits are counted at once

#: Fixed value: the generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
_BITS, _CHECK = 23, 11


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint: a bit is 1 if it is set in over half the shingles' hashes."""
    words = text.lower().split()  # on bytes, both know ASCII alone
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _PIECE):
        ones += np.unpackbits(hashes[i:i + _PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp): the text's own hash and the fingerprint's bits, as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = batch.column("text").cast(pa.large_binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in raw], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(fps)], names=["doc_id", "text_key", "fp"])

    return arrow(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), run, "doc_id long, text_key long, fp long")


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator: zero for codewords."""
    words = words.astype(np.int64)
    for bit in range(_BITS - 1, _CHECK - 1, -1):
        words = words ^ (((words >> bit) & 1) * (GOLAY << (bit - _CHECK)))
    return words


@functools.cache
def coset_table(distance: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of weight up to 3 + ``distance`` with it, and by how
    much their weight goes beyond 3; rows are padded with an excess that no limit admits."""
    patterns = np.array([sum(1 << b for b in c) for w in range(4 + distance) for c in combinations(range(_BITS), w)], np.int64)
    excess = np.array([max(0, w - 3) for w in range(4 + distance) for _ in combinations(range(_BITS), w)], np.int8)
    at = syndromes(patterns)
    by = np.argsort(at, kind="stable")
    patterns, excess, at = patterns[by], excess[by], at[by]
    counts = np.bincount(at, minlength=1 << _CHECK)
    column = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    table, over = np.zeros((1 << _CHECK, counts.max()), np.int64), np.full((1 << _CHECK, counts.max()), 99, np.int8)
    table[at, column], over[at, column] = patterns, excess
    return table, over


def anchors(fps: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home): every anchor that each fingerprint visits; ``home`` marks its own.

    An anchor is the pair of messages of its two codewords, 24 bits."""
    table, over = coset_table(distance)
    rows, keys, homes = [], [], []
    mask = (1 << _BITS) - 1
    for i in range(0, len(fps), 4096):
        part = fps[i:i + 4096].view(np.uint64).astype(np.uint64)
        a, b = (part & np.uint64(mask)).astype(np.int64), ((part >> np.uint64(_BITS)) & np.uint64(mask)).astype(np.int64)
        sa, sb = syndromes(a), syndromes(b)
        beyond = over[sa][:, :, None] + over[sb][:, None, :]
        r, x, y = np.nonzero(beyond <= distance)
        left, right = (a[r] ^ table[sa[r], x]) >> _CHECK, (b[r] ^ table[sb[r], y]) >> _CHECK
        rows.append(r + i)
        keys.append((left << 12) | right)
        homes.append(beyond[r, x, y] == 0)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v): pairs u < v of the distinct fingerprints in column fp that differ in at most ``distance`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fp").to_numpy()
            for i in range(0, len(own), 1 << 14):
                part = own[i:i + (1 << 14)]
                row, anchor, home = anchors(part, distance)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(part[row]), pa.array(home)], names=["anchor", "fp", "home"])

    visits = arrow(fps.select("fp"), run, "anchor int, fp long, home boolean")
    homes = visits.where("home").select("anchor", F.col("fp").alias("u"))
    near = (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance) & (F.col("u") < F.col("v"))
    # the smaller one's home sees each pair, so that each comes out once
    return homes.join(visits.select("anchor", F.col("fp").alias("v")).hint("merge"), "anchor").where(near).select("u", "v")


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id): the component's smallest fingerprint, and the smallest doc_id reachable over links."""
    rows, _ = written(fingerprints(docs, shingle), "fingerprints")
    distinct, _ = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = components(links(distinct, distance))
    # the component's node is its smallest fingerprint; its id is the smallest doc_id of all its fingerprints
    nodes = distinct.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id): the smallest doc_id reachable over links."""
    return grouped(docs, shingle, distance).select("doc_id", "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest doc_id, of its repeats the one
    with the smallest text hash. Columns pass through."""
    found = grouped(docs, shingle, distance)
    # component_id does not tell components apart: it may be null, and a repeated doc_id may be in several; the root does
    mine = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id").agg(F.min("text_key").alias("__key"))
    kept, _ = written(mine.select(F.col("component_id").alias("__id"), "__key"), "kept")
    rows = docs.withColumn("__row_key", F.xxhash64("text")).join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row_key") == F.col("__key")), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id", "__row_key").orderBy("doc_id"))
    return rows.withColumn("__first", first).where("__first = 1").select(docs.columns)
