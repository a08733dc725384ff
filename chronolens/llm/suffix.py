"""Suffix-array dedup of byte strings that repeat across documents.

Every ``LENGTH``-byte string that also starts in a document with a smaller doc_id is
removed. The work follows difference-cover blockwise suffix sorting:

1. A difference cover D modulo v samples the suffixes: for any two positions i, j
   some d < v puts both i + d and j + d on samples. So two equal strings of
   ``LENGTH`` bytes have a pair of equal samples, at the same place in both, that are
   LENGTH - v + 1 bytes long. The samples are ranked first, one bucket of keys at a
   time: all that matters of a rank here is whether a sample has an equal in another
   document.
2. Only suffixes whose reach of v positions holds such a sample can have a long tie.
   They are dealt into buckets, ranges of a 64-bit key of the string, and one bucket at
   a time is sorted; ties of ``LENGTH`` bytes are told by that key and a second hash of
   four bytes or more, as the input's size asks (``check_bytes``). As the key is of all
   ``LENGTH`` bytes, a start that very many strings share does not fill one bucket.
   (Shipping the cover ranks of all residues with each suffix, to compare bytes and
   ranks pairwise, would cost 41 bytes a suffix in place of 12.)
3. Each tied class's smallest doc_id decides its members, and each document's
   removed bytes are the union of its removed strings.

Texts lie in blocks of bounded size, written once. Buckets answer each block with
one bit a key, in the block's own key order, so that neither texts nor positions go
through the sort. Keys are distinct within a block before they are sent: a group of
copies of any size sends as many keys as it touches blocks.

Defined results: null texts are empty; null doc_ids come after all others; rows with
the same doc_id never remove from one another; texts shorter than ``LENGTH`` keep
all; an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import Block, answered, ascending, blocks_of, planes, release, unascending, unplaned, written_blocks
from .common import _BASE, arrow, drop, grouped, mixed, powers, ship, written

LENGTH = 50
#: Fixed value: a perfect difference set modulo 21; every nonzero residue is a difference exactly once.
COVER, MODULUS = (3, 6, 7, 12, 14), 21
BLOCK = 2 << 20  # bytes of text in a block
BUCKET = 8 << 20  # bytes of text for each bucket of keys
PASSES = 2  # shares of the buckets that are sorted one after the other, which divides the keys on disk at a time
_SEGMENT = 1 << 16  # positions hashed at a time

_PLAIN = np.arange(1, 257, dtype=np.uint64)
_OTHER = mixed(_PLAIN)  # of the second hash

_back = np.ones(1, np.uint64)


def _backwards(n: int) -> np.ndarray:
    """Powers of the inverse of ``powers``' base."""
    global _back
    if len(_back) < n:
        _back = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        _back[0] = 1
        _back = np.multiply.accumulate(_back)
    return _back[:n]


def window_keys(raw: np.ndarray, at: np.ndarray, length: int, values: np.ndarray = _PLAIN, kind: type = np.uint64, shift: int = 0) -> np.ndarray:
    """A 64-bit key of the ``length`` bytes from each position of ``at``, which ascends; ``values`` stand for the bytes."""
    out = np.zeros(len(at), kind)
    for lo in range(0, len(raw), _SEGMENT):
        a, b = np.searchsorted(at, [lo, lo + _SEGMENT])
        if a == b:
            continue
        part = raw[lo:lo + _SEGMENT + length]
        total = np.zeros(len(part) + 1, np.uint64)
        np.add.accumulate(values[part] * powers(len(part)), out=total[1:])
        own = at[a:b] - lo
        out[a:b] = mixed((total[own + length] - total[own]) * _backwards(len(part))[own]) >> np.uint64(shift)
    return out


class CoverBlock(Block):
    """A block with its cover samples."""

    def samples(self, length: int) -> np.ndarray:
        """Positions on the cover that have a sample's length of text."""
        size = length - MODULUS + 1
        on = np.zeros(MODULUS, bool)
        on[list(COVER)] = True
        reach = int(self.lengths.max(initial=0))
        pattern = np.flatnonzero(np.resize(on, reach))
        counts = np.searchsorted(pattern, np.maximum(self.lengths - size + 1, 0))
        start = np.cumsum(counts) - counts
        return pattern[np.arange(counts.sum()) - np.repeat(start, counts)] + np.repeat(self.offsets[:-1], counts)


def check_bytes(size: int) -> int:
    """Bytes of the second hash, so that ``size`` strings hold two unlike ones with equal keys with odds below 2**-32."""
    return min(8, max(4, -(-(2 * size.bit_length() - 32) // 8)))


def sort_keys(keys: np.ndarray, checks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, by their checks where they are equal, and which of the sorted ones differ from the one before."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if checks is not None:
        again = np.flatnonzero(~new)
        if (checks[order[again]] != checks[order[again - 1]]).any():
            order = np.lexsort((checks, keys))
            new[1:] = (keys[order[1:]] != keys[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
    return order, new


class Keys:
    """Distinct keys of some positions, sorted; ``first`` has the smallest document rank of each."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray, checks: np.ndarray | None = None) -> None:
        self.order, new = sort_keys(keys, checks)
        begin = np.flatnonzero(new)
        self.distinct = keys[self.order[begin]]
        self.checks = None if checks is None else checks[self.order[begin]]
        self.of = np.cumsum(new) - 1  # which distinct key, by sorted position
        docs = docs[self.order]
        self.docs = docs
        self.first = np.minimum.reduceat(docs, begin) if len(begin) else docs[:0]
        self.last = np.maximum.reduceat(docs, begin) if len(begin) else docs[:0]


def _sample_keys(block: CoverBlock, length: int, bits: int) -> tuple[np.ndarray, Keys]:
    at = block.samples(length)
    return at, Keys(window_keys(block.raw, at, length - MODULUS + 1) >> np.uint64(64 - bits), block.doc_of(at))


def _range_cuts(distinct: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each bucket begins among sorted keys; buckets are ranges of their 32 high bits."""
    top = (distinct >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(top, np.arange(buckets + 1, dtype=np.uint64))


def _candidates(block: CoverBlock, length: int, bits: int, buckets: int, answer: dict[int, bytes]) -> np.ndarray:
    """Positions of the suffixes that reach a sample with an equal in another document."""
    at, keys = _sample_keys(block, length, bits)
    tied = keys.first != keys.last
    cuts = _range_cuts(keys.distinct, buckets, bits)
    for b, said in answer.items():
        tied[cuts[b]:cuts[b + 1]] |= np.unpackbits(np.frombuffer(said, np.uint8), count=cuts[b + 1] - cuts[b]).astype(bool)
    hit = at[keys.order[tied[keys.of]]]
    hit.sort()
    doc = np.searchsorted(block.offsets[1:], hit, side="right")
    size = len(block.raw) + 1
    step = np.bincount(np.maximum(hit - MODULUS + 1, block.offsets[doc]), minlength=size) - np.bincount(hit + 1, minlength=size)
    own = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    end = block.offsets[np.searchsorted(block.offsets[1:], own, side="right") + 1] if len(own) else own
    return own[own + length <= end]


class Suffixes:
    """The candidate suffixes of a block, sorted by their string's key; ``place`` are those of the buckets
    of share ``turn`` of ``passes``, or all. A bucket is a range of the keys."""

    def __init__(self, block: CoverBlock, at: np.ndarray, length: int, buckets: int, check: int, passes: int = 1, turn: int = 0) -> None:
        keys = window_keys(block.raw, at, length)
        if passes > 1:
            self.place = np.flatnonzero(((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)) % np.uint64(passes) == np.uint64(turn))
            keys = keys[self.place]
        else:
            self.place = np.arange(len(at))
        own = at[self.place]
        self.keys = Keys(keys, block.doc_of(own), window_keys(block.raw, own, length, _OTHER, np.uint32 if check <= 4 else np.uint64, 64 - 8 * check))
        self.cuts = _range_cuts(self.keys.distinct, buckets, 64)
        self.buckets = np.flatnonzero(np.diff(self.cuts)).tolist()


def _named(first: np.ndarray, docs: np.ndarray) -> tuple[bytes, bytes]:
    """Ranks of documents as places among the ids that they name, and those ids."""
    named = np.zeros(len(docs), bool)
    named[first] = True
    return planes((np.cumsum(named) - 1)[first], 4), planes(np.diff(docs[named], prepend=np.int64(0)).view(np.uint64), 8)


def dedup(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, bucket: int = BUCKET, passes: int = PASSES) -> DataFrame:
    """The rows of ``docs`` with a struct ``dedup``: n_bytes, n_removed, n_spans, kept_sha256,
    spans (of removed bytes) and text (what is left; a character cut by a span's edge stays whole)."""
    ship(docs.sparkSession)
    if length < MODULUS + 8:
        raise ValueError(f"length must be at least {MODULUS + 8}")
    spark = docs.sparkSession
    docs = docs.select([c for c in docs.columns if c != "dedup"])
    blocks, block_path = written_blocks(docs, block, "suffix-blocks")
    size = blocks.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    total = 3 * size  # about what the compressed texts hold
    buckets = max(4, -(-total // bucket))
    check = check_bytes(total)
    bits = min(64, max(32, (total // 4).bit_length() + 9))  # of a sample's key: few unequal ones share it, and then only cost work

    # a block's arrays are local to a call, so that they are gone when the next block's are made
    def asked_of(row: dict, own: CoverBlock) -> pa.RecordBatch:
        _, keys = _sample_keys(own, length, bits)
        cuts = _range_cuts(keys.distinct, buckets, bits)
        some = np.flatnonzero(np.diff(cuts)).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([row["block"]] * len(some), pa.int64()), pa.array([ascending(keys.distinct[cuts[b]:cuts[b + 1]]) for b in some], pa.binary())],
            names=["bucket", "block", "keys"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, own in blocks_of(batch, CoverBlock):
                yield asked_of(row, own)

    def rank_samples(table: pa.Table) -> pa.Table:
        parts = [unascending(x.as_py()) for x in table.column("keys")]
        keys = np.concatenate(parts)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        del parts
        order = np.argsort(keys)
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]  # keys are distinct within a block
        tied = np.zeros(len(keys), bool)
        tied[order[1:][same]] = True
        tied[order[:-1][same]] = True
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array([np.packbits(x).tobytes() for x in np.split(tied, cuts)], pa.binary())})

    lean = ["block", "docs", "offsets", "text"]
    asked = arrow(blocks.select(*lean), ask, "bucket int, block long, keys binary")
    ranked, rank_path = answered(asked, rank_samples, "cover-ranks")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.column("rest")
            for i, (row, own) in enumerate(blocks_of(batch.drop_columns(["rest"]), CoverBlock)):
                at = _candidates(own, length, bits, buckets, row["answer"])
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([row[c]], pa.int64() if c == "block" else pa.binary()) for c in lean], rest.slice(i, 1), pa.array([ascending(at.astype(np.uint64))], pa.binary())],
                    names=[*lean, "rest", "at"])

    marked, _ = written(arrow(blocks.join(ranked, "block", "left"), mark, "block long, docs binary, offsets binary, text binary, rest binary, at binary"), "suffix-marked")
    drop(spark, block_path, rank_path)
    release(spark)

    def sent_of(row: dict, own: CoverBlock, turn: int) -> pa.RecordBatch:
        own_keys = Suffixes(own, unascending(row["at"]).astype(np.int64), length, buckets, check, passes, turn)
        some, keys = own_keys.buckets, own_keys.keys
        parts = [slice(own_keys.cuts[b], own_keys.cuts[b + 1]) for b in some]
        named = [_named(keys.first[x], own.docs) for x in parts]
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([row["block"]] * len(some), pa.int64()), pa.array([ascending(keys.distinct[x]) for x in parts], pa.binary()),
             pa.array([planes(keys.checks[x], check) for x in parts], pa.binary()), *[pa.array([n[i] for n in named], pa.binary()) for i in (0, 1)]],
            names=["bucket", "block", "keys", "checks", "first", "docs"])

    def send(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, own in blocks_of(batch, CoverBlock):
                    yield sent_of(row, own, turn)

        return run

    def tie(table: pa.Table) -> pa.Table:
        parts = [unascending(x.as_py()) for x in table.column("keys")]
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        keys = np.concatenate(parts)
        del parts
        order, new = sort_keys(keys, np.concatenate([unplaned(x.as_py(), check).astype(np.uint32 if check <= 4 else np.uint64) for x in table.column("checks")]))
        del keys
        ids = np.concatenate([np.cumsum(unplaned(d.as_py(), 8).view(np.int64))[unplaned(f.as_py(), 4).astype(np.int64)] for f, d in zip(table.column("first"), table.column("docs"))])[order]
        begin = np.flatnonzero(new)
        later = np.zeros(len(ids), bool)
        later[order] = np.repeat(np.minimum.reduceat(ids, begin), np.diff(begin, append=len(ids))) < ids
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array([np.packbits(x).tobytes() for x in np.split(later, cuts)], pa.binary())})

    tied = None
    for turn in range(passes):  # a share of the buckets at a time, whose keys are gone before the next
        asked = arrow(marked.select(*lean, "at"), send(turn), "bucket int, block long, keys binary, checks binary, first binary, docs binary")
        share, _ = written(grouped(asked, "bucket", tie, "block long, bucket int, bits binary"), "suffix-ties")
        tied = share if tied is None else tied.unionAll(share)
        release(spark)
    tied = tied.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answer"))

    found = T.StructType([
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("text", T.StringType())])
    order = [c for c in docs.columns if c != "text"]

    def removed(block: CoverBlock, at: np.ndarray, said: dict[int, bytes]) -> np.ndarray:
        """Positions of the removed strings; a share of the buckets at a time, as they were sent."""
        gone = np.zeros(len(at), bool)
        for turn in range(passes):
            own = Suffixes(block, at, length, buckets, check, passes, turn)
            keys = own.keys
            later = np.zeros(len(keys.distinct), bool)
            for b in own.buckets:
                lo, hi = own.cuts[b], own.cuts[b + 1]
                later[lo:hi] = np.unpackbits(np.frombuffer(said[b], np.uint8), count=hi - lo)
            gone[own.place[keys.order]] = later[keys.of] | (keys.docs > keys.first[keys.of])
            del own, keys, later
        return at[gone]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, own in blocks_of(batch, CoverBlock):
                starts = removed(own, unascending(row["at"]).astype(np.int64), row["answer"])
                rest = pa.ipc.open_stream(zstandard.decompress(row["rest"])).read_all().combine_chunks()
                others = [rest.column(c).combine_chunks() for c in order]
                for lo in range(0, len(rest), 2000):
                    some = _results(own, starts, length, lo, min(lo + 2000, len(rest)))
                    yield pa.RecordBatch.from_arrays([*[c.slice(lo, 2000) for c in others], some], names=[*order, "dedup"])

    schema = T.StructType([*[docs.schema[c] for c in order], T.StructField("dedup", found)])
    return arrow(marked.join(tied, "block", "left"), cut, schema)


_FOUND = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("text", pa.string())])


def _results(block: CoverBlock, starts: np.ndarray, length: int, lo: int, hi: int) -> pa.Array:
    """The struct of each document from ``lo`` to ``hi``, given the removed strings' positions."""
    bounds = np.searchsorted(starts, block.offsets)
    out = []
    for d in range(lo, hi):
        a, b = int(block.offsets[d]), int(block.offsets[d + 1])
        own = starts[bounds[d]:bounds[d + 1]] - a
        raw = block.raw[a:b]
        if len(own):
            apart = np.flatnonzero(np.diff(own) > length)
            spans = list(zip(own[np.r_[0, apart + 1]].tolist(), (own[np.r_[apart, len(own) - 1]] + length).tolist()))
        else:
            spans = []
        data, last, digest, text, then = raw.tobytes(), 0, hashlib.sha256(), [], 0
        for s, e in spans:
            digest.update(data[last:s])
            last = e
            while s < e and data[s] & 0xC0 == 0x80:
                s += 1
            while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
                e -= 1
            text.append(data[then:s])
            then = e
        digest.update(data[last:])
        text.append(data[then:])
        out.append({"n_bytes": b - a, "n_removed": sum(e - s for s, e in spans), "n_spans": len(spans), "kept_sha256": digest.hexdigest(),
                    "spans": [{"start": s, "end": e} for s, e in spans], "text": b"".join(text).decode()})
    return pa.array(out, _FOUND)
