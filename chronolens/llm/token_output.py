"""Token ids as binary blocks: canonical length-limited Huffman coding.

Texts are encoded with a public tokenizer, ids are counted over all documents,
and package-merge gives code lengths of at most ``LIMIT`` bits. Documents in
ascending doc_id order are packed into independent blocks. A block holds whole
documents, its bit stream, and the bit offset of every ``STEP``-th id, so that a
reader can start at any checkpoint. Decoding looks up ``LIMIT`` bits in a table;
all checkpoints of a block advance together as one numpy vector.

The file format is a folder with two Parquet tables: ``codebook`` (id, length)
and ``blocks`` (part, block, doc_ids, n_tokens, checkpoints, bits).

Defined results: a null text counts as empty and holds the end id alone; null
doc_ids come first; documents with the same doc_id are ordered by their ids'
crc32; an empty table gives no blocks. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Known, arrow, binary_column, drop, lowered, shared_dir, slices, utf8, word_spans, write, written

LIMIT = 20  # bits of the longest code; 2**LIMIT must be at least the number of distinct ids
STEP = 64  # ids from one checkpoint to the next
BLOCK = 1 << 18  # ids in a block, more if one document alone has more
_CACHE = 800_000  # parts of words whose ids a worker keeps

_PROBE = "Don't STOP  it, 2024-01-15: été (x+y)\n\tÜber the-house... ok"  # tells tokenizers with another split

_tokenizer: tuple[str, object] | None = None
_last = np.zeros(0, bool)  # of each id, whether its piece ends a word


def _load(path: str):
    global _tokenizer, _last
    if _tokenizer is None or _tokenizer[0] != path:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        _known.clear()
        _tokenizer = (path, tok)
        vocabulary = tok.get_vocab()
        _last = np.zeros(max(vocabulary.values()) + 1, bool)
        _last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        if not _last.any():
            raise ValueError(f"{path} has no pieces that end a word")
        if encode_texts(pa.array([_PROBE]), path)[0] != np.array(tok.encode(_PROBE, add_special_tokens=False).ids, np.uint32).tobytes():
            _tokenizer = None
            raise ValueError(f"{path} splits texts in another way than at white space, digits and runs of other signs, in lower case")
    return _tokenizer[1]


def part_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the parts of words that the tokenizer's own split separates: letters,
    single digits, runs of other signs. A word is left whole if it has an apostrophe (contractions), a
    ``<`` (special tokens), or a character beyond U+017F or that is none of these kinds."""
    starts, ends, _ = word_spans(raw, offsets)
    after = np.append(raw[1:], 0)
    odd = (raw == 0x27) | (raw == 0x3C) | (raw < 9) | ((raw > 13) & (raw < 32)) | (raw == 0x7F)
    odd |= (raw >= 0xC0) & ((raw < 0xC3) | (raw > 0xC5)) | (raw == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (raw == 0xC4) & (after == 0xB0)
    total = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
    whole = total[ends] > total[starts]
    kind = np.full(256, 3, np.uint8)
    kind[0x80:] = kind[0x41:0x5B] = kind[0x61:0x7B] = 1
    kind[0x30:0x3A] = 2
    kind = kind[raw]
    new = np.ones(len(raw), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    step = np.zeros(len(raw) + 1, np.int8)
    step[starts[whole]] += 1
    step[ends[whole]] -= 1
    new &= np.cumsum(step[:-1], dtype=np.int8) == 0
    step[:] = 0
    step[starts] += 1
    step[ends] -= 1
    new &= np.cumsum(step[:-1], dtype=np.int8) > 0
    new[starts] = True
    first = np.flatnonzero(new)
    word = np.searchsorted(starts, first, side="right") - 1
    last = np.append(first[1:], len(raw))
    return first, np.minimum(last, ends[word]), np.searchsorted(offsets, first, side="right") - 1


def _wholes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of parts that hold a ``<``: special tokens are told by their own letters' case."""
    total = np.concatenate([[0], np.cumsum(raw == 0x3C, dtype=np.int64)])
    held = total[ends] > total[starts]
    step = np.zeros(len(raw) + 1, np.int8)
    step[starts[held]] += 1
    step[ends[held]] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) > 0


_known = Known(_CACHE)


def _encoded(parts: list[bytes], tok) -> list[np.ndarray]:
    """The ids of each part."""
    names = [p.decode() for p in parts]
    plain = [n.isalpha() and max(n) < "\u0180" and not {*n} & {*"\u00aa\u00ba\u00b5\u0130"} for n in names]
    odd = [i for i, x in enumerate(plain) if not x]
    out: list[np.ndarray] = [None] * len(parts)
    for i, e in zip(odd, tok.encode_batch_fast([names[i] for i in odd], add_special_tokens=False)):
        out[i] = np.array(e.ids, np.uint32)
    own = [i for i, x in enumerate(plain) if x]
    for lo in range(0, len(own), 4096):  # a row of plain words is one text; a word's last id tells them apart
        some = own[lo:lo + 4096]
        e = tok.encode_batch_fast([" ".join([names[i] for i in some])], add_special_tokens=False)[0]
        ids = np.array(e.ids, np.uint32)
        at = np.concatenate([[0], np.flatnonzero(_last[ids]) + 1]).tolist()
        assert len(at) == len(some) + 1
        for k, i in enumerate(some):
            out[i] = ids[at[k]:at[k + 1]]
    return out


def encode_texts(column: pa.Array, path: str) -> list[bytes]:
    """Ids of each text of a column, 32 bits each. The tokenizer drops white space and merges within
    parts of words only, so that a part is encoded once and looked up from then on."""
    tok = _load(path)
    raw, offsets = utf8(column)
    starts, ends, row = part_spans(raw, offsets)
    low = lowered(raw)
    low = np.where(_wholes(raw, starts, ends), raw, low)
    ids = _known.ids_of(low, starts, ends, row, len(column), lambda parts: _encoded(parts, tok))
    return [x.tobytes() for x in ids]


def _shrunk(raw: bytes) -> bytes:
    """Ids in a row, first all low bytes, then the next."""
    return zstandard.compress(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _grown(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, crc, ids): the ids, the end id last, as compressed little-endian unsigned
    32-bit integers; the crc is that of the integers."""
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            raw = [x + end for x in encode_texts(batch.column("text"), tokenizer)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array([_shrunk(x) for x in raw], pa.binary())],
                names=["doc_id", "n_tokens", "crc", "ids"])

    return arrow(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, crc long, ids binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, n) over all documents, counted in each partition first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            held = [_grown(raw) for raw in batch.column("ids").to_pylist()]
            for i in range(0, len(held), 1000):
                n = np.bincount(np.concatenate(held[i:i + 1000]))
                total = np.pad(total, (0, max(0, len(n) - len(total))))
                total[:len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return arrow(tokens.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; counts must be positive."""
    n = len(counts)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    weights, levels = leaves, []
    for _ in range(limit - 1):
        pairs = weights[:len(weights) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([leaves, pairs])
        by = np.argsort(merged, kind="stable")
        levels.append(by < n)  # which items of this level are leaves
        weights = merged[by]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        k = int(is_leaf[:take].sum())  # the smallest k leaves are among the items taken
        lengths[:k] += 1
        take = 2 * (take - k)
    lengths[:take] += 1
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lengths, codes) in canonical order: by length, then id."""
    by = np.lexsort((ids, lengths))
    ids, lengths = ids[by].astype(np.int64), lengths[by].astype(np.int64)
    codes = np.zeros(len(ids), np.int64)
    if len(ids):
        top = int(lengths[-1])
        width = np.int64(1) << (top - lengths)
        codes = (np.cumsum(width) - width) >> (top - lengths)
    return ids, lengths, codes


def pack(flat: np.ndarray, code_of: np.ndarray, length_of: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """The bit stream of some ids as big-endian 32-bit words, and the bit offset of every ``step``-th."""
    size = length_of[flat].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    word = at >> 5
    value = code_of[flat].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
    out = np.zeros((int(end[-1]) >> 5) + 3 if len(flat) else 2, np.uint32)
    if len(flat):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        np.add.at(out, word[first], np.add.reduceat(value >> np.uint64(32), first).astype(np.uint32))
        np.add.at(out, word[first] + 1, np.add.reduceat(value & np.uint64(0xFFFFFFFF), first).astype(np.uint32))
    return out.astype(">u4"), at[::step]


class Decoder:
    """Table of ``limit`` bits: the id whose code they begin with, and its length."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        ids, lengths, codes = canonical(ids, lengths)
        self.limit = int(lengths.max()) if len(lengths) else 1
        span = (np.int64(1) << (self.limit - lengths)) if len(lengths) else np.zeros(0, np.int64)
        table = np.repeat((ids << 6) | lengths, span)
        self.table = np.concatenate([table, np.zeros((1 << self.limit) - len(table), np.int64)])

    def unpack(self, bits: bytes, checkpoints: np.ndarray, n: int, step: int = STEP) -> np.ndarray:
        """All ``n`` ids: the stretches from every checkpoint, side by side."""
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at, out = checkpoints.astype(np.int64), np.zeros((step, len(checkpoints)), np.uint32)
        mask = np.uint64((1 << self.limit) - 1)
        for k in range(min(step, n)):
            live = at[:len(at) - (k >= 1 + (n - 1) % step)]
            seen = (pairs[live >> 5] >> (64 - self.limit - (live & 31)).astype(np.uint64)) & mask
            found = self.table[seen.astype(np.int64)]
            out[k, :len(live)] = found >> 6
            at = np.concatenate([live + (found & 63), at[len(live):]])
        return out.T.ravel()[:n]


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block: int = BLOCK, step: int = STEP, limit: int = LIMIT) -> None:
    """Write the token files of ``docs`` to folder ``path``."""
    spark = docs.sparkSession
    tokens, scratch = written(tokenized(docs, tokenizer, end_id), "tokens")
    found = sorted((r.id, r.n) for r in id_counts(tokens).collect())  # as many rows as the vocabulary at most
    ids = np.array([i for i, _ in found], np.int64)
    lengths = code_lengths(np.array([n for _, n in found], np.int64), limit)
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist())), "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    by_id, by_length, codes = canonical(ids, lengths)
    code_of, length_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint32), np.zeros(int(ids.max(initial=0)) + 1, np.uint8)
    code_of[by_id], length_of[by_id] = codes, by_length
    book = spark.sparkContext.broadcast((code_of, length_of))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of, length_of = book.value
        part, number, docs_in, sizes, held, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def packed() -> pa.RecordBatch:
            bits, marks = pack(np.concatenate(held), code_of, length_of, step)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([docs_in], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([marks.astype("<i8").tobytes()], pa.binary()), pa.array([bits.tobytes()], pa.binary())],
                names=["part", "block", "doc_ids", "n_tokens", "checkpoints", "bits"])

        for batch in batches:
            for doc, n, raw in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids")]):
                docs_in.append(doc)
                sizes.append(n)
                held.append(_grown(raw))
                total += n
                if total >= block:
                    yield packed()
                    number, docs_in, sizes, held, total = number + 1, [], [], [], 0
        if docs_in:
            yield packed()

    ordered = tokens.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("crc")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "crc", "n_tokens")
    write(arrow(ordered, run, "part long, block long, doc_ids array<long>, n_tokens array<long>, checkpoints binary, bits binary"), f"{path}/blocks")
    drop(spark, scratch)


def read_blocks(spark: SparkSession, path: str, step: int = STEP) -> DataFrame:
    """(part, block, pos, doc_id, n_tokens, ids) decoded from the files in ``path``."""
    rows = spark.read.schema("id long, length int").parquet(f"{path}/codebook").collect()  # the vocabulary at most
    ids, lengths = np.array([r.id for r in rows], np.int64), np.array([r.length for r in rows], np.int64)
    book = spark.sparkContext.broadcast((ids, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*book.value)
        for batch in batches:
            for i in range(len(batch)):
                part, number, docs_in, sizes, marks, bits = (batch.column(c)[i].as_py() for c in ("part", "block", "doc_ids", "n_tokens", "checkpoints", "bits"))
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                flat = decoder.unpack(bits, np.frombuffer(marks, "<i8"), int(cuts[-1]), step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(sizes), pa.int64()), pa.array([number] * len(sizes), pa.int64()), pa.array(range(len(sizes)), pa.int64()), pa.array(docs_in, pa.int64()), pa.array(sizes, pa.int64()), binary_column(flat.astype("<u4"), cuts)],
                    names=["part", "block", "pos", "doc_id", "n_tokens", "ids"])

    blocks = spark.read.schema("part long, block long, doc_ids array<long>, n_tokens array<long>, checkpoints binary, bits binary").parquet(f"{path}/blocks")
    return arrow(blocks, run, "part long, block long, pos long, doc_id long, n_tokens long, ids binary")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, first): ids before each block. A running sum in each part, then one over the parts."""
    blocks = spark.read.schema("part long, block long, n_tokens array<long>").parquet(f"{path}/blocks")
    sums = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("inside", F.coalesce(F.sum("n").over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0)))
    parts = sums.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("outside"))
    return inside.join(parts, "part").select("part", "block", (F.col("inside") + F.col("outside")).alias("first"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("block"), batch.column("pos"), batch.column("doc_id"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                                             names=["part", "block", "pos", "doc_id", "n_tokens", "ids_crc32"])

    rows, _ = written(arrow(read_blocks(spark, path), run, "part long, block long, pos long, doc_id long, n_tokens long, ids_crc32 long"), "token-digest")
    in_block = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("in_block", in_block).join(starts(spark, path), ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm/token-files-{uuid.uuid4().hex}"
