"""SentencePiece encoding and decoding by a max-plus scan.

A text's pieces are those with the largest sum of the model's scores (ties at a place:
the longest piece that ends there). Short documents are encoded in one go. A giant
document is cut into chunks of ``CHUNK`` characters, which need not end where pieces
do: a chunk's state at its left edge is how many of its characters a piece from the
chunk before has taken. For each chunk a task gives the transfer matrix, the best sum
from every state at its left edge to every state at its right one. The matrices
combine associatively in (max, +), so that a document's matrices alone, 2 KB a chunk,
give the best sums at every edge. With them each chunk says which left state each
right state goes back to; those maps combine from the right, and each chunk is then
backtraced on its own.

No piece goes on from a character to a space, so that the best pieces from one run of
spaces to the next depend on nothing else and are looked up once found.

Characters that the vocabulary lacks become byte pieces. A literal U+2581, which the
vocabulary uses for spaces, becomes bytes too, so that decoding gives back every text.
An unknown character scores 10 less than the lowest piece.

Defined results: null and empty texts have no pieces and decode to an empty text;
repeated rows are repeated; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Known, arrow, ship, slices, utf8, written

CHUNK = 1 << 15  # characters of a chunk
SPACE, LITERAL = "▁", "\udc81"  # the vocabulary's space; what a literal one becomes meanwhile
_CACHE = 800_000  # stretches between spaces whose ids a worker keeps
_NONE = float("-inf")


class Vocabulary:
    """Pieces with their ids and scores."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        self.control = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.control and i not in self.value}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.unknown = min(self.scores.values(), default=0.0) - 10
        self.reach = max(map(len, self.ids), default=1)
        self.prefixes = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        #: Scores of all beginnings of pieces; those that are no piece have none.
        self.table = {p: self.scores.get(p, _NONE) for p in self.prefixes}
        self.raw = [b"" if i in self.control else bytes([self.value[i]]) if i in self.value else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.known = Known(_CACHE)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that hold a space after another character are not supported")
        #: Runs of spaces stay together only where a piece holds two.
        self.unit = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if any(SPACE in p[1:] for p in self.ids) else f"{SPACE}[^{SPACE}]*|[^{SPACE}]+")
        self.cut = re.compile(f"(?<!{SPACE}){SPACE}" if any(SPACE in p[1:] for p in self.ids) else SPACE)

    def normalized(self, text: str) -> str:
        return SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE) if text else ""

    def ids_of(self, piece: str) -> tuple[int, ...]:
        if piece in self.ids:
            return (self.ids[piece],)
        raw = SPACE.encode() if piece == LITERAL else piece.encode()
        return tuple(self.byte.get(b, 0) for b in raw)

    def forward(self, text: str, entry: list[float], starts: int, ends: int) -> tuple[list[float], list[int]]:
        """Best sums to every node up to ``ends``, from nodes entered with the sums ``entry``, by
        pieces that start before ``starts``; and where the last piece started, -1 for an entry."""
        best = (entry + [_NONE] * (ends + 1))[:ends + 1]
        back = [-1] * (ends + 1)
        value, unknown = self.table.get, self.unknown
        for i in range(min(starts, ends)):
            here = best[i]
            if here == _NONE:
                continue
            v = value(text[i])
            if (s := here + (unknown if v is None or v == _NONE else v)) > best[i + 1]:
                best[i + 1], back[i + 1] = s, i
            if v is None:
                continue
            for j in range(i + 2, min(i + self.reach, ends) + 1):
                v = value(text[i:j])
                if v is None:
                    break
                if (s := here + v) > best[j]:
                    best[j], back[j] = s, i
        return best, back

    def backward(self, text: str, end: int) -> list[float]:
        """Best sums from every node to node ``end``."""
        best = [_NONE] * end + [0.0]
        for i in range(end - 1, -1, -1):
            top = self.unknown + best[i + 1] if text[i] not in self.scores else _NONE
            for j in range(i + 1, min(i + self.reach, end) + 1):
                piece = text[i:j]
                if piece not in self.prefixes:
                    break
                if piece in self.scores and (s := self.scores[piece] + best[j]) > top:
                    top = s
            best[i] = top
        return best

    def trace(self, text: str, back: list[int], at: int) -> tuple[int, list[int]]:
        """Back from node ``at``: the node entered, and the ids from there."""
        spans = []
        while back[at] >= 0:
            spans.append((back[at], at))
            at = back[at]
        return at, [x for a, b in reversed(spans) for x in self.ids_of(text[a:b])]

    def best(self, unit: str) -> tuple[float, list[int]]:
        """Sum and ids of a stretch that begins and ends where no piece goes on."""
        sums, back = self.forward(unit, [0.0], len(unit), len(unit))
        return sums[-1], self.trace(unit, back, len(unit))[1]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        out: list[int] = []
        for unit in self.unit.findall(self.normalized(text)):
            out += self.best(unit)[1]
        return out

    def encode_column(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a column. A stretch from one run of spaces to the next is encoded once."""
        raw, offsets = utf8(column)
        n, sizes = len(column), np.diff(offsets)
        rows = np.flatnonzero(sizes)  # the others have no pieces
        return self._stretches(np.insert(raw, offsets[rows], 32), offsets[rows] + np.arange(len(rows)), rows, n)  # a space leads each text

    def _stretches(self, led: np.ndarray, begin: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
        """Ids of the rows that begin in the bytes ``led`` at ``begin``; ``n`` rows in all."""
        space = led == 32
        new = space.copy()
        new[1:] &= ~space[:-1]
        new[begin] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(led))
        row = rows[np.searchsorted(begin, starts, side="right") - 1] if len(rows) else rows
        return self.known.ids_of(led, starts, ends, row, n, lambda units: [np.array(self.best(self.normalized(u.decode())[1:])[1], np.uint32) for u in units])

    def decode(self, ids) -> str:
        """The text of some ids; control ids say nothing, and broken bytes become U+FFFD."""
        raw = b"".join([self.raw[i] for i in ids])
        return (raw[1:] if raw.startswith(b" ") else raw).decode(errors="replace")


class Chunk:
    """``size`` characters of a normalized text, and what follows as far as a piece may reach."""

    def __init__(self, v: Vocabulary, text: str, size: int) -> None:
        self.v, self.text, self.size = v, text, size
        self.ends = min(len(text), size + v.reach - 1)
        # a space at the very start is no cut for a run of spaces that began before; the next one is as good
        cuts = [m.start() for m in (v.cut.search(text, 1),) if m and m.start() <= size]
        self.first = cuts[0] if cuts else None
        self.last = self.first
        if cuts:
            at = text.rfind(SPACE, 0, size + 1)
            while at > self.first and not v.cut.match(text, at):
                at -= 1
            self.last = max(at, self.first)

    def middle(self) -> list[int]:
        """Ids from the first cut to the last."""
        raw = np.frombuffer(self.text[self.first:self.last].replace(SPACE, " ").replace(LITERAL, SPACE).encode(), np.uint8)
        one = np.zeros(1, np.int64)
        return self.v._stretches(raw, one, one, 1)[0].tolist() if len(raw) else []

    def transfer(self) -> np.ndarray:
        """Best sums from each state at the left edge to each at the right one; where the chunk has
        cuts, without the pieces from the first to the last, which add the same to all."""
        v, m = self.v, self.v.reach
        out = np.full((m, m), _NONE)
        if self.first is None:
            best = np.full((self.ends + 1, m), _NONE)
            best[np.arange(min(m, self.ends + 1)), np.arange(min(m, self.ends + 1))] = 0
            for i in range(self.size):
                if self.text[i] not in v.scores:
                    np.maximum(best[i + 1], best[i] + v.unknown, out=best[i + 1])
                for j in range(i + 1, min(i + m, self.ends) + 1):
                    piece = self.text[i:j]
                    if piece not in v.prefixes:
                        break
                    if piece in v.scores:
                        np.maximum(best[j], best[i] + v.scores[piece], out=best[j])
            tail = best[self.size:self.ends + 1]
            out[:, :len(tail)] = tail.T
            return out
        head = self.v.backward(self.text, self.first)[:m]
        tail, _ = self._tail()
        out[:len(head), :len(tail)] = np.add.outer(np.array(head), np.array(tail))
        return out

    def _tail(self) -> tuple[list[float], list[int]]:
        sums, back = self.v.forward(self.text[self.last:], [0.0], self.size - self.last, self.ends - self.last)
        return sums[self.size - self.last:], back

    def sources(self, entry: list[float]) -> list[int]:
        """For each state at the right edge, the one at the left edge that the best pieces come from."""
        m = self.v.reach
        if self.first is None:
            sums, back = self.v.forward(self.text, entry, self.size, self.ends)
            return [self.v.trace(self.text, back, self.size + b)[0] if self.size + b <= self.ends and sums[self.size + b] > _NONE else 0 for b in range(m)]
        _, back = self.v.forward(self.text, entry[:self.first + 1], self.first, self.first)
        return [self.v.trace(self.text, back, self.first)[0]] * m

    def pieces(self, entry: list[float], state: int) -> list[int]:
        """Ids of the pieces that start in this chunk, given the state at its right edge."""
        v = self.v
        if self.first is None:
            _, back = v.forward(self.text, entry, self.size, self.ends)
            return v.trace(self.text, back, self.size + state)[1]
        _, back = v.forward(self.text, entry[:self.first + 1], self.first, self.first)
        return v.trace(self.text, back, self.first)[1] + self.middle() + v.trace(self.text[self.last:], self._tail()[1], self.size - self.last + state)[1]


_vocabulary: tuple[str, Vocabulary] | None = None


def load(path: str) -> Vocabulary:
    global _vocabulary
    if _vocabulary is None or _vocabulary[0] != path:
        _vocabulary = path, Vocabulary(path)
    return _vocabulary[1]


def _entries(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Best sums at every left edge: the prefixes of the (max, +) product."""
    at = np.full(len(matrices[0]), _NONE)
    at[0] = 0
    out = []
    for t in matrices:
        out.append(at)
        at = (at[:, None] + t).max(0)
        at = at - at.max()  # differences alone matter, and stay exact for documents of any length
    return out


def _giants(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    """(doc_id, ids, n_chunks) of documents longer than a chunk."""
    ship(docs.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(path)
        for batch in slices(batches):
            for row, doc, text in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "text")]):
                text = v.normalized(text)
                at = range(0, len(text), chunk)
                raw = [text[a:a + chunk + v.reach].encode("utf-8", "surrogatepass") for a in at]
                for i in range(0, len(raw), 64):
                    k = len(raw[i:i + 64])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * k, pa.int64()), pa.array([doc] * k, pa.int64()), pa.array(range(i, i + k), pa.int64()), pa.array([min(chunk, len(text) - a) for a in at[i:i + k]], pa.int64()), pa.array(raw[i:i + 64], pa.binary())],
                        names=["row", "doc_id", "chunk", "size", "text"])

    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    chunks, _ = written(arrow(rows, split, "row long, doc_id long, chunk long, size long, text binary").repartition("row", "chunk"), "spm-chunks")

    def each(names: list[str], kinds: list[pa.DataType], work):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = load(path)
            for batch in batches:
                for i in range(len(batch)):
                    row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                    got = work(Chunk(v, row["text"].decode("utf-8", "surrogatepass"), row["size"]), row)
                    yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, 1), batch.column("chunk").slice(i, 1), *[pa.array([x], k) for x, k in zip(got, kinds)]], names=["row", "chunk", *names])

        return run

    def scan(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        m = [np.frombuffer(x).reshape(int((len(x) // 8) ** 0.5), -1) for x in table.column("matrix").to_pylist()]
        return pa.table({"row": table.column("row"), "chunk": table.column("chunk"), "entry": pa.array([x.tolist() for x in _entries(m)], pa.list_(pa.float64()))})

    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by([("chunk", "descending")])
        state, out = 0, []
        for back in table.column("sources").to_pylist():
            out.append(state)
            state = back[state]
        return pa.table({"row": table.column("row"), "chunk": table.column("chunk"), "state": pa.array(out, pa.int32()), "entry": table.column("entry")})

    key = ["row", "chunk"]
    matrices = arrow(chunks.select(*key, "size", "text"), each(["matrix"], [pa.binary()], lambda c, _: [c.transfer().tobytes()]), "row long, chunk long, matrix binary")
    entries = matrices.groupBy("row").applyInArrow(scan, "row long, chunk long, entry array<double>")
    numbers = pa.list_(pa.float64())
    sources = arrow(chunks.select(*key, "size", "text").join(entries, key), each(["sources", "entry"], [pa.list_(pa.int32()), numbers], lambda c, r: [c.sources(r["entry"]), r["entry"]]), "row long, chunk long, sources array<int>, entry array<double>")
    states, _ = written(sources.groupBy("row").applyInArrow(follow, "row long, chunk long, state int, entry array<double>"), "spm-states")
    ids = arrow(chunks.select(*key, "size", "text").join(states, key), each(["ids"], [pa.list_(pa.int32())], lambda c, r: [c.pieces(r["entry"], r["state"])]), "row long, chunk long, ids array<int>")
    whole = ids.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    names = chunks.where("chunk = 0").select("row", "doc_id")
    return names.join(whole, "row").select("doc_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"), F.size("parts").alias("n_chunks"))


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, ids array<int>, n_chunks) of every whole text."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(path)
        for batch in slices(batches, most=2 << 20):
            ids = v.encode_column(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.view(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([1] * len(ids), pa.int32())], names=["doc_id", "ids", "n_chunks"])

    if chunk < 64:
        raise ValueError("a chunk must be longer than any piece")
    giant = F.coalesce(F.char_length("text") >= chunk, F.lit(False))  # the leading space makes one more
    small = arrow(docs.where(~giant).select("doc_id", "text"), short, "doc_id long, ids array<int>, n_chunks int")
    return small.unionAll(_giants(docs.where(giant), path, chunk))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids."""
    kept = encoded.select([c for c in encoded.columns if c != "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                texts = [v.decode(x or ()) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return arrow(kept, run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())]))


def digest(encoded: DataFrame, path: str, ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, n_chunks, ids_crc32 (little-endian 32-bit), the decoded text's
    bytes and SHA-256, and the ids if asked for."""
    with_ids = ids
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(path)
        for batch in batches:
            out = []
            for doc, said, chunks in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("n_chunks").to_pylist()):
                own = said.values.to_numpy().astype("<u4")
                text = v.decode(own.tolist()).encode()
                out.append((doc, len(own), chunks, zlib.crc32(own.tobytes()), len(text), hashlib.sha256(text).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            names = ["doc_id", "n_tokens", "n_chunks", "ids_crc32", "n_bytes", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns + [batch.column("ids")] * with_ids, names=names + ["ids"] * with_ids)

    schema = "doc_id long, n_tokens long, n_chunks int, ids_crc32 long, n_bytes long, decoded_sha256 string"
    return arrow(encoded.select("doc_id", "ids", "n_chunks"), run, schema + ", ids array<int>" * with_ids)
