"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by their number of distinct word shingles, in powers of two.
An item's signature is its k smallest shingle hashes, with k set by its partition:
a text that holds a share ``threshold`` of n shingles lacks at most
n - ceil(threshold * n) of them, so that any k = that + 1 shingles include one it
holds. A signature so long finds every text over the threshold whatever the text's
size, where a Jaccard estimate would lose short items inside long documents.
Documents are searched for signature hashes; each candidate is verified by the
exact containment of the item's shingles, compared as strings.

Items are read in blocks of bounded size, each against all documents.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. An item with fewer words
than the shingle length is one shingle of all its words, looked for among the
documents' shingles of that length.

Defined results: null and empty items and texts have no shingles and match
nothing; repeated rows match each on their own; empty tables give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, lowered, mixed, slices, utf8, word_hashes, word_spans

SHINGLE, THRESHOLD = 5, 0.8
ITEM_BLOCK = 16 << 20  # bytes of item texts searched at a time
_STEP = np.uint64(0x9DDFEA08EB382D69)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``length`` successive words of one row, and where each begins."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(length):
        h = h * _STEP + words[i:i + n]
    whole = np.flatnonzero(rows[:n] == rows[length - 1:])
    return mixed(h[whole]), whole


def split(text: bytes) -> list[bytes]:
    return text.lower().split()


def signature_size(n: int, threshold: float = THRESHOLD) -> int:
    """Hashes in the signature of an item of n shingles, set by its partition's largest size."""
    top = 1 << (n - 1).bit_length()
    return min(n, top - math.ceil(threshold * top - 1e-9) + 1)


class Items:
    """Signatures of a block of items by shingle length, and what verifies a candidate."""

    def __init__(self, items: list[tuple[int, str]], length: int = SHINGLE, threshold: float = THRESHOLD) -> None:
        self.threshold, self.ids, self.shingles, self.hashes = threshold, [], [], []
        found: dict[int, list[tuple[int, int]]] = {}
        for item, text in items:
            words = split(text.encode())
            if not words:
                continue
            n = min(length, len(words))
            raw, offsets = utf8(pa.array([text]))
            raw = lowered(raw)
            a, b, rows = word_spans(raw, offsets)
            h = np.unique(shingle_hashes(word_hashes(raw, a, b), rows, n)[0])
            own = len(self.ids)
            self.ids.append(item)
            self.shingles.append((n, {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}))
            self.hashes.append(h)
            found.setdefault(n, []).extend((x, own) for x in h[:signature_size(len(h), threshold)].tolist())
        self.tables = {}
        for n, pairs in found.items():
            pairs.sort()
            keys, of = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64)
            unique, first = np.unique(keys, return_index=True)
            seen = np.zeros(1 << 20, bool)
            seen[(unique & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables[n] = unique, np.append(first, len(keys)), of, seen

    def search(self, column: pa.Array) -> list[tuple[int, int, float]]:
        """(row, item, containment) for the texts of a column."""
        raw, offsets = utf8(column)
        raw = lowered(raw)
        a, b, rows = word_spans(raw, offsets)
        words = word_hashes(raw, a, b)
        out = []
        for n, (unique, first, of, seen) in self.tables.items():
            h, at = shingle_hashes(words, rows, n)
            may = np.flatnonzero(seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(unique, h[may]), len(unique) - 1)
            may, place = may[unique[place] == h[may]], place[unique[place] == h[may]]
            pairs = {(row, item) for row, p in set(zip(rows[at[may]].tolist(), place.tolist())) for item in of[first[p]:first[p + 1]].tolist()}
            doc = None
            for row, item in sorted(pairs):
                if doc is None or doc[0] != row:
                    lo, hi = np.searchsorted(rows[at], [row, row + 1])
                    doc, said = (row, np.unique(h[lo:hi])), None
                size = len(self.shingles[item][1])
                if np.isin(self.hashes[item], doc[1], assume_unique=True).sum() < self.threshold * size - 1e-9:
                    continue
                if said is None:
                    ws = split(raw[offsets[row]:offsets[row + 1]].tobytes())
                    said = {b" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)}
                shared = len(self.shingles[item][1] & said)
                if shared >= self.threshold * size - 1e-9:
                    out.append((row, self.ids[item], shared / size))
        return out


def _item_blocks(benchmark: DataFrame, block: int):
    """The items, a broadcast of bounded size at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block))
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).collect()
        yield spark.sparkContext.broadcast([(r.item_id, r.text) for r in part])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, containment): documents that hold a share ``threshold`` or more of an item's shingles."""
    out = None
    for held in _item_blocks(benchmark, block):

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Items(held.value, shingle, threshold)
            for batch in slices(batches, most=4 << 20):
                found = index.search(batch.column("text"))
                ids = batch.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([f[0] for f in found], pa.int64())), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64())],
                    names=["doc_id", "item_id", "containment"])

        pairs = arrow(docs.select("doc_id", "text"), run, "doc_id long, item_id long, containment double")
        out = pairs if out is None else out.unionAll(pairs)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, block: int = ITEM_BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no item to the threshold. Columns pass through."""
    for held in _item_blocks(benchmark, block):

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Items(held.value, shingle, threshold)
            for batch in slices(batches, most=4 << 20):
                keep = np.ones(len(batch), bool)
                keep[[f[0] for f in index.search(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        docs = arrow(docs, run, docs.schema)
    return docs


ORACLE = r"""
WITH low AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT kind, id, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM low),
items AS (SELECT id, least(5, len(w)) AS n, w FROM words WHERE kind = 'b' AND len(w) > 0),
need AS (SELECT DISTINCT id AS item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s FROM items),
have AS (
  SELECT DISTINCT id AS doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM words, (SELECT DISTINCT n FROM items) WHERE kind = 'd' AND len(w) >= n),
sizes AS (SELECT item_id, count(*) AS size FROM need GROUP BY item_id)
SELECT doc_id, item_id, count(*) / any_value(size)::DOUBLE AS containment
FROM need JOIN have USING (n, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(size) - 1e-9
"""
