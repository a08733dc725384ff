"""Filter interaction audit: what each filter removes, in every order, from wide packed counters.

Five filters give each text a mask of the conditions that it fails. A mask decides all
600 step outcomes at once (120 orders of 5 steps): at which step of each order the text
is removed. ``packed`` maps a mask to one big integer with a field of ``WIDTH`` bits for
each step, 1 where the text goes, and one more field that counts the text. Integers of
texts add up to the counts, since a field of 64 bits cannot overflow into its neighbour
before 2**64 rows. A task adds up its rows' integers for each part, further steps add up
the sums, and ``unpacked`` reads the fields. The other counts follow from these sums:
kept is the total less what went up to the step; a filter's failures are what it removes
as the first step, and its unique failures what it removes as the last.

Filter E (the same text under a smaller doc_id) needs the whole table: rows meet by
their text's SHA-256, counted for each (text, part, doc_id) first and for each (text,
part) next, so that a large group of copies is a few rows before it is sorted.

Defined results: a null text is the empty one; a null source is part ``""``; no id is
smaller than another because either is null, but a null id comes after all others, so a
row without id fails E where a row with an id has its text; rows with equal ids and texts
fail E alike; labels that repeat a doc_id count as 1 where any of them is 1; labels
without a document, or with a null id, count nowhere; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, drop, ship, slices, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, 6)]
WIDTH = 64  # bits of a field
FIELDS = len(STEPS) + 1  # the last one counts the texts
SALT = 64  # sums of a part that are made side by side before the last one
KINDS = ("all", "good", "toxic")

_LETTERS = bytes(range(65, 91))
_SIGNS = re.compile(rb"[#$%&*|]")


def mask_of(text: bytes) -> int:
    """Bits 0 to 3: whether the text fails A, B, C and D."""
    words = text.split()  # of bytes: at 0x20 and 0x09 to 0x0D, and nowhere else
    points = len(text) - len(text.translate(None, _HEADS))
    return ((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, _LETTERS))) > 5 * points) << 2 | (_SIGNS.search(text) is not None) << 3)


_HEADS = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)  # the first bytes of UTF-8 characters


@lru_cache(maxsize=None)
def packed(mask: int) -> int:
    """The integer of a mask: field i is 1 where step i of STEPS removes the text; the last field is 1."""
    out = 1 << WIDTH * len(STEPS)
    for i, (order, step) in enumerate(STEPS):
        fails = [mask >> FILTERS.index(f) & 1 for f in order]
        if fails[step - 1] and not any(fails[:step - 1]):
            out |= 1 << WIDTH * i
    return out


def unpacked(total: int) -> np.ndarray:
    """All fields of a sum of integers."""
    return np.frombuffer(total.to_bytes(FIELDS * WIDTH // 8, "little"), "<u8")


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every whole text: its SHA-256, and what it fails of A to D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=4 << 20):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(list(map(mask_of, texts)), pa.int32())],
                names=["doc_id", "part", "digest", "mask"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    return arrow(rows, run, "doc_id long, part string, digest binary, mask int")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows of ``masks`` by text and part, bit 4 of the mask being E.

    A (text, part) gives one row for its copies and one for those whose id is the text's smallest."""
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    one = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    named = rows.where("doc_id is not null").join(said, "doc_id", "left").select(
        "digest", "part", "doc_id", "mask", F.lit(1).cast("long").alias("n"), one("good"), one("toxic"))
    # one row for each (text, part, id): the join deals by id, so that a group of copies is spread here
    each = named.groupBy("digest", "part", "doc_id", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    zero = F.lit(0).cast("long")
    nameless = rows.where("doc_id is null").groupBy("digest", "part", "doc_id", "mask").agg(F.count(F.lit(1)).alias("n")).select("*", zero.alias("good"), zero.alias("toxic"))
    counts = ("n", "good", "toxic")
    by_text = each.unionByName(nameless).groupBy("digest", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in counts], F.min("doc_id").alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(zero)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *counts))).alias("first"))
    # a window holds a text's parts, one row each
    least = F.min("least").over(Window.partitionBy("digest"))
    found = by_text.withColumn("of_text", least)
    own = F.col("least") == F.col("of_text")  # null where no row of the text has an id: none fails E then
    firsts = {c: F.when(F.col("of_text").isNull(), F.col(c)).when(own, F.col(f"first.{c}")).otherwise(zero) for c in counts}
    split = found.select("part", "mask", F.explode(F.array(
        F.struct(F.lit(0).alias("e"), *[firsts[c].alias(c) for c in counts]),
        F.struct(F.lit(16).alias("e"), *[(F.col(c) - firsts[c]).alias(c) for c in counts]))).alias("x"))
    return split.where("x.n > 0").select("part", (F.col("mask") + F.col("x.e")).alias("mask"), *[f"x.{c}" for c in counts])


def sums(counts: DataFrame) -> DataFrame:
    """(part, all, good, toxic): one sum of packed integers each, as bytes; summed in tasks, then by part and salt, then by part."""
    schema = "part string, salt int, " + ", ".join(f"{k} binary" for k in KINDS)
    size = FIELDS * WIDTH // 8

    def rows(held: dict[str, list[int]], salt: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()),
                                           *[pa.array([v[k].to_bytes(size, "little") for v in held.values()], pa.binary()) for k in range(3)]], names=["part", "salt", *KINDS])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        for batch in batches:
            for part, mask, *ns in zip(*[batch.column(c).to_pylist() for c in ("part", "mask", "n", "good", "toxic")]):
                total = held.setdefault(part, [0, 0, 0])
                for k, n in enumerate(ns):
                    if n:
                        total[k] += n * packed(mask)
        yield rows(held, TaskContext.get().partitionId() % SALT)

    def more(table: pa.Table) -> pa.Table:
        held = [sum(int.from_bytes(x.as_py(), "little") for x in table.column(k)) for k in KINDS]
        return pa.Table.from_batches([rows({table.column("part")[0].as_py(): held}, 0)])

    ship(counts.sparkSession)
    by_salt = arrow(counts, first, schema).groupBy("part", "salt").applyInArrow(more, schema)
    return by_salt.groupBy("part").applyInArrow(more, schema).drop("salt")


def report(totals: DataFrame) -> DataFrame:
    """The 600 rows of each part out of its three sums."""
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    letters = np.array([FILTERS.index(order[step - 1]) for order, step in STEPS])
    steps = np.array([step for _, step in STEPS])
    alone = {f: next(i for i, (o, s) in enumerate(STEPS) if s == 1 and o[0] == f) for f in FILTERS}
    last = {f: next(i for i, (o, s) in enumerate(STEPS) if s == 5 and o[4] == f) for f in FILTERS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                fields, good, toxic = (unpacked(int.from_bytes(batch.column(k)[i].as_py(), "little")).astype(np.int64) for k in KINDS)
                removed, total = fields[:-1], fields[-1]
                kept = total - removed.reshape(-1, 5).cumsum(1).ravel()
                fails = np.array([removed[alone[f]] for f in FILTERS])[letters]
                unique = np.array([removed[last[f]] for f in FILTERS])[letters]
                shapley = np.array([removed[letters == k].sum() for k in range(5)])[letters]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("part")[i].as_py()] * len(STEPS), pa.string()), pa.array([o for o, _ in STEPS], pa.string()), pa.array(steps, pa.int32()),
                     *[pa.array(x, pa.int64()) for x in (kept, removed, fails - removed, unique, good[:-1], toxic[:-1], shapley)]], names=names)

    return arrow(totals, run, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names[3:]))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step; see the module's text.

    ``docs`` has doc_id, text and source; ``labels`` has doc_id, quality and toxic. The rows
    of ``masks`` and the sums are written, so that no later step reads a text again."""
    rows, path = written(masks(docs), "audit-masks")
    totals, _ = written(sums(mask_counts(rows, labels)), "audit-sums")  # some rows a source
    drop(docs.sparkSession, path)
    return report(totals)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
least AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
f AS (
  SELECT w.doc_id, w.part,
    len(words) < 50 AS fa,
    100 * len(list_distinct(words)) < 65 * len(words) AS fb,
    100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 5 * length(w.t) AS fc,
    regexp_matches(w.t, '[#$%&*|]') AS fd,
    coalesce(first_id < w.doc_id, first_id IS NOT NULL AND w.doc_id IS NULL, FALSE) AS fe
  FROM w JOIN least ON w.t = least.t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, [fa, fb, fc, fd, fe] AS fails, count(*) AS n,
    count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (SELECT filter_order, s::INT AS step, substr(filter_order, s::INT, 1) AS own FROM orders, range(1, 6) r(s)),
outcome AS (
  SELECT part, filter_order, step, own, n, good, toxic,
    fails[ascii(own) - 64] AS fails_own,
    len(list_filter(range(1, step::BIGINT), lambda k: fails[ascii(substr(filter_order, k::INT, 1)) - 64])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) AS failed
  FROM m, steps),
sums AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails_own), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE NOT gone AND fails_own), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND fails_own), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE fails_own AND failed = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND fails_own), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails_own), 0)::BIGINT AS toxic_lost
  FROM outcome GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM sums
"""
