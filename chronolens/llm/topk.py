"""Exact top-k by integer inner product: no-random-access aggregation over sorted lists.

Rows are dealt into shards of bounded size. A shard's index holds, for each component, its
rows sorted by that component. A query reads every list from the end that raises its score
(the far end where its own component is negative), all lists to the same depth. From what
was read each row has bounds: a component not yet seen lies between the value where reading
stands and the list's last value. A row whose upper bound is below the k-th largest lower
bound is an outsider; once all but a few rows are outsiders, reading stops and the scores of
the rest are resolved from their vectors. At full depth both bounds are the score, so the
result is exact for any data; how far lists are read only decides the work.

A block of queries reads together: which rows a depth has shown is the same for all queries
with the same sign of a component, so the bounds of a block are two matrix products. All
numbers are integers below 2**53 in doubles, or 64-bit integers where they may be larger.

Every query meets every shard once: queries are copied to the shards (they are the smaller
side), and a shard's index is copied only once for each ``GROUP`` queries. A last ranking
merges k rows a shard.

Defined results: vectors null, empty, or with null or non-finite components take no part,
nor do rows with a null vec_id; zero vectors do; ties go to the smaller vec_id; a vector is
never its own neighbour, by id; a repeated row is a candidate, and a query, of its own; an
empty table gives no rows; vectors of several lengths, and components so large that a score
might not fit a long, are errors. Other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, ship, written
from .vectors import dimension, integers, matrix

SHARD, GROUP, BLOCK = 8192, 1 << 16, 256  # rows of a shard, queries that share a copy of it, queries that read together
RESOLVE = 64  # rows left at which reading stops, k at least


def build(ids: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """A shard's lists: ``order[d]`` are its rows by falling component d."""
    by = np.argsort(ids, kind="stable")  # equal scores then come in order of their ids
    ids, x = ids[by], x[by]
    return {"ids": ids, "x": x, "order": np.argsort(-x, axis=0, kind="stable").T.astype(np.int32)}


def depths(n: int) -> list[int]:
    """How far lists of ``n`` rows are read before each look at the bounds."""
    return sorted({max(1, n * e // 16) for e in (1, 2, 4, 8, 10, 12, 14, 16)}) if n else []


class Reader:
    """Lists of a shard read to a depth: what the bounds of any query need."""

    def __init__(self, shard: dict[str, np.ndarray], dtype) -> None:
        self.order, self.x = shard["order"], shard["x"].astype(dtype)
        self.n, self.dim = self.x.shape
        self.at = 0
        self.top = self.x[self.order[:, 0], np.arange(self.dim)]
        self.end = self.x[self.order[:, -1], np.arange(self.dim)]
        self.falling = np.zeros((self.n, self.dim), bool)  # seen from the top
        self.rising = np.zeros((self.n, self.dim), bool)  # seen from the end

    def read(self, depth: int) -> None:
        """The next entries of every list, from both ends."""
        for d in range(self.dim):
            self.falling[self.order[d, self.at:depth], d] = True
            self.rising[self.order[d, self.n - depth:self.n - self.at], d] = True
        self.at = depth
        each = np.arange(self.dim)
        self.high, self.low = self.x[self.order[:, depth - 1], each], self.x[self.order[:, self.n - depth], each]
        # a seen component counts itself, an unseen one the bound: the difference where seen, the bound for all
        self.upper = np.hstack([np.where(self.falling, self.x - self.high, 0), np.where(self.rising, self.x - self.low, 0)])
        self.lower = np.hstack([np.where(self.falling, self.x - self.end, 0), np.where(self.rising, self.x - self.top, 0)])

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(upper, lower) of some queries and all rows."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        both = np.hstack([plus, minus])
        return (both @ self.upper.T + (plus @ self.high + minus @ self.low)[:, None],
                both @ self.lower.T + (plus @ self.end + minus @ self.top)[:, None])


def search(shard: dict[str, np.ndarray], query_ids: np.ndarray, q: np.ndarray, k: int, block: int = BLOCK, resolve: int = RESOLVE) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, vec_id, score) of each query's ``k`` highest in the shard, and the entries read."""
    ids, x = shard["ids"], shard["x"]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(ids) or not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    largest = 4 * x.shape[1] * int(np.abs(x).max()) * int(np.abs(q).max())
    if largest >= 1 << 62:
        raise ValueError("components are so large that a score might not fit a long")
    dtype = np.float64 if largest < 1 << 53 else np.int64
    none = -np.inf if dtype is np.float64 else np.iinfo(np.int64).min
    reader, entries = Reader(shard, dtype), 0
    waiting = [np.arange(a, min(a + block, len(q))) for a in range(0, len(q), block)]
    for depth in depths(len(ids)):
        reader.read(depth)
        left = []
        for own in waiting:
            upper, lower = reader.bounds(q[own].astype(dtype))
            itself = query_ids[own][:, None] == ids[None, :]
            upper[itself] = lower[itself] = none
            if len(ids) > k:
                least = -np.partition(-lower if dtype is np.float64 else ~lower, k - 1, axis=1)[:, k - 1]
                least = least if dtype is np.float64 else least - 1  # of integers, -(~v) is v + 1
            else:
                least = np.full(len(own), none)
            may = (upper >= least[:, None]) & ~itself
            done = (may.sum(1) <= max(k, resolve)) | (depth == len(ids))
            r, c = np.nonzero(may & done[:, None])
            score = (q[own[r]] * x[c]).sum(1)
            by = np.lexsort((ids[c], -score, r))
            r, c, score = r[by], c[by], score[by]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            top = place < k
            out.append((own[r[top]], ids[c[top]], score[top]))
            entries += int(done.sum()) * depth * x.shape[1]
            if not done.all():
                left.append(own[~done])
        waiting = left
        if not waiting:
            break
    return *(np.concatenate(p) for p in zip(*out)), entries


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products of floor(scale * component).

    ``vectors`` and ``queries`` have columns vec_id and embedding."""
    spark = vectors.sparkSession
    ship(spark)

    def numbered(df: DataFrame, size: int, name: str) -> tuple[DataFrame, str, int, int]:
        rows, path = written(integers(df, scale).where("vec_id is not null").withColumn("row", F.monotonically_increasing_id()), name)
        n, dim = dimension(rows)
        parts = max(1, -(-n // size))
        return rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")), path, parts, dim

    rows, rows_path, shards, dim = numbered(vectors, shard, "topk-rows")
    asked, _, groups, asked_dim = numbered(queries, group, "topk-queries")
    if dim and asked_dim and dim != asked_dim:
        raise ValueError(f"queries have {asked_dim} components, vectors {dim}")

    def pack(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        table = table.sort_by("row")
        held = build(table.column("vec_id").to_numpy(), matrix(table.column("x").combine_chunks(), dim))
        out = io.BytesIO()
        np.savez(out, **held)
        return pa.table({"part": pa.array([part], pa.int32()), "lists": pa.array([out.getvalue()], pa.binary())})

    index, _ = written(rows.groupBy("part").applyInArrow(pack, "part int, lists binary"), "topk-lists")
    drop(spark, rows_path)

    def run(lists: pa.Table, ask: pa.Table) -> pa.Table:
        names = ["ask", "query_id", "vec_id", "score"]
        if not len(lists) or not len(ask):
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        held = np.load(io.BytesIO(lists.column("lists")[0].as_py()))
        ids, ask_row = ask.column("query_id").to_numpy(), ask.column("ask").to_numpy()
        row, near, score, _ = search({c: held[c] for c in held.files}, ids, matrix(ask.column("x").combine_chunks(), dim), k)
        return pa.table([pa.array(v) for v in (ask_row[row], ids[row], near, score)], names=names)

    # a task for each shard and group of queries
    tasks = shards * groups
    copies = index.select("part", "lists", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")).repartition(2 * tasks, "part", "grp")
    questions = asked.select(F.col("row").alias("ask"), F.col("vec_id").alias("query_id"), "x", F.col("part").alias("grp"),
                             F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part")).repartition(2 * tasks, "part", "grp")
    found = copies.groupBy("part", "grp").cogroup(questions.groupBy("part", "grp")).applyInArrow(run, "ask long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("ask").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH x AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM x q JOIN x v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM n WHERE rank <= 5
"""
