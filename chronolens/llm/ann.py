"""Nearest neighbours by inner product: vantage-point trees, one for each shard.

Inner product becomes distance by one more component: (p, sqrt(M^2 - |p|^2)) against
(q, 0), with M the largest norm, lies at |q|^2 + M^2 - 2<q, p>. A node keeps its
vantage point, a radius, and children inside and outside of it; the triangle
inequality bounds how near a child's points can be. A child is skipped when ``factor``
times its bound exceeds the distance of the k-th nearest found so far: 1 is exact,
more skips more.

A top tree, fitted on at most ``SAMPLE_BYTES`` of vectors drawn by a hash, cuts space into
regions; every vector is indexed. A region's rows form one shard, or several by a hash
of the row where they are too many for one (so copies of one vector spread too), and
each shard's tree is one row of an index table. A query first goes to its home shard. The k-th score found
there then rules out shards, by the bounds of the top tree, and is where the search in
the others starts; they return only what reaches it. A shard's tree comes first in its
partition and its queries stream past it. It is sent once for each ``ASKED`` queries that
visit the shard, so trees never outweigh the visits. How many shards a query visits
depends on the data: in many dimensions without clusters, most of them.

Defined results: vectors null, empty, zero or with null or non-finite components
take no part; ties go to the smaller id; a vector is never its own neighbour, by
id; repeated rows are candidates each, and repeated queries are answered each, told
apart by nothing but their order; an empty table gives no rows. Vectors of several
lengths are an error. Vectors with a component over ``LARGE``, whose squares may
overflow, lie outside the trees and are compared with every query; a score may then be
infinite, and a sum that is not a number counts as minus infinity. Other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, drop, ship, written

SHARD, LEAF = 8192, 64  # rows of a shard, of a leaf
ASKED = 65536  # queries for which a shard's tree is sent once
SAMPLE_BYTES = 16 << 20  # of the vectors that the top tree is fitted on
FACTOR = 1.25
LARGE = 1e100


def _saved(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _vectors(column: pa.Array) -> np.ndarray:
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError(f"vectors of several lengths: {np.unique(lengths).tolist()}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))[:, None]])


def _slack(reach: np.ndarray) -> np.ndarray:
    """What rounding may add to a distance whose square is a difference of numbers up to ``reach``."""
    return 1e-7 * np.sqrt(reach)


def _split(lifted: np.ndarray, own: np.ndarray, share: float = 0.5) -> tuple[int, float, np.ndarray] | None:
    """(vantage row, radius, which of ``own`` are inside); None where a side would be empty."""
    # of a few candidates, the one from which the others lie furthest apart
    some = own[:: max(1, len(own) // 256)]
    tries = own[:: max(1, len(own) // 8)][:8]
    spread = [np.linalg.norm(lifted[some] - lifted[t], axis=1).std() for t in tries]
    v = int(tries[int(np.argmax(spread))])
    d = np.linalg.norm(lifted[own] - lifted[v], axis=1)
    radius = float(np.quantile(d, share))
    inside = d <= radius
    return (v, radius, inside) if inside.any() and not inside.all() else None


def build(ids: np.ndarray, x: np.ndarray, leaf: int = LEAF, plain: bool = False) -> dict[str, np.ndarray]:
    """The tree as flat arrays: nodes are (vantage row, radius, inside, outside) or a range of rows; a ``plain`` one is one leaf."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    top = 0.0 if plain else (x * x).sum(1).max(initial=0.0)
    lifted = None if plain else _lift(x, top)
    vantage, radius, child, rows, used = [], [], [], [], 0

    def node(own: np.ndarray) -> int:
        nonlocal used
        at = len(vantage)
        vantage.append(-1)
        radius.append(0.0)
        child.append((-1, -1))
        split = _split(lifted, own) if len(own) > leaf and not plain else None
        if split:
            vantage[at], radius[at], inside = split
            child[at] = node(own[inside]), node(own[~inside])
            return at
        rows.append(own)
        child[at] = (used, used + len(own))
        used += len(own)
        return at

    node(np.arange(len(ids)))
    return {"ids": ids, "x": x, "top": np.array(top), "vantage": np.array(vantage, np.int64), "radius": np.array(radius), "child": np.array(child, np.int64), "rows": np.concatenate(rows)}


class Regions:
    """The top tree: cuts space into about ``want`` regions, numbered from 0."""

    def __init__(self, sample: np.ndarray, top: float, want: int) -> None:
        self.top, self.count, self.vantage, self.radius, self.child = top, 0, [], [], []
        lifted = _lift(sample, top)

        def node(own: np.ndarray, want: int) -> int:
            at = len(self.child)
            self.child.append((-1, self.count))
            self.vantage.append(None)
            self.radius.append(0.0)
            split = _split(lifted, own, (want // 2) / want) if want > 1 and len(own) >= 16 else None
            if not split:
                self.count += 1
                return at
            self.vantage[at], self.radius[at], inside = lifted[split[0]], split[1], split[2]
            self.child[at] = node(own[inside], want // 2), node(own[~inside], want - want // 2)
            return at

        node(np.arange(len(sample)), want)

    def of(self, lifted: np.ndarray) -> np.ndarray:
        """The region of each point."""
        out = np.zeros(len(lifted), np.int64)
        todo = [(0, np.arange(len(lifted)))]
        while todo:
            at, own = todo.pop()
            if self.vantage[at] is None:
                out[own] = self.child[at][1]
            elif len(own):
                inside = np.linalg.norm(lifted[own] - self.vantage[at], axis=1) <= self.radius[at]
                todo += [(self.child[at][0], own[inside]), (self.child[at][1], own[~inside])]
        return out

    def within(self, lifted: np.ndarray, far: np.ndarray, factor: float) -> list[tuple[int, np.ndarray]]:
        """Per region the points to which it may hold something nearer than ``far``."""
        out, todo = [], [(0, np.arange(len(lifted)))]
        while todo:
            at, own = todo.pop()
            if not len(own):
                continue
            if self.vantage[at] is None:
                out.append((self.child[at][1], own))
                continue
            d = np.linalg.norm(lifted[own] - self.vantage[at], axis=1)
            for c, bound in ((self.child[at][0], d - self.radius[at]), (self.child[at][1], self.radius[at] - d)):
                todo.append((c, own[factor * bound <= far[own]]))
        return out


def search(tree: dict[str, np.ndarray], query_ids: np.ndarray, q: np.ndarray, k: int, factor: float, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the ``k`` nearest of each query in one tree, of those with a score of at least ``floor``."""
    ids, x, vantage, radius, child, rows = (tree[n] for n in ("ids", "x", "vantage", "radius", "child", "rows"))
    lifted = tree["lifted"] if "lifted" in tree else _lift(x, float(tree["top"]))
    n, none = len(q), len(ids)
    up = np.hstack([q, np.zeros((n, 1))])
    reach = (q * q).sum(1) + float(tree["top"])  # squared distance at inner product zero
    best = np.repeat((np.full(n, -np.inf) if floor is None else floor)[:, None], k, axis=1)
    best_at = np.full((n, k), none)  # rows ascend by id
    home = np.full(n, -1, np.int64)

    def scan(at: int, own: np.ndarray) -> None:
        points = rows[child[at, 0]:child[at, 1]]
        for lo in range(0, len(own), max(1, (1 << 22) // max(1, len(points)))):
            compare(points, own[lo:lo + max(1, (1 << 22) // max(1, len(points)))])

    def compare(points: np.ndarray, own: np.ndarray) -> None:
        rough = q[own] @ x[points].T
        miss = rough < (best[own, -1] - 1e-9 * (1 + reach[own]))[:, None]
        r, c = np.nonzero(~miss & (ids[points][None, :] != query_ids[own][:, None]))
        if not len(r):
            return
        # summed one component after the other, so that equal vectors have equal scores
        exact = np.zeros(len(r))
        for j in range(q.shape[1]):
            exact += q[own[r], j] * x[points[c], j]
        exact[np.isnan(exact)] = -np.inf
        some = np.unique(r)
        all_r = np.concatenate([np.repeat(some, k), r])
        all_s = np.concatenate([best[own[some]].ravel(), exact])
        all_i = np.concatenate([best_at[own[some]].ravel(), points[c]])
        by = np.lexsort((all_i, -all_s, all_r))
        first = np.searchsorted(all_r[by], some)
        take = by[first[:, None] + np.arange(k)]
        best[own[some]], best_at[own[some]] = all_s[take], all_i[take]

    def descend(at: int, own: np.ndarray) -> None:
        if not len(own):
            return
        if vantage[at] < 0:
            home[own] = at
            scan(at, own)
            return
        d = np.linalg.norm(up[own] - lifted[vantage[at]], axis=1)
        near = d <= radius[at]
        descend(child[at, 0], own[near])
        descend(child[at, 1], own[~near])

    def visit(at: int, own: np.ndarray) -> None:
        if not len(own):
            return
        if vantage[at] < 0:
            own = own[home[own] != at]
            if len(own):
                scan(at, own)
            return
        d = np.linalg.norm(up[own] - lifted[vantage[at]], axis=1)
        for c, bound in ((child[at, 0], d - radius[at]), (child[at, 1], radius[at] - d)):
            far = np.sqrt(np.maximum(reach[own] - 2 * best[own, -1], 0)) + _slack(reach[own])
            visit(c, own[~(factor * bound > far)])

    if len(ids):
        with np.errstate(over="ignore", invalid="ignore"):
            everyone = np.arange(n)
            if floor is None:
                descend(0, everyone)
            visit(0, everyone)
    row, col = np.nonzero(best_at < none)
    return row, ids[best_at[row, col]], best[row, col]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR, shard: int = SHARD, asked: int = ASKED, leaf: int = LEAF, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each query by inner product.

    ``vectors`` and ``queries`` have columns vec_id and embedding."""
    spark = vectors.sparkSession
    ship(spark)

    def clean(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        value = F.col("embedding").cast("array<double>")
        bad = F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        return written(df.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("embedding")).where(
            F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda v: v != 0)).select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "embedding", F.exists("embedding", lambda v: F.abs(v) > LARGE).alias("large")), name)

    rows, rows_path = clean(vectors, "vp-rows")
    asks, asks_path = clean(queries, "vp-asks")
    norm = F.aggregate("embedding", F.lit(0.0), lambda total, v: total + v * v)
    dim = F.size("embedding")
    count, least, most, top = rows.agg(F.count(F.lit(1)), F.min(dim), F.max(dim), F.max(F.when(~F.col("large"), norm))).first()
    low, high = asks.agg(F.min(dim), F.max(dim)).first()
    lengths = sorted({v for v in (least, most, low, high) if v is not None})
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {lengths}")
    if not count or low is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, top = lengths[0], top or 0.0

    need = max(16, sample_bytes // (8 * width))
    drawn = rows.where(~F.col("large") & (F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(min(1.0, 1.1 * need / count) * (1 << 30)))).select("embedding").limit(need).toArrow()
    regions = Regions(_vectors(drawn.column("embedding").combine_chunks()).reshape(-1, width), top, max(1, -(-count // shard)))
    outside = regions.count  # the region of the large ones

    def region_of(x: np.ndarray, large: np.ndarray) -> np.ndarray:
        out = np.full(len(x), outside, np.int64)
        out[~large] = regions.of(_lift(x[~large], top))
        return out

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = region_of(_vectors(batch.column("embedding")).reshape(-1, width), batch.column("large").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(region.astype(np.int32)), batch.column("row"), batch.column("vec_id"), batch.column("embedding")], names=["region", "row", "vec_id", "embedding"])

    routed, routed_path = written(arrow(rows, route, "region int, row long, vec_id long, embedding array<double>"), "vp-routed")
    drop(spark, rows_path)
    parts = np.zeros(outside + 1, np.int64)
    for r in routed.groupBy("region").count().collect():  # a row for each region of the top tree, which the sample bounds
        parts[r["region"]] = -(-r["count"] // (2 * shard))
    start = np.cumsum(parts) - parts
    shards = int(parts.sum())
    placing = spark.createDataFrame([(r, int(start[r]), int(parts[r])) for r in np.flatnonzero(parts).tolist()], "region int, start int, parts int")
    placed = routed.join(F.broadcast(placing), "region").withColumn("shard", (F.col("start") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int"))

    def grow(table: pa.Table) -> pa.Table:
        number = table.column("shard")[0].as_py()
        table = table.sort_by("row")
        x = _vectors(table.column("embedding").combine_chunks())
        tree = build(table.column("vec_id").to_numpy(), x, leaf, plain=number >= start[outside])
        return pa.table({"shard": pa.array([number], pa.int32()), "tree": pa.array([_saved(**tree)], pa.binary())})

    index, _ = written(placed.select("shard", "row", "vec_id", "embedding").groupBy("shard").applyInArrow(grow, "shard int, tree binary"), "vp-index")
    drop(spark, routed_path)

    def visits(requests: DataFrame, run, schema: str) -> DataFrame:
        """``run`` over (tree, batch of requests) for each shard; trees are sent once for ``asked`` requests."""
        copies = requests.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / asked).cast("int").alias("copies"))
        pairs = copies.agg(F.sum("copies")).first()[0] or 1
        copies = F.broadcast(copies) if shards <= 1 << 20 else copies  # a row of two integers for each shard
        spread = requests.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("row"), F.col("copies")).cast("int")).drop("copies")
        trees = index.join(copies, "shard").select("shard", "tree", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        both = trees.unionByName(spread, allowMissingColumns=True).repartition(min(int(pairs), 20000), "shard", "copy").sortWithinPartitions("shard", "copy", F.col("row").asc_nulls_first())

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree: dict[str, np.ndarray] = {}
            for batch in batches:
                heads = np.flatnonzero(batch.column("tree").is_valid().to_numpy(zero_copy_only=False))
                for a, b in zip([0, *(heads + 1)], [*heads, len(batch)]):
                    if b > a:
                        yield run(tree, batch.slice(a, b - a))
                    if b < len(batch):
                        tree = dict(np.load(io.BytesIO(batch.column("tree")[int(b)].as_py())))
                        with np.errstate(over="ignore", invalid="ignore"):
                            tree["lifted"] = _lift(tree["x"], float(tree["top"]))

        return arrow(both, stream, schema)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = region_of(_vectors(batch.column("embedding")).reshape(-1, width), batch.column("large").to_numpy(zero_copy_only=False))
            full = np.flatnonzero(parts)
            region = np.where(parts[region] > 0, region, full[0])
            number = start[region] + batch.column("row").to_numpy() % parts[region]
            yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), *[batch.column(c) for c in ("row", "vec_id", "embedding", "large")]], names=["shard", "row", "vec_id", "embedding", "large"])

    def first(tree: dict[str, np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
        """Each query's nearest in its home shard, and the other shards that may hold nearer ones."""
        q, large = _vectors(batch.column("embedding")).reshape(-1, width), batch.column("large").to_numpy(zero_copy_only=False)
        row, near, score = search(tree, batch.column("vec_id").to_numpy(), q, k, factor)
        ends = np.searchsorted(row, np.arange(len(q) + 1)).astype(np.int32)
        floor = np.where(np.diff(ends) == k, score[np.maximum(ends[1:] - 1, 0)] if len(score) else -np.inf, -np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            reach = (q * q).sum(1) + top
            far = np.where(large, np.inf, np.sqrt(np.maximum(reach - 2 * floor, 0)) + _slack(reach))
            lifted = np.hstack([q, np.zeros((len(q), 1))])
            lifted[large] = 0
            go = regions.within(lifted, far, factor) + [(outside, np.arange(len(q)))]
        who = np.concatenate([np.repeat(own, parts[r]) for r, own in go])
        where = np.concatenate([np.tile(start[r] + np.arange(parts[r]), len(own)) for r, own in go])
        other = where != batch.column("shard").to_numpy()[who]
        by = np.argsort(who[other], kind="stable")
        cuts = np.searchsorted(who[other][by], np.arange(len(q) + 1)).astype(np.int32)
        found = pa.StructArray.from_arrays([pa.array(near), pa.array(score)], names=["vec_id", "score"])
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("vec_id"), batch.column("embedding"), pa.array(floor), pa.ListArray.from_arrays(pa.array(ends), found),
             pa.ListArray.from_arrays(pa.array(cuts), pa.array(where[other][by].astype(np.int32)))],
            names=["row", "vec_id", "embedding", "floor", "near", "shards"])

    def more(tree: dict[str, np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
        row, near, score = search(tree, batch.column("vec_id").to_numpy(), _vectors(batch.column("embedding")).reshape(-1, width), k, factor, batch.column("floor").to_numpy())
        return pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(row)), batch.column("vec_id").take(pa.array(row)), pa.array(near), pa.array(score)], names=["row", "query_id", "vec_id", "score"])

    homes, homes_path = written(arrow(asks, home, "shard int, row long, vec_id long, embedding array<double>, large boolean"), "vp-asked")
    drop(spark, asks_path)
    known, _ = written(visits(homes, first, "row long, vec_id long, embedding array<double>, floor double, near array<struct<vec_id:long,score:double>>, shards array<int>"), "vp-home")
    drop(spark, homes_path)
    found = known.select("row", F.col("vec_id").alias("query_id"), F.inline("near"))
    if shards > 1:
        further = known.select("row", "vec_id", "embedding", "floor", F.explode("shards").alias("shard"))
        found = found.unionByName(visits(further, more, "row long, query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("row", "query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
