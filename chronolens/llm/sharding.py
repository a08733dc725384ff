"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with u from a hash of the row's key and the child's path, and
the smallest draw wins, so that a child gets rows in proportion to its weight.
A draw depends on the key, the path and the child's own weight only: when the
weight of a subtree changes, rows move into it or out of it and nowhere else.

Native: DataFrame functions alone.

Defined results: a null key is hashed as its own key; a null text has no bytes
(size 16, crc32 0); repeated rows each get a slot; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, base: int = 40, racks: int = 2, per_rack: int = 4) -> list[Leaf]:
    """Shards 0 to ``shards - 1``: the first ``base`` in regions of ``racks`` x ``per_rack``.

    Each shard from ``base`` on comes as a region of its own, so that adding one
    changes the weight of no older subtree.
    """
    region = racks * per_rack
    out = [Leaf(s // region, s % region // per_rack, s) for s in range(min(shards, base))]
    first = -(-base // region)
    return out + [Leaf(first + s - base, 0, s) for s in range(base, shards)]


def _draw(key: Column, path: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(weight))


def _winner(key: Column, children: dict[int, tuple[str, float]]) -> Column:
    if len(children) == 1:
        return F.lit(next(iter(children)))
    return F.array_min(F.array(*[F.struct(_draw(key, path, w).alias("d"), F.lit(c).alias("c")) for c, (path, w) in children.items()]))["c"]


def _chosen(of: list[Column], by: list[tuple[list[int], Column]]) -> Column:
    out = None
    for at, value in by:
        here = F.lit(True)
        for c, v in zip(of, at):
            here = here & (c == v)
        out = F.when(here, value) if out is None else out.when(here, value)
    return out


def place(df: DataFrame, key: str, leaves: list[Leaf], out: str = "shard") -> DataFrame:
    """``df`` with column ``out``: the shard that the key's descent through the tree ends in."""
    live = [x for x in leaves if x.weight > 0]
    if not live:
        raise ValueError("the tree has no shard with a weight")
    regions: dict[int, dict[int, dict[int, float]]] = {}
    for x in live:
        regions.setdefault(x.region, {}).setdefault(x.rack, {})[x.shard] = x.weight
    weigh = lambda racks: sum(sum(s.values()) for s in racks.values())
    k = F.coalesce(F.col(key).cast("string"), F.lit("\0null"))
    r, q = f"__{out}_region", f"__{out}_rack"
    df = df.withColumn(r, _winner(k, {i: (f"{i}", weigh(racks)) for i, racks in regions.items()}))
    df = df.withColumn(q, _chosen([F.col(r)], [([i], _winner(k, {j: (f"{i}/{j}", sum(s.values())) for j, s in racks.items()})) for i, racks in regions.items()]))
    df = df.withColumn(out, _chosen([F.col(r), F.col(q)], [([i, j], _winner(k, {s: (f"{i}/{j}/{s}", w) for s, w in shards.items()})) for i, racks in regions.items() for j, shards in racks.items()]))
    return df.drop(r, q)


def slotted(df: DataFrame, shard: str = "shard", out: str = "slot") -> DataFrame:
    """``df`` with ``out``: gapless row numbers from 0 in each shard.

    The rows are written once with an id that names their partition. A window then
    ranks (shard, partition) and a running sum over the partitions' counts adds the
    offset: a shard, or one hot key, is never a single task.
    """
    placed, _ = written(df.withColumn("__id", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("__part", F.shiftrightunsigned("__id", 33))
    counts = placed.groupBy(F.col(shard).alias("__s"), F.col("__part").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__s").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__s", "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = placed.withColumn("__row", F.row_number().over(Window.partitionBy(shard, "__part").orderBy("__id")))
    joined = ranked.join(offsets, (F.col(shard) == F.col("__s")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn(out, F.col("__before") + F.col("__row") - 1).drop("__s", "__p", "__before", "__row", "__part", "__id")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Every document's shard under the law ``key``, its slot there, and its shard were there one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = place(place(rows, "doc_id", tree(shards)), "doc_id", tree(shards + 1), "grown_shard")
    return slotted(rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
