"""Distributed ordered prefix sums.

``Σ_s offset_s · v_s`` with ``offset_s = Σ_{s' < s} n_{s'}`` (rows ordered by
``order_col`` inside each group) is what the pooled-ordinal slope needs. A
``Window.partitionBy(group).orderBy(...)`` would run each group in one task;
a group may hold a third of all rows, so instead:

1. range-partition the rows by ``(group, order)`` (balanced by sampling) and
   tag each row with its range partition — an order-preserving chunk id;
2. prefix sums inside each ``(group, chunk)`` (bounded by the chunk size);
3. prefix over chunk totals per group (at most ``chunks`` rows per group).

The chunk id is the range partition a row lands in. The partition bounds are
fixed once per shuffle (sampled from the input), so a retried task after an
executor loss assigns every row to the same chunk; callers pass a written
(materialised) input, so the sample itself is stable too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered_cross_sum(df: DataFrame, group_cols: Sequence[str], order_col: str,
                      n_col: str, v_col: str, chunks: int, out: str = "cross_sum") -> DataFrame:
    """Per group: ``Σ_s (Σ_{s'<s} n_{s'}) · v_s``; one row per group."""
    g = list(group_cols)
    ranged = (df.select(*g, order_col, n_col, v_col)
                .repartitionByRange(max(1, int(chunks)), *g, order_col)
                .withColumn("_chunk", F.spark_partition_id()))
    w = Window.partitionBy(*g, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_loc", F.coalesce(F.sum(n_col).over(w), F.lit(0)).cast("double"))
    per_chunk = local.groupBy(*g, "_chunk").agg(
        F.sum(n_col).alias("_cn"), F.sum(v_col).alias("_cv"),
        F.sum(F.col("_loc") * F.col(v_col)).alias("_lv"))
    w2 = Window.partitionBy(*g).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.withColumn("_off", F.coalesce(F.sum("_cn").over(w2), F.lit(0)).cast("double"))
    return per_chunk.groupBy(*g).agg(F.sum(F.col("_off") * F.col("_cv") + F.col("_lv")).alias(out))


def running_sum(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                sub_bucket: str, sums: dict[str, str]) -> DataFrame:
    """Running ``Σ value`` per partition in order, split by a time sub-bucket; ``sums``
    names the column of each value's sum. All values take the same sort and exchange.

    ``sub_bucket`` must be monotone in the order (e.g. the hour of the
    timestamp). Local running sums are taken per (partition, sub-bucket) and
    offset by the totals of earlier sub-buckets, so a hot partition is split
    across many tasks. Exact for integer and decimal values.
    """
    p = list(partition_cols)
    w = (Window.partitionBy(*p, sub_bucket).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.select("*", *[F.sum(v).over(w).alias(f"_local_{out}") for v, out in sums.items()])
    totals = df.groupBy(*p, sub_bucket).agg(*[F.sum(v).alias(f"_tot_{out}") for v, out in sums.items()])
    w2 = Window.partitionBy(*p).orderBy(sub_bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*p, sub_bucket, *[F.sum(f"_tot_{out}").over(w2).alias(f"_off_{out}") for out in sums.values()])
    joined = local.join(offsets, on=[*p, sub_bucket], how="left")
    zero = {out: F.lit(0).cast(local.schema[f"_local_{out}"].dataType) for out in sums.values()}
    return joined.select(*df.columns, *[(F.col(f"_local_{out}") + F.coalesce(F.col(f"_off_{out}"), zero[out])).alias(out)
                                        for out in sums.values()])
