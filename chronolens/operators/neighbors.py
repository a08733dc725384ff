"""Previous / next sample of every point, per series, without a per-series task.

``lag``/``lead`` over ``Window.partitionBy(series)`` would put a whole series
in one task; a hot series (a third of all rows) would then be one task. We
instead window over ``(series, time bucket)`` and add *carry rows*: the last
sample of the previous non-empty bucket and the first sample of the next
non-empty bucket. Those come from a small ``(series, bucket)`` table (one row
per bucket, built with partial aggregation), so every window partition holds
one bucket of one series plus at most two extra rows.

Input: columns ``keys`` (series identity, hashable), ``ts_us`` (BIGINT) and
``value`` (DOUBLE); other columns pass through. Output adds ``prev_ts_us``,
``prev_value`` and/or ``next_ts_us``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import fdiv

DEFAULT_BUCKET_S = 3600


def with_neighbors(df: DataFrame, keys: Sequence[str], *, prev: bool = True,
                   next_: bool = False, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    keys = list(keys)
    bucket_us = int(bucket_s) * 1_000_000
    base = df.withColumn("_b", fdiv(F.col("ts_us"), F.lit(bucket_us)))

    tails = base.groupBy(*keys, "_b").agg(
        F.max("ts_us").alias("_last_ts"), F.max_by("value", "ts_us").alias("_last_v"),
        F.min("ts_us").alias("_first_ts"), F.min_by("value", "ts_us").alias("_first_v"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    tails = tails.select(*keys, "_b", "_last_ts", "_last_v", "_first_ts", "_first_v",
                         F.lead("_b").over(wb).alias("_nb"), F.lag("_b").over(wb).alias("_pb"))

    u = base.withColumn("_carry", F.lit(False))
    if prev:
        fwd = tails.where(F.col("_nb").isNotNull()).select(
            *keys, F.col("_nb").alias("_b"), F.col("_last_ts").alias("ts_us"),
            F.col("_last_v").alias("value"), F.lit(True).alias("_carry"))
        u = u.unionByName(fwd, allowMissingColumns=True)
    if next_:
        back = tails.where(F.col("_pb").isNotNull()).select(
            *keys, F.col("_pb").alias("_b"), F.col("_first_ts").alias("ts_us"),
            F.col("_first_v").alias("value"), F.lit(True).alias("_carry"))
        u = u.unionByName(back, allowMissingColumns=True)

    w = Window.partitionBy(*keys, "_b").orderBy("ts_us")
    extra = []
    if prev:
        extra += [F.lag("ts_us").over(w).alias("prev_ts_us"), F.lag("value").over(w).alias("prev_value")]
    if next_:
        extra.append(F.lead("ts_us").over(w).alias("next_ts_us"))
    return u.select("*", *extra).where(~F.col("_carry")).drop("_carry", "_b")
