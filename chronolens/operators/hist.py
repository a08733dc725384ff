"""``histogram_quantile(q, buckets)`` as native array expressions (no UDF).

Input: per-bucket points ``(group keys…, le, step, value)`` — typically the
``rate`` of a ``*_bucket`` metric. The buckets of one group at one step are
gathered with ``collect_list``; that group holds only the buckets of one
histogram at one step, so it is bounded by the bucket layout, not by data.

Semantics (public definition): sort by ``le``; merge equal bounds; force
monotonic counts (ignoring float noise below 1e-12 relative); no ``+Inf``
bucket, fewer than two buckets or zero observations → NaN; ``q < 0`` → −Inf,
``q > 1`` → +Inf; otherwise linear interpolation inside the first bucket whose
cumulative count reaches ``q·total`` (lower edge 0 for the first bucket,
answer ``le`` of the first bucket when it is ≤ 0, and the largest finite
bound when the rank falls in the ``+Inf`` bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_BUCKET_T = "array<struct<le:double,c:double>>"

def _merge_equal(sorted_: Column) -> Column:
    """Merge buckets with equal upper bound (input sorted by ``le``)."""
    empty = F.array().cast(_BUCKET_T)

    def merge(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        same = (F.size(acc) > 0) & (last["le"] == x["le"])
        merged_last = F.struct(x["le"].alias("le"), (last["c"] + x["c"]).alias("c"))
        return F.when(same, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(merged_last))) \
                .otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(sorted_, empty, merge)


_TINY = 2.2250738585072014e-308
_MAXF = 1.7976931348623157e308


def _monotonic(merged: Column) -> Column:
    """Cumulative counts made non-decreasing; differences below 1e-12
    relative are treated as float noise and flattened too."""
    empty = F.array().cast(_BUCKET_T)

    def almost(p, x):
        abs_sum = F.abs(p) + F.abs(x)
        diff = F.abs(p - x)
        degenerate = (p == 0) | (x == 0) | (abs_sum < F.lit(_TINY))
        return F.when(degenerate, diff < F.lit(1e-12 * _TINY)) \
                .otherwise(diff / F.least(abs_sum, F.lit(_MAXF)) < F.lit(1e-12))

    def keep_prev(p, x):
        return p.isNotNull() & ~F.isnan(x) & ~F.isnan(p) & (x != p) & (almost(p, x) | (x < p))

    zero = F.struct(empty.alias("arr"), F.lit(None).cast("double").alias("p"))

    def step(acc, b):
        nc = F.when(keep_prev(acc["p"], b["c"]), acc["p"]).otherwise(b["c"])
        return F.struct(F.concat(acc["arr"], F.array(F.struct(b["le"].alias("le"), nc.alias("c")))).alias("arr"),
                        nc.alias("p"))

    return F.aggregate(merged, zero, step, lambda acc: acc["arr"])


def with_quantile(df: DataFrame, q: Column, buckets: str, out: str = "value") -> DataFrame:
    """Adds the quantile of the histogram in column ``buckets``
    (``array<struct<le double, c double>>``). Each stage is its own column so
    every array expression is evaluated once per row."""
    usable = F.array_sort(F.filter(F.col(buckets), lambda b: b["le"].isNotNull() & ~F.isnan(b["le"])))
    # lateral aliases: one projection to analyse
    d = df.select("*", q.cast("double").alias("_q"), usable.alias("_sorted"),
                  _monotonic(_merge_equal(F.col("_sorted"))).alias("_mono"), F.size("_mono").alias("_n"),
                  F.get(F.col("_mono"), F.col("_n") - 1)["c"].alias("_total"),
                  (F.col("_q") * F.col("_total")).alias("_rank"))
    mono, n, rank = F.col("_mono"), F.col("_n"), F.col("_rank")
    # first 1-based index in [1, n-1] whose count reaches the rank; n if none
    reaches = F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                       lambda i: (i <= n - 1) & ~F.isnan(F.get(mono, i - 1)["c"]) & ~F.isnan(rank)
                       & (F.get(mono, i - 1)["c"] >= rank))
    d = d.withColumn("_bidx", F.coalesce(F.get(reaches, 0), n))
    b = F.col("_bidx")
    cur, prev = F.get(mono, b - 1), F.get(mono, b - 2)
    start = F.when(b > 1, prev["le"]).otherwise(F.lit(0.0))
    prev_c = F.when(b > 1, prev["c"]).otherwise(F.lit(0.0))
    count = cur["c"] - prev_c
    rank2 = rank - prev_c
    ratio = (F.when(count != 0, F.try_divide(rank2, count))
              .when(F.isnan(rank2) | (rank2 == 0), F.lit(float("nan")))
              .when(rank2 > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
    interp = start + (cur["le"] - start) * ratio
    nan = F.lit(float("nan"))
    qc, sorted_ = F.col("_q"), F.col("_sorted")
    value = (F.when(F.isnan(qc), nan)
              .when(qc < 0, F.lit(float("-inf")))
              .when(qc > 1, F.lit(float("inf")))
              .when(F.size(sorted_) == 0, nan)
              .when(F.get(sorted_, F.size(sorted_) - 1)["le"] != F.lit(float("inf")), nan)
              .when(n < 2, nan)
              .when(F.col("_total") == 0, nan)
              .when(b == n, F.get(mono, n - 2)["le"])
              .when((b == 1) & (cur["le"] <= 0), cur["le"])
              .otherwise(interp))
    return d.withColumn(out, value).drop("_q", "_sorted", "_mono", "_n", "_total", "_rank", "_bidx")


def histogram_quantile(points: DataFrame, q, group_keys: Sequence[str], *,
                       le_col: str = "le", step_cols: Sequence[str] = ("k", "step_ts"),
                       carry: Sequence[str] = ()) -> DataFrame:
    """Group bucket points by (group keys, step) and compute the quantile.

    ``le`` arrives as label text; unparseable bounds are ignored, as the
    public implementation ignores such series.
    """
    # No row filter on the parsed bound: ``le`` derives from the series key,
    # so Catalyst would push such a filter below the upstream aggregate and
    # evaluate it per sample. Unparseable bounds are dropped inside the array.
    pts = points.withColumn("_le", F.col(le_col).try_cast("double"))
    grouped = pts.groupBy(*group_keys, *step_cols).agg(
        F.collect_list(F.struct(F.col("_le").alias("le"), F.col("value").alias("c"))).alias("_buckets"),
        *[F.first(cc, ignorenulls=True).alias(cc) for cc in carry])
    # a group none of whose bounds parse has no histogram: no output row
    grouped = grouped.where(F.exists("_buckets", lambda b: b["le"].isNotNull()))
    extra = []
    if isinstance(q, (list, tuple)):
        # several quantiles from one grouping: each group row once per q
        grouped = grouped.withColumn("quantile", F.explode(F.array(*[F.lit(float(x)) for x in q])))
        qcol, extra = F.col("quantile"), ["quantile"]
    else:
        qcol = F.lit(float(q)) if isinstance(q, (int, float)) else F.col(q)
    out = with_quantile(grouped, qcol, "_buckets")
    return out.select(*group_keys, *step_cols, *carry, *extra, "value")
