"""The per-query statistical summary and trend label.

All statistics pool every valid point of every series of one query result,
in a fixed order: series by ``series_key``, then time. A response that sets an
order of its own (``series_order``, ``pos_cols``) is pooled in that order.

* ``series_count`` — series in the result, including ones with no valid point;
* ``max_value`` / ``max_timestamp`` — strict ``>`` scan from −Inf: NaN never
  wins, the first maximum in pooled order wins ties, an all-NaN (or all −Inf)
  result keeps −Inf and the epoch;
* ``avg_value`` — mean (NaN/Inf propagate);
* ``non_zero_percentage`` — ``count(v ≠ 0) / count · 100`` (NaN counts);
* ``trend`` — least-squares slope over the pooled ordinal and the coefficient
  of variation, labelled by the rule chain in ``trend_label``; ``""`` when
  there is no valid point.

Plan: two levels, never a whole query in one task.
(1) per (query, series): count, sums, variance, first maximum and ``Σ i·v``
    with the series-local ordinal ``i`` (a window bounded by the step count);
(2) per query: merge the series rows; the cross term of the pooled ordinal
    comes from a range-partitioned prefix sum (``functions.prefix``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import gt, ieee_div, lt, rfc3339_from_seconds
from ..functions.prefix import ordered_cross_sum
from ..session import kept

SUMMARY_COLS = ["series_count", "n_points", "max_value", "max_timestamp", "avg_value",
                "non_zero_percentage", "trend", "slope", "cv"]


def series_stats(points: DataFrame, group_cols: Sequence[str], order_col: str = "ts_s",
                 pos_cols: Sequence[str] = (), key_cols: Sequence[str] = ("series_key",),
                 series_order: Sequence[str] = ()) -> DataFrame:
    """Level 1: one row per (group, series), with its place ``_ord`` among the group's series.

    ``points`` has ``group_cols``, ``series_key``, ``order_col`` (epoch
    seconds, DOUBLE) and ``value`` (NULL marks a point that failed decoding;
    a series made only of such rows still counts as a series).
    """
    g = [*group_cols, *key_cols]
    valid = F.col("value").isNotNull()
    w = Window.partitionBy(*g).orderBy(F.col("_valid").desc(), *(pos_cols or [order_col]))
    p = (points.withColumn("_valid", valid)
               .withColumn("_i", (F.row_number().over(w) - 1).cast("double")))
    v = F.col("value")
    cand = valid & ~F.isnan(v) & (v > F.lit(float("-inf")))
    return p.groupBy(*g).agg(
        F.min(F.struct(*series_order, *key_cols)).alias("_ord"),
        F.count(v).alias("n_s"),
        F.sum(v).alias("sv"),
        F.sum(F.col("_i") * v).alias("siv"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
        F.count_if(valid & (v != 0)).alias("nz"),
        F.min(F.when(cand, F.struct((-v).alias("nv"), F.col("_i").alias("i"),
                                     F.col(order_col).alias("ts"))))
         .alias("best"))


def summarize(points: DataFrame, group_cols: Sequence[str], order_col: str = "ts_s",
              chunks: int = 8, materialize=True, **order) -> DataFrame:
    """Level 1 + level 2: one summary row per group (groups with ≥ 1 series).

    The series table (one row per result series) is kept from its first use on:
    level 2 reads it several times (and range partitioning samples it), which
    would otherwise re-run the whole upstream evaluation. No job runs here.
    """
    g = list(group_cols)
    s = series_stats(points, g, order_col, **order)
    if materialize:
        s = kept(s)
    return summarize_series(s, g, chunks)


def summarize_series(s: DataFrame, group_cols: Sequence[str], chunks: int = 8) -> DataFrame:
    g = list(group_cols)
    nz_series = s.where(F.col("n_s") > 0)
    per_group = s.groupBy(*g).agg(
        F.count(F.lit(1)).alias("series_count"),
        F.sum("n_s").alias("n_points"),
        F.sum("sv").alias("sum_v"),
        F.sum("siv").alias("sum_iv"),
        F.sum("nz").alias("nz"),
        F.sum(F.when(F.col("n_s") > 0, F.col("m2"))).alias("m2_within"),
        F.sum(F.when(F.col("n_s") > 0, F.try_divide(F.col("sv") * F.col("sv"), F.col("n_s")))).alias("sq_means"),
        F.min(F.when(F.col("best").isNotNull(),
                     F.struct(F.col("best.nv").alias("nv"), F.col("_ord"),
                              F.col("best.i").alias("i"), F.col("best.ts").alias("ts")))).alias("best"))
    cross = ordered_cross_sum(nz_series, g, "_ord", "n_s", "sv", chunks)
    joined = per_group.join(cross, on=g, how="left")
    return _finish(joined, g)


def _finish(df: DataFrame, g: list[str]) -> DataFrame:
    n = F.col("n_points").cast("double")
    mean = ieee_div(F.col("sum_v"), n)
    m2 = F.col("m2_within") + (F.col("sq_means") - F.try_divide(F.col("sum_v") * F.col("sum_v"), n))
    std = F.sqrt(F.try_divide(F.greatest(m2, F.lit(0.0)), n))
    sum_x = n * (n - 1) / 2
    sum_x2 = (n - 1) * n * (2 * n - 1) / 6
    sum_xy = F.coalesce(F.col("cross_sum"), F.lit(0.0)) + F.col("sum_iv")
    slope = ieee_div(n * sum_xy - sum_x * F.col("sum_v"), n * sum_x2 - sum_x * sum_x)
    d = (df.withColumn("_mean", mean).withColumn("_std", std).withColumn("slope", slope))
    d = d.withColumn("cv", F.when(F.col("_mean") != 0, ieee_div(F.col("_std"), F.abs(F.col("_mean"))))
                             .otherwise(F.lit(0.0)))
    has = F.col("n_points") > 0
    max_value = F.when(F.col("best").isNotNull(), -F.col("best.nv")).otherwise(F.lit(float("-inf")))
    max_ts = F.when(F.col("best").isNotNull(), rfc3339_from_seconds(F.col("best.ts"))) \
              .otherwise(rfc3339_from_seconds(F.lit(0)))
    return d.select(
        *g,
        F.col("series_count").cast("long").alias("series_count"),
        F.col("n_points").cast("long").alias("n_points"),
        F.when(has, max_value).otherwise(F.lit(0.0)).alias("max_value"),
        F.when(has, max_ts).alias("max_timestamp"),
        F.when(has, F.col("_mean")).otherwise(F.lit(0.0)).alias("avg_value"),
        F.when(has, ieee_div(F.col("nz").cast("double"), n) * F.lit(100.0)).otherwise(F.lit(0.0))
         .alias("non_zero_percentage"),
        F.when(has, trend_label(F.col("n_points"), F.col("_mean"), F.col("slope"), F.col("cv")))
         .otherwise(F.lit("")).alias("trend"),
        F.when(F.col("n_points") >= 2, F.col("slope")).alias("slope"),
        F.when(F.col("n_points") >= 2, F.col("cv")).alias("cv"))


def trend_label(n: Column, mean: Column, slope: Column, cv: Column) -> Column:
    """The label rules, in order; every comparison with NaN is false."""
    abs_mean = F.abs(mean)
    nonzero_mean = mean != 0          # true for NaN, as in the reference
    norm_abs = F.when(nonzero_mean, ieee_div(F.abs(slope), abs_mean)).otherwise(F.lit(0.0))
    norm = ieee_div(slope, abs_mean)
    return (F.when(n < 2, F.lit("stable"))
             .when(gt(cv, 0.5) & (lt(norm_abs, 0.1) | gt(cv, 0.8)), F.lit("spiky"))
             .when(nonzero_mean & gt(norm, 0.05), F.lit("increasing"))
             .when(nonzero_mean & lt(norm, -0.05), F.lit("decreasing"))
             .when(~nonzero_mean & gt(slope, 0.001), F.lit("increasing"))
             .when(~nonzero_mean & lt(slope, -0.001), F.lit("decreasing"))
             .otherwise(F.lit("stable")))

