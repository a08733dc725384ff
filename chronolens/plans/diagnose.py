"""The diagnostic job: the candidates of all registry entries in set-based passes.

Plan of a pass:

1. prune: samples of the candidates' metrics only, inside the widest reach of
   the window (both predicates reach the scan);
2. choose: each candidate's label matchers, tested once per distinct series —
   of the series table where there is one, so that no sample is read for it;
3. one interval table per series, its intervals the common divisor of the step
   and of all candidates' ranges; its rows fan out to the candidates;
4. per (candidate, series, step): gauges by as-of spans of the interval's last
   sample, counters by ``sliding.window_merge`` over the candidate's own number
   of intervals; histogram candidates then regroup buckets per (candidate,
   series-without-``le``, step) for the quantile;
5. summarise every candidate (two-level summary) and pick per entry the
   first candidate, in priority order, whose *evaluated* result is
   non-empty — else the primary's empty result.

One pass evaluates all candidates that have a series. ``staged`` makes two of it, in one
lazy plan. The first evaluates one candidate per entry: the first that has a series in
reach (without a series table: the primary). The second takes the later candidates of
the entries that the first left without a point. Its samples are filtered by the metrics
it needs, a broadcast of at most the registry's size; where none is needed, adaptive
execution drops the pass unread. Planning twice takes seconds whatever the data, so
staging pays where the alternatives' samples take longer than that to read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import MICROS
from ..model import Grid, TimeWindow, fmt_rfc3339, series_key
from ..operators import hist, rangefn
from ..operators import select as sel
from ..operators.neighbors import DEFAULT_BUCKET_S, with_neighbors
from ..operators.sliding import common_width, window_merge
from ..operators.summary import summarize
from ..session import default_parallelism, kept
from ..sources.samples import time_part_filter
from .registry import Registry


@dataclass
class DiagnoseResult:
    results: DataFrame       # one row per registry entry
    candidates: DataFrame    # one row per candidate, with its own summary
    points: DataFrame        # every evaluated point of every candidate
    held: tuple = ()         # tables kept from their first use on

    def unpersist(self) -> None:
        for df in self.held:
            df.unpersist()


def _matcher_ok() -> Column:
    """All matchers of a candidate; a missing label equals the empty string."""
    def ok(m):
        v = F.coalesce(F.when(m["label"] == "__name__", F.col("metric")).otherwise(F.col("labels")[m["label"]]), F.lit(""))
        found = F.rlike(v, F.concat(F.lit(r"\A(?s:"), m["value"], F.lit(r")\z")))
        return (F.when(m["op"] == "=", v == m["value"]).when(m["op"] == "!=", v != m["value"])
                 .when(m["op"] == "=~", found).otherwise(~found))
    return F.forall("matchers", ok)


def selected_by(registry: Registry) -> Column | None:
    """Whether any candidate selects a sample (None: matchers exclude nothing).

    The registry is a fixed table of a few dozen rows, so this is one short
    expression; a metric that some candidate takes whole needs no label test.
    """
    cands = [c for e in registry.entries for c in e.candidates]
    whole = sorted({c.metric for c in cands if not c.matchers})
    tests = [sel.matcher("__name__", "=", c.metric) & reduce(and_, (sel.matcher(*t) for t in c.tests()))
             for c in sorted(set(cands), key=repr) if c.matchers and c.metric not in whole]
    return reduce(or_, tests, F.col("metric").isin(whole)) if tests else None


def chosen_series(series: DataFrame, reg_df: DataFrame) -> DataFrame:
    """The (candidate, series) pairs of ``series`` rows ``(metric, series_key)``.

    Label matchers are evaluated once per distinct series, not per sample."""
    cands = reg_df.select(
        "cand_id", "ordinal", "priority", "metric", "matchers", "kind", "quantile",
        (F.when(F.col("kind") == "gauge", F.col("lookback_s")).otherwise(F.col("range_s")) * F.lit(MICROS))
        .alias("reach_us"),
        F.col("kind").isin("rate", "hquantile").alias("is_rate"))
    distinct = (series.select("metric", "series_key").distinct()
                      .withColumn("labels", F.from_json("series_key", "map<string,string>")))
    # the registry is a fixed table of a few dozen rows
    return (distinct.join(F.broadcast(cands), on="metric", how="inner").where(_matcher_ok())
                    .select("metric", "series_key", "cand_id", "ordinal", "priority", "kind", "quantile", "reach_us",
                            "is_rate"))


def in_reach(samples: DataFrame, grid: Grid, metrics: list[str], max_reach_s: int) -> DataFrame:
    lo_us = grid.start_us - max_reach_s * MICROS
    pruned = samples.where(F.col("metric").isin(metrics) & (F.col("ts") > F.timestamp_micros(F.lit(lo_us)))
                           & (F.col("ts") <= F.timestamp_micros(F.lit(grid.end_us))))
    prune = time_part_filter(samples, lo_us, grid.end_us)
    return pruned if prune is None else pruned.where(prune)


def series_in_reach(series: DataFrame, grid: Grid, metrics: list[str], max_reach_s: int) -> DataFrame:
    """Series with a day that meets the reach; some may have no sample in it."""
    lo_us = grid.start_us - max_reach_s * MICROS
    found = series.where(F.col("metric").isin(metrics) & (F.col("last_ts") > F.timestamp_micros(F.lit(lo_us)))
                         & (F.col("first_ts") <= F.timestamp_micros(F.lit(grid.end_us))))
    prune = time_part_filter(series, lo_us, grid.end_us)
    return found if prune is None else found.where(prune)


def evaluate_candidates(samples: DataFrame, reg_df: DataFrame, grid: Grid, *,
                        metrics: list[str], max_reach_s: int,
                        bucket_s: int = DEFAULT_BUCKET_S, range_s: int | None = None,
                        ranges_s: list[int] | None = None, selection: Column | None = None,
                        chosen: DataFrame | None = None) -> DataFrame:
    """Points ``(cand_id, series_key, k, step_ts, value)`` of all candidates.

    ``ranges_s`` are the candidates' distinct ranges (``range_s``: a single one).
    ``selection`` (``selected_by``) drops samples that no candidate selects
    right after the scan, before any shuffle. ``chosen`` are the pairs of
    ``chosen_series`` to evaluate; where it is given, only samples of its metrics are
    read, by a broadcast of their names. Without it the pairs come from the samples.
    """
    pruned = in_reach(samples, grid, metrics, max_reach_s)
    if selection is not None:
        pruned = pruned.where(selection)
    if chosen is None:
        chosen = chosen_series(pruned, reg_df)
    else:   # at most as many names as the registry has
        pruned = pruned.join(F.broadcast(chosen.select("metric").distinct()), "metric", "left_semi")
    chosen = chosen.select("metric", "series_key", "cand_id", "kind", "quantile", "reach_us", "is_rate")
    keys = ["cand_id", "metric", "series_key"]
    consts = ["is_gauge", "is_hq", "is_rate", "quantile", "reach_us"]
    g = F.col("is_gauge")
    if ranges_s is None:
        ranges_s = [] if range_s is None else [range_s]
    width = common_width(grid, [r * MICROS for r in ranges_s]) if ranges_s else None
    if width:
        # Per (series, interval) summaries are a property of the series:
        # built once from the pruned samples, then the (small) interval table
        # fans out to the candidates that select the series, each with its
        # own number of intervals.
        iv = rangefn.interval_table(pruned.select("metric", "series_key", "ts_us", "value"),
                                    ["metric", "series_key"], grid, width)
        ivc = iv.join(chosen, on=["metric", "series_key"], how="inner").select(
            "*", (F.col("kind") == "gauge").alias("is_gauge"), (F.col("kind") == "hquantile").alias("is_hq"))
        m = F.when(g, F.lit(1)).otherwise(F.try_divide(F.col("reach_us"), F.lit(width)).cast("long"))
        asof = rangefn.asof_steps(grid, F.col("last_ts_us"), F.col("last_next_ts_us"), F.col("reach_us"))
        agg = window_merge(ivc, keys, grid, width, m, single=g, single_steps=asof, consts=consts)
    else:
        # Neighbours belong to the series, not to the candidate: take them
        # once on the pruned samples, then fan out to the candidates.
        nb_s = with_neighbors(pruned.select("metric", "series_key", "ts_us", "value"),
                              ["metric", "series_key"], prev=True, next_=True, bucket_s=bucket_s)
        nb = (nb_s.join(chosen, on=["metric", "series_key"], how="inner")
                  .where(F.col("ts_us") > F.lit(grid.start_us) - F.col("reach_us"))
                  .select("cand_id", "metric", "series_key", (F.col("kind") == "gauge").alias("is_gauge"),
                          (F.col("kind") == "hquantile").alias("is_hq"), "quantile", "reach_us", "is_rate",
                          "ts_us", "value", "prev_ts_us", "prev_value", "next_ts_us"))
        lo_r, hi_r = rangefn.window_steps(grid, F.col("ts_us"), F.col("reach_us"))
        lo_g, hi_g = rangefn.asof_steps(grid, F.col("ts_us"), F.col("next_ts_us"), F.col("reach_us"))
        x = rangefn.explode_steps(nb, F.when(g, lo_g).otherwise(lo_r), F.when(g, hi_g).otherwise(hi_r))
        agg = rangefn.window_aggregate(x, keys, grid, F.col("reach_us"), consts=consts)
    agg = agg.where(F.col("is_gauge") | (F.col("n") >= 2))
    ext = rangefn.extrapolate(agg, grid, F.col("reach_us"), "is_rate")
    value = F.when(F.col("is_gauge"), F.col("last_v")).otherwise(F.col("value")).alias("value")
    pts = ext.select("cand_id", "series_key", "k", "is_hq", "quantile", value,
                     F.timestamp_micros(grid.step_ts_us(F.col("k"))).alias("step_ts"))
    # One grouping for every kind (no union of branches: pruning would shape
    # the shared aggregate differently per branch and defeat exchange reuse).
    # A histogram groups its buckets by the series without ``le``; any other
    # series is a group of one.
    labels = F.from_json("series_key", "map<string,string>")
    hq = F.col("is_hq")
    keyed = pts.select("*", F.when(hq, series_key(F.map_filter(labels, lambda k, v: k != "le")))
                             .otherwise(F.col("series_key")).alias("grp"),
                       F.when(hq, labels["le"].try_cast("double")).alias("_le"))
    grouped = (keyed.groupBy("cand_id", "grp", "k", "step_ts")
               .agg(F.first("is_hq").alias("is_hq"), F.first("quantile").alias("quantile"),
                    F.collect_list(F.struct(F.col("_le").alias("le"), F.col("value").alias("c"))).alias("_b"))
               .where(~F.col("is_hq") | F.exists("_b", lambda b: b["le"].isNotNull())))
    q = hist.with_quantile(grouped, F.col("quantile"), "_b", out="_qv")
    value = F.when(F.col("is_hq"), F.col("_qv")).otherwise(F.get(F.col("_b"), 0)["c"])
    return q.select("cand_id", F.col("grp").alias("series_key"), "k", "step_ts", value.alias("value"))


def _staged(samples: DataFrame, series: DataFrame | None, reg: Registry, reg_df: DataFrame, grid: Grid,
            bucket_s: int) -> tuple[DataFrame, tuple]:
    """Points of each entry's candidates, in two passes; and the tables that both read."""
    how = {"metrics": reg.metrics(), "max_reach_s": reg.reach_s(), "bucket_s": bucket_s, "ranges_s": reg.ranges_s()}
    if series is None:
        chosen = chosen_series(in_reach(samples, grid, how["metrics"], how["max_reach_s"]), reg_df)
        first = reg_df.select("ordinal", F.lit(0).alias("priority")).distinct()
    else:
        chosen = chosen_series(series_in_reach(series, grid, how["metrics"], how["max_reach_s"]), reg_df)
        first = chosen.groupBy("ordinal").agg(F.min("priority").alias("priority"))
    first = F.broadcast(first)   # a row per entry
    points = evaluate_candidates(samples, reg_df, grid, **how, selection=selected_by(reg),
                                 chosen=chosen.join(first, ["ordinal", "priority"], "left_semi"))
    if all(len(e.candidates) < 2 for e in reg.entries):
        return points, ()
    points = kept(points)
    answered = points.select("cand_id").distinct().join(reg_df.select("cand_id", "ordinal"), "cand_id")
    later = (chosen.join(F.broadcast(answered.select("ordinal").distinct()), "ordinal", "left_anti")
                   .join(first.withColumnRenamed("priority", "_tried"), "ordinal")
                   .where(F.col("priority") > F.col("_tried")))
    more = evaluate_candidates(samples, reg_df, grid, **how, selection=selected_by(reg), chosen=later)
    return points.unionByName(more), (points,)


def diagnose(spark: SparkSession, samples: DataFrame, registry: Registry, window: TimeWindow,
             step_s: int = 60, start=None, end=None, component: str = "all",
             bucket_s: int = DEFAULT_BUCKET_S, series: DataFrame | None = None,
             staged: bool = False) -> DiagnoseResult:
    """Run a bundle (``component``) or ``"all"`` over ``samples``. Nothing runs until an action.

    The requested range is clamped to the window; an inverted range (the
    request lies outside the window) evaluates to empty results. ``series`` is the
    samples' series table. ``staged`` reads the samples of alternatives only for the
    entries that need one; the others are in ``candidates`` without points, as the
    ones that select nothing.
    """
    reg = registry.bundle(component)
    s, e = window.clamp(start, end)
    grid = Grid.of(s, e, step_s)
    reg_df = reg.to_df(spark)
    held: tuple = ()
    if grid.empty:
        points = spark.createDataFrame([], "cand_id INT, series_key STRING, k INT, step_ts TIMESTAMP, value DOUBLE")
    elif staged:
        points, held = _staged(samples, series, reg, reg_df, grid, bucket_s)
    else:
        chosen = None if series is None else chosen_series(
            series_in_reach(series, grid, reg.metrics(), reg.reach_s()), reg_df)
        points = kept(evaluate_candidates(samples, reg_df, grid, metrics=reg.metrics(), max_reach_s=reg.reach_s(),
                                          bucket_s=bucket_s, ranges_s=reg.ranges_s(), selection=selected_by(reg),
                                          chosen=chosen))
        held = (points,)
    pts = points.withColumn("ts_s", F.unix_micros("step_ts").cast("double") / F.lit(1e6))
    summ = summarize(pts, ["cand_id"], "ts_s", chunks=default_parallelism(spark))
    cand = (reg_df.join(summ, on="cand_id", how="left")
                  .withColumn("status", F.when(F.coalesce(F.col("n_points"), F.lit(0)) > 0, F.lit("ok"))
                                         .otherwise(F.lit("empty"))))
    cand = _fill_empty(cand)
    winners = (cand.groupBy("ordinal").agg(
        F.coalesce(F.min(F.when(F.col("status") == "ok", F.col("priority"))), F.lit(0)).alias("priority")))
    res = cand.join(winners, on=["ordinal", "priority"], how="inner").select(
        "*", (F.col("priority") > 0).alias("fallback_used"), F.lit(None).cast("string").alias("error"),
        F.lit(component).alias("subsystem"), F.lit(fmt_rfc3339(window.start)).alias("query_window_start"),
        F.lit(fmt_rfc3339(window.end)).alias("query_window_end"), F.lit(fmt_rfc3339(s)).alias("window_start"),
        F.lit(fmt_rfc3339(e)).alias("window_end"))
    return DiagnoseResult(res, cand, points, held)


def _fill_empty(cand: DataFrame) -> DataFrame:
    """A candidate without a result has the all-zero summary with trend ""."""
    defaults = {"series_count": F.lit(0).cast("long"), "n_points": F.lit(0).cast("long"),
                "max_value": F.lit(0.0), "avg_value": F.lit(0.0), "non_zero_percentage": F.lit(0.0),
                "trend": F.lit("")}
    return cand.withColumns({col: F.coalesce(F.col(col), d) for col, d in defaults.items()})


__all__ = ["diagnose", "evaluate_candidates", "chosen_series", "DiagnoseResult"]
