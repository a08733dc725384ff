"""Time-series operators on a step grid (instant selectors, range functions).

Semantics follow the public PromQL definitions:

* a step ``t`` with range ``r`` sees samples in ``(t − r, t]``;
* an instant selector at ``t`` takes the latest sample in ``(t − lookback, t]``;
* ``increase``/``rate`` use the counter-reset correction and the boundary
  extrapolation of the public implementation; ``rate`` divides by ``r``.

Plan shape, never a range join, integer microseconds everywhere:

* the step and the range have a common divisor that is not much finer than the
  step (the common case): every window is a run of intervals of that width.
  Each sample is aggregated once per (series, interval) — inner pairs from a
  ``lag`` per (series, interval), entering pairs from a ``lag`` over the
  interval rows — and ``sliding.window_merge`` merges at most two rows for
  each step, however long the range is. Two exchanges in all; no per-series task.
* any other range: each sample is exploded to exactly the steps whose window
  holds it (``k ∈ [⌈(ts−S)/P⌉, ⌈(ts+r−S)/P⌉−1] ∩ [0, K]``), with neighbours
  from ``operators.neighbors``, then one grouped aggregate per
  ``(series, step)`` that runs partial (map-side) before its exchange.

A sample that repeats another's series and time counts once: in one table the
largest value stays (NaN is the largest); ``samples.write_samples`` applies the
same rule, and a later batch replaces an earlier one's.

Inputs are DataFrames with the series identity columns ``keys``, ``ts_us``
(BIGINT) and ``value``; ``carry`` columns (e.g. ``labels``) are constant per
series and ride along. Range/lookback may be an int (seconds) or the name of
a per-series column holding microseconds (for registry jobs where every
candidate has its own range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import MICROS, ceil_div, ieee_div, lt
from ..model import CHUNK_COL, Grid
from .neighbors import DEFAULT_BUCKET_S, with_neighbors
from .sliding import common_width, window_merge


def _us(param) -> Column:
    """Seconds (number) → microsecond literal; column name → that column."""
    if isinstance(param, Column):
        return param
    if isinstance(param, str):
        return F.col(param)
    return F.lit(int(round(float(param) * MICROS)))


def _key_list(keys, param) -> list[str]:
    keys = list(keys)
    if isinstance(param, str) and param not in keys:
        keys.append(param)
    return keys


def _rebuild(col: str) -> Column:
    """Per-series constant columns are not pushed through aggregates (a map
    buffer forces sort-based aggregation); ``labels`` is rebuilt from the
    series key, which is its JSON form."""
    if col == "labels":
        return F.from_json(F.col("series_key"), "map<string,string>").alias("labels")
    raise ValueError(f"cannot rebuild carry column {col!r}; add it to the keys")


def in_reach(df: DataFrame, grid: Grid, reach, ts_col: str = "ts") -> DataFrame:
    """Keep samples that any step can see: ``ts ∈ (start − reach, end]``.

    Written on the raw timestamp column so Catalyst pushes it to the scan.
    For a per-row reach (column) the scalar pre-filter uses ``max_reach_s``.
    """
    lo = F.timestamp_micros(F.lit(grid.start_us) - _us(reach))
    hi = F.timestamp_micros(F.lit(grid.end_us))
    out = df.where((F.col(ts_col) > lo) & (F.col(ts_col) <= hi))
    if isinstance(reach, (int, float)):
        from ..sources.samples import time_part_filter
        prune = time_part_filter(df, grid.start_us - int(reach * MICROS), grid.end_us)
        if prune is not None:
            out = out.where(prune)
    return out


def step_grid(grid: Grid) -> Column:
    """Array of step timestamps; empty (not an error) for an inverted range."""
    if grid.empty:
        return F.array().cast("array<timestamp>")
    return F.transform(F.sequence(F.lit(0), F.lit(grid.k_max)),
                       lambda k: F.timestamp_micros(grid.step_ts_us(k)))


def request_steps(start_us: Column, end_us: Column, step_us: int) -> Column:
    """Column form of the grid for a table of (clamped) requests.

    ``sequence`` raises on an inverted range, so it is guarded: an inverted
    request (clamp pushed start past end) has no steps.
    """
    k_max = F.try_divide(end_us - start_us, F.lit(step_us)).cast("long")
    return F.when(start_us <= end_us,
                  F.transform(F.sequence(F.lit(0).cast("long"), k_max),
                              lambda k: start_us + k * F.lit(step_us))
                  ).otherwise(F.array().cast("array<long>"))


def asof_steps(grid: Grid, ts_us: Column, next_ts_us: Column, lb_us: Column) -> tuple[Column, Column]:
    """Steps a sample answers as an instant selector: ``[ts, min(next, ts + lookback))``."""
    S, P, K = F.lit(grid.start_us), F.lit(grid.step_us), F.lit(grid.k_max)
    cover_end = F.least(F.coalesce(next_ts_us, ts_us + lb_us), ts_us + lb_us)
    lo = F.greatest(F.lit(0).cast("long"), ceil_div(ts_us - S, P))
    hi = F.least(K.cast("long"), ceil_div(cover_end - S, P) - 1)
    return lo, hi


def window_steps(grid: Grid, ts_us: Column, r_us: Column) -> tuple[Column, Column]:
    return _steps_for_window(grid, ts_us, r_us)


def explode_steps(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    return _explode_steps(df, lo, hi)


def window_aggregate(x: DataFrame, keys: Sequence[str], grid: Grid, r_us: Column,
                     consts: Sequence[str] = ()) -> DataFrame:
    """Per (keys, step): count, first/last sample and the counter-reset sum of
    pairs inside the window. ``consts`` are per-key constants (fixed-width
    types keep the aggregate hash-based)."""
    t_us = grid.step_ts_us(F.col("k"))
    in_pair = (F.col("prev_ts_us") > t_us - r_us) & lt(F.col("value"), F.col("prev_value"))
    return x.groupBy(*keys, "k").agg(
        *[F.first(cc).alias(cc) for cc in consts],
        F.count(F.lit(1)).alias("n"),
        F.min("ts_us").alias("first_ts_us"), F.max("ts_us").alias("last_ts_us"),
        F.min_by("value", "ts_us").alias("first_v"), F.max_by("value", "ts_us").alias("last_v"),
        F.sum(F.when(in_pair, F.col("prev_value")).otherwise(F.lit(0.0))).alias("resets"))


def extrapolate(agg: DataFrame, grid: Grid, r_us: Column, is_rate) -> DataFrame:
    """Adds ``value``: the extrapolated increase, or rate where ``is_rate``."""
    return _extrapolate(agg, grid, r_us, is_rate)


def interval_table(df: DataFrame, keys: Sequence[str], grid: Grid, width_us: int | None = None) -> DataFrame:
    """Per (series, interval ``j``) summary without a neighbour pass; interval ``j`` is
    ``(S + (j − 1)·width, S + j·width]``, of the step's width by default.

    Pairs inside an interval come from ``lag`` over ``(series, j)`` (bounded
    by the samples of one interval); pairs entering an interval come
    from ``lag`` over the interval rows of the series (bounded by the number
    of intervals). The grouping reuses the window's partitioning (no exchange).
    Columns: ``keys``, ``j``, ``n``, first/last sample, ``sum_v``, ``inner_reset``,
    ``cross_reset`` and ``last_next_ts_us`` (first sample after the interval).

    Samples of a bucketed table are grouped by their chunk too, which its buckets already do,
    so that no raw sample is exchanged; the pieces of an interval that lies in two chunks
    are then put together like neighbouring intervals.
    """
    keys = list(keys)
    chunk = [CHUNK_COL] if CHUNK_COL in df.columns else []
    S, P = F.lit(grid.start_us), F.lit(width_us or grid.step_us)
    by = Window.partitionBy(*keys, *chunk, "j")
    w, w_all = by.orderBy("ts_us"), by.orderBy("ts_us", "value")
    # a repeated sample counts once: the last of equal times, which holds the largest value
    d = (df.select(*keys, *chunk, "ts_us", "value").withColumn("j", ceil_div(F.col("ts_us") - S, P))
           .withColumn("_nt", F.lead("ts_us").over(w_all))
           .where(F.col("_nt").isNull() | (F.col("_nt") != F.col("ts_us")))
           .withColumn("_pv", F.lag("value").over(w)))
    inner = F.when(F.col("_pv").isNotNull() & lt(F.col("value"), F.col("_pv")), F.col("_pv")).otherwise(F.lit(0.0))
    iv = d.groupBy(*keys, *chunk, "j").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts_us").alias("first_ts_us"), F.max("ts_us").alias("last_ts_us"),
        F.min_by("value", "ts_us").alias("first_v"), F.max_by("value", "ts_us").alias("last_v"),
        F.sum("value").alias("sum_v"), F.sum(inner).alias("inner_reset"))
    wi = Window.partitionBy(*keys).orderBy("j", *chunk)
    iv = (iv.withColumn("_plv", F.lag("last_v").over(wi))
            .withColumn("last_next_ts_us", F.lead("first_ts_us").over(wi)))
    cross = F.when(F.col("_plv").isNotNull() & lt(F.col("first_v"), F.col("_plv")), F.col("_plv")) \
             .otherwise(F.lit(0.0))
    iv = iv.withColumn("cross_reset", cross)
    if chunk:
        iv = _whole_intervals(iv.withColumn("_begins", F.coalesce(F.lag("j").over(wi) != F.col("j"), F.lit(True))), keys)
    return iv.drop("_plv")


def _whole_intervals(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per interval out of the pieces that chunks cut it into; the reset on entering a
    later piece (not ``_begins``) lies inside the interval. The keys' partitioning is kept."""
    entered = F.when(F.col("_begins"), F.lit(0.0)).otherwise(F.col("cross_reset"))
    return pieces.groupBy(*keys, "j").agg(
        F.sum("n").alias("n"), F.min("first_ts_us").alias("first_ts_us"), F.max("last_ts_us").alias("last_ts_us"),
        F.min_by("first_v", "first_ts_us").alias("first_v"), F.max_by("last_v", "last_ts_us").alias("last_v"),
        F.sum("sum_v").alias("sum_v"), F.sum(F.col("inner_reset") + entered).alias("inner_reset"),
        F.max_by("last_next_ts_us", "last_ts_us").alias("last_next_ts_us"),
        F.sum(F.col("cross_reset") - entered).alias("cross_reset"))


def intervals_apply(grid: Grid, range_us: int) -> bool:
    """True when every window ``(t − r, t]`` is a run of intervals that the step is cut into."""
    return common_width(grid, [range_us]) is not None


def _width(grid: Grid, range_s) -> int | None:
    """Width of the intervals for one range in seconds; None where they don't apply."""
    return common_width(grid, [int(round(range_s * MICROS))]) if isinstance(range_s, (int, float)) else None


def _steps_for_window(grid: Grid, ts_us: Column, r_us: Column) -> tuple[Column, Column]:
    """Steps whose window ``(t−r, t]`` contains ``ts``."""
    S, P, K = F.lit(grid.start_us), F.lit(grid.step_us), F.lit(grid.k_max)
    lo = F.greatest(F.lit(0).cast("long"), ceil_div(ts_us - S, P))
    hi = F.least(K.cast("long"), ceil_div(ts_us + r_us - S, P) - 1)
    return lo, hi


def _explode_steps(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    return (df.withColumn("_lo", lo).withColumn("_hi", hi)
              .where(F.col("_lo") <= F.col("_hi"))
              .withColumn("k", F.explode(F.sequence(F.col("_lo").cast("int"), F.col("_hi").cast("int"))))
              .drop("_lo", "_hi"))


def range_vector(df: DataFrame, keys: Sequence[str], grid: Grid, range_s,
                 carry: Sequence[str] = ()) -> DataFrame:
    """``m[r]`` on the grid: per (series, step) the samples in the window.

    Returns one row per (series, step) with ``n``, ``first_ts_us``,
    ``last_ts_us``, ``sum_value``; no per-sample list is materialised.
    """
    keys = _key_list(keys, range_s)
    r = _us(range_s)
    if width := _width(grid, range_s):
        iv = interval_table(df, keys, grid, width)
        agg = window_merge(iv, keys, grid, width, F.lit(int(round(range_s * MICROS)) // width), sums=True)
        return (agg.select(*keys, "k", "n", "first_ts_us", "last_ts_us", "sum_value")
                   .withColumn("step_ts", F.timestamp_micros(grid.step_ts_us(F.col("k"))))
                   .select("*", *[_rebuild(cc) for cc in carry]))
    lo, hi = _steps_for_window(grid, F.col("ts_us"), r)
    x = _explode_steps(df, lo, hi)
    return (x.groupBy(*keys, "k").agg(
                F.count(F.lit(1)).alias("n"), F.min("ts_us").alias("first_ts_us"),
                F.max("ts_us").alias("last_ts_us"), F.sum("value").alias("sum_value"))
             .withColumn("step_ts", F.timestamp_micros(grid.step_ts_us(F.col("k"))))
             .select("*", *[_rebuild(cc) for cc in carry]))


def extrapolated(df: DataFrame, keys: Sequence[str], grid: Grid, range_s, *,
                 is_rate, carry: Sequence[str] = (), bucket_s: int = DEFAULT_BUCKET_S,
                 neighbors_done: bool = False) -> DataFrame:
    """``increase(m[r])`` / ``rate(m[r])`` on the grid.

    ``is_rate`` is a bool or the name of a per-series boolean column. Steps
    whose window holds fewer than two samples produce no point. The metric
    name is dropped by the caller's projection (series identity stays).
    """
    keys = _key_list(keys, range_s)
    if isinstance(is_rate, str) and is_rate not in keys:
        keys.append(is_rate)
    r = _us(range_s)
    t_us = grid.step_ts_us(F.col("k"))
    if not neighbors_done and (width := _width(grid, range_s)):
        iv = interval_table(df, keys, grid, width)
        agg = window_merge(iv, keys, grid, width, F.lit(int(round(range_s * MICROS)) // width))
    else:
        src = df if neighbors_done else with_neighbors(df, keys, prev=True, bucket_s=bucket_s)
        lo, hi = _steps_for_window(grid, F.col("ts_us"), r)
        agg = window_aggregate(_explode_steps(src, lo, hi), keys, grid, r)
    agg = agg.where(F.col("n") >= 2)
    out = _extrapolate(agg, grid, r, is_rate)
    return out.select(*keys, *[_rebuild(cc) for cc in carry], "k",
                      F.timestamp_micros(t_us).alias("step_ts"), "value")


def _extrapolate(agg: DataFrame, grid: Grid, r_us: Column, is_rate) -> DataFrame:
    t_us = grid.step_ts_us(F.col("k"))
    raw = (F.col("last_v") - F.col("first_v")) + F.col("resets")
    si = (F.col("last_ts_us") - F.col("first_ts_us")).cast("double") / F.lit(1e6)
    avg = ieee_div(F.col("_si"), (F.col("n") - 1).cast("double"))
    d0 = (F.col("first_ts_us") - (t_us - r_us)).cast("double") / F.lit(1e6)
    d1 = (t_us - F.col("last_ts_us")).cast("double") / F.lit(1e6)
    d0a = F.when(F.col("_d0") >= F.col("_th"), F.col("_avg") / F.lit(2.0)).otherwise(F.col("_d0"))
    to_zero = F.col("_si") * ieee_div(F.col("first_v"), F.col("_raw"))
    # zero clamp: a counter cannot go below 0, so do not extrapolate past it
    zero_ok = (F.col("_raw") > 0) & (F.col("first_v") >= 0) & ~F.isnan(F.col("_raw"))
    d0b = F.when(zero_ok & (to_zero < F.col("_d0a")), to_zero).otherwise(F.col("_d0a"))
    d1a = F.when(F.col("_d1") >= F.col("_th"), F.col("_avg") / F.lit(2.0)).otherwise(F.col("_d1"))
    factor = ieee_div((F.col("_si") + F.col("_d0b")) + F.col("_d1a"), F.col("_si"))
    rate_flag = F.lit(bool(is_rate)) if isinstance(is_rate, bool) else F.col(is_rate)
    r_s = r_us.cast("double") / F.lit(1e6)
    value = F.when(rate_flag, F.col("_raw") * ieee_div(F.col("_factor"), r_s)).otherwise(F.col("_raw") * F.col("_factor"))
    # each column refers to those before it (lateral aliases): one projection to analyse, not one a column
    return agg.select("*", raw.alias("_raw"), si.alias("_si"), avg.alias("_avg"), (F.col("_avg") * F.lit(1.1)).alias("_th"),
                      d0.alias("_d0"), d1.alias("_d1"), d0a.alias("_d0a"), d0b.alias("_d0b"), d1a.alias("_d1a"),
                      factor.alias("_factor"), value.alias("value"))


def increase(df, keys, grid, range_s, **kw) -> DataFrame:
    return extrapolated(df, keys, grid, range_s, is_rate=False, **kw)


def rate(df, keys, grid, range_s, **kw) -> DataFrame:
    return extrapolated(df, keys, grid, range_s, is_rate=True, **kw)


def gauge_on_grid(df: DataFrame, keys: Sequence[str], grid: Grid, lookback_s, *,
                  carry: Sequence[str] = (), bucket_s: int = DEFAULT_BUCKET_S,
                  neighbors_done: bool = False) -> DataFrame:
    """Bare selector evaluated at every step (as-of with lookback).

    Sample ``i`` answers every step in ``[ts_i, min(ts_{i+1}, ts_i + lookback))``,
    so each sample is exploded to that span; each (series, step) gets at most
    one row and no aggregate is needed.
    """
    keys = _key_list(keys, lookback_s)
    lb = _us(lookback_s)
    if not neighbors_done and not carry:
        # only the last sample of each step interval can answer a step: build
        # the interval table (no neighbour pass) and expand its last samples
        iv = interval_table(df, keys, grid)
        lo, hi = asof_steps(grid, F.col("last_ts_us"), F.col("last_next_ts_us"), lb)
        x = _explode_steps(iv, lo, hi)
        return x.select(*keys, "k", F.timestamp_micros(grid.step_ts_us(F.col("k"))).alias("step_ts"),
                        F.col("last_v").alias("value"), F.col("last_ts_us").alias("ts_us"))
    src = df if neighbors_done else with_neighbors(df, keys, prev=False, next_=True, bucket_s=bucket_s)
    cover_end = F.least(F.coalesce(F.col("next_ts_us"), F.col("ts_us") + lb), F.col("ts_us") + lb)
    S, P, K = F.lit(grid.start_us), F.lit(grid.step_us), F.lit(grid.k_max)
    lo = F.greatest(F.lit(0).cast("long"), ceil_div(F.col("ts_us") - S, P))
    hi = F.least(K.cast("long"), ceil_div(cover_end - S, P) - 1)
    x = _explode_steps(src, lo, hi)
    return x.select(*keys, *carry, "k", F.timestamp_micros(grid.step_ts_us(F.col("k"))).alias("step_ts"),
                    "value", "ts_us")


def instant(df: DataFrame, keys: Sequence[str], t_us: int, lookback_s,
            carry: Sequence[str] = ()) -> DataFrame:
    """Instant vector at ``t``: latest sample per series in ``(t − lookback, t]``.

    A grouped ``max_by`` (partial aggregation, no window, no sort).
    """
    lb = _us(lookback_s)
    sel = df.where((F.col("ts_us") > F.lit(t_us) - lb) & (F.col("ts_us") <= F.lit(t_us)))
    return sel.groupBy(*keys).agg(
        F.max_by("value", "ts_us").alias("value"), F.max("ts_us").alias("sample_ts_us")
    ).select("*", *[_rebuild(cc) for cc in carry])


__all__ = ["in_reach", "step_grid", "request_steps", "range_vector", "extrapolated",
           "increase", "rate", "gauge_on_grid", "instant", "interval_table"]
