"""Sliding windows over interval rows: each step merges at most two rows.

A window ``(t − r, t]`` at a step is a run of ``m`` intervals. The intervals of a series
are cut into blocks of ``m``; such a run is then the end of one block and the beginning of
the next, or one whole block. So it is enough to know, per block,

* for every interval the merge of the block's intervals up to it (prefix), and
* for every interval the merge of the block's intervals from it on (suffix).

Both are running aggregates over a block of one series (a window of at most ``m`` rows).
A prefix answers the steps from its interval up to the next one that has samples, a
suffix those whose window begins after the interval before it and up to its own. So each
step gets at most one row of each, whatever ``r / step`` is, and one grouping merges them.

What is merged is a counter segment: number of samples, first and last sample, and the sum
of the values before resets. Merging two neighbours adds numbers and resets, and the reset
between them, which the later segment's first interval carries (``cross_reset``). This is
associative, so any split of a window gives the same answer.

Intervals may be finer than the step (``width``, the common divisor of the step and all
ranges), and ``m`` may be a column: candidates with ranges of their own share one table.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ceil_div, fdiv
from ..model import Grid

FINEST = 64   # intervals of a step, at most: bounds a series' interval rows by its steps


def common_width(grid: Grid, ranges_us: Sequence[int]) -> int | None:
    """The widest interval of which the step and all ranges are multiples; None where
    a step would have more than ``FINEST`` of them or a range is not positive."""
    if any(r <= 0 for r in ranges_us):
        return None
    width = gcd(grid.step_us, *ranges_us)
    return width if grid.step_us // width <= FINEST else None


def _steps(lo: Column, hi: Column, grid: Grid, width: int) -> Column:
    """Steps whose interval number (of ``width``) lies in ``[lo, hi]``."""
    per = grid.step_us // width
    a = F.greatest(F.lit(0).cast("long"), lo if per == 1 else ceil_div(lo, F.lit(per).cast("long")))
    b = F.least(F.lit(grid.k_max).cast("long"), hi if per == 1 else fdiv(hi, F.lit(per).cast("long")))
    none = F.array().cast("array<int>")
    return F.when(a <= b, F.sequence(a.cast("int"), b.cast("int"))).otherwise(none)


def window_merge(iv: DataFrame, keys: Sequence[str], grid: Grid, width: int, m: Column, *,
                 single: Column | None = None, single_steps: tuple[Column, Column] | None = None,
                 consts: Sequence[str] = (), sums: bool = False) -> DataFrame:
    """Per (keys, step ``k``): ``n``, first and last sample and ``resets`` of the window of
    ``m`` intervals that ends at the step.

    ``iv`` are rows of ``rangefn.interval_table`` with ``keys`` and interval number ``j``.
    Rows for which ``single`` holds answer the steps ``single_steps`` by their own last
    sample instead (gauges). ``consts`` are constant per key. ``sums`` adds ``sum_value``.
    """
    keys = list(keys)
    d = iv.select("*", m.cast("long").alias("_m"), fdiv(F.col("j"), F.col("_m")).alias("_b"))
    up = Window.partitionBy(*keys, "_b").orderBy("j")
    down = Window.partitionBy(*keys, "_b").orderBy(F.col("j").desc())
    pre = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suf = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = down.rowsBetween(Window.unboundedPreceding, -1)
    # the reset on entering an interval counts inside a block, unless the block begins with it
    before = F.lag("j").over(up)
    d = d.select("*", before.alias("_pj"), F.lead("j").over(up).alias("_nj"),
                 F.when(before.isNull(), F.lit(0.0)).otherwise(F.col("cross_reset")).alias("_in"))
    merged = {"_pn": F.sum("n").over(pre), "_pft": F.first("first_ts_us").over(pre), "_pfv": F.first("first_v").over(pre),
              "_pres": F.sum(F.col("inner_reset") + F.col("_in")).over(pre), "_enter": F.first("cross_reset").over(pre)}
    if sums:
        merged["_psum"] = F.sum("sum_v").over(pre)
    d = d.select("*", *[c.alias(name) for name, c in merged.items()])
    merged = {"_sn": F.sum("n").over(suf), "_slt": F.first("last_ts_us").over(suf), "_slv": F.first("last_v").over(suf),
              "_sres": F.sum("inner_reset").over(suf) + F.coalesce(F.sum("_in").over(later), F.lit(0.0))}
    if sums:
        merged["_ssum"] = F.sum("sum_v").over(suf)
    d = d.select("*", *[c.alias(name) for name, c in merged.items()])

    j, start = F.col("j"), F.col("_b") * F.col("_m")
    end = start + F.col("_m") - 1
    ends = _steps(j, F.least(F.coalesce(F.col("_nj"), end + 1) - 1, end), grid, width)
    # windows that begin in (interval before, j] but not with the block: those are prefixes
    begins = _steps(F.coalesce(F.col("_pj"), start) + F.col("_m"), j + F.col("_m") - 1, grid, width)
    entry = lambda steps, prefix: F.transform(steps, lambda k: F.struct(k.alias("k"), F.lit(prefix).alias("p")))
    entries = F.concat(entry(ends, True), entry(begins, False))
    if single is not None:
        lo, hi = single_steps
        own = F.when(lo <= hi, F.sequence(lo.cast("int"), hi.cast("int"))).otherwise(F.array().cast("array<int>"))
        entries = F.when(single, entry(own, True)).otherwise(entries)
    x = d.select("*", F.explode(entries).alias("_e"))
    p = F.col("_e.p")
    pick = lambda a, b: F.when(p, F.col(a)).otherwise(F.col(b))
    row = x.select(*keys, *consts, "_e.k", p.alias("_p"), pick("_pn", "_sn").alias("n"),
                   pick("_pft", "first_ts_us").alias("first_ts_us"), pick("_pfv", "first_v").alias("first_v"),
                   pick("last_ts_us", "_slt").alias("last_ts_us"), pick("last_v", "_slv").alias("last_v"),
                   pick("_pres", "_sres").alias("res"), F.when(p, F.col("_enter")).otherwise(F.lit(0.0)).alias("enter"),
                   *([pick("_psum", "_ssum").alias("sum_v")] if sums else []))
    return row.groupBy(*keys, "k").agg(
        *[F.first(c).alias(c) for c in consts], F.sum("n").alias("n"),
        F.min("first_ts_us").alias("first_ts_us"), F.max("last_ts_us").alias("last_ts_us"),
        F.min_by("first_v", "first_ts_us").alias("first_v"), F.max_by("last_v", "last_ts_us").alias("last_v"),
        (F.sum("res") + F.when(F.count_if(~F.col("_p")) > 0, F.sum("enter")).otherwise(F.lit(0.0))).alias("resets"),
        *([F.sum("sum_v").alias("sum_value")] if sums else []))


__all__ = ["common_width", "window_merge", "FINEST"]
