"""One instant or range query: clamp, evaluate, status, window.

``query`` and ``query_range`` clamp the request to the investigation window,
evaluate a typed expression over a samples table and return the points with a
one-row result ``(query, status, window_start, window_end)``. The status is
``empty`` when no series has a point; the window is the configured one. A
range that the clamp leaves inverted has no point. Nothing runs until an
action on either DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import (DEFAULT_LOOKBACK_S, DEFAULT_RANGE_S, DEFAULT_STEP_S, Grid, TimeWindow, fmt_rfc3339, series_key,
                     to_micros)
from ..operators import hist, rangefn
from ..operators import select as sel
from .registry import duration_text

KINDS = ("gauge", "rate", "increase", "hquantile")
KEYS = ["metric", "series_key"]


@dataclass(frozen=True)
class Expr:
    """A metric with matchers ``(label, op, value)`` and the function over it."""

    metric: str
    kind: str = "gauge"
    matchers: Sequence[tuple[str, str, str]] = ()
    range_s: int = DEFAULT_RANGE_S
    quantile: float = 0.99

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")

    @property
    def text(self) -> str:
        inner = ",".join(f'{n}{op}"{v}"' for n, op, v in self.matchers)
        s = f"{self.metric}{{{inner}}}" if inner else self.metric
        if self.kind == "gauge":
            return s
        r = f"[{duration_text(self.range_s)}]"
        if self.kind == "hquantile":
            return f"histogram_quantile({self.quantile:g}, rate({s}{r}))"
        return f"{self.kind}({s}{r})"


@dataclass(frozen=True)
class QueryResult:
    result: DataFrame   # one row: query, status, window_start, window_end
    data: DataFrame     # metric, series_key, k, step_ts, value


def evaluate(samples: DataFrame, expr: Expr, grid: Grid, lookback_s: int = DEFAULT_LOOKBACK_S) -> DataFrame:
    """The points ``(metric, series_key, k, step_ts, value)`` of ``expr`` on the grid."""
    reach = lookback_s if expr.kind == "gauge" else expr.range_s
    chosen = sel.select(samples, expr.metric, expr.matchers)
    if grid.empty:   # no step: any operator's empty result has these columns
        return (chosen.where(F.lit(False))
                .select(*KEYS, F.lit(0).cast("long").alias("k"), F.col("ts").alias("step_ts"), "value"))
    s = rangefn.in_reach(chosen, grid, reach)
    if expr.kind == "gauge":
        out = rangefn.gauge_on_grid(s, KEYS, grid, lookback_s)
    elif expr.kind == "hquantile":
        r = rangefn.rate(s, KEYS, grid, expr.range_s, carry=["labels"])
        r = (r.withColumn("le", F.col("labels")["le"])
              .withColumn("series_key", series_key(F.map_filter("labels", lambda k, v: k != "le"))))
        out = hist.histogram_quantile(r, expr.quantile, KEYS)
    else:
        out = rangefn.extrapolated(s, KEYS, grid, expr.range_s, is_rate=expr.kind == "rate")
    return out.select(*KEYS, F.col("k").cast("long").alias("k"), "step_ts", "value")


def _result(data: DataFrame, expr: Expr, window: TimeWindow) -> QueryResult:
    found = data.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return QueryResult(found.select(
        F.lit(expr.text).alias("query"),
        F.when(F.col("n") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status"),
        F.lit(fmt_rfc3339(window.start)).alias("window_start"),
        F.lit(fmt_rfc3339(window.end)).alias("window_end")), data)


def query(samples: DataFrame, expr: Expr, window: TimeWindow, t=None,
          lookback_s: int = DEFAULT_LOOKBACK_S) -> QueryResult:
    """Instant query at ``t`` clamped into the window (unset: its end)."""
    us = to_micros(window.clamp_instant(t))
    return _result(evaluate(samples, expr, Grid(us, us, 1_000_000), lookback_s), expr, window)


def query_range(samples: DataFrame, expr: Expr, window: TimeWindow, start=None, end=None,
                step_s: float = DEFAULT_STEP_S, lookback_s: int = DEFAULT_LOOKBACK_S) -> QueryResult:
    """Range query over ``[start, end]``, each bound clamped to the window on its own side."""
    s, e = window.clamp(start, end)
    return _result(evaluate(samples, expr, Grid.of(s, e, step_s), lookback_s), expr, window)
