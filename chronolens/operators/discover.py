"""Metric and label discovery inside the window.

``list_metrics(match, limit)``: distinct names of series matching a selector
with samples in the window, sorted; ``limit <= 0`` means the default 200;
``truncated`` flags that more names existed. The limit is a top-k
(``orderBy().limit(n + 1)`` → TakeOrderedAndProject), so only ``n + 1``
names ever reach a single task.

With the table's *series table* (``sources.samples``) no sample is read: a day of a
series meets the window when its first or last sample lies inside. Only for a window
within one UTC day can a series' day span the window without a sample in it; then the
samples of that window are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import DEFAULT_LIST_LIMIT, TimeWindow
from ..model import to_micros
from ..sources.samples import DAY_US, time_part_filter


def in_window(samples: DataFrame, window: TimeWindow) -> DataFrame:
    """Samples inside the window; on a partitioned table other partitions are not opened."""
    lo, hi = to_micros(window.start), to_micros(window.end)
    prune = time_part_filter(samples, lo, hi)
    inside = (F.col("ts") >= F.timestamp_micros(F.lit(lo))) & (F.col("ts") <= F.timestamp_micros(F.lit(hi)))
    return samples.where(inside if prune is None else prune & inside)


def _match(samples: DataFrame, match) -> DataFrame:
    """``match``: None (all), a metric name, ``(metric, matchers)`` or a list
    of matcher triples (``("__name__", "=~", "…")`` selects names by regex)."""
    from . import select as sel
    if match is None:
        return samples
    if isinstance(match, str):
        return sel.select(samples, match)
    if isinstance(match, tuple) and len(match) == 2 and not isinstance(match[1], str):
        return sel.select(samples, match[0], match[1])
    return sel.select(samples, None, match)


def series_in_window(samples: DataFrame, window: TimeWindow, series: DataFrame | None = None) -> DataFrame:
    """Rows ``(metric, series_key, labels)`` that have a sample in the window; a series may have several."""
    lo, hi = to_micros(window.start), to_micros(window.end)
    if series is None or lo // DAY_US == hi // DAY_US:
        return in_window(samples, window)
    inside = lambda c: (F.col(c) >= F.timestamp_micros(F.lit(lo))) & (F.col(c) <= F.timestamp_micros(F.lit(hi)))
    days = F.col("day").between(lo // DAY_US, hi // DAY_US)
    prune = time_part_filter(series, lo, hi)
    met = days & (inside("first_ts") | inside("last_ts"))
    return series.where(met if prune is None else prune & met)


def metric_names(samples: DataFrame, window: TimeWindow, match=None, series: DataFrame | None = None) -> DataFrame:
    return _match(series_in_window(samples, window, series), match).select("metric").distinct()


def list_metrics(samples: DataFrame, window: TimeWindow, limit: int = 0, match=None,
                 series: DataFrame | None = None) -> DataFrame:
    """Columns ``metric``, ``truncated`` (same value on every row)."""
    n = DEFAULT_LIST_LIMIT if limit <= 0 else int(limit)
    top = metric_names(samples, window, match, series).orderBy("metric").limit(n + 1)
    # a window over at most n + 1 rows: bounded
    w = Window.orderBy("metric")
    ranked = top.withColumn("_pos", F.row_number().over(w)).withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy()))
    return ranked.where(F.col("_pos") <= n).select("metric", (F.col("_cnt") > n).alias("truncated"))


def list_labels(samples: DataFrame, window: TimeWindow, series: DataFrame | None = None) -> DataFrame:
    """Distinct label names (plus ``__name__``), as the label-values API lists them."""
    # a series key holds its labels: the label map of each sample is not read
    found = series_in_window(samples, window, series).select("series_key").distinct()
    keys = found.select(F.explode(F.json_object_keys("series_key")).alias("label")).distinct()
    return keys.unionByName(samples.sparkSession.range(1).select(F.lit("__name__").alias("label"))).distinct()
