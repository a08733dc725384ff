"""Series selection: metric name, label matchers, regex matchers, series cap.

Matcher semantics (public PromQL): a missing label equals ``""``; regex
matchers are fully anchored. ``rlike`` alone is unanchored, so patterns are
wrapped as ``^(?:…)$``.

``metric`` and ``ts`` predicates reach the parquet scan; label predicates on
the map column are evaluated right after it inside the same codegen stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def anchored(pattern: str) -> str:
    return rf"\A(?s:{pattern})\z"


def label(name: str) -> Column:
    """Label value with the missing-is-empty rule; ``__name__`` is the metric."""
    if name == "__name__":
        return F.col("metric")
    return F.coalesce(F.col("labels")[name], F.lit(""))


def matcher(name: str, op: str, value: str) -> Column:
    """One matcher: ``=``, ``!=``, ``=~``, ``!~``."""
    v = label(name)
    if op == "=":
        return v == F.lit(value)
    if op == "!=":
        return v != F.lit(value)
    if op == "=~":
        return v.rlike(anchored(value))
    if op == "!~":
        return ~v.rlike(anchored(value))
    raise ValueError(f"unknown matcher op {op!r}")


def select(samples: DataFrame, metric: str | None = None,
           matchers: Sequence[tuple[str, str, str]] | Mapping[str, str] = ()) -> DataFrame:
    """``metric{l1="v1", l2=~"re", ...}``; a dict means equality matchers."""
    df = samples
    if metric is not None:
        df = df.where(F.col("metric") == F.lit(metric))
    items = [(k, "=", v) for k, v in matchers.items()] if isinstance(matchers, Mapping) else list(matchers)
    for name, op, value in items:
        df = df.where(matcher(name, op, value))
    return df


def select_name_regex(samples: DataFrame, pattern: str) -> DataFrame:
    return samples.where(F.col("metric").rlike(anchored(pattern)))


def select_series(samples: DataFrame, series: DataFrame, metric: str | None = None,
                  matchers: Sequence[tuple[str, str, str]] | Mapping[str, str] = ()) -> DataFrame:
    """``select`` by the series table: labels are tested once per series, and the samples'
    label maps are not read. Samples are reached by a semi join, for which Spark broadcasts
    the chosen series by their measured size or filters the scan by them at run time."""
    chosen = select(series, metric, matchers).select("metric", "series_key").distinct()
    if metric is not None:
        samples = samples.where(F.col("metric") == F.lit(metric))
    return samples.join(chosen, on=["metric", "series_key"], how="left_semi")


def series_cap(samples: DataFrame, max_series: int, by: Sequence[str] = ("metric",),
               buckets: int = 64, series: DataFrame | None = None) -> DataFrame:
    """Keep the first ``max_series`` series (by sorted key) per ``by`` group.

    Two-level top-N, so a metric with a huge number of series is never one
    window task: first the top N per (group, hash bucket of the key), spread
    over many tasks; then the top N per group over at most ``N × buckets``
    survivors. The kept set (≤ N per group) is semi-joined back. With the
    ``series`` table the choice reads no sample.
    """
    by = list(by)
    found = ((samples if series is None else series).select(*by, "series_key").distinct()
             .withColumn("_bk", F.pmod(F.xxhash64("series_key"), F.lit(int(buckets)))))
    w1 = Window.partitionBy(*by, "_bk").orderBy("series_key")
    first = found.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= max_series).drop("_r", "_bk")
    w2 = Window.partitionBy(*by).orderBy("series_key")
    kept = first.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= max_series).drop("_r")
    return samples.join(kept, on=[*by, "series_key"], how="left_semi")
