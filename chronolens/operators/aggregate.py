"""Aggregation across series (``sum``/``sum by (…)`` of an instant vector).

Input: grid points with a ``labels`` map (or label columns). Grouping is by
the chosen label values and the step; the metric name is dropped, as an
aggregation over series does. Partial aggregation runs map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_by(points: DataFrame, by: Sequence[str], step_cols: Sequence[str] = ("k", "step_ts"),
           fn=F.sum) -> DataFrame:
    """``sum by (by…) (expr)`` per step; a missing label groups as ``""``."""
    by = list(by)
    cols = [F.coalesce(F.col("labels")[b], F.lit("")).alias(b) for b in by]
    return points.select(*cols, *step_cols, "value").groupBy(*by, *step_cols).agg(fn("value").alias("value"))
