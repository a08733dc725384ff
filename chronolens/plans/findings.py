"""Findings: caller-written predicates over the diagnostic results.

The reference ships no threshold logic; a finding is whatever the caller's
rule says. Rules are ``(predicate, severity, description)`` applied to the
results table; the first matching rule per result wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINDING_COLS = ["component", "metric", "value", "description", "severity"]


def value_text(v: Column) -> Column:
    """A short, engine-independent rendering of a summary value."""
    return F.when(F.isnan(v), F.lit("NaN")).otherwise(F.format_number(v, 6))


def findings(results: DataFrame, rules: Sequence[tuple[Column, str, str]]) -> DataFrame:
    """Apply rules; columns ``component, metric, value, description,
    severity, finding_order``."""
    sev, desc = None, None
    for pred, severity, description in rules:
        sev = (F.when(pred, F.lit(severity)) if sev is None else sev.when(pred, F.lit(severity)))
        desc = (F.when(pred, F.lit(description)) if desc is None else desc.when(pred, F.lit(description)))
    out = results.withColumn("severity", sev).withColumn("_desc", desc).where(F.col("severity").isNotNull())
    return out.select(
        "component", F.col("name").alias("metric"), value_text(F.col("max_value")).alias("value"),
        F.concat(F.col("_desc"), F.lit(": "), F.col("description")).alias("description"), "severity",
        F.col("ordinal").cast("long").alias("finding_order"))


def default_rules() -> list[tuple[Column, str, str]]:
    """Example rules used by the catalog: rising or spiky signals."""
    return [
        ((F.col("status") == "ok") & (F.col("trend") == "increasing"), "warning", "rising"),
        ((F.col("status") == "ok") & (F.col("trend") == "spiky"), "warning", "spiky"),
        ((F.col("status") == "empty"), "info", "no data"),
    ]
