"""The diagnostic job over response payloads (the reference's own flow).

Input: ``responses (cand_id, payload)`` — zero or more response documents per
registry candidate (a result may be sharded over several payloads, e.g. one
per series). Per candidate:

* any rejected payload → the candidate *errors* (message of S4);
* otherwise ``ok`` when some payload holds a non-empty result, else ``empty``;
* the summary pools the decoded points of all its payloads in response order:
  payloads by ``payload_idx`` (where ``responses`` has it), series by their
  place, then name and labels, points by their place. A series is its name and
  labels; skipped points still count their series.

Fallback with errors (D3/D10): a primary that errors is recorded and no
alternative is tried; a primary that is non-empty wins; otherwise the first
alternative in order that neither errors nor is empty; otherwise the primary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.summary import summarize
from ..session import default_parallelism, kept
from ..sources import payloads as pl
from .diagnose import DiagnoseResult, _fill_empty


def parsed_payloads(responses: DataFrame, group_cols: list[str]) -> tuple[DataFrame, list[str]]:
    """The payloads' parsed rows and the columns that identify them, ``payload_idx`` where there is one."""
    cols = [*group_cols, *[c for c in ("payload_idx",) if c in responses.columns]]
    return pl.tagged(responses, id_cols=cols), cols


def evaluate_payloads(spark: SparkSession, parsed: DataFrame, id_cols: list[str], reg_df: DataFrame) -> DataFrame:
    """One row per candidate with ``status``, ``error`` and the summary, from parsed payloads."""
    st = parsed.groupBy("cand_id").agg(F.min("message").alias("error"),
                                       F.max(F.col("status") == "ok").alias("_any_ok"))
    summ = summarize_parsed(spark, parsed, ["cand_id"], id_cols)
    cand = (reg_df.join(st, "cand_id", "left").join(summ, "cand_id", "left")
                  .withColumn("status", F.when(F.col("error").isNotNull(), F.lit("error"))
                                         .when(F.coalesce(F.col("_any_ok"), F.lit(False)), F.lit("ok"))
                                         .otherwise(F.lit("empty")))
                  .drop("_any_ok"))
    return _fill_empty(cand)


def summarize_payloads(spark: SparkSession, responses: DataFrame, group_cols: list[str]) -> DataFrame:
    """One summary row per group of payloads that holds a series, pooled in response order."""
    parsed, cols = parsed_payloads(responses, group_cols)
    return summarize_parsed(spark, parsed, group_cols, cols)


def summarize_parsed(spark: SparkSession, parsed: DataFrame, group_cols: list[str], id_cols: list[str]) -> DataFrame:
    idx = id_cols[len(group_cols):]
    pts = pl.tagged_points(parsed, id_cols)
    return summarize(pts, group_cols, "ts_s", chunks=default_parallelism(spark),
                     pos_cols=[*idx, "point_idx", "ts_s"], key_cols=["metric", "series_key"],
                     series_order=[*idx, "series_idx"])


def pick_winners(cand: DataFrame) -> DataFrame:
    """Winning candidate per registry entry under the error-aware rule."""
    p0 = F.col("priority") == 0
    w = cand.groupBy("ordinal").agg(
        F.max(F.when(p0, F.col("status"))).alias("_p_status"),
        F.min(F.when((F.col("priority") > 0) & (F.col("status") == "ok"), F.col("priority"))).alias("_alt"))
    win = w.select("ordinal", F.when(F.col("_p_status").isin("error", "ok"), F.lit(0))
                               .otherwise(F.coalesce(F.col("_alt"), F.lit(0))).alias("priority"))
    res = cand.join(win, on=["ordinal", "priority"], how="inner")
    summary_cols = ["series_count", "n_points", "max_value", "max_timestamp", "avg_value",
                    "non_zero_percentage", "trend", "slope", "cv"]
    for c in summary_cols:   # an errored entry has no summary
        res = res.withColumn(c, F.when(F.col("status") != "error", F.col(c)))
    return res.withColumn("fallback_used", F.col("priority") > 0)


def diagnose_payloads(spark: SparkSession, responses: DataFrame, reg_df: DataFrame) -> DiagnoseResult:
    """Every payload is parsed once: its parsed row is kept from its first use on, and errors,
    emptiness, summaries and points branch from there."""
    parsed, cols = parsed_payloads(responses, ["cand_id"])
    parsed = kept(parsed)
    cand = evaluate_payloads(spark, parsed, cols, reg_df)
    points = pl.tagged_points(parsed, cols).drop(*cols[1:])
    return DiagnoseResult(pick_winners(cand), cand, points, (parsed,))
