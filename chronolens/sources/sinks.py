"""Result sinks: JSON documents and the Markdown findings report.

* ``results_json``: one JSON document per run, ``all`` included
  (``{subsystem, results[], window}``). An entry carries ``name``, ``query``
  and either ``result`` (``{status, query, window}``) with ``summary``, or
  ``error``. The result's window is the configured one, the document's is the
  clamped request. ``to_json`` drops NULL fields, which gives the "omit when
  empty" behaviour. NaN/±Inf cannot be encoded as JSON numbers, so they are
  dropped instead of failing the document. A run holds at most the registry's
  entries — a fixed bound — so one ``collect_list`` is safe; the points, which
  have none, are the table ``DiagnoseResult.points``.
* ``report_lines``: the Markdown report as ordered lines (header,
  parameters, findings table, or a fixed sentence when there are none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Report layout.
REPORT_TITLE = "# Load Test Bottleneck Analysis"
NO_FINDINGS = "No findings — no anomalies detected in the queried metrics."
TABLE_HEADER = "| Component | Metric | Value | Severity | Description |"
TABLE_RULE = "|-----------|--------|-------|----------|-------------|"


def _finite(c: Column, decimals: int | None = None) -> Column:
    if decimals is not None:
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c.try_cast(f"decimal(38,{decimals})"))
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def summary_struct(decimals: int | None = None) -> Column:
    """``decimals`` writes the numbers with that many places instead of in full."""
    return F.struct(
        F.col("series_count").alias("series_count"),
        _finite(F.col("max_value"), decimals).alias("max_value"),
        F.col("max_timestamp").alias("max_timestamp"),
        _finite(F.col("avg_value"), decimals).alias("avg_value"),
        _finite(F.col("non_zero_percentage"), decimals).alias("non_zero_percentage"),
        F.col("trend").alias("trend"))


def results_json(results: DataFrame, decimals: int | None = None) -> DataFrame:
    """One row per run: ``subsystem``, ``json``."""
    ok = F.col("error").isNull()
    result = F.struct("status", "query", F.struct(F.col("query_window_start").alias("start"),
                                                  F.col("query_window_end").alias("end")).alias("window"))
    entry = F.struct(F.col("name"), F.col("query"), F.when(ok, result).alias("result"),
                     F.when(ok, summary_struct(decimals)).alias("summary"), F.col("error"))
    g = results.groupBy("subsystem", "window_start", "window_end").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", entry.alias("entry")))).alias("_results"))
    doc = F.struct(F.col("subsystem"), F.transform("_results", lambda r: r["entry"]).alias("results"),
                   F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"))
    return g.select("subsystem", F.to_json(doc).alias("json"))


def verbose_json(results: DataFrame, points: DataFrame, decimals: int | None = None) -> DataFrame:
    """The verbose document as JSON lines: one row per (query, series) with its points.

    Columns ``subsystem``, ``ordinal``, ``series_key`` and ``json``
    (``{name, query, metric{}, values[[seconds, "value"], …]}``): a document of all series
    has no bound, a line has that of one series, its steps. Values are texts, as in a query
    response, so that NaN and infinities are kept.
    """
    won = results.select("subsystem", "ordinal", "name", "query", "cand_id")
    v = F.col("value")
    text = (F.when(F.isnan(v), F.lit("NaN")).when(v == float("inf"), F.lit("+Inf")).when(v == float("-inf"), F.lit("-Inf"))
             .otherwise(v.cast("string") if decimals is None else v.cast(f"decimal(38,{decimals})").cast("string")))
    second = F.unix_micros("step_ts").try_cast("decimal(20,0)") / F.lit(1_000_000)
    pair = F.concat(F.lit("["), F.regexp_replace(second.cast("decimal(20,6)").cast("string"), r"[.]?0+$", ""), F.lit(',"'),
                    text, F.lit('"]'))
    lines = (points.join(F.broadcast(won), "cand_id")   # an entry has one row
             .groupBy("subsystem", "ordinal", "name", "query", "series_key")
             .agg(F.array_sort(F.collect_list(F.struct("k", pair.alias("pair")))).alias("_p")))
    q = lambda col: F.regexp_extract(F.to_json(F.struct(F.col(col).alias("x"))), r'^\{"x":(.*)\}$', 1)
    return lines.select("subsystem", F.col("ordinal").cast("long").alias("ordinal"), "series_key", F.concat(
        F.lit('{"name":'), q("name"), F.lit(',"query":'), q("query"), F.lit(',"metric":'), F.col("series_key"),
        F.lit(',"values":['), F.array_join(F.transform("_p", lambda p: p["pair"]), ","), F.lit("]}")).alias("json"))


def write_lines(lines: DataFrame, path: str, order: list[str], col: str = "line", mode: str = "overwrite") -> None:
    """Write lines of text in order: files in the order of their names hold ascending ranges of
    ``order``, each sorted, so that the files end to end are the document."""
    lines.sort(*order).select(col).write.mode(mode).text(path)


def write_json(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the documents of ``results_json`` as lines of text."""
    docs.select("json").write.mode(mode).text(path)


def report_lines(spark: SparkSession, findings: DataFrame, test_params: str) -> DataFrame:
    """Ordered report lines: ``line_no``, ``line``.

    Findings rows are formatted on the executors; only the fixed header
    comes from the driver. Row order follows ``finding_order``.
    """
    rows = findings.select(
        (F.lit(10) + F.col("finding_order")).cast("long").alias("line_no"),
        F.format_string("| %s | %s | %s | %s | %s |", "component", "metric", "value", "severity",
                        "description").alias("line"))
    text = lambda *lines: F.array(*[F.lit(s) for s in lines])
    head = text(REPORT_TITLE, f"**Test parameters:** {test_params}", "", "## Findings", "")
    found = findings.limit(1).agg(F.count(F.lit(1)).alias("n"))
    tail = F.when(F.col("n") > 0, text(TABLE_HEADER, TABLE_RULE)).otherwise(text(NO_FINDINGS))
    header = found.select(F.posexplode(F.concat(head, tail)).alias("line_no", "line"))
    return header.select(F.col("line_no").cast("long").alias("line_no"), "line").unionByName(rows)
