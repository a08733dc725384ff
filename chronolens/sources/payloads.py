"""Query-API response payloads: decode, reject, and build.

A payload is one JSON document per row (``spark.read.text`` of JSON-lines
files, or a column). Decoding parses into VARIANT with ``try_parse_json`` so
that a JSON number can be told from a numeric string, as the reference's
decoder does:

* malformed JSON → reject ``parsing response: invalid JSON``;
* ``status != "success"`` → reject ``query failed: <error> (<errorType>)``
  (``list_metrics failed: …`` for name lists);
* ``data.result`` absent, ``null`` or ``[]`` → status ``empty``;
* a result with an element that is no series (a label that is no text,
  points that are no list) has no series at all; a null element is a series
  without labels or points;
* a point is kept only if it has ≥ 2 elements, a numeric timestamp and a
  string value that parses as a float; otherwise it is skipped, but its
  series still counts.

Every payload decodes independently (no grouping, no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import parse_float_text
from ..model import series_key

_NUMERIC = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files, one response per line → column ``payload``."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def tagged(df: DataFrame, col: str = "payload", id_cols: Sequence[str] = (),
           prefix: str = "query failed") -> DataFrame:
    """One row per payload, parsed once: ``message`` where it is rejected; else ``status`` (``ok`` or
    ``empty``), ``result_type`` and the document's ``data`` as a variant. The other functions branch
    on these columns, so a caller that needs several keeps this table and parses nothing again."""
    p = (df.withColumn("_v", F.try_parse_json(F.col(col)))
           .withColumn("_ok", F.coalesce(F.try_variant_get("_v", "$.status", "string") == "success", F.lit(False))))
    # The reference's message formats.
    msg = (F.when(F.col("_v").isNull(), F.lit("parsing response: invalid JSON"))
            .when(~F.col("_ok"),
                  F.format_string(f"{prefix}: %s (%s)",
                                  F.coalesce(F.try_variant_get("_v", "$.error", "string"), F.lit("")),
                                  F.coalesce(F.try_variant_get("_v", "$.errorType", "string"), F.lit("")))))
    res = F.try_variant_get("_v", "$.data.result", "variant")
    empty = (_kind(res) == "VOID") | (F.size(F.try_variant_get(res, "$", "array<variant>")) == 0)
    return p.select(*id_cols, msg.alias("message"),
                    F.when(F.col("_ok"), F.when(F.coalesce(empty, F.lit(False)), F.lit("empty"))
                           .otherwise(F.lit("ok"))).alias("status"),
                    F.when(F.col("_ok"), F.try_variant_get("_v", "$.data.resultType", "string")).alias("result_type"),
                    F.when(F.col("_ok"), F.try_variant_get("_v", "$.data", "variant")).alias("data"))


def rejects(df: DataFrame, col: str = "payload", id_cols: Sequence[str] = (),
            prefix: str = "query failed") -> DataFrame:
    """Rows that are not a successful response, with the reference message."""
    return tagged(df, col, id_cols, prefix).where(F.col("message").isNotNull()).select(*id_cols, "message")


def query_status(df: DataFrame, col: str = "payload", id_cols: Sequence[str] = ()) -> DataFrame:
    """``ok`` / ``empty`` per accepted payload (the emptiness predicate)."""
    return tagged(df, col, id_cols).where(F.col("status").isNotNull()).select(*id_cols, "result_type", "status")


def _kind(v: Column) -> Column:
    """Schema text of a variant; ``VOID`` for a JSON null and for nothing at all."""
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _is_series(e: Column) -> Column:
    """Whether one result element decodes as a series: null, or an object whose labels are an
    object of texts (or null) and whose ``values`` are a list of lists (or null)."""
    labels, values = F.try_variant_get(e, "$.metric", "variant"), F.try_variant_get(e, "$.values", "variant")
    texts = F.forall(F.map_values(F.try_variant_get(e, "$.metric", "map<string,variant>")),
                     lambda v: _kind(v).isin("STRING", "VOID"))
    lists = F.forall(F.try_variant_get(e, "$.values", "array<variant>"),
                     lambda v: (_kind(v) == "VOID") | _kind(v).startswith("ARRAY"))
    return (_kind(e) == "VOID") | (
        _kind(e).startswith("OBJECT") & ((_kind(labels) == "VOID") | F.coalesce(texts, F.lit(False)))
        & ((_kind(values) == "VOID") | F.coalesce(lists, F.lit(False))))


def _point(p: Column, idx: int) -> Column:
    return F.try_variant_get(p, f"$[{idx}]", "variant")


def decode_points(df: DataFrame, col: str = "payload", id_cols: Sequence[str] = (),
                  field: str = "values") -> DataFrame:
    """Decode matrix (``field="values"``) or vector (``field="value"``) payloads.

    One row per point: ``id_cols``, ``series_idx``, ``metric``, ``labels``,
    ``series_key``, ``point_idx``, ``ts_s`` (DOUBLE) and ``value`` (DOUBLE,
    NULL for a skipped point). A series without points yields one row with
    NULL point, so it still counts as a series.
    """
    return tagged_points(tagged(df, col, id_cols), id_cols, field)


def tagged_points(parsed: DataFrame, id_cols: Sequence[str] = (), field: str = "values") -> DataFrame:
    """The points of ``tagged`` payloads, as ``decode_points`` gives them."""
    a = parsed.where(F.col("status") == "ok")
    result = F.try_variant_get("data", "$.result", "array<variant>")
    # a result that is not a list of series (a scalar ``[ts, "v"]``, a label
    # that is no text) does not decode at all: no series, no points
    as_series = F.when(F.forall(result, _is_series), result)
    series = a.select(*id_cols, F.posexplode(as_series).alias("series_idx", "_s"))
    metric_map = F.transform_values(F.try_variant_get("_s", "$.metric", "map<string,string>"),
                                    lambda k, v: F.coalesce(v, F.lit("")))
    series = (series.withColumn("_m", F.coalesce(metric_map, F.create_map().cast("map<string,string>")))
                    .withColumn("metric", F.col("_m")["__name__"])
                    .withColumn("labels", F.map_filter("_m", lambda k, v: k != "__name__")))
    if field == "values":
        pts = series.select("*", F.posexplode_outer(F.try_variant_get("_s", "$.values", "array<variant>"))
                            .alias("point_idx", "_p"))
    else:
        pts = series.select("*", F.lit(0).alias("point_idx"), F.try_variant_get("_s", "$.value", "variant").alias("_p"))
    p0, p1 = _point(F.col("_p"), 0), _point(F.col("_p"), 1)
    n_el = F.size(F.try_variant_get(F.col("_p"), "$", "array<variant>"))
    ok_ts = F.schema_of_variant(p0).rlike(_NUMERIC)
    ok_v = F.schema_of_variant(p1) == "STRING"
    ts = F.try_variant_get(F.col("_p"), "$[0]", "double")
    val = parse_float_text(F.try_variant_get(F.col("_p"), "$[1]", "string"))
    good = F.col("_p").isNotNull() & (F.coalesce(n_el, F.lit(0)) >= 2) & ok_ts & ok_v & val.isNotNull()
    return pts.select(*id_cols, "series_idx", "metric", "labels", series_key(F.col("labels")).alias("series_key"),
                      "point_idx", F.when(good, ts).alias("ts_s"), F.when(good, val).alias("value"))


def decode_names(df: DataFrame, col: str = "payload", id_cols: Sequence[str] = ()) -> DataFrame:
    """``{status, data: [names]}`` → one row per name."""
    a = tagged(df, col, id_cols).where(F.col("status").isNotNull())
    return a.select(*id_cols, F.explode(F.try_variant_get("data", "$", "array<string>")).alias("name"))


# ------------------------------------------------------------------ building

def value_text(v: Column) -> Column:
    """Float as the API writes it: ``NaN``, ``+Inf``, ``-Inf`` or the number."""
    return (F.when(F.isnan(v), F.lit("NaN"))
             .when(v == F.lit(float("inf")), F.lit("+Inf"))
             .when(v == F.lit(float("-inf")), F.lit("-Inf"))
             .otherwise(v.cast("string")))


def _ts_text(ts_us: Column) -> Column:
    return (ts_us.cast("double") / F.lit(1e6)).cast("string")


def _metric_json(metric: Column, labels: Column) -> Column:
    return F.to_json(F.map_concat(F.create_map(F.lit("__name__"), metric), labels))


def build_range_payloads(samples: DataFrame, chunk_s: int = 86400, bad_col: str | None = None) -> DataFrame:
    """One matrix payload per (series, time chunk): the group is bounded by
    the samples of one series in one chunk. Columns: ``payload_id``,
    ``chunk``, ``payload``. Rows flagged by ``bad_col`` are written with the
    value as a JSON number instead of a string (a malformed point)."""
    chunk_us = int(chunk_s) * 1_000_000
    bad = F.col(bad_col) if bad_col else F.lit(False)
    g = (samples.withColumn("_chunk", F.floor(F.col("ts_us") / F.lit(chunk_us)).cast("long"))
                .withColumn("_bad", bad)
                .groupBy("metric", "series_key", "_chunk")
                .agg(F.array_sort(F.collect_list(F.struct("ts_us", "value", "_bad"))).alias("_pts")))
    pts_txt = F.array_join(F.transform("_pts", lambda p: F.concat(
        F.lit("["), _ts_text(p["ts_us"]),
        F.when(p["_bad"], F.concat(F.lit(","), value_text(p["value"]), F.lit("]")))
         .otherwise(F.concat(F.lit(',"'), value_text(p["value"]), F.lit('"]'))))), ",")
    labels = F.from_json(F.col("series_key"), "map<string,string>")
    payload = F.concat(F.lit('{"status":"success","data":{"resultType":"matrix","result":[{"metric":'),
                       _metric_json(F.col("metric"), labels), F.lit(',"values":['), pts_txt, F.lit("]}]}}"))
    return g.select(F.concat_ws("|", "metric", "series_key", F.col("_chunk").cast("string")).alias("payload_id"),
                    F.col("_chunk").alias("chunk"), payload.alias("payload"))


def build_vector_payloads(instant: DataFrame, t_us: int) -> DataFrame:
    """One vector payload per series of an instant result (``value`` column)."""
    labels = F.from_json(F.col("series_key"), "map<string,string>")
    payload = F.concat(F.lit('{"status":"success","data":{"resultType":"vector","result":[{"metric":'),
                       _metric_json(F.col("metric"), labels), F.lit(',"value":['),
                       _ts_text(F.lit(t_us)), F.lit(',"'), value_text(F.col("value")), F.lit('"]}]}}'))
    return instant.select(F.concat_ws("|", "metric", "series_key").alias("payload_id"), payload.alias("payload"))


def build_name_payloads(names: DataFrame, col: str = "metric", spread: int = 64) -> DataFrame:
    """Name-list payloads, one per (leading characters, hash bucket) of the
    name, so no single payload collects every name."""
    pid = F.concat_ws("|", F.substring(col, 1, 2), F.pmod(F.xxhash64(col), F.lit(int(spread))).cast("string"))
    g = names.groupBy(pid.alias("payload_id")).agg(F.array_sort(F.collect_list(col)).alias("_names"))
    return g.select("payload_id", F.concat(F.lit('{"status":"success","data":'), F.to_json("_names"),
                                           F.lit("}")).alias("payload"))
