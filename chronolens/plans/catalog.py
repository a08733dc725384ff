"""Registered queries over the driver tables (one per operator of the survey).

Every query reads the parquet tables under ``sf_dir`` (through the metric
views of ``sources.testviews``) and returns a DataFrame whose columns are
plain types: BIGINT epoch seconds for times, doubles rounded with ``r6`` and
``series_key`` text for label sets, so the DuckDB oracle can match them.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import epoch_s, fdiv, ntz_micros, parse_rfc3339, r6, utc_day, utc_ntz
from ..model import Grid, clamp_instant_value, clamp_range, series_key, to_micros
from ..operators import aggregate, discover, hist, outcomes, rangefn
from ..operators import select as sel
from ..sources import payloads as pl
from ..sources import sinks
from . import findings as fnd
from . import query as qr
from ..session import materialize, prepare
from ..sources import testviews as tv
from . import diagnose as dg
from .payload_diagnose import diagnose_payloads, summarize_payloads
from .registry import Candidate, Entry, Registry, default_registry, test_registry

EV_GRID = Grid.of(tv.EVENTS_WINDOW.start, tv.EVENTS_WINDOW.end, tv.EVENTS_STEP_S)
OR_GRID = Grid.of(tv.ORDERS_WINDOW.start, tv.ORDERS_WINDOW.end, tv.ORDERS_STEP_S)
KEYS = ["metric", "series_key"]


def _step_s() -> F.Column:
    return epoch_s(F.unix_micros("step_ts")).alias("step_s")


def _counters(spark, sf):
    return tv.metric_table(spark, sf, "events_total", "event_value_sum_total")


# ------------------------------------------------------------------ T1–T8

def rate_q(spark: SparkSession, sf: str) -> DataFrame:
    s = rangefn.in_reach(_counters(spark, sf), EV_GRID, tv.EVENTS_RANGE_S)
    r = rangefn.rate(s, KEYS, EV_GRID, tv.EVENTS_RANGE_S)
    return r.select("metric", "series_key", _step_s(), r6("value").alias("value"))


def increase_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = rangefn.in_reach(tv.metric_table(spark, sf, "events_total"), EV_GRID, tv.EVENTS_RANGE_S)
    a = rangefn.increase(ev, KEYS, EV_GRID, tv.EVENTS_RANGE_S)
    sh = rangefn.in_reach(tv.metric_table(spark, sf, "shipped_quantity_total"), OR_GRID, tv.ORDERS_RANGE_S)
    b = rangefn.increase(sh, KEYS, OR_GRID, tv.ORDERS_RANGE_S, bucket_s=86400 * 28)
    return (a.unionByName(b)).select("metric", "series_key", _step_s(), r6("value").alias("value"))


ODD_RANGE_S = tv.EVENTS_STEP_S * 7 // 2   # not a whole number of steps


def rate_odd_range_q(spark: SparkSession, sf: str) -> DataFrame:
    """Rate, increase and range vector where the range is no whole number of steps."""
    s = rangefn.in_reach(_counters(spark, sf), EV_GRID, ODD_RANGE_S)
    rate, inc = (f(s, KEYS, EV_GRID, ODD_RANGE_S).withColumn("kind", F.lit(name))
                 for name, f in (("rate", rangefn.rate), ("increase", rangefn.increase)))
    vec = (rangefn.range_vector(s, KEYS, EV_GRID, ODD_RANGE_S)
           .select(*KEYS, "k", "step_ts", F.col("n").cast("double").alias("value"), F.lit("count").alias("kind")))
    return (rate.unionByName(inc).unionByName(vec)
            .select("kind", "metric", "series_key", _step_s(), r6("value").alias("value")))


LONG_GRID = Grid.of(tv.EVENTS_WINDOW.start, tv.EVENTS_WINDOW.end, 3600)
LONG_RANGE_S = 120 * 3600   # 120 steps


def increase_long_range_q(spark: SparkSession, sf: str) -> DataFrame:
    """Increase over ranges of 120 steps."""
    s = rangefn.in_reach(_counters(spark, sf), LONG_GRID, LONG_RANGE_S)
    r = rangefn.increase(s, KEYS, LONG_GRID, LONG_RANGE_S)
    return r.select("metric", "series_key", _step_s(), r6("value").alias("value"))


def rate_repeated_samples_q(spark: SparkSession, sf: str) -> DataFrame:
    """Rate where every sample is there twice, and on odd seconds a third time with half the value."""
    s = rangefn.in_reach(_counters(spark, sf), EV_GRID, tv.EVENTS_RANGE_S)
    low = s.where(F.pmod(epoch_s(F.col("ts_us")), F.lit(2)) == 1).withColumn("value", F.col("value") / 2)
    r = rangefn.rate(s.unionByName(s).unionByName(low), KEYS, EV_GRID, tv.EVENTS_RANGE_S)
    return r.select("metric", "series_key", _step_s(), r6("value").alias("value"))


def rate_bucketed_q(spark: SparkSession, sf: str) -> DataFrame:
    """Rate over a table bucketed by series and time chunk: raw samples stay where they are."""
    s = rangefn.in_reach(tv.bucketed_table(spark, sf), EV_GRID, tv.EVENTS_RANGE_S)
    r = rangefn.rate(s, KEYS, EV_GRID, tv.EVENTS_RANGE_S)
    return r.select("metric", "series_key", _step_s(), r6("value").alias("value"))


# Requests of the composed queries: name, expression, start (or time), end.
RUNS = [
    ("gauge", qr.Expr("event_value", "gauge", (("event_type", "=", "click"),)), None, None),
    ("rate", qr.Expr("events_total", "rate", (("event_type", "!=", "click"),), tv.EVENTS_RANGE_S),
     "2024-01-10T00:00:00Z", "2024-02-10T00:00:00Z"),
    ("regex", qr.Expr("event_value_sum_total", "increase", (("shard", "=~", "0|3"), ("event_type", "!~", "v.*")),
                      tv.EVENTS_RANGE_S), None, "2024-01-07T00:00:00Z"),
    ("absent", qr.Expr("no_such_metric"), None, None),
    ("inverted", qr.Expr("event_value"), "2024-02-01T00:00:00Z", "2024-02-02T00:00:00Z"),
]


def _runs(results) -> DataFrame:
    """Per request its result row (no metric) and its points (no status)."""
    rows = [df.withColumn("request", F.lit(name)) for name, res in results for df in (
        res.result, res.data.select("metric", "series_key", _step_s(), r6("value").alias("value")))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def query_run_q(spark: SparkSession, sf: str) -> DataFrame:
    """Instant queries: results and points."""
    s = tv.samples_table(spark, sf)
    return _runs((n, qr.query(s, x, tv.EVENTS_WINDOW, t, tv.EVENTS_LOOKBACK_S)) for n, x, t, _ in RUNS)


def query_range_run_q(spark: SparkSession, sf: str) -> DataFrame:
    """Range queries: results and points."""
    s = tv.samples_table(spark, sf)
    return _runs((n, qr.query_range(s, x, tv.EVENTS_WINDOW, a, b, tv.EVENTS_STEP_S, tv.EVENTS_LOOKBACK_S))
                 for n, x, a, b in RUNS)


def query_range_gauge_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = rangefn.in_reach(tv.metric_table(spark, sf, "event_value"), EV_GRID, tv.EVENTS_LOOKBACK_S)
    a = rangefn.gauge_on_grid(ev, KEYS, EV_GRID, tv.EVENTS_LOOKBACK_S)
    op = rangefn.in_reach(tv.metric_table(spark, sf, "order_price"), OR_GRID, tv.ORDERS_RANGE_S)
    b = rangefn.gauge_on_grid(op, KEYS, OR_GRID, tv.ORDERS_RANGE_S, bucket_s=86400 * 28)
    return (a.unionByName(b)).select("metric", "series_key", _step_s(), r6("value").alias("value"),
                                     epoch_s(F.col("ts_us")).alias("sample_s"))


def range_vector_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = rangefn.in_reach(tv.metric_table(spark, sf, "event_value"), EV_GRID, tv.EVENTS_RANGE_S)
    r = rangefn.range_vector(ev, KEYS, EV_GRID, tv.EVENTS_RANGE_S)
    return r.select("metric", "series_key", _step_s(), F.col("n").alias("n_samples"),
                    epoch_s(F.col("first_ts_us")).alias("first_s"), epoch_s(F.col("last_ts_us")).alias("last_s"),
                    r6("sum_value").alias("sum_value"))


def query_instant_q(spark: SparkSession, sf: str) -> DataFrame:
    t = EV_GRID.end_us
    s = rangefn.in_reach(tv.metric_table(spark, sf, *tv.EVENT_METRICS), Grid(t, t, 1), tv.EVENTS_LOOKBACK_S)
    r = rangefn.instant(s, KEYS, t, tv.EVENTS_LOOKBACK_S)
    return r.select("metric", "series_key", r6("value").alias("value"),
                    epoch_s(F.col("sample_ts_us")).alias("sample_s"),
                    F.lit(t // 1_000_000).alias("eval_s"))


def _bucket_rates(spark, sf):
    s = rangefn.in_reach(tv.metric_table(spark, sf, "event_value_bucket"), EV_GRID, tv.EVENTS_RANGE_S)
    r = rangefn.rate(s, KEYS, EV_GRID, tv.EVENTS_RANGE_S, carry=["labels"])
    return (r.withColumn("le", F.col("labels")["le"])
             .withColumn("grp_key", series_key(F.map_filter("labels", lambda k, v: k != "le"))))


def histogram_quantile_q(spark: SparkSession, sf: str) -> DataFrame:
    out = hist.histogram_quantile(_bucket_rates(spark, sf), [0.99, 0.5], ["grp_key"])
    return out.select("quantile", F.col("grp_key").alias("series_key"), _step_s(), r6("value").alias("value"))


def sum_over_series_q(spark: SparkSession, sf: str) -> DataFrame:
    s = rangefn.in_reach(tv.metric_table(spark, sf, "event_value_sum_total"), EV_GRID, tv.EVENTS_RANGE_S)
    r = rangefn.rate(s, KEYS, EV_GRID, tv.EVENTS_RANGE_S, carry=["labels"])
    by_type = aggregate.sum_by(r, ["event_type"])
    total = aggregate.sum_by(r, []).withColumn("event_type", F.lit(""))
    return (by_type.unionByName(total)).select("event_type", _step_s(), r6("value").alias("value"))


# ------------------------------------------------------------------ diagnose

@lru_cache(maxsize=4)
def _registry():
    return test_registry()


def diagnose_run(spark: SparkSession, sf: str, component: str = "all", **how) -> dg.DiagnoseResult:
    prepare(spark)
    samples = tv.metric_table(spark, sf, *tv.EVENT_METRICS)
    return dg.diagnose(spark, samples, _registry(), tv.EVENTS_WINDOW, step_s=tv.EVENTS_STEP_S,
                       component=component, series=tv.series_table(spark, sf), **how)


def _summary_cols():
    return [F.col("series_count"), F.col("n_points"), r6("max_value").alias("max_value"), F.col("max_timestamp"),
            r6("avg_value").alias("avg_value"), r6("non_zero_percentage").alias("non_zero_percentage"),
            F.col("trend")]


def diagnose_all_q(spark: SparkSession, sf: str) -> DataFrame:
    res = diagnose_run(spark, sf).results
    return res.select("component", F.col("ordinal").cast("long").alias("ordinal"), "name", "query", "status",
                      *_summary_cols())


def diagnose_component_q(spark: SparkSession, sf: str) -> DataFrame:
    res = diagnose_run(spark, sf, "ruler").results
    return res.select("component", F.col("ordinal").cast("long").alias("ordinal"), "name", "query", "status",
                      *_summary_cols())


def mixed_registry() -> Registry:
    """Candidates with ranges, lookbacks and matchers of their own; the step is six hours."""
    hour = 3600
    c = Candidate
    return Registry([
        Entry("ruler", "short_rate", "Rate over a third of the step", (c("rate", "events_total", (), 2 * hour),)),
        Entry("ruler", "long_increase", "Increase over five days",
              (c("increase", "events_total", (("event_type", "!=", "click"),), 120 * hour),)),
        Entry("ruler", "odd_increase", "Increase over three and a half steps",
              (c("increase", "event_value_sum_total", (("shard", "=~", "0|3"), ("event_type", "!~", "v.*")), 21 * hour),)),
        Entry("ingester", "default_rate", "Rate over the registry's range", (c("rate", "event_value_sum_total"),)),
        Entry("ingester", "recent_gauge", "Gauge of the last two hours", (c("gauge", "event_value", (), None, 2 * hour),)),
        Entry("querier", "long_gauge", "Gauge of the last three days, by regex",
              (c("gauge", "no_such_metric"), c("gauge", "event_value", (("event_type", "=~", "p.*|s.*"),), None, 72 * hour))),
        Entry("querier", "long_p90", "p90 over two days", (c("hquantile", "event_value_bucket", (), 48 * hour),), 0.9),
        # its primary has a series, but hardly a sample in the second before a step
        Entry("distributor", "later_answer", "The first candidate has a series but no point",
              (c("gauge", "events_total", (("event_type", "click"),), None, 1),
               c("increase", "events_total", (("event_type", "=", "click"),), 24 * hour))),
    ], tv.EVENTS_RANGE_S, tv.EVENTS_LOOKBACK_S)


def diagnose_mixed_ranges_q(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    res = dg.diagnose(spark, tv.metric_table(spark, sf, *tv.EVENT_METRICS), mixed_registry(), tv.EVENTS_WINDOW,
                      step_s=tv.EVENTS_STEP_S, series=tv.series_table(spark, sf), staged=True).results
    return res.select("component", F.col("ordinal").cast("long").alias("ordinal"), "name", "query", "status",
                      F.col("priority").cast("long").alias("priority"), *_summary_cols())


def diagnose_default_registry_q(spark: SparkSession, sf: str) -> DataFrame:
    """The registry as it ships, at its own step and ranges, over one day of series named as its metrics."""
    prepare(spark)
    res = dg.diagnose(spark, tv.registry_samples(spark, sf), default_registry(), tv.REGISTRY_WINDOW).results
    return res.select("component", F.col("ordinal").cast("long").alias("ordinal"), "name", "query", "status",
                      F.col("priority").cast("long").alias("priority"), *_summary_cols())


def parse_time_q(spark: SparkSession, sf: str) -> DataFrame:
    """Times of events as text, some of it no RFC 3339 time, read back to microseconds."""
    e = tv.table(spark, sf, "events").select("event_id", ntz_micros(F.col("ts")).alias("us"))
    k = F.pmod("event_id", F.lit(len(TIME_FORMS))).cast("int")
    wall = lambda us: utc_ntz(epoch_s(us)).cast("string")
    day, clock = F.left(wall(F.col("us")), F.lit(10)), F.right(wall(F.col("us")), F.lit(8))
    frac = F.lpad(F.pmod("us", F.lit(1_000_000)).cast("string"), 6, "0")
    text = F.element_at(F.array(*[F.lit(f) for f in TIME_FORMS]), k + 1)
    for mark, part in (("{d}", day), ("{t}", clock), ("{f}", frac)):
        text = F.replace(text, F.lit(mark), part)
    return e.select("event_id", text.alias("text"), parse_rfc3339(text).alias("parsed_us"))


# Forms of time text, with {d} the day, {t} the time of day and {f} six digits of its fraction.
TIME_FORMS = [
    "{d}T{t}Z", "{d}T{t}.{f}Z", "{d}T{t}+05:30", "{d}T{t}.{f}-08:00", "{d}T{t}.5Z", "{d}T{t}.{f}789+00:00",
    "{d}", "{d}T{t}", "{d} {t}Z", " {d}T{t}Z", "{d}T{t}Z ", "{d}T{t}+0530", "{d}T{t}.Z", "{d}T{t}+25:00",
    "{d}T24:00:00Z", "{d}T{t}+05:60", "2024-02-30T{t}Z", "2023-02-29T{t}Z", "2024-W03-1T{t}Z", "20240115T{t}Z",
    "2024-13-01T{t}Z", "2024-00-10T{t}Z", "{d}T23:59:60Z", "", "{d}t{t}z", "2024-02-29T{t}Z", "0001-01-01T00:00:00Z",
]


def fallback_q(spark: SparkSession, sf: str) -> DataFrame:
    res = diagnose_run(spark, sf, staged=True).results
    return res.select("name", F.col("priority").cast("long").alias("priority"), "query", "status",
                      "fallback_used")


def query_status_q(spark: SparkSession, sf: str) -> DataFrame:
    c = diagnose_run(spark, sf).candidates
    return c.select(F.col("cand_id").cast("long").alias("cand_id"), "name",
                    F.col("priority").cast("long").alias("priority"), "query", "status", "n_points")


def diagnose_points_q(spark: SparkSession, sf: str) -> DataFrame:
    d = diagnose_run(spark, sf)
    win = d.results.select("cand_id", "component", "name")
    return (d.points.join(win, on="cand_id")
            .select("component", "name", "series_key", _step_s(), r6("value").alias("value")))


def _cand_summary(spark, sf):
    return diagnose_run(spark, sf).candidates.withColumn("cand_id", F.col("cand_id").cast("long"))


def query_summary_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", *_summary_cols(), r6("slope").alias("slope"),
                                           r6("cv").alias("cv"))


def summary_count_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", "series_count")


def summary_max_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", r6("max_value").alias("max_value"), "max_timestamp")


def summary_avg_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", r6("avg_value").alias("avg_value"))


def summary_nonzero_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", "n_points",
                                           r6("non_zero_percentage").alias("non_zero_percentage"))


def summary_empty_q(spark, sf):
    c = _cand_summary(spark, sf).where(F.col("status") == "empty")
    return c.select("cand_id", *_summary_cols())


def trend_slope_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", "n_points", r6("slope").alias("slope"))


def trend_cv_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", "n_points", r6("cv").alias("cv"))


def trend_label_q(spark, sf):
    return _cand_summary(spark, sf).select("cand_id", "trend")


# ------------------------------------------------------------------ F1–F9, T2

DAY_S = 86400


def _requests(spark, sf):
    """A table of requests derived from events: start = event time (unset for
    'view' events), end = start + user_id hours (unset for 'signup')."""
    e = tv.table(spark, sf, "events")
    t = ntz_micros(F.col("ts"))
    return e.select("event_id",
                    F.when(F.col("event_type") != "view", t).alias("start_us"),
                    F.when(F.col("event_type") != "signup", t + F.col("user_id") * F.lit(3600 * 1_000_000))
                     .alias("end_us"),
                    t.alias("t_us"))


def clamp_window_q(spark, sf):
    r = _requests(spark, sf)
    ws, we = to_micros(tv.EVENTS_WINDOW.start), to_micros(tv.EVENTS_WINDOW.end)
    s, e = clamp_range(F.col("start_us"), F.col("end_us"), F.lit(ws), F.lit(we))
    return r.select("event_id", epoch_s(s).alias("start_s"), epoch_s(e).alias("end_s"), (s > e).alias("inverted"))


def clamp_instant_q(spark, sf):
    r = _requests(spark, sf).withColumn("t_us", F.col("start_us"))
    ws, we = to_micros(tv.EVENTS_WINDOW.start), to_micros(tv.EVENTS_WINDOW.end)
    return r.select("event_id", epoch_s(clamp_instant_value(F.col("t_us"), F.lit(ws), F.lit(we))).alias("t_s"))


def step_grid_q(spark, sf):
    r = _requests(spark, sf)
    ws, we = to_micros(tv.EVENTS_WINDOW.start), to_micros(tv.EVENTS_WINDOW.end)
    s, e = clamp_range(F.col("start_us"), F.col("end_us"), F.lit(ws), F.lit(we))
    steps = rangefn.request_steps(s, e, DAY_S * 1_000_000)
    return r.select("event_id", F.posexplode(steps).alias("k", "step_us")).select(
        "event_id", F.col("k").cast("long").alias("k"), epoch_s(F.col("step_us")).alias("step_s"))


def _pt_cols():
    return [epoch_s(F.col("ts_us")).alias("ts_s"), r6("value").alias("value")]


def select_metric_q(spark, sf):
    s = discover.in_window(sel.select(tv.samples_table(spark, sf), "order_price"), tv.ORDERS_WINDOW)
    return s.select("metric", "series_key", *_pt_cols())


def select_label_eq_q(spark, sf):
    s, series = (t.where(F.col("metric").isin("events_total", "event_value_sum_total"))
                 for t in (tv.samples_table(spark, sf), tv.series_table(spark, sf)))
    return sel.select_series(s, series, None, {"event_type": "click", "shard": ""}).select("metric", "series_key", *_pt_cols())


def select_label_re_q(spark, sf):
    s = sel.select_series(tv.samples_table(spark, sf), tv.series_table(spark, sf), "event_value_bucket",
                          [("le", "=~", "[0-9]0")])
    return s.select("series_key", *_pt_cols())


def select_name_re_q(spark, sf):
    s = sel.select_name_regex(tv.series_table(spark, sf), "event_value.*")
    by_series = s.groupBy("metric", "series_key").agg(F.sum("n_samples").alias("n"))
    return by_series.groupBy("metric").agg(F.sum("n").alias("n_samples"), F.count(F.lit(1)).alias("n_series"))


def series_cap_q(spark, sf):
    s = sel.series_cap(tv.samples_table(spark, sf), 3, series=tv.series_table(spark, sf))
    return s.groupBy("metric", "series_key").agg(F.count(F.lit(1)).alias("n_samples"))


# ------------------------------------------------------------------ L1–L3, D1

def list_metrics_q(spark, sf):
    return discover.list_metrics(tv.samples_table(spark, sf), tv.EVENTS_WINDOW, series=tv.series_table(spark, sf))


def list_metrics_limit_q(spark, sf):
    return discover.list_metrics(tv.samples_table(spark, sf), tv.EVENTS_WINDOW, limit=2,
                                 series=tv.series_table(spark, sf))


def list_labels_q(spark, sf):
    return discover.list_labels(tv.samples_table(spark, sf), tv.EVENTS_WINDOW, tv.series_table(spark, sf))


def bundle_registry_q(spark, sf):
    reg = _registry().to_df(spark)
    names = discover.metric_names(tv.samples_table(spark, sf), tv.EVENTS_WINDOW,
                                  series=tv.series_table(spark, sf)).withColumn("present", F.lit(True))
    return (reg.join(names, on="metric", how="left")
               .select("component", "name", F.col("priority").cast("long").alias("priority"), "metric",
                       F.coalesce(F.col("present"), F.lit(False)).alias("present")))


# ------------------------------------------------------------------ C1–C3

# Status codes the test outcomes are drawn from (k % 8 picks one).
STATUS_CODES = [200, 400, 401, 403, 404, 429, 500, 503]


def _code(k: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in STATUS_CODES]), (F.pmod(k, F.lit(8)) + 1).cast("int"))


def _event_k(spark, sf):
    e = tv.table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def outcome_rollup_q(spark, sf):
    r = _event_k(spark, sf).withColumn("status_code", _code(F.col("k")))
    return outcomes.rollup(r).select(
        F.col("status_code").cast("long").alias("status_code"),
        F.coalesce("category", F.lit("")).alias("category"),
        "connection_status",
        F.when(F.col("category").isNotNull(), outcomes.status_of_category(F.col("category")))
         .otherwise(F.lit("")).alias("error_status"),
        "n")


def outcome_snippet_q(spark, sf):
    d = tv.table(spark, sf, "documents")
    r = d.select("doc_id", F.col("text").alias("body"), _code(F.col("doc_id")).alias("status_code"))
    c = outcomes.classify(r, body_col="body")
    snip = outcomes.snippet(F.col("body"))
    return c.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("status_code").cast("long").alias("status_code"),
                    F.coalesce("category", F.lit("")).alias("category"),
                    F.octet_length(snip).cast("long").alias("snippet_bytes"),
                    F.coalesce("message", F.lit("")).alias("message"))


# ------------------------------------------------------------------ S1–S8

def payload_matrix_q(spark, sf):
    s = tv.metric_table(spark, sf, "event_value", "event_value_sum_total")
    pays = pl.build_range_payloads(s)
    pts = pl.decode_points(pays, id_cols=["payload_id"])
    return pts.select("metric", "series_key", F.floor("ts_s").cast("long").alias("ts_s"), r6("value").alias("value"))


def payload_summary_q(spark, sf):
    """Summary per day over range payloads of ``event_value`` in which some
    points are malformed (value as a JSON number): values below 1, and every
    point on the 7th of the month. Skipped points leave their series counted."""
    s = tv.metric_table(spark, sf, "event_value")
    bad = (F.col("value") < 1.0) | utc_day("ts").endswith("-07")
    pays = pl.build_range_payloads(s.withColumn("_bad", bad), bad_col="_bad")
    summ = summarize_payloads(spark, pays.select("chunk", "payload"), ["chunk"])
    return summ.select(F.col("chunk").cast("long").alias("day"), *_summary_cols())


def payload_edge_q(spark, sf):
    """Status and summary per (day, event type) over responses with two metrics of equal labels,
    the later name first; on every 5th day a label is a number, so nothing decodes; on every 7th
    a null element follows, which counts as a series."""
    s = tv.metric_table(spark, sf, "event_value", "events_total")
    day = fdiv(F.col("ts_us"), F.lit(DAY_S * 1_000_000))
    # one series' samples of one day bound the group
    one = (s.groupBy("series_key", day.alias("day"), "metric")
           .agg(F.array_sort(F.collect_list(F.struct("ts_us", "value"))).alias("p")))
    pts = F.array_join(F.transform("p", lambda p: F.concat(
        F.lit("["), (p["ts_us"].cast("double") / F.lit(1e6)).cast("string"), F.lit(',"'), pl.value_text(p["value"]),
        F.lit('"]'))), ",")
    labels = F.when(F.pmod("day", F.lit(5)) == 0, F.lit('"event_type":5')) \
              .otherwise(F.expr("substring(series_key, 2, length(series_key) - 2)"))
    series = F.concat(F.lit('{"metric":{"__name__":"'), "metric", F.lit('",'), labels, F.lit('},"values":['), pts,
                      F.lit("]}"))
    pays = (one.select("series_key", "day", "metric", series.alias("j")).groupBy("series_key", "day")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("metric", "j")), asc=False), lambda x: x["j"])
                 .alias("js"))
            .select("series_key", "day", F.concat(
                F.lit('{"status":"success","data":{"resultType":"matrix","result":['), F.array_join("js", ","),
                F.when(F.pmod("day", F.lit(7)) == 0, F.lit(",null")).otherwise(F.lit("")), F.lit("]}}"))
                .alias("payload"))
            .withColumnRenamed("series_key", "grp"))
    keys = ["grp", "day"]
    summ = summarize_payloads(spark, pays, keys)
    out = dg._fill_empty(pl.query_status(pays, id_cols=keys).join(summ, keys, "left"))
    # the mean times the count: a mean of 2^k values can lie on a rounding tie
    cols = [c for c in _summary_cols() if "avg_value" not in str(c)]
    return out.select(F.col("grp").alias("labels"), "day", "status", *cols,
                      r6(F.col("avg_value") * F.col("n_points")).alias("pooled_sum"))


def payload_vector_q(spark, sf):
    t = EV_GRID.end_us
    s = rangefn.in_reach(tv.metric_table(spark, sf, *tv.EVENT_METRICS), Grid(t, t, 1), tv.EVENTS_LOOKBACK_S)
    inst = rangefn.instant(s, KEYS, t, tv.EVENTS_LOOKBACK_S)
    pts = pl.decode_points(pl.build_vector_payloads(inst, t), id_cols=["payload_id"], field="value")
    return pts.select("metric", "series_key", F.floor("ts_s").cast("long").alias("eval_s"),
                      r6("value").alias("value"))


def payload_names_q(spark, sf):
    names = discover.metric_names(tv.samples_table(spark, sf), tv.EVENTS_WINDOW, series=tv.series_table(spark, sf))
    return pl.decode_names(pl.build_name_payloads(names)).select(F.col("name").alias("metric"))


def _responses(spark, sf):
    """(event_id, status_code, body) derived from events: HTTP errors carry an
    error body; 200 responses are an error envelope, malformed text or a
    success payload depending on k."""
    r = _event_k(spark, sf).withColumn("status_code", _code(F.col("k")))
    k, code = F.col("k"), F.col("status_code")
    etype = F.when(code >= 500, F.lit("internal")).otherwise(F.lit("bad_data"))
    body = (F.when(code >= 400, F.format_string('{"status":"error","errorType":"%s","error":"status %d"}', etype, code))
             .when(F.pmod(k, F.lit(3)) == 0,
                   F.format_string('{"status":"error","errorType":"bad_data","error":"invalid selector %d"}', k))
             .when(F.pmod(k, F.lit(3)) == 1, F.lit("<html>gateway page</html>"))
             .otherwise(F.format_string('{"status":"success","data":{"resultType":"vector","result":[]}}')))
    return r.withColumn("body", body)


def payload_rejects_q(spark, sf):
    r = outcomes.classify(_responses(spark, sf), body_col="body")
    http = r.where(F.col("status_code") >= 400).select("event_id", "status_code", "category", "message")
    parsed = pl.rejects(r.where(F.col("status_code") < 400), col="body", id_cols=["event_id", "status_code"])
    body = parsed.select("event_id", "status_code", F.lit("").alias("category"), "message")
    return http.unionByName(body).select(F.col("event_id").cast("long").alias("event_id"),
                                         F.col("status_code").cast("long").alias("status_code"),
                                         F.coalesce("category", F.lit("")).alias("category"), "message")


def candidate_responses(spark, sf):
    """Responses per registry candidate, derived from the evaluated test data:
    one matrix payload per (candidate, series) holding its points; an empty
    result for a candidate that selected nothing; an error envelope for a
    candidate whose metric does not exist at all (an unknown metric)."""
    prepare(spark)
    reg_obj = _registry()
    reg = reg_obj.to_df(spark)
    points = dg.evaluate_candidates(tv.metric_table(spark, sf, *tv.EVENT_METRICS), reg, EV_GRID,
                                    metrics=reg_obj.metrics(), range_s=reg_obj.range_s,
                                    max_reach_s=max(reg_obj.range_s, reg_obj.lookback_s))
    known = tv.samples_table(spark, sf).select("metric").distinct().withColumn("_known", F.lit(True))
    cands = reg.join(known, "metric", "left").select("cand_id", "metric",
                                                       F.coalesce("_known", F.lit(False)).alias("known"))
    g = (points.groupBy("cand_id", "series_key")
         .agg(F.array_sort(F.collect_list(F.struct(F.unix_micros("step_ts").alias("t"), "value"))).alias("_p")))
    vals = F.array_join(F.transform("_p", lambda p: F.concat(
        F.lit("["), (p["t"].cast("double") / F.lit(1e6)).cast("string"), F.lit(',"'), pl.value_text(p["value"]),
        F.lit('"]'))), ",")
    data = g.select("cand_id", F.concat(
        F.lit('{"status":"success","data":{"resultType":"matrix","result":[{"metric":'), F.col("series_key"),
        F.lit(',"values":['), vals, F.lit("]}]}}")).alias("payload"))
    empty = (cands.where("known").join(g.select("cand_id").distinct(), "cand_id", "left_anti")
             .select("cand_id", F.lit('{"status":"success","data":{"resultType":"matrix","result":[]}}')
                     .alias("payload")))
    errors = cands.where(~F.col("known")).select("cand_id", F.format_string(
        '{"status":"error","errorType":"bad_data","error":"unknown metric %s"}', "metric").alias("payload"))
    # responses arrive as files in practice: write them once, read them back
    return materialize(data.unionByName(empty).unionByName(errors), "responses")


def diagnose_payloads_q(spark, sf):
    res = diagnose_payloads(spark, candidate_responses(spark, sf), _registry().to_df(spark)).results
    return res.select("component", F.col("ordinal").cast("long").alias("ordinal"), "name", "query", "status",
                      F.coalesce("error", F.lit("")).alias("error"), *_summary_cols())


def diagnose_json_q(spark, sf):
    """The whole run as one document; numbers with six places, so that texts can be compared."""
    return sinks.results_json(diagnose_run(spark, sf).results, decimals=6)


def diagnose_json_component_q(spark, sf):
    return sinks.results_json(diagnose_run(spark, sf, "ruler").results, decimals=6)


def diagnose_json_verbose_q(spark, sf):
    """Every series of the ruler's results with its points, a JSON line each."""
    d = diagnose_run(spark, sf, "ruler")
    return sinks.verbose_json(d.results, d.points, decimals=6)


def findings_report_q(spark, sf):
    f = fnd.findings(diagnose_run(spark, sf).results, fnd.default_rules())
    return sinks.report_lines(spark, f, "test-data window 2024-01-05 to 2024-01-25, step 6h")


QUERIES = {
    "rate": rate_q,
    "increase": increase_q,
    "rate_odd_range": rate_odd_range_q,
    "increase_long_range": increase_long_range_q,
    "rate_repeated_samples": rate_repeated_samples_q,
    "rate_bucketed": rate_bucketed_q,
    "diagnose_mixed_ranges": diagnose_mixed_ranges_q,
    "diagnose_default_registry": diagnose_default_registry_q,
    "diagnose_json_verbose": diagnose_json_verbose_q,
    "parse_time": parse_time_q,
    "query_run": query_run_q,
    "query_range_run": query_range_run_q,
    "query_range_gauge": query_range_gauge_q,
    "range_vector": range_vector_q,
    "query_instant": query_instant_q,
    "histogram_quantile": histogram_quantile_q,
    "sum_over_series": sum_over_series_q,
    "diagnose_all": diagnose_all_q,
    "diagnose_component": diagnose_component_q,
    "fallback": fallback_q,
    "query_status": query_status_q,
    "diagnose_points": diagnose_points_q,
    "query_summary": query_summary_q,
    "summary_count": summary_count_q,
    "summary_max": summary_max_q,
    "summary_avg": summary_avg_q,
    "summary_nonzero": summary_nonzero_q,
    "summary_empty": summary_empty_q,
    "trend_slope": trend_slope_q,
    "trend_cv": trend_cv_q,
    "trend_label": trend_label_q,
    "clamp_window": clamp_window_q,
    "clamp_instant": clamp_instant_q,
    "step_grid": step_grid_q,
    "select_metric": select_metric_q,
    "select_label_eq": select_label_eq_q,
    "select_label_re": select_label_re_q,
    "select_name_re": select_name_re_q,
    "series_cap": series_cap_q,
    "list_metrics": list_metrics_q,
    "list_metrics_limit": list_metrics_limit_q,
    "list_labels": list_labels_q,
    "bundle_registry": bundle_registry_q,
    "outcome_rollup": outcome_rollup_q,
    "outcome_snippet": outcome_snippet_q,
    "payload_matrix": payload_matrix_q,
    "payload_vector": payload_vector_q,
    "payload_summary": payload_summary_q,
    "payload_edge": payload_edge_q,
    "payload_names": payload_names_q,
    "payload_rejects": payload_rejects_q,
    "diagnose_payloads": diagnose_payloads_q,
    "diagnose_json": diagnose_json_q,
    "diagnose_json_component": diagnose_json_component_q,
    "findings_report": findings_report_q,
}

__all__ = ["QUERIES", "diagnose_run", "candidate_responses"]
