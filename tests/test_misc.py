"""Clamp, discovery limits, outcome categories, payload decoding, report."""
import re

import pytest
from pyspark.sql import functions as F

from chronolens.model import TimeWindow, clamp_columns
from chronolens.operators import discover, outcomes
from chronolens.plans import findings as fnd
from chronolens.sources import payloads as pl
from chronolens.sources import sinks
from conftest import samples_df

WIN = TimeWindow.of("2024-01-15T10:00:00Z", "2024-01-15T12:00:00Z")


@pytest.mark.parametrize("start,end,ws,we", [
    ("2024-01-15T10:30:00Z", "2024-01-15T11:00:00Z", "10:30", "11:00"),
    ("2024-01-15T09:00:00Z", "2024-01-15T11:00:00Z", "10:00", "11:00"),
    ("2024-01-15T10:30:00Z", "2024-01-15T13:00:00Z", "10:30", "12:00"),
    (None, None, "10:00", "12:00"),
    ("2024-01-15T08:00:00Z", "2024-01-15T15:00:00Z", "10:00", "12:00"),
])
def test_clamp(start, end, ws, we):
    s, e = WIN.clamp(start, end)
    assert s.strftime("%H:%M") == ws and e.strftime("%H:%M") == we


def test_clamp_inverted_and_instant():
    s, e = WIN.clamp("2024-01-15T13:00:00Z", None)
    assert s > e
    assert WIN.clamp_instant("2024-01-15T13:00:00Z").strftime("%H:%M") == "12:00"
    assert WIN.clamp_instant(None).strftime("%H:%M") == "12:00"


def test_clamp_columns(spark):
    df = spark.createDataFrame([(None, None)], "s timestamp, e timestamp")
    s, e = clamp_columns(F.col("s"), F.col("e"), WIN)
    row = df.select(F.unix_timestamp(s).alias("s"), F.unix_timestamp(e).alias("e")).collect()[0]
    assert (row["s"], row["e"]) == (1705312800, 1705320000)


def _names(spark, n):
    return samples_df(spark, [(f"metric_{i:03d}", {}, 1705313000, 1.0) for i in range(n)])


def test_list_default_limit(spark):
    rows = discover.list_metrics(_names(spark, 250), WIN, limit=0).collect()
    assert len(rows) == 200 and all(r["truncated"] for r in rows)


def test_list_limit(spark):
    rows = discover.list_metrics(_names(spark, 50), WIN, limit=10).collect()
    assert [r["metric"] for r in rows] == [f"metric_{i:03d}" for i in range(10)] and rows[0]["truncated"]
    rows = discover.list_metrics(_names(spark, 5), WIN, limit=10).collect()
    assert len(rows) == 5 and not rows[0]["truncated"]


def test_list_labels(spark):
    df = samples_df(spark, [("m", {"job": "x", "instance": "i"}, 1705313000, 1.0)])
    assert sorted(r["label"] for r in discover.list_labels(df, WIN).collect()) == ["__name__", "instance", "job"]


def test_outcomes(spark):
    df = spark.createDataFrame([(c,) for c in (401, 403, 500, 400, 404, 429, 200)], "status_code int")
    got = {r["status_code"]: (r["category"], r["connection_status"])
           for r in outcomes.classify(df).collect()}
    assert got[401] == ("auth", "auth_failed") and got[403] == ("auth", "auth_failed")
    assert got[500] == ("server_error", "error") and got[400] == ("query_error", "error")
    assert got[404] == ("config_error", "wrong_endpoint") and got[429] == ("server_error", "error")
    assert got[200] == (None, "connected")


def test_snippet_cuts_bytes(spark):
    body = "a" * 199 + "日本"
    s = spark.createDataFrame([(body,)], "b string").select(outcomes.snippet(F.col("b")).alias("s")).collect()[0]["s"]
    assert s == "a" * 199 + "�"


PAYLOADS = [
    ("inst", '{"status":"success","data":{"resultType":"vector","result":[{"metric":{"__name__":"up"},"value":[1705312800,"1"]}]}}'),
    ("range", '{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"__name__":"up","job":"a"},"values":[[1705312800,"1"],[1705312860,"2"]]}]}}'),
    ("empty", '{"status":"success","data":{"resultType":"matrix","result":[]}}'),
    ("err", '{"status":"error","errorType":"bad_data","error":"invalid selector"}'),
    ("bad", '<html>oops'),
    ("odd", '{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"__name__":"m"},"values":[[3],["1","2"],[1,5],[1,"x"]]}]}}'),
]


def _pay(spark):
    return spark.createDataFrame(PAYLOADS, "id string, payload string")


def test_payload_decode(spark):
    rng = pl.decode_points(_pay(spark).where("id = 'range'"), id_cols=["id"]).collect()
    assert [(r["ts_s"], r["value"]) for r in rng] == [(1705312800.0, 1.0), (1705312860.0, 2.0)]
    assert rng[0]["metric"] == "up" and rng[0]["series_key"] == '{"job":"a"}'
    inst = pl.decode_points(_pay(spark).where("id = 'inst'"), id_cols=["id"], field="value").collect()
    assert inst[0]["value"] == 1.0
    odd = pl.decode_points(_pay(spark).where("id = 'odd'"), id_cols=["id"]).collect()
    assert len(odd) == 4 and all(r["value"] is None for r in odd)   # all points skipped, series kept


def test_payload_status_and_rejects(spark):
    st = {r["id"]: r["status"] for r in pl.query_status(_pay(spark), id_cols=["id"]).collect()}
    assert st["empty"] == "empty" and st["range"] == "ok"
    rj = {r["id"]: r["message"] for r in pl.rejects(_pay(spark), id_cols=["id"]).collect()}
    assert rj == {"err": "query failed: invalid selector (bad_data)", "bad": "parsing response: invalid JSON"}


def _matrix(result):
    return '{"status":"success","data":{"resultType":"matrix","result":%s}}' % result


def test_payload_order_and_typing(spark):
    from chronolens.plans.payload_diagnose import summarize_payloads
    b, a = '{"metric":{"s":"b"},"values":[[1,"6"],[2,"8"]]}', '{"metric":{"s":"a"},"values":[[1,"2"],[2,"4"]]}'
    rows = [("b before a", _matrix(f"[{b},{a}]")), ("a before b", _matrix(f"[{a},{b}]")),
            ("label no text", _matrix('[%s,{"metric":{"s":5},"values":[[1,"2"]]}]' % a)),
            ("points no list", _matrix('[{"metric":{"s":"a"},"values":[7]}]')),
            ("null", _matrix("[null]")),
            ("two names", _matrix('[{"metric":{"__name__":"x","job":"j"},"values":[[1,"1"]]},'
                                  '{"metric":{"__name__":"y","job":"j"},"values":[[1,"2"]]}]')),
            ("scalar", _matrix('[1,"2"]')), ("nothing", _matrix("null"))]
    df = spark.createDataFrame(rows, "id string, payload string")
    got = {r["id"]: r for r in summarize_payloads(spark, df, ["id"]).collect()}
    assert got["b before a"]["trend"] == "decreasing" and got["a before b"]["trend"] == "increasing"
    assert got["null"]["series_count"] == 1 and got["null"]["n_points"] == 0
    assert got["two names"]["series_count"] == 2
    assert not {"label no text", "points no list", "scalar", "nothing"} & set(got)
    st = {r["id"]: r["status"] for r in pl.query_status(df, id_cols=["id"]).collect()}
    assert st.pop("nothing") == "empty" and set(st.values()) == {"ok"}


def test_payloads_of_one_series_go_in_their_order(spark):
    from chronolens.plans.payload_diagnose import summarize_payloads
    part = lambda *v: _matrix('[{"metric":{},"values":[%s]}]' % ",".join(f'[{i},"{x}"]' for i, x in enumerate(v)))
    df = spark.createDataFrame([("q", 1, part(1, 2)), ("q", 0, part(9, 8))], "id string, payload_idx int, payload string")
    assert summarize_payloads(spark, df, ["id"]).collect()[0]["trend"] == "decreasing"


def test_time_text_in_any_session_zone(spark):
    from chronolens.functions.exprs import rfc3339_from_seconds, utc_day
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            r = spark.range(1).select(rfc3339_from_seconds(F.lit(1704132822)).alias("t"),
                                      rfc3339_from_seconds(F.lit(-1.5)).alias("n"),
                                      utc_day(F.timestamp_micros(F.lit(1704067199_999999))).alias("d")).collect()[0]
            assert (r["t"], r["n"], r["d"]) == ("2024-01-01T18:13:42Z", "1969-12-31T23:59:59Z", "2023-12-31")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_names_payload(spark):
    df = spark.createDataFrame([('{"status":"success","data":["metric_1","metric_2"]}',)], "payload string")
    assert [r["name"] for r in pl.decode_names(df).collect()] == ["metric_1", "metric_2"]


def test_float_text_guard(spark):
    from chronolens.functions.exprs import parse_float_text
    vals = ["1", " 5 ", "5d", "1e400", "+Inf", "NaN", "-2.5e3", ".5", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r["v"] for r in df.select(parse_float_text(F.col("s")).alias("v")).collect()]
    assert got[0] == 1.0 and got[1] is None and got[2] is None and got[3] is None
    assert got[4] == float("inf") and got[5] != got[5] and got[6] == -2500.0 and got[7] == 0.5 and got[8] is None


def test_report(spark):
    empty = spark.createDataFrame([], "component string, metric string, value string, description string, "
                                      "severity string, finding_order long")
    lines = [r["line"] for r in sinks.report_lines(spark, empty, "x").orderBy("line_no").collect()]
    assert lines[-1] == sinks.NO_FINDINGS and lines[1] == "**Test parameters:** x"
    one = spark.createDataFrame([("ruler", "missed", "5", "desc", "critical", 0)], empty.schema)
    lines = [r["line"] for r in sinks.report_lines(spark, one, "x").orderBy("line_no").collect()]
    assert lines[-1] == "| ruler | missed | 5 | critical | desc |" and sinks.TABLE_HEADER in lines


def test_list_metrics_match(spark):
    df = samples_df(spark, [("up", {"job": "a"}, 1705313000, 1.0), ("up_total", {"job": "b"}, 1705313000, 1.0),
                            ("down", {"job": "a"}, 1705313000, 1.0)])
    got = [r["metric"] for r in discover.list_metrics(df, WIN, match=[("__name__", "=~", "up.*")]).collect()]
    assert got == ["up", "up_total"]
    got = [r["metric"] for r in discover.list_metrics(df, WIN, match=[("job", "=", "a")]).collect()]
    assert got == ["down", "up"]


def test_scalar_result_is_not_series(spark):
    df = spark.createDataFrame(
        [("s", '{"status":"success","data":{"resultType":"scalar","result":[1705312800,"1"]}}'),
         ("v", '{"status":"success","data":{"resultType":"vector","result":[{"metric":{"a":"b"},"value":[1,"2"]}]}}')],
        "id string, payload string")
    rows = pl.decode_points(df, id_cols=["id"]).collect()
    assert [r["id"] for r in rows] == ["v"]        # the vector's series counts; the scalar has none
    assert rows[0]["value"] is None                # a vector has no "values": no valid point


def test_category_to_status(spark):
    df = spark.createDataFrame([(c,) for c in CATS], "c string")
    got = {r["c"]: r["s"] for r in df.select("c", outcomes.status_of_category(F.col("c")).alias("s")).collect()}
    assert got == {"auth": "auth_failed", "connectivity": "unreachable", "config_error": "wrong_endpoint",
                   "server_error": "error", "query_error": "error", "timeout": "error"}


CATS = ["auth", "connectivity", "config_error", "server_error", "query_error", "timeout"]


def test_series_cap_two_level_matches_brute_force(spark):
    from chronolens.operators.select import series_cap
    rows = [(m, {"i": f"{i:04d}"}, 1705313000 + i, 1.0) for m in ("a", "b") for i in range(700)]
    df = samples_df(spark, rows)
    got = {(r["metric"], r["series_key"]) for r in series_cap(df, 25, buckets=8).select("metric", "series_key").collect()}
    keys = sorted({(m, '{"i":"%04d"}' % i) for m in ("a", "b") for i in range(700)})
    want = {k for m in ("a", "b") for k in sorted(k for k in keys if k[0] == m)[:25]}
    assert got == want


def test_day_and_month_tables_prune_alike(spark, tmp_path):
    from pyspark.sql import functions as F
    from chronolens.model import Grid
    from chronolens.operators.rangefn import in_reach
    from chronolens.sources.samples import make_samples, read_samples, write_samples
    t0 = 1_705_314_600_000_000  # 2024-01-15T10:30:00Z
    raw = spark.range(60).select(F.lit("m").alias("m"), F.create_map(F.lit("a"), F.lit("b")).alias("l"),
                                 (F.col("id") * 60_000_000 + t0).alias("us"), F.col("id").cast("double").alias("v"))
    rows = make_samples(raw, F.col("m"), F.col("l"), F.col("us"), F.col("v"))
    for part in ("day", "month"):
        path = str(tmp_path / part)
        write_samples(rows, path, part=part)
        assert in_reach(read_samples(spark, path, part), Grid(t0, t0 + 5_400_000_000, 60_000_000), 300).count() == 60


def test_anchored_regex_and_signed_nan(spark):
    from pyspark.sql import functions as F
    from chronolens.functions.exprs import parse_float_text
    from chronolens.operators.select import anchored
    got = [r[0] for r in spark.createDataFrame([("ab",), ("ab\n",), ("xab",), ("a\nb",)], "s string").select(F.col("s").rlike(anchored("a.?b"))).collect()]
    assert got == [True, False, False, True]
    vals = [r[0] for r in spark.createDataFrame([("NaN",), ("+NaN",), ("-nan",), ("-Inf",), ("+1.5",)], "s string").select(parse_float_text("s")).collect()]
    assert vals[0] != vals[0] and vals[1:] == [None, None, float("-inf"), 1.5]


def test_payloads_are_parsed_once(spark):
    from chronolens.plans.payload_diagnose import diagnose_payloads
    from chronolens.plans.registry import default_registry
    rows = [(0, _matrix('[{"metric":{"s":"a"},"values":[[1,"2"],[2,"4"]]}]')), (1, _matrix("[]")), (2, "{")]
    res = diagnose_payloads(spark, spark.createDataFrame(rows, "cand_id int, payload string"),
                            default_registry().to_df(spark))
    # the kept rows alone hold a parse: another one in any plan would have an id of its own
    parses = set()
    for df in (*res.held, res.results, res.candidates, res.points):
        plan = df._jdf.queryExecution().withCachedData().toString()
        assert "InMemoryRelation" in plan
        parses |= set(re.findall(r"parseJson\(.*?AS _v#\d+", plan))
    assert len(parses) == 1
    assert [tuple(r) for r in res.points.select("cand_id", "ts_s", "value").orderBy("ts_s").collect()] == [(0, 1.0, 2.0), (0, 2.0, 4.0)]
    status = {r["cand_id"]: (r["status"], r["error"]) for r in res.candidates.select("cand_id", "status", "error").collect()}
    assert status[0] == ("ok", None) and status[1] == ("empty", None) and status[2] == ("error", "parsing response: invalid JSON")
    res.unpersist()
