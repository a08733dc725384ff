"""Registry lookup and the fallback rule (bundles tests of the reference)."""
import pytest
from pyspark.sql import functions as F

from chronolens.model import TimeWindow
from chronolens.plans.diagnose import diagnose
from chronolens.plans.registry import COMPONENTS, Candidate, Entry, Registry, default_registry, render
from conftest import samples_df


def test_counts():
    reg = default_registry()
    want = {"ruler": 8, "ingester": 5, "querier": 4, "distributor": 3, "compactor": 2, "store_gateway": 2}
    for c in COMPONENTS:
        assert len(reg.bundle(c).entries) == want[c]
    assert len(reg.bundle("all").entries) == 24
    kinds = [e.candidates[0].kind for e in reg.entries]
    assert (kinds.count("hquantile"), kinds.count("rate"), kinds.count("increase"), kinds.count("gauge")) == (6, 10, 1, 7)
    assert sum(len(e.candidates) > 1 for e in reg.entries) == 5


def test_unknown_component():
    with pytest.raises(ValueError, match="unknown subsystem"):
        default_registry().bundle("nope")


def test_render():
    assert render(Candidate("hquantile", "m_bucket"), 0.99, 300) == "histogram_quantile(0.99, rate(m_bucket[5m]))"
    assert render(Candidate("gauge", "cortex_ring_members", (("name", "ruler"),)), 0.99, 300) == \
        'cortex_ring_members{name="ruler"}'
    assert render(Candidate("increase", "x_total"), 0.99, 7200) == "increase(x_total[2h])"


WIN = TimeWindow.of("2024-01-15T10:00:00Z", "2024-01-15T12:00:00Z")
T0 = 1705312800  # 10:00


def _reg(*cands):
    return Registry([Entry("ruler", "q", "d", tuple(cands))], range_s=300, lookback_s=300)


def _rows(metric, n=30):
    return [(metric, {"job": "a"}, T0 + 60 * i, float(i)) for i in range(n)]


def _run(spark, rows, reg):
    df = samples_df(spark, rows)
    return diagnose(spark, df, reg, WIN, step_s=60).results.collect()[0]


def test_fallback_to_alternative(spark):
    r = _run(spark, _rows("alt_total"), _reg(Candidate("rate", "primary_total"), Candidate("rate", "alt_total")))
    assert r["priority"] == 1 and r["query"] == "rate(alt_total[5m])" and r["status"] == "ok"


def test_primary_with_data_wins(spark):
    rows = _rows("primary_total") + _rows("alt_total")
    r = _run(spark, rows, _reg(Candidate("rate", "primary_total"), Candidate("rate", "alt_total")))
    assert r["priority"] == 0 and r["query"] == "rate(primary_total[5m])"


def test_second_alternative(spark):
    r = _run(spark, _rows("alt2_total"), _reg(Candidate("rate", "p_total"), Candidate("rate", "a1_total"),
                                                Candidate("rate", "alt2_total")))
    assert r["priority"] == 2


def test_all_empty_keeps_primary(spark):
    r = _run(spark, _rows("other"), _reg(Candidate("rate", "p_total"), Candidate("rate", "a_total")))
    assert r["priority"] == 0 and r["status"] == "empty" and r["trend"] == "" and r["series_count"] == 0


def test_present_metric_can_still_be_empty(spark):
    # one sample: rate has no point, so the evaluated result is empty and fallback runs
    rows = _rows("p_total", n=1) + _rows("a_total")
    r = _run(spark, rows, _reg(Candidate("rate", "p_total"), Candidate("rate", "a_total")))
    assert r["priority"] == 1


def test_label_matcher_and_window_clamp(spark):
    rows = [("ring", {"name": "ruler"}, T0 + 60 * i, 3.0) for i in range(200)] + \
           [("ring", {"name": "ingester"}, T0 + 60 * i, 9.0) for i in range(200)]
    reg = _reg(Candidate("gauge", "ring", (("name", "ruler"),)))
    res = diagnose(spark, samples_df(spark, rows), reg, WIN, step_s=60,
                   start="2024-01-15T08:00:00Z", end="2024-01-15T15:00:00Z")
    r = res.results.collect()[0]
    assert r["max_value"] == 3.0 and r["n_points"] == 121 and r["window_start"] == "2024-01-15T10:00:00Z"


def test_inverted_range_is_empty(spark):
    reg = _reg(Candidate("gauge", "ring"))
    res = diagnose(spark, samples_df(spark, _rows("ring")), reg, WIN, step_s=60,
                   start="2024-01-15T13:00:00Z", end="2024-01-15T14:00:00Z")
    assert res.results.collect()[0]["status"] == "empty"


def test_payload_fallback_with_errors(spark):
    """Primary error stops (no fallback); an erroring alternative is skipped."""
    from chronolens.plans.payload_diagnose import diagnose_payloads
    reg = Registry([Entry("ruler", "a", "d", (Candidate("rate", "p1"), Candidate("rate", "p2"))),
                    Entry("ruler", "b", "d", (Candidate("rate", "q1"), Candidate("rate", "q2"),
                                              Candidate("rate", "q3")))], range_s=300, lookback_s=300)
    ok = ('{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"job":"x"},'
          '"values":[[1,"1"],[2,"3"]]}]}}')
    empty = '{"status":"success","data":{"resultType":"matrix","result":[]}}'
    err = '{"status":"error","errorType":"bad_data","error":"boom"}'
    responses = spark.createDataFrame([(0, err), (1, ok), (2, empty), (3, err), (4, ok)], "cand_id int, payload string")
    res = {r["name"]: r for r in diagnose_payloads(spark, responses, reg.to_df(spark)).results.collect()}
    assert res["a"]["status"] == "error" and res["a"]["priority"] == 0 and res["a"]["error"].startswith("query failed: boom")
    assert res["a"]["series_count"] is None
    assert res["b"]["priority"] == 2 and res["b"]["status"] == "ok" and res["b"]["max_value"] == 3.0


def test_result_document(spark, tmp_path):
    import json

    from chronolens.plans.catalog import diagnose_run
    from chronolens.sources import sinks
    docs = sinks.results_json(diagnose_run(spark, "/root/testdata/sf0.001").results)
    sinks.write_json(docs, str(tmp_path / "out"))
    (text,) = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    doc = json.loads(text)
    assert list(doc) == ["subsystem", "results", "window"] and doc["subsystem"] == "all" and len(doc["results"]) == 24
    for e in doc["results"]:
        assert list(e) == ["name", "query", "result", "summary"] and e["result"]["query"] == e["query"]
        assert e["result"]["status"] in ("ok", "empty") and list(e["result"]["window"]) == ["start", "end"]
