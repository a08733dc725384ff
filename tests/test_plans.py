"""Plan checks over every registered query: no Python
evaluation anywhere, and no single-partition exchange except over the
bounded top-k of the metric list."""
import __spark_entry__ as se
from chronolens.plans.catalog import QUERIES

BOUNDED_SINGLE = {"list_metrics", "list_metrics_limit",
                  "query_run", "query_range_run", "findings_report"}   # whether a row exists: one row a partition


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_and_no_single_partition(spark):
    sf = "/root/testdata/sf0.001"
    for name, fn in QUERIES.items():  # the metrics engine's own; corpus operators may run Python
        plan = _plan(fn(spark, sf))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
        if name not in BOUNDED_SINGLE:
            assert "SinglePartition" not in plan, name


def test_discovery_opens_the_window_only(spark):
    import re
    for name in ("list_metrics", "list_labels", "select_metric", "bundle_registry", "payload_names"):
        plan = _plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert re.search(r"PartitionFilters: \[[^\]]*tpart", plan), name
    assert "labels" not in re.search(r"ReadSchema: struct<[^>]*>", _plan(QUERIES["list_labels"](
        spark, "/root/testdata/sf0.001")))[0]


def test_diagnose_selects_before_the_first_shuffle(spark):
    from chronolens.plans import catalog as cat
    from chronolens.plans.diagnose import evaluate_candidates, selected_by
    reg = cat._registry().bundle("ruler")
    samples = cat.tv.metric_table(spark, "/root/testdata/sf0.001", *cat.tv.EVENT_METRICS)
    df = evaluate_candidates(samples, reg.to_df(spark), cat.EV_GRID, metrics=reg.metrics(), range_s=reg.range_s,
                             max_reach_s=reg.range_s, selection=selected_by(reg))
    assert "CartesianProduct" not in _plan(df) and "NestedLoop" not in _plan(df)
    one = cat.test_registry().bundle("ruler")
    one.entries = [e for e in one.entries if e.candidates[0].matchers][:1]
    one.entries[0] = type(one.entries[0])(**{**one.entries[0].__dict__, "candidates": one.entries[0].candidates[:1]})
    plan = _plan(evaluate_candidates(samples, one.to_df(spark), cat.EV_GRID, metrics=one.metrics(),
                                     range_s=one.range_s, max_reach_s=one.range_s, selection=selected_by(one)))
    label = one.entries[0].candidates[0].matchers[0][0]
    scans = plan.count("FileScan parquet")
    assert scans and plan.count(f"[{label}]") >= scans


def test_samples_scan_prunes_and_pushes(spark):
    import re
    plan = _plan(se.queries()["rate"](spark, "/root/testdata/sf0.001"))
    assert re.search(r"PartitionFilters: \[[^\]]*metric#\d+ (IN \(|= )[^\]]*events_total[^\]]*tpart", plan)
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThan\(ts,2024-01-04", plan)
    assert re.search(r"ReadSchema: struct<series_key:string,ts:timestamp,value:double>", plan)
