"""The samples table's series table, repeated samples and batches; discovery reads no sample."""
from pyspark.sql import functions as F

from chronolens.model import TimeWindow
from chronolens.operators import discover, select
from chronolens.plans.catalog import QUERIES
from chronolens.sources.samples import merge_batches, read_samples, read_series, write_samples
from conftest import samples_df

T0 = 1705312800  # 2024-01-15T10:00:00Z
DAY = 86400
SF = "/root/testdata/sf0.001"


def _leaves(df):
    """(folder, columns read) of every file scan of a query."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    out = []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.nodeName().startswith("LogicalRelation") or "Relation" in leaf.nodeName() and hasattr(leaf, "relation"):
            out.append((leaf.relation().location().rootPaths().mkString(), [leaf.output().apply(i).name() for i in range(leaf.output().size())]))
    return out


def test_discovery_and_cap_scan_no_sample(spark):
    for name in ("list_metrics", "list_metrics_limit", "list_labels", "payload_names", "select_name_re"):
        found = _leaves(QUERIES[name](spark, SF))
        assert found and all(path.endswith(".series") for path, _ in found), (name, found)
    for name in ("series_cap", "select_label_eq", "select_label_re"):
        df = QUERIES[name](spark, SF)
        assert [path.endswith(".series") for path, _ in _leaves(df)].count(False) == 1, name
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "labels:map" not in plan, name


def test_series_rows_and_windows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", {"x": "1"}, T0 + i * 3600, 1.0) for i in range(60)] + [("b", {"y": "2"}, T0, 1.0), ("b", {"y": "2"}, T0 + 5 * DAY, 2.0)]
    write_samples(samples_df(spark, rows), path)
    s, series = read_samples(spark, path), read_series(spark, path)
    assert series.agg(F.sum("n_samples")).first()[0] == len(rows) and series.where("metric = 'b'").count() == 2
    for lo, hi in ((0, 1), (DAY, 2 * DAY), (1, 3 * DAY), (3 * DAY, 4 * DAY), (-9 * DAY, -DAY), (3600, 3 * 3600), (5 * DAY - 10, 5 * DAY)):
        w = TimeWindow.of(T0 + lo, T0 + hi)
        for fn in (discover.list_metrics, discover.list_labels):
            assert sorted(map(tuple, fn(s, w).collect())) == sorted(map(tuple, fn(s, w, series=series).collect()))
    # a window in the gap of one day
    write_samples(samples_df(spark, [("c", {}, T0, 1.0), ("c", {}, T0 + 7200, 1.0)]), str(tmp_path / "u"))
    s, series = read_samples(spark, str(tmp_path / "u")), read_series(spark, str(tmp_path / "u"))
    assert discover.list_metrics(s, TimeWindow.of(T0 + 60, T0 + 120), series=series).count() == 0


def test_selection_by_series_is_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(m, {"k": str(i % 5), "z": "q"} if i % 2 else {"k": str(i % 5)}, T0 + i, float(i)) for i in range(200) for m in ("a", "b")]
    write_samples(samples_df(spark, rows), path)
    s, series = read_samples(spark, path), read_series(spark, path)
    cols = ["metric", "series_key", "ts_us", "value"]
    for metric, matchers in (("a", {"k": "1"}), (None, [("k", "=~", "[12]"), ("z", "!=", "")]), (None, [("__name__", "!~", "a"), ("z", "=", "")])):
        one, two = select.select(s, metric, matchers), select.select_series(s, series, metric, matchers)
        assert sorted(map(tuple, one.select(*cols).collect())) == sorted(map(tuple, two.select(*cols).collect()))
    capped = [sorted(map(tuple, select.series_cap(s, 2, series=t).select(*cols).collect())) for t in (None, series)]
    assert capped[0] == capped[1] and capped[0]


def test_repeated_samples_and_batches(spark, tmp_path):
    path, merged = str(tmp_path / "t"), str(tmp_path / "m")
    write_samples(samples_df(spark, [("a", {}, T0, 1.0), ("a", {}, T0, 3.0), ("a", {}, T0, 2.0), ("a", {}, T0 + 1, float("nan")), ("a", {}, T0 + 1, 9.0)]), path)
    assert [str(r.value) for r in read_samples(spark, path).orderBy("ts").collect()] == ["3.0", "nan"]
    path = str(tmp_path / "b")
    for batch, rows in ((1, [("a", {}, T0, 1.0), ("a", {}, T0 + 60, 5.0)]), (2, [("a", {}, T0, 0.5), ("b", {}, T0 + DAY, 7.0)]), (1, [("a", {}, T0, 1.0), ("a", {}, T0 + 60, 6.0)])):
        write_samples(samples_df(spark, rows), path, batch_id=batch)
    assert read_samples(spark, path).count() == 4 and read_series(spark, path).agg(F.sum("n_samples")).first()[0] == 4
    merge_batches(spark, path, merged)
    got = [(r.metric, r.ts_us // 10**6 - T0, r.value) for r in read_samples(spark, merged).orderBy("metric", "ts").collect()]
    assert got == [("a", 0, 0.5), ("a", 60, 6.0), ("b", DAY, 7.0)]
    assert read_series(spark, merged).agg(F.sum("n_samples")).first()[0] == 3


def test_a_hot_series_is_dealt_over_the_files_of_its_partition(spark, tmp_path):
    from chronolens.sources.samples import _spread, read_samples, write_samples
    from conftest import samples_df
    df = samples_df(spark, [("m", {"s": "hot"}, 3600 * h, h) for h in range(24 * 20)] * 2)
    for part, files in (("month", 4), ("day", 3)):
        # the small files themselves may be written together
        path = f"file://{tmp_path}/{part}"
        write_samples(df, path, part=part, files_per_part=files)
        got = read_samples(spark, path)
        assert got.count() == 24 * 20
        held = [r["count"] for r in got.groupBy("tpart", _spread(files).alias("file")).count().collect()]
        per = got.select("tpart").distinct().count()
        assert len(held) == files * per and max(held) < 24 * 20 / per * 0.75
