"""Staged fallback: nothing runs while a query is built; unneeded alternatives are not read."""
import pytest
from pyspark.sql import functions as F

from chronolens.functions.exprs import parse_rfc3339
from chronolens.model import TimeWindow, parse_time
from chronolens.plans.diagnose import diagnose
from chronolens.plans.registry import Candidate, Entry, Registry
from chronolens.sources import sinks
from chronolens.sources.samples import read_samples, read_series, write_samples
from conftest import samples_df

T0 = 1705312800
WIN = TimeWindow.of(T0, T0 + 7200)


def _rows(metric, n=30, **labels):
    return [(metric, labels or {"job": "a"}, T0 + 60 * i, float(i)) for i in range(n)]


def _jobs(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    out = fn()
    jobs = sc.statusTracker().getJobIdsForGroup(group)
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(jobs)


def test_building_runs_no_job_and_alternatives_stay_unread(spark, tmp_path):
    path = str(tmp_path / "t")
    write_samples(samples_df(spark, _rows("p_total") + _rows("alt_total") + _rows("one_total", 1) + _rows("late_total")), path)
    reg = Registry([Entry("ruler", "x", "d", (Candidate("rate", "p_total"), Candidate("rate", "alt_total"))),
                    Entry("ruler", "y", "d", (Candidate("rate", "none_total"), Candidate("rate", "one_total"), Candidate("rate", "late_total")))],
                   range_s=300, lookback_s=300)
    s, series = read_samples(spark, path), read_series(spark, path)
    res, jobs = _jobs(spark, "build", lambda: diagnose(spark, s, reg, WIN, step_s=60, series=series, staged=True))
    assert jobs == 0
    rows = {r["name"]: r for r in res.results.collect()}
    assert rows["x"]["priority"] == 0 and rows["y"]["priority"] == 2
    evaluated = {r.cand_id for r in res.points.select("cand_id").distinct().collect()}
    assert evaluated == {0, 4}   # the alternative of x is not evaluated, that of y is
    every = diagnose(spark, s, reg, WIN, step_s=60, series=series)
    assert {r.cand_id for r in every.points.select("cand_id").distinct().collect()} == {0, 1, 4}
    for d in (res, every):
        d.unpersist()


def test_the_second_pass_is_dropped_where_no_entry_needs_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_samples(samples_df(spark, _rows("p_total") + _rows("alt_total")), path)
    reg = Registry([Entry("ruler", "x", "d", (Candidate("rate", "p_total"), Candidate("rate", "alt_total")))], 300, 300)
    s, series = read_samples(spark, path), read_series(spark, path)
    points = diagnose(spark, s, reg, WIN, step_s=60, series=series, staged=True).points
    points.collect()
    final = points._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    now = final.split("Initial Plan")[0] if "Initial Plan" in final else final
    scanned = [x for x in now.split("\n") if "FileScan" in x and ".series" not in x and "InMemory" not in x]
    assert len(scanned) <= 1   # the first pass, in the kept table


def test_own_ranges_and_matchers(spark):
    rows = _rows("m_total", 120, job="a", az="x1") + _rows("m_total", 120, job="b", az="y1")
    reg = Registry([Entry("ruler", "short", "d", (Candidate("increase", "m_total", (("az", "=~", "x."),), 120),)),
                    Entry("ruler", "long", "d", (Candidate("increase", "m_total", (("job", "!=", "a"),), 3600),)),
                    Entry("ruler", "odd", "d", (Candidate("increase", "m_total", (("az", "!~", "x."), ("none", "=", "")), 60),))], 300, 300)
    got = {r["name"]: r for r in diagnose(spark, samples_df(spark, rows), reg, WIN, step_s=60).results.collect()}
    assert got["short"]["query"] == 'increase(m_total{az=~"x."}[2m])' and got["short"]["max_value"] == pytest.approx(2.0)
    assert got["long"]["max_value"] == pytest.approx(60.0, rel=0.05) and got["long"]["series_count"] == 1
    assert got["odd"]["n_points"] == 0 and got["odd"]["status"] == "empty"   # a minute holds one sample


VALID = [("2024-01-15T10:00:00Z", 1705312800_000000), ("2024-01-15T10:00:00.25Z", 1705312800_250000),
         ("2024-01-15T10:00:00+05:30", 1705293000_000000), ("2024-01-15T10:00:00.123456789-08:00", 1705341600_123456),
         ("2024-02-29T00:00:00Z", 1709164800_000000), ("1969-12-31T23:59:59.5Z", -500000)]
REFUSED = ["2024-01-15", "2024-W03-1", "20240115T100000Z", "2024-01-15T10:00:00", " 2024-01-15T10:00:00Z", "2024-01-15T10:00:00Z ",
           "2024-01-15T24:00:00Z", "2023-02-29T00:00:00Z", "2024-01-15T10:00:60Z", "2024-01-15T10:00:00+0530", "2024-01-15T10:00:00.Z",
           "2024-01-15t10:00:00z", "2024-01-15T10:00:00+24:00", "2024-01-15T10:00:00+05:60", "x", "2024-01-15T10:00:00Z\n"]


def test_strict_time_text(spark):
    from chronolens.model import to_micros
    rows = spark.createDataFrame([(t,) for t, _ in VALID] + [(t,) for t in [*REFUSED, "", None]], "t string")
    got = {r.t: r.us for r in rows.select("t", parse_rfc3339("t").alias("us")).collect()}
    assert got == {**dict(VALID), **dict.fromkeys([*REFUSED, "", None])}
    assert all(to_micros(parse_time(t)) == us for t, us in VALID)
    for t in REFUSED:
        with pytest.raises(ValueError):
            parse_time(t)


def test_verbose_lines_and_ordered_files(spark, tmp_path):
    import json
    rows = _rows("m_total") + [("g", {"a": 'q"\\é'}, T0 + 60 * i, [float("nan"), float("inf"), 1.5][i % 3]) for i in range(6)]
    reg = Registry([Entry("ruler", "r", "d", (Candidate("rate", "m_total"),)), Entry("ruler", 'g "x"', "d", (Candidate("gauge", "g"),))], 300, 60)
    d = diagnose(spark, samples_df(spark, rows), reg, WIN, step_s=60)
    docs = {r["ordinal"]: json.loads(r["json"]) for r in sinks.verbose_json(d.results, d.points).collect()}
    assert docs[1]["name"] == 'g "x"' and docs[1]["metric"] == {"a": 'q"\\é'}
    assert [v for _, v in docs[1]["values"]] == ["NaN", "+Inf", "1.5"] * 2 and docs[1]["values"][1][0] == T0 + 60
    assert len(docs[0]["values"]) == d.points.where("cand_id = 0").count()
    lines = spark.range(5000, numPartitions=7).select((F.lit(4999) - F.col("id")).alias("line_no"), F.concat(F.lit("line "), F.lit(4999) - F.col("id")).alias("line"))
    sinks.write_lines(lines, str(tmp_path / "out"), ["line_no"])
    text = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert text == [f"line {i}" for i in range(5000)]
