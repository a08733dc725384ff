"""Sliding merge: against brute force for any ratio of range and step, without a row explosion."""
import random
import re

import pytest
from pyspark.sql import functions as F

from chronolens.model import Grid
from chronolens.operators import rangefn
from chronolens.operators.sliding import common_width
from conftest import samples_df
from test_rangefn import _brute_increase


def _series(seed, n=300, gap=40):
    rnd = random.Random(seed)
    ts, v, out = 0, 0.0, []
    for _ in range(n):
        ts += rnd.choice([1, 2, rnd.randint(1, gap), rnd.randint(1, 20 * gap) if rnd.random() < 0.05 else 3])
        v = float(rnd.randint(0, 3)) if rnd.random() < 0.06 else v + rnd.randint(0, 9)
        out.append((ts, v))
    return out


@pytest.mark.parametrize("step,range_s", [(10, 1200), (60, 60), (60, 90), (60, 20), (7, 21), (30, 45), (50, 1000)])
def test_any_ratio(spark, step, range_s):
    series = {"a": _series(1), "b": _series(2, gap=9), "c": _series(3, n=2)}
    df = samples_df(spark, [("m", {"s": k}, t, v) for k, s in series.items() for t, v in s])
    g = Grid(100_000_000, 4_000_000_000, step * 1_000_000)
    got = {(r["series_key"], r["k"]): r["value"] for r in rangefn.increase(df, ["series_key"], g, range_s).collect()}
    vec = {(r["series_key"], r["k"]): r for r in rangefn.range_vector(df, ["series_key"], g, range_s).collect()}
    for name, samples in series.items():
        key = '{"s":"%s"}' % name
        for k in range(g.k_max + 1):
            t = 100 + k * step
            want = _brute_increase(samples, t, range_s)
            assert (want is None) == ((key, k) not in got)
            if want is not None:
                assert got[key, k] == pytest.approx(want, rel=1e-9, abs=1e-9)
            inside = [(s, v) for s, v in samples if t - range_s < s <= t]
            assert bool(inside) == ((key, k) in vec)
            if inside:
                r = vec[key, k]
                assert (r["n"], r["first_ts_us"], r["last_ts_us"]) == (len(inside), inside[0][0] * 10**6, inside[-1][0] * 10**6)
                assert r["sum_value"] == pytest.approx(sum(v for _, v in inside))


def test_two_rows_a_step_at_most(spark):
    df = samples_df(spark, [("m", {"s": "a"}, t, float(t)) for t in range(0, 6000, 5)])
    g = Grid(2_000_000_000, 5_000_000_000, 10_000_000)
    out = rangefn.increase(df, ["series_key"], g, 1200)   # 120 intervals a window
    assert out.count() == g.k_max + 1
    iv = rangefn.interval_table(df, ["series_key"], g)
    from chronolens.operators.sliding import window_merge
    merged = window_merge(iv, ["series_key"], g, g.step_us, F.lit(120))
    plan = merged._jdf.queryExecution().optimizedPlan()
    generate = plan
    while generate.nodeName() != "Generate":
        generate = generate.children().head()
    from pyspark.sql import DataFrame
    rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, generate), spark).count()
    assert rows <= 2 * (g.k_max + 1)


def test_repeated_samples_count_once(spark):
    rows = [("m", {"s": "a"}, t, v) for t, v in _series(4)]
    g = Grid(100_000_000, 2_000_000_000, 60_000_000)
    twice = samples_df(spark, rows + rows + [(m, s, t, v / 2 - 1) for m, s, t, v in rows[::3]]).orderBy(F.rand(2))
    for fn, r in ((rangefn.increase, 300), (rangefn.rate, 90), (rangefn.range_vector, 300)):
        a, b = (fn(df, ["series_key"], g, r).drop("step_ts").collect() for df in (samples_df(spark, rows), twice))
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_common_width():
    g = Grid(0, 10**9, 60_000_000)
    assert common_width(g, [300_000_000, 7_200_000_000]) == 60_000_000
    assert common_width(g, [90_000_000]) == 30_000_000
    assert common_width(g, [123_456_789]) is None and common_width(g, [0]) is None


def test_rate_needs_two_exchanges(spark):
    from chronolens.plans.catalog import QUERIES
    plan = QUERIES["increase_long_range"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange hash", plan)) == 2 and plan.count("FileScan") == 1
