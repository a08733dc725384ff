"""Range functions on the FIXTURES §4 vectors, and against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from chronolens.model import Grid
from chronolens.operators import rangefn
from chronolens.operators.neighbors import with_neighbors
from conftest import samples_df

VECTORS = [
    ([(15, 100), (75, 110), (135, 120), (195, 130), (255, 140)], 50, 0.1666667),
    ([(15, 100), (75, 110), (135, 5), (195, 15), (255, 20)], 37.5, 0.125),
    ([(15, 0), (75, 10), (135, 20), (195, 30), (255, 40)], 47.5, 0.1583333),
    ([(15, 7)], None, None),
    ([(0, 50), (60, 60), (120, 70), (180, 80), (240, 90), (300, 100)], 50, 0.1666667),
    ([(15, 100), (75, 110)], 17.5, 0.0583333),
]


@pytest.mark.parametrize("pts,inc,rate", VECTORS)
def test_vectors(spark, pts, inc, rate):
    df = samples_df(spark, [("c", {"a": "1"}, ts, v) for ts, v in pts])
    g = Grid(300_000_000, 300_000_000, 60_000_000)
    got_i = rangefn.increase(df, ["series_key"], g, 300).collect()
    got_r = rangefn.rate(df, ["series_key"], g, 300).collect()
    if inc is None:
        assert got_i == [] and got_r == []
    else:
        assert got_i[0]["value"] == pytest.approx(inc, rel=1e-6)
        assert got_r[0]["value"] == pytest.approx(rate, rel=1e-5)


def _brute_increase(samples, t, r):
    win = [(ts, v) for ts, v in samples if t - r < ts <= t]
    if len(win) < 2:
        return None
    raw = win[-1][1] - win[0][1]
    for (_, a), (_, b) in zip(win, win[1:]):
        if b < a:
            raw += a
    si = win[-1][0] - win[0][0]
    avg = si / (len(win) - 1)
    d0, d1 = win[0][0] - (t - r), t - win[-1][0]
    if d0 >= avg * 1.1:
        d0 = avg / 2
    if raw > 0 and win[0][1] >= 0:
        d0 = min(d0, si * (win[0][1] / raw))
    if d1 >= avg * 1.1:
        d1 = avg / 2
    return raw * (si + d0 + d1) / si


def test_increase_brute_force(spark):
    rnd = random.Random(3)
    samples, v = [], 0.0
    ts = 0
    for _ in range(300):
        ts += rnd.randint(1, 40)
        v = 0.0 if rnd.random() < 0.03 else v + rnd.randint(0, 9)
        samples.append((ts, v))
    df = samples_df(spark, [("c", {}, t, x) for t, x in samples])
    g = Grid(50_000_000, 6_000_000_000, 37_000_000)
    # small time buckets force many carry rows across bucket edges
    got = {r["k"]: r["value"] for r in rangefn.increase(df, ["series_key"], g, 123, bucket_s=97).collect()}
    for k in range(g.k_max + 1):
        t = (g.start_us + k * g.step_us) / 1e6
        want = _brute_increase(samples, t, 123)
        if want is None:
            assert k not in got
        else:
            assert got[k] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_neighbors_match_plain_lag(spark):
    rnd = random.Random(11)
    rows = []
    for s in range(4):
        ts = 0
        for _ in range(200):
            ts += rnd.randint(1, 500)
            rows.append(("m", {"s": str(s)}, ts, rnd.random()))
    df = samples_df(spark, rows)
    got = with_neighbors(df, ["series_key"], prev=True, next_=True, bucket_s=300)
    from pyspark.sql import Window
    w = Window.partitionBy("series_key").orderBy("ts_us")
    want = df.select("series_key", "ts_us", F.lag("ts_us").over(w).alias("prev_ts_us"),
                     F.lag("value").over(w).alias("prev_value"), F.lead("ts_us").over(w).alias("next_ts_us"))
    cols = ["series_key", "ts_us", "prev_ts_us", "prev_value", "next_ts_us"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_gauge_brute_force(spark):
    rnd = random.Random(5)
    ts, samples = 0, []
    for _ in range(150):
        ts += rnd.randint(1, 200)
        samples.append((ts, rnd.random()))
    df = samples_df(spark, [("g", {}, t, x) for t, x in samples])
    g = Grid(100_000_000, 15_000_000_000, 53_000_000)
    got = {r["k"]: r["value"] for r in rangefn.gauge_on_grid(df, ["series_key"], g, 120, bucket_s=250).collect()}
    for k in range(g.k_max + 1):
        t = (g.start_us + k * g.step_us) / 1e6
        cand = [(s, v) for s, v in samples if t - 120 < s <= t]
        if not cand:
            assert k not in got
        else:
            assert got[k] == cand[-1][1]


def test_repartition_does_not_change_rate(spark):
    rows = [("c", {"x": str(i % 3)}, 10 * j + i, float(j + i)) for i in range(3) for j in range(200)]
    df = samples_df(spark, rows)
    g = Grid(100_000_000, 1_900_000_000, 60_000_000)
    a = rangefn.rate(df, ["series_key"], g, 300).select("series_key", "k", "value")
    b = rangefn.rate(df.repartition(7).orderBy(F.rand(1)), ["series_key"], g, 300).select("series_key", "k", "value")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_inverted_grid_has_no_steps(spark):
    g = Grid(10, 5, 1)
    assert g.empty and g.k_max == -1
    df = spark.range(1).select(rangefn.request_steps(F.lit(10), F.lit(5), 1).alias("s"))
    assert df.collect()[0]["s"] == []


def test_increase_brute_force_interval_path(spark):
    """Range a multiple of the step: the per-interval pre-aggregation path."""
    rnd = random.Random(9)
    samples, v, ts = [], 0.0, 0
    for _ in range(400):
        ts += rnd.randint(1, 30)
        v = 0.0 if rnd.random() < 0.05 else v + rnd.randint(0, 9)
        samples.append((ts, v))
    df = samples_df(spark, [("c", {}, t, x) for t, x in samples])
    g = Grid(40_000_000, 6_500_000_000, 41_000_000)
    assert rangefn.intervals_apply(g, 123_000_000)
    got = {r["k"]: r["value"] for r in rangefn.increase(df, ["series_key"], g, 123, bucket_s=97).collect()}
    for k in range(g.k_max + 1):
        t = (g.start_us + k * g.step_us) / 1e6
        want = _brute_increase(samples, t, 123)
        if want is None:
            assert k not in got
        else:
            assert got[k] == pytest.approx(want, rel=1e-9, abs=1e-9)
