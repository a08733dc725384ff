"""Summary and trend on the golden vectors (FIXTURES §3)."""
import math

import pytest
from pyspark.sql import functions as F

from chronolens.operators.summary import summarize

NAN, INF = float("nan"), float("inf")


def _points(spark, series):
    """series: list of (series_key, [values]); timestamps 1000, 1060, … per series."""
    rows = []
    for key, vals in series:
        for i, v in enumerate(vals):
            rows.append(("q", key, 1000.0 + 60 * i, None if v is None else float(v)))
    return spark.createDataFrame(rows, "grp string, series_key string, ts_s double, value double")


def _summary(spark, series):
    out = summarize(_points(spark, series), ["grp"], "ts_s", chunks=3, materialize=False).collect()
    return out[0].asDict() if out else None


CASES = [
    ([("a", [1, 2, 3, 4, 5])], 1, 5, 3, 100, "increasing"),
    ([("a", [10, 8, 6, 4, 2])], 1, 10, 6, 100, "decreasing"),
    ([("a", [5, 5, 5, 5, 5])], 1, 5, 5, 100, "stable"),
    ([("a", [1, 100, 2, 99, 3])], 1, 100, 41, 100, "spiky"),
    ([("a", [2, 4]), ("b", [6, 8])], 2, 8, 5, 100, "increasing"),
    ([("a", [0, 5, 0, 3, 0])], 1, 5, 1.6, 40, "spiky"),
    ([("a", [1, 5, 3])], 1, 5, 3, 100, "increasing"),
    ([("b", [2, 4]), ("a", [6, 8])], 2, 8, 5, 100, "decreasing"),
    ([("a", [0, 0])], 1, 0, 0, 0, "stable"),
    ([("a", [-1, 0, 1])], 1, 1, 0, 200 / 3, "increasing"),
    ([("a", [7])], 1, 7, 7, 100, "stable"),
    ([("a", [0] * 9 + [10])], 1, 10, 1, 10, "spiky"),
    ([("a", list(range(40)))], 1, 39, 19.5, 97.5, "spiky"),
]


@pytest.mark.parametrize("series,n,mx,avg,nz,trend", CASES)
def test_golden(spark, series, n, mx, avg, nz, trend):
    s = _summary(spark, series)
    assert s["series_count"] == n
    assert s["max_value"] == pytest.approx(mx)
    assert s["avg_value"] == pytest.approx(avg)
    assert s["non_zero_percentage"] == pytest.approx(nz)
    assert s["trend"] == trend


def test_max_timestamp_first_max(spark):
    s = _summary(spark, [("a", [1, 5, 3])])
    assert s["max_timestamp"] == "1970-01-01T00:17:40Z"
    s = _summary(spark, [("a", [5, 1, 5])])
    assert s["max_timestamp"] == "1970-01-01T00:16:40Z"   # first of two maxima


def test_nan_and_inf(spark):
    s = _summary(spark, [("a", [1, NAN, 3])])
    assert s["max_value"] == 3 and math.isnan(s["avg_value"]) and s["trend"] == "stable"
    assert s["non_zero_percentage"] == 100
    s = _summary(spark, [("a", [1, INF, 3])])
    assert s["max_value"] == INF and s["avg_value"] == INF and s["trend"] == "stable"
    s = _summary(spark, [("a", [NAN, NAN])])
    assert s["max_value"] == -INF and s["max_timestamp"] == "1970-01-01T00:00:00Z"


def test_series_without_points(spark):
    s = _summary(spark, [("a", [None])])
    assert s["series_count"] == 1 and s["n_points"] == 0 and s["trend"] == "" and s["max_value"] == 0


def test_two_level_matches_direct(spark):
    """The chunked pooled ordinal equals a direct computation over many series."""
    import random
    rnd = random.Random(7)
    series = [(f"s{i:03d}", [rnd.uniform(-5, 50) for _ in range(rnd.randint(1, 12))]) for i in range(60)]
    s = _summary(spark, series)
    vals = [v for _, vs in sorted(series) for v in vs]
    n = len(vals)
    sx = n * (n - 1) / 2
    sx2 = (n - 1) * n * (2 * n - 1) / 6
    sxy = sum(i * v for i, v in enumerate(vals))
    slope = (n * sxy - sx * sum(vals)) / (n * sx2 - sx * sx)
    assert s["slope"] == pytest.approx(slope, rel=1e-9)
    mean = sum(vals) / n
    cv = math.sqrt(sum((v - mean) ** 2 for v in vals) / n) / abs(mean)
    assert s["cv"] == pytest.approx(cv, rel=1e-9)


def test_summary_invariant_under_repartition(spark):
    import random
    rnd = random.Random(2)
    series = [(f"k{i:02d}", [rnd.choice([0, 1, 2.5, 7, 100]) for _ in range(rnd.randint(1, 9))]) for i in range(25)]
    pts = _points(spark, series)
    a = summarize(pts, ["grp"], "ts_s", chunks=4, materialize=False).collect()[0].asDict()
    b = summarize(pts.repartition(5).orderBy(F.rand(3)), ["grp"], "ts_s", chunks=2,
                  materialize=False).collect()[0].asDict()
    for key in a:
        if isinstance(a[key], float):
            assert a[key] == pytest.approx(b[key], rel=1e-12, abs=1e-12)
        else:
            assert a[key] == b[key]
