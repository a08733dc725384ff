"""histogram_quantile golden vectors (FIXTURES §4)."""
import math

import pytest
from pyspark.sql import functions as F

from chronolens.operators.hist import with_quantile

INF = float("inf")
CASES = [
    (0.99, [(0.1, 50), (0.5, 90), (1, 100), (INF, 100)], 0.95),
    (0.99, [(0.1, 50), (0.5, 90), (INF, 100)], 0.5),
    (0.5, [(0.1, 50), (0.5, 90), (INF, 100)], 0.1),
    (0.99, [(0.1, 0), (INF, 0)], float("nan")),
    (0.99, [(0.1, 5)], float("nan")),
    (0.5, [(0.1, 10), (0.5, 8), (1, 20), (INF, 20)], 0.1),
    (-0.5, [(0.1, 10), (INF, 20)], -INF),
    (1.5, [(0.1, 10), (INF, 20)], INF),
    (0.5, [(-1.0, 10), (INF, 20)], -1.0),
    (0.5, [(0.5, 4), (0.1, 6), (0.5, 6), (INF, 20)], 0.5),   # equal bounds merge
]


@pytest.mark.parametrize("q,buckets,want", CASES)
def test_quantile(spark, q, buckets, want):
    df = spark.createDataFrame([(q, [(float(le), float(c)) for le, c in buckets])],
                               "q double, b array<struct<le:double,c:double>>")
    got = with_quantile(df, F.col("q"), "b").collect()[0]["value"]
    if math.isnan(want):
        assert math.isnan(got)
    else:
        assert got == pytest.approx(want)
