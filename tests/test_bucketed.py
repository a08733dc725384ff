"""Bucketed samples tables: the same answers, without an exchange of raw samples."""
import random
import re

from pyspark.sql import functions as F

from chronolens.model import Grid
from chronolens.operators import rangefn
from chronolens.plans.catalog import QUERIES
from chronolens.sources.samples import open_bucketed, read_samples, read_series, write_bucketed, write_samples
from conftest import samples_df

KEYS = ["metric", "series_key"]


def _rows(rng, n=600):
    """Counters with resets and repeated samples; one series holds most rows; chunks end inside intervals."""
    out = []
    for i in range(n):
        s = "hot" if i % 3 else rng.choice("abc")
        out.append(("m_total", {"s": s}, rng.randrange(0, 4000) + rng.choice((0, 0.25)), rng.choice((0, 1, 5, 50)) + i % 7))
    return out + out[:40]


def _values(df):
    return sorted((r["series_key"], r["step_ts"], round(r["value"], 9)) for r in df.collect())


def test_same_answers_as_a_plain_table(spark, tmp_path):
    df = samples_df(spark, _rows(random.Random(3)))
    plain, path = f"file://{tmp_path}/plain", f"file://{tmp_path}/bucketed"
    write_samples(df, plain)
    # 70 s and 1000 s: neither divides a step of 60 s
    for chunk_s in (70, 1000):
        write_bucketed(df, "bucketed_test", path, buckets=5, chunk_s=chunk_s)
        a, b = read_samples(spark, plain), open_bucketed(spark, "bucketed_test", path)
        assert b.count() == a.count() < df.count()
        assert sorted(map(tuple, b.select(*KEYS, "ts", "value").collect())) == sorted(map(tuple, a.select(*KEYS, "ts", "value").collect()))
        grid = Grid(600_000_000, 3_900_000_000, 60_000_000)
        for fn in (lambda s: rangefn.rate(s, KEYS, grid, 300), lambda s: rangefn.increase(s, KEYS, grid, 90),
                   lambda s: rangefn.gauge_on_grid(s, KEYS, grid, 200)):
            got = _values(fn(rangefn.in_reach(b, grid, 300)))
            assert got and got == _values(fn(rangefn.in_reach(a, grid, 300)))
        assert read_series(spark, path).agg(F.sum("n_samples")).first()[0] == a.count()
    # a session that does not know the table finds its layout beside it
    again = open_bucketed(spark, "bucketed_test_again", path)
    assert again.count() == a.count() and "Bucketed: true" in again.groupBy("series_key", "ts_chunk").count()._jdf.queryExecution().executedPlan().toString()
    for name in ("bucketed_test", "bucketed_test_again"):
        spark.sql(f"DROP TABLE {name}")


def test_no_exchange_below_the_first_aggregate(spark):
    plan = QUERIES["rate_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    # the plan's text goes from the result down to the scan
    below = plan[plan.rindex("HashAggregate"):]
    assert "Exchange" not in below and "Window" in below and re.search(r"Bucketed: true", below)
    assert re.search(r"PartitionFilters: \[[^\]]*tpart", below) and "PushedFilters: [IsNotNull(ts)" in below
    other = QUERIES["rate"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in other[other.rindex("HashAggregate"):]
