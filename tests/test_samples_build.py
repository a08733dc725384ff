"""The derived samples are built with few exchanges and sorts, and hold what plain Python counts."""

import json

from pyspark.sql import functions as F

from chronolens.functions.prefix import running_sum
from chronolens.sources import samples as sm
from chronolens.sources import testviews as tv


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def events(spark, path):
    rows = [(1, "2024-01-01 00:10:00", 1, "a", 5.0), (2, "2024-01-01 00:20:00", 1, "a", 30.0), (3, "2024-01-01 00:30:00", 2, "a", None),
            (4, "2024-01-03 05:00:00", 2, "a", 700.0), (5, "2024-01-01 00:15:00", 3, None, 100.0), (6, "2024-01-02 00:15:00", 3, None, 20.0)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    df.withColumn("ts", F.expr("cast(ts as timestamp_ntz)")).write.parquet(f"{path}/events.parquet")
    return rows


def test_bucket_counts_and_rows_made_after_the_exchange(spark, tmp_path):
    rows = events(spark, tmp_path)
    df = tv.event_value_bucket(spark, str(tmp_path))
    got = sorted((json.loads(r.series_key)["le"], str(r.labels["event_type"]), r.ts_us, r.value) for r in df.collect())
    assert len(got) == len(rows) * len(tv.BUCKET_BOUNDS)
    for le in tv.BUCKET_BOUNDS:
        a = [x[3] for x in got if x[0] == le and x[1] == "a"]
        assert a == [sum(r[4] is not None and r[4] <= float(le) for r in rows[:n + 1]) for n in range(4)], le
    text = plan(df)
    assert text.index("Generate") < text.index("Window")   # above: windows and exchanges see one row an event
    assert text.count("Generate") == 1


def test_sums_share_a_window(spark):
    df = spark.createDataFrame([("x", i // 3, i, i, 10 * i) for i in range(9)] + [("y", 0, 0, 5, None)], "g string, b int, t int, v long, w long")
    out = running_sum(df, ["g"], ["t"], "b", {"v": "sv", "w": "sw"})
    got = {(r.g, r.t): (r.sv, r.sw) for r in out.collect()}
    assert all(got["x", i] == (sum(range(i + 1)), 10 * sum(range(i + 1))) for i in range(9))
    assert got["y", 0] == (5, None)


def test_the_write_sorts_its_rows_once(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("m", f"s{i % 3}", 1704067200 + 3600 * (11 * i % 40), float(i)) for i in range(60)], "metric string, s string, t long, v double")
    df = sm.make_samples(df, F.col("metric"), F.create_map(F.lit("s"), F.col("s")), F.col("t") * 1_000_000, F.col("v"))
    seen = []
    real = sm._write
    monkeypatch.setattr(sm, "_write", lambda out, path, *a, **k: (seen.append(out), real(out, path, *a, **k))[1])
    path = str(tmp_path / "t")
    sm.write_samples(df, path, files_per_part=2)
    text = plan(seen[0].sortWithinPartitions("metric", "tpart", "series_key", "ts"))
    assert text.count("Sort [") == 1
    for f in (tmp_path / "t").rglob("*.parquet"):
        here = [(r.series_key, r.ts) for r in spark.read.parquet(str(f)).collect()]
        assert here == sorted(here)
    assert spark.read.parquet(path).count() == len({(r.s, r.ts) for r in df.select(F.col("labels.s").alias("s"), "ts").collect()})
