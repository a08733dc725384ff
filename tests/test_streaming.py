"""Streaming payload ingest: files in, samples table out, rejects kept."""
from chronolens.sources.samples import read_samples
from chronolens.streaming.ingest import start_ingest

GOOD = ('{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"__name__":"up","job":"a"},'
        '"values":[[1705312800,"1"],[1705312860,"2"],[1705312920,"x"]]}]}}')
BAD = '{"status":"error","errorType":"bad_data","error":"invalid selector"}'


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    from chronolens.streaming.ingest import write_batch
    batch = spark.createDataFrame([("f", GOOD), ("f", BAD)], "source string, payload string")
    table, rej = str(tmp_path / "samples"), str(tmp_path / "rejects")
    for batch_id, n in ((0, 2), (0, 2), (1, 4), (1, 4)):
        write_batch(batch, batch_id, table, rej)
        assert read_samples(spark, table).count() == n and spark.read.parquet(rej).count() == n // 2


def test_ingest_available_now(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text(GOOD + "\n" + BAD + "\n")
    table, rej = str(tmp_path / "samples"), str(tmp_path / "rejects")
    import uuid
    q = start_ingest(spark, str(src), table, rej, name=f"ingest-test-{uuid.uuid4().hex}", available_now=True)
    q.awaitTermination(120)
    rows = read_samples(spark, table).orderBy("ts").collect()
    assert [(r["metric"], r["series_key"], r["value"]) for r in rows] == [("up", '{"job":"a"}', 1.0),
                                                                          ("up", '{"job":"a"}', 2.0)]
    assert [r["message"] for r in spark.read.parquet(rej).collect()] == ["query failed: invalid selector (bad_data)"]
