"""Continuous ingest of query-API response payloads into the samples table.

The batch decoder (``sources.payloads``) applied to a Structured Streaming
file source: every new JSON-lines file is decoded row by row (no state, no
shuffle), valid points are appended to the partitioned samples table and
rejected payloads to a rejects table. Progress is tracked in a checkpoint
location under the session's shared checkpoint folder. Both tables are
partitioned by batch, and a batch replaces its own partitions, so one that
is replayed after a failure adds no row twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir
from ..sources import payloads as pl
from ..sources.samples import BATCH_COL, write_samples


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Progress location that survives a restart of the application: under
    the configured ``spark.checkpoint.dir`` root (not the per-application
    subfolder Spark creates for RDD checkpoints)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{root.rstrip('/')}/chronolens-streams/{name}"


def payload_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
            .load(input_dir).select(F.input_file_name().alias("source"), F.col("value").alias("payload")))


def decoded_samples(payloads: DataFrame) -> DataFrame:
    """Valid points in the samples schema (skipped points are dropped here;
    the batch summary keeps them to count their series)."""
    pts = pl.decode_points(payloads, id_cols=["source"])
    return (pts.where(F.col("value").isNotNull() & F.col("metric").isNotNull())
               .select("metric", "labels", "series_key",
                       F.timestamp_micros((F.col("ts_s") * F.lit(1e6)).cast("long")).alias("ts"), "value"))


def write_batch(batch: DataFrame, batch_id: int, table_path: str, rejects_path: str | None = None,
                part: str = "day") -> None:
    """Write one batch; the same batch again replaces what it wrote before."""
    write_samples(decoded_samples(batch), table_path, part=part, batch_id=batch_id)
    if rejects_path:
        (pl.rejects(batch, id_cols=["source"]).withColumn(BATCH_COL, F.lit(int(batch_id)))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(BATCH_COL).parquet(rejects_path))


def start_ingest(spark: SparkSession, input_dir: str, table_path: str, rejects_path: str | None = None,
                 name: str = "payload-ingest", available_now: bool = False,
                 part: str = "day") -> StreamingQuery:
    """Start the ingest query. ``available_now`` processes what is there and
    stops (batch-like runs and tests)."""
    stream = payload_stream(spark, input_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, table_path, rejects_path, part)

    writer = (stream.writeStream.queryName(name).foreachBatch(sink)
              .option("checkpointLocation", stream_checkpoint(spark, name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
