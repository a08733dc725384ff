"""The ``samples`` table: read, write and shape helpers.

On disk the table is parquet partitioned by ``metric`` and ``day`` so a
metric/time selector prunes whole directories and the remaining ``ts``
predicate reaches the row-group statistics.

Beside the table lies its *series table*: one row per (metric, series, UTC day) with
the first and last sample time and the number of samples, partitioned alike and
written by every write. Names, labels and series of a window are read from it; so
is the choice of series by labels, before any sample is read.

A table holds one sample per (series, time). Of repeated ones in a write the largest
value stays (NaN is the largest). Batches keep their own partitions, so that one
written again replaces itself; ``merge_batches`` writes a table in which a later
batch's sample has replaced an earlier one's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import fdiv, utc_day
from ..model import CHUNK_COL, SAMPLES_DDL, series_key


def make_samples(df: DataFrame, metric, labels, ts_us, value) -> DataFrame:
    """Project any DataFrame to the samples schema (+ ``ts_us``).

    ``metric`` may be a literal name or a column; ``labels`` a map column.
    """
    m = F.lit(metric) if isinstance(metric, str) else metric
    return df.select(
        m.alias("metric"),
        labels.alias("labels"),
        series_key(labels).alias("series_key"),
        F.timestamp_micros(ts_us).alias("ts"),
        value.cast("double").alias("value"),
        ts_us.cast("long").alias("ts_us"))


# Characters of the UTC day's text that name a partition.
PART_LENGTHS = {"day": 10, "month": 7}


SERIES_DDL = "metric STRING, series_key STRING, day INT, first_ts TIMESTAMP, last_ts TIMESTAMP, n_samples BIGINT"
DAY_US = 86400 * 1_000_000

# Partition column of tables that streaming batches write.
BATCH_COL = "ingest_batch"


def write_samples(df: DataFrame, path: str, mode: str = "overwrite", part: str = "day",
                  files_per_part: int = 8, batch_id: int | None = None) -> None:
    """Write partitioned by ``metric`` and a time bucket (``day`` or
    ``month``). Inside a partition, series and shorter spans of time (hours of
    a day, days of a month) are spread over ``files_per_part`` files by hash, so
    neither a hot metric nor a hot series is one file or one task, and each file
    is sorted by (series, time) so row-group statistics on ``series_key`` and
    ``ts`` skip data too.

    The series table is brought up to date from the files on disk: those of
    the batch, or the whole table's.

    With ``batch_id`` the rows go to partitions of their own batch, whose
    earlier content they replace: writing a batch again adds nothing."""
    n = PART_LENGTHS[part]
    out = (df.select("metric", "labels", "series_key", "ts", "value")
             .withColumn("tpart", F.left(utc_day("ts"), F.lit(n))).withColumn("_spread", _spread(files_per_part))
             .repartition("metric", "tpart", "_spread"))
    _write(_once(out, [F.col("value").desc()]).drop("_spread"), path, mode, batch_id)
    _write_series(df.sparkSession, path, files_per_part, batch_id)


def _spread(files: int) -> Column:
    """The file of a sample in its partition: by series, and by day in a month or hour in a day."""
    unit = F.when(F.length("tpart") == PART_LENGTHS["month"], F.lit(DAY_US)).otherwise(F.lit(DAY_US // 24))
    return F.pmod(F.xxhash64("series_key", fdiv(F.unix_micros("ts"), unit)), F.lit(int(files)))


def _once(df: DataFrame, order: list, by: tuple[str, ...] = ("tpart", "_spread")) -> DataFrame:
    """The first sample, by ``order``, of each (series, time); in series and time order in each task.

    ``by`` are the columns, given by series and time, that the rows are already dealt by. The
    order of a partition of the table is that of its files, so that the write sorts nothing again."""
    w = Window.partitionBy("metric", *[c for c in by if c == "tpart"], "series_key", "ts", *[c for c in by if c != "tpart"]).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def _write(out: DataFrame, path: str, mode: str, batch_id: int | None, sort: str = "ts") -> None:
    parts = ["metric", "tpart"]
    if batch_id is not None:
        out, parts = out.withColumn(BATCH_COL, F.lit(int(batch_id))), [*parts, BATCH_COL]
    writer = out.sortWithinPartitions("metric", "tpart", "series_key", sort).write
    if batch_id is not None:
        mode, writer = "overwrite", writer.option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).partitionBy(*parts).parquet(path)


def series_path(path: str) -> str:
    return path.rstrip("/") + ".series"


def _write_series(spark: SparkSession, path: str, files_per_part: int, batch_id: int | None) -> None:
    """The series rows of what a write has left on disk: of its own batch, or of the whole table."""
    written = spark.read.schema(SAMPLES_DDL + ", tpart STRING").parquet(path)
    if batch_id is not None:
        if BATCH_COL not in written.columns:   # the batch had no sample and there is none yet
            return
        written = written.where(F.col(BATCH_COL) == int(batch_id))
    rows = (written.groupBy("metric", "tpart", "series_key", fdiv(F.unix_micros("ts"), F.lit(DAY_US)).cast("int").alias("day"))
            .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_samples"))
            .repartition("metric", "tpart", F.pmod(F.xxhash64("series_key"), F.lit(int(files_per_part)))))
    _write(rows, series_path(path), "overwrite", batch_id, sort="day")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """The series table of the samples table at ``path``, with ``labels`` out of the series key.

    A series has a row per day, and per batch that brought samples of the day."""
    df = spark.read.schema(SERIES_DDL + ", tpart STRING").parquet(series_path(path))
    return df.drop(BATCH_COL).withColumn("labels", F.from_json("series_key", "map<string,string>"))


def merge_batches(spark: SparkSession, path: str, to: str, files_per_part: int = 8) -> None:
    """Write the samples of all batches at ``path`` as a table without batches at ``to``: of the
    samples of one (series, time) the latest batch's stays."""
    df = spark.read.schema(SAMPLES_DDL + ", tpart STRING").parquet(path)
    out = df.withColumn("_spread", _spread(files_per_part)).repartition("metric", "tpart", "_spread")
    latest = [F.col(BATCH_COL).desc()] if BATCH_COL in df.columns else []
    kept = _once(out, [*latest, F.col("value").desc()]).select("metric", "labels", "series_key", "ts", "value", "tpart")
    _write(kept, to, "overwrite", None)
    _write_series(spark, to, files_per_part, None)


def read_samples(spark: SparkSession, path: str, part: str = "day") -> DataFrame:
    """Read a samples table; adds ``ts_us`` and keeps the ``tpart`` partition
    column so time predicates can prune directories (``in_reach`` adds one)."""
    df = spark.read.schema(SAMPLES_DDL + ", tpart STRING").parquet(path)
    return df.drop(BATCH_COL).withColumn("ts_us", F.unix_micros("ts"))


LAYOUT_DDL = "buckets INT, chunk_s BIGINT"


def layout_path(path: str) -> str:
    return path.rstrip("/") + ".layout"


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, chunk_s: int = 86400, part: str = "month") -> None:
    """Write ``df`` at ``path`` as the table ``name``: partitioned like any samples table, and
    bucketed by series and chunks of ``chunk_s`` seconds. Choose ``buckets`` so that one bucket
    of the partitions that a query reads fits a task.

    The number of buckets and the chunk's width are written beside it, for ``open_bucketed``."""
    spark = df.sparkSession
    chunk = fdiv(F.unix_micros("ts"), F.lit(int(chunk_s) * 1_000_000))
    out = (df.select("metric", "labels", "series_key", "ts", "value", chunk.alias(CHUNK_COL))
             .withColumn("tpart", F.left(utc_day("ts"), F.lit(PART_LENGTHS[part])))
             .repartition(int(buckets), "series_key", CHUNK_COL))   # as the buckets are: a task has one
    (_once(out, [F.col("value").desc()], by=(CHUNK_COL,)).write.mode("overwrite").partitionBy("metric", "tpart")
     .bucketBy(int(buckets), "series_key", CHUNK_COL).sortBy("series_key", "ts").option("path", path).saveAsTable(name))
    _write_series(spark, path, 8, None)
    spark.range(1).select(F.lit(int(buckets)).alias("buckets"), F.lit(int(chunk_s)).cast("long").alias("chunk_s")) \
         .write.mode("overwrite").parquet(layout_path(path))


def open_bucketed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The bucketed samples table at ``path`` with ``ts_us``; registered as ``name`` where this session lacks it."""
    if not spark.catalog.tableExists(name):
        (layout,) = spark.read.schema(LAYOUT_DDL).parquet(layout_path(path)).collect()
        spark.sql(f"CREATE TABLE `{name}` ({SAMPLES_DDL}, {CHUNK_COL} BIGINT, tpart STRING) USING parquet "
                  f"PARTITIONED BY (metric, tpart) CLUSTERED BY (series_key, {CHUNK_COL}) SORTED BY (series_key, ts) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
    return spark.table(name).withColumn("ts_us", F.unix_micros("ts"))


def time_part_filter(df: DataFrame, lo_us: int, hi_us: int):
    """Partition-pruning predicate matching ``lo_us <= ts <= hi_us``.

    The bounds are cut to each partition value's own length, so that day and
    month layouts (whose texts order like their times) prune alike."""
    if "tpart" not in df.columns:
        return None
    lo, hi = (utc_day(F.timestamp_micros(F.lit(us))) for us in (lo_us, hi_us))
    own = F.length("tpart")
    return (F.col("tpart") >= F.left(lo, own)) & (F.col("tpart") <= F.left(hi, own))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)
