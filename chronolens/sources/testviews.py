"""Metric views derived from the driver tables (events, orders, lineitem).

Each view has the ``samples`` schema and is plain DataFrame code that DuckDB
can mirror in SQL. Counters use exact arithmetic (row counts, DECIMAL sums)
so both engines produce bit-identical doubles.

=====================  ========  ===================================  =======================================
metric                 kind      labels                               value
=====================  ========  ===================================  =======================================
event_value            gauge     event_type                           ``value``
events_total           counter   event_type                           running count per (type, UTC day)
event_value_sum_total  counter   event_type, shard = user_id % 4      running ``Σ value`` by ts
event_value_bucket     counter   event_type, le                       running ``count(value <= le)`` by ts
order_price            gauge     o_orderpriority                      ``Σ o_totalprice`` per order date
shipped_quantity_total counter   l_returnflag, l_linestatus           running ``Σ`` of daily ``Σ l_quantity``
=====================  ========  ===================================  =======================================

Running sums are split by an hourly sub-bucket (``functions.prefix``), so a
hot event type is not one window task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import fdiv, ntz_micros
from ..functions.prefix import running_sum
from ..model import TimeWindow, series_key
from .samples import make_samples

# Histogram bucket bounds of the test histogram (as label text).
BUCKET_BOUNDS = ["10", "25", "50", "100", "250", "500", "+Inf"]

# Evaluation parameters on the test data.
EVENTS_WINDOW = TimeWindow.of("2024-01-05T00:00:00Z", "2024-01-25T00:00:00Z")
EVENTS_STEP_S = 6 * 3600
EVENTS_RANGE_S = 24 * 3600
EVENTS_LOOKBACK_S = 24 * 3600
ORDERS_WINDOW = TimeWindow.of("1997-01-01T00:00:00Z", "1999-01-01T00:00:00Z")
ORDERS_STEP_S = 7 * 86400
ORDERS_RANGE_S = 28 * 86400

HOUR_US = 3600 * 1_000_000
DAY_US = 86400 * 1_000_000

EVENT_METRICS = ["event_value", "events_total", "event_value_sum_total", "event_value_bucket"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "event_type", "user_id", "value", ntz_micros(F.col("ts")).alias("ts_us"))


def event_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return make_samples(e, "event_value", F.create_map(F.lit("event_type"), F.col("event_type")),
                        F.col("ts_us"), F.col("value"))


def events_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = (_events(spark, sf_dir)
         .withColumn("_day", fdiv(F.col("ts_us"), F.lit(DAY_US)))
         .withColumn("_hour", fdiv(F.col("ts_us"), F.lit(HOUR_US)))
         .withColumn("_one", F.lit(1).cast("long")))
    r = running_sum(e, ["event_type", "_day"], ["ts_us", "event_id"], "_hour", {"_one": "_count"})
    return make_samples(r, "events_total", F.create_map(F.lit("event_type"), F.col("event_type")),
                        F.col("ts_us"), F.col("_count"))


def event_value_sum_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = (_events(spark, sf_dir)
         .withColumn("shard", F.pmod(F.col("user_id"), F.lit(4)).cast("string"))
         .withColumn("_hour", fdiv(F.col("ts_us"), F.lit(HOUR_US)))
         .withColumn("_v", F.col("value").cast("decimal(18,2)")))
    r = running_sum(e, ["event_type", "shard"], ["ts_us", "event_id"], "_hour", {"_v": "_sum"})
    labels = F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("shard"), F.col("shard"))
    return make_samples(r, "event_value_sum_total", labels, F.col("ts_us"), F.col("_sum"))


def event_value_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = {f"_hit_{i}": (F.col("value") <= F.lit(b).cast("double")).cast("long") for i, b in enumerate(BUCKET_BOUNDS)}
    e = _events(spark, sf_dir).withColumns({**hits, "_hour": fdiv(F.col("ts_us"), F.lit(HOUR_US))})
    # a column for each bound: events are dealt and sorted once, and are rows for each bound after that
    r = running_sum(e, ["event_type"], ["ts_us", "event_id"], "_hour", {h: f"_cnt{h}" for h in hits})
    r = r.withColumn("_at", F.explode(F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"_cnt{h}").alias("cnt"))
                                                for h, b in zip(hits, BUCKET_BOUNDS)])))
    labels = F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("le"), F.col("_at.le"))
    return make_samples(r, "event_value_bucket", labels, F.col("ts_us"), F.col("_at.cnt"))


def order_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    daily = (o.groupBy("o_orderpriority", "o_orderdate")
              .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_p")))
    return make_samples(daily, "order_price",
                        F.create_map(F.lit("o_orderpriority"), F.col("o_orderpriority")),
                        ntz_micros(F.col("o_orderdate")), F.col("_p"))


def shipped_quantity_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    daily = (li.groupBy("l_returnflag", "l_linestatus", "l_shipdate")
               .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_q")))
    # one row per (series, day): the window is bounded by the number of days
    w = (Window.partitionBy("l_returnflag", "l_linestatus").orderBy("l_shipdate")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = daily.withColumn("_cum", F.sum("_q").over(w))
    labels = F.create_map(F.lit("l_linestatus"), F.col("l_linestatus"),
                          F.lit("l_returnflag"), F.col("l_returnflag"))
    return make_samples(run, "shipped_quantity_total", labels, ntz_micros(F.col("l_shipdate")), F.col("_cum"))


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four event-derived metrics as one samples DataFrame."""
    return (event_value(spark, sf_dir)
            .unionByName(events_total(spark, sf_dir))
            .unionByName(event_value_sum_total(spark, sf_dir))
            .unionByName(event_value_bucket(spark, sf_dir)))


def all_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (event_samples(spark, sf_dir)
            .unionByName(order_price(spark, sf_dir))
            .unionByName(shipped_quantity_total(spark, sf_dir)))


TABLE_PART = "month"


def _table_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the derived table lies, by its sources' folder; written once per application."""
    from ..session import checkpoint_dir, default_parallelism
    from .samples import path_exists, series_path, write_samples
    tag = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    path = f"{checkpoint_dir(spark)}/samples_{tag}"
    if not path_exists(spark, f"{series_path(path)}/_SUCCESS"):   # written last
        write_samples(all_samples(spark, sf_dir), path, part=TABLE_PART, files_per_part=default_parallelism(spark))
    return path


def samples_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived metrics as a stored samples table.

    Derived once per application from the driver tables and written as
    parquet partitioned by (metric, month) under the session's checkpoint
    folder (a shared folder on a cluster); later queries read it back, so
    metric and time predicates prune partitions and every query starts from
    a table scan, as it would on a real samples table.
    """
    from .samples import read_samples
    return read_samples(spark, _table_path(spark, sf_dir), part=TABLE_PART)


def series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series table of ``samples_table``."""
    from .samples import read_series
    return read_series(spark, _table_path(spark, sf_dir))


def bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' counters of ``samples_table`` as a stored table bucketed by (series, day)."""
    from ..session import default_parallelism
    from .samples import layout_path, open_bucketed, path_exists, write_bucketed
    path = _table_path(spark, sf_dir) + "_bucketed"
    name = path.rsplit("/", 1)[1]
    if not path_exists(spark, f"{layout_path(path)}/_SUCCESS"):   # written last
        write_bucketed(metric_table(spark, sf_dir, "events_total", "event_value_sum_total"), name, path,
                       buckets=default_parallelism(spark), part=TABLE_PART)
    return open_bucketed(spark, name, path)


def metric_table(spark: SparkSession, sf_dir: str, *metrics: str) -> DataFrame:
    return samples_table(spark, sf_dir).where(F.col("metric").isin(*metrics))


# A day of the events, and the derived series that stand for the registry's metrics.
# Metrics that are not listed have no series: some primaries, so that alternatives answer, and some alone.
REGISTRY_WINDOW = TimeWindow.of("2024-01-10T00:00:00Z", "2024-01-11T00:00:00Z")
REGISTRY_SERIES = {
    "event_value": ["cortex_prometheus_rule_group_rules", "cortex_ingester_memory_series", "cortex_ingester_memory_chunks",
                    "cortex_query_frontend_queue_length"],
    "events_total": ["cortex_prometheus_rule_group_iterations_missed_total", "cortex_ruler_queries_failed_total",
                     "cortex_ruler_rule_evaluations_total", "cortex_ruler_sync_rules_total",
                     "cortex_querier_queries_failed_total", "cortex_distributor_receive_grpc_request_failures_total"],
    "event_value_sum_total": ["cortex_ingester_ingested_samples_total", "cortex_query_frontend_retries_total",
                              "cortex_compactor_runs_started_total", "cortex_storegateway_series_result_series_total"],
    "event_value_bucket": ["cortex_ruler_rule_evaluation_duration_seconds_bucket",
                           "cortex_prometheus_rule_group_duration_seconds_bucket",
                           "cortex_querier_query_duration_seconds_bucket"],
}


def registry_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples under the registry's own metric names: copies of derived series, buckets with ``le``
    included, and ring members with the label ``name``."""
    s = samples_table(spark, sf_dir)
    pairs = F.create_map(*[x for m, names in REGISTRY_SERIES.items() for x in
                           (F.lit(m), F.array(*[F.lit(n) for n in names]))])
    named = (s.where(F.col("metric").isin(*REGISTRY_SERIES)).withColumn("metric", F.explode(pairs[F.col("metric")])))
    ring = s.where(F.col("metric") == "event_value")
    name = F.when(F.col("labels")["event_type"].isin("click", "view"), F.lit("ruler")).otherwise(F.lit("ingester"))
    labels = F.map_concat("labels", F.create_map(F.lit("name"), name))
    members = (ring.withColumn("metric", F.lit("cortex_ring_members")).withColumn("labels", labels)
               .withColumn("series_key", series_key(F.col("labels"))))
    return named.unionByName(members)
