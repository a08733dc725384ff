"""Spark session helpers.

Everything in the library is plain DataFrame code; this module only pins the
few session settings the semantics depend on (UTC, AQE) and resolves the
shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call sites per expression: several calls into the JVM for each column operation
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # CPU-bound stages (grid explode, window) follow small shuffles; do not
    # let AQE merge them below the core count. Large shuffles still coalesce
    # to the advisory size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def get_session(master: str | None = None, app: str = "chronolens",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC on a session we did not build (time text is rendered in UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system and is used as is.
    Only when it is unset (local tests) do we pick a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="chronolens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present in practice
        return os.cpu_count() or 8


def kept(df):
    """``df``, computed once: the first action that needs it keeps its rows in memory and on
    local disks, later ones read them. Nothing runs here. Rows that a lost executor held are
    computed again from the plan. ``unpersist`` gives the space back."""
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: one job, and the result no longer depends on its lineage (lost
    executors do not force a recompute of the upstream plan)."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
