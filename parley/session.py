"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether a query's shuffle files are removed when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_CHECKPOINT_ROOT: str | None = None


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "parley") -> SparkSession:
    """Session for tests and the bench. On a cluster, pass the cluster's own session instead."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.speculation", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a local-mode
    session without one gets a fresh temporary folder; a cluster session without one is an error,
    because a machine-local folder is not visible to other executors.
    """
    global _LOCAL_CHECKPOINT_ROOT
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    ctx_dir = sc.getCheckpointDir()
    if ctx_dir:
        return ctx_dir.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_CHECKPOINT_ROOT is None:
        _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="parley-shared-", dir="/tmp")
    sc.setCheckpointDir(_LOCAL_CHECKPOINT_ROOT)
    return _LOCAL_CHECKPOINT_ROOT


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder for one stage table or stream."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back; this cuts the lineage. The shuffle files of the write go with its end:
    nothing reads them again, and otherwise they lie on disk until the driver happens to collect its garbage."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES)
    conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        conf.set(FREE_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstaged(*tables: DataFrame) -> None:
    """Remove tables of :func:`staged` that nothing will read again."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(conf).delete(path, True)
