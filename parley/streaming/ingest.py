"""STR-1: incremental ingest of new transcript files with Structured Streaming.

``readStream`` over a directory (file glob), ``trigger(availableNow=True)`` so each run takes
what is new and stops, and a checkpoint location under the shared folder. ``foreachBatch`` writes
each batch to a folder of its own, ``epoch=<id>``, and overwrites it: a batch that is replayed
after a failure has the same id and the same files, so it replaces what it left, whatever its
rows' keys are. The sink is never read to write to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_available(spark: SparkSession, source_dir: str, glob: str, schema: T.StructType,
                     transform: Callable[[DataFrame], DataFrame], sink_path: str, checkpoint_path: str,
                     files_per_batch: int | None = None) -> DataFrame:
    """Process every file not yet seen by ``checkpoint_path``, however long that takes; return the
    whole sink (with ``epoch``, the batch a row came with). ``sink_path`` and ``checkpoint_path``
    belong together: a fresh checkpoint starts again at epoch 0."""

    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    run_available(stream.parquet(source_dir), sink_path, checkpoint_path, transform)
    out = transform(spark.createDataFrame([], schema)).schema.add("epoch", T.LongType())
    return spark.read.schema(out).parquet(sink_path) if _path_exists(spark, sink_path) else spark.createDataFrame([], out)


def run_available(stream: DataFrame, sink_path: str, checkpoint_path: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Run a stream over what is there, each batch into its own folder of the sink."""

    def batch(df: DataFrame, epoch_id: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{sink_path}/epoch={epoch_id}")

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)
