"""Stage tables leave no shuffle files behind."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from parley.llm import common
from parley.session import FREE_SHUFFLES, staged, unstaged


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for d in dirs for f in Path(d).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_write(spark):
    setting = spark.conf.get(FREE_SHUFFLES)
    grouped = spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    for stage in (staged, common.staged):
        before = shuffle_files(spark)
        out, left = stage(grouped.join(grouped.withColumnRenamed("s", "t"), "k"), "freed"), {""}
        for _ in range(50):  # the files are removed in the background
            if not (left := shuffle_files(spark) - before):
                break
            time.sleep(0.2)
        assert not left
        assert out.count() == 1000 and out.agg(F.sum("s")).first()[0] == 50_000 * 49_999 // 2
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_unstaged_tables_leave_no_files(spark):
    kept, gone = staged(spark.range(5), "kept"), staged(spark.range(5), "gone")
    folder = Path(gone.staged_at.removeprefix("file:"))
    assert folder.is_dir()
    unstaged(gone)
    assert not folder.exists() and kept.count() == 5
