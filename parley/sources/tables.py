"""Driver tables and the adapters that give them the reference's roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.constants import AGENT, CUSTOMER
from parley.operators.scan import in_blocks, numbered
from parley.schemas import TABLE_SCHEMAS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table with its fixed schema (no inference)."""
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_small(df: DataFrame, key: str, most_bytes: int = 256 << 20) -> DataFrame:
    """Deal a small table out over the session's cores by ``key``. A file of one row group is read by
    one task, whatever follows; up to ``most_bytes`` (by the plan's own estimate) one small shuffle
    is cheaper than that. Larger tables have row groups enough and are left as they are."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key) if estimate <= most_bytes else df


def turns_from_conversations(conv: DataFrame) -> DataFrame:
    """``conversations`` as transcript turns: conv_id -> call_id, turn -> start_s, user ->
    customer, assistant -> agent; system turns dropped; no end times."""
    role = F.when(F.col("role") == "user", F.lit(CUSTOMER)).when(F.col("role") == "assistant", F.lit(AGENT))
    return conv.where(F.col("role").isin("user", "assistant")).select(
        F.col("conv_id").alias("call_id"),
        F.col("turn").cast("double").alias("start_s"),
        F.lit(None).cast("double").alias("end_s"),
        role.alias("role"),
        F.col("text"),
    )


def samples_from_events(events: DataFrame, most: int | None = None) -> DataFrame:
    """``events`` as per-call signal samples: user_id -> call_id, the event's rank within the
    user by ``(ts, event_id)`` -> t (0-based), value -> value, event_type kept. A user with more than
    ``most`` events is ranked in blocks."""
    rows = events.select(F.col("user_id").alias("call_id"), "value", "event_type", "event_id", "ts")
    return numbered(in_blocks(rows, "call_id", ["ts", "event_id"], most), "t").select(
        "call_id", "t", "value", "event_type", "event_id", "ts")


def vectors_from_embeddings(emb: DataFrame) -> DataFrame:
    """``embeddings`` as index documents: even label plays the agent side, odd the customer."""
    persona = F.when(F.col("label") % 2 == 0, F.lit(AGENT)).otherwise(F.lit(CUSTOMER))
    return emb.select(F.col("vec_id").alias("id"), persona.alias("persona"),
                      F.col("embedding").alias("embed"), "label")
