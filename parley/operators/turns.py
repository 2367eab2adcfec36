"""Transcript turns: FIL-1, AGG-1, SRT-1, SET-1, WIN-6.

``turns(call_id, start_s, end_s, role, text)``; role is ``customer`` or ``agent``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.constants import AGENT, CUSTOMER
from parley.operators.scan import BLOCK, before, in_blocks


def role_filter(turns: DataFrame, role: str) -> DataFrame:
    """FIL-1."""
    return turns.where(F.col("role") == role)


def speech_by_role(turns: DataFrame, block_seconds: float = 64.0) -> DataFrame:
    """AGG-1: ``(call_id, role, speech, n_turns)``; one string per call and role, texts joined
    by one blank in ``(start_s, end_s, text)`` order. Null and empty texts are skipped on both
    sides (behaviour B25).

    Two-level so that a very long call is not gathered by one task in one step: texts are first
    joined per ``(call, role, time block)`` (partial, map-side combinable), then the block
    strings are joined per ``(call, role)`` in block order. ``block_seconds`` bounds the rows per
    first-level group.
    """
    blk = F.floor(F.col("start_s") / F.lit(block_seconds)).cast("bigint")
    first = (
        turns.where(F.col("text").isNotNull() & (F.col("text") != ""))
        .withColumn("blk", blk)
        .groupBy("call_id", "role", "blk")
        .agg(
            F.expr("listagg(text, ' ') WITHIN GROUP (ORDER BY start_s, end_s, text)").alias("part"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return first.groupBy("call_id", "role").agg(
        F.expr("listagg(part, ' ') WITHIN GROUP (ORDER BY blk)").alias("speech"),
        F.sum("n").alias("n_turns"),
    )


def interleave(customer: DataFrame, agent: DataFrame) -> DataFrame:
    """SET-1 + SRT-1: both channels in one table, totally ordered by
    ``(call_id, start_s, role, end_s, text)`` (a range-partitioned sort: a long call is split
    across tasks rather than gathered into one)."""
    cols = ["call_id", "start_s", "end_s", "role", "text"]
    both = customer.select(*cols).unionByName(agent.select(*cols))
    return both.orderBy("call_id", "start_s", "role", "end_s", "text")


def gap_turns(rows: DataFrame, key: str, ts_col: str, tie_col: str, min_silence_s: float, min_speech_s: float = 0.0,
              pad_s: float = 0.0, most: int | None = None) -> DataFrame:
    """WIN-6: gaps and islands. Rows of one key, in order of time and ``tie_col``, start a new turn after a silence
    longer than ``min_silence_s``; turns shorter than ``min_speech_s`` are dropped; start and
    end are padded by ``pad_s``. Output ``(key, turn, start_us, end_us, n)`` in microseconds.

    A key with more than ``most`` rows is worked in blocks: a block's last time says whether the next
    block goes on with its last turn, and their numbers of turns add up."""
    b = in_blocks(rows.select(key, F.unix_micros(F.col(ts_col).cast("timestamp")).alias("_t"), F.col(tie_col).alias("_tie")),
                  key, ["_t", "_tie"], most)
    silence, w, block = int(min_silence_s * 1e6), b.window(), [BLOCK] if b.split else []
    new = F.coalesce((F.col("_t") - F.lag("_t").over(w) > silence).cast("int"), F.lit(0))
    turn = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    parts = b.rows.withColumn("_new", new).withColumn("turn", turn).groupBy(key, *block, "turn").agg(
        F.min("_t").alias("_s"), F.max("_t").alias("_e"), F.count(F.lit(1)).alias("n"))
    if b.split:
        carry = parts.groupBy(key, BLOCK).agg((F.max("turn") + 1).alias("_turns"), F.min("_s").alias("_first"), F.max("_e").alias("_last"))
        over = b.over_blocks()
        goes_on = F.coalesce((F.col("_first") - F.lag("_last").over(over) <= silence).cast("int"), F.lit(0))
        carry = carry.withColumn("_on", goes_on).select(
            key, BLOCK, (before(F.col("_turns"), over) - F.sum("_on").over(over)).alias("_before"))
        parts = b.carried(parts, carry).groupBy(key, (F.col("turn") + F.col("_before")).alias("turn")).agg(
            F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("n").alias("n"))
    pad = int(pad_s * 1e6)
    return parts.where((F.col("_e") - F.col("_s")) >= int(min_speech_s * 1e6)).select(
        key, "turn", (F.col("_s") - pad).alias("start_us"), (F.col("_e") + pad).alias("end_us"), "n")


__all__ = ["AGENT", "CUSTOMER", "role_filter", "speech_by_role", "interleave", "gap_turns"]
