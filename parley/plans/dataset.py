"""PIPE-1, PIPE-4..6: model requests around the candidates, and the final instruction pairs.

TOP-2 (first 3 candidates before paying for calls), AGG-7 (numbered answers), SCL-18
(seeded instruction pick), PRJ-2 (final columns), TOP-4 (seeded sample), SNK-2 (stage write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.constants import (
    INSTRUCTION_SEED, INSTRUCTIONS, PROMPT_COMBINE, PROMPT_REFINE, PROMPT_RESTATE, REFINE_K, TAG_ANSWER,
    TAG_REQUEST,
)
from parley.operators.model_stage import build_messages, wrap
from parley.session import scratch_path


def restate_requests(requests: DataFrame) -> DataFrame:
    """PIPE-1 model side: one restate request per call; the user text is the wrapped speech."""
    return build_messages(requests.withColumn("content", F.col("spoken")), PROMPT_RESTATE, "content")


def refine_requests(cands: DataFrame, k: int = REFINE_K) -> DataFrame:
    """PIPE-4: ``(request_id, call_id, rank, content, messages)`` for the first ``k`` candidates."""
    top = cands.select("call_id", "request", F.explode(F.slice("answers", 1, k)).alias("a"))
    content = F.concat(wrap(F.col("request"), TAG_REQUEST), F.lit("\n"), wrap(F.col("a.text"), TAG_ANSWER))
    return build_messages(top.select("call_id", F.col("a.rank").alias("rank"), content.alias("content")),
                          PROMPT_REFINE, "content")


def number_answers(answers) -> F.Column:
    """AGG-7: ``1) a`` newline ``2) b`` ..."""
    return F.array_join(F.transform(answers, lambda x, i: F.concat((i + 1).cast("string"), F.lit(") "), x)), "\n")


def combine_requests(refined: DataFrame) -> DataFrame:
    """PIPE-5: one combine request per call from its finished refined answers ``(call_id, rank,
    answer, status)``, in rank order. Answers that are not finished are left out, and a call
    without any waits."""
    done = refined.where("status = 'done'").groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("rank", "answer"))).alias("a"))
    return build_messages(done.select("call_id", number_answers(F.transform("a", lambda x: x["answer"])).alias("content")),
                          PROMPT_COMBINE, "content")


def pick_instruction(key_col: str, seed: str = INSTRUCTION_SEED) -> F.Column:
    """SCL-18: one of the templates by a seeded hash of the key (reproducible)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col(key_col).cast("string"))), 1, 8), 16, 10)
    idx = F.pmod(h.cast("long"), F.lit(len(INSTRUCTIONS))) + 1
    return F.element_at(F.array(*[F.lit(t) for t in INSTRUCTIONS]), idx.cast("int"))


def to_pairs(requests: DataFrame, combined: DataFrame) -> DataFrame:
    """PIPE-6 / PRJ-2: ``(call_id, instruction, request, answer)`` of the calls whose request and
    combined answer are both finished."""
    answers = combined.where("status = 'done'").select("call_id", "answer")
    return requests.join(answers, "call_id").select("call_id", pick_instruction("call_id").alias("instruction"), "request", "answer")


def sample_rows(df: DataFrame, key_col: str, n: int, seed: str = INSTRUCTION_SEED) -> DataFrame:
    """TOP-4: a reproducible sample of ``n`` rows (top-n by a seeded hash; no full sort)."""
    return df.orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key_col).cast("string"))), key_col).limit(n)


def write_stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """SNK-2: write a stage table under the shared folder and read it back with its schema.
    Cuts the lineage, so a lost executor does not re-run earlier (possibly paid) stages."""
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """SNK-2 export of the final pairs; quotes inside a field are doubled. An existing folder is an
    error, not overwritten."""
    (df.write.mode("errorifexists").option("header", header).option("sep", sep)
     .option("quote", '"').option("escape", '"').csv(path))
