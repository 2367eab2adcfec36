"""Language-model stages as tables: SCL-8, SCL-10, SCL-19, JOIN-7, JOIN-8, UDF-1, UDF-2, UDF-3,
UDF-5, WIN-7, AGG-5.

The model is never shipped: the caller passes a function with the ``mapInPandas`` contract,
``Iterator[pd.DataFrame] -> Iterator[pd.DataFrame]``. Requests are keyed by a hash of their
messages, de-duplicated before the call (identical prompts are paid once), and responses are
joined back on that key (never by position, behaviour B12). Requests are stateless: each carries
its own messages (behaviours B6, B7).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parley.constants import (
    BASE_MODEL, BIG_ERROR, INVALID, LARGE_MODEL, NANO_USD_PER_TOKEN, NOT_USEFUL_ANSWER, NOT_YET,
)
from parley.schemas import EMBED_RESPONSES, RESPONSES

ModelFn = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def wrap(col, tags: tuple[str, str]):
    """SCL-8: ``open + text + close``."""
    return F.concat(F.lit(tags[0]), col, F.lit(tags[1]))


def request_key(system_prompt: str, content) -> F.Column:
    """Request id: SHA-256 of the system prompt and the user content."""
    return F.sha2(F.concat(F.lit(system_prompt + "\n\n"), content), 256)


def build_messages(df: DataFrame, system_prompt: str, content_col: str, history_col: str | None = None) -> DataFrame:
    """UDF-5: add ``messages`` and ``request_id``. The messages are the system prompt, the earlier
    messages of a conversation in order (``history_col``, an array of role and content, empty where
    null) and the user's content."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))
    first, last = F.array(message("system", F.lit(system_prompt))), F.array(message("user", F.col(content_col)))
    if history_col is None:
        return df.withColumn("messages", F.concat(first, last)).withColumn("request_id", request_key(system_prompt, F.col(content_col)))
    earlier = F.coalesce(F.transform(history_col, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))), F.slice(last, 1, 0))
    return df.withColumn("messages", F.concat(first, earlier, last)).withColumn("request_id", F.sha2(F.to_json("messages"), 256))


def _few_at_once(model_fn: ModelFn, schema: T.StructType, most_bytes: int = 1 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``model_fn`` on Arrow batches, of which about ``most_bytes`` at a time become objects."""
    given = to_arrow_schema(schema)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = max(1, most_bytes * b.num_rows // max(1, b.nbytes))
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                yield pd.DataFrame({name: part.column(i).to_pylist() for i, name in enumerate(b.schema.names)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in model_fn(frames(batches)):
            yield pa.RecordBatch.from_pandas(out, given, preserve_index=False)

    return run


def call_model(requests: DataFrame, model_fn: ModelFn, concurrency: int | None = None) -> DataFrame:
    """UDF-1: one call per distinct request and attempt. ``model_fn`` receives batches with
    ``request_id, messages, model, attempt`` and yields RESPONSES rows. Requests without a model or
    an attempt are first attempts on the base model. ``concurrency`` bounds the number of tasks
    calling the service at once."""
    model = F.col("model") if "model" in requests.columns else F.lit(BASE_MODEL)
    attempt = F.col("attempt") if "attempt" in requests.columns else F.lit(1)
    todo = requests.select("request_id", "messages", model.alias("model"), attempt.cast("int").alias("attempt"))
    todo = todo.dropDuplicates(["request_id", "attempt"])
    if concurrency:
        todo = todo.repartition(concurrency, "request_id")
    return todo.mapInArrow(_few_at_once(model_fn, RESPONSES), RESPONSES)


def complete(requests: DataFrame, model_fn: ModelFn, write: Callable[[DataFrame, str], DataFrame],
             existing: DataFrame | None = None, concurrency: int | None = None, retries: int = 3, wait_s: float = 0.0) -> DataFrame:
    """UDF-1, UDF-2, JOIN-8: every response to ``requests``, the ``existing`` ones included.

    Requests without a response are called once; after that, and for the existing responses, the
    routing of :func:`next_attempts` decides: too large goes on to the larger model, once; rate
    limited is called again, ``retries`` times at most in one run and ``wait_s`` seconds later; what
    has an ``ok`` or a final answer is not called again (resume). ``write(df, name)`` writes each
    round's responses before anything reads them, so a lost executor never pays for a call twice."""
    asked = requests.select("request_id", "messages").dropDuplicates(["request_id"])
    found, todo = existing, asked.withColumn("model", F.lit(BASE_MODEL)).withColumn("attempt", F.lit(1))
    if existing is not None:
        fresh = todo.join(existing.select("request_id").distinct(), "request_id", "left_anti")
        todo = fresh.unionByName(next_calls(asked, existing))
        if todo.isEmpty():
            return existing
    for n in range(2 + retries):
        batch = write(call_model(todo, model_fn, concurrency), f"responses-{n + 1}")
        found = batch if found is None else found.unionByName(batch)
        limited, big = F.col("status") == "rate_limited", (F.col("status") == "too_large") & (F.col("model") != LARGE_MODEL)
        left = batch.where(limited | big).agg(F.count(F.lit(1)), F.count_if(limited)).first()
        if not left[0]:
            break
        # only what this round was told to try again: a call without any answer stays pending
        todo = next_calls(asked.join(batch.select("request_id").distinct(), "request_id", "left_semi"), found)
        if wait_s and left[1]:
            time.sleep(wait_s)
    return found


def next_calls(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """``(request_id, messages, model, attempt)`` of the requests that are to be tried again."""
    again = next_attempts(latest_attempt(responses)).where("status = 'retry'")
    return requests.select("request_id", "messages").join(
        again.select("request_id", "model", F.col("attempt").cast("int").alias("attempt")), "request_id")


def merge_responses(requests: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN-8 / JOIN-7 / SCL-10: latest successful response per request joined back by key. One that
    was too large for the larger model too is ``BIG ERROR`` / ``failed``; any other request without
    a response is ``NOT YET`` / ``pending`` (no other row shifts)."""
    ok, big = F.col("status") == "ok", F.col("status") == "too_large"
    said = responses.groupBy("request_id").agg(
        F.max_by(F.when(ok, F.col("text")), F.when(ok, F.col("attempt"))).alias("_text"),
        F.max(F.when(ok, 1)).alias("_ok"),
        F.max(F.when(big & (F.col("model") == LARGE_MODEL), 1)).alias("_big"))
    j = requests.join(said, "request_id", "left")
    done, failed = F.col("_ok").isNotNull(), F.col("_big").isNotNull()
    return j.select(*keys, "request_id",
                    F.when(done, F.coalesce("_text", F.lit(""))).when(failed, F.lit(BIG_ERROR)).otherwise(F.lit(NOT_YET)).alias("answer"),
                    F.when(done, F.lit("done")).when(failed, F.lit("failed")).otherwise(F.lit("pending")).alias("status"))


def usage_log(responses: DataFrame, stage: str, kind: str = "chat") -> DataFrame:
    """SNK-4: one row per call: stage, model, kind, request_id, attempt, tokens_in, tokens_out."""
    return responses.select(F.lit(stage).alias("stage"), "model", F.lit(kind).alias("kind"), "request_id", "attempt",
                            F.coalesce("tokens_in", F.lit(0)).alias("tokens_in"), F.coalesce("tokens_out", F.lit(0)).alias("tokens_out"))


# ---- attempts and routing (UDF-2, WIN-7) ------------------------------------------------------

def attempts_with_model(attempts: DataFrame) -> DataFrame:
    """``(request_id, attempt, status)`` -> plus ``model``: the larger model once an earlier
    attempt of the request was too large."""
    w = Window.partitionBy("request_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    big_before = F.coalesce(F.sum((F.col("status") == "too_large").cast("int")).over(w), F.lit(0))
    return attempts.withColumn("model", F.when(big_before > 0, F.lit(LARGE_MODEL)).otherwise(F.lit(BASE_MODEL)))


def latest_attempt(attempts: DataFrame) -> DataFrame:
    """WIN-7: the last attempt per request (partial aggregation, no per-request sort)."""
    last = F.max(F.struct("attempt", "model", "status"))
    return attempts.groupBy("request_id").agg(
        last.alias("_l"), F.count_if(F.col("status") == "too_large").alias("n_too_large")
    ).select("request_id", "_l.attempt", "_l.model", "_l.status", "n_too_large")


def next_attempts(latest: DataFrame) -> DataFrame:
    """UDF-2 as data: too large once -> retry on the larger model; too large twice -> final
    ``BIG ERROR``; rate limited -> retry on the same model (the wait is the caller's); ok -> none."""
    big = F.col("status") == "too_large"
    final = big & (F.col("n_too_large") >= 2)
    retry = (big & ~final) | (F.col("status") == "rate_limited")
    model = F.when(big, F.lit(LARGE_MODEL)).otherwise(F.col("model"))
    return latest.where(final | retry).select(
        "request_id",
        F.when(final, F.col("attempt")).otherwise(F.col("attempt") + 1).alias("attempt"),
        F.when(final, F.col("model")).otherwise(model).alias("model"),
        F.when(final, F.lit(BIG_ERROR)).otherwise(F.lit("retry")).alias("status"),
    )


# ---- verdicts and cost (SCL-19, AGG-4, AGG-5) -------------------------------------------------

def classify_verdict(text_col, not_useful: str = NOT_USEFUL_ANSWER) -> F.Column:
    """SCL-19: tolerant reading of a verdict answer: ``INVALID`` anywhere as a word, the declared
    answer for nothing of use, a bare 0/1, or the words not useful / useful."""
    t = F.col(text_col) if isinstance(text_col, str) else text_col
    up = F.upper(F.trim(t))
    return (
        F.when(t.isNull(), F.lit(None))
        .when(up.rlike(f"(^|[^A-Z]){INVALID}([^A-Z]|$)"), F.lit("invalid"))
        .when(up.contains(not_useful.upper()), F.lit("not_useful"))
        .when(up == "1", F.lit("useful"))
        .when(up == "0", F.lit("not_useful"))
        .when(up.contains("NOT USEFUL"), F.lit("not_useful"))
        .when(up.contains("USEFUL"), F.lit("useful"))
        .otherwise(F.lit("unknown"))
    )


def price_table(spark) -> DataFrame:
    """Nano-dollars per token by stage kind (two rows)."""
    rows = [("embed", NANO_USD_PER_TOKEN["embed"], 0),
            ("chat", NANO_USD_PER_TOKEN["prompt"], NANO_USD_PER_TOKEN["completion"])]
    return spark.createDataFrame(rows, "kind string, nano_in long, nano_out long")


def usage_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """AGG-5: tokens and cost by stage and model with roll-up rows; output tokens priced at the
    completion price (behaviour B8 fixed). Usage of a kind without a price counts its tokens, costs
    nothing and is reported in ``n_unpriced``."""
    j = usage.join(prices, "kind", "left")
    price = lambda c: F.coalesce(c, F.lit(0))
    nano = F.col("tokens_in") * price(F.col("nano_in")) + F.col("tokens_out") * price(F.col("nano_out"))
    return j.rollup("stage", "model").agg(
        F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"),
        F.round(F.sum(nano) / F.lit(1e9), 6).alias("cost"),
        F.count_if(F.col("nano_in").isNull()).alias("n_unpriced"))


# ---- embedding stage (UDF-3) -------------------------------------------------------------------

def embed_stage(texts: DataFrame, id_col: str, text_col: str, embed_fn: ModelFn,
                write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """UDF-3: embed each distinct text once (keyed by its SHA-256), write the vectors, join them back
    by key."""
    keyed = texts.withColumn("text_key", F.sha2(F.col(text_col), 256))
    todo = keyed.select("text_key", F.col(text_col).alias("text")).dropDuplicates(["text_key"])
    vecs = write(todo.mapInArrow(_few_at_once(embed_fn, EMBED_RESPONSES), EMBED_RESPONSES), "embedded")
    return keyed.join(vecs, "text_key", "left").select(id_col, "embed", "tokens")
