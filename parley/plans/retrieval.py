"""PIPE-1..3: turns -> cleaned speech -> requests and agent documents -> candidates.

JOIN-6 (late materialisation): the k-NN join carries only ids and vectors; texts are joined
back after the top-k cut. AGG-2: candidate lists with the max score (-1 and an empty list
when a request has no hit, behaviour B13).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.constants import AGENT, CANDIDATE_SEP, CUSTOMER, NA_TEXT, TAG_SPEECH, TOP_K
from parley.operators.hashvec import dense_vectors, term_weights
from parley.operators.knn import knn_topk
from parley.operators.turns import speech_by_role
from parley.plans.clean import clean_texts


def cleaned_speech(turns: DataFrame, names: DataFrame | None, spread: Callable[[DataFrame, str], DataFrame] = lambda df, key: df) -> DataFrame:
    """``(key, call_id, role, clean)``: both roles' speech cleaned in one chain (the agent side has
    digits removed twice; idempotent). call_id and role travel with the text. ``spread(df, key)`` may
    deal the speeches over the cores again: they are gathered by size, but cleaning takes time, not space."""
    sp = speech_by_role(turns).select(F.concat_ws(":", "role", F.col("call_id").cast("string")).alias("key"),
                                      "call_id", "role", "speech")
    return clean_texts(spread(sp, "key"), "key", "speech", names, out_col="clean")


def requests_from_speech(speech: DataFrame) -> DataFrame:
    """PIPE-1 data side: one request row per call with customer speech: ``(call_id, spoken)``."""
    c = speech.where(F.col("role") == CUSTOMER)
    return c.select("call_id", F.concat(F.lit(f"\n\n{TAG_SPEECH[0]}\n"), F.col("clean"), F.lit(f"\n{TAG_SPEECH[1]}")).alias("spoken"))


def build_docs(speech: DataFrame, requests: DataFrame) -> DataFrame:
    """PIPE-2, PRJ-1, SET-2: request and agent documents in one index table. ``requests`` are the
    finished restated requests ``(call_id, spoken, request)``."""
    req = requests.select(
        F.concat(F.lit(CUSTOMER + ":"), F.col("call_id").cast("string")).alias("doc_id"),
        F.lit(CUSTOMER).alias("persona"), F.lit("request").alias("category"), "call_id",
        F.col("spoken").alias("original"), F.col("request").alias("text"))
    ag = speech.where(F.col("role") == AGENT).select(
        F.concat(F.lit(AGENT + ":"), F.col("call_id").cast("string")).alias("doc_id"),
        F.lit(AGENT).alias("persona"), "call_id", F.lit(NA_TEXT).alias("original"),
        F.col("clean").alias("text"))
    return req.unionByName(ag, allowMissingColumns=True)


def doc_vectors(docs: DataFrame) -> DataFrame:
    """Vectors for every index document (UDF-4 over the whole index as one collection)."""
    w = term_weights(docs.select("doc_id", "text"), "doc_id", "text")
    return docs.join(dense_vectors(w, "doc_id"), "doc_id", "left")


def candidates(vec: DataFrame, k: int = TOP_K, exclude_same_call: bool = False, **blocks) -> DataFrame:
    """PIPE-3: ``(call_id, request, n, max_score, answers)``; answers = array of
    ``struct(rank, doc_id, score, text)`` over all agent documents. ``vec``: index documents with
    their vectors (``doc_vectors``), best written as a table, since each side reads it."""
    q = vec.where(F.col("persona") == CUSTOMER)
    d = vec.where(F.col("persona") == AGENT)   # FIL-5: persona filter before scoring
    hits = knn_topk(q.select("doc_id", "call_id", "embed"), d.select("doc_id", "call_id", "embed"), k=k,
                    q_id="doc_id", d_id="doc_id", group_col="call_id" if exclude_same_call else None, **blocks)
    texts = d.select(F.col("doc_id").alias("hit_id"), F.col("text").alias("hit_text"))
    hits = hits.join(texts, hits.doc_id == texts.hit_id).drop("hit_id")
    agg = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("doc_id"), "score", F.col("hit_text").alias("text"))))
        .alias("answers"),
        F.max("score").alias("max_score"),
    )
    base = q.select("doc_id", "call_id", F.col("text").alias("request"))
    out = base.join(agg, base.doc_id == agg.query_id, "left")
    empty = F.array().cast("array<struct<rank:int,doc_id:string,score:double,text:string>>")
    return out.select(
        "call_id", "request",
        F.coalesce(F.col("answers"), empty).alias("answers"),
        F.coalesce(F.col("max_score"), F.lit(-1.0)).alias("max_score"),
    )


def escape_separator(text):
    """A text in which the separator cannot occur: a backslash is doubled, and one goes into it."""
    inside = CANDIDATE_SEP[0] + "\\" + CANDIDATE_SEP[1:]
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CANDIDATE_SEP), F.lit(inside))


def export_candidates(cands: DataFrame) -> DataFrame:
    """Candidate texts as one string, each followed by the separator (the export format); a
    separator inside a text is escaped."""
    joined = F.array_join(F.transform("answers", lambda a: F.concat(escape_separator(a["text"]), F.lit(CANDIDATE_SEP))), "")
    return cands.select("call_id", "request", F.size("answers").cast("bigint").alias("n"),
                        F.round("max_score", 6).alias("max_score"), joined.alias("answers_joined"))


def split_candidates(exported: DataFrame) -> DataFrame:
    """SCL-9: split the export string back into ``(call_id, pos, answer)``; the trailing empty
    piece after the last separator is dropped."""
    parts = F.split(F.col("answers_joined"), CANDIDATE_SEP, -1)
    kept = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    plain = F.transform(kept, lambda x: F.regexp_replace(x, r"(?s)\\(.)", "$1"))
    return exported.select("call_id", F.posexplode(plain).alias("pos", "answer"))
