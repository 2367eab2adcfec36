"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights by term (here: the place in the vector). A block of
documents is turned into postings: for every term, the documents that hold it and their weights.
A block of queries walks the terms; each posting list is multiplied by the queries' weights for
the term and added at the documents' places into a dense array of scores. The k best of a block
come from a partition selection at the k-th score, and the blocks' winners are merged.

Queries and documents meet in a grid of blocks: every document block is sent once per query block,
so no task holds more than one block of each, whatever the sizes, and nothing is broadcast. The
number of blocks follows from the row counts. No pair is emitted but a block's k best per query.

Scores are 64-bit integers. Exact as long as a score stays within 2**63.

Defined results: vectors null, or holding null or non-finite components, take no part, nor do rows
with a null id; vectors of unequal length are compared on the places both have; an empty vector
scores 0; ties go to the smaller id; rows that share an id are candidates each, but never for a
query of that id; query rows that share id and vector are one query, those that share only the id are
a query each, with ranks of their own; fewer than k candidates: all of them; empty table: no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "query_id long, query_no int, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of each component, as long. Only rows that take part."""
    x = F.col("`embedding`").cast("array<double>")
    return (
        vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
        .where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    )


def _dense(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def accumulate(queries: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Scores (queries x documents), term by term over the documents' postings."""
    scores = np.zeros((len(queries), len(docs)), dtype=np.int64)
    for term in range(docs.shape[1]):
        column, weights = docs[:, term], queries[:, term]
        at, using = np.flatnonzero(column), np.flatnonzero(weights)
        if not len(at) or not len(using):
            continue
        if len(at) == len(docs) and len(using) == len(queries):  # the posting list holds every document
            scores += weights[:, None] * column[None, :]
        else:
            scores[np.ix_(using, at)] += weights[using][:, None] * column[at][None, :]
    return scores


def select_top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= kth)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _cell(k: int, at_once: int):
    def run(queries: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(docs):
            width = int(max(docs["v"].map(len).max(), queries["v"].map(len).max()))
            ids, matrix = docs["vec_id"].to_numpy(), _dense(docs["v"], width)
            for start in range(0, len(queries), at_once):
                part = queries.iloc[start:start + at_once]
                scores = accumulate(_dense(part["v"], width), matrix)
                for q, no, row in zip(part["vec_id"].to_numpy(), part["query_no"].to_numpy(), scores):
                    others = np.flatnonzero(ids != q)
                    best = others[select_top(row[others], ids[others], k)]
                    out.append(pd.DataFrame({"query_id": q, "query_no": no, "vec_id": ids[best], "score": row[best]}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "query_no", "vec_id", "score")})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, docs_per_block: int = 16384,
          queries_per_block: int = 2048, at_once: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. ``vectors``: vec_id, v (array<long>);
    ``is_query``: which rows are queries."""
    docs, queries = vectors, vectors.where(is_query)
    n = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    d_blocks, q_blocks = -(-max(n["n"], 1) // docs_per_block), -(-max(n["q"], 1) // queries_per_block)
    block = lambda count: F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    d = docs.select("vec_id", "v", block(d_blocks).alias("db"), every(q_blocks).alias("qb"))
    same_id = Window.partitionBy("vec_id").orderBy("v")
    numbered = queries.select("vec_id", "v").distinct().withColumn("query_no", F.row_number().over(same_id))
    q = numbered.select("vec_id", "v", "query_no", block(q_blocks).alias("qb"), every(d_blocks).alias("db"))
    cells = q.groupBy("db", "qb").cogroup(d.groupBy("db", "qb")).applyInPandas(_cell(k, at_once), SCHEMA)
    w = Window.partitionBy("query_id", "query_no").orderBy(F.col("score").desc(), "vec_id")
    return (cells.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
