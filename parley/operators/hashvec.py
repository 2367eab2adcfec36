"""UDF-4: text to vector without a model - hashed term counts times idf, L2-normalised.

Terms are SCL-14 terms; a term's bucket is the first 32 bits of its md5, modulo ``dims``.
``idf = ln((1 + N) / (1 + df)) + 1`` with N the number of texts and df the number of texts
using the bucket. All native: explode terms, partial aggregation per (id, bucket), a
``dims``-row document-frequency table broadcast back (bounded by ``dims``), N as a scalar
subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.constants import HASH_DIMS
from parley.functions.text import analyse_terms


def term_bucket(term, dims: int = HASH_DIMS):
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long"), F.lit(dims))


def term_weights(df: DataFrame, id_col: str, text_col: str, dims: int = HASH_DIMS) -> DataFrame:
    """Sparse ``(id, bucket, weight)``; rows only for used buckets."""
    n_docs = df.select(F.count(F.lit(1)).cast("double")).scalar()
    tf = (
        df.select(id_col, F.explode(analyse_terms(text_col)).alias("term"))
        .groupBy(id_col, term_bucket(F.col("term"), dims).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    dfreq = tf.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    w = tf.join(F.broadcast(dfreq), "bucket").select(id_col, "bucket", (F.col("tf") * idf).alias("w"))
    l2 = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "bucket", (F.col("w") / l2).alias("weight"))


def dense_vectors(weights: DataFrame, id_col: str, dims: int = HASH_DIMS, out_col: str = "embed") -> DataFrame:
    """``(id, embed array<double>)`` from sparse weights; texts without terms get no row."""
    m = F.map_from_entries(F.collect_list(F.struct(F.col("bucket").cast("int"), "weight")))
    return weights.groupBy(id_col).agg(m.alias("_m")).select(
        id_col,
        F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                    lambda i: F.coalesce(F.element_at(F.col("_m"), i), F.lit(0.0))).alias(out_col),
    )
