"""Sinks and row checks: SNK-1 strict documents, FIL-6 input assertions, PRJ-3 key
normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.text import WS


def strict_check(df: DataFrame, json_col: str, allowed: list[str], required: list[str] | None = None,
                 vector_field: str | None = None, dims: int | None = None) -> DataFrame:
    """SNK-1: add ``unknown_keys`` (sorted, comma-joined) and ``ok``. A row is rejected when its
    JSON is invalid, has a field outside ``allowed``, misses a ``required`` field, or its vector
    field does not have ``dims`` numbers. (Spark's FAILFAST would silently drop unknown fields.)"""
    keys = F.json_object_keys(F.col(json_col))
    allowed_arr = F.array(*[F.lit(a) for a in allowed])
    unknown = F.array_sort(F.array_except(keys, allowed_arr))
    ok = keys.isNotNull() & (F.size(unknown) == 0)
    for r in required or []:
        ok = ok & F.array_contains(keys, r)
    if vector_field and dims:
        vector = F.from_json(F.get_json_object(F.col(json_col), f"$.{vector_field}"), "array<double>")
        ok = ok & (F.coalesce(F.size(vector), F.lit(-1)) == dims) & ~F.coalesce(F.exists(vector, lambda x: x.isNull()), F.lit(False))
    return df.withColumn("unknown_keys", F.array_join(unknown, ",")).withColumn("ok", F.coalesce(ok, F.lit(False)))


def document_problem(docs: DataFrame, schema: T.StructType, required: list[str], dims: int, vector: str = "embed") -> Column:
    """SNK-1 on typed rows: what keeps a document out, or null. The columns and their types must be
    the schema's (an error for the table otherwise); a required field must not be null, and a
    vector, where there is one, holds ``dims`` finite numbers."""
    given, wanted = dict(docs.dtypes), {f.name: f.dataType.simpleString() for f in schema}
    if unknown := sorted(set(given) - set(wanted)):
        raise ValueError(f"fields that the index does not have: {unknown}")
    if wrong := sorted(c for c in given if given[c] != wanted[c]):
        raise ValueError(f"fields of another type than the index's: {wrong}")
    problem = F.lit(None).cast("string")
    if vector in given:
        v = F.col(vector)
        odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        problem = F.when(v.isNotNull() & (F.size(v) != dims), F.lit("bad_dims")).when(odd, F.lit("bad_number"))
    for c in reversed(required):
        problem = F.when(F.col(c).isNull() if c in given else F.lit(True), F.lit(f"missing_{c}")).otherwise(problem)
    return problem


def write_documents(docs: DataFrame, path: str, schema: T.StructType, required: list[str], dims: int) -> dict[str, int]:
    """SNK-1: every document below ``path``, in one pass over ``docs``, by verdict: accepted (read back by
    :func:`accepted_documents`) or rejected, with the reason (:func:`rejected_documents`). Returns how many of
    each were written."""
    problem = document_problem(docs, schema, required, dims)
    columns = [(F.col(f.name) if f.name in docs.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    verdict = F.when(F.col("problem").isNull(), "accepted").otherwise("rejected").alias("verdict")
    seen = Observation()
    rows = docs.select(*columns, problem.alias("problem")).observe(
        seen, F.count_if(F.col("problem").isNull()).alias("accepted"), F.count_if(F.col("problem").isNotNull()).alias("rejected"))
    rows.select("*", verdict).write.partitionBy("verdict").parquet(path)
    return dict(seen.get)


def accepted_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The accepted documents, with every column of the schema in its order."""
    return _of_verdict(spark, path, schema, "accepted").drop("problem")


def rejected_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejected documents and ``problem``."""
    return _of_verdict(spark, path, schema, "rejected")


def _of_verdict(spark: SparkSession, path: str, schema: T.StructType, verdict: str) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField("problem", T.StringType()), T.StructField("verdict", T.StringType())])
    return spark.read.schema(stored).parquet(path).where(F.col("verdict") == verdict).drop("verdict")


def text_problem(text_col: str) -> F.Column:
    """FIL-6 for texts: null or blank."""
    t = F.col(text_col)
    return F.when(t.isNull(), F.lit("null_text")).when(t.rlike(f"^[{WS}]*$"), F.lit("empty_text"))


def vector_problem(vec_col: str, dims: int) -> F.Column:
    """FIL-6 for vectors: null, wrong length, all zeros."""
    v = F.col(vec_col)
    return (F.when(v.isNull(), F.lit("null_vector"))
            .when(F.size(v) != dims, F.lit("bad_dims"))
            .when(~F.exists(v, lambda x: x != 0), F.lit("zero_vector")))


def base_name(path_col: str) -> F.Column:
    """PRJ-3: last path element, query and fragment removed."""
    return F.element_at(F.split(F.regexp_replace(F.col(path_col), r"[?#].*$", ""), "/"), -1)


def normalise_key(name) -> F.Column:
    """PRJ-3: strip the feature-file prefix and ``.csv``, swap ``.opus`` for ``.mp3``."""
    n = F.regexp_replace(name, r"^features_", "")
    n = F.regexp_replace(n, r"\.csv$", "")
    return F.regexp_replace(n, r"\.opus$", ".mp3")
