"""What the registered queries set for a session, and how often a row's verdict is worked out."""

import json

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parley.plans.catalog import REGISTRY


def test_batches_of_texts_are_small(spark, tmp_path):
    spark.createDataFrame([(1, "a 1", "de", "s", 3)], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(
        str(tmp_path / "documents.parquet"))
    assert [r.n_removed for r in entry.queries()["strip_digits"](spark, str(tmp_path)).collect()] == [1]
    texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 50_000).alias("text"))  # 20 MB in one partition
    sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) >= 20_000_000 and max(r.n for r in sizes) < 2 * entry.BATCH_BYTES


def test_bad_inputs_judges_a_row_once(spark, tmp_path):
    tables = {
        "documents": ([(1, "a 1"), (2, None), (3, " "), (4, "abc")], "doc_id long, text string"),
        "embeddings": ([(1, [1.0] * 64, 1), (2, [0.0] * 64, 2), (3, None, 3), (4, [1.0] * 64, 4)], "vec_id long, embedding array<float>, label int"),
        "events": ([(1, "error", json.dumps([{"text": "x"}])), (2, "signup", "[]"), (3, "view", "[]")], "event_id long, event_type string, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = REGISTRY["bad_inputs"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^0-9]") <= 2, plan  # null or blank, of one evaluation; a filter doubled it
    assert sorted((r.source, r.id, r.problem) for r in found.collect()) == [
        ("cut", 1, "bad_json"), ("cut", 2, "null_json"), ("digits", 2, "null_text"), ("digits", 3, "empty_text"), ("digits", 4, "empty_text"),
        ("documents", 2, "null_text"), ("documents", 3, "empty_text"), ("embeddings", 2, "zero_vector"), ("embeddings", 3, "null_vector"),
        ("short", 1, "bad_dims"), ("short", 2, "zero_vector"), ("short", 3, "null_vector")]


def test_answers_search_neighbours_once(spark, monkeypatch):
    # what a later round of calls reads is a table, not the search again
    from parley.plans import catalog

    seen = []
    answers = catalog._answers

    def looked(spark, reqs):
        seen.append(reqs._jdf.queryExecution().optimizedPlan().toString())
        return answers(spark, reqs)

    monkeypatch.setattr(catalog, "_answers", looked)
    assert REGISTRY["combined_answers"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 3 and not [p for p in seen[1:] if "Join" in p or "Aggregate" in p]
