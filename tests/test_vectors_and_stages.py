"""k-NN, retrieval, model stages, sinks (SCL-11, JOIN-5, AGG-2, SCL-9, AGG-7, UDF-2, SNK-1, JOIN-7)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parley.functions.vector import cosine_plus_one
from parley.operators import knn
from parley.operators import model_stage as ms
from parley.operators.knn import knn_topk
from parley.plans import dataset as ds
from parley.plans import retrieval as rt
from parley.schemas import INDEX_DOC
from parley.plans.clean import clean_audit
from parley.sources.sinks import accepted_documents, rejected_documents, strict_check, write_documents


def test_cosine_plus_one(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [-1.0, 0.0]),
                                ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_plus_one("a", "b")).collect()]
    assert got[:3] == [2.0, 1.0, 0.0] and got[3] is None and got[4] is None


def _brute(q, d, k):
    qn = q / np.linalg.norm(q, axis=1, keepdims=True)
    dn = d / np.linalg.norm(d, axis=1, keepdims=True)
    s = np.round(qn @ dn.T + 1, 14)
    out = set()
    for i in range(len(q)):
        order = sorted(range(len(d)), key=lambda j: (-s[i, j], j))[:k]
        out |= {(i, j, r + 1) for r, j in enumerate(order)}
    return out


def test_knn_matches_brute_force_for_any_blocking(spark):
    rng = np.random.default_rng(3)
    q, d = rng.normal(size=(30, 8)), rng.normal(size=(70, 8))
    d[5] = d[9]  # an exact tie, broken by id
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, embed array<double>")
    rows = [(j, v.tolist()) for j, v in enumerate(d)] + [(100, [0.0] * 8), (101, None)]
    ddf = spark.createDataFrame(rows, "id long, embed array<double>")
    expect = _brute(q, d, 10)
    for qb, db, prune in ((1, 1, True), (2, 3, False), (3, 5, False), (3, 5, True)):
        hits = knn_topk(qdf, ddf, k=10, query_blocks=qb, doc_blocks=db, chunk_rows=16, prune=prune)
        got = {(r.query_id, r.doc_id, r.rank) for r in hits.collect()}
        assert got == expect


def clustered(spark, rng, n, m, dims=8, clusters=6):
    """Queries and documents around the same few directions; copies of one document; one document far off."""
    centres = rng.normal(size=(clusters, dims)) * 5
    q = centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims)) * 0.3
    d = centres[rng.integers(0, clusters, m)] + rng.normal(size=(m, dims)) * 0.3
    d[:40] = d[0]
    d[40] = -d[41]
    frame = lambda v: spark.createDataFrame([(i, i % 3, x.tolist()) for i, x in enumerate(v)], "id long, grp long, embed array<double>")
    return q, d, frame(q), frame(d)


@pytest.mark.parametrize("pivots,cell", [(2, 15), (12, 1000)])
def test_pruning_is_exact_for_any_pivots(spark, monkeypatch, pivots, cell):
    rng = np.random.default_rng(pivots)
    q, d, qdf, ddf = clustered(spark, rng, 40, 150)
    # whatever the pivots: random directions
    if cell == 15:
        monkeypatch.setattr(knn, "choose_pivots", lambda sample, n: knn._unit(pd.Series(list(rng.normal(size=(n, 8))))))
    side = lambda df, name: df.select(F.col("id").alias(name), F.col("embed").alias("v"), "grp")
    hits, met = knn.pruned_topk(side(qdf, "qid"), side(ddf, "did"), 10, False, cell, cell, 16, pivots)
    assert {(r.query_id, r.doc_id, r["rank"]) for r in hits.collect()} == _brute(q, d, 10)
    seen = met.agg(F.sum("met"), F.sum("pivots"), F.count("qid")).first()
    assert seen[2] == 40 and (cell == 15 or seen[0] < 0.5 * seen[1])
    few, _ = knn.pruned_topk(side(qdf, "qid"), side(ddf.where("id < 3"), "did"), 10, True, cell, cell, 16, pivots)
    got = {(r.query_id, r.doc_id) for r in few.collect()}
    assert got == {(i, j) for i in range(40) for j in range(3) if i % 3 != j % 3}


def test_bounds_of_angles():
    rng = np.random.default_rng(0)
    unit = lambda n: knn._unit(pd.Series(list(rng.normal(size=(n, 3)))))
    pivots, docs, q = unit(5), unit(300), unit(50)
    angle = lambda a, b: np.arccos(np.clip(a @ b.T, -1, 1))
    to_pivot, home = angle(docs, pivots), angle(docs, pivots).argmin(axis=1)
    near = np.array([to_pivot[home == p, p].min() for p in range(5)])
    far = np.array([to_pivot[home == p, p].max() for p in range(5)])
    least = knn.least_angles(angle(q, pivots), near, far)
    for p in range(5):
        assert (least[:, p] <= angle(q, docs[home == p]).min(axis=1)).all()


def test_pruned_empty_sides(spark):
    none = spark.createDataFrame([], "id long, embed array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embed array<double>")
    for a, b in ((none, one), (one, none), (none, none)):
        assert knn_topk(a, b, doc_blocks=3).count() == 0


def test_knn_plan_has_group_limit(spark):
    qdf = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embed array<double>")
    plan = knn_topk(qdf, qdf)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_knn_blocks_follow_the_counts(spark):
    assert [knn.plan_blocks(n, 100) for n in (0, 1, 100, 101, 12345)] == [1, 1, 1, 2, 124]
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 4)))], "id long, embed array<double>")
    most = spark.sparkContext.accumulator(0)
    plain = knn._block_topk

    def watched(*args):
        run = plain(*args)

        def cell(q, d):
            most.add(1 << 20 if len(q) > 60 or len(d) > 60 else 0)
            return run(q, d)

        return cell

    knn._block_topk = watched
    try:
        got = {(r.query_id, r.doc_id, r.rank) for r in knn_topk(df, df, k=3, cell_queries=30, cell_docs=30).collect()}
    finally:
        knn._block_topk = plain
    x = np.array([r.embed for r in df.orderBy("id").collect()])
    assert got == _brute(x, x, 3) and most.value == 0  # no task held more than twice a block's mean


def test_candidates_without_agent_docs(spark):
    docs = spark.createDataFrame([("customer:1", "customer", "request", 1, "x", "hello there")],
                                 "doc_id string, persona string, category string, call_id long, original string, text string")
    out = rt.candidates(rt.doc_vectors(docs)).first()
    assert out["answers"] == [] and out["max_score"] == -1.0


def test_split_and_number(spark):
    df = spark.createDataFrame([(1, "a<sep>b<sep>"), (2, "")], "call_id long, answers_joined string")
    got = [(r.call_id, r.pos, r.answer) for r in rt.split_candidates(df).collect()]
    assert got == [(1, 0, "a"), (1, 1, "b")]
    texts = ["x<sep>y", "a\\b", "<\\sep>", "<sep>", ""]
    answers = spark.createDataFrame([(7, "r", 1.0, [(i, "d", 1.0, t) for i, t in enumerate(texts)])],
                                    "call_id long, request string, max_score double, answers array<struct<rank int, doc_id string, score double, text string>>")
    assert [r.answer for r in rt.split_candidates(rt.export_candidates(answers)).orderBy("pos").collect()] == texts
    arr = spark.createDataFrame([(["x", "y"],)], "a array<string>")
    assert arr.select(ds.number_answers(F.col("a"))).first()[0] == "1) x\n2) y"


def test_retry_routing(spark):
    att = spark.createDataFrame([
        ("r1", 1, "too_large"),
        ("r2", 1, "too_large"), ("r2", 2, "too_large"),
        ("r3", 1, "rate_limited"),
        ("r4", 1, "ok"),
    ], "request_id string, attempt long, status string")
    nxt = {r.request_id: (r.attempt, r.model, r.status)
           for r in ms.next_attempts(ms.latest_attempt(ms.attempts_with_model(att))).collect()}
    assert nxt == {"r1": (2, "large", "retry"), "r2": (2, "large", "BIG ERROR"), "r3": (2, "base", "retry")}


def test_strict_sink(spark):
    df = spark.createDataFrame([(1, '{"text": "a", "embed": [1, 2]}'), (2, '{"text": "a", "extra": 1, "embed": [1, 2]}'),
                                (3, '{"text": "a", "embed": [1]}'), (4, "not json")], "id long, j string")
    got = {r.id: (r.ok, r.unknown_keys) for r in strict_check(df, "j", ["text", "embed"], vector_field="embed", dims=2).collect()}
    assert got[1] == (True, "") and got[2] == (False, "extra") and got[3][0] is False and got[4][0] is False


def test_merge_keeps_rows_aligned(spark):
    req = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "request_id string, call_id long")
    resp = spark.createDataFrame([("a", 1, "base", "ok", "A", 1, 1), ("c", 1, "base", "ok", "C", 1, 1)],
                                 "request_id string, attempt int, model string, status string, text string, "
                                 "tokens_in long, tokens_out long")
    got = {r.call_id: r.answer for r in ms.merge_responses(req, resp, ["call_id"]).collect()}
    assert got == {1: "A", 2: "NOT YET", 3: "C"}


def test_model_called_once_per_distinct_prompt(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(batches):
        for b in batches:
            calls.add(len(b))
            yield pd.DataFrame({"request_id": b["request_id"], "attempt": 1, "model": "m", "status": "ok",
                                "text": "t", "tokens_in": 1, "tokens_out": 1})

    df = spark.createDataFrame([(1, "same"), (2, "same"), (3, "other")], "call_id long, c string")
    req = ms.build_messages(df, "sys", "c")
    ms.call_model(req, model).collect()
    assert calls.value == 2


def _responder(log):
    def model(batches):
        for b in batches:
            rows = []
            for request, messages, model, attempt in zip(b["request_id"], b["messages"], b["model"], b["attempt"]):
                said = messages[-1]["content"]
                log.add([(said, model, int(attempt))])
                if said == "silent":
                    continue
                big = said == "huge" or (said == "big" and model == "base")
                rows.append((request, attempt, model, "too_large" if big else "ok", None if big else f"{said}:{model}", 3, 1))
            yield pd.DataFrame(rows, columns=["request_id", "attempt", "model", "status", "text", "tokens_in", "tokens_out"])
    return model


class _Calls(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, a, b):
        return a + b


def test_one_retry_on_the_larger_model_and_resume(spark):
    calls = spark.sparkContext.accumulator([], _Calls())
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["plain", "big", "huge", "silent", "plain"])], "call_id long, c string")
    req = ms.build_messages(df, "sys", "c")
    write = lambda d, n: ds.write_stage(spark, d, n)
    responses = ds.write_stage(spark, ms.complete(req, _responder(calls), write), "all")
    assert sorted(calls.value) == [("big", "base", 1), ("big", "large", 2), ("huge", "base", 1), ("huge", "large", 2), ("plain", "base", 1), ("silent", "base", 1)]
    merged = {r.call_id: (r.answer, r.status) for r in ms.merge_responses(req, responses, ["call_id"]).collect()}
    assert merged == {0: ("plain:base", "done"), 1: ("big:large", "done"), 2: ("BIG ERROR", "failed"), 3: ("NOT YET", "pending"), 4: ("plain:base", "done")}
    calls.value.clear()
    again = ms.complete(req, _responder(calls), write, existing=responses)
    assert again.where("status = 'ok'").count() == 2
    # what is answered, or too large for the larger model too, is not paid for again
    assert {c for c, _, _ in calls.value} == {"silent"}
    log = ms.usage_log(responses, "restate").collect()
    assert len(log) == 5 and {r.kind for r in log} == {"chat"}


def test_call_keeps_the_routing(spark):
    calls = spark.sparkContext.accumulator([], _Calls())
    req = ms.build_messages(spark.createDataFrame([("q", "large", 2)], "c string, model string, attempt long"), "sys", "c")
    got = ms.call_model(req, _responder(calls)).collect()[0]
    assert (got.model, got.attempt) == ("large", 2) and calls.value == [("q", "large", 2)]


def test_combined_answers_wait_for_their_parts(spark):
    refined = spark.createDataFrame([(1, 2, "b", "done"), (1, 1, "a", "done"), (1, 3, "NOT YET", "pending"), (2, 1, "BIG ERROR", "failed")],
                                    "call_id long, rank int, answer string, status string")
    assert [(r.call_id, r.content) for r in ds.combine_requests(refined).collect()] == [(1, "1) a\n2) b")]


def test_verdicts(spark):
    said = {"Não é útil": "not_useful", 'Saída: "não é útil".': "not_useful", "1": "useful", " 0 ": "not_useful", "INVALID.": "invalid",
            "INVALIDATED": "unknown", "Useful": "useful", "not useful": "not_useful", "x": "unknown", None: None}
    df = spark.createDataFrame([(t,) for t in said], "t string")
    assert [r[0] for r in df.select(ms.classify_verdict("t")).collect()] == list(said.values())
    assert df.select(ms.classify_verdict(F.lit("nada"), not_useful="Nada")).first()[0] == "not_useful"


def test_document_sink(spark, tmp_path):
    kinds = "text string, persona string, call_id string, embed array<float>"
    rows = [("a", "agent", "1", [1.0, 2.0]), ("b", "agent", "2", [1.0]), (None, "agent", "3", [1.0, 2.0]), ("d", "agent", "4", None), ("e", "agent", "5", [1.0, float("nan")])]
    runs = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    counts = write_documents(spark.createDataFrame(rows, kinds).mapInArrow(once, kinds), f"{tmp_path}/sink", INDEX_DOC, ["text", "persona"], 2)
    assert counts == {"accepted": 2, "rejected": 3} and runs.value == len(rows)  # the source runs once
    ok, no = accepted_documents(spark, f"{tmp_path}/sink", INDEX_DOC), rejected_documents(spark, f"{tmp_path}/sink", INDEX_DOC)
    assert ok.columns == INDEX_DOC.names and {r.call_id for r in ok.collect()} == {"1", "4"}
    assert {(r.call_id, r.problem) for r in no.collect()} == {("2", "bad_dims"), ("3", "missing_text"), ("5", "bad_number")}
    for bad in ("text string, persona string, other int", "text int, persona string"):
        with pytest.raises(ValueError):
            write_documents(spark.createDataFrame([], bad), f"{tmp_path}/x", INDEX_DOC, ["text"], 2)
    checked = spark.createDataFrame([('{"embed": [1, "x"]}',), ('{"embed": [1, 2]}',)], "j string")
    assert [r.ok for r in strict_check(checked, "j", ["embed"], vector_field="embed", dims=2).collect()] == [False, True]


def test_audit_is_one_pass(spark):
    rows = [(1, "same", "a"), (1, "x 12", "a"), (None, "345", "a"), (2, None, "b")]
    audit = clean_audit(spark.createDataFrame(rows, "id long, text string, lang string"), "id", "text", "lang", None)
    assert {tuple(r) for r in audit.collect()} == {("a", 3, 2, 1, 5), ("b", 1, 0, 0, 0)}
    assert "Join" not in audit._jdf.queryExecution().executedPlan().toString()


def test_csv_export_round_trip(spark, tmp_path):
    rows = [(1, 'say "oi", ok'), (2, "a\\b"), (3, "line\nbreak"), (4, "plain")]
    df = spark.createDataFrame(rows, "call_id long, answer string")
    ds.export_csv(df, f"{tmp_path}/out", sep=";")
    back = spark.read.schema(df.schema).csv(f"{tmp_path}/out", sep=";", header=True, multiLine=True, escape='"')
    assert sorted(map(tuple, back.collect())) == rows
    with pytest.raises(AnalysisException):
        ds.export_csv(df, f"{tmp_path}/out")


def test_messages_with_history(spark):
    kinds = "c string, h array<struct<role string, content string>>"
    df = spark.createDataFrame([("now", [("user", "a"), ("assistant", "b")]), ("now", []), ("now", None)], kinds)
    rows = ms.build_messages(df, "sys", "c", "h").collect()
    assert [[(m.role, m.content) for m in r.messages] for r in rows] == [
        [("system", "sys"), ("user", "a"), ("assistant", "b"), ("user", "now")], [("system", "sys"), ("user", "now")], [("system", "sys"), ("user", "now")]]
    assert rows[0].request_id != rows[1].request_id == rows[2].request_id


def test_neighbouring_pivots_share_blocks():
    first, parts = knn.dealt(np.full(700, 64), list(range(700)), 8192)
    assert first.max() + 1 == -(-700 // 128) and (parts == 1).all()
    first, parts = knn.dealt(np.array([10, 500, 20, 0]), [2, 1, 0, 3], 100)
    assert parts.tolist() == [1, 5, 1, 1] and first[2] == 0 and first[1] == 1 and first[0] == first[3] == 6
    assert sorted(knn.chained(np.eye(5))) == list(range(5))


def test_a_model_gets_few_requests_at_once(spark):
    def model(batches):
        for b in batches:
            yield pd.DataFrame({"request_id": b["request_id"], "attempt": 1, "model": "m", "status": "ok", "text": str(len(b)), "tokens_in": 1, "tokens_out": 1})

    df = spark.range(100).coalesce(1).select("id", F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 100_000)).alias("c"))
    got = ms.call_model(ms.build_messages(df, "sys", "c"), model, concurrency=1).collect()
    assert len(got) == 100 and max(int(r.text) for r in got) <= 11
