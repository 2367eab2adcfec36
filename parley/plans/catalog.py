"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or data Spark derives from them) in full. Output columns
match the oracle SQL in ``parley.plans.oracles`` by name; doubles are rounded to 6 digits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.constants import AGENT, CUSTOMER, NAME_MASK
from parley.functions import text as tx
from parley.operators import turns as tn
from parley.operators.names import load_names, mask_names, names_from_items
from parley.operators.repeats import filter_repeats
from parley.plans.clean import clean_audit, clean_texts
from parley.sources.tables import read_table, spread_small, turns_from_conversations

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__.removeprefix("q_")] = fn
    return fn


def _turns(spark, d):
    return turns_from_conversations(read_table(spark, d, "conversations"))


def _names(spark, d):
    return load_names(names_from_items(read_table(spark, d, "benchmark")))


def _docs(spark, d):
    return spread_small(read_table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang"), "id")


# ---- turns -----------------------------------------------------------------------------------

@query
def q_scan_turns(spark, d):
    return _turns(spark, d).select("call_id", "start_s", "role", "text")


@query
def q_speech_by_role(spark, d):
    return tn.speech_by_role(_turns(spark, d))


@query
def q_interleave(spark, d):
    t = _turns(spark, d)
    both = tn.interleave(tn.role_filter(t, CUSTOMER), tn.role_filter(t, AGENT))
    return both.select("call_id", "start_s", "role", "text")


# ---- text cleaning ---------------------------------------------------------------------------

@query
def q_dedupe_repeats(spark, d):
    return filter_repeats(_docs(spark, d), "id", "text").withColumnRenamed("id", "doc_id")


@query
def q_repair_unicode(spark, d):
    return _docs(spark, d).select(F.col("id").alias("doc_id"), tx.repair_unicode("text").alias("text"))


@query
def q_repair_damaged(spark, d):
    """Texts whose first half was written as UTF-8 and read as Latin-1, joined to the rest by a dash that Latin-1
    does not have."""
    half = F.floor(F.length("text") / 2).cast("int")
    broken = F.decode(F.encode(F.left("text", half), "UTF-8"), "ISO-8859-1")
    text = F.concat(broken, F.lit(" — "), F.substring("text", half + 1, F.length("text")))
    return _docs(spark, d).select(F.col("id").alias("doc_id"), tx.repair_unicode(text).alias("text"))


@query
def q_normalise_punct(spark, d):
    return _docs(spark, d).select(F.col("id").alias("doc_id"), tx.normalise_punct("text").alias("text"))


@query
def q_strip_digits(spark, d):
    out = tx.strip_digits("text")
    return _docs(spark, d).select(F.col("id").alias("doc_id"), out.alias("text"),
                                  (F.length("text") - F.length(out)).cast("bigint").alias("n_removed"))


def _mask_query(spark, d, compat):
    docs = _docs(spark, d).select("id", "text")
    m = mask_names(docs, "id", "text", _names(spark, d), compat=compat, out_col="masked")
    n = tx.count_occurrences("masked", NAME_MASK) - tx.count_occurrences("text", NAME_MASK)
    return m.select(F.col("id").alias("doc_id"), F.col("masked").alias("text"), n.alias("n_masked"))


@query
def q_mask_names(spark, d):
    return _mask_query(spark, d, False)


@query
def q_mask_names_compat(spark, d):
    return _mask_query(spark, d, True)


@query
def q_clean_speech(spark, d):
    docs = _docs(spark, d)
    return clean_texts(docs, "id", "text", _names(spark, d)).select("id", "text")


@query
def q_capped_names(spark, d):
    return load_names(names_from_items(read_table(spark, d, "benchmark")), per_list=5)


@query
def q_clean_audit(spark, d):
    return clean_audit(_docs(spark, d), "id", "text", "lang", _names(spark, d))


@query
def q_analyse_text(spark, d):
    t = tx.analyse_terms("text")
    return _docs(spark, d).select(
        F.col("id").alias("doc_id"), F.size(t).cast("bigint").alias("n_terms"),
        F.size(F.array_distinct(t)).cast("bigint").alias("n_distinct"), F.get(t, 0).alias("first_term"))


# ---- vectors and retrieval ---------------------------------------------------------------------

from parley.operators.hashvec import term_weights  # noqa: E402
from parley.operators.knn import knn_topk  # noqa: E402
from parley.operators import model_stage as ms  # noqa: E402
from parley.plans import dataset as ds  # noqa: E402
from parley.plans import retrieval as rt  # noqa: E402
from parley.plans.resumable import build_pairs  # noqa: E402
from parley.plans.standins import refusing_model, stub_embedder, stub_model  # noqa: E402
from parley.plans.store import StageStore, files_version  # noqa: E402
from parley.session import scratch_path  # noqa: E402
from parley.sources.tables import vectors_from_embeddings  # noqa: E402


def _write(spark):
    return lambda df, name: ds.write_stage(spark, df, name)


def _speech(spark, d):
    """Cleaned (masked) speech as a stage table: the conversations are read once."""
    return ds.write_stage(spark, rt.cleaned_speech(_turns(spark, d), _names(spark, d), spread_small), "speech")


def _answers(spark, reqs):
    """All responses of the stand-in model, which every core of the session may call at once."""
    return ms.complete(reqs, stub_model, _write(spark), concurrency=spark.sparkContext.defaultParallelism)


def _requests_of(speech):
    return ds.restate_requests(rt.requests_from_speech(speech))


def _restated(spark, speech):
    """``(call_id, spoken, request_id, answer, status)`` after the restating stage."""
    reqs = _requests_of(speech)
    return ms.merge_responses(reqs, _answers(spark, reqs), ["call_id", "spoken"])


def _finished(restated):
    return restated.where("status = 'done'").select("call_id", "spoken", F.col("answer").alias("request"))


def _index_docs(spark, d):
    sp = _speech(spark, d)
    return rt.build_docs(sp, _finished(_restated(spark, sp)))


@query
def q_build_docs(spark, d):
    return _index_docs(spark, d).select("doc_id", "persona", "category", "call_id", "original", "text")


@query
def q_hash_vectors(spark, d):
    conv = read_table(spark, d, "conversations")
    src = conv.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
                      "text")
    w = term_weights(src, "id", "text")
    return w.select("id", F.col("bucket").cast("bigint").alias("bucket"), F.round("weight", 6).alias("weight"))


@query
def q_knn_topk(spark, d):
    v = vectors_from_embeddings(read_table(spark, d, "embeddings"))
    hits = knn_topk(v.where(F.col("persona") == CUSTOMER), v.where(F.col("persona") == AGENT),
                    k=10)
    return hits.select("query_id", "doc_id", F.col("rank").cast("bigint").alias("rank"),
                       F.round("score", 6).alias("score"))


@query
def q_knn_pruned(spark, d):
    """The same search in small blocks, so that pivots decide which of them a query has to meet."""
    v = vectors_from_embeddings(read_table(spark, d, "embeddings"))
    hits = knn_topk(v.where(F.col("persona") == CUSTOMER), v.where(F.col("persona") == AGENT), k=10, cell_docs=64, cell_queries=512)
    return hits.select("query_id", "doc_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


def _candidates(spark, d):
    docs = ds.write_stage(spark, _index_docs(spark, d), "index")
    return rt.candidates(ds.write_stage(spark, rt.doc_vectors(docs), "vectors"))


@query
def q_candidates(spark, d):
    return rt.export_candidates(_candidates(spark, d))


@query
def q_split_candidates(spark, d):
    return rt.split_candidates(rt.export_candidates(_candidates(spark, d))).select(
        "call_id", F.col("pos").cast("bigint").alias("pos"), "answer")


# ---- model stages and the dataset -------------------------------------------------------------

from parley.constants import FEATURES, INVALID, NOT_USEFUL_ANSWER  # noqa: E402
from parley.schemas import INDEX_DOC  # noqa: E402
from parley.sources import files as fs  # noqa: E402
from parley.sources import sinks as sk  # noqa: E402
from parley.sources.tables import samples_from_events  # noqa: E402


def _requests(spark, d):
    return _requests_of(_speech(spark, d))


@query
def q_build_requests(spark, d):
    return _requests(spark, d).select("request_id", "call_id", "content")


@query
def q_build_messages(spark, d):
    r = _requests(spark, d)
    return r.select("request_id", "call_id", F.posexplode("messages").alias("pos", "m")).select(
        "request_id", "call_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


@query
def q_message_history(spark, d):
    """Each call's last customer turn as the request, all turns before it as the history."""
    t = _turns(spark, d).where(F.col("text").isNotNull())
    last = t.where(F.col("role") == CUSTOMER).groupBy("call_id").agg(F.max("start_s").alias("last"))
    said = F.struct("start_s", F.when(F.col("role") == CUSTOMER, "user").otherwise("assistant").alias("role"), F.col("text").alias("content"))
    calls = t.join(last, "call_id").where(F.col("start_s") <= F.col("last")).groupBy("call_id").agg(
        F.array_sort(F.collect_list(said)).alias("all"))
    asked = calls.select("call_id", F.slice("all", 1, F.size("all") - 1).alias("earlier"), F.element_at("all", -1)["content"].alias("content"))
    m = ms.build_messages(asked, "system", "content", "earlier")
    return m.select("call_id", F.posexplode("messages").alias("pos", "m")).select(
        "call_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


@query
def q_merge_responses(spark, d):
    reqs = _requests(spark, d)
    return ms.merge_responses(reqs, _answers(spark, reqs), ["call_id"])


@query
def q_usage_log(spark, d):
    reqs = _requests(spark, d)
    log = ms.usage_log(_answers(spark, reqs), "restate")
    return log.select("stage", "model", "kind", "request_id", F.col("attempt").cast("bigint").alias("attempt"), "tokens_in", "tokens_out")


@query
def q_restated_requests(spark, d):
    return _restated(spark, _speech(spark, d)).select("call_id", "answer", "status")


def _refine_requests(spark, d):
    """The refine requests as a stage table: every round of calls reads them, and the neighbours are searched once."""
    return ds.write_stage(spark, ds.refine_requests(_candidates(spark, d)).drop("content"), "refine-requests")


def _refine(spark, reqs):
    """Refined answers ``(call_id, rank, answer, status)``."""
    return ms.merge_responses(reqs, _answers(spark, reqs), ["call_id", "rank"])


def _combine(spark, refined):
    # a stage table, so that the refined answers are joined and gathered once, not for every round
    reqs = ds.write_stage(spark, ds.combine_requests(refined), "combine-requests")
    return ms.merge_responses(reqs, _answers(spark, reqs), ["call_id"])


@query
def q_refine_requests(spark, d):
    return ds.refine_requests(_candidates(spark, d)).select(
        "request_id", "call_id", F.col("rank").cast("bigint").alias("rank"), "content")


@query
def q_refined_answers(spark, d):
    return _refine(spark, _refine_requests(spark, d)).select("call_id", F.col("rank").cast("bigint").alias("rank"), "answer", "status")


@query
def q_combined_answers(spark, d):
    return _combine(spark, _refine(spark, _refine_requests(spark, d))).select("call_id", "answer", "status")


@query
def q_number_answers(spark, d):
    return ds.combine_requests(_refine(spark, _refine_requests(spark, d))).select("call_id", F.col("content").alias("numbered"))


@query
def q_pick_instruction(spark, d):
    return rt.requests_from_speech(_speech(spark, d)).select("call_id", ds.pick_instruction("call_id").alias("instruction"))


def _pairs(spark, d):
    cands = ds.write_stage(spark, _candidates(spark, d), "candidates")
    return ds.to_pairs(cands.select("call_id", "request"), _combine(spark, _refine(spark, ds.refine_requests(cands))))


@query
def q_pairs(spark, d):
    return ds.write_stage(spark, _pairs(spark, d), "pairs")


@query
def q_resumed_run(spark, d):
    """A run that breaks off before the combine stage, and another on the same store: its models for the
    stages before refuse any request, so it comes through only if nothing is paid for twice."""
    store = lambda: StageStore(spark, root)
    root = scratch_path(spark, "store")
    versions = [files_version(spark, f"{d.rstrip('/')}/{name}.parquet") for name in ("conversations", "benchmark")]
    run = lambda model: build_pairs(store(), _turns(spark, d), _names(spark, d), versions, model, parts=2)

    def first(stage):
        if stage == "combine":
            raise InterruptedError(stage)
        return stub_model

    try:
        run(first)
    except InterruptedError:
        pass
    return run(lambda stage: stub_model if stage == "combine" else refusing_model)[0]


@query
def q_sample_pairs(spark, d):
    return ds.sample_rows(_pairs(spark, d), "call_id", 10)


def _verdict_text():
    return (F.when((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit(f"This request is {INVALID}."))
            .when(F.col("quality") == 0, F.lit(INVALID))
            .when((F.col("toxic") == 1) & (F.col("doc_id") % 2 == 0), F.lit(f" {NOT_USEFUL_ANSWER.lower()}. "))
            .when(F.col("toxic") == 1, F.lit("0"))
            .when(F.col("doc_id") % 5 == 0, F.lit("This is useful"))
            .when(F.col("doc_id") % 5 == 1, F.lit("not useful at all"))
            .when(F.col("doc_id") % 5 == 2, F.lit("perhaps")).otherwise(F.lit("1")))


@query
def q_classify_verdict(spark, d):
    lab = read_table(spark, d, "labels")
    return lab.select("doc_id", ms.classify_verdict(_verdict_text()).alias("verdict"))


@query
def q_invalid_rate(spark, d):
    lab = read_table(spark, d, "labels")
    total = lab.select(F.count(F.lit(1))).scalar()
    v = F.when(F.col("quality").eqNullSafe(F.lit(0)), F.lit(INVALID)).otherwise(F.lit("VALID"))
    return lab.groupBy(v.alias("verdict")).agg(F.count(F.lit(1)).alias("n")).select(
        "verdict", "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


@query
def q_pending_rows(spark, d):
    stage = read_table(spark, d, "documents").select("doc_id").join(
        read_table(spark, d, "labels").select("doc_id", F.col("quality").alias("result")), "doc_id", "left")
    return stage.where(F.col("result").isNull()).select("doc_id")


@query
def q_resume_anti(spark, d):
    return read_table(spark, d, "documents").select("doc_id").join(
        read_table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


def _attempts(spark, d):
    s = samples_from_events(read_table(spark, d, "events"))
    status = (F.when(F.col("event_type") == "error", F.lit("too_large"))
              .when(F.col("event_type") == "signup", F.lit("rate_limited")).otherwise(F.lit("ok")))
    return ms.attempts_with_model(s.select(F.col("call_id").alias("request_id"),
                                           (F.col("t") + 1).cast("bigint").alias("attempt"), status.alias("status")))


@query
def q_latest_attempt(spark, d):
    return ms.latest_attempt(_attempts(spark, d)).select("request_id", "attempt", "model", "status")


@query
def q_next_attempts(spark, d):
    return ms.next_attempts(ms.latest_attempt(_attempts(spark, d)))


@query
def q_usage_cost(spark, d):
    li = read_table(spark, d, "lineitem")
    q = F.floor("l_quantity").cast("bigint")
    usage = li.select(
        F.when(F.col("l_returnflag") == "A", F.lit("embed")).when(F.col("l_returnflag") == "N", F.lit("restate"))
        .otherwise(F.lit("combine")).alias("stage"),
        F.when(F.col("l_linestatus") == "O", F.lit("base")).otherwise(F.lit("large")).alias("model"),
        F.when(F.col("l_returnflag") == "A", F.lit("embed")).otherwise(F.lit("chat")).alias("kind"),
        (q * 100 + F.col("l_linenumber")).alias("tokens_in"),
        F.when(F.col("l_returnflag") == "A", F.lit(0).cast("bigint")).otherwise(q * 10).alias("tokens_out"),
    )
    return ms.usage_cost(usage, ms.price_table(spark))


@query
def q_embed_stage(spark, d):
    sp = _speech(spark, d).select(F.col("key").alias("id"), "clean")
    e = ms.embed_stage(sp, "id", "clean", stub_embedder(), _write(spark))
    total = F.aggregate("embed", F.lit(0.0), lambda a, x: a + F.round(x.cast("double") * 255))
    return e.select("id", F.size("embed").cast("bigint").alias("dims"), "tokens", total.cast("bigint").alias("bytes_sum"))


@query
def q_compare_runs(spark, d):
    lab = read_table(spark, d, "labels")
    runs = [
        lab.select("doc_id", F.when(F.col("quality") == 0, F.lit(INVALID)).otherwise(F.lit("VALID")).alias("run1")),
        lab.select("doc_id", F.when(F.col("toxic") == 1, F.lit(INVALID)).otherwise(F.lit("VALID")).alias("run2")),
        lab.select("doc_id", F.when((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit(INVALID))
                   .otherwise(F.lit("VALID")).alias("run3")),
    ]
    out = read_table(spark, d, "documents").select("doc_id")
    for r in runs:
        out = out.join(r, "doc_id", "left")
    same = F.col("run1").eqNullSafe(F.col("run2")) & F.col("run2").eqNullSafe(F.col("run3"))
    return out.withColumn("differs", ~same)


@query
def q_profile(spark, d):
    o = read_table(spark, d, "orders")
    cols = o.columns
    one = o.agg(*[F.count(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n"))
    kinds = F.create_map(*(F.lit(x) for c, kind in o.dtypes for x in (c, kind)))
    return one.unpivot("n", cols, "column", "non_null").select(
        "column", "non_null", "n", F.element_at(kinds, F.col("column")).alias("dtype"))


@query
def q_stage_counts(spark, d):
    j = read_table(spark, d, "documents").select("doc_id").join(
        read_table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    one = j.agg(F.count(F.lit(1)).alias("t1"), F.count("quality").alias("d1"),
                F.count("quality").alias("t2"), F.count_if(F.col("quality") == 1).alias("d2"))
    st = one.selectExpr("stack(2, 'verdict', t1, d1, 'valid', t2, d2) AS (stage, total, done)")
    return st.withColumn("remaining", F.col("total") - F.col("done"))


@query
def q_dedupe_inputs(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.groupBy(F.sha2("text", 256).alias("_k")).agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies")).select("doc_id", "n_copies")


@query
def q_key_normalise(spark, d):
    p = read_table(spark, d, "pages")
    b = sk.base_name("url")
    return p.select("page_id", b.alias("base_name"), sk.normalise_key(b).alias("key"))


@query
def q_strict_docs(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "props")
    return sk.strict_check(ev, "props", allowed=["k"], required=["k"]).select("event_id", "unknown_keys", "ok")


@query
def q_bad_inputs(spark, d):
    """Problems of the tables as they are, and of three columns that Spark derives from them and
    that hold bad values: digits alone of a text, vectors cut short, props cut open."""
    docs = read_table(spark, d, "documents")
    emb = read_table(spark, d, "embeddings")
    ev = read_table(spark, d, "events")
    digits = docs.select("doc_id", F.regexp_replace("text", "[^0-9]", " ").alias("digits"))
    short = emb.select("vec_id", F.when(F.col("label") % 4 == 1, F.slice("embedding", 1, 32)).when(
        F.col("label") % 4 == 2, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")).alias("short"))
    cut = ev.select("event_id", F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).when(
        F.col("event_type") != "signup", F.col("props")).alias("cut"))
    checked = [("documents", docs, "doc_id", sk.text_problem("text")), ("embeddings", emb, "vec_id", sk.vector_problem("embedding", 64)),
               ("digits", digits, "doc_id", sk.text_problem("digits")), ("short", short, "vec_id", sk.vector_problem("short", 64)),
               ("cut", cut, "event_id", fs.chunk_problem("cut"))]
    # a row's problem, or no row: a filter would work the verdict out once for itself and once for the result
    parts = [df.select(F.lit(name).alias("source"), F.col(key).alias("id"), F.explode(F.array_compact(F.array(problem))).alias("problem"))
             for name, df, key, problem in checked]
    return reduce(DataFrame.unionByName, parts)


@query
def q_document_sink(spark, d):
    """Documents with the vector of their number, some of them without and some cut short, written through the strict
    sink: what it counted on the way, and what lies there."""
    text = read_table(spark, d, "documents").select("doc_id", F.nullif(F.expr("left(text, length(text) * int(doc_id % 9 > 0))"), F.lit("")).alias("text"), "source")
    vectors = read_table(spark, d, "embeddings").select("vec_id", F.when(F.col("label") % 4 == 1, F.slice("embedding", 1, 32)).otherwise(
        F.col("embedding")).cast("array<float>").alias("embed"))
    docs = text.join(vectors, text.doc_id == vectors.vec_id, "left").select(
        "text", F.lit(AGENT).alias("persona"), F.col("source").alias("category"), F.col("doc_id").cast("string").alias("call_id"), "embed")
    path = scratch_path(spark, "documents")
    counted = sk.write_documents(docs, path, INDEX_DOC, ["text", "persona", "call_id", "embed"], 64)
    lie = sk.accepted_documents(spark, path, INDEX_DOC).select(F.lit(None).cast("string").alias("problem")).union(
        sk.rejected_documents(spark, path, INDEX_DOC).select("problem"))
    told = F.when(F.col("problem").isNull(), F.lit(counted["accepted"])).otherwise(F.lit(counted["rejected"]))
    return lie.groupBy("problem").agg(F.count(F.lit(1)).alias("n")).withColumn("counted", told.cast("long"))


@query
def q_chunks_to_turns(spark, d):
    t = _turns(spark, d).withColumn("blk", F.floor(F.col("start_s") / 32).cast("bigint"))
    lists = t.groupBy("call_id", "blk").agg(F.array_sort(F.collect_list(F.struct("start_s", "text"))).alias("c"))
    n = F.size("c")
    chunks = F.transform("c", lambda x, i: F.struct(
        F.array(x["start_s"], F.when(i == n - 1, F.lit(None)).otherwise(x["start_s"] + 1)).alias("timestamp"),
        x["text"].alias("text")))
    src = lists.select("call_id", "blk", F.to_json(chunks).alias("stt"))
    return fs.chunks_to_turns(src, "stt", ["call_id", "blk"])


@query
def q_incremental_ingest(spark, d):
    from parley.schemas import TABLE_SCHEMAS
    from parley.streaming.ingest import ingest_available

    names = _names(spark, d)

    def transform(df):
        turns = turns_from_conversations(df).select("call_id", "start_s", "role", "text")
        keyed = turns.withColumn("key", F.concat_ws(":", F.col("call_id").cast("string"), F.col("start_s").cast("string")))
        return clean_texts(keyed, "key", "text", names).select("call_id", "start_s", "role", "text")

    sink, seen = scratch_path(spark, "ingest-sink"), scratch_path(spark, "ingest-ckpt")
    step = lambda folder: ingest_available(
        spark, folder, "*.parquet", TABLE_SCHEMAS["conversations"], transform, sink, seen, files_per_batch=1)
    # the table arrives in two files; each run takes what is new, and a third run finds nothing
    folder = scratch_path(spark, "ingest-source")
    given = read_table(spark, d, "conversations")
    for part in (0, 1):
        given.where(F.coalesce(F.pmod("conv_id", F.lit(2)), F.lit(0)) == part).write.mode("append").parquet(folder)
        step(folder)
    return step(folder).drop("epoch")


@query
def q_retry_stream(spark, d):
    """The attempts of :func:`_attempts` as a stream that is stopped half-way and started again, and what stands
    for each request at its end."""
    from parley.streaming.retry import route_available, standing

    ev = read_table(spark, d, "events")
    status = (F.when(F.col("event_type") == "error", F.lit("too_large"))
              .when(F.col("event_type") == "signup", F.lit("rate_limited")).otherwise(F.lit("ok")))
    came = ds.write_stage(spark, samples_from_events(ev).select(
        F.col("call_id").cast("string").alias("request_id"), (F.col("t") + 1).cast("long").alias("attempt"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("ts")), "attempts")
    first, last = came.agg(F.min("ts"), F.max("ts")).first()
    folder, sink, seen = (scratch_path(spark, f"retry-{name}") for name in ("source", "sink", "checkpoint"))
    # a last attempt of nobody, a day later, lets the waits that are still open end
    middle, end = F.lit(first + (last - first) / 2), F.lit(last) + F.expr("interval 1 day")
    nobody = spark.range(1).select(F.lit("").alias("request_id"), F.lit(1).cast("long").alias("attempt"), F.lit("ok").alias("status"), end.alias("ts"))
    for part in (came.where(F.col("ts") < middle), came.where(F.col("ts") >= middle), nobody):
        part.write.mode("append").parquet(folder)
        decisions = route_available(spark, folder, sink, seen)
    return standing(decisions.where("request_id <> ''")).select(F.col("request_id").cast("long").alias("request_id"), "attempt", "model", "status")


# ---- segments, spectra and signals -------------------------------------------------------------

from parley.functions import signal as sg  # noqa: E402
from parley.operators import segments as seg  # noqa: E402


def _samples(spark, d):
    return samples_from_events(read_table(spark, d, "events")).select("call_id", "t", "value", "event_type")


def _r6(c):
    return F.round(c, 6)


@query
def q_segment_features(spark, d):
    st = seg.segment_stats(_samples(spark, d))
    return st.select("call_id", "seg", *[_r6(c).alias(c) for c in ("mean", "sd", "median", "max", "min")], "n")


def _cents():
    return F.round(F.sum("value") * 100).cast("bigint")


@query
def q_two_means_1d(spark, d):
    return seg.two_means_1d(seg.segment_stats(_samples(spark, d), v=_cents()), "call_id", "seg", "v").select(
        "call_id", "seg", F.col("label").cast("bigint").alias("label"))


def _click_changes(spark, d):
    clicks = seg.segment_stats(_samples(spark, d), label=F.max((F.col("event_type") == "click").cast("int")))
    return seg.change_point(clicks.select("call_id", "seg", "label"))


@query
def q_change_point(spark, d):
    return _click_changes(spark, d)


@query
def q_ivr_removal(spark, d):
    st = ds.write_stage(spark, seg.segment_stats(_samples(spark, d), v=_cents()).select("call_id", "seg", "mean", "v"), "segments")
    cp = seg.change_point(seg.two_means_1d(st, "call_id", "seg", "v"))
    kept = seg.cut_before(st.withColumn("t0", F.col("seg") * 5), cp, "call_id", "t0")
    return kept.select("call_id", "seg", _r6("mean").alias("value"))


@query
def q_cut_ivr(spark, d):
    s = samples_from_events(read_table(spark, d, "events")).select("call_id", "t", "value")
    return seg.cut_before(s, _click_changes(spark, d), "call_id", "t").select(
        "call_id", F.col("t").cast("bigint").alias("t"), "value")


@query
def q_gap_turns(spark, d):
    ev = read_table(spark, d, "events").select("event_id", F.col("user_id").alias("call_id"), "ts")
    g = tn.gap_turns(ev, "call_id", "ts", "event_id", min_silence_s=6 * 3600, min_speech_s=1800, pad_s=0.4)
    return g.select("call_id", F.col("turn").cast("bigint").alias("turn"), "start_us", "end_us", "n")


def _spectra(spark, d):
    """Vectors as spectra: 64 frames a call, 8 frames a segment, in order of the id."""
    e = read_table(spark, d, "embeddings")
    return e.select(F.floor(F.col("vec_id") / 64).alias("call_id"), F.floor(F.pmod("vec_id", F.lit(64)) / 8).alias("seg"),
                    F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("mag"))


@query
def q_spectral_summary(spark, d):
    f = seg.spectral_features(_spectra(spark, d))
    return f.select("call_id", "seg", *(_r6(c).alias(c) for c in FEATURES))


def _two_means(spark, d):
    features = ds.write_stage(spark, seg.spectral_features(_spectra(spark, d)), "features")
    return features, seg.two_means(features, "call_id", "seg", FEATURES, _write(spark))


@query
def q_two_means(spark, d):
    return _two_means(spark, d)[1]


@query
def q_ivr_cut_features(spark, d):
    """The whole opening removal: features, clusters, change point, cut."""
    features, labels = _two_means(spark, d)
    kept = seg.cut_before(features.withColumn("t0", F.col("seg") * 5), seg.change_point(labels), "call_id", "t0")
    return kept.select("call_id", "seg", _r6("meanfreq").alias("meanfreq"))


def _signal_parts(spark, d, parts):
    e = read_table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("s"))
    p = e.select("id", F.posexplode(parts).alias("part", "x"))
    return p.select("id", F.col("part").cast("bigint").alias("part"), F.size("x").cast("bigint").alias("n"),
                    _r6(F.aggregate("x", F.lit(0.0).cast("double"), lambda a, v: a + v)).alias("sum"))


@query
def q_frame_signal(spark, d):
    return _signal_parts(spark, d, sg.frames("s", 5))


@query
def q_chunk_signal(spark, d):
    return _signal_parts(spark, d, sg.blocks("s", 5))


@query
def q_split_channels(spark, d):
    return _signal_parts(spark, d, F.array(sg.channel("s", 0), sg.channel("s", 1)))


@query
def q_merge_channels(spark, d):
    """Signals split into channels and merged again, odd lengths among them; told by values at their places."""
    e = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform(
        F.slice("embedding", F.lit(1), F.size("embedding") - F.pmod("vec_id", F.lit(2)).cast("int")), lambda x: x.cast("double")).alias("s"))
    merged = e.select("id", F.col("s"), sg.interleave_channels(sg.channel("s", 0), sg.channel("s", 1)).alias("m"))
    placed = F.aggregate(F.transform("m", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return merged.select("id", F.size("m").cast("bigint").alias("n"), _r6(placed).alias("placed"), (F.col("s") == F.col("m")).alias("same"))


@query
def q_prompted_requests(spark, d):
    """Requests whose prompt is read from a file that was written before."""
    from parley.constants import PROMPT_RESTATE

    path = scratch_path(spark, "prompt")
    spark.createDataFrame([(PROMPT_RESTATE,)], "prompt string").write.option("lineSep", "\n").text(path)
    prompt = fs.read_prompt(spark, path=path).first().prompt.removesuffix("\n")
    reqs = rt.requests_from_speech(_speech(spark, d)).withColumn("content", F.col("spoken"))
    return ms.build_messages(reqs, prompt, "content").select("request_id", "call_id", "content")


@query
def q_repair_unicode_nfc(spark, d):
    return _docs(spark, d).select(F.col("id").alias("doc_id"), tx.nfc_normalise(tx.repair_unicode("text")).alias("text"))
