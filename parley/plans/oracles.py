"""Oracle SQL (DuckDB) for the registered queries; same output column names."""

from __future__ import annotations

from parley.constants import FEATURES, INSTRUCTION_SEED, INSTRUCTIONS, NAME_MASK, PROMPT_REFINE, PROMPT_RESTATE
from parley.plans import sqlkit as K

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


TURNS = ("SELECT conv_id AS call_id, CAST(turn AS DOUBLE) AS start_s, CAST(NULL AS DOUBLE) AS end_s, "
         "CASE role WHEN 'user' THEN 'customer' ELSE 'agent' END AS role, text FROM conversations "
         "WHERE role IN ('user', 'assistant')")
DOCS = "SELECT doc_id AS id, text, lang FROM documents"

oracle("scan_turns", f"SELECT call_id, start_s, role, text FROM ({TURNS})")

oracle("speech_by_role", f"""
SELECT call_id, role, string_agg(text, ' ' ORDER BY start_s, end_s, text) AS speech, count(*) AS n_turns
FROM ({TURNS}) WHERE text IS NOT NULL AND text <> '' GROUP BY call_id, role""")

oracle("interleave", f"SELECT call_id, start_s, role, text FROM ({TURNS})")

oracle("dedupe_repeats", K.with_ctes([("src", DOCS)] + K.repeats_steps("src"),
                                     "SELECT id AS doc_id, text FROM r_out"))

oracle("repair_unicode", K.with_ctes([("src", DOCS)] + K.unicode_steps("src"),
                                     "SELECT id AS doc_id, text FROM u7"))

# what was whole before the damage comes out as if there had been none
oracle("repair_damaged", K.with_ctes(
    [("src", "SELECT doc_id AS id, left(text, length(text) // 2) || ' — ' || substr(text, length(text) // 2 + 1) AS text FROM documents")]
    + K.unicode_steps("src"), "SELECT id AS doc_id, text FROM u7"))

oracle("normalise_punct", f"SELECT doc_id, {K.punct('text')} AS text FROM documents")

oracle("strip_digits", f"SELECT doc_id, {K.digits('text')} AS text, "
                       f"CAST(length(text) - length({K.digits('text')}) AS BIGINT) AS n_removed FROM documents")


def _count(col):
    return f"CAST((length({col}) - length(replace({col}, '{NAME_MASK}', ''))) / 4 AS BIGINT)"


for _name, _compat in (("mask_names", False), ("mask_names_compat", True)):
    oracle(_name, K.with_ctes(
        [("src", DOCS)] + K.names_steps() + K.mask_steps("src", "nm", _compat),
        f"SELECT m.id AS doc_id, m.text AS text, {_count('m.text')} - {_count('s.text')} AS n_masked "
        f"FROM m_out m JOIN src s ON m.id = s.id"))

oracle("clean_speech", K.with_ctes([("src", DOCS)] + K.names_steps() + K.clean_steps("src", "nm"),
                                   "SELECT id, text FROM c_out"))

oracle("clean_audit", K.with_ctes(
    [("src", DOCS)] + K.names_steps() + K.clean_steps("src", "nm"),
    "SELECT s.lang, count(*) AS n, count(*) FILTER (WHERE s.text IS DISTINCT FROM c.text) AS n_changed, "
    "count(*) FILTER (WHERE length(c.text) = 0 AND length(s.text) > 0) AS n_emptied, "
    "sum(coalesce(length(s.text), 0) - coalesce(length(c.text), 0)) AS chars_removed "
    "FROM src s LEFT JOIN c_out c ON s.id = c.id GROUP BY s.lang"))

oracle("document_sink", """
WITH t AS (SELECT CASE WHEN d.doc_id % 9 = 0 OR d.text = '' OR d.text IS NULL THEN 'missing_text' WHEN e.embedding IS NULL THEN 'missing_embed'
                       WHEN e.label % 4 = 1 AND len(e.embedding) > 32 THEN 'bad_dims' END AS problem
           FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id)
SELECT problem, count(*) AS n,
       CASE WHEN problem IS NULL THEN (SELECT count(*) FILTER (WHERE problem IS NULL) FROM t) ELSE (SELECT count(problem) FROM t) END AS counted
FROM t GROUP BY problem""")

oracle("analyse_text", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_terms, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct,
       t[1] AS first_term
FROM (SELECT doc_id, {K.terms('text')} AS t FROM documents)""")


oracle("capped_names", K.with_ctes(
    K.names_steps(), "SELECT DISTINCT lower(name) AS name FROM (SELECT *, row_number() OVER (PARTITION BY list "
                     "ORDER BY rank, name) AS r FROM nm_raw) WHERE r <= 5 AND lower(name) <> ''"))


# ---- model answers -----------------------------------------------------------------------------

NL = "chr(10)"


def req_key(prompt: str, content: str) -> str:
    return f"sha256({K.lit(prompt)} || {NL} || {NL} || {content})"


def stub_answer(content: str) -> str:
    """Answer and status that the stand-in model leads to, retry round included."""
    h, body = f"md5({content})", f"regexp_replace({content}, '</?(transcription|dem|res)>', '', 'g')"
    return (f"CASE WHEN {h} LIKE '0%' THEN 'NOT YET' WHEN {h} SIMILAR TO '1[0-3].*' THEN 'BIG ERROR' "
            f"ELSE 'a' || substr({h}, 1, 8) || ' ' || {body} END AS answer, "
            f"CASE WHEN {h} LIKE '0%' THEN 'pending' WHEN {h} SIMILAR TO '1[0-3].*' THEN 'failed' ELSE 'done' END AS status")


# ---- vectors and retrieval ---------------------------------------------------------------------

def speech_docs_steps() -> list[tuple[str, str]]:
    """CTEs ending in ``ix(doc_id, persona, category, call_id, original, text)``; on the way
    ``rq(request_id, call_id, content)`` and ``rst(call_id, request_id, content, answer, status)``."""
    return [
        ("t", TURNS),
        ("sp", "SELECT role || ':' || CAST(call_id AS VARCHAR) AS id, call_id, role, "
               "string_agg(text, ' ' ORDER BY start_s, end_s, text) AS text FROM t "
               "WHERE text IS NOT NULL AND text <> '' GROUP BY call_id, role"),
        ("src", "SELECT id, text FROM sp"),
    ] + K.names_steps() + K.clean_steps("src", "nm") + [
        ("rq", f"SELECT {req_key(PROMPT_RESTATE, 'content')} AS request_id, call_id, content FROM (SELECT sp.call_id, "
               f"{NL} || {NL} || '<transcription>' || {NL} || c.text || {NL} || '</transcription>' AS content "
               f"FROM sp JOIN c_out c ON sp.id = c.id WHERE sp.role = 'customer')"),
        ("rst", f"SELECT call_id, request_id, content, {stub_answer('content')} FROM rq"),
        ("ix", "SELECT 'customer:' || CAST(call_id AS VARCHAR) AS doc_id, 'customer' AS persona, 'request' AS category, "
               "call_id, content AS original, answer AS text FROM rst WHERE status = 'done' UNION ALL "
               "SELECT 'agent:' || CAST(sp.call_id AS VARCHAR), 'agent', NULL, sp.call_id, 'N/A', c.text "
               "FROM sp JOIN c_out c ON sp.id = c.id WHERE sp.role = 'agent'"),
    ]


def hash_steps(src: str, id_col: str, dims: int = 64, out: str = "hv") -> list[tuple[str, str]]:
    return [
        ("h_t", f"SELECT {id_col} AS hid, unnest({K.terms('text')}) AS term FROM {src}"),
        ("h_tf", f"SELECT hid, ('0x' || substr(md5(term), 1, 8))::BIGINT % {dims} AS bucket, count(*) AS tf "
                 f"FROM h_t GROUP BY ALL"),
        ("h_n", f"SELECT count(*) AS n FROM {src}"),
        ("h_df", "SELECT bucket, count(*) AS df FROM h_tf GROUP BY bucket"),
        ("h_w", "SELECT hid, bucket, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM h_tf JOIN h_df USING (bucket) "
                "CROSS JOIN h_n"),
        (out, "SELECT hid, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY hid)) AS weight FROM h_w"),
    ]


def dense_steps(hv: str = "hv", dims: int = 64, out: str = "dv") -> list[tuple[str, str]]:
    return [
        (out, f"SELECT i.hid, list(coalesce(h.weight, 0.0) ORDER BY b.range) AS e FROM "
              f"(SELECT DISTINCT hid FROM {hv}) i CROSS JOIN range({dims}) b "
              f"LEFT JOIN {hv} h ON h.hid = i.hid AND h.bucket = b.range GROUP BY i.hid"),
    ]


def cosine(a: str, b: str) -> str:
    return (f"list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * "
            f"sqrt(list_dot_product({b}, {b}))) + 1")


oracle("build_docs", K.with_ctes(speech_docs_steps(),
                                 "SELECT doc_id, persona, category, call_id, original, text FROM ix"))

oracle("hash_vectors", K.with_ctes(
    [("cv", "SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS id, text FROM conversations")]
    + hash_steps("cv", "id"),
    "SELECT hid AS id, bucket, round(weight, 6) AS weight FROM hv"))

for _name in ("knn_topk", "knn_pruned"):
    oracle(_name, f"""
WITH v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_dot_product(embedding, embedding) > 0),
s AS (SELECT q.id AS query_id, d.id AS doc_id, {cosine('q.e', 'd.e')} AS score
      FROM v q JOIN v d ON q.label % 2 = 1 AND d.label % 2 = 0)
SELECT query_id, doc_id, rank, round(score, 6) AS score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
WHERE rank <= 10""")


def candidates_steps() -> list[tuple[str, str]]:
    """CTEs ending in ``cand(call_id, request, n, max_score, answers_joined)``."""
    return speech_docs_steps() + hash_steps("ix", "doc_id") + dense_steps() + [
        ("qv", "SELECT ix.doc_id, dv.e FROM ix JOIN dv ON ix.doc_id = dv.hid WHERE ix.persona = 'customer'"),
        ("av", "SELECT ix.doc_id, dv.e FROM ix JOIN dv ON ix.doc_id = dv.hid WHERE ix.persona = 'agent'"),
        ("sc", f"SELECT qv.doc_id AS qid, av.doc_id AS did, {cosine('qv.e', 'av.e')} AS score FROM qv JOIN av ON true"),
        ("top", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, did) AS rank "
                "FROM sc) WHERE rank <= 10"),
        ("agg", "SELECT qid, count(*) AS n, max(score) AS max_score, "
                "string_agg(replace(replace(ix.text, '\\', '\\\\'), '<sep>', '<\\sep>') || '<sep>', '' ORDER BY rank) AS answers_joined "
                "FROM top JOIN ix ON ix.doc_id = top.did GROUP BY qid"),
        ("cand", "SELECT r.call_id, r.text AS request, coalesce(agg.n, 0) AS n, "
                 "round(coalesce(agg.max_score, -1), 6) AS max_score, coalesce(agg.answers_joined, '') AS answers_joined "
                 "FROM ix r LEFT JOIN agg ON agg.qid = r.doc_id WHERE r.persona = 'customer'"),
    ]


oracle("candidates", K.with_ctes(candidates_steps(), "SELECT * FROM cand"))

oracle("split_candidates", K.with_ctes(
    candidates_steps(), "SELECT r.call_id, top.rank - 1 AS pos, a.text AS answer FROM top JOIN ix r ON r.doc_id = top.qid "
                        "JOIN ix a ON a.doc_id = top.did"))


# ---- model stages and the dataset -------------------------------------------------------------

REQ = speech_docs_steps()

for _name in ("build_requests", "prompted_requests"):
    oracle(_name, K.with_ctes(REQ, "SELECT request_id, call_id, content FROM rq"))

oracle("build_messages", K.with_ctes(
    REQ, f"SELECT request_id, call_id, 0 AS pos, 'system' AS role, {K.lit(PROMPT_RESTATE)} AS content FROM rq "
         f"UNION ALL SELECT request_id, call_id, 1, 'user', content FROM rq"))

oracle("merge_responses", K.with_ctes(REQ, "SELECT call_id, request_id, answer, status FROM rst"))
oracle("restated_requests", K.with_ctes(REQ, "SELECT call_id, answer, status FROM rst"))

_N = "CAST(len({}) AS BIGINT)".format
oracle("usage_log", K.with_ctes(
    REQ + [("calls", f"SELECT DISTINCT request_id, md5(content) AS h, content, {_N(K.words_list('content'))} AS tokens_in, "
                     f"{_N(K.words_list('answer'))} AS n_out FROM rst WHERE md5(content) NOT LIKE '0%'")],
    "SELECT 'restate' AS stage, 'base' AS model, 'chat' AS kind, request_id, 1 AS attempt, tokens_in, "
    "CASE WHEN h LIKE '1%' THEN 0 ELSE n_out END AS tokens_out FROM calls UNION ALL "
    "SELECT 'restate', 'large', 'chat', request_id, 2, tokens_in, CASE WHEN h SIMILAR TO '1[0-3].*' THEN 0 ELSE n_out END "
    "FROM calls WHERE h LIKE '1%'"))

_REF = (f"'<dem>' || r.text || '</dem>' || {NL} || '<res>' || a.text || '</res>'")


def refine_steps() -> list[tuple[str, str]]:
    """CTEs on to ``rf(call_id, rank, content)``, its answers ``ra``, the combine requests ``cb`` and
    their answers ``ca``."""
    return candidates_steps() + [
        ("rf", f"SELECT r.call_id, top.rank, {_REF} AS content FROM top JOIN ix r ON r.doc_id = top.qid "
               f"JOIN ix a ON a.doc_id = top.did WHERE top.rank <= 3"),
        ("ra", f"SELECT call_id, rank, {stub_answer('content')} FROM rf"),
        ("cb", f"SELECT call_id, string_agg(CAST(k AS VARCHAR) || ') ' || answer, {NL} ORDER BY rank) AS content FROM "
               f"(SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY rank) AS k FROM ra WHERE status = 'done') GROUP BY call_id"),
        ("ca", f"SELECT call_id, {stub_answer('content')} FROM cb"),
    ]


oracle("refine_requests", K.with_ctes(
    refine_steps(), f"SELECT {req_key(PROMPT_REFINE, 'content')} AS request_id, call_id, rank, content FROM rf"))
oracle("refined_answers", K.with_ctes(refine_steps(), "SELECT call_id, rank, answer, status FROM ra"))
oracle("number_answers", K.with_ctes(refine_steps(), "SELECT call_id, content AS numbered FROM cb"))
oracle("combined_answers", K.with_ctes(refine_steps(), "SELECT call_id, answer, status FROM ca"))


def pick(key: str) -> str:
    arr = "[" + ", ".join(K.lit(t) for t in INSTRUCTIONS) + "]"
    h = f"('0x' || substr(md5({K.lit(INSTRUCTION_SEED + ':')} || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"
    return f"list_extract({arr}, ({h} % {len(INSTRUCTIONS)}) + 1)"


oracle("pick_instruction", K.with_ctes(REQ, f"SELECT call_id, {pick('call_id')} AS instruction FROM rq"))

PAIRS = (f"SELECT ca.call_id, {pick('ca.call_id')} AS instruction, ix.text AS request, ca.answer FROM ca "
         f"JOIN ix ON ix.call_id = ca.call_id AND ix.persona = 'customer' WHERE ca.status = 'done'")
oracle("pairs", K.with_ctes(refine_steps(), PAIRS))
oracle("resumed_run", K.with_ctes(refine_steps(), PAIRS))
oracle("sample_pairs", K.with_ctes(
    refine_steps(), f"SELECT * FROM ({PAIRS}) ORDER BY md5({K.lit(INSTRUCTION_SEED + ':')} || CAST(call_id AS VARCHAR)), "
              f"call_id LIMIT 10"))

VERDICT_TEXT = ("CASE WHEN quality = 0 AND toxic = 1 THEN 'This request is INVALID.' WHEN quality = 0 THEN 'INVALID' "
                "WHEN toxic = 1 AND doc_id % 2 = 0 THEN ' não é útil. ' WHEN toxic = 1 THEN '0' "
                "WHEN doc_id % 5 = 0 THEN 'This is useful' WHEN doc_id % 5 = 1 THEN 'not useful at all' "
                "WHEN doc_id % 5 = 2 THEN 'perhaps' ELSE '1' END")
oracle("classify_verdict", f"""
SELECT doc_id, CASE WHEN t IS NULL THEN NULL
  WHEN regexp_matches(upper(trim(t)), '(^|[^A-Z])INVALID([^A-Z]|$)') THEN 'invalid'
  WHEN contains(lower(t), 'não é útil') THEN 'not_useful'
  WHEN upper(trim(t)) = '1' THEN 'useful' WHEN upper(trim(t)) = '0' THEN 'not_useful'
  WHEN contains(upper(trim(t)), 'NOT USEFUL') THEN 'not_useful' WHEN contains(upper(trim(t)), 'USEFUL') THEN 'useful'
  ELSE 'unknown' END AS verdict
FROM (SELECT doc_id, {VERDICT_TEXT} AS t FROM labels)""")

oracle("invalid_rate", """
SELECT verdict, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labels), 2) AS pct
FROM (SELECT CASE WHEN quality IS NOT DISTINCT FROM 0 THEN 'INVALID' ELSE 'VALID' END AS verdict FROM labels)
GROUP BY verdict""")

oracle("pending_rows", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL")
oracle("resume_anti", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")

ATTEMPTS = """
a AS (SELECT user_id AS request_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt,
             CASE event_type WHEN 'error' THEN 'too_large' WHEN 'signup' THEN 'rate_limited' ELSE 'ok' END AS status
      FROM events),
m AS (SELECT *, CASE WHEN coalesce(sum(CASE WHEN status = 'too_large' THEN 1 ELSE 0 END) OVER (PARTITION BY request_id
             ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 THEN 'large' ELSE 'base' END AS model
      FROM a),
l AS (SELECT request_id, attempt, model, status,
             count(*) FILTER (WHERE status = 'too_large') OVER (PARTITION BY request_id) AS n_big,
             max(attempt) OVER (PARTITION BY request_id) AS last FROM m)"""

oracle("latest_attempt", f"WITH {ATTEMPTS} SELECT request_id, attempt, model, status FROM l WHERE attempt = last")
for _name in ("next_attempts", "retry_stream"):
    oracle(_name, f"""WITH {ATTEMPTS}
SELECT request_id,
  CASE WHEN status = 'too_large' AND n_big >= 2 THEN attempt ELSE attempt + 1 END AS attempt,
  CASE WHEN status = 'too_large' AND n_big >= 2 THEN model WHEN status = 'too_large' THEN 'large' ELSE model END AS model,
  CASE WHEN status = 'too_large' AND n_big >= 2 THEN 'BIG ERROR' ELSE 'retry' END AS status
FROM l WHERE attempt = last AND status IN ('too_large', 'rate_limited')""")

oracle("usage_cost", """
WITH p(kind, nano_in, nano_out) AS (VALUES ('embed', 100, 0), ('chat', 1500, 2000)),
u AS (SELECT CASE l_returnflag WHEN 'A' THEN 'embed' WHEN 'N' THEN 'restate' ELSE 'combine' END AS stage,
             CASE l_linestatus WHEN 'O' THEN 'base' ELSE 'large' END AS model,
             CASE WHEN l_returnflag = 'A' THEN 'embed' ELSE 'chat' END AS kind,
             CAST(floor(l_quantity) AS BIGINT) * 100 + l_linenumber AS tokens_in,
             CASE WHEN l_returnflag = 'A' THEN 0 ELSE CAST(floor(l_quantity) AS BIGINT) * 10 END AS tokens_out
      FROM lineitem)
SELECT stage, model, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out,
       round(CAST(sum(tokens_in * coalesce(nano_in, 0) + tokens_out * coalesce(nano_out, 0)) AS DOUBLE) / 1e9, 6) AS cost,
       CAST(count(*) FILTER (WHERE nano_in IS NULL) AS BIGINT) AS n_unpriced
FROM u LEFT JOIN p USING (kind) GROUP BY ROLLUP (stage, model)""")

oracle("compare_runs", """
SELECT d.doc_id, r1.run1, r2.run2, r3.run3,
       NOT (r1.run1 IS NOT DISTINCT FROM r2.run2 AND r2.run2 IS NOT DISTINCT FROM r3.run3) AS differs
FROM documents d
LEFT JOIN (SELECT doc_id, CASE WHEN quality = 0 THEN 'INVALID' ELSE 'VALID' END AS run1 FROM labels) r1 ON d.doc_id = r1.doc_id
LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'INVALID' ELSE 'VALID' END AS run2 FROM labels) r2 ON d.doc_id = r2.doc_id
LEFT JOIN (SELECT doc_id, CASE WHEN quality = 0 AND toxic = 1 THEN 'INVALID' ELSE 'VALID' END AS run3 FROM labels) r3
  ON d.doc_id = r3.doc_id""")

oracle("profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) AS n, '{kind}' AS dtype FROM orders"
    for c, kind in [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]))

oracle("embed_stage", K.with_ctes(speech_docs_steps(), f"""
SELECT sp.id, 16 AS dims, CAST(len({K.words_list('c.text')}) AS BIGINT) AS tokens,
       CAST(list_sum(list_transform(range(16), lambda i: ('0x' || substr(md5(c.text), 2 * i + 1, 2))::BIGINT)) AS BIGINT) AS bytes_sum
FROM sp JOIN c_out c ON sp.id = c.id"""))

oracle("stage_counts", """
WITH j AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'verdict' AS stage, count(*) AS total, count(quality) AS done, count(*) - count(quality) AS remaining FROM j
UNION ALL
SELECT 'valid', count(quality), count(*) FILTER (WHERE quality = 1),
       count(quality) - count(*) FILTER (WHERE quality = 1) FROM j""")

oracle("dedupe_inputs", "SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text")

oracle("key_normalise", """
SELECT page_id, base_name,
       regexp_replace(regexp_replace(regexp_replace(base_name, '^features_', ''), '\\.csv$', ''), '\\.opus$', '.mp3') AS key
FROM (SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS base_name FROM pages)""")

oracle("strict_docs", """
SELECT event_id, array_to_string(list_sort(list_filter(k, lambda x: x NOT IN ('k'))), ',') AS unknown_keys,
       coalesce(k IS NOT NULL AND len(list_filter(k, lambda x: x NOT IN ('k'))) = 0 AND list_contains(k, 'k'), false) AS ok
FROM (SELECT event_id, CASE WHEN json_valid(props) THEN json_keys(props) END AS k FROM events)""")

_VEC = ("CASE WHEN {0} IS NULL THEN 'null_vector' WHEN len({0}) <> 64 THEN 'bad_dims' "
        "WHEN list_bool_and(list_transform({0}, lambda x: x = 0)) THEN 'zero_vector' END").format


def _TXT(e: str) -> str:
    return f"CASE WHEN {e} IS NULL THEN 'null_text' WHEN regexp_full_match({e}, {K.lit('[' + K.WS + ']*')}) THEN 'empty_text' END"


oracle("bad_inputs", f"""
SELECT * FROM (
SELECT 'documents' AS source, doc_id AS id, {_TXT('text')} AS problem FROM documents
UNION ALL SELECT 'embeddings', vec_id, {_VEC('embedding')} FROM embeddings
UNION ALL SELECT 'digits', doc_id, {_TXT("regexp_replace(text, '[^0-9]', ' ', 'g')")} FROM documents
UNION ALL SELECT 'short', vec_id, {_VEC('s')} FROM (SELECT vec_id, CASE label % 4 WHEN 1 THEN embedding[1:32]
  WHEN 2 THEN list_transform(embedding, lambda x: x * 0) ELSE embedding END AS s FROM embeddings)
UNION ALL SELECT 'cut', event_id, CASE WHEN c IS NULL THEN 'null_json' WHEN NOT json_valid(c) THEN 'bad_json' END FROM
  (SELECT event_id, CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) WHEN event_type <> 'signup' THEN props END AS c
   FROM events)
) WHERE problem IS NOT NULL""")

oracle("chunks_to_turns", f"""
SELECT call_id, blk, seq, start_s, CASE WHEN seq = n - 1 THEN NULL ELSE start_s + 1 END AS end_s, text
FROM (SELECT call_id, CAST(floor(start_s / 32) AS BIGINT) AS blk, start_s, text,
             row_number() OVER (PARTITION BY call_id, floor(start_s / 32) ORDER BY start_s, text) - 1 AS seq,
             count(*) OVER (PARTITION BY call_id, floor(start_s / 32)) AS n
      FROM ({TURNS}))""")

oracle("incremental_ingest", K.with_ctes(
    [("t0", TURNS), ("src", "SELECT call_id || ':' || start_s AS id, * FROM t0")] + K.names_steps() + K.clean_steps("src", "nm"),
    "SELECT s.call_id, s.start_s, s.role, c.text FROM src s JOIN c_out c ON s.id = c.id"))

oracle("message_history", f"""
WITH t AS (SELECT * FROM ({TURNS}) WHERE text IS NOT NULL),
l AS (SELECT call_id, max(start_s) AS last FROM t WHERE role = 'customer' GROUP BY call_id)
SELECT call_id, 0 AS pos, 'system' AS role, 'system' AS content FROM l UNION ALL
SELECT t.call_id, row_number() OVER (PARTITION BY t.call_id ORDER BY start_s, role DESC, text),
       CASE role WHEN 'customer' THEN 'user' ELSE 'assistant' END, text
FROM t JOIN l ON t.call_id = l.call_id WHERE start_s <= last""")


# ---- segments, spectra and signals -------------------------------------------------------------

FRAMED = """
s AS (SELECT user_id AS call_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t,
             value, event_type FROM events),
f AS (SELECT *, t // 5 AS seg FROM s),
fullf AS (SELECT call_id, seg FROM f GROUP BY call_id, seg HAVING count(*) = 5),
ff AS (SELECT f.* FROM f SEMI JOIN fullf ON f.call_id = fullf.call_id AND f.seg = fullf.seg),
st AS (SELECT call_id, seg, avg(value) AS mean, stddev_pop(value) AS sd, median(value) AS median,
              max(value) AS max, min(value) AS min, count(*) AS n FROM ff GROUP BY call_id, seg)"""

oracle("segment_features", f"""WITH {FRAMED}
SELECT call_id, seg, round(mean, 6) AS mean, round(sd, 6) AS sd, round(median, 6) AS median,
       round(max, 6) AS max, round(min, 6) AS min, n FROM st""")

TWO_MEANS = """
fr AS (SELECT call_id, seg, CAST(round(sum(value) * 100) AS BIGINT) AS v FROM ff GROUP BY call_id, seg),
w AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY v, seg) AS k,
             sum(v) OVER (PARTITION BY call_id ORDER BY v, seg ROWS UNBOUNDED PRECEDING) AS cum,
             count(*) OVER (PARTITION BY call_id) AS n, sum(v) OVER (PARTITION BY call_id) AS tot,
             lead(v) OVER (PARTITION BY call_id ORDER BY v, seg) AS nxt FROM fr),
c AS (SELECT *, CASE WHEN k < n AND nxt > v THEN CAST(cum * cum AS DOUBLE) / k
                     + CAST((tot - cum) * (tot - cum) AS DOUBLE) / (n - k) END AS score FROM w),
b AS (SELECT call_id, min(k) AS best FROM (SELECT *, max(score) OVER (PARTITION BY call_id) AS ms FROM c)
      WHERE score = ms GROUP BY call_id),
tm AS (SELECT c.call_id, c.seg, CAST(CASE WHEN b.best IS NOT NULL AND c.k > b.best THEN 1 ELSE 0 END AS BIGINT) AS label
       FROM c LEFT JOIN b ON c.call_id = b.call_id)"""

oracle("two_means_1d", f"WITH {FRAMED}, {TWO_MEANS} SELECT call_id, seg, label FROM tm")


def change_sql(labels: str, out: str) -> str:
    return f"""
{out}_p AS (SELECT *, row_number() OVER w - 1 AS i, lead(label, 1) OVER w AS l1, lead(label, 2) OVER w AS l2,
             lead(label, 3) OVER w AS l3 FROM {labels} WINDOW w AS (PARTITION BY call_id ORDER BY seg)),
{out}_s AS (SELECT *, 100 * abs(label + l1 - l2 - l3) - i AS score FROM {out}_p),
{out}_b AS (SELECT call_id, count(*) AS n, max(score) AS ms FROM {out}_s GROUP BY call_id),
{out}_i AS (SELECT s.call_id, min(s.i) AS bi FROM {out}_s s JOIN {out}_b b ON s.call_id = b.call_id
            WHERE s.score = b.ms GROUP BY s.call_id),
{out} AS (SELECT b.call_id, CAST(CASE WHEN n < 4 THEN NULL ELSE bi + 2 END AS BIGINT) AS change_seg,
          CAST(CASE WHEN n < 4 THEN 0 ELSE (bi + 2) * 5 END AS BIGINT) AS start_s, n < 4 AS too_short
          FROM {out}_b b LEFT JOIN {out}_i i ON b.call_id = i.call_id)"""


CLICKS = "cl AS (SELECT call_id, seg, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS label FROM ff GROUP BY call_id, seg)"

oracle("change_point", f"WITH {FRAMED}, {CLICKS}, {change_sql('cl', 'cp')} SELECT * FROM cp")

oracle("ivr_removal", f"""WITH {FRAMED}, {TWO_MEANS}, {change_sql('tm', 'cp')}
SELECT st.call_id, st.seg, round(st.mean, 6) AS value FROM st LEFT JOIN cp ON st.call_id = cp.call_id
WHERE cp.start_s IS NULL OR st.seg * 5 >= cp.start_s""")

oracle("cut_ivr", f"""WITH {FRAMED}, {CLICKS}, {change_sql('cl', 'cp')}
SELECT s.call_id, s.t, s.value FROM s LEFT JOIN cp ON s.call_id = cp.call_id
WHERE cp.start_s IS NULL OR s.t >= cp.start_s""")

oracle("gap_turns", """
WITH g AS (SELECT user_id AS call_id, epoch_us(ts) AS t, event_id FROM events),
h AS (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > 21600000000 THEN 1 ELSE 0 END AS nw
      FROM g WINDOW w AS (PARTITION BY call_id ORDER BY t, event_id)),
i AS (SELECT *, sum(nw) OVER (PARTITION BY call_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) - 1 AS turn FROM h)
SELECT call_id, CAST(turn AS BIGINT) AS turn, min(t) - 400000 AS start_us, max(t) + 400000 AS end_us, count(*) AS n
FROM i GROUP BY call_id, turn HAVING max(t) - min(t) >= 1800000000""")

_FN = {"mean": "avg", "sd": "stddev_pop", "median": "median", "max": "max", "min": "min"}
_SPEC_AGGS = [f"round({_FN[_s]}(CAST({_c} AS DOUBLE)), 6) AS {_name}" for _c, _s, _name in [
    ("c", "mean", "meanfreq"), ("c", "sd", "sd"), ("c", "median", "median"), ("c", "max", "maxfreq"), ("c", "min", "minfreq"),
    *[("f", _s, f"{_s}_sfm") for _s in ("mean", "median", "sd")],
    *[(f"r{_r[1:]}", _s, f"{_s}_rolloff_{_r}") for _r in ("099", "001") for _s in ("mean", "median", "sd", "min", "max")]]]

SPECTRAL = f"""
b AS (SELECT vec_id, unnest(range(len(embedding))) AS i, abs(CAST(unnest(embedding) AS DOUBLE)) AS m FROM embeddings),
cu AS (SELECT *, sum(m) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS cum,
              sum(m) OVER (PARTITION BY vec_id) AS tot FROM b),
fr AS (SELECT vec_id // 64 AS call_id, vec_id % 64 // 8 AS seg, CASE WHEN sum(m) > 0 THEN sum(i * m) / sum(m) END AS c,
              exp(avg(ln(greatest(m * m, 1e-10)))) / avg(greatest(m * m, 1e-10)) AS f,
              CASE WHEN max(tot) > 0 THEN min(i) FILTER (WHERE cum >= 0.99 * tot) END AS r99,
              CASE WHEN max(tot) > 0 THEN min(i) FILTER (WHERE cum >= 0.01 * tot) END AS r01
       FROM cu GROUP BY vec_id),
ft AS (SELECT call_id, seg, {', '.join(_SPEC_AGGS)} FROM fr GROUP BY call_id, seg)"""

oracle("spectral_summary", f"WITH {SPECTRAL} SELECT * FROM ft")


def _square(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1]::DOUBLE - p[2]) * (p[1]::DOUBLE - p[2])))"


def _centre(label: int) -> str:
    """The mean of the segments of a label; null without any."""
    return (f"CASE WHEN len(list_filter(lab, lambda l: l = {label})) > 0 THEN list_transform(range(1, {len(FEATURES) + 1}), lambda f: "
            f"list_sum(list_transform(list_zip(xs, lab), lambda p: CASE WHEN p[2] = {label} THEN p[1][f] ELSE 0 END))::DOUBLE "
            f"/ len(list_filter(lab, lambda l: l = {label}))) END")


# Lloyd's steps of a call and start as one row, its segments as lists
LLOYD = f"""{SPECTRAL},
fx AS (SELECT call_id, seg, [{', '.join(f'floor(coalesce({c}, 0) * 1000000 + 0.5)::BIGINT' for c in FEATURES)}] AS x FROM ft),
xs AS (SELECT call_id, list(x ORDER BY seg) AS xs, list(seg ORDER BY seg) AS segs FROM fx GROUP BY call_id),
s1 AS (SELECT call_id, s, arg_min(x, md5(s || ':' || seg)) AS a FROM fx CROSS JOIN range(10) t(s) GROUP BY call_id, s),
s2 AS (SELECT s1.call_id, s, a, x AS b FROM s1 JOIN fx USING (call_id)
       QUALIFY row_number() OVER (PARTITION BY call_id, s ORDER BY {_square('x', 'a')} DESC, seg) = 1),
rec AS (
  SELECT call_id, s, 0 AS it, list_transform(xs, lambda x: ({_square('x', 'b')} < {_square('x', 'a')})::INT) AS lab, NULL::INT[] AS before
  FROM s2 JOIN xs USING (call_id)
  UNION ALL
  SELECT call_id, s, it + 1, list_transform(xs, lambda x: CASE WHEN {_square('x', 'c1')} < {_square('x', 'c0')} THEN 1 ELSE 0 END), lab
  FROM (SELECT *, {_centre(0)} AS c0, {_centre(1)} AS c1 FROM rec JOIN xs USING (call_id) WHERE it < 300 AND lab IS DISTINCT FROM before)),
ended AS (SELECT call_id, s, arg_max(lab, it) AS lab FROM rec GROUP BY call_id, s),
spread AS (SELECT *, list_sum(list_transform(xs, lambda x: least({_square('x', 'c0')}, {_square('x', 'c1')}))) AS d
           FROM (SELECT *, {_centre(0)} AS c0, {_centre(1)} AS c1 FROM ended JOIN xs USING (call_id))),
best AS (SELECT * FROM spread QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY round(d, -3), s) = 1),
tm AS (SELECT call_id, unnest(segs) AS seg, unnest(list_transform(lab, lambda l: (l <> lab[1])::INT)) AS label FROM best)"""

oracle("two_means", f"WITH RECURSIVE {LLOYD} SELECT call_id, seg, label FROM tm")
oracle("ivr_cut_features", f"""WITH RECURSIVE {LLOYD}, {change_sql('tm', 'cp')}
SELECT ft.call_id, ft.seg, ft.meanfreq FROM ft JOIN cp ON ft.call_id = cp.call_id WHERE ft.seg * 5 >= cp.start_s""")

_E = "SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings"
oracle("frame_signal", f"""
SELECT id, part, CAST(len(x) AS BIGINT) AS n, round(list_sum(x), 6) AS sum FROM
  (SELECT id, part, e[part * 5 + 1 : part * 5 + 5] AS x FROM (SELECT id, e, unnest(range(len(e) // 5)) AS part FROM ({_E})))""")
oracle("chunk_signal", f"""
SELECT id, part, CAST(len(x) AS BIGINT) AS n, round(list_sum(x), 6) AS sum FROM
  (SELECT id, part, e[part * 5 + 1 : least(part * 5 + 5, len(e))] AS x FROM
    (SELECT id, e, unnest(range(CAST(ceil(len(e) / 5) AS BIGINT))) AS part FROM ({_E})))""")
oracle("split_channels", f"""
SELECT id, part, CAST(len(x) AS BIGINT) AS n, round(list_sum(x), 6) AS sum FROM
  (SELECT id, 0 AS part, list_transform(range(0, len(e), 2), lambda i: e[i + 1]) AS x FROM ({_E})
   UNION ALL SELECT id, 1, list_transform(range(1, len(e), 2), lambda i: e[i + 1]) FROM ({_E}))""")

oracle("merge_channels", f"""
SELECT id, CAST(len(s) AS BIGINT) AS n, round(coalesce(list_sum(list_transform(s, lambda x, i: x * i)), 0), 6) AS placed, true AS same
FROM (SELECT id, list_slice(e, 1, len(e) - (id % 2)) AS s FROM ({_E}))""")

oracle("repair_unicode_nfc", K.with_ctes([("src", DOCS)] + K.unicode_steps("src"),
                                         "SELECT id AS doc_id, nfc_normalize(text) AS text FROM u7"))
