"""DuckDB SQL for the queries of this subpackage that SQL can express. The constants are stated
here again, so that a wrong constant in an operator shows."""

ORACLES: dict[str, str] = {}

ORACLES["op2_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws(':', doc_id::VARCHAR, text)) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS lvl
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT arg_min(lvl, ratio) AS lvl FROM levels WHERE lvl <= ratio
), streams AS (
  SELECT d.doc_id, d.size, l.source_size, l.weight,
         least((3 * l.source_size)::DOUBLE, c.lvl * l.weight) AS target,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::DOUBLE
           - d.size::DOUBLE / 2 AS middle
  FROM sized d JOIN levels l ON d.source IS NOT DISTINCT FROM l.source CROSS JOIN chosen c
), taken AS (
  SELECT *, ((middle <= target)::INT + (middle + source_size <= target)::INT
             + (middle + 2 * source_size <= target)::INT)::BIGINT AS repeats,
         weight::DOUBLE * CASE WHEN target > 0 THEN least(1.0::DOUBLE, middle / target) ELSE 0 END AS amount
  FROM streams
)
SELECT doc_id, size, source_size, target, size * repeats AS taken, repeats,
       CASE WHEN repeats > 0 THEN least(1.0::DOUBLE, 2.0::DOUBLE * amount
         / (CASE weight WHEN 1 THEN 1.5::DOUBLE WHEN 2 THEN 2.0::DOUBLE ELSE 2.5::DOUBLE END
            + sqrt(greatest(0.0::DOUBLE,
                CASE weight WHEN 1 THEN 2.25::DOUBLE WHEN 2 THEN 4.0::DOUBLE ELSE 6.25::DOUBLE END
                + CASE weight WHEN 1 THEN -2.0::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END * amount)))) END
         AS first_position
FROM taken
"""

ORACLES["op5_warc_revisits"] = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS kept FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to, true AS intact
FROM q
"""

ORACLES["op6_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), c AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         string_agg(left(role, 1), '' ORDER BY turn, role, text) AS letters,
         sum(length('<|im_start|>') + length('<|im_end|>') + 2 + length(role)
             + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars,
       regexp_full_match(letters, 's?(ua)+') AS valid
FROM c
"""

ORACLES["op7_topk_search"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, d.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""

ORACLES["op13_ranked_search"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (
  SELECT rid, doc_id, len(terms)::BIGINT AS n, terms FROM words WHERE len(terms) > 0
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM docs
), tf AS (
  SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(terms) AS term FROM docs) GROUP BY rid, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf CROSS JOIN totals GROUP BY term
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), scored AS (
  SELECT item_id, d.rid, any_value(d.doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // totals.terms))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN docs d USING (rid) CROSS JOIN totals
  GROUP BY item_id, d.rid
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
