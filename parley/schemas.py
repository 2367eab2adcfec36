"""Fixed schemas (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS = T.TimestampNTZType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TABLE_SCHEMAS = {
    "conversations": _s(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
    "documents": _s(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": _s(("doc_id", L), ("quality", I), ("toxic", I)),
    "embeddings": _s(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "events": _s(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
    "benchmark": _s(("item_id", L), ("text", S)),
    "pages": _s(("page_id", L), ("url", S), ("html", S)),
    "lineitem": _s(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                   ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                   ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "orders": _s(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                 ("o_orderdate", TS), ("o_orderpriority", S)),
}

# D4: one transcript turn (CSV export of a call, or derived from conversations).
TURN = _s(("start", D), ("end", D), ("transcription", S), ("role", S))
TURNS = _s(("call_id", S), ("start_s", D), ("end_s", D), ("role", S), ("text", S))

# D5: speech-to-text chunk list.
CHUNK_LIST = T.ArrayType(T.StructType([
    T.StructField("timestamp", T.ArrayType(D), True),
    T.StructField("text", S, True),
]))

# D12: chat messages.
MESSAGE = T.StructType([T.StructField("role", S, False), T.StructField("content", S, True)])
MESSAGES = T.ArrayType(MESSAGE)

# D13: model responses.
RESPONSES = _s(("request_id", S), ("attempt", I), ("model", S), ("status", S), ("text", S),
               ("tokens_in", L), ("tokens_out", L))

# D14: embedding responses.
EMBED_RESPONSES = T.StructType([
    T.StructField("text_key", S, True),
    T.StructField("embed", T.ArrayType(T.FloatType()), True),
    T.StructField("tokens", L, True),
])

# D7: index document, with its allowed field names for the strict sink (SNK-1).
INDEX_DOC_FIELDS = ["text", "persona", "category", "call_id", "original", "embed"]
INDEX_DOC = _s(("text", S), ("persona", S), ("category", S), ("call_id", S), ("original", S),
               ("embed", T.ArrayType(T.FloatType())))
