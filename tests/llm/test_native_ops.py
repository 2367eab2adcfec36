"""Mixing, WARC, chat formatting and top-k on small hand-made tables and by brute force."""

import gzip
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import chat, mixing, topk, warc
from parley.session import scratch_path

DOC = "doc_id long, text string, lang string, source string, n_chars long, size string, target string, positions long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "x", "y", 7) for i, t, s in rows], DOC)


def water_fill(sizes, weights, epochs=3):
    budget, open_, target = sum(sizes.values()), dict(weights), {}
    while True:
        level = (budget - sum(target.values())) / sum(open_.values()) if open_ else 0
        over = [s for s in open_ if level * open_[s] > epochs * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in open_.items()}
        for s in over:
            target[s] = epochs * sizes[s]
            del open_[s]


def test_mix_targets_and_taken(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 9, 30]))),
             rng.choice(["a", "a", "a", "b", "é", "z", None, "tiny" if i < 3 else "a"])) for i in range(400)]
    rows += [(1000, None, "a"), (1001, " \t\n\x0b ", "b"), (None, "one two", "b"), (1002, "x y z", "b")]
    got = mixing.mix(docs_of(spark, rows), digits=2).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = water_fill(sizes, {s: 1 + k % 3 for k, s in enumerate(order)})
    assert {r.row.source: r.source_size for r in got} == sizes
    for r in got:
        assert r.target == pytest.approx(want[r.row.source])
        assert r.repeats <= 3 and len(r.positions) == r.repeats and sorted(r.positions) == r.positions
        assert all(0 <= p <= 1 for p in r.positions)
    for s in sizes:
        own = [r for r in got if r.row.source == s]
        assert abs(sum(r.size * r.repeats for r in own) - want[s]) <= max(r.size for r in own) / 2 + 1e-6
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_positions_follow_the_schedules(spark):
    rows = [(i, "w " * 10, s) for i in range(900) for s in [["a", "b", "c"][i % 3]]]
    got = mixing.mix(docs_of(spark, rows)).select("row.source", F.explode("positions").alias("p")).toPandas()
    first_half = got[got.p < 0.5].groupby("source").size() / got.groupby("source").size()
    assert first_half["a"] == pytest.approx(0.625, abs=0.02)       # falls from 1.5 to 0.5
    assert first_half["b"] == pytest.approx(0.5, abs=0.02)
    assert first_half["c"] == pytest.approx(1.375 / 3, abs=0.02)   # rises from 2.5 to 3.5


def test_training_order_keeps_columns_and_repeats(spark):
    df = docs_of(spark, [(i, "a b c", ["s", "t"][i % 2]) for i in range(40)])
    mixed = mixing.mix(df)
    out = mixing.training_order(mixed)
    assert out.schema == df.schema
    assert out.count() == mixed.agg(F.sum("repeats")).first()[0]
    again = mixing.mix(df.repartition(7))
    key = lambda d: sorted((r.doc_id, r.repeats, r.positions) for r in d.collect())
    assert key(mixed) == key(again)


def test_mix_empty_tables(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    blank = mixing.mix(docs_of(spark, [(1, None, None), (2, "", "s")])).collect()
    assert all(r.size == 0 and r.target == 0 for r in blank)


def test_schedule_arguments():
    assert [mixing.integrals(s)[-1] for s in mixing.CURRICULUM] == [1, 2, 3]
    with pytest.raises(ValueError):
        mixing.integrals([(0, 0), (1, 0)])


PAGES = "page_id long, url string, html string, payload_digest long, refers_to string"


def archive(spark, rows, **kw):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES), path, **kw)
    return warc.read_archives(spark, path)


def test_warc_round_trip_and_revisits(spark):
    big, tricky = "ä" * 600, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 60 + "\r\n\r\n"
    rows = [(1, "http://a", big), (5, "http://b/x y\r\nEvil: 1", big), (3, None, big), (7, "u", tricky), (2, "u", tricky),
            (4, "u", "small"), (6, "u", "small"), (8, "u", None), (9, "u", ""), (10, "u", "x" * 1000), (10, "u", "x" * 1000),
            (11, "u", "x" * 999), (12, "u", "x" * 999), (None, "u", big), (13, "u", "long " * 400_000)]
    got = archive(spark, rows, records_per_file=3).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    want = {(1, "revisit", 5), (5, "response", None), (3, "revisit", 5), (7, "response", None), (2, "revisit", 7),
            (None, "revisit", 5)} | {(i, "response", None) for i in (4, 6, 8, 9, 10, 11, 12, 13)}
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == want
    html = {i: t or "" for i, _, t in rows}
    for r in got:
        full = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(full), hashlib.sha1(full).hexdigest())
        assert r.payload == (html[r.page_id] if r.record_type == "response" else None)


def test_warc_empty(spark):
    assert archive(spark, []).count() == 0


def test_warc_damage_is_seen(spark):
    with pytest.raises(ValueError):
        list(warc.read_file(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


CHAT = "conv_id long, turn long, role string, text string, said string, formatted string"


def chats_of(spark, rows):
    return chat.format_chats(spark.createDataFrame([(*r, "x", "y") for r in rows], CHAT))


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "\\", "\\<|", "<", "|x", "a\\\\|<|im_start|>user\n", "", None, "\n", "<|im_end|>\n", "é \r\n", "<\\|", "$1\\0"]
    rows = [(c, t, ["user", "assistant"][t % 2], nasty[(c * 5 + t * t) % len(nasty)]) for c in range(30) for t in range(c % 6 + 1)]
    rows += [(99, 0, "ro\nle\\<|im_start|>", "x"), (99, 1, None, "y"), (98, None, "assistant", "late"), (98, 4, "user", "q"),
             (None, 0, "user", "a"), (None, 1, "assistant", "b"), (97, 0, "user", "same"), (97, 0, "user", "same")]
    got = {r.conv_id: r for r in chats_of(spark, rows).withColumn("turns", chat.parse(F.col("formatted")))
           .withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((r[1] is None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert [(t.role, t.text) for t in got[c].turns] == [(r, t) for _, _, r, t in own]
        assert got[c].loss == "".join(t for _, _, r, t in own if r == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
        assert got[c].formatted.count("<|im_start|>") == len(own)


def test_chat_long_roles_and_texts(spark):
    long = ["r" * 10**6, "\\" * 200_000, "\n<|" * 100_000]
    rows = [(i, 0, x, x) for i, x in enumerate(long)]
    got = chats_of(spark, rows).withColumn("turns", chat.parse(F.col("formatted"))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == {i: [(x, x)] for i, x in enumerate(long)}


def test_chat_machine(spark):
    letters = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    cases = {"ua": None, "sua": None, "uaua": None, "u": 1, "au": 0, "uu": 1, "sa": 1, "s": 1, "uas": 2, "xua": 0, "uax": 2}
    rows = [(i, t, letters[x], "t") for i, c in enumerate(cases) for t, x in enumerate(c)]
    got = {r.conv_id: (r.valid, r.bad_turn) for r in chats_of(spark, rows).collect()}
    assert got == {i: (bad is None, bad) for i, bad in enumerate(cases.values())}
    assert chats_of(spark, []).count() == 0


VEC = "vec_id long, embedding array<float>, score long, rank string"


def test_topk_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1) * (rng.random(6) < 0.6)]) for i in range(250)]
    rows += [(300, None), (400, [1.0, None]), (500, [1.0, math.nan]), (600, [math.inf]), (700, []), (800, [0.5]), (None, [1.0] * 6),
             (801, rows[3][1]), (802, rows[3][1]), (803, [1.0] * 9)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VEC)
    ints = topk.integer_vectors(df)
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for sizes in ({}, {"docs_per_block": 37, "queries_per_block": 2, "at_once": 1}):
        got = {}
        for r in topk.top_k(ints, F.col("vec_id") % 100 == 0, **sizes).collect():
            got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
        for q, v in good:
            if q % 100:
                continue
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q))[:10]
            assert [got[q][k + 1] for k in range(10)] == [(i, -s) for s, i in best]
        assert set(got) == {q for q, _ in good if q % 100 == 0}


def test_topk_repeated_query_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (0, [-1.0])] + [(i, [float(i)]) for i in range(1, 13)]
    ints = topk.integer_vectors(spark.createDataFrame([(*r, 1, "x") for r in rows], VEC))
    high, low = [(k, 13 - k) for k in range(1, 11)], [(k, k) for k in range(1, 11)]
    for sizes in ({}, {"docs_per_block": 3, "queries_per_block": 1}):
        got = topk.top_k(ints, F.col("vec_id") % 100 == 0, **sizes).collect()
        assert sorted((r["rank"], r.vec_id) for r in got) == sorted(high + low)


def test_topk_few_candidates_and_empty(spark):
    none = topk.integer_vectors(spark.createDataFrame([], VEC))
    assert topk.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    two = topk.integer_vectors(spark.createDataFrame([(0, [1.0], 1, "x"), (1, [2.0], 1, "x")], VEC))
    assert [(r.query_id, r.vec_id, r.score) for r in topk.top_k(two, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1024 * 2048)]


def test_mix_comes_in_training_order(spark):
    from parley.llm.queries import op2_mix_sources
    from tests.conftest import SMALL

    first = [r.first_position for r in op2_mix_sources(spark, SMALL).collect()]
    taken = [x for x in first if x is not None]
    assert len(taken) > 20 and taken == sorted(taken) and first[len(taken):] == [None] * (len(first) - len(taken))
