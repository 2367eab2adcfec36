"""Text cleaning: FIXTURES.md section 3 rows and properties (WIN-1, SCL-2..7, AGG-1, SRT-1)."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.constants import PUNCT_MAP
from parley.operators import repeats
from parley.operators.names import load_names, mask_names
from parley.operators.repeats import filter_repeats
from parley.operators.turns import interleave, speech_by_role
from parley.plans import sqlkit as K


def _rep(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = {r["id"]: r["text"] for r in filter_repeats(df, "id", "text", **kw).collect()}
    return [out[i] for i in range(len(texts))]


def test_repeats_fixtures(spark):
    rows = {
        "a b a b a b a b": "a b a b a b a b",              # four places each: not enough
        "a b a b a b a b a": "b b b b",                    # a touches five places at gap 2
        "x x x c d e f g h i x x x": "c d e f g h i",      # two runs of gap 1, six places together
        "x x x x x": "",
        "a b": "a b",
        "oi tudo oi bem oi sim oi ok oi até logo": "tudo bem sim ok até logo",
        "q q q q r r r r": "q q q q r r r r",
        "p 1 p 2 p 3 4 p 5 6 p 7 8 p": "p 1 p 2 p 3 4 p 5 6 p 7 8 p",  # gaps 2 2 3 3 3: sets of 3 and 4
        "p 1 p 2 p 3 p 4 5 p 6 7 p": "p 1 p 2 p 3 p 4 5 p 6 7 p",      # gaps 2 2 2 3 3: sets of 4 and 3
        "p 1 p 2 p 3 p 4 p 5 6 p 7 8 p": "1 2 3 4 5 6 p 7 8 p",        # the set of gap 2 alone goes
        "": "", "   ": "",
    }
    assert _rep(spark, [*rows, None]) == [*rows.values(), None]


def test_repeats_keep_first(spark):
    assert _rep(spark, ["x x x x x"], keep_first=True) == ["x"]


def test_repeats_by_another_route(spark):
    """Random texts against SQL that builds the sets of places."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    src = pd.DataFrame({"id": range(len(texts)), "text": texts})  # noqa: F841  (read by DuckDB)
    want = duckdb.sql(K.with_ctes([("given", "SELECT * FROM src")] + K.repeats_steps("given"), "SELECT id, text FROM r_out ORDER BY id")).fetchall()
    assert _rep(spark, texts) == [t for _, t in want]


def test_repeats_in_small_batches(monkeypatch):
    texts = pd.Series(["x x x x x", None, "a b", "", "y y y y y y z"])
    whole = repeats.without_repeats(texts, 4, 5, False).tolist()
    monkeypatch.setattr(repeats, "WORDS_AT_ONCE", 1)
    assert repeats.without_repeats(texts, 4, 5, False).tolist() == whole == ["", None, "a b", "", "z"]


def _col(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


def test_punctuation(spark):
    assert _col(spark, tx.normalise_punct, ["«Oi»…", "a—b", "x．y", "１"]) == ['"Oi"...', "a - b", "x. y", "１"]
    assert _col(spark, lambda c: tx.normalise_punct(c, compat=True), ["１"]) == ['"']


def test_every_punctuation_entry(spark):
    assert _col(spark, lambda c: tx.normalise_punct(c, compat=True), [src for src, _ in PUNCT_MAP]) == [dst for _, dst in PUNCT_MAP]


def test_repair_survives_a_final_line_separator(spark):
    assert _col(spark, tx.repair_unicode, ["cafÃ©\u2028", "cafÃ©\n", "Ã© \u0085", "Ã©\u0085"]) == ["café\n", "café\n", "é \n", "Ã©\n"]


def _damaged(text):
    return text.encode().decode("latin-1")


def test_repair_of_parts(spark):
    """Damage is undone where it is; what only looks a little like it stays; a second call changes nothing."""
    pairs = [(_damaged("São João") + " — já", "São João — já"), ("漢 " + _damaged("naïve café"), "漢 naïve café"),
             ("“" + _damaged("niño") + "” und »Ü« Ô", "\"niño\" und »Ü« Ô"), (_damaged("preço 5 €") + " …", "preço 5 € …"),
             ("… " + _damaged("漢字 🙂"), "… 漢字 🙂"), ("é — è à ç", "é — è à ç"), ("— Ã", "— Ã"), ("— " + "x" * 50, "— " + "x" * 50),
             ("… " + _damaged("é")[:1], "… Ã"), ("— " + _damaged("ééé") + "é", "— " + _damaged("ééé") + "é"), (None, None), ("", "")]
    once = _col(spark, tx.repair_unicode, [a for a, _ in pairs])
    assert once == [b for _, b in pairs]
    assert _col(spark, tx.repair_unicode, once) == once


def test_digits(spark):
    assert _col(spark, tx.strip_digits, ["CPF 123.456 ok 7", "a٣b３c"]) == ["CPF . ok ", "abc"]


def test_unicode_repair(spark):
    got = _col(spark, tx.repair_unicode,
               ["CafÃ©", "漢字 Ã©", "a &amp; b", "ﬁm", "“x” ‘y’", "a\r\nb", "Ａ１", "x\x07y", "<b>&amp;</b>"])
    assert got == ["Café", "漢字 é", "a & b", "fim", "\"x\" 'y'", "a\nb", "A1", "xy", "<b>&amp;</b>"]


def test_split_words_unicode_blanks(spark):
    df = spark.createDataFrame([(" a b　c  d ",)], "t string")
    assert df.select(tx.split_words("t")).first()[0] == ["a", "b", "c", "d"]


def _mask(spark, names, texts, compat):
    """Both ways, by set and by join, must agree."""
    nm = spark.createDataFrame([(n,) for n in names], "name string")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = []
    for small in (1000, 0):
        out = {r["id"]: r["text"] for r in mask_names(df, "id", "text", nm, compat=compat, small=small).collect()}
        found.append([out[i] for i in range(len(texts))])
    assert found[0] == found[1]
    return found[0]


def test_no_name_is_left_out(spark):
    many = spark.createDataFrame([(f"Name{i}", "a", i) for i in range(501)], "name string, list string, rank int")
    names = load_names(many)
    df = spark.createDataFrame([(1, "name500 and NAME0, nobody")], "id long, text string")
    assert mask_names(df, "id", "text", names).first()["text"] == "NOME and NOME, nobody"
    assert load_names(many, per_list=500).count() == 500


@pytest.mark.parametrize("compat", [False, True])
def test_mask_ways_agree_on_random_texts(spark, compat):
    rng = random.Random(3)
    bits = ["ana", "Ana", "ÁNA", "(ana)", "ana.ana", "bea", "me", "ME", "x", "\u00a0", "\u2028", "\x1c", " ", "_ana_", "a-n-a", "não", "É"]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", "", "\t"]) for _ in range(12)) for _ in range(150)]
    _mask(spark, ["ana", "bea", "me", "anaana", "não"], texts, compat)


def test_mask_fixtures(spark):
    assert _mask(spark, ["ana"], ["Ana ligou para Anatel", "(Ana), ana.", None], False) == \
        ["NOME ligou para Anatel", "(NOME), NOME.", None]
    assert _mask(spark, ["ana"], ["Ana ligou para Anatel"], True) == ["NOME ligou para NOMEtel"]
    assert _mask(spark, ["atila"], ["Átila chegou"], False) == ["NOME chegou"]
    assert _mask(spark, ["atila"], ["Átila chegou"], True) == ["Átila chegou"]


def test_mask_compat_repeats_are_sequential(spark):
    # "me" is inside the mask word, so the second occurrence re-masks the inserted masks.
    assert _mask(spark, ["me"], ["ME x ME"], True) == ["NONOME x NONOME"]


def test_speech_concat_and_interleave(spark):
    rows = [(1, 0.0, None, "customer", "a"), (1, 1.0, None, "customer", None), (1, 2.0, None, "customer", "b"),
            (1, 0.0, None, "agent", "z")]
    t = spark.createDataFrame(rows, "call_id long, start_s double, end_s double, role string, text string")
    sp = {r["role"]: r["speech"] for r in speech_by_role(t, block_seconds=1.0).collect()}
    assert sp == {"customer": "a b", "agent": "z"}
    order = [r["role"] for r in interleave(t.where("role = 'customer'"), t.where("role = 'agent'")).collect()]
    assert order[:2] == ["agent", "customer"]


def test_nfc(spark):
    assert _col(spark, tx.nfc_normalise, ["Café", None]) == ["Café", None]


def test_texts_become_objects_in_slices(spark):
    df = spark.range(100).coalesce(1).select("id", F.repeat(F.lit("x"), 100_000).alias("t"))
    told = df.select(tx.by_slices(lambda s: pd.Series([str(len(s))] * len(s)))("t").alias("n")).collect()
    assert len(told) == 100 and max(int(r.n) for r in told) <= 11


def test_repair_names_its_steps_once(spark):
    plan = spark.range(1).select(tx.repair_unicode(F.col("id").cast("string")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") <= 3
