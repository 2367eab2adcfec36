"""N-best segmentation against enumeration of all segmentations, and exact round trips."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from parley.llm import pieces
from parley.llm.common import table
from parley.llm.queries import op4_sentencepiece_nbest
from tests.conftest import SMALL

DOC = "doc_id long, text string, ids string, scores int"


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.read_model())


def every_segmentation(model, text):
    """Scores of all ways to cut the whole normalised text, by the pieces alone."""
    norm, sp = model.sp.normalize(text), model.sp
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    low = min(score.values()) - 10

    def cuts(i):
        if i == len(norm):
            yield 0.0
        for j in range(i + 1, len(norm) + 1):
            s = score.get(norm[i:j], low if j == i + 1 else None)
            if s is not None:
                for rest in cuts(j):
                    yield s + rest

    return sorted(cuts(0), reverse=True)


def score_of(model, ids):
    """Score of a list of ids, unknown characters' bytes aside."""
    return sum(model.sp.get_score(i) for i in ids if not model.sp.is_byte(i))


@pytest.mark.parametrize("text", ["the", "of the", "  two", "a b c", "Étre là", "漢字x", "\U0001F600 ok", "abab abab", "x\ny\tz", "a   b ", "▁a"])
def test_nbest_against_enumeration(model, text):
    want = every_segmentation(model, text)
    for n in (1, 2, 5, 40):
        got = model.segment(text, n)
        assert [s.score for s in got] == want[:n]
        assert len({s.ids for s in got}) == len(got)
        for s in got:
            assert model.decode(s.ids) == text.replace(pieces.MARK, " ")
            if not any(model.sp.is_byte(i) for i in s.as_ids()):
                assert score_of(model, s.as_ids()) == s.score


def test_random_texts_against_enumeration(model):
    rng = random.Random(6)
    for _ in range(60):
        text = "".join(rng.choice("theanr é ") for _ in range(rng.randint(0, 11)))
        assert [s.score for s in model.segment(text, 6)] == (every_segmentation(model, text)[:6])


def test_first_path_is_the_viterbi_path(model):
    for text in ("internationalization of things", "aaaa aaaa aaaa", "thththth"):
        assert model.segment(text, 4)[0] == model.segment(text, 1)[0]


def test_long_and_odd_texts(model):
    for text in ("the " * 50_000, "x" * 20_000, "a\x00b", "﻿", "é" * 3000):
        got = model.segment(text, 3)
        assert model.decode(got[0].ids) == text and [s.score for s in got] == sorted((s.score for s in got), reverse=True)


def test_cache_generations(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_CHUNKS", 3)
    texts = [f"word{i} again{i % 4}" for i in range(40)]
    first = [model.segment(t, 3) for t in texts]
    assert first == [model.segment(t, 3) for t in texts]
    assert len(model.young) <= 3 and len(model.old) <= 3


def test_columns(spark, model):
    data = pieces.read_model()
    rows = [(1, "the river and"), (1, "the river and"), (2, None), (3, ""), (None, "漢 \U0001F600"), (4, "b▁c")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOC)
    got = df.select("doc_id", "text", pieces.encode(F.col("text"), data).alias("e"), pieces.encode_nbest(F.col("text"), data, 3).alias("n"))
    got = got.withColumn("back", pieces.decode(F.col("e"), data)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = model.segment(r.text, 3)
        assert list(r.e) == want[0].as_ids() and [list(i) for i in r.n.ids] == [s.as_ids() for s in want]
        assert list(r.n.scores) == [s.score for s in want] and r.back == (r.text or "").replace(pieces.MARK, " ")
    assert df.limit(0).select(pieces.encode(F.col("text"), data)).count() == 0


def test_query(spark, model):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    got = op4_sentencepiece_nbest(spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(texts) and all(r.round_trip for r in got)
    for r in got[:40]:
        want = model.segment(texts[r.doc_id], 3)
        assert list(r.scores) == [s.score for s in want]
        assert list(r.ids_sha256) == [hashlib.sha256(s.ids).hexdigest() for s in want]
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_chunks_together_as_one_by_one(monkeypatch):
    """Solved in one step for many chunks: the same ids, scores and losses, unknown characters and ties among them."""
    model, rng = pieces.PieceModel(pieces.read_model()), random.Random(12)
    chunks = sorted({"▁" + "".join(rng.choice("thenaious é漢🙂\n_x") for _ in range(rng.randint(0, 20))) for _ in range(3000)}, key=len)
    assert model.solve_all(chunks) == [model.solve(c) for c in chunks]
    texts = [" ".join(rng.choice(["then", "thén", "x" * 60, "漢字", "in", ""]) for _ in range(rng.randint(0, 9))) for _ in range(200)] + [None]
    monkeypatch.setattr(pieces, "TOGETHER", 7)
    monkeypatch.setattr(pieces, "AT_ONCE", 3)
    fresh = pieces.PieceModel(pieces.read_model())
    assert list(fresh.segments(texts, 3)) == [model.segment(t, 3) for t in texts]
