"""Every pipeline stage on the smallest table against a brute-force version of its operator."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import mixing, pieces, quality
from parley.llm.common import staged, table
from tests.conftest import SMALL
from tests.llm.test_linededup import expected as expected_lines
from tests.llm.test_native_ops import water_fill
from tests.llm.test_neardup import expected as expected_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage and the last result, as rows and as tables."""
    docs, out = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((docs, docs.collect()))
        docs = staged(stage(spark, docs, SMALL), "test-stage")
    return [*out, (docs, docs.collect())]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "mixing sources", "sentencepiece"]
    assert all(df.columns == COLUMNS for df, _ in stages[:-1])
    assert stages[-1][0].columns == [*COLUMNS, "piece_ids", "nbest_scores"]


def test_quality_stage(spark, stages):
    docs, rows = stages[0]
    model = quality.fit(docs, table(spark, SMALL, "labels"), quality.in_fold(F.col("doc_id"), 5, 0))
    p = quality.probabilities(quality.features([r.text for r in rows], model.good, model.bad), model)
    assert {r.doc_id for r in stages[1][1]} == {r.doc_id for r, x in zip(rows, p) if x >= 0.3}
    assert 0 < len(stages[1][1]) < len(rows)


def test_line_stage(stages):
    dropped = expected_lines([(r.doc_id, r.text) for r in stages[1][1]])
    want = {}
    for (doc_id, text), gone in dropped.items():
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        if left.split() or not gone:
            want[doc_id] = left
    assert {r.doc_id: r.text for r in stages[2][1]} == want
    assert all(r.n_chars == len(r.text) for r in stages[2][1])


def test_simhash_stage(stages):
    groups = expected_groups([(r.doc_id, r.text) for r in stages[2][1]])
    assert sorted(r.doc_id for r in stages[3][1]) == sorted({g for _, _, g in groups})


def test_mixing_stage(stages):
    rows = stages[3][1]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows}
    total, streams = {}, {}
    for r in sorted(rows, key=lambda r: hashlib.md5(f"{r.doc_id}:{r.text}".encode()).hexdigest()):
        streams.setdefault(r.source, []).append((total.get(r.source, 0) + size[r.doc_id] / 2, r.doc_id))
        total[r.source] = total.get(r.source, 0) + size[r.doc_id]
    kinds = {s: k % 3 for k, s in enumerate(sorted(total))}
    target = water_fill(total, {s: 1 + k for s, k in kinds.items()})
    placed = [(doc_id, (m + k * total[s]) / target[s], kinds[s]) for s in streams for m, doc_id in streams[s]
              for k in range(3) if m + k * total[s] <= target[s]]
    taken = stages[4][1]
    assert sorted(r.doc_id for r in taken) == sorted(d for d, _, _ in placed)

    def at(share, kind):  # by bisection instead of the quadratic
        (_, w0), (_, w1) = mixing.CURRICULUM[kind]
        low, high = 0.0, 1.0
        for _ in range(60):
            t = (low + high) / 2
            low, high = (t, high) if w0 * t + (w1 - w0) * t * t / 2 < share * (w0 + w1) / 2 else (low, t)
        return low

    order = [d for _, d in sorted((round(at(u, k), 9), d) for d, u, k in placed)]
    assert [r.doc_id for r in mixing.training_order(mixing.mix(stages[3][0])).collect()] == order


def test_piece_stage(stages):
    model = pieces.PieceModel(pieces.read_model())
    assert sorted(r.doc_id for r in stages[5][1]) == sorted(r.doc_id for r in stages[4][1])
    for r in stages[5][1]:
        found = model.segment(r.text, 3)
        assert list(r.piece_ids) == found[0].as_ids() and list(r.nbest_scores) == [s.score for s in found]
        assert model.sp.decode(list(r.piece_ids)) == r.text.replace(pieces.MARK, " ")


def test_run_gives_the_same(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, stages[5][1]))


def test_empty_and_odd_tables(spark, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, row string, fp int"
    labels = "doc_id long, quality int, toxic int"
    odd = [(1, None, None, None, None, "a", 1), (None, "", "en", "s", 0, "b", 2), (2, "x", None, "s", 1, "c", 3), (2, "x", None, "s", 1, "c", 3),
           (3, "five words are in here\n" * 3, "en", None, None, None, None), (4, "long " * 30000, "en", "s", 5, "d", 4)]
    for name, rows, given in (("none", [], []), ("odd", odd, [(2, 1, 0), (3, 0, 0), (None, None, None)])):
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(given, labels).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "fp", "piece_ids", "nbest_scores"]
        assert (len(got.collect()) == 0) == (name == "none")
