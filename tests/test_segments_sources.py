"""Segments, signals, sources and streaming (WIN-2, CLU-1, SCL-15/16, SRC-1, SRC-3, STR-1)."""

import hashlib
import itertools
import os
import random
import tempfile

import numpy as np
import pandas as pd
import pytest

from parley.constants import FEATURES
from parley.functions import signal as sg
from parley.operators import segments as seg
from parley.operators.turns import role_filter
from parley.plans.dataset import write_stage
from parley.sources.files import chunk_problem, chunks_to_turns, read_transcripts
from parley.streaming.ingest import ingest_available


def _cp(spark, seqs):
    rows = [(c, i, l) for c, labs in enumerate(seqs) for i, l in enumerate(labs)]
    df = spark.createDataFrame(rows, "call_id long, seg long, label int")
    return {r.call_id: (r.change_seg, r.start_s, r.too_short) for r in seg.change_point(df).collect()}


def test_change_point_fixtures(spark):
    got = _cp(spark, [[0, 0, 0, 1, 1, 1], [1, 1, 1, 0, 0, 0], [0, 0, 0, 0, 0], [0, 1, 0]])
    assert got[0] == (3, 15, False) and got[1] == (3, 15, False)
    assert got[2] == (2, 10, False) and got[3] == (None, 0, True)


def _brute_two_means(vals):
    order = sorted(range(len(vals)), key=lambda i: (vals[i], i))
    best, best_k = None, None
    for k in range(1, len(vals)):
        a, b = [vals[i] for i in order[:k]], [vals[i] for i in order[k:]]
        if max(a) == min(b):
            continue
        ss = sum((x - sum(a) / len(a)) ** 2 for x in a) + sum((x - sum(b) / len(b)) ** 2 for x in b)
        if best is None or ss < best - 1e-9:
            best, best_k = ss, k
    lab = [0] * len(vals)
    if best_k is not None:
        for i in order[best_k:]:
            lab[i] = 1
    return lab


def test_two_means_1d_is_optimal(spark):
    rng = random.Random(5)
    calls = [[rng.randint(0, 20) for _ in range(rng.randint(1, 12))] for _ in range(40)]
    rows = [(c, i, v) for c, vs in enumerate(calls) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "call_id long, seg long, v long")
    got = {}
    for r in seg.two_means_1d(df, "call_id", "seg", "v").collect():
        got.setdefault(r.call_id, {})[r.seg] = r.label
    for c, vs in enumerate(calls):
        assert [got[c][i] for i in range(len(vs))] == _brute_two_means(vs)


def test_two_means_1d_large_sums(spark):
    rows = [(1, i, v) for i, v in enumerate([2_000_000_000, 2_000_000_001, 4_000_000_000_000, 4_000_000_000_001])]
    df = spark.createDataFrame(rows, "call_id long, seg long, v long")
    assert [r.label for r in seg.two_means_1d(df, "call_id", "seg", "v").orderBy("seg").collect()] == [0, 0, 1, 1]


def _write(spark):
    return lambda df, name: write_stage(spark, df, name)


def test_two_means_many_dims(spark):
    rows = [(1, i, float(i >= 5), float(i >= 5) * 2, 0.0) for i in range(10)] + [(2, 0, 1.0, 1.0, 1.0)] + [(3, i, 5.0, 5.0, None) for i in range(4)]
    df = spark.createDataFrame(rows, "call_id long, seg long, a double, b double, key double")
    for standardise in (False, True):
        out = seg.two_means(df, "call_id", "seg", ["a", "b", "key"], _write(spark), standardise)
        got = {(r.call_id, r.seg): r.label for r in out.collect()}
        assert [got[(1, i)] for i in range(10)] == [0] * 5 + [1] * 5 and got[(2, 0)] == 0 and {got[(3, i)] for i in range(4)} == {0}


def test_two_means_is_a_fixed_point(spark):
    """Converged: every segment is nearest to its own cluster's mean."""
    rng = np.random.default_rng(4)
    x = {(c, i): rng.normal(size=18) + (i % 3 == 0) * rng.normal(size=18) for c in range(6) for i in range(40)}
    names = [f"f{j}" for j in range(18)]
    df = spark.createDataFrame([(c, i, *map(float, v)) for (c, i), v in x.items()], "call_id long, seg long, " + ", ".join(f"{n} double" for n in names))
    lab = {(r.call_id, r.seg): r.label for r in seg.two_means(df, "call_id", "seg", names, _write(spark)).collect()}
    for c in range(6):
        assert lab[c, 0] == 0
        means = [np.mean([x[c, i] for i in range(40) if lab[c, i] == k], axis=0) for k in (0, 1)]
        for i in range(40):
            d = [((x[c, i] - m) ** 2).sum() for m in means]
            assert d[lab[c, i]] <= d[1 - lab[c, i]] + 1e-9


def _inertia(x, lab):
    return sum(((x[lab == k] - x[lab == k].mean(axis=0)) ** 2).sum() for k in (0, 1) if (lab == k).any())


def _plain_lloyd(x, a, b):
    centres = [x[a], x[b]]
    while True:
        d = [((x - c) ** 2).sum(axis=1) if c is not None else np.full(len(x), np.inf) for c in centres]
        lab = (d[1] < d[0]).astype(int)
        after = [x[lab == k].mean(axis=0) if (lab == k).any() else None for k in (0, 1)]
        if all((p is None) == (q is None) and (p is None or (p == q).all()) for p, q in zip(centres, after)):
            return lab
        centres = after


def test_two_means_takes_the_best_start(spark):
    """Never worse than any of its starts run one by one, and better than the worst of them somewhere."""
    rng, calls = np.random.default_rng(8), {}
    for c in range(8):
        n = int(rng.integers(3, 60))
        calls[c] = np.round(rng.normal(size=(n, 3)) + rng.integers(0, 3, (n, 1)) * 3, 3)
    df = spark.createDataFrame([(c, i, *map(float, v)) for c, x in calls.items() for i, v in enumerate(x)], "call_id long, seg long, a double, b double, c double")
    lab = {(r.call_id, r.seg): r.label for r in seg.two_means(df, "call_id", "seg", ["a", "b", "c"], _write(spark)).collect()}
    gains = 0
    for c, x in calls.items():
        got = _inertia(x, np.array([lab[c, i] for i in range(len(x))]))
        plain = []
        for s in range(10):
            a = min(range(len(x)), key=lambda i: (hashlib.md5(f"{s}:{i}".encode()).hexdigest(), i))
            b = max(range(len(x)), key=lambda i: (((x[i] - x[a]) ** 2).sum(), -i))
            plain.append(_inertia(x, _plain_lloyd(x, a, b)))
        assert got == pytest.approx(min(plain))
        gains += max(plain) > min(plain) + 1e-9
    assert gains > 0


def test_two_means_ends_with_an_error(spark):
    df = spark.createDataFrame([(1, i, float(i % 7)) for i in range(30)], "call_id long, seg long, a double")
    with pytest.raises(RuntimeError, match="call 1"):
        seg.two_means(df, "call_id", "seg", ["a"], _write(spark), most_steps=1)


def test_framing(spark):
    df = spark.createDataFrame([([float(i) for i in range(12)],)], "s array<double>")
    fr, bl = df.select(sg.frames("s", 5), sg.blocks("s", 5)).first()
    assert [len(x) for x in fr] == [5, 5] and [len(x) for x in bl] == [5, 5, 2]
    ch = df.select(sg.channel("s", 0), sg.channel("s", 1)).first()
    assert ch[0] == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0] and ch[1][0] == 1.0


def test_transcript_csv_scan(spark):
    d = tempfile.mkdtemp(prefix="parley-csv-", dir="/tmp")
    texts = ['disse "oi", sim', "duas\nlinhas", "tchau"]
    pd.DataFrame({"start": [0.0, 1.5, 3.0], "end": [1.0, None, 4.0], "transcription": texts,
                  "role": ["cliente", "atendente", "robot"]}).to_csv(os.path.join(d, "call1.csv"), index=False)
    open(os.path.join(d, "notes.txt"), "w").write("ignored")
    got = read_transcripts(spark, d).orderBy("start_s")
    assert [(r.call_id, r.start_s, r.end_s, r.text, r.role) for r in got.collect()] == [
        ("call1", 0.0, 1.0, texts[0], "customer"), ("call1", 1.5, None, texts[1], "agent"), ("call1", 3.0, 4.0, texts[2], "robot")]
    assert role_filter(got, "customer").count() == 1


def test_only_the_files_of_a_call_are_opened(spark):
    d = tempfile.mkdtemp(prefix="parley-csv-", dir="/tmp")
    for call in ("a", "b,1", "c[x]", "d", "e f+g %2B"):
        pd.DataFrame({"start": [0.0], "end": [1.0], "transcription": [call], "role": ["cliente"]}).to_csv(os.path.join(d, f"{call}.csv"), index=False)
    got = read_transcripts(spark, d, calls=["b,1", "c[x]", "nobody"])
    assert {(r.call_id, r.text) for r in got.collect()} == {("b,1", "b,1"), ("c[x]", "c[x]")}
    assert len(got.inputFiles()) == 2
    assert {r.call_id for r in read_transcripts(spark, d).collect()} == {"a", "b,1", "c[x]", "d", "e f+g %2B"}


def test_arguments_are_checked(spark):
    for wrong in (lambda: sg.frames("s", 0), lambda: sg.blocks("s", -1), lambda: sg.channel("s", 2), lambda: sg.channel("s", 0, 0),
                  lambda: seg.with_segments(spark.range(1).toDF("t"), 0), lambda: read_transcripts(spark, "")):
        with pytest.raises(ValueError):
            wrong()


def test_channels_of_odd_signals(spark):
    for n in range(6):
        df = spark.createDataFrame([([float(i) for i in range(n)],)], "s array<double>")
        assert df.select(sg.interleave_channels(sg.channel("s", 0), sg.channel("s", 1))).first()[0] == [float(i) for i in range(n)]


def test_chunk_list(spark):
    df = spark.createDataFrame([(1, '[{"timestamp": [0.0, 2.5], "text": "a"}, {"timestamp": [2.5, null], "text": "b"}]')],
                               "call_id long, j string")
    got = [(r.seq, r.start_s, r.end_s, r.text) for r in chunks_to_turns(df, "j", ["call_id"]).collect()]
    assert got == [(0, 0.0, 2.5, "a"), (1, 2.5, None, "b")]


def test_chunk_problems(spark):
    df = spark.createDataFrame([("[]",), (None,), ("[{",), ("nope",)], "j string")
    assert [r[0] for r in df.select(chunk_problem("j")).collect()] == [None, "null_json", "bad_json", "bad_json"]


def test_incremental_ingest(spark):
    src = tempfile.mkdtemp(prefix="parley-src-", dir="/tmp")
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    sink, ckpt = os.path.join(root, "sink"), os.path.join(root, "ckpt")
    kinds = "k long, v string"
    st = spark.createDataFrame([], kinds).schema
    run = lambda: ingest_available(spark, os.path.join(src, "*"), "*.parquet", st, lambda df: df, sink, ckpt)
    add = lambda rows, name: spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(os.path.join(src, name))
    rows = lambda df: sorted((r.k, r.v) for r in df.collect())
    add([(1, "a"), (None, "n")], "p1")
    assert rows(run().fillna(0)) == [(0, "n"), (1, "a")]
    add([(1, "other text"), (3, "c")], "p2")   # a key that was there already
    first = rows(run().fillna(0))
    assert first == [(0, "n"), (1, "a"), (1, "other text"), (3, "c")]
    assert rows(run().fillna(0)) == first  # nothing new
    # a batch whose commit was lost is run again with the same number, and replaces what it left
    commits = os.path.join(ckpt, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    assert rows(run().fillna(0)) == first


def test_incremental_ingest_query_keeps_rows_without_id(spark, tmp_path):
    from parley.plans.catalog import q_incremental_ingest
    from parley.schemas import TABLE_SCHEMAS
    from parley.sources.tables import read_table
    from tests.conftest import SMALL

    kind = TABLE_SCHEMAS["conversations"]
    rows = [{"conv_id": c, "turn": t, "role": "user", "text": "hello there"} for c, t in ((1, 0), (2, 0), (None, 7), (None, 8))]
    spark.createDataFrame([tuple(r.get(f.name) for f in kind) for r in rows], kind).write.parquet(f"{tmp_path}/conversations.parquet")
    read_table(spark, SMALL, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = q_incremental_ingest(spark, str(tmp_path)).collect()
    assert sorted((r.call_id or 0, r.start_s) for r in got) == [(0, 7.0), (0, 8.0), (1, 0.0), (2, 0.0)]


def test_incremental_ingest_of_nothing(spark):
    src = tempfile.mkdtemp(prefix="parley-src-", dir="/tmp")
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    st = spark.createDataFrame([], "k long").schema
    assert ingest_available(spark, src, "*.parquet", st, lambda df: df, f"{root}/none", f"{root}/none-ckpt").count() == 0


def test_spectral_functions(spark):
    df = spark.createDataFrame([([0.0, 1.0, 1.0, 0.0],), ([0.0, 0.0],)], "m array<double>")
    r = df.select(sg.centroid("m"), sg.rolloff("m", 0.99), sg.rolloff("m", 0.01)).collect()
    assert r[0][0] == 1.5 and r[0][1] == 2 and r[0][2] == 1
    assert r[1][0] is None and r[1][1] is None


def test_label_flip_keeps_change_point(spark):
    seqs = [list(p) for p in itertools.islice(itertools.product([0, 1], repeat=7), 0, 128, 9)]
    a = _cp(spark, seqs)
    b = _cp(spark, [[1 - x for x in s] for s in seqs])
    assert a == b


def test_manifest_prompt_and_features(spark):
    from parley.sources.files import manifest, read_features, read_prompt

    d = tempfile.mkdtemp(prefix="parley-files-", dir="/tmp")
    for name in ("a.wav", "b.wav", "c.txt"):
        open(os.path.join(d, name), "wb").write(b"x" * 10)
    m = manifest(spark, d, glob="*.wav")
    assert sorted(os.path.basename(r.path) for r in m.collect()) == ["a.wav", "b.wav"]
    assert "content" not in m.columns
    p = os.path.join(d, "prompt.txt")
    open(p, "w").write("line one\nline two\n")
    assert read_prompt(spark, path=f"file://{p}").first().prompt == "line one\nline two\n"
    assert read_prompt(spark, text=p).first().prompt == p
    with pytest.raises(ValueError):
        read_prompt(spark)
    fd = tempfile.mkdtemp(prefix="parley-feat-", dir="/tmp")
    x = np.arange(36.0).reshape(2, 18)
    pd.DataFrame(x, columns=FEATURES).to_csv(os.path.join(fd, "features_x.opus.csv"), index=False)
    pd.DataFrame(x + 1, columns=FEATURES).to_csv(os.path.join(fd, "features_y.opus.csv"), index=False)
    pd.DataFrame(x, columns=FEATURES).to_csv(os.path.join(fd, "features_z.tsv"), index=False, header=False, sep="\t")
    got = read_features(spark, fd, calls=["x.opus"]).orderBy("seg").collect()
    assert [(r.call_id, r.seg, [r[f] for f in FEATURES]) for r in got] == [("x.opus", i, x[i].tolist()) for i in (0, 1)]
    assert read_features(spark, fd).count() == 4
    tabs = read_features(spark, fd, tab_separated=True).orderBy("seg").collect()
    assert [(r.call_id, r.seg, r.meanfreq, r.max_rolloff_001) for r in tabs] == [("z", 0, 0.0, 17.0), ("z", 1, 18.0, 35.0)]


def test_cost_prices_output_tokens_at_completion_price(spark):
    from parley.operators.model_stage import price_table, usage_cost

    u = spark.createDataFrame([("combine", "base", "chat", 1000, 1000), ("embed", "base", "embed", 1000, 0)],
                              "stage string, model string, kind string, tokens_in long, tokens_out long")
    got = {(r.stage, r.model): r.cost for r in usage_cost(u, price_table(spark)).collect()}
    assert got[("combine", "base")] == 0.0035 and got[("embed", "base")] == 0.0001
    assert got[(None, None)] == 0.0036
    strange = u.union(spark.createDataFrame([("combine", "odd", "video", 7, 5)], u.schema))
    total = [r for r in usage_cost(strange, price_table(spark)).collect() if r.stage is None][0]
    assert (total.tokens_in, total.cost, total.n_unpriced) == (2007, 0.0036, 1)


def test_key_normalisation(spark):
    from parley.sources.sinks import base_name, normalise_key

    cases = {"http://a/b/features_x.opus.csv?v=1": "x.mp3", "s3://b/y.opus#t": "y.mp3", "z.csv": "z", "features_features_q.csv.csv": "features_q.csv",
             "plain": "plain", "d/": ""}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert [r[0] for r in df.select(normalise_key(base_name("url"))).collect()] == list(cases.values())
