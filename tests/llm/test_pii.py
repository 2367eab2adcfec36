"""Personal data: base spans against the patterns as they stand, the tagger's gradient, decoding by
enumeration, other notations held out, and clean texts."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from parley.llm import pii
from parley.llm.common import table
from parley.llm.queries import op11_personal_data
from tests.conftest import SMALL
from tests.llm.test_runs import DOC

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            number = [int(c) for c in m.group() if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(number)))
                if not 12 <= len(number) <= 19 or total % 10:
                    continue
            if kind == 3 and not 9 <= len(number) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(table(spark, SMALL, "documents"))


def test_base_spans_are_the_patterns():
    rng = random.Random(3)
    parts = ["a", "Z9", "@", ".", "-", "+", " ", "1", "12", "255", "256", "(", ")", "4111 1111 1111 1111", "+1 (017) 555-7713", "é", "\n", "١", "000"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert sorted((s[1], s[0], s[2]) for s in pii.base_spans(text)) == plain_base(text), text


def test_base_spans_of_long_stretches():
    for text in ("a" * 10**6, "1" * 10**6, "1." * 10**5, "a@" * 10**5, "+1 " * 10**5, "0" * 10**6 + ".1.1.1", "a.b@c" * 10**5):
        pii.base_spans(text)
    assert pii.base_spans("0" * 10**5 + ".1.1.1") == [(1, 0, 10**5 + 6)]


def random_windows(rng, n, length):
    x = rng.integers(32, 128, (n, length))
    x[0, length // 2:] = pii.PAD
    y = np.zeros((n, length), np.int64)
    y[1, 2:5] = (3, 4, 4)
    y[2, 0] = 1
    return x, y


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    model, (x, y) = pii.new_model(3, 1), random_windows(rng, 3, 9)
    _, gradient = pii.loss_and_gradient(model, x, y)
    for a, d in zip(pii._arrays(model), pii._arrays(gradient)):
        places = [tuple(rng.integers(0, n) for n in a.shape) for _ in range(6)]
        if a is model.by_symbol:
            places = [(w, x[1, 3], g) for w, _, g in places]
        for place in places:
            held, losses = a[place], []
            for step in (1e-5, -1e-5):
                a[place] = held + step
                losses.append(pii.loss_and_gradient(model, x, y)[0])
            a[place] = held
            assert abs((losses[0] - losses[1]) / 2e-5 - d[place]) < 1e-6 * (1 + abs(d[place]))


def test_likelihood_and_decoding_by_enumeration():
    rng = np.random.default_rng(2)
    model = pii.new_model(3, 5)
    model.step[:] = rng.normal(0, 1, model.step.shape)
    x = rng.integers(32, 128, (1, 4))
    e = pii.emissions(model, x)[0]

    def score(tags):
        steps = sum(model.step[a, b] + pii.ALLOWED[a, b] for a, b in itertools.pairwise(tags))
        return pii.FIRST[tags[0]] + sum(e[i, t] for i, t in enumerate(tags)) + steps

    every = list(itertools.product(range(pii.TAGS), repeat=4))
    scores = np.array([score(t) for t in every])
    best = every[int(scores.argmax())]
    assert pii.viterbi(model, e[None])[0].tolist() == list(best)
    y = np.array([[0, 3, 4, 0]])
    assert pii.loss_and_gradient(model, x, y)[0] == pytest.approx(np.log(np.exp(scores).sum()) - score(y[0]))
    none, one = score((0, 0, 0, 0)), score((0, 3, 4, 0))
    assert pii.log_odds(model, e, (1, 1, 3)) == pytest.approx(one - none)


def test_windows_hold_every_short_span():
    rng = random.Random(1)
    for n in [1, 63, 64, 128, 129, 192, 193, 1000]:
        text = ["x"] * n
        for _ in range(3):
            text[rng.randrange(n)] = "7"
        text = "".join(text)
        starts = pii.windows_of(text)
        whole = range(0, max(1, n - pii.WINDOW + pii.STRIDE), pii.STRIDE)
        assert starts == [s for s in whole if "7" in text[s:s + pii.WINDOW]]
        for m in re.finditer("7", text):
            a, b = max(0, m.start() - 30), min(n, m.start() + 30)
            assert any(s <= a and b <= s + pii.WINDOW for s in starts)


def test_best_set_by_enumeration():
    rng = random.Random(4)
    for _ in range(300):
        spans = {(rng.randrange(4), a, a + rng.randint(1, 6)) for a in (rng.randrange(14) for _ in range(7))}
        weighed = [(rng.random(), s) for s in sorted(spans)]
        chosen = pii.best_set(weighed)
        apart = lambda some: all(a[2] <= b[1] for a, b in itertools.pairwise(sorted(some, key=lambda s: s[1])))
        weight = dict((s, w) for w, s in weighed)
        assert apart(chosen)
        most = max(sum(weight[s] for s in some) for n in range(8) for some in itertools.combinations(weight, n) if apart(some))
        assert sum(weight[s] for s in chosen) == pytest.approx(most)


def test_other_notations_and_clean_texts(model, spark):
    """Values that the patterns miss are found; texts without personal data are left alone."""
    rng = random.Random(77)
    words = [w for r in table(spark, SMALL, "documents").where("text is not null").collect() for w in r.text.split()]
    words = [w for w in words if w.isalpha()]
    some = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    texts, wanted = [], []
    while len(texts) < 500:
        kind = rng.randrange(4)
        value, before = pii.written(rng, kind, words), some(60)
        text = f"{before} {value} {some(40)}"
        base = pii.base_spans(text)
        span = (kind, len(before) + 1, len(before) + 1 + len(value))
        if not any(a < span[2] and span[1] < b for _, a, b in base):
            texts.append((text, base))
            wanted.append(span)
    found = pii.Tagger(model).added(texts)
    for kind in range(4):
        hits = [w in f for w, f in zip(wanted, found) if w[0] == kind]
        assert sum(hits) >= 0.85 * len(hits), (pii.KINDS[kind], sum(hits), len(hits))
    clean = [(f"{some(30)} {pii.decoy(rng)} {some(30)}", []) for _ in range(500)]
    clean = [(t, b) for t, b in clean if not pii.base_spans(t)]
    assert sum(map(len, pii.Tagger(model).added(clean))) <= 0.02 * len(clean)


def test_windows_together_do_not_matter(model, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["word", "(055) 123-4567", "é", "10.0.0 .1", "x@ y.org"]) for _ in range(rng.randint(0, 80))) for _ in range(30)]
    based = [(t, pii.base_spans(t)) for t in texts]
    whole = pii.Tagger(model).added(based)
    monkeypatch.setattr(pii, "TOGETHER", 3)
    assert [pii.Tagger(model).added([b])[0] for b in based] == whole
    assert sum(map(len, whole)) > 10


def test_edges(spark, model, monkeypatch):
    monkeypatch.setattr(pii, "CHARS", 40)
    rows = [(1, None), (2, ""), (None, "mail a.b@c.de now"), (4, "x" * 300), (5, "4111 1111 1111 1111"), (5, "4111 1111 1111 1111"), (6, "é" * 200 + " 10.1.2.3")]
    docs = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], DOC)
    found = pii.find(docs, model)
    got = sorted((r.doc_id or 0, tuple(tuple(s) for s in r.spans)) for r in found.collect())
    assert got == [(0, (("email", 5, 13, True),)), (1, ()), (2, ()), (4, ()), (5, (("card", 0, 19, True),)), (5, (("card", 0, 19, True),)),
                   (6, (("ip", 201, 209, True),))]
    joined = found.where("doc_id is null").select(pii.as_text(pii.F.col("spans")).alias("t"),
                                                  pii.masked(pii.F.lit("mail a.b@c.de now"), pii.F.col("spans")).alias("m")).first()
    assert tuple(joined) == ("email:5:13", "mail <email> now")
    assert pii.find(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(pii, "train", lambda x, y, seed: seen.update(n=len(x)) or pii.new_model(2, seed))
    docs = spark.createDataFrame([(1, None, 1, "x", "y")], DOC)
    pii.fit(docs, windows=50)
    assert seen == {"n": 50}


def test_learning_from_spans_longer_than_a_window():
    # a run of digits, as in a table of figures, is longer than the windows that train
    for text in ("9" * 120, "call 12 34 56 " + "12 34 56 " * 30, "a" * 150 + "@b.com"):
        x, y = pii.labelled_windows([text], 12, 11)
        assert x.shape == y.shape == (12, pii.LEARNED) and (y[::3] > 0).any()


def test_query_on_given_table(spark):
    got = {r.doc_id: r for r in op11_personal_data(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        base, r = plain_base(d.text), got[d.doc_id]
        stated = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(stated).encode()).hexdigest()
        assert set(stated) <= set(r.spans.split(",")) and (base or not r.spans)
