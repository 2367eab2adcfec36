"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from parley.llm import runs
from parley.llm.common import table
from parley.llm.queries import op12_periodic_runs
from tests.conftest import SMALL

DOC = "doc_id long, text string, n_words long, runs string, collapsed string"
WHITE = " \t\n\x0b\x0c\r"


def plain_runs(words, power=4, least=6):
    """Every period on its own: the longest stretches of words that equal the word q later."""
    found = {}
    for q in range(1, len(words) // power + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                if i + q - start >= max(least, power * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_words(text):
    for c in WHITE:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_row(doc_id, text):
    words = plain_words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = None
    for s, m, q in found:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("stretch,in_step", [(1, 1), (3, 0), (7, 4), (1 << 16, 32)])
def test_runs_of_random_words(monkeypatch, stretch, in_step):
    monkeypatch.setattr(runs, "STRETCH", stretch)
    monkeypatch.setattr(runs, "IN_STEP", in_step)
    rng = random.Random(stretch)
    for _ in range(25 if stretch < 7 else 150):
        texts = []
        for _ in range(rng.randint(1, 3)):
            n, letters = rng.choice([0, 1, 5, 6, 10, 40, 90]), rng.choice([1, 2, 3, 9])
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n else 0):
                a = rng.randrange(n)
                p, m = rng.randint(1, max(1, (n - a) // 3)), rng.randint(0, n - a)
                words[a:a + m] = [words[a + i % p] for i in range(m)]
            texts.append(words)
        power, least = rng.choice([2, 3, 4]), rng.choice([2, 6])
        for words, found in zip(texts, runs.runs_of(texts, power, least)):
            assert sorted((s, e - s, p) for s, e, p in found.tolist()) == plain_runs(words, power, least)


def test_appended_in_any_pieces():
    rng = np.random.default_rng(4)
    words = np.concatenate([rng.integers(0, 3, 500), np.tile(rng.integers(0, 9, 37), 11), rng.integers(0, 2, 300)])
    whole = runs.Catchers()
    whole.append(words)
    pieces = runs.Catchers()
    for part in np.split(words, np.sort(rng.integers(0, len(words), 60))):
        pieces.append(part)
    assert pieces.finish().tolist() == whole.finish().tolist() != []


def test_equal_names_of_different_blocks(monkeypatch):
    monkeypatch.setattr(runs, "_mix", lambda left, right: (left + right) * np.uint64(0))
    rng = random.Random(3)
    for _ in range(40):
        words = [b"%d" % rng.randrange(2) for _ in range(30)]
        found = [(s, e - s, p) for s, e, p in runs.runs_of([words])[0].tolist()]
        assert all(words[s:s + m - p] == words[s + p:s + m] for s, m, p in found)


def test_long_texts():
    one = [b"a"] * 30_000
    assert runs.runs_of([one])[0].tolist() == [[0, 30_000, 1]]
    turn = [b"x%d" % i for i in range(5_000)]
    assert runs.runs_of([[b"y"] + turn * 4 + turn[:7] + [b"z"]])[0].tolist() == [[1, 20_008, 5_000]]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (5, "x x x x x"), (6, "b\x0bb\x0cb\rb b  b\xa0 c"),
            (7, "a b " * 4 + "c"), (7, "a b " * 4 + "c"), (8, "é 漢 " * 3)]
    docs = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], DOC)
    got = {(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in runs.periodic_runs(docs).collect()}
    assert got == {(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (None, 6, ((0, 6, 1),), "a"), (5, 5, (), "x x x x x"),
                   (6, 7, (), "b b b b b b\xa0 c"), (7, 9, ((0, 8, 2),), "a b c"), (8, 6, (), "é 漢 é 漢 é 漢")}
    assert runs.periodic_runs(docs).where("doc_id = 7").count() == 2
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_on_given_table(spark):
    docs = table(spark, SMALL, "documents").collect()
    got = sorted(tuple(r)[:8] for r in op12_periodic_runs(spark, SMALL).collect())
    assert got == sorted(plain_row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] for r in got) > 10
