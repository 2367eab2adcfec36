"""Ranked search against scores of every document, and what the pair bounds save."""

import math
import random
import re

import numpy as np

from parley.llm import maxscore
from tests.llm.test_runs import DOC

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=20):
    held = [(doc_id, plain_terms(text)) for doc_id, text in docs]
    held = [(doc_id, terms) for doc_id, terms in held if terms]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    out = set()
    for item_id in {i for i, _ in items}:
        asked = [t for i, text in sorted(set(items), key=repr) if i == item_id for t in plain_terms(text)]
        found = []
        for doc_id, terms in held:
            m, score = 75 + 25 * len(terms) * n_docs // n_terms, 0
            for t in asked:
                tf, df = terms.count(t), sum(t in other for _, other in held)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out |= {(item_id, rank + 1, None if missing else doc_id, -score)
                for rank, (score, missing, doc_id) in enumerate(sorted(found)[:k])}
    return out


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x", "y") for i, t in docs], DOC).repartition(3),
            spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score long"))


def result(df):
    return {tuple(r) for r in df.collect()}


def random_docs(rng, n, words=40):
    vocabulary = [f"w{i}" for i in range(words)]
    odds = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(vocabulary, odds, k=rng.choice([0, 1, 3, 12, 30])))) for i in range(n)]


def test_against_every_score(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 150)
    rng = random.Random(5)
    docs = random_docs(rng, 120) + [(7, "W1, w2. w2 w2"), (None, "w3 w3"), (None, "w9"), (500, None), (501, "…é É ß w1")]
    docs += docs[:10]
    items = [(i, " ".join(f"w{rng.randrange(42)}" for _ in range(rng.choice([1, 2, 5, 15])))) for i in range(25)]
    items += [items[0], (1, "w1 w1 w1 W1"), (None, "w3"), (90, None), (91, ""), (92, "nothing of it"), (93, "É …é")]
    given = frames(spark, docs, items)
    for k in (1, 4, 20):
        assert result(maxscore.search(*given, k)) == plain_search(docs, items, k)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK_BYTES", 40)
    rng = random.Random(6)
    docs, items = random_docs(rng, 40), [(i, f"w{i} w{i + 1} w3") for i in range(12)]
    assert result(maxscore.search(*frames(spark, docs, items), 5)) == plain_search(docs, items, 5)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert maxscore.search(docs.limit(0), items).count() == 0
    assert maxscore.search(docs, items.limit(0)).count() == 0
    assert maxscore.search(docs.withColumn("text", maxscore.F.lit(None).cast("string")), items).count() == 0


def shard_of(rows, weights, pairs, n_docs=1000, n_terms=10_000):
    """``rows``: for each document, {term: tf}."""
    docs = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    terms = np.array([t for r in rows for t in sorted(r)], np.int32)
    tfs = np.array([r[t] for r in rows for t in sorted(r)], np.int32)
    norms = np.array([75 + 25 * sum(r.values()) * n_docs // n_terms for r in rows], np.int64)
    return maxscore.Shard(np.arange(len(rows)), norms, docs, terms, tfs, np.array(weights, np.int64), pairs)


def test_bounds_hold_and_lose_nothing():
    rng = random.Random(9)
    for _ in range(60):
        terms = 8
        # neighbours rarely share a document, so that joint maxima are far below the sums of maxima
        rows = [{t: rng.randint(1, 9) for t in range(terms) if (t + d) % 2 and rng.random() < 0.6 or rng.random() < 0.02}
                for d in range(200)]
        rows = [r or {0: 1} for r in rows]
        query = [(t, rng.choice([1, 1, 2])) for t in range(terms)]
        weights = sorted(rng.randint(0, 3000) for _ in range(terms))
        for paired in (True, False):
            shard = shard_of(rows, weights, maxscore.pairs_of([query]))
            places, scores = shard.search(query, 5, paired=paired)
            full = np.zeros(len(rows), np.int64)
            for t, times in query:
                docs, impacts = shard.postings(t)
                full[docs] += times * impacts
            best = sorted(((-s, i) for i, s in enumerate(full.tolist()) if s > 0))[:5]
            assert sorted(zip((-scores).tolist(), places.tolist()))[:5] == best
            for left, bound in enumerate(shard.bounds(query, paired)):
                part = np.zeros(len(rows), np.int64)
                for t, times in query[:left]:
                    docs, impacts = shard.postings(t)
                    part[docs] += times * impacts
                assert part.max() <= bound


def test_pair_bounds_skip_lists_that_single_bounds_read():
    # terms 0 and 1 fill a half of the documents each and meet nowhere; term 2 outweighs either, not both
    rows = [{0: 1} if d % 2 else {1: 1} for d in range(1000)]
    for d in range(30):
        rows[d][2] = 1
    query, read = [(0, 1), (1, 1), (2, 1)], []
    for paired in (True, False):
        shard = shard_of(rows, [600, 600, 900], maxscore.pairs_of([query]))
        places, scores = shard.search(query, 20, paired=paired)
        assert len(places) >= 20 and len(set(scores.tolist())) == 1
        read.append(shard.read)
    assert read[0] <= 30 + 2 * 30 and read[1] >= 500


def test_floor_of_earlier_shards_keeps_ties():
    shard = shard_of([{0: 1}, {0: 1}, {0: 2}], [500], maxscore.pairs_of([]))
    _, scores = shard.search([(0, 1)], 3)
    places, _ = shard.search([(0, 1)], 3, least=int(min(scores)))
    assert places.tolist() == [0, 1, 2]
