"""Order MinHash against a plain version and on planted edits."""

import hashlib
import random

import numpy as np
import pytest

from parley.llm import minhash
from parley.llm.common import table
from parley.llm.queries import op3_order_minhash
from tests.conftest import SMALL

DOC = "doc_id long, text string, lang string, range int, lent boolean, fingerprint string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, 1, True, "x") for i, t in rows], DOC)


def plain_signature(text, h):
    """The definition, one hash function and one k-mer at a time."""
    grams = [text[i:i + h.k] for i in range(max(1, len(text) - h.k + 1))] if text else []
    values = h.kmers(text).tolist()
    assert len(values) == len(grams)
    numbered = [(g, grams[:i].count(g)) for i, g in enumerate(grams)]
    assert len(set(values)) == len(set(numbered)) == len(grams)
    out = []
    for j in range(h.m):
        hashed = []
        for i, v in enumerate(values):
            hashed.append((((v >> 32) ^ int(h.flip[j, 0])) * int(h.times[j, 0]) % 2**32, i))
        places = sorted(i for _, i in sorted(hashed)[:h.l])
        x = np.array([h.salt[j]], dtype=np.uint64)
        for i in places:
            x = minhash._mix(x ^ np.array([values[i]], dtype=np.uint64))
        out.append(int(x[0]) >> 48)
    return out


def test_signature_is_the_definition(monkeypatch):
    monkeypatch.setattr(minhash, "AT_ONCE", 7)
    rng = random.Random(2)
    h = minhash.OrderMinHash(k=3, l=2, m=9)
    for text in ["", "a", "ab", "abc", "aaaaaaaaaaaa", "é漢🙂xyz" * 5] + ["".join(rng.choice("ab c") for _ in range(n)) for n in range(3, 60)]:
        assert h.signature(text).tolist() == plain_signature(text, h)


def test_blocks_do_not_matter(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefg hij") for _ in range(30_000))
    whole = minhash.as_text(minhash.OrderMinHash().signature(text))
    monkeypatch.setattr(minhash, "AT_ONCE", 1000)
    assert minhash.as_text(minhash.OrderMinHash().signature(text)) == whole


def test_likeness_falls_with_edits_and_moves():
    rng, h = random.Random(8), minhash.OrderMinHash(m=256)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    like = lambda other: minhash.likeness(h.signature(" ".join(words)), h.signature(" ".join(other)))
    few, many = list(words), list(words)
    for i in rng.sample(range(400), 5):
        few[i] = "zzzzzz"
    for i in rng.sample(range(400), 100):
        many[i] = "yyyyyy"
    turned = words[200:] + words[:200]
    assert like(words) == 1 and like(few) > like(many) > like(["qqq"] * 400)
    assert like(turned) < 0.7  # nearly the same k-mers, another order


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    h, out = minhash.OrderMinHash(), []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        other = text[:len(text) - half] + after[:half]
        a, b, c = h.signature(text), h.signature(other), h.signature(after)
        out.append((doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), minhash.as_text(a), minhash.as_text(b),
                    minhash.likeness(a, b), minhash.likeness(a, c)))
    return sorted(out, key=repr)


def test_query_against_plain_order(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    got = op3_order_minhash(spark, SMALL)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("least", [1, 5, 1000])
def test_ranges_nulls_and_repeats(spark, least, monkeypatch):
    rng = random.Random(least)
    rows = [(rng.randrange(-10**12, 10**12), "".join(rng.choice("ab é漢") for _ in range(rng.randint(0, 30)))) for _ in range(120)]
    rows += [(5, "same"), (5, "same"), (5, "other"), (None, "n1"), (None, None), (7, None), (8, ""), (2**62 + 1, "big"), (2**62, "big 2")]
    plain = minhash.in_descending_order
    monkeypatch.setattr(minhash, "in_descending_order", lambda d: plain(d, least))
    got = minhash.fingerprint_pairs(docs_of(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_small_tables(spark):
    assert minhash.fingerprint_pairs(docs_of(spark, [])).count() == 0
    one = minhash.fingerprint_pairs(docs_of(spark, [(1, "abcd" * 10)])).first()
    assert one.near_next == 1 and one.n_chars == 40
