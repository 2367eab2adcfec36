"""SimHash near-duplicates and connected components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from parley.llm import neardup
from parley.llm.components import components
from parley.llm.queries import op9_simhash_neardup
from tests.conftest import SMALL

DOC = "doc_id long, text string, lang string, source string, n_chars long, fp string, root string, late int, id long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", "y", 1, 2) for i, t in rows], DOC)


def plain_fingerprint(text):
    """Bit by bit, on characters instead of bytes."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def expected(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    comp = plain_components({f for _, f in fps}, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return sorted(((i, f"{f:016x}", least.get(comp[f])) for i, f in fps), key=repr)


def test_fingerprint_against_plain():
    texts = [None, "", " \t ", "One", "A b", "É é ÀB c d e", "a b c\x0bd\x0ce\x1cf g", "x " * 70000, "the cat sat on the mat " * 3]
    rng = random.Random(1)
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert neardup.fingerprint(t, 3) % 2**64 == plain_fingerprint(t)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op9_simhash_neardup(spark, SMALL)
    assert sorted(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect()), key=repr) == expected(rows)


def near_rows(n=250):
    rng, rows = random.Random(7), []
    for f in range(12):
        words = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 40)) for _ in range(150)]
        for _ in range(n // 12):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                own[rng.randrange(len(own))] = "new"
            rows.append(" ".join(own))
    ids = rng.sample(range(10000), len(rows))
    return list(zip(ids, rows))


def test_families_nulls_and_repeats(spark):
    rows = near_rows() + [(20000, None), (20001, ""), (20002, "  "), (None, "only"), (None, None), (20003, "two words"), (20003, "two words"),
                          (20004, "long " * 100_000)]
    got = neardup.near_duplicates(docs_of(spark, rows)).select("doc_id", "fp", "component_id").collect()
    assert sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=repr) == expected(rows)


def test_keep_one(spark):
    rows = near_rows(60) + [(20000, None), (20001, ""), (20003, "two words"), (20003, "two words"), (None, "no id"), (None, "no id")]
    df = docs_of(spark, rows)
    kept = neardup.keep_one(df)
    assert kept.schema == df.schema
    comp = expected(rows)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({c for _, _, c in comp}, key=repr)


def test_empty(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0
    assert neardup.keep_one(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("m,max_bits,per_block", [(8, 3, 512), (8, 3, 3), (4, 3, 512), (8, 2, 512), (16, 3, 512), (8, 5, 512), (8, 0, 512)])
def test_links_are_complete(spark, m, max_bits, per_block):
    """Dense and sparse fingerprints: every pair within reach, once, and no other."""
    rng = np.random.default_rng(m + max_bits)
    centre = rng.integers(0, 2**63, 6)
    fps = {int(c) ^ sum({1 << int(b) for b in rng.integers(0, 63, rng.integers(0, 5))}) for c in centre for _ in range(70)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = [tuple(r) for r in neardup.link_fingerprints(df, max_bits, m, per_block).collect()]
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= max_bits}
    assert len(got) == len(set(got)) and set(got) == want


def test_pigeonring_keys():
    assert neardup.budgets(8, 3) == [0, 0, 1, 1, 1, 2, 2, 3]
    assert [m.bit_count() for m in neardup.key_masks(8, 3)] == [32] * 3
    with pytest.raises(ValueError):
        neardup.link_fingerprints(None, 16, 8)


def test_components_long_chain_and_hub(spark):
    rng = random.Random(2)
    chain = rng.sample(range(1000, 2000), 300)
    edges = list(zip(chain, chain[1:])) + [(5000, i) for i in range(5001, 5400)] + [(1, 2), (2, 1), (2, 2), (3, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[c] for c in chain} == {min(chain)} and {got[i] for i in range(5000, 5400)} == {5000}
    assert got[1] == got[2] == 1 and 3 not in got and len(got) == 300 + 400 + 2
