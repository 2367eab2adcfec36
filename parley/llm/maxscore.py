"""Ranked lexical search: MaxScore with bounds for pairs of terms.

The items (queries) are taken in blocks of a bounded size; a block's terms are the vocabulary.
One pass over the texts counts the vocabulary's terms a document and writes postings; document
frequencies are counted in the tasks and added up. Then every task indexes its postings shard by
shard, and searches all items of the block:

- The index holds, for each term, its documents with their impacts and the highest impact; and for
  each pair of terms that stand next to each other in an item, least weight first, the intersection
  list: the highest joint impact of a document with both.
- An item's documents that have one of the two terms only cannot pass the higher single impact,
  those with both not the joint maximum. So a pair's bound is the larger of these, below the sum of
  the two maxima unless one document has both; bounds of pairs and of a single last term add up to
  the bound of all lighter terms together.
- Terms are taken from the heaviest. Once the bound of the rest is under the k-th best sum so far,
  no new document can enter: the rest is only looked up for documents that can still do so, fewer
  with each term. The k-th best score of earlier shards is the least to be reached.

Pruning loses nothing: a document goes only when its sum and the bound of what is left are less
than k other documents have for certain. A task sends its best k an item, which are merged in two
steps, first over parts of the tasks' rows.

Defined results: text null or without a term: no document, no rows for such an item; equal rows of
``items`` count once, different texts with one item_id are one item with the terms of all; equal
documents are ranked each, doc_id null last among equal scores; item_id null is an item of its own;
very long texts: counts are held for distinct terms only; empty tables: no rows; further columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import pick, staged

#: Bytes of item texts in a block: what the driver holds and every task gets.
BLOCK_BYTES = 4 << 20
#: Postings that are indexed together.
SHARD = 1 << 21
#: Parts in which the tasks' results are merged first.
PARTS = 64
#: Bytes of a term: digits, letters and whatever is not ASCII; A-Z in lower case.
TERM_BYTES = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms_of(text: bytes | None) -> Counter:
    return Counter((text or b"").translate(TERM_BYTES).split())


class Shard:
    """Index of some documents. ``docs``: place of each posting's document in ``doc_ids``."""

    def __init__(self, doc_ids: np.ndarray, norms: np.ndarray, docs: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, pairs: np.ndarray):
        self.doc_ids, self.read = doc_ids, 0
        order = np.lexsort((docs, terms))
        self.docs, tfs = docs[order], tfs[order].astype(np.int64)
        self.impacts = weights[terms[order]] * (1_000_000_000 * tfs // (1000 * tfs + 12 * norms[self.docs]))
        self.begin = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        some = np.flatnonzero(np.diff(self.begin))
        self.highest = np.zeros(len(weights), np.int64)
        if len(some):
            self.highest[some] = np.maximum.reduceat(self.impacts, self.begin[some])
        self.joint = self._joint(pairs)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.begin[term], self.begin[term + 1]
        return self.docs[a:b], self.impacts[a:b]

    def _joint(self, pairs: np.ndarray) -> dict[tuple[int, int], int]:
        """The highest joint impact of each pair (by first term); 0 where no document has both."""
        found, first, held = {}, -1, np.zeros(len(self.doc_ids), np.int64)
        for a, b in pairs.tolist():
            if a != first:
                if first >= 0:
                    held[self.postings(first)[0]] = 0
                docs, impacts = self.postings(a)
                held[docs], first = impacts, a
            docs, impacts = self.postings(b)
            both = held[docs]
            found[a, b] = int(np.max(both + impacts, where=both > 0, initial=0))
        return found

    def bounds(self, query: list[tuple[int, int]], paired: bool = True) -> list[int]:
        """Bound of the first 0, 1, 2 ... terms of a query (term, times), the lightest first."""
        out = [0]
        for i, (term, times) in enumerate(query):
            alone = times * int(self.highest[term])
            best = out[-1] + alone
            if paired and i % 2:
                other, others = query[i - 1]
                before = others * int(self.highest[other])
                both = self.joint[other, term]
                # (times - 1) more of each impact than the joint one holds
                both = both and both + (times - 1) * int(self.highest[term]) + (others - 1) * int(self.highest[other])
                best = min(best, out[i - 1] + max(before, alone, both))
            out.append(best)
        return out

    def search(self, query: list[tuple[int, int]], k: int, least: int = 1, paired: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of at least the best k documents that score ``least`` or more."""
        bounds, sums = self.bounds(query, paired), np.zeros(len(self.doc_ids), np.int64)
        left, seen = len(query), 0
        while left and bounds[left] >= least:  # the rest could lift a new document high enough
            left -= 1
            term, times = query[left]
            docs, impacts = self.postings(term)
            sums[docs] += times * impacts
            self.read += len(docs)
            seen += len(docs)
            if seen >= k and len(sums) >= k and bounds[left] < sums.max():
                least = max(least, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        live = np.flatnonzero(sums + bounds[left] >= least) if left < len(query) else np.empty(0, np.int64)
        score = sums[live]
        while left and len(live):
            left -= 1
            term, times = query[left]
            docs, impacts = self.postings(term)
            if len(docs):
                at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
                score = score + np.where(docs[at] == live, times * impacts[at], 0)
                self.read += min(len(live), len(docs))
            if len(live) > k:
                least = max(least, int(np.partition(score, len(score) - k)[len(score) - k]))
            keep = score + bounds[left] >= least
            live, score = live[keep], score[keep]
        keep = score >= max(1, least)
        return live[keep], score[keep]


class Best:
    """The best k of an item so far: score, whether doc_id is missing, doc_id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, rows: list[tuple[int, bool, int]]) -> None:
        self.rows = sorted(self.rows + rows, key=lambda r: (-r[0], r[1], r[2]))[:self.k]


def pairs_of(queries: list[list[tuple[int, int]]]) -> np.ndarray:
    """The terms next to each other in the queries, from the first on, two by two."""
    found = {(query[i][0], query[i + 1][0]) for query in queries for i in range(0, len(query) - 1, 2)}
    return np.array(sorted(found), np.int64).reshape(-1, 2)


POSTINGS = "doc_id long, n long, terms binary, tfs binary"


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row for each document with a term: the number of its terms, those of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                counts = terms_of(text.as_py())
                if counts:
                    held = sorted((vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys())
                    terms, tfs = np.array(held, np.int32).reshape(-1, 2).T
                    rows.append((doc_id, sum(counts.values()), terms.tobytes(), tfs.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "n", "terms", "tfs"])

    return pick(docs, doc_id="long", text="binary").mapInArrow(run, POSTINGS)


def frequencies(held: DataFrame, terms: int) -> np.ndarray:
    """Documents of each term; counted in the tasks, so that a frequent term is a row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    found = held.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(terms, np.int64)
    for r in found:
        out[r.term] = r.df
    return out


def _search(held: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int,
            queries: list[tuple[int | None, list[tuple[int, int]]]], k: int) -> DataFrame:
    pairs = pairs_of([query for _, query in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rows, size = [Best(k) for _ in queries], [], 0

        def flush() -> None:
            rows.sort(key=lambda r: (r[0] is None, r[0]))
            terms = [np.frombuffer(r[2], np.int32) for r in rows]
            tfs = np.concatenate([np.frombuffer(r[3], np.int32) for r in rows])
            docs = np.repeat(np.arange(len(rows)), [len(t) for t in terms])
            norms = np.array([75 + 25 * r[1] * n_docs // n_terms for r in rows], np.int64)
            missing = np.array([r[0] is None for r in rows])
            shard = Shard(np.array([r[0] or 0 for r in rows], np.int64), norms, docs, np.concatenate(terms), tfs, weights, pairs)
            for (_, query), top in zip(queries, best):
                places, scores = shard.search(query, k, top.least)
                top.add(list(zip(scores.tolist(), missing[places].tolist(), shard.doc_ids[places].tolist())))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tfs"))):
                rows.append(row)
                size += len(row[2]) // 4 + 1
                if size >= SHARD:
                    flush()
                    rows, size = [], 0
        if rows:
            flush()
        out = [(item, None if missing else doc, score) for (item, _), top in zip(queries, best) for score, missing, doc in top.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)],
                                         names=["item_id", "doc_id", "score"])

    return held.mapInArrow(run, "item_id long, doc_id long, score long")


def _of_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    counts: dict[int | None, Counter] = {}
    for item_id, text in items:
        counts.setdefault(item_id, Counter()).update(terms_of(text))
    vocabulary = {term: i for i, term in enumerate(sorted({t for c in counts.values() for t in c}))}
    held = staged(postings(docs, vocabulary), "postings")
    n_docs, n_terms = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = frequencies(held, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    queries = []
    for item_id in sorted(counts, key=lambda i: (i is None, i)):
        query = [(vocabulary[t], times) for t, times in counts[item_id].items() if df[vocabulary[t]]]
        queries.append((item_id, sorted(query, key=lambda x: (weights[x[0]], x[0]))))
    return _search(held, weights, n_docs, n_terms, queries, k)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of every item."""
    given = pick(items, item_id="long", text="binary").distinct()
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [_of_block(docs, [tuple(r) for r in given.where(block == i).collect()], k) for i in range(blocks)]
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    merged = reduce(DataFrame.union, found).withColumn("part", part)
    merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*best))).where(F.col("rank") <= k)
    return (merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best)))
            .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
