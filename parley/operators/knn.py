"""JOIN-5, WIN-4, TOP-1, FIL-5: exact k-nearest-neighbour join by cosine similarity.

Every query is scored against every document, but no pair is ever a row. The query side is
hashed into ``query_blocks`` blocks and the document side into ``doc_blocks``; each query is
replicated to every document block and each document to every query block, so cell
``(qb, db)`` meets exactly the pairs it owns (a grid equi-join on the cell key, not a cross
join). A cell multiplies its two blocks with numpy in bounded document chunks and emits only
its local top-k per query; the final ``row_number() <= k`` per query (planned as a
``WindowGroupLimit``) sees at most ``doc_blocks * k`` rows per query.

With more than one document block, blocks are not met in full: see :func:`pruned_topk`. Without pruning
(``prune=False``) the shuffle volume is ``|Q| * doc_blocks + |D| * query_blocks`` vectors plus ``|Q| * doc_blocks * k``
hits. A task holds one block of each side: ``cell_queries`` and ``cell_docs`` rows on average
(ids are hashed to blocks), whatever the size of the tables; the block counts follow from the row
counts unless they are given. Ties are broken by document id; null, empty and zero-norm vectors
never score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import TOP_K
from parley.functions.vector import usable
from parley.session import staged


#: Queries whose scores are worked out together; documents that pass by the queries of a cell.
AT_ONCE, PASSING = 512, 8192


def plan_blocks(n: int, per_block: int) -> int:
    """Blocks of about ``per_block`` rows."""
    return max(1, math.ceil(n / per_block))


def _merge_topk(s: np.ndarray, idx: np.ndarray, k: int):
    """Per row, the k best (score desc, place asc) of ``s``; exact on ties at the k-th score."""
    if s.shape[1] > k:
        kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None]
        keep = s >= kth
        cnt = keep.sum(axis=1)
        r, c = np.nonzero(keep)
        pos = np.arange(len(r)) - np.repeat(np.cumsum(cnt) - cnt, cnt)
        width = int(cnt.max())
        s2 = np.full((s.shape[0], width), -np.inf)
        i2 = np.zeros((s.shape[0], width), dtype=np.int64)
        s2[r, pos] = s[r, c]
        i2[r, pos] = idx[r, c]
        s, idx = s2, i2
    order = np.lexsort((idx, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, axis=1), np.take_along_axis(idx, order, axis=1)


class _Best:
    """The k best documents of some queries so far. Documents come in order of their ids, so that of equal
    scores the earlier stays. Scores are worked out for ``AT_ONCE`` queries at a time."""

    def __init__(self, k: int, q: pd.DataFrame, exclude_same_group: bool, allowed: np.ndarray | None = None):
        self.k, self.qids, self.v = k, q["qid"].to_numpy(), _unit(q["v"])
        self.grp, self.allowed = q["grp"].to_numpy() if exclude_same_group else None, allowed
        self.score, self.place = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), dtype=np.int64)
        self.dids: list[np.ndarray] = []
        self.n = 0

    def add(self, d: pd.DataFrame) -> None:
        dv, places = _unit(d["v"]), np.arange(self.n, self.n + len(d))
        self.dids.append(d["did"].to_numpy())
        self.n += len(d)
        score, place = [], []
        for at in range(0, len(self.v), AT_ONCE):
            mine = slice(at, at + AT_ONCE)
            # equal vectors score alike wherever they stand in a block
            s = np.round(self.v[mine] @ dv.T + 1.0, 14)
            if self.grp is not None:
                s[self.grp[mine, None] == d["grp"].to_numpy()[None, :]] = -np.inf
            if self.allowed is not None:
                s[~self.allowed[mine][:, d["pivot"].to_numpy()]] = -np.inf
            merged = _merge_topk(np.concatenate([self.score[mine], s], axis=1),
                                 np.concatenate([self.place[mine], np.broadcast_to(places, s.shape)], axis=1), self.k)
            score.append(merged[0])
            place.append(merged[1])
        self.score, self.place = np.concatenate(score), np.concatenate(place)

    def hits(self) -> pd.DataFrame:
        ok = np.isfinite(self.score)
        return pd.DataFrame({"qid": self.qids[np.nonzero(ok)[0]], "did": np.concatenate(self.dids)[self.place[ok]], "score": self.score[ok]})


def _block_topk(k: int, chunk_rows: int, exclude_same_group: bool):
    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(d) == 0:
            return pd.DataFrame({"qid": q["qid"].iloc[:0], "did": d["did"].iloc[:0], "score": np.zeros(0)})
        best, d = _Best(k, q, exclude_same_group), d.sort_values("did", kind="stable")
        for start in range(0, len(d), chunk_rows):
            best.add(d.iloc[start:start + chunk_rows])
        return best.hits()

    return run


def _streamed_topk(k: int, chunk_rows: int, exclude_same_group: bool, pivots: int):
    """The same for rows in order of (qb, cell, side, did): the queries of a cell are held, its documents
    pass by. A query scores the documents of the pivots in its ``meet`` alone."""

    def opened(parts: list[pd.DataFrame]) -> _Best:
        q = pd.concat(parts)
        allowed = np.zeros((len(q), pivots), dtype=bool)
        for row, met in enumerate(q["meet"]):
            allowed[row, met] = True
        return _Best(k, q, exclude_same_group, allowed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, asking, best = None, [], None
        for b in batches:
            if not len(b):
                continue
            of = b[["qb", "cell", "side"]].to_numpy()
            starts = [0, *(np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1).tolist()]
            for start, end in zip(starts, [*starts[1:], len(b)]):
                if key != (key := tuple(of[start, :2])):
                    if best is not None:
                        yield best.hits()
                    asking, best = [], None
                if of[start, 2] == 0:
                    asking.append(b.iloc[start:end])
                    continue
                if best is None and asking:
                    best = opened(asking)
                for at in range(start, end if best is not None else start, chunk_rows):
                    best.add(b.iloc[at:min(end, at + chunk_rows)])
        if best is not None:
            yield best.hits()

    return run


def knn_topk(queries: DataFrame, docs: DataFrame, k: int = TOP_K, query_blocks: int | None = None,
             doc_blocks: int | None = None, q_id: str = "id", d_id: str = "id", vec: str = "embed",
             group_col: str | None = None, cell_queries: int = 4096, cell_docs: int = 8192,
             chunk_rows: int = 2048, prune: bool = True) -> DataFrame:
    """``(query_id, doc_id, rank, score)`` with score = cosine + 1, rank 1..k per query.

    Filters on either side (for example the persona filter) must be applied before the call;
    Catalyst pushes them into the scan. ``group_col`` (present on both sides) excludes pairs
    from the same group, for example a call's own agent text (behaviour B17, off by default).
    """
    grp = (lambda df: F.col(group_col)) if group_col else (lambda df: F.lit(0).cast("long"))
    q = queries.where(usable(vec)).select(F.col(q_id).alias("qid"), F.col(vec).alias("v"),
                                           grp(queries).cast("long").alias("grp"))
    d = docs.where(usable(vec)).select(F.col(d_id).alias("did"), F.col(vec).alias("v"),
                                        grp(docs).cast("long").alias("grp"))
    query_blocks = query_blocks or plan_blocks(q.count(), cell_queries)
    doc_blocks = doc_blocks or plan_blocks(d.count(), cell_docs)
    if prune and doc_blocks > 1:
        return pruned_topk(q, d, k, group_col is not None, cell_queries, cell_docs, chunk_rows, pivots=doc_blocks)[0]
    q = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(query_blocks)).cast("int")).withColumn(
        "db", F.explode(F.sequence(F.lit(0), F.lit(doc_blocks - 1))))
    d = d.withColumn("db", F.pmod(F.xxhash64("did"), F.lit(doc_blocks)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    schema = T.StructType([
        T.StructField("qid", queries.schema[q_id].dataType),
        T.StructField("did", docs.schema[d_id].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    hits = (
        q.groupBy("qb", "db")
        .cogroup(d.groupBy("qb", "db"))
        .applyInPandas(_block_topk(k, chunk_rows, group_col is not None), schema)
    )
    return _best(hits, k)


def _best(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("did"))
    return (
        hits.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select(F.col("qid").alias("query_id"), F.col("did").alias("doc_id"), "rank", "score")
    )


# ---- exact pruning ------------------------------------------------------------------------------

#: Pivots at most; documents that are looked at for each; angles (radians) by which bounds are slackened for rounding.
MOST_PIVOTS, SAMPLE, SLACK = 1024, 16, 1e-5


def choose_pivots(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """``n`` unit vectors at most: the sample's means on the sphere, started far from each other."""
    at, away = [0], np.full(len(sample), np.inf)
    while len(at) < min(n, len(sample)):
        away = np.minimum(away, 1 - sample @ sample[at[-1]])
        if away.max() <= 1e-9:
            break
        at.append(int(away.argmax()))
    pivots = sample[at]
    for _ in range(rounds):
        near = (sample @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), pivots)
    return pivots


def chained(points: np.ndarray) -> list[int]:
    """The pivots in an order that goes from each to the nearest of those left."""
    near, order = points @ points.T, [0]
    near[:, 0] = -np.inf
    while len(order) < len(points):
        order.append(int(near[order[-1]].argmax()))
        near[:, order[-1]] = -np.inf
    return order


def dealt(counts: np.ndarray, order: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of neighbouring pivots with ``most`` rows at most: for each pivot its first group and how many
    groups its rows are dealt into; more than one only where it has more rows by itself."""
    first, parts = np.zeros(len(counts), np.int64), np.maximum(1, -(-counts // most))
    group, held = -1, most + 1
    for p in order:
        if held + counts[p] > most:
            group, held = group + 1, 0
        first[p], held = group, held + counts[p]
        group += parts[p] - 1
    return first, parts


def _unit(vectors: pd.Series) -> np.ndarray:
    v = np.stack(vectors.to_numpy()).astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _angles(vectors: pd.Series, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ pivots.T, -1.0, 1.0))


def least_angles(angles: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """The smallest angle that a query, at ``angles`` from the pivots, can have to a document of each pivot: angles are a
    metric, and a pivot's documents are between ``nearest`` and ``farthest`` from it."""
    return np.maximum(0.0, np.maximum(angles - farthest, nearest - angles) - SLACK)


def pruned_topk(q: DataFrame, d: DataFrame, k: int, exclude_same_group: bool, cell_queries: int, cell_docs: int,
                chunk_rows: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """The exact top k of ``q(qid, v, grp)`` in ``d(did, v, grp)``, and ``(qid, met, pivots)``: how many pivots' documents
    each query met, of how many.

    Documents go to the nearest of some pivots, whose farthest and nearest document are known. A query
    first meets the documents of its nearest pivots, enough of them for k. The k-th score it has then
    bounds by the triangle inequality which other pivots can hold a better or equal document; only
    those are met in a second pass. Whatever the pivots, nothing is missed; good pivots save work.

    Queries of one nearest pivot, and of pivots near it, ask for much the same documents, so they share
    blocks of about ``cell_queries``; the documents of neighbouring pivots share cells, and what is larger than
    a block or a cell is split by a hash of the id. So neither the number of cells nor the copies of a vector
    grow with the number of pivots. A task holds a block of queries, and the documents pass by. The
    driver holds the pivots (``MOST_PIVOTS`` vectors), a sample of ``SAMPLE`` times as many, and three
    numbers a pivot."""
    spark, want = q.sparkSession, min(pivots, MOST_PIVOTS)
    q, d = q.withColumn("qkey", F.xxhash64("qid")), d.withColumn("dkey", F.xxhash64("did"))
    total = d.count()
    share = 4.0 * SAMPLE * want / max(1, total)
    few = d.where(F.pmod("dkey", F.lit(1 << 30)) < min(1 << 30, math.ceil(share * (1 << 30))))
    sample = [r.v for r in few.orderBy("dkey", "did").limit(SAMPLE * want).select("v").collect()]
    empty = spark.createDataFrame([], T.StructType([q.schema["qid"], T.StructField("met", T.LongType()), T.StructField("pivots", T.LongType())]))
    types = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("did", d.schema["did"].dataType),
                          T.StructField("score", T.DoubleType())])
    if not sample:
        return _best(spark.createDataFrame([], types), k), empty
    points = choose_pivots(_unit(pd.Series(sample)), want)

    def assign(batches):
        for b in batches:
            if len(b):
                angles = _angles(b["v"], points)
                near = angles.argmin(axis=1)
                yield b.assign(pivot=near.astype(np.int32), angle=angles[np.arange(len(b)), near])

    more = [T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    d = staged(d.mapInPandas(assign, T.StructType([*d.schema.fields, *more])), "assigned")
    q = staged(q.mapInPandas(assign, T.StructType([*q.schema.fields, *more])), "assigned")
    n = len(points)
    counts, near, far = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for r in d.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("a"), F.max("angle").alias("b")).collect():
        counts[r.pivot], near[r.pivot], far[r.pivot] = r.n, r.a, r.b
    asked = np.zeros(n, np.int64)
    for r in q.groupBy("pivot").count().collect():
        asked[r.pivot] = r["count"]
    order = chained(points)
    cell, cells = dealt(counts, order, max(cell_docs, PASSING))
    block, blocks = dealt(asked, order, cell_queries)

    def first(batches):
        for b in batches:
            if len(b):
                order = np.argsort(np.where(counts > 0, _angles(b["v"], points), np.inf), axis=1, kind="stable")
                enough = np.minimum((np.cumsum(counts[order], axis=1) < k).sum(axis=1) + 1, int((counts > 0).sum()))
                yield b.assign(meet=[o[:e].astype(np.int32) for o, e in zip(order, enough)])

    def rest(batches):
        for b in batches:
            if len(b):
                least = least_angles(_angles(b["v"], points), near, far)
                reach = np.arccos(np.clip(b["kth"].fillna(0.0).to_numpy() - 1.0, -1.0, 1.0)) + SLACK
                may = (least <= reach[:, None]) & (counts > 0)
                for row, met in enumerate(b["meet"]):
                    may[row, met] = False
                yield b.drop(columns="kth").assign(meet=[np.flatnonzero(m).astype(np.int32) for m in may])

    q_types = T.StructType([*q.schema.fields, T.StructField("meet", T.ArrayType(T.IntegerType()))])
    number = lambda column, of: F.element_at(F.array(*(F.lit(int(x)).cast("long") for x in of)), (F.col(column) if isinstance(column, str) else column) + 1)
    q = q.withColumn("part", number("pivot", block) + F.pmod("qkey", number("pivot", blocks)))
    q_types = q_types.add("part", T.LongType())
    d = d.withColumn("cell", number("pivot", cell) + F.pmod("dkey", number("pivot", cells)))
    last = cell + cells - 1
    vector = q.schema["v"].dataType if q.schema["v"].dataType == d.schema["v"].dataType else T.ArrayType(T.DoubleType())
    none = lambda df, name: F.lit(0).cast(df.schema[name].dataType).alias(name)

    def meet(asking: DataFrame) -> DataFrame:
        """The best k of each query in the documents of the pivots that it names in ``meet``."""
        each = asking.select("qid", F.col("v").cast(vector).alias("v"), "grp", F.col("part").alias("qb"), "meet")
        wanted = each.select("qb", F.explode("meet").alias("pivot")).distinct().groupBy("pivot").agg(F.collect_list("qb").alias("qbs"))
        of = F.array_distinct(F.flatten(F.transform("meet", lambda p: F.sequence(number(p, cell), number(p, last)))))
        each = each.withColumn("cell", F.explode(of)).withColumn(
            "meet", F.filter("meet", lambda p: F.col("cell").between(number(p, cell), number(p, last))))
        lent = d.join(wanted, "pivot").select(F.explode("qbs").alias("qb"), "cell", "did", F.col("v").cast(vector).alias("v"), "grp", "pivot")
        held = each.select("qb", "cell", F.lit(0).alias("side"), "qid", none(d, "did"), "v", "grp", F.lit(0).alias("pivot"), "meet")
        passing = lent.select("qb", "cell", F.lit(1).alias("side"), none(q, "qid"), "did", "v", "grp", "pivot", F.lit(None).cast("array<int>").alias("meet"))
        rows = held.union(passing).repartition("qb", "cell").sortWithinPartitions("qb", "cell", "side", "did")
        return rows.mapInPandas(_streamed_topk(k, chunk_rows, exclude_same_group, n), types)

    columns = ["qid", "v", "grp", "qkey", "pivot", "angle"]
    begun = staged(q.mapInPandas(first, _ordered(q_types, [*q.columns, "meet"])), "meet")
    hits = staged(_best(meet(begun), k), "first")
    kth = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") == k).select(
        F.col("query_id").alias("kid"), "kth")
    known = begun.join(kth, begun.qid == kth.kid, "left").drop("kid")
    left = staged(known.mapInPandas(rest, _ordered(q_types, [*columns, "part", "meet"])), "meet")
    found = hits.select(F.col("query_id").alias("qid"), F.col("doc_id").alias("did"), "score").unionByName(meet(left.where(F.size("meet") > 0)))
    met = begun.select("qid", F.size("meet").alias("m")).union(left.select("qid", F.size("meet"))).groupBy("qid").agg(
        F.sum("m").alias("met"), F.lit(int((counts > 0).sum())).cast("long").alias("pivots"))
    return _best(found, k), met


def _ordered(schema: T.StructType, columns: list[str]) -> T.StructType:
    return T.StructType([schema[c] for c in columns])
