"""Order MinHash fingerprints, sensitive to edit distance.

The k-mers of a text are numbered by occurrence, so that repeats differ. Each of ``m`` hash
functions picks the ``l`` k-mers with the smallest values; put back into text order, they are
hashed to one number of the signature. Two texts agree in a place if they share the minimal k-mers
and have them in the same order, so the share of equal places falls with edits and with moves.

:func:`fingerprint_pairs` fingerprints every document and a text edited from it and the next one.
Neighbours in descending doc_id are brought together by one shuffle: doc_ids are cut into ranges
at approximate quantiles, each range is read in order in one task with one text in hand, and the
first document of a range is sent to the range before it as well.

Defined results: text null: empty; fewer than k code points: the whole text is the one k-mer;
fewer than l k-mers: all of them; an empty text: the signature of no k-mers, equal to that of any
other empty text; doc_id null: last in order; rows that share a doc_id are in order of their text;
a single row is its own next; empty table: no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pick

#: k-mers of AT_ONCE places are hashed at once, whatever the length of the text.
AT_ONCE = 1 << 14
PLACE = 4  # hex digits of a place


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit numbers (multiply and shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class OrderMinHash:
    def __init__(self, k: int = 8, l: int = 2, m: int = 64, seed: int = 42):  # noqa: E741
        self.k, self.l, self.m = k, l, m
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 32, m, dtype=np.uint64).astype(np.uint32)[:, None]
        self.times = (rng.integers(0, 1 << 32, m, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.salt = rng.integers(0, 1 << 63, m, dtype=np.uint64)

    def kmers(self, text: str) -> np.ndarray:
        """A 64-bit value for each occurrence-numbered k-mer, in text order."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
        n = len(points) - self.k + 1
        if not len(points):
            return points
        if n < 1:
            n, width = 1, len(points)
        else:
            width = self.k
        value = np.zeros(n, dtype=np.uint64)
        for i in range(width):
            value = value * np.uint64(0x100000001B3) + points[i:i + n] + np.uint64(1)
        value = _mix(value)
        order = np.argsort(value, kind="stable")
        sorted_ = value[order]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = sorted_[1:] != sorted_[:-1]
        if fresh.all():
            return _mix(value)
        place = np.arange(n)
        occurrence = np.empty(n, dtype=np.uint64)
        occurrence[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
        return _mix(value + occurrence * np.uint64(0xA24BAED4963EE407))

    def signature(self, text: str | None) -> np.ndarray:
        """m numbers of PLACE hex digits."""
        kmers = self.kmers(text or "")
        few = min(self.l, len(kmers))
        best = np.empty((self.m, 0), dtype=np.uint64)   # value << 32 | place, of the smallest so far
        small = (kmers >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(kmers), AT_ONCE):
            hashed = (small[at:at + AT_ONCE][None, :] ^ self.flip) * self.times
            rows, found = np.arange(self.m), []
            for _ in range(min(few, hashed.shape[1])):
                where = hashed.argmin(axis=1)
                found.append(hashed[rows, where].astype(np.uint64) << np.uint64(32) | (where + at).astype(np.uint64))
                hashed[rows, where] = 0xFFFFFFFF
            best = np.sort(np.column_stack([best, *found]), axis=1)[:, :few]
        places = np.sort((best & np.uint64(0xFFFFFFFF)).astype(np.int64), axis=1)
        out = self.salt.copy()
        for i in range(few):
            out = _mix(out ^ kmers[places[:, i]])
        return (out >> np.uint64(64 - 4 * PLACE)).astype(">u2")


def as_text(signature: np.ndarray) -> str:
    return signature.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, after: str) -> str:
    """The last half of the code points replaced by as many first ones of the next text (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _in_range(cuts: np.ndarray, lend_to: dict[int, tuple[int, int]]):
    """UDF over (doc_id or 0, is null): the row's range, 0 for the largest ids, and the range that
    gets a copy of it because the row is its own range's first (else -1)."""

    @F.pandas_udf("range int, lend_to int")
    def run(ids: pd.Series, late: pd.Series) -> pd.DataFrame:
        number = np.where(late, len(cuts) + 1, len(cuts) - np.searchsorted(cuts, ids.to_numpy(), side="right"))
        lent = np.full(len(number), -1)
        for i, (n, doc_id, is_late) in enumerate(zip(number.tolist(), ids.tolist(), late.tolist())):
            to, top = lend_to.get(n, (-1, 0))
            if to >= 0 and (is_late or doc_id == top):
                lent[i] = to
        return pd.DataFrame({"range": number, "lend_to": lent})

    return run(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull())


def in_descending_order(docs: DataFrame, least_rows: int = 256) -> DataFrame:
    """range, lent, doc_id, text: rows of a range are in one partition in descending doc_id, and
    the first row of the next range (``lent``) comes last. There are at most four ranges for each
    shuffle partition; the driver gets one doc_id for each."""
    rows = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, min(4 * partitions, rows.count() // least_rows))
    steps = [i / count for i in range(1, count)]
    found = rows.where("doc_id is not null").approxQuantile("doc_id", steps, 1 / (4 * count)) if steps else []
    cuts = np.array(sorted({int(c) for c in found}), dtype=np.int64)
    tops = (rows.select("doc_id", _in_range(cuts, {}).alias("at")).groupBy("at.range")
            .agg(F.max(F.coalesce("doc_id", F.lit(0))).alias("top")).orderBy("range").collect())
    lend_to = {r.range: (tops[i - 1].range, r.top) for i, r in enumerate(tops)}  # the first one's is the last one
    own = F.struct(F.col("at.range").alias("range"), F.lit(False).alias("lent"))
    lent = F.struct(F.col("at.lend_to").alias("range"), F.lit(True).alias("lent"))
    dealt = rows.withColumn("at", _in_range(cuts, lend_to)).withColumn(
        "to", F.explode(F.when(F.col("at.lend_to") < 0, F.array(own)).otherwise(F.array(own, lent))))
    return (dealt.select("to.range", "to.lent", "doc_id", "text")
            .repartition("range").sortWithinPartitions("range", "lent", F.desc_nulls_last("doc_id"), "text"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprint_pairs(docs: DataFrame, k: int = 8, l: int = 2, m: int = 64, seed: int = 42) -> DataFrame:  # noqa: E741
    """SCHEMA, a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OrderMinHash(k, l, m, seed)

        def pair(doc_id, text, own, after, next_own):
            other = edited(text, after)
            changed = own if other == text else hasher.signature(other)
            return (doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), as_text(own), as_text(changed),
                    likeness(own, changed), likeness(own, next_own))

        held, in_hand, closed = [], None, None   # in_hand: range, doc_id, text, signature
        for batch in batches:
            for number, lent, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "lent", "doc_id", "text"))):
                if closed == number:
                    continue  # further lent rows of a range that has its end
                own = hasher.signature(text)
                if in_hand is not None:
                    held.append(pair(*in_hand[1:], text, own))
                closed = number if lent else None
                in_hand = None if lent else (number, doc_id, text, own)
                if len(held) >= 1000:
                    yield _batch(held)
                    held = []
        if in_hand is not None:
            raise AssertionError("a range lacks its last row's next document")
        if held:
            yield _batch(held)

    return in_descending_order(docs).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)
