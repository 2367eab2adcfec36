"""SimHash near-duplicates with pigeonring filtering.

A document's words (ASCII letters in lower case) form shingles; a fingerprint bit is set if it is
set in over half of the shingles' XXH64 values. Two fingerprints are linked if they differ in
``max_bits`` bits at most.

Candidates: the 64 bits are a ring of ``m`` segments. If two fingerprints differ in at most t bits
in all, there is a segment from which on every chain of l consecutive segments differs in at most
l * t / m bits. With m = 8 and t = 3 the budgets of chains of 1 to 8 segments are
0 0 1 1 1 2 2 3: the first two segments are equal, and so are two of the next three. These four
segments (32 bits) are the join key, one for each of 8 starts and 3 choices. On each candidate the
chain budgets are tested from that start on, and only what passes gets the full Hamming check.

Equal fingerprints are one node, so groups of copies cost one row, whatever their size. Keys held
by many fingerprints are dealt over blocks: one side by block, the other to every block of its
key. A pair is emitted under its first key only. Fingerprints that are all linked to each other
are 128 at most, and one has fewer than 43,745 within three bits; so links grow with the number of
fingerprints, not with the square of a group.

Defined results: text null or without words: fingerprint zero, linked like any other; fewer words
than a shingle: the whole sequence is the shingle; doc_id null: takes part, is never a component's
smallest; rows that repeat a doc_id are rows each; empty table: no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import pick, staged, whole_row
from parley.llm.components import components

SEED = 42
AT_ONCE = 1 << 15


def shingles(text: str | None, k: int) -> Iterator[bytes]:
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and the six ASCII blanks
    if len(words) < k:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(k))))


def fingerprint(text: str | None, k: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    digest, counts, n = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64), 0
    hashes = [digest(s, SEED) for s in shingles(text, k)]
    for at in range(0, len(hashes), AT_ONCE):
        part = np.frombuffer(b"".join(hashes[at:at + AT_ONCE]), dtype=np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, text_hash (tells rows apart that share a doc_id), fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, k) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fps, pa.int64())],
                                             names=["doc_id", "text_hash", "fp"])

    rows = pick(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def budgets(m: int, max_bits: int) -> list[int]:
    """The bits in which chains of 1 to m segments may differ."""
    return [length * max_bits // m for length in range(1, m + 1)]


def key_masks(m: int, max_bits: int) -> list[int]:
    """The bits, of a ring turned so that the chain's start is on top, that are equal in every
    pair that passes: the chain's segments without budget, and all but one of those with one bit."""
    allowed, width = budgets(m, max_bits), 64 // m
    segment = lambda i: ((1 << width) - 1) << (64 - width * (i + 1))
    equal = sum(segment(i) for i in range(m) if allowed[i] == 0)
    loose = [i for i in range(m) if allowed[i] == 1]
    if len(loose) < 2:
        return [equal]
    return [equal + sum(segment(i) for i in loose if i != gap) for gap in loose]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _turned(bits: Column, by: Column) -> Column:
    return F.call_function("shiftleft", bits, by).bitwiseOR(F.call_function("shiftrightunsigned", bits, (F.lit(64) - by).cast("int")))


def _within(turned: Column, m: int, max_bits: int) -> Column:
    """Whether every chain shorter than the ring, from the top on, keeps to its budget."""
    ok = F.lit(True)
    for length, most in enumerate(budgets(m, max_bits)[:-1], start=1):
        ok = ok & (F.bit_count(F.shiftrightunsigned(turned, 64 - length * (64 // m))) <= most)
    return ok


def link_fingerprints(fps: DataFrame, max_bits: int = 3, m: int = 8, per_block: int = 512) -> DataFrame:
    """``fps``: distinct values in column fp. Returns a, b: every pair that differs in 1 to
    ``max_bits`` bits, once."""
    if max_bits >= 2 * m or 64 % m:
        raise ValueError("m must divide 64, and a segment's budget must be under 2 bits")
    masks, width = key_masks(m, max_bits), 64 // m
    starts = [(start, c) for start in range(m) for c in range(len(masks))]
    key = lambda start, c: F.struct(
        F.lit(start * len(masks) + c).alias("slot"),
        _turned(F.col("fp"), F.lit(start * width)).bitwiseAND(F.lit(_signed(masks[c]))).alias("bits"))
    keyed = fps.select("fp", F.explode(F.array(*(key(*s) for s in starts))).alias("key")).select("key.slot", "key.bits", "fp")
    held = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("slot", "bits"))).where("n > 1")
    held = held.withColumn("blocks", F.ceil(F.col("n") / per_block).cast("int"))
    one = held.select("slot", "bits", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"), F.col("fp").alias("a"))
    other = held.select("slot", "bits", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    by_slot = F.array(*(F.struct(F.lit(i).alias("slot"), F.lit(s * width).alias("by"), F.lit(_signed(masks[c])).alias("mask"))
                        for i, (s, c) in enumerate(starts)))
    passes = lambda s: ((_turned(differ, s["by"]).bitwiseAND(s["mask"]) == 0)
                        & _within(_turned(differ, s["by"]), m, max_bits))
    first = F.get(F.filter(by_slot, passes), F.lit(0))["slot"]
    start = F.floor(F.col("slot") / len(masks)).cast("int")
    return (
        one.join(other, ["slot", "bits", "block"])
        .where(F.col("a") < F.col("b"))
        .where(_within(_turned(differ, start * width), m, max_bits))
        .where(F.bit_count(differ) <= max_bits)
        .where(first == F.col("slot"))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (the component's fingerprint),
    component_id (the smallest doc_id reachable)."""
    marked = staged(fingerprints(docs, k), "simhash")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = components(link_fingerprints(nodes.select("fp"), max_bits))
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return marked.join(grouped.select("fp", "root").join(smallest, "root"), "fp")


def keep_one(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest doc_id
    (of rows that share it, the one with the smallest text hash; of equal rows, one)."""
    rank = F.struct(F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")
    kept = near_duplicates(docs, k, max_bits).groupBy("root").agg(F.min(rank).alias("kept"))
    kept = kept.select("kept.late", "kept.id", "kept.text_hash")
    doc_id = F.col("`doc_id`").cast("long")
    rows = docs.select(whole_row(docs).alias("row"), doc_id.isNull().alias("late"), F.coalesce(doc_id, F.lit(0)).alias("id"),
                       F.xxhash64(F.col("`text`").cast("string")).alias("text_hash"))
    key = ["late", "id", "text_hash"]
    once = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    return rows.join(kept, key, "left_semi").withColumn("once", once).where("once = 1").select("row.*")
