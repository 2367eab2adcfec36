"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight schedule: a piecewise linear function of the training time 0..1. Its
integral is the source's share of the token budget (the size of all documents). A target never
exceeds ``max_epochs`` times its source's size; what is cut off is dealt to the other sources by
weight until no target is above its cap. In closed form: with the sources in order of
cap / weight, the common level of the open sources is (budget - caps of those before) / (weights
of the rest), and the first source whose own ratio reaches its level ends the capped ones.

The documents of a source, in a fixed hash order and repeated for as many epochs as needed, form
its token stream. A document is taken, whole, in each epoch in which its middle word lies within
the target; so a source misses its target by half of its longest document at most. Inverting the
cumulative demand (a quadratic on each piece of the schedule) turns the place in the stream into
the training position, by which :func:`training_order` range-sorts the documents.

Only DataFrame functions are used. The running sums of a source, however many rows it holds, are
split over ``16 ** digits`` hash cells: sums of whole cells first, then a window inside each cell.

Defined results: text null or without a word: size 0, taken 0; source null: a source of its own,
the last; all sizes 0: targets 0; empty table: no rows; rows that share a doc_id are ordered by a
hash of their text, and equal rows are interchangeable; further columns are handed through
:func:`training_order` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import WORD, whole_row

Schedule = Sequence[tuple[float, float]]

#: Weights 1, 2 and 3 over the whole of training: one falls, one is level, one rises.
CURRICULUM: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 2.5), (1.0, 3.5)),
)


def integrals(schedule: Schedule) -> list[float]:
    """The integral of a schedule up to each of its knots."""
    total, out = 0.0, [0.0]
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if t1 <= t0 or w0 < 0 or w1 < 0:
            raise ValueError("knots must rise in time and weights must not be negative")
        total += (w0 + w1) / 2 * (t1 - t0)
        out.append(total)
    if len(out) < 2 or total <= 0:
        raise ValueError("a schedule needs two knots and a weight above 0")
    return out


def _time_of(schedule: Schedule, share: Column) -> Column:
    """The time at which the given share (0..1) of a schedule's integral is reached."""
    upto = integrals(schedule)
    amount = share * F.lit(upto[-1])
    expr = None
    for i in reversed(range(len(schedule) - 1)):
        (t0, w0), (t1, w1) = schedule[i], schedule[i + 1]
        rest = amount - F.lit(upto[i])
        slope2 = 2 * (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(slope2) * rest))
        piece = F.lit(t0) + F.when(F.lit(w0) + root > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        expr = piece if expr is None else F.when(amount <= F.lit(upto[i + 1]), piece).otherwise(expr)
    return F.least(F.lit(1.0), expr)


def position_of(schedules: Sequence[Schedule], kind: Column, share: Column) -> Column:
    expr = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        expr = F.when(kind == i, _time_of(schedule, share)).otherwise(expr)
    return expr


def _prepared(docs: DataFrame, digits: int) -> DataFrame:
    source, text = F.col("`source`").cast("string"), F.col("`text`").cast("string")
    order = F.md5(F.concat_ws(":", F.col("`doc_id`").cast("string"), text).cast("binary"))
    return docs.select(
        whole_row(docs).alias("row"),
        F.col("`doc_id`").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("skey"),
        order.alias("h"),
        F.left(order, F.lit(digits)).alias("cell"),
    )


def source_targets(cells: DataFrame, schedules: Sequence[Schedule], max_epochs: int) -> DataFrame:
    """One row per source: skey, kind (which schedule), source_size, target. ``cells`` has sums
    by (skey, cell). The windows without a key run over one row per source, not over documents."""
    weight = F.element_at(F.array(*(F.lit(integrals(s)[-1]) for s in schedules)), (F.col("kind") + 1).cast("int"))
    by_name = Window.orderBy("skey")
    by_ratio = Window.orderBy("ratio", "skey")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        cells.groupBy("skey").agg(F.sum("size").alias("source_size"))
        .withColumn("kind", (F.row_number().over(by_name) - 1) % len(schedules))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("caps_before")) / (F.sum("weight").over(everything) - F.col("weights_before")))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "skey", "level"))).over(everything)["level"])
        .select("skey", "kind", "source_size",
                F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def mix(docs: DataFrame, schedules: Sequence[Schedule] = CURRICULUM, max_epochs: int = 3, digits: int = 4) -> DataFrame:
    """One row per document: ``row`` (the input row), ``doc_id``, ``size``, ``source_size``,
    ``target``, ``repeats`` (how often the mix takes it) and ``positions`` (one training position,
    0..1, for each time)."""
    rows = _prepared(docs, digits)
    cells = rows.groupBy("skey", "cell").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("skey", "cell", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.join(source_targets(cells, schedules, max_epochs), "skey")
    inside = Window.partitionBy("skey", "cell").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(offsets, ["skey", "cell"]).withColumn(
        "middle", F.col("offset") + F.sum("size").over(inside) - F.col("size") / 2)
    middles = F.array(*(F.col("middle") + k * F.col("source_size") for k in range(max_epochs)))
    share = lambda m: F.when(F.col("target") > 0, F.least(F.lit(1.0), m / F.col("target"))).otherwise(F.lit(0.0))
    taken = F.filter(middles, lambda m: m <= F.col("target"))
    return placed.withColumn("taken_at", taken).select(
        "row", "doc_id", "size", "source_size", "target",
        F.size("taken_at").cast("long").alias("repeats"),
        F.transform("taken_at", lambda m: position_of(schedules, F.col("kind"), share(m))).alias("positions"),
    )


def by_first_position(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`mix`, range-sorted by the first place that training takes them at; those that it never
    takes come last."""
    first = F.get("positions", F.lit(0))
    return (
        mixed.withColumn("first_position", first)
        .repartitionByRange(F.col("first_position").asc_nulls_last(), "doc_id")
        .sortWithinPartitions(F.col("first_position").asc_nulls_last(), "doc_id")
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves: each as often as it is taken, range-sorted by position, with
    the columns of the input."""
    return (
        mixed.select("row", "doc_id", F.posexplode("positions").alias("epoch", "position"))
        .repartitionByRange("position", "doc_id")
        .sortWithinPartitions("position", "doc_id", "epoch")
        .select("row.*")
    )
