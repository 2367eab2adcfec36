"""Segments of a call: AGG-3, WIN-2, WIN-3, CLU-1, CLU-2, FIL-4, JOIN-3.

``samples(call_id, t, value)``: one value per time step; a segment (frame) is ``floor(t / size)``
and only complete frames count (SCL-15). Ordered windows go in blocks where a call is long
(:mod:`parley.operators.scan`); aggregations use partial (map-side) combination.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.constants import EDGE_FILTER_LEN, EDGE_OFFSET, FEATURES, SEGMENT_SECONDS
from parley.functions import signal as sg
from parley.operators.scan import BLOCK, before, in_blocks, numbered


def with_segments(samples: DataFrame, size: int = SEGMENT_SECONDS) -> DataFrame:
    """Add ``seg``. FIL-6: a segment has a length."""
    sg.positive("segment size", size)
    return samples.withColumn("seg", F.floor(F.col("t") / size).cast("bigint"))


def frame_samples(samples: DataFrame, size: int = SEGMENT_SECONDS) -> DataFrame:
    """Add ``seg``; drop the incomplete last frame of each call."""
    s = with_segments(samples, size)
    count = F.count(F.lit(1)).over(Window.partitionBy("call_id", "seg"))
    return s.withColumn("_n", count).where(F.col("_n") == size).drop("_n")


def segment_stats(samples: DataFrame, value_col: str = "value", size: int = SEGMENT_SECONDS, **more) -> DataFrame:
    """AGG-3: per complete (call, seg): mean, population sd, median, max, min, n, and ``more``
    aggregates by name, in one aggregation of the samples."""
    v = F.col(value_col)
    return with_segments(samples, size).groupBy("call_id", "seg").agg(
        F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"), F.median(v).alias("median"),
        F.max(v).alias("max"), F.min(v).alias("min"), F.count(F.lit(1)).alias("n"),
        *(a.alias(name) for name, a in more.items())).where(F.col("n") == size)


def spectral_features(frames: DataFrame, mag: str = "mag") -> DataFrame:
    """AGG-3: the 18 features per (call, seg) over the segment's frames ``(call_id, seg, mag)``, under
    the names of the feature files. A segment has few frames, so its medians have little state."""
    fr = frames.select("call_id", "seg", sg.centroid(mag).alias("c"), sg.flatness(mag).alias("f"),
                       sg.rolloff(mag, 0.99).cast("double").alias("r99"), sg.rolloff(mag, 0.01).cast("double").alias("r01"))
    stats = {"mean": F.avg, "sd": F.stddev_pop, "median": F.median, "max": F.max, "min": F.min}
    parts = [("c", s) for s in ("mean", "sd", "median", "max", "min")] + [("f", s) for s in ("mean", "median", "sd")] + [
        (r, s) for r in ("r99", "r01") for s in ("mean", "median", "sd", "min", "max")]
    return fr.groupBy("call_id", "seg").agg(*(stats[s](F.col(c)).alias(name) for (c, s), name in zip(parts, FEATURES)))


def two_means_1d(df: DataFrame, key: str, order: str, value_col: str, most: int | None = None) -> DataFrame:
    """CLU-1, exact in one dimension: the optimal 2-means split of a call's sorted values is the
    prefix maximising ``cum^2/k + (tot-cum)^2/(n-k)`` among splits between distinct values.
    ``label`` is 1 for the upper cluster, 0 otherwise (all 0 when no split exists).
    Integer values keep the objective identical across engines. A call with more than ``most`` rows
    is worked in blocks, whose counts and sums add up."""
    b = in_blocks(df, key, [value_col, order], most)
    w, w_all, v = b.window(), Window.partitionBy(key), F.col(value_col)
    d = (b.rows.withColumn("_k", F.row_number().over(w))
         .withColumn("_cum", F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("_next", F.lead(v).over(w)))
    if b.split:
        over = b.over_blocks()
        carry = b.rows.groupBy(key, BLOCK).agg(F.count(F.lit(1)).alias("_cn"), F.sum(v).alias("_cs"), F.min(v).alias("_cv"))
        carry = carry.select(key, BLOCK, F.sum("_cn").over(w_all).alias("_n"), F.sum("_cs").over(w_all).alias("_tot"),
                             before(F.col("_cn"), over).alias("_kb"), before(F.col("_cs"), over).alias("_cb"),
                             F.lead("_cv").over(over).alias("_after"))
        d = b.carried(d, carry).withColumns({"_k": F.col("_k") + F.col("_kb"), "_cum": F.col("_cum") + F.col("_cb"),
                                             "_next": F.coalesce("_next", "_after")})
    else:
        d = d.withColumn("_n", F.count(F.lit(1)).over(w_all)).withColumn("_tot", F.sum(v).over(w_all))
    rest = F.col("_tot") - F.col("_cum")
    # squares as 38-digit decimals: a call's sum may pass the root of the largest bigint
    square = lambda x: (x.cast("decimal(19,0)") * x.cast("decimal(19,0)")).cast("double")
    score = square(F.col("_cum")) / F.col("_k") + square(rest) / (F.col("_n") - F.col("_k"))
    valid = (F.col("_k") < F.col("_n")) & (F.col("_next") > v)
    d = d.withColumn("_cand", F.when(valid, F.struct(score.alias("s"), (-F.col("_k")).alias("nk"))))
    if b.split:
        best = d.groupBy(key, BLOCK).agg(F.max("_cand").alias("_b"))
        d = b.carried(d, best.select(key, BLOCK, F.max("_b").over(w_all).alias("_top")))
    else:
        d = d.withColumn("_top", F.max("_cand").over(w_all))
    best = -F.col("_top")["nk"]
    label = F.when(best.isNotNull() & (F.col("_k") > best), 1).otherwise(0)
    return d.select(*df.columns, label.alias("label"))


def change_point(labels: DataFrame, key: str = "call_id", seg: str = "seg", label: str = "label",
                 segment_seconds: int = SEGMENT_SECONDS, most: int | None = None) -> DataFrame:
    """WIN-2 + WIN-3: ``(key, change_seg, start_s, too_short)``.

    Score at position i (0-based, i <= n-4): ``100 * |l_i + l_i+1 - l_i+2 - l_i+3| - i`` (the
    reference's ``|conv| - 0.01 i`` scaled to integers, behaviour B16); the first best position
    plus 2 is the change segment. Fewer than 4 segments: null, start 0, ``too_short``
    (behaviour B15). No edge at all still yields position 0, i.e. segment 2 (behaviour B23).
    Positions are ranks in ``seg`` order. A call with more than ``most`` segments is worked in blocks,
    each of which is lent the first labels of the blocks behind it.
    """
    b = in_blocks(labels.select(key, seg, label), key, [seg], most)
    w, l0, reach = b.window(), F.col(label), EDGE_FILTER_LEN - 1
    d = numbered(b, "_i")
    ahead = [F.lead(l0, j).over(w) for j in range(1, EDGE_FILTER_LEN)]
    if b.split:
        over = b.over_blocks()
        carry = b.rows.withColumn("_r", F.row_number().over(w)).groupBy(key, BLOCK).agg(
            F.array_sort(F.collect_list(F.when(F.col("_r") <= reach, F.struct("_r", F.col(label).alias("l"))))).alias("_head"),
            F.max("_r").alias("_last"))
        lent = F.flatten(F.collect_list(F.transform("_head", lambda x: x["l"])).over(over.rowsBetween(1, reach)))
        d = b.carried(d, carry.select(key, BLOCK, "_last", lent.alias("_lent")))
        left = F.col("_last") - F.row_number().over(w)  # rows of the block behind this one
        ahead = [F.when(left >= j, lead).otherwise(F.get("_lent", j - 1 - left)) for j, lead in enumerate(ahead, 1)]
    d = d.withColumn("_score", 100 * F.abs(l0 + ahead[0] - ahead[1] - ahead[2]) - F.col("_i"))
    agg = d.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("_score").isNotNull(), F.struct(F.col("_score"), (-F.col("_i")).alias("ni")))).alias("_b"))
    short = F.col("_n") < EDGE_FILTER_LEN
    cs = F.when(short, F.lit(None)).otherwise(-F.col("_b.ni") + EDGE_OFFSET).cast("bigint")
    return agg.select(key, cs.alias("change_seg"),
                      F.coalesce(cs * segment_seconds, F.lit(0)).cast("bigint").alias("start_s"),
                      short.alias("too_short"))


def cut_before(rows: DataFrame, changes: DataFrame, key: str, time_col: str) -> DataFrame:
    """FIL-4 + JOIN-3: keep rows at or after their call's start time (calls without a change
    point row are kept whole). An equi-join on the call key; AQE broadcasts the change table
    when its measured size is small."""
    j = rows.join(changes.select(key, "start_s"), key, "left")
    return j.where(F.col("start_s").isNull() | (F.col(time_col) >= F.col("start_s"))).drop("start_s")


# ---- CLU-1 in many dimensions -------------------------------------------------------------------

#: Features are integers of this many parts of one, so that sums are exact in any order.
UNIT = 1_000_000
STARTS, MOST_STEPS = 10, 300


def two_means(df: DataFrame, key: str, seg: str, features: list[str], write: Callable[[DataFrame, str], DataFrame],
              standardise: bool = False, starts: int = STARTS, most_steps: int = MOST_STEPS) -> DataFrame:
    """CLU-1: 2-means per call on the feature columns, the best of ``starts`` starts: ``(key, seg, label)``; raw
    features by default (behaviour B18). Label 0 is the cluster of the call's first segment.

    All starts of all calls run at once. A start takes a segment by a hash, and the segment farthest
    from it. In a step, each segment is labelled under every start by the centres of its call (an
    array), and its features go into partial sums per (call, start, label); only these few sums leave
    the tasks, and only centres are written between steps, with ``write``. Starts whose sums did not
    change are done; calls without an open start take no part in further steps. The start with the
    smallest sum of squared distances wins, the first of equal ones.

    Features are rounded to ``UNIT`` parts of one and added up as integers, so the centres, and with
    them the steps, do not depend on the order of rows. Missing features count as 0; a segment at
    equal distance has label 0. More than ``most_steps`` steps are an error that names a call."""
    at = range(len(features))
    x = df.select(F.col(key).alias("_key"), F.col(seg).alias("_seg"), F.array(*(
        F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features)).alias("_x"))
    if standardise:
        each = lambda fn: F.array(*(fn(F.col("_x")[i]) for i in at))
        spread = x.groupBy("_key").agg(each(F.avg).alias("mean"), each(F.stddev_pop).alias("sd"))
        scaled = F.zip_with("_x", F.arrays_zip("mean", "sd"), lambda v, m: F.when(m["sd"] > 0, (v - m["mean"]) / m["sd"]).otherwise(0.0))
        x = x.join(spread, "_key").select("_key", "_seg", scaled.alias("_x"))
    x = write(x.select("_key", "_seg", F.transform("_x", lambda v: F.floor(v * UNIT + 0.5).cast("long")).alias("_x")), "two-means")
    away = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: (u.cast("double") - v) * (u.cast("double") - v)), F.lit(0.0), lambda s, v: s + v)
    mean = lambda total, n: F.when(n > 0, F.transform(total, lambda v: v / n))
    to = lambda c, i: away(F.col("_x"), mean(c[f"s{i}"], c[f"n{i}"]))
    label = lambda c: F.when(to(c, 1) < to(c, 0), 1).otherwise(0)

    # a state: of each call and start, sums and counts of both clusters
    number = F.sequence(F.lit(0), F.lit(starts - 1))
    by_hash = lambda s: F.md5(F.concat_ws(":", s.cast("string"), F.col("_seg").cast("string")))
    drawn = [F.min_by("_x", F.struct(by_hash(F.lit(s)), F.col("_seg"))) for s in range(starts)]
    first = write(x.groupBy("_key").agg(F.array(*drawn).alias("_a")), "two-means")
    distance = lambda s: F.struct(away(F.col("_x"), F.get("_a", F.lit(s))).alias("d"), (-F.col("_seg")).alias("g"))
    far = x.join(first, "_key").groupBy("_key").agg(F.array(*(F.max_by("_x", distance(s)) for s in range(starts))).alias("_b"))
    one = F.lit(1).cast("long")
    state = write(first.join(far, "_key").select("_key", F.explode(F.transform(number, lambda s: F.struct(
        s.alias("start"), F.get("_a", s).alias("s0"), one.alias("n0"), F.get("_b", s).alias("s1"), one.alias("n1")))).alias("c"))
        .select("_key", "c.*", F.lit(True).alias("open")), "two-means")

    centres = lambda df: df.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("start", "s0", "n0", "s1", "n1"))).alias("_c"))
    for step in range(most_steps + 1):
        go_on = state.where("open")
        stuck = go_on.agg(F.count(F.lit(1)), F.first("_key")).first()
        if not stuck[0]:
            break
        if step == most_steps:
            raise RuntimeError(f"two-means of call {stuck[1]} is not done after {most_steps} steps")
        told = x.join(centres(go_on), "_key").select("_key", "_x", F.explode(F.transform("_c", lambda c: F.struct(
            c["start"].alias("start"), label(c).alias("label")))).alias("l"))
        sums = told.groupBy("_key", "l.start", "l.label").agg(F.count(F.lit(1)).alias("n"), F.array(*(F.sum(F.col("_x")[i]) for i in at)).alias("s"))
        of = lambda i, c: F.max(F.when(F.col("label") == i, F.col(c)))
        none = F.array_repeat(F.lit(0).cast("long"), len(features))
        after = sums.groupBy("_key", "start").agg(*(a for i in (0, 1) for a in (
            F.coalesce(of(i, "s"), none).alias(f"t{i}"), F.coalesce(of(i, "n"), F.lit(0).cast("long")).alias(f"m{i}"))))
        same = (F.col("s0") == F.col("t0")) & (F.col("n0") == F.col("m0")) & (F.col("s1") == F.col("t1")) & (F.col("n1") == F.col("m1"))
        moved = go_on.join(after, ["_key", "start"]).select("_key", "start", F.col("t0").alias("s0"), F.col("m0").alias("n0"),
                                                            F.col("t1").alias("s1"), F.col("m1").alias("n1"), (~same).alias("open"))
        state = write(moved.unionByName(state.where("not open")), "two-means")
    to_own = F.transform("_c", lambda c: F.struct(c["start"].alias("start"), F.least(to(c, 0), to(c, 1)).alias("d")))
    spread = x.join(centres(state), "_key").select("_key", F.explode(to_own).alias("l")).groupBy("_key", "l.start").agg(F.sum("l.d").alias("d"))
    best = spread.groupBy("_key").agg(F.min(F.struct(F.round("d", -3), "start")).alias("b")).select("_key", F.col("b.start").alias("start"))
    chosen = state.join(best, ["_key", "start"]).select("_key", F.struct("s0", "n0", "s1", "n1").alias("_c"))
    labelled = x.join(chosen, "_key").select("_key", "_seg", label(F.col("_c")).alias("label"))
    begins = labelled.groupBy("_key").agg(F.min_by("label", "_seg").alias("_first"))
    return labelled.join(begins, "_key").select(F.col("_key").alias(key), F.col("_seg").alias(seg),
                                                (F.col("label") != F.col("_first")).cast("int").alias("label"))
