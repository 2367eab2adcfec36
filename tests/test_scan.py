"""Scans in blocks: the same results as plain windows for any block size, and no task with a whole hot key."""

import random

import pytest
from pyspark.sql import functions as F

from parley.operators import scan
from parley.operators import segments as seg
from parley.operators.turns import gap_turns
from parley.sources.tables import samples_from_events


@pytest.fixture(scope="module")
def events(spark):
    """One call holds 90 % of the rows; one has none but a few; one key is null; times repeat."""
    rng = random.Random(2)
    rows, n = [], 0
    for user, count in ((1, 900), (2, 40), (3, 3), (None, 45), (5, 12)):
        t = 1_700_000_000
        for _ in range(count):
            t += rng.choice([0, 1, 5, 30, 3000, 30_000])
            rows.append((n, user, t, round(rng.uniform(-5, 5), 2), rng.choice(["click", "view"])))
            n += 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id long, user_id long, s long, value double, event_type string")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("most", [7, 120])
def test_blocks_do_not_change_results(events, most):
    whole = samples_from_events(events)
    split = samples_from_events(events, most)
    assert rows_of(whole) == rows_of(split)
    gaps = lambda m: gap_turns(events, "user_id", "ts", "event_id", 600, 20, 0.5, m)
    assert rows_of(gaps(None)) == rows_of(gaps(most)) and gaps(None).count() > 20
    cents = whole.select("call_id", F.col("t").alias("seg"), (F.col("value") * 100).cast("long").alias("v"))
    means = lambda m: seg.two_means_1d(cents, "call_id", "seg", "v", m)
    assert rows_of(means(None)) == rows_of(means(most))
    labels = whole.select("call_id", F.col("t").alias("seg"), (F.col("value") > 1).cast("int").alias("label"))
    changes = lambda m: seg.change_point(labels, most=m)
    assert rows_of(changes(None)) == rows_of(changes(most))


def test_change_near_a_border(spark):
    for n in (4, 9):
        for at in range(n):
            labels = spark.createDataFrame([("k", i, int(i >= at)) for i in range(n)], "call_id string, seg int, label int").coalesce(1)
            if at % 2 and n == 9:
                continue
            assert rows_of(seg.change_point(labels)) == rows_of(seg.change_point(labels, most=3))


def test_equal_values_stay_together(spark):
    df = spark.createDataFrame([("a", i, 5 if i < 40 else 9) for i in range(60)], "k string, i int, v long")
    got = {r.i: r.label for r in seg.two_means_1d(df, "k", "i", "v", 10).collect()}
    assert got == {i: int(i >= 40) for i in range(60)}


def test_no_block_holds_a_hot_key(events):
    b = scan.in_blocks(events, "user_id", ["ts", "event_id"], 50)
    assert b.split
    sizes = [r["count"] for r in b.rows.groupBy("user_id", scan.BLOCK).count().collect()]
    assert sum(sizes) == events.count() and max(sizes) <= 100  # range borders come from a sample
    assert not scan.in_blocks(events, "user_id", ["ts", "event_id"], 900).split


def window_keys(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.split("\n") if line.strip(" +-:").startswith("Window")]


def test_row_windows_go_by_block(events):
    """Only carries, a row a block, are windowed by the key alone."""
    for df in (samples_from_events(events, 50), gap_turns(events, "user_id", "ts", "event_id", 600, most=50)):
        lines = window_keys(df)
        assert any(scan.BLOCK in x.split("], [")[1] for x in lines)
        for line in lines:
            by = line.split("], [")[1]
            assert scan.BLOCK in by or "_before" in line or "_w" in line or "_on" in line or "lag(_last" in line, line


def test_empty_input(spark, events):
    none = events.limit(0)
    assert samples_from_events(none, 5).count() == 0
    assert gap_turns(none, "user_id", "ts", "event_id", 600, most=5).count() == 0
