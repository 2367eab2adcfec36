"""The stage store: what is paid for once, what names a table, markers and removal."""

import pytest
from pyspark.sql import functions as F

from parley.operators import model_stage as ms
from parley.plans.standins import stub_model
from parley.plans.store import MARKER, StageStore, files_version
from parley.session import scratch_path


def requests_of(spark, n, prefix="say"):
    df = spark.range(n).select(F.col("id").alias("call_id"), F.concat(F.lit(prefix + " "), F.col("id").cast("string")).alias("content"))
    return ms.build_messages(df, "system", "content")


def counting(calls, stop=None):
    """The stand-in model, counting the requests that it answers; ``stop``: fails for ids from this on."""
    def run(batches):
        def seen():
            for b in batches:
                if stop is not None and (b["request_id"] >= stop).any():
                    raise RuntimeError("the service is gone")
                calls.add(len(b))
                yield b
        yield from stub_model(seen())
    return run


def test_a_broken_stage_loses_a_part_at_most(spark):
    store, calls = StageStore(spark, scratch_path(spark, "store")), spark.sparkContext.accumulator(0)
    reqs = requests_of(spark, 200)
    with pytest.raises(Exception, match="the service is gone"):
        store.complete("say", reqs, counting(calls, stop="8"), parts=4)
    below = reqs.where("request_id < '8'")
    kept = store.responses("say")
    assert kept.join(below, "request_id", "left_anti").count() == 0
    failed = below.join(kept, "request_id", "left_anti")  # no answer: may be asked again
    first_run = calls.value
    again, calls2 = StageStore(spark, store.root), spark.sparkContext.accumulator(0)
    responses, version = again.complete("say", reqs, counting(calls2), parts=4)
    plain = spark.sparkContext.accumulator(0)
    whole, _ = StageStore(spark, scratch_path(spark, "store")).complete("say", reqs, counting(plain), parts=1)
    rows = lambda df: sorted((r.request_id, r.attempt, r.model, r.status, r.text) for r in df.collect())
    assert rows(responses) == rows(whole)
    assert first_run + calls2.value == plain.value + failed.count()
    assert StageStore(spark, store.root).complete("say", reqs, counting(calls2), parts=4)[1] == version


def test_new_rows_pay_for_themselves_only(spark):
    store = StageStore(spark, scratch_path(spark, "store"))
    _, old = store.complete("say", requests_of(spark, 30), stub_model)
    calls = spark.sparkContext.accumulator(0)
    both = requests_of(spark, 30).unionByName(requests_of(spark, 10, "ask"))
    responses, version = store.complete("say", both, counting(calls))
    assert version != old
    fresh = requests_of(spark, 10, "ask").join(responses, "request_id").count()
    silent = both.join(responses, "request_id", "left_anti").count()
    assert calls.value == fresh + silent


def test_too_large_answers_are_not_paid_again(spark):
    reqs = requests_of(spark, 4).cache()
    ids = sorted(r.request_id for r in reqs.collect())
    known = [(ids[0], 1, "ok", "base"), (ids[1], 1, "too_large", "base"), (ids[2], 1, "too_large", "base"), (ids[2], 2, "too_large", "large"),
             (ids[3], 1, "rate_limited", "base")]
    models = {"base": ms.BASE_MODEL, "large": ms.LARGE_MODEL}
    existing = spark.createDataFrame([(i, n, models[m], s, "t" if s == "ok" else None, 1, 1) for i, n, s, m in known], ms.RESPONSES)
    asked = ms.next_calls(reqs, existing).collect()
    assert sorted((r.request_id, r.attempt, r.model) for r in asked) == [(ids[1], 2, ms.LARGE_MODEL), (ids[3], 2, ms.BASE_MODEL)]


def test_rate_limits_are_tried_again(spark):
    store = StageStore(spark, scratch_path(spark, "store"))

    def limited(batches):
        for b in batches:
            late = b["attempt"] > 2
            yield b[["request_id", "attempt", "model"]].assign(status=late.map({True: "ok", False: "rate_limited"}),
                                                             text=late.map({True: "yes", False: None}), tokens_in=1, tokens_out=1)

    responses, _ = store.complete("say", requests_of(spark, 6), limited, parts=2, retries=3)
    assert responses.groupBy("request_id").agg(F.max("attempt").alias("n")).where("n = 3").count() == 6
    assert ms.merge_responses(requests_of(spark, 6), responses, ["call_id"]).where("status = 'done'").count() == 6
    few, _ = StageStore(spark, scratch_path(spark, "store")).complete("say", requests_of(spark, 6), limited, parts=1, retries=0)
    assert few.where("status = 'ok'").count() == 0 and few.count() == 12


def test_what_names_a_table(spark):
    store, built = StageStore(spark, scratch_path(spark, "store")), []

    def build():
        built.append(1)
        return spark.range(5).select("id", (F.col("id") * 2).alias("x"))

    first, key = store.table("double", build, ["a"], factor=2)
    second, same = StageStore(spark, store.root).table("double", build, ["a"], factor=2)
    assert key == same and built == [1] and second.schema == first.schema and second.count() == 5
    assert store.table("double", build, ["b"], factor=2)[1] != key
    assert store.table("double", build, ["a"], factor=3)[1] != key
    assert len(built) == 3


def test_what_has_no_marker_does_not_count(spark):
    store = StageStore(spark, scratch_path(spark, "store"))
    folder = f"{store.root}/tables/{store.key('t', ['a'])}"
    spark.range(3).write.parquet(f"{folder}/broken")
    spark.range(3).write.parquet(f"{store.root}/responses/say/broken/rows")
    assert store.responses("say") is None
    df, _ = store.table("t", lambda: spark.range(7), ["a"])
    assert df.count() == 7
    assert store._mark(folder, part="broken", schema="") is False  # the first marker stays
    assert StageStore(spark, store.root).table("t", lambda: 1 / 0, ["a"])[0].count() == 7


def test_removal_keeps_what_the_run_used(spark):
    old = StageStore(spark, scratch_path(spark, "store"))
    old.table("t", lambda: spark.range(1), ["old"])
    old.complete("say", requests_of(spark, 5), stub_model, parts=1)
    spark.range(3).write.parquet(f"{old.root}/responses/say/broken/rows")
    new = StageStore(spark, old.root)
    new.table("t", lambda: spark.range(2), ["new"])
    gone = new.remove_unused()
    assert len(gone) == 2 and any("broken" in g for g in gone)
    assert new.table("t", lambda: 1 / 0, ["new"])[0].count() == 2
    assert new.responses("say").count() > 0
    assert new.table("t", lambda: spark.range(9), ["old"])[0].count() == 9


def test_version_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    one = files_version(spark, path)
    assert files_version(spark, path) == one
    spark.range(1).write.mode("append").parquet(path)
    assert files_version(spark, path) != one
    assert MARKER not in one
