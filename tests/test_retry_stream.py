"""Retries as a stream: waits, restarts, repeated and overtaken attempts."""

from datetime import datetime, timedelta

import pandas as pd

from parley.constants import BASE_MODEL, BIG_ERROR, LARGE_MODEL
from parley.session import scratch_path
from parley.streaming.retry import ATTEMPTS, Router, route_available, standing

BEGIN = datetime(2025, 1, 1)


def test_waits_and_restarts(spark):
    folder, sink, seen = (scratch_path(spark, f"retry-{x}") for x in ("source", "sink", "seen"))

    def run(*rows):
        came = [(r, n, status, BEGIN + timedelta(seconds=at)) for r, n, status, at in rows]
        spark.createDataFrame(came, ATTEMPTS).coalesce(1).write.mode("append").parquet(folder)
        found = route_available(spark, folder, sink, seen, wait_s=45, late="10 seconds")
        return {tuple(r) for r in found.collect() if r.request_id}, {tuple(r) for r in standing(found).collect()}

    # a is limited, b too large, c fine, d limited and answered within the wait; every run is a restart
    all_rows, now = run(("a", 1, "rate_limited", 0), ("b", 1, "too_large", 0), ("c", 1, "ok", 0), ("d", 1, "rate_limited", 0))
    assert all_rows == {("b", 1, 2, LARGE_MODEL, "retry"), ("c", 1, 1, BASE_MODEL, "ok")}
    assert now == {("b", 2, LARGE_MODEL, "retry")}
    all_rows, now = run(("d", 2, "ok", 30), ("b", 1, "too_large", 30))
    assert now == {("b", 2, LARGE_MODEL, "retry")} and ("d", 2, 2, BASE_MODEL, "ok") in all_rows  # b's repeat is nothing new
    # the wait of a is over, that of d was called off
    all_rows, now = run(("b", 2, "too_large", 200), ("", 1, "ok", 200))
    assert now == {("a", 2, BASE_MODEL, "retry"), ("b", 2, LARGE_MODEL, BIG_ERROR)}
    assert not any(r[0] == "d" and r[4] == "retry" for r in all_rows)
    # attempts of one request in one file, out of order
    _, now = run(("a", 3, "ok", 420), ("a", 2, "too_large", 400), ("e", 2, "rate_limited", 420), ("e", 1, "too_large", 400), ("", 2, "ok", 900))
    assert now == {("b", 2, LARGE_MODEL, BIG_ERROR), ("e", 3, LARGE_MODEL, "retry")}


def test_timers_are_touched_once_a_batch():
    class Handle:
        def __init__(self):
            self.listed, self.held, self.timers = 0, None, []

        def getValueState(self, name, schema):  # noqa: N802
            return self

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

        def listTimers(self):  # noqa: N802
            self.listed += 1
            return self.timers

        def deleteTimer(self, timer):  # noqa: N802
            self.timers = [t for t in self.timers if t != timer]

        def registerTimer(self, timer):  # noqa: N802
            self.timers = [*self.timers, timer]

    handle, router = Handle(), Router(45)
    router.init(handle)
    rows = lambda ns, status: iter([pd.DataFrame({"attempt": ns, "status": status, "ts": [BEGIN + timedelta(seconds=n) for n in ns]})])
    list(router.handleInputRows(("a",), rows(list(range(1, 101)), "rate_limited"), None))
    assert handle.listed == 0 and handle.timers == [int((BEGIN + timedelta(seconds=145)).timestamp() * 1000)]
    list(router.handleInputRows(("a",), rows([101], "ok"), None))
    assert handle.listed == 1 and handle.timers == [] and handle.held[0] == 101
