"""UDF-2, STR-1: retries as a stream of attempts, with the wait kept in state.

Outcomes of calls ``(request_id, attempt, status, ts)`` arrive as they happen. Each request has a
state: its last attempt, the model it was on, and how often it was too large. What is too large goes
to the larger model at once, and is ``BIG ERROR`` the second time. What is rate limited sets a timer
and is called again when the wait is over; an attempt that arrives before that, or a restart, loses
nothing, since state and timers are in the checkpoint. The routing is that of
:func:`parley.operators.model_stage.next_attempts`, which is the same rule over a finished table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parley.constants import BASE_MODEL, BIG_ERROR, LARGE_MODEL
from parley.streaming.ingest import run_available

ATTEMPTS = "request_id string, attempt long, status string, ts timestamp"
#: ``of_attempt`` is the attempt that was decided on; ``status`` retry, ok or BIG ERROR.
DECISIONS = "request_id string, of_attempt long, attempt long, model string, status string"
STATE = "attempt long, model string, too_large int, limited boolean"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Router(StatefulProcessor):
    """Decides on every attempt of a request, in order."""

    def __init__(self, wait_s: float):
        self.wait_ms = int(wait_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", STATE)

    def _decided(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=["request_id", "of_attempt", "attempt", "model", "status"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        request, out = key[0], []
        held = self.last.get()
        attempt, _, too_large, _ = held if held is not None else (0, BASE_MODEL, 0, False)
        first: dict[int, tuple] = {}
        for part in rows:
            for n, status, ts in zip(part["attempt"], part["status"], part["ts"]):
                first.setdefault(int(n), (status, ts))
        came = [(n, *first[n]) for n in sorted(first) if n > attempt]  # the others were seen before
        if not came:
            return
        # timers go off between calls of this function: only one set before, and that of the last attempt, matter
        if held is not None and held[3]:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        for n, status, _ in came:
            model = LARGE_MODEL if too_large else BASE_MODEL
            if status == "ok":
                out.append((request, n, n, model, "ok"))
            elif status == "too_large":
                too_large += 1
                out.append((request, n, n, model, BIG_ERROR) if too_large > 1 else (request, n, n + 1, LARGE_MODEL, "retry"))
        attempt, status, ts = came[-1]
        if status == "rate_limited":
            self.handle.registerTimer(int(ts.timestamp() * 1000) + self.wait_ms)
        self.last.update((attempt, model, too_large, status == "rate_limited"))
        yield from self._decided(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        attempt, model, _, limited = self.last.get()
        yield from self._decided([(key[0], attempt, attempt + 1, model, "retry")] if limited else [])

    def close(self) -> None:
        pass


def route_available(spark: SparkSession, source_dir: str, sink_path: str, checkpoint_path: str, wait_s: float = 45.0,
                    late: str = "10 minutes") -> DataFrame:
    """Take every file of ATTEMPTS below ``source_dir`` that ``checkpoint_path`` has not seen; return all DECISIONS so far.
    A wait is over when attempts from after it have come, ``late`` the longest that one may come behind later ones."""
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        stream = spark.readStream.schema(ATTEMPTS).parquet(source_dir).withWatermark("ts", late)
        routed = stream.groupBy("request_id").transformWithStateInPandas(
            statefulProcessor=Router(wait_s), outputStructType=DECISIONS, outputMode="Append", timeMode="EventTime")
        run_available(routed, sink_path, checkpoint_path)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return spark.read.schema(DECISIONS).parquet(sink_path).drop("epoch")


def standing(decisions: DataFrame) -> DataFrame:
    """What holds for each request by its last attempt: a retry or ``BIG ERROR``; none where it was ok."""
    last = decisions.groupBy("request_id").agg(F.max_by(F.struct("attempt", "model", "status"), "of_attempt").alias("d"))
    return last.select("request_id", "d.*").where("status <> 'ok'")
