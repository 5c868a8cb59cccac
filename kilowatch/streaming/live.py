"""The live job: messages in, scored readings, alerts, states and rejects out, as one streaming query.

A message is decoded once. Valid events go through the state of their meter, rejected messages pass the
same operator untouched, so each micro-batch leaves it as one table that is split over the sinks: no
second read of the source, and nothing is lost without a trace.
"""

from __future__ import annotations

import time
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from kilowatch.operators.alerts import alerts_from_scored, meter_states
from kilowatch.sinks.alertlog import AlertLog
from kilowatch.sinks.snapshots import Snapshot, upsert_states
from kilowatch.streaming.decode import decode_marked
from kilowatch.streaming.jobs import TRIGGER, Sinks, fan_out, overwrite_batch, started
from kilowatch.streaming.scorer import PASSED, score_stream

PROGRESS = (
    "name string, batch_id bigint, at string, rows bigint, rows_per_second double, duration_ms bigint, "
    "state_rows bigint, state_bytes bigint"
)


@dataclass
class LiveTables:
    """Folders of the job's tables, and the catalog's name of the meter states."""

    root: str
    states_table: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def live_scores(messages: DataFrame, **options) -> DataFrame:
    """Scored events of a stream of ``key, value`` messages, and its rejects with ``reject_reason``."""
    return score_stream(decode_marked(messages), passed=True, **options)


def live_sinks(spark: SparkSession, tables: LiveTables):
    """The writer of one micro-batch. Each sink may be repeated."""
    alerts = AlertLog(spark, tables.path("alerts"))
    states = Snapshot(spark, tables.path("states"), tables.states_table)
    rest = fan_out(Sinks(scored=tables.path("scored"), messages=tables.path("messages")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rejects = batch.where("reject_reason IS NOT NULL").select(*PASSED)
            overwrite_batch(rejects.withColumn("rejected_at", F.current_timestamp()), batch_id, tables.path("quarantine"))
            scored = batch.where("reject_reason IS NULL").drop(*PASSED)
            rest(scored, batch_id)
            alerts.append(alerts_from_scored(scored), batch_id)
            upsert_states(states, meter_states(scored), batch_id)
        finally:
            batch.unpersist()

    return write


def start_live(
    messages: DataFrame, tables: LiveTables, *, every: str = TRIGGER, bounded: bool = False, **options
) -> StreamingQuery:
    """Start the job; ``bounded`` works off what is there and ends."""
    spark = messages.sparkSession
    scored = live_scores(messages, **options)
    return started(scored, live_sinks(spark, tables), tables.path("checkpoint"), every=every, bounded=bounded)


class ProgressLog(StreamingQueryListener):
    """What the micro-batches of all queries reported: rows, rate, time, size of the state.

    Holds the newest ``most`` reports until they are stored.
    """

    def __init__(self, most: int = 10_000):
        self.reports: deque[tuple] = deque(maxlen=most)
        self.failed: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.reports.append((
            p.name, p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond),
            int(p.batchDuration), sum(s.numRowsTotal for s in p.stateOperators),
            sum(s.memoryUsedBytes for s in p.stateOperators),
        ))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed[str(event.id)] = event.exception

    def store(self, spark: SparkSession, path: str) -> int:
        """Append the reports that are not stored yet; returns their number."""
        rows = [self.reports.popleft() for _ in range(len(self.reports))]
        if rows:
            spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(path)
        return len(rows)


def run_until_any_ends(
    queries: list[StreamingQuery], log: ProgressLog | None = None, path: str | None = None, poll_s: float = 5.0,
    most_s: float | None = None,
) -> None:
    """Wait until one query ends or fails, or ``most_s`` passes; then stop all others and raise its failure."""
    began, spark = time.monotonic(), SparkSession.active()
    try:
        while all(q.isActive for q in queries) and (most_s is None or time.monotonic() - began < most_s):
            queries[0].awaitTermination(poll_s)
            if log and path:
                log.store(spark, path)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        if log and path:
            log.store(spark, path)
    for q in queries:
        if q.exception():
            raise q.exception()
