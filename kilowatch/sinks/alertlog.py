"""The stored alert table: appended by micro-batches, its status kept apart, old rows retired.

Alerts lie in day=.../part=FIRST-LAST, the span of micro-batches that wrote the part. A retention run
merges the parts of a day into one that spans them all, and the reader takes a part only if no other spans
it; a day beyond the horizon is marked as retired and read no more. Spanned parts and retired days are
removed by the run after, so a reader that has opened them goes on reading.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatch.functions import clock
from kilowatch.operators.alerts import ALERT_DAYS, ALERT_KEY, ALERT_VERSIONS, compact, resolutions, with_status
from kilowatch.sinks import folders


def _span(part: str) -> tuple[int, int]:
    first, _, last = part.partition("=")[2].partition("-")
    return int(first), int(last)


def _uncovered(parts: list[str]) -> list[str]:
    """Parts that no other part spans."""
    spans = {p: _span(p) for p in parts}
    return [
        p for p, (first, last) in spans.items()
        if not any(q != p and a <= first and last <= b for q, (a, b) in spans.items())
    ]


RETIRED = "retired"


class AlertLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _days(self) -> dict[str, list[str]]:
        """Names of the folders of each day; of days as many as the horizon has."""
        days = [d for d in folders.subfolders(self.spark, self.path) if d.startswith("day=")]
        return {d: folders.subfolders(self.spark, f"{self.path}/{d}") for d in days}

    def parts(self) -> dict[str, list[str]]:
        """Names of the parts of each day that is not retired."""
        return {d: [p for p in names if p.startswith("part=")] for d, names in self._days().items() if RETIRED not in names}

    def _write(self, alerts: DataFrame, first: int, last: int) -> None:
        name = f"{first:012d}-{last:012d}"
        (
            alerts.withColumns({"day": F.coalesce(clock.date_text(F.col("ts")), F.lit("none")), "part": F.lit(name)})
            .hint("rebalance", F.col("day"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "part").parquet(self.path)
        )

    def append(self, alerts: DataFrame, batch_id: int) -> None:
        """Alerts of a micro-batch; a repeated batch replaces its own."""
        self._write(alerts, batch_id, batch_id)

    def _read(self, chosen: list[str]) -> DataFrame | None:
        chosen = [c for c in chosen if folders.has_files(self.spark, f"{self.path}/{c}")]
        if not chosen:
            return None
        rows = self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{c}" for c in chosen])
        return rows.drop("day", "part")

    def read(self) -> DataFrame | None:
        """All versions of all alerts; None if nothing was written yet."""
        return self._read([f"{d}/{p}" for d, parts in self.parts().items() for p in _uncovered(parts)])

    def retire(
        self, as_of: dt.datetime, upto: int, days: int = ALERT_DAYS, versions: int = ALERT_VERSIONS,
        keys: list[str] = ALERT_KEY, version: str = "created_at",
    ) -> None:
        """Drop alerts older than ``days``, keep the newest ``versions`` per key, merge the parts of a day.

        Batches up to ``upto`` are finished. Days that lie in one part, without expired rows, stay as they
        are; days beyond the horizon go as folders, unread.
        """
        horizon = as_of - dt.timedelta(days=days)
        edge, touched = f"day={horizon.date()}", []
        for day, names in self._days().items():
            if RETIRED in names:
                folders.remove(self.spark, f"{self.path}/{day}")
                continue
            if day < edge:
                folders.make(self.spark, f"{self.path}/{day}/{RETIRED}")
                continue
            parts = [p for p in names if p.startswith("part=")]
            current = _uncovered(parts)
            for old in set(parts) - set(current):
                folders.remove(self.spark, f"{self.path}/{day}/{old}")
            done = [p for p in current if _span(p)[1] <= upto]
            if len(done) > 1 or (done and day == edge):
                touched += [f"{day}/{p}" for p in done]
        rows = self._read(touched)
        if rows is None:
            return
        kept = compact(rows, keys, version, "ts", days, versions, F.lit(as_of))
        first = min(_span(p.rpartition("/")[2])[0] for p in touched)
        self._write(kept, first, upto)
        # A part without rows covers the parts of a day of which nothing was kept.
        for day in {t.partition("/")[0] for t in touched}:
            folders.make(self.spark, f"{self.path}/{day}/part={first:012d}-{upto:012d}")


class StatusLog:
    """Status rows of alerts, appended per request; the newest one of an alert holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def resolve(self, alerts: DataFrame, requests: DataFrame, request: str) -> None:
        """Close the requested ``(meter_id, ts, resolved_at)``; unknown alerts are ignored, and a repeated
        ``request`` replaces its own rows."""
        resolutions(alerts, requests).write.mode("overwrite").parquet(f"{self.path}/request={request}")

    def read(self, as_of: Column | None = None) -> DataFrame | None:
        """Status rows written up to ``as_of``; None if there are none."""
        if not folders.subfolders(self.spark, self.path):
            return None
        rows = self.spark.read.parquet(self.path).drop("request")
        return rows if as_of is None else rows.where(F.col("updated_at") <= as_of)

    def applied(self, alerts: DataFrame, as_of: Column | None = None) -> DataFrame:
        """Alerts with the status they had at ``as_of``, now by default."""
        rows = self.read(as_of)
        if rows is None:
            return alerts.withColumn("resolved_at", F.lit(None).cast("timestamp"))
        return with_status(alerts, rows)
