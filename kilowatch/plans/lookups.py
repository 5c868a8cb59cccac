"""Lookups over the alert table and the latest meter states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.functions.text import METER_ID_PATTERN
from kilowatch.operators.alerts import OPEN, READING_DAYS, newest, retain
from kilowatch.operators.scoring import ELEVATION, FLAT, SPIKE

# Default and largest number of rows a lookup returns.
DEFAULT_LIMIT, MAX_LIMIT = 50, 500


def clamp_limit(value: object, default: int = DEFAULT_LIMIT, largest: int = MAX_LIMIT) -> int:
    """Limit argument as given by a caller; anything that is no number gives the default."""
    try:
        number = int(value)
    except (TypeError, ValueError):
        return default
    return max(0, min(number, largest))


def check_meter_id(meter_id: str) -> str:
    import re

    if not re.fullmatch(METER_ID_PATTERN, meter_id):
        raise ValueError(f"not a meter id: {meter_id!r}")
    return meter_id


def first_rows(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows, or all. ``clamp_limit`` is for limits that come from a request."""
    return rows if limit is None else rows.limit(limit)


def recent_alerts(alerts: DataFrame, meter: str | Column, limit: int | None = None) -> DataFrame:
    """Newest alerts of one meter, by equality: an id never matches a longer one."""
    if isinstance(meter, str):
        check_meter_id(meter)
    rows = alerts.where(F.col("meter_id") == meter)
    return first_rows(rows.orderBy(F.desc("ts"), "anomaly_type", F.desc("z_score")), limit)


def open_alerts(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    rows = alerts.where(F.col("status") == OPEN)
    return first_rows(rows.orderBy(F.desc("ts"), "meter_id", "anomaly_type", F.desc("z_score")), limit)


def alert_type_counts(alerts: DataFrame) -> DataFrame:
    counts = alerts.groupBy("anomaly_type").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "anomaly_type")


def top_meters(alerts: DataFrame, limit: int | None = 10) -> DataFrame:
    counts = alerts.groupBy("meter_id").agg(F.count("*").alias("alert_count"))
    return first_rows(counts.orderBy(F.desc("alert_count"), "meter_id"), limit)


def meter_state(states: DataFrame, meter: str) -> DataFrame:
    """Current statistics of a meter; no row when it is unknown."""
    return states.where(F.col("meter_id") == check_meter_id(meter))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """One row of totals over the open alerts, with the meter that has most of them or N/A."""
    opened = alerts.where(F.col("status") == OPEN)
    per_meter = opened.groupBy("meter_id").agg(
        F.count("*").alias("_all"),
        *[F.count_if(F.col("anomaly_type") == t).alias(f"_{t}") for t in (SPIKE, ELEVATION, FLAT)],
    )
    # Most alerts first, then the smallest id.
    best = F.min_by("meter_id", F.struct(-F.col("_all"), F.col("meter_id")))
    return per_meter.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(name)
            for c, name in (
                ("_all", "total_open_alerts"), (f"_{SPIKE}", "spike_count"),
                (f"_{ELEVATION}", "sustained_count"), (f"_{FLAT}", "flatline_count"),
            )
        ],
        F.coalesce(best, F.lit("N/A")).alias("top_offending_meter"),
    )


def latest_readings(readings: DataFrame, as_of: Column, days: int = READING_DAYS) -> DataFrame:
    """Newest reading per meter inside the retention horizon."""
    return newest(retain(readings, "ts", days, as_of), ["meter_id"], ["ts", "reading_id"])
