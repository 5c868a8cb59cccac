"""The keyed alert table: versions, status, latest state, retention.

Alerts and states are append-only; the newest version of a key wins on read. ``row_number() <= n``
plans a partial limit before the exchange, so a key with many versions stays cheap to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, RESOLVED = "open", "resolved"
ALERT_KEY = ["meter_id", "ts"]

# Retention horizons in days and versions kept.
READING_DAYS, READING_VERSIONS = 30, 1
ALERT_DAYS, ALERT_VERSIONS = 90, 3


def alerts_from_scored(scored: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Anomalous readings as open alerts."""
    stamp = F.current_timestamp() if created_at is None else created_at
    household = [c for c in ("acorn_group", "tariff_type") if c in scored.columns]
    return scored.where("is_anomaly").select(
        "meter_id", "ts", "kwh_hourly", F.round("z_score", 3).alias("z_score"), "anomaly_type",
        F.round("severity", 2).alias("severity"), *household,
        F.lit(OPEN).alias("status"), stamp.alias("created_at"),
    )


def newest(df: DataFrame, keys: list[str], by: list[Column | str], n: int = 1) -> DataFrame:
    """The ``n`` newest rows per key."""
    w = W.partitionBy(*keys).orderBy(*[F.desc(c) if isinstance(c, str) else c for c in by])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def resolutions(alerts: DataFrame, requests: DataFrame) -> DataFrame:
    """Status rows for the requested ``(meter_id, ts, resolved_at)``; unknown keys give none."""
    known = requests.join(alerts.select(*ALERT_KEY), ALERT_KEY, "left_semi")
    return known.select(
        *ALERT_KEY, F.lit(RESOLVED).alias("status"), "resolved_at",
        F.col("resolved_at").alias("updated_at"),
    )


def with_status(alerts: DataFrame, status_rows: DataFrame) -> DataFrame:
    """Alerts with their newest status and ``resolved_at``."""
    latest = newest(status_rows, ALERT_KEY, ["updated_at", "status"]).select(
        *ALERT_KEY, F.col("status").alias("_status"), "resolved_at"
    )
    joined = alerts.join(latest, ALERT_KEY, "left")
    return joined.withColumn("status", F.coalesce("_status", "status")).drop("_status")


def retain(df: DataFrame, ts: str, days: int, as_of: Column) -> DataFrame:
    """Rows younger than ``days`` at ``as_of``."""
    return df.where(F.col(ts) > as_of - F.make_dt_interval(days=F.lit(days)))


def compact(
    df: DataFrame, keys: list[str], version: str, ts: str, days: int, versions: int, as_of: Column
) -> DataFrame:
    """Retention job: drop expired rows, keep the newest versions per key."""
    return newest(retain(df, ts, days, as_of), keys, [version], versions)


def meter_states(
    scored: DataFrame, order: tuple[str, ...] = ("ts", "reading_id"), digits: int | None = 5
) -> DataFrame:
    """Latest rolling statistics per meter, rounded to ``digits``.

    ``max_by`` aggregates on the map side: one row per meter and task crosses the shuffle.
    """
    def stat(name: str) -> Column:
        return F.col(name) if digits is None else F.round(name, digits).alias(name)

    state = F.struct(
        F.col("n").alias("count"), stat("rolling_mean"), stat("rolling_stddev"),
        "consecutive_high",
        F.col("ts").alias("last_updated"),
    )
    return scored.groupBy("meter_id").agg(F.max_by(state, F.struct(*order)).alias("_s")).select(
        "meter_id", "_s.*"
    )


def merge_states(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored snapshot with newer rows of ``updates`` laid over it."""
    both = stored.unionByName(updates.select(*stored.columns))
    rest = [c for c in stored.columns if c != "meter_id"]
    picked = both.groupBy("meter_id").agg(
        F.max_by(F.struct(*rest), F.col("last_updated")).alias("_s")
    )
    return picked.select("meter_id", "_s.*").select(*stored.columns)


def zscore_history(
    scored: DataFrame, length: int = 48, order: tuple[str, ...] = ("ts", "reading_id")
) -> DataFrame:
    """The last ``length`` z-scores per meter, oldest first, rounded to 3."""
    kept = newest(scored, ["meter_id"], list(order), length)
    entry = F.struct(*order, F.round("z_score", 3).alias("z"))
    return kept.groupBy("meter_id").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["z"]).alias("last_n_zscore")
    )


def newest_first_key(meter: Column, ts: Column) -> Column:
    """Text key that sorts the newest alert of a meter first.

    Fixed format: meter, underscore, seconds that remain to 99999999999.
    """
    return F.format_string("%s_%d", meter, F.lit(99_999_999_999) - F.unix_seconds(ts.cast("timestamp")))
