"""Aggregations of readings and weather. All are partial (map side) plus final hash aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURLY_KEYS = ["meter_id", "reading_date", "hour", "tariff_type", "acorn_group"]


def rollup_hourly(enriched: DataFrame, min_slots: int = 1) -> DataFrame:
    """Slot readings to hourly totals; ``min_slots=2`` keeps only complete hours."""
    return (
        enriched.groupBy(*HOURLY_KEYS)
        .agg(
            F.sum("kwh").alias("kwh_hourly"),
            F.avg("kwh").alias("kwh_avg"),
            F.max("kwh").alias("kwh_max"),
            F.count("kwh").alias("reading_count"),
        )
        .where(F.col("reading_count") >= min_slots)
    )


def rollup_then_enrich(
    readings: DataFrame, meta: DataFrame, min_slots: int = 1, how: str = "inner"
) -> DataFrame:
    """Same rows as joining metadata first and rolling up afterwards, with a smaller join.

    Slots are summed per (meter, date, hour) before the join, so even a meter with a third of all
    readings brings one row per hour to it. Metadata is reduced to its distinct group keys with
    their multiplicity, which keeps repeated metadata rows counted as the join would count them.
    """
    slots = readings.groupBy("meter_id", "reading_date", "hour").agg(
        F.sum("kwh").alias("_sum"), F.max("kwh").alias("kwh_max"), F.count("kwh").alias("_n")
    )
    groups = meta.groupBy("meter_id", "tariff_type", "acorn_group").agg(F.count("*").alias("_copies"))
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    return (
        slots.join(groups, "meter_id", how)
        .select(
            *HOURLY_KEYS,
            (F.col("_sum") * copies).alias("kwh_hourly"),
            F.try_divide(F.col("_sum"), F.col("_n")).alias("kwh_avg"),
            "kwh_max",
            (F.col("_n") * copies).alias("reading_count"),
        )
        .where(F.col("reading_count") >= min_slots)
    )


def meter_stats(readings: DataFrame) -> DataFrame:
    """Baseline per meter over all slots; the deviation is the population one."""
    return readings.groupBy("meter_id").agg(
        F.count("kwh").alias("total_readings"),
        F.avg("kwh").alias("global_mean"),
        F.min("kwh").alias("global_min"),
        F.max("kwh").alias("global_max"),
        F.stddev_pop("kwh").alias("global_stddev"),
    )


def daily_weather(weather: DataFrame) -> DataFrame:
    return weather.groupBy("w_date").agg(
        F.avg("temp_high_c").alias("temp_high_c"),
        F.avg("temp_low_c").alias("temp_low_c"),
        F.avg("humidity").alias("humidity"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name and number of rows."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out
