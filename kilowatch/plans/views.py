"""The stored views, and the row counts of all tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.functions import clock
from kilowatch.operators.rollup import row_counts
from kilowatch.operators.scoring import ELEVATION, FLAT, SPIKE
from kilowatch.plans.reports import since, with_actuals


def hourly_anomaly_counts(scored: DataFrame, as_of: Column | None = None, days: int = 30) -> DataFrame:
    return (
        since(scored, days, as_of)
        .where("is_anomaly")
        .groupBy("reading_date", clock.hour_text(F.col("ts")).alias("hour"), "anomaly_type")
        .agg(
            F.count("*").alias("anomaly_count"),
            F.avg("severity").alias("avg_severity"),
            F.avg("kwh_hourly").alias("avg_kwh"),
        )
    )


def top_anomaly_meters(scored: DataFrame, limit: int = 50) -> DataFrame:
    def of_type(name: str) -> Column:
        return F.count_if(F.col("anomaly_type") == name)

    return (
        scored.where("is_anomaly")
        .groupBy("meter_id", "acorn_group", "tariff_type")
        .agg(
            F.count("*").alias("total_anomalies"),
            of_type(SPIKE).alias("spikes"),
            of_type(ELEVATION).alias("sustained"),
            of_type(FLAT).alias("flatlines"),
            F.avg("severity").alias("avg_severity"),
            F.max("z_score").alias("max_z_score"),
        )
        .orderBy(F.desc("total_anomalies"), "meter_id")
        .limit(limit)
    )


def daily_consumption(readings: DataFrame) -> DataFrame:
    return readings.groupBy("reading_date", "acorn_group", "tariff_type").agg(
        F.count_distinct("meter_id").alias("meter_count"),
        F.sum("kwh_hourly").alias("total_kwh"),
        F.avg("kwh_hourly").alias("avg_kwh_per_meter_hour"),
        F.max("kwh_hourly").alias("peak_kwh"),
        F.avg("temp_high_c").alias("avg_temp_high"),
    )


def forecast_vs_actual(
    forecasts: DataFrame, demand: DataFrame, as_of: Column | None = None, days: int = 7
) -> DataFrame:
    """Forecast points of the last days with the actual value where it is known."""
    end = clock.latest(demand) if as_of is None else as_of
    recent = forecasts.where(F.col("ts") >= clock.days_before(end, days))
    error = F.abs(F.col("predicted_mw") - F.col("_actual"))
    return with_actuals(recent, demand, "left").select(
        "ts", "zone", "predicted_mw", F.col("_actual").alias("actual_mw"),
        error.alias("abs_error_mw"),
        (F.try_divide(error, F.nullif(F.col("_actual"), F.lit(0.0))) * 100).alias("pct_error"),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return row_counts(tables)
