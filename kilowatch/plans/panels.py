"""Dashboard panels. Each is one aggregation or one top-k over a table or a view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kilowatch.functions import clock
from kilowatch.functions.numbers import half_up
from kilowatch.plans.reports import error_measures, since
from kilowatch.plans.views import forecast_vs_actual, hourly_anomaly_counts, top_anomaly_meters

# Z-scores that grade a household.
CRITICAL_Z, WARNING_Z = 4.5, 3.0


def hours_before(end: Column, hours: int) -> Column:
    return end - F.make_dt_interval(hours=F.lit(hours))


def live_alert_feed(
    scored: DataFrame, as_of: Column | None = None, limit: int = 50,
    zone: str | None = None, meter: str | None = None,
) -> DataFrame:
    """Newest anomalies since the day before ``as_of``."""
    rows = since(scored, 1, as_of).where("is_anomaly")
    if zone is not None:
        rows = rows.where(F.col("zone") == zone)
    if meter is not None:
        rows = rows.where(F.col("meter_id") == meter)
    return (
        rows.select("ts", "meter_id", "anomaly_type", "severity", "kwh_hourly", "z_score", "acorn_group")
        .orderBy(F.desc("ts"), "meter_id")
        .limit(limit)
    )


def anomaly_type_share(scored: DataFrame) -> DataFrame:
    """Anomalies by type with their share in percent.

    The unpartitioned window sees one row per anomaly type, never readings.
    """
    counts = scored.where("is_anomaly").groupBy("anomaly_type").agg(F.count("*").alias("count"))
    total = F.sum("count").over(W.partitionBy())
    return counts.withColumn("pct", F.round(F.col("count") * 100.0 / total, 0)).orderBy(
        F.desc("count"), "anomaly_type"
    )


def anomalies_by_day(scored: DataFrame, as_of: Column | None = None, days: int = 30) -> DataFrame:
    return (
        hourly_anomaly_counts(scored, as_of, days)
        .groupBy("reading_date", "anomaly_type")
        .agg(F.sum("anomaly_count").alias("anomaly_count"))
        .orderBy("reading_date", "anomaly_type")
    )


def forecast_last_hours(
    forecasts: DataFrame, demand: DataFrame, as_of: Column | None = None, hours: int = 48
) -> DataFrame:
    end = clock.latest(demand) if as_of is None else as_of
    rows = forecast_vs_actual(forecasts, demand, as_of)
    return (
        rows.where((F.col("ts") > hours_before(end, hours)) & (F.col("ts") <= end))
        .select("ts", "zone", "predicted_mw", "actual_mw")
        .orderBy("ts", "zone")
    )


def flagged_meters(scored: DataFrame, limit: int = 20) -> DataFrame:
    return (
        top_anomaly_meters(scored)
        .select("meter_id", "acorn_group", "total_anomalies")
        .orderBy(F.desc("total_anomalies"), "meter_id")
        .limit(limit)
    )


def load_kpis(forecasts: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Peak and mean forecast of the next hours."""
    end = as_of + F.make_dt_interval(hours=F.lit(hours))
    return forecasts.where((F.col("ts") >= as_of) & (F.col("ts") <= end)).agg(
        F.max("predicted_mw").alias("peak_predicted_24h"),
        F.avg("predicted_mw").alias("avg_predicted_24h"),
        F.max("ts").alias("last_forecast_ts"),
        F.max("forecast_run_ts").alias("last_forecast_run"),
    )


def consumption_heatmap(readings: DataFrame) -> DataFrame:
    return readings.groupBy("acorn_group", F.col("hour").cast("int").alias("hour_of_day")).agg(
        half_up(F.avg("kwh_hourly"), 4).alias("avg_kwh")
    )


def accuracy_kpis(forecasts: DataFrame, demand: DataFrame, as_of: Column | None = None) -> DataFrame:
    """MAE, RMSE and MAPE of the last days, over the points with an actual value."""
    known = forecast_vs_actual(forecasts, demand, as_of).where(F.col("actual_mw").isNotNull())
    measures = error_measures(F.col("predicted_mw"), F.col("actual_mw"))
    return known.agg(*[c.alias(m) for m, c in measures.items()])


def anomalies_last_hours(scored: DataFrame, as_of: Column | None = None, hours: int = 1) -> DataFrame:
    end = clock.latest(scored, "processed_at") if as_of is None else as_of
    recent = scored.where("is_anomaly").where(F.col("processed_at") >= hours_before(end, hours))
    return recent.groupBy("anomaly_type").agg(F.count("*").alias("cnt")).orderBy("anomaly_type")


def next_forecast_hours(
    forecasts: DataFrame, as_of: Column, hours: int = 6, zone: str | None = None
) -> DataFrame:
    """Forecasts of the next hours, ``as_of`` itself left out, of every zone or one."""
    end = as_of + F.make_dt_interval(hours=F.lit(hours))
    rows = forecasts.where((F.col("ts") > as_of) & (F.col("ts") <= end))
    if zone is not None:
        rows = rows.where(F.col("zone") == zone)
    return rows.select("ts", "zone", "predicted_mw", "actual_mw").orderBy("ts", "zone")


def meter_drilldown(scored: DataFrame, meter: str | Column, limit: int = 48) -> DataFrame:
    """Last readings of one meter."""
    return (
        scored.where(F.col("meter_id") == meter)
        .select("ts", "kwh_hourly", "z_score", "anomaly_type")
        .orderBy(F.desc("ts"), "kwh_hourly")
        .limit(limit)
    )


def meter_kpis(scored: DataFrame, as_of: Column | None = None, hours: int = 48) -> DataFrame:
    """Of the last hours, per meter: anomalies, largest z, mean kWh, time of the last anomaly."""
    end = clock.latest(scored) if as_of is None else as_of
    recent = scored.where((F.col("ts") > hours_before(end, hours)) & (F.col("ts") <= end))
    return recent.groupBy("meter_id").agg(
        F.count_if("is_anomaly").alias("anomalies_48h"),
        F.max("z_score").alias("max_z_score"),
        F.avg("kwh_hourly").alias("avg_kwh"),
        F.max(F.when(F.col("is_anomaly"), F.col("ts"))).alias("last_anomaly_ts"),
    )


def operations_kpis(
    readings: DataFrame, scored: DataFrame, forecasts: DataFrame, demand: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """One row: total consumption, active meters, alerts in the last hour, 24-hour MAPE."""
    end = clock.latest(demand) if as_of is None else as_of
    last_alert_end = clock.latest(scored, "processed_at") if as_of is None else as_of
    alerts = scored.where("is_anomaly").where(F.col("processed_at") >= hours_before(last_alert_end, 1))
    recent = forecasts.where((F.col("ts") > hours_before(end, 24)) & (F.col("ts") <= end))
    known = forecast_vs_actual(recent, demand, as_of)
    return readings.agg(
        F.sum("kwh_hourly").alias("total_kwh"), F.count_distinct("meter_id").alias("active_meters")
    ).withColumns(
        {
            "alerts_last_hour": alerts.agg(F.count("*")).scalar(),
            "mape_24h": known.agg(F.avg("pct_error")).scalar(),
        }
    )


def load_curve(readings: DataFrame) -> DataFrame:
    """Total and mean consumption by hour of day."""
    return (
        readings.groupBy(F.col("hour").cast("int").alias("hour_of_day"))
        .agg(F.sum("kwh_hourly").alias("total_kwh"), F.avg("kwh_hourly").alias("avg_kwh"))
        .orderBy("hour_of_day")
    )


def alerts_by_zone(alerts: DataFrame) -> DataFrame:
    """Alerts and open alerts per zone."""
    return (
        alerts.groupBy("zone")
        .agg(F.count("*").alias("alerts"), F.count_if(F.col("status") == "open").alias("open_alerts"))
        .orderBy(F.desc("alerts"), "zone")
    )


def household_status(
    scored: DataFrame, limit: int = 20, critical: float = CRITICAL_Z, warning: float = WARNING_Z
) -> DataFrame:
    """Households with most anomalies, graded by their largest z-score."""
    per_meter = scored.where("is_anomaly").groupBy("meter_id", "zone").agg(
        F.count("*").alias("anomalies"), F.max("z_score").alias("max_z_score")
    )
    grade = (
        F.when(F.col("max_z_score") > critical, "Critical")
        .when(F.col("max_z_score") > warning, "Warning")
        .otherwise("Normal")
    )
    return (
        per_meter.withColumn("status", grade).orderBy(F.desc("anomalies"), "meter_id").limit(limit)
    )
