"""The named consumption, anomaly and accuracy reports.

Each takes the tables it reads and returns a DataFrame. ``as_of`` replaces "now" in relative date
filters; by default it is the newest time in the table, found by a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.functions import clock
from kilowatch.functions.numbers import half_up


def _hour(column: str = "hour") -> Column:
    return F.col(column).cast("int")


def since(df: DataFrame, days: int, as_of: Column | None, ts: str = "ts") -> DataFrame:
    """Rows whose ``reading_date`` is at most ``days`` days before ``as_of``."""
    end = clock.latest(df, ts) if as_of is None else as_of
    return df.where(F.col("reading_date").try_cast("date") >= clock.days_before(end, days))


def peak_hours(readings: DataFrame) -> DataFrame:
    """Consumption by hour of day."""
    return (
        readings.groupBy("hour")
        .agg(
            half_up(F.avg("kwh_hourly"), 4).alias("avg_kwh"),
            half_up(F.max("kwh_hourly"), 4).alias("peak_kwh"),
            half_up(F.stddev_pop("kwh_hourly"), 4).alias("stddev_kwh"),
            F.count_distinct("meter_id").alias("meters"),
        )
        .orderBy(_hour())
    )


def monthly_trend(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("year", "month")
        .agg(
            half_up(F.sum("kwh_hourly"), 2).alias("total_kwh"),
            half_up(F.avg("kwh_hourly"), 4).alias("avg_kwh_per_meter_hour"),
            F.count_distinct("meter_id").alias("active_meters"),
            half_up(F.avg("temp_high_c"), 2).alias("avg_temp_high_c"),
        )
        .orderBy("year", "month")
    )


def anomaly_breakdown(scored: DataFrame) -> DataFrame:
    """Anomalies by household group and type."""
    return (
        scored.where("is_anomaly")
        .groupBy("acorn_group", "anomaly_type")
        .agg(
            F.count("*").alias("anomaly_count"),
            half_up(F.avg("severity"), 3).alias("avg_severity"),
            half_up(F.avg("z_score"), 3).alias("avg_zscore"),
            F.count_distinct("meter_id").alias("affected_meters"),
        )
        .orderBy(F.desc("anomaly_count"), "acorn_group", "anomaly_type")
    )


def anomaly_rate_trend(scored: DataFrame, as_of: Column | None = None, days: int = 60) -> DataFrame:
    """Share of flagged readings per day."""
    rate = F.try_divide(F.count_if(F.col("is_anomaly")) * 100.0, F.count("*"))
    return (
        since(scored, days, as_of)
        .groupBy("reading_date")
        .agg(
            F.count("*").alias("total_readings"),
            F.count_if(F.col("is_anomaly")).alias("anomaly_count"),
            half_up(rate, 2).alias("anomaly_rate_pct"),
        )
        .orderBy("reading_date")
    )


def top_consumers(readings: DataFrame, stats: DataFrame, limit: int = 20) -> DataFrame:
    """Meters with the largest total.

    Readings are totalled per meter before the join with the baseline table: the join sees one row
    per meter and group, not every reading.
    """
    totals = readings.groupBy("meter_id", "acorn_group", "tariff_type").agg(
        F.sum("kwh_hourly").alias("_total"),
        F.avg("kwh_hourly").alias("_avg"),
        F.max("kwh_hourly").alias("_max"),
        F.count("*").alias("reading_count"),
    )
    return (
        totals.join(stats.select("meter_id"), "meter_id")
        .select(
            "meter_id", "acorn_group", "tariff_type",
            half_up("_total", 2).alias("total_kwh"),
            half_up("_avg", 4).alias("avg_kwh_hourly"),
            half_up("_max", 4).alias("peak_kwh"),
            "reading_count",
        )
        .orderBy(F.desc("total_kwh"), "meter_id")
        .limit(limit)
    )


def with_actuals(forecasts: DataFrame, demand: DataFrame, how: str) -> DataFrame:
    actual = demand.select("ts", "zone", F.col("mw_demand").alias("_actual"))
    return forecasts.join(actual, ["ts", "zone"], how)


def error_measures(predicted: Column, actual: Column) -> dict[str, Column]:
    """Mean absolute, root mean square and mean absolute percentage error."""
    error = predicted - actual
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.avg(F.try_divide(F.abs(error), F.nullif(actual, F.lit(0.0)))) * 100,
    }


def forecast_accuracy(
    forecasts: DataFrame, demand: DataFrame, as_of: Column | None = None, days: int = 7
) -> DataFrame:
    """Forecast errors per day and zone."""
    end = clock.latest(demand) if as_of is None else as_of
    measures = error_measures(F.col("predicted_mw"), F.col("_actual"))
    recent = forecasts.where(F.col("ts") >= clock.days_before(end, days))
    return (
        with_actuals(recent, demand.where("mw_demand > 0"), "inner")
        .groupBy(F.to_date("ts").alias("forecast_date"), "zone")
        .agg(
            F.count("*").alias("forecast_points"),
            *[half_up(c, 2).alias(f"{m}_{'pct' if m == 'mape' else 'mw'}") for m, c in measures.items()],
        )
        .orderBy("forecast_date", "zone")
    )


def weekend_weekday(readings: DataFrame) -> DataFrame:
    day = F.col("reading_date").try_cast("date")
    kind = F.when(clock.is_weekend(day), "Weekend").otherwise("Weekday")
    return (
        readings.groupBy(kind.alias("day_type"), "hour")
        .agg(
            half_up(F.avg("kwh_hourly"), 4).alias("avg_kwh"),
            half_up(F.stddev_pop("kwh_hourly"), 4).alias("stddev_kwh"),
        )
        .orderBy("day_type", _hour())
    )


def weather_correlation(readings: DataFrame) -> DataFrame:
    return (
        readings.where(F.col("temp_high_c").isNotNull())
        .groupBy("year", "month")
        .agg(
            half_up(F.avg("kwh_hourly"), 4).alias("avg_kwh"),
            half_up(F.avg("temp_high_c"), 2).alias("avg_temp_high"),
            half_up(F.avg("temp_low_c"), 2).alias("avg_temp_low"),
            half_up(F.corr("kwh_hourly", "temp_high_c"), 4).alias("corr_kwh_temp_high"),
            half_up(F.corr("kwh_hourly", "humidity"), 4).alias("corr_kwh_humidity"),
        )
        .orderBy("year", "month")
    )


def tariff_by_hour(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("tariff_type", "hour")
        .agg(
            half_up(F.avg("kwh_hourly"), 4).alias("avg_kwh"),
            F.count_distinct("meter_id").alias("meter_count"),
        )
        .orderBy("tariff_type", _hour())
    )


def injection_validation(scored: DataFrame) -> DataFrame:
    """Injected against detected anomalies. ``correctly_flagged`` counts any flag, ``type_match``
    the right one."""
    return (
        scored.where("injected_anomaly != 'none'")
        .groupBy("injected_anomaly", F.col("anomaly_type").alias("detected_as"))
        .agg(
            F.count("*").alias("count"),
            half_up(F.avg("severity"), 3).alias("avg_severity"),
            half_up(F.avg("z_score"), 3).alias("avg_zscore"),
            F.count_if(F.col("is_anomaly")).alias("correctly_flagged"),
            F.count_if(~F.col("is_anomaly")).alias("missed"),
            F.count_if(F.col("injected_anomaly") == F.col("anomaly_type")).alias("type_match"),
        )
        .orderBy("injected_anomaly", "detected_as")
    )
