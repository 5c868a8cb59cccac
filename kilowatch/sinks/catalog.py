"""Databases, external tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kilowatch import schemas

# Tables over Parquet folders: columns and partition columns, as stored.
TABLES: dict[str, tuple[str, list[str]]] = {
    "meter_readings": (
        "meter_id STRING, reading_date STRING, hour STRING, tariff_type STRING, acorn_group STRING, "
        "kwh_hourly DOUBLE, kwh_max DOUBLE, temp_high_c DOUBLE, temp_low_c DOUBLE, "
        "temp_range_c DOUBLE, humidity DOUBLE, ts TIMESTAMP, year STRING, month STRING",
        ["year", "month"],
    ),
    "household_stats": (schemas.METER_STATS, []),
    "zone_demand": (
        "ts TIMESTAMP, zone STRING, mw_demand DOUBLE, hour INT, day_of_week INT, "
        "is_weekend BOOLEAN, year STRING, month STRING",
        ["year", "month"],
    ),
    "scored_readings": (
        "meter_id STRING, reading_id BIGINT, ts TIMESTAMP, kwh_hourly DOUBLE, rolling_mean DOUBLE, "
        "rolling_stddev DOUBLE, z_score DOUBLE, anomaly_type STRING, severity DOUBLE, "
        "is_anomaly BOOLEAN, tariff_type STRING, acorn_group STRING, reading_date STRING, "
        "injected_anomaly STRING, n BIGINT, consecutive_high BIGINT, processed_at TIMESTAMP, "
        "reading_year STRING, reading_month STRING, batch_id BIGINT",
        ["reading_year", "reading_month", "batch_id"],
    ),
}


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")
    spark.catalog.setCurrentDatabase(name)


def register_table(spark: SparkSession, name: str, path: str, kind: str | None = None) -> DataFrame:
    """(Re)create a table over a Parquet folder and find its partitions."""
    columns, folders = TABLES[kind or name]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(folders)})" if folders else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts} LOCATION '{path}'")
    if folders:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
