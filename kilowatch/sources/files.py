"""Readers of raw and cleaned files. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatch import schemas
from kilowatch.functions import clock, text


def raw_readings(spark: SparkSession, path: str) -> DataFrame:
    """Half-hourly reading files; header lines stay in and are dropped by the cleaner."""
    return spark.read.schema(schemas.RAW_READING).option("mode", "PERMISSIVE").csv(path)


def household_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HOUSEHOLD_META).csv(path)


def weather(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Weather file, by column name; commas inside quotes do not shift columns.

    ``columns`` maps our names to the names in the header where they differ.
    """
    raw = spark.read.option("header", True).csv(path)
    names = {c: c for c in ("time", "temp_high", "temp_low", "humidity")} | (columns or {})
    return raw.select(*[F.col(f"`{theirs}`").cast("string").alias(ours) for ours, theirs in names.items()])


def clean_readings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLEAN_READING).option("header", False).csv(path)


def clean_readings_text(spark: SparkSession, path: str) -> DataFrame:
    """The same files with every cell as text, for the event parser."""
    return spark.read.schema(schemas.CLEAN_READING_TEXT).option("header", False).csv(path)


def meter_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METER_STATS).option("header", False).csv(path)


def zone_demand(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """All zone files of a folder as ``(ts, zone, mw_demand)`` with calendar columns.

    The zone of a file stands only in its header. All files are read in one pass as text lines
    with their file name; the header line of each file gives the zone of its rows, so a hundred
    thousand files are still one scan and one join, not one plan branch per file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = (
        spark.read.schema("_a string, _b string")
        .option("header", False)
        .csv(paths)
        .withColumn("_file", F.input_file_name())
    )
    is_header = F.lower(F.trim("_a")) == "datetime"
    headers = lines.where(is_header).groupBy("_file").agg(
        F.max(text.zone_of_header(F.trim("_b"))).alias("zone")
    )
    rows = lines.where(~is_header).join(headers, "_file")
    demand = rows.select(
        F.try_to_timestamp(F.trim("_a"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        "zone",
        F.trim("_b").try_cast("double").alias("mw_demand"),
    ).dropna(subset=["ts", "mw_demand"])
    return clock.with_calendar(demand)


def parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Partitioned Parquet; filters on partition columns prune folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def with_partition_bounds(
    df: DataFrame, date_from: str, date_to: str, year: str = "reading_year", month: str = "reading_month"
) -> DataFrame:
    """Add the partition predicate that a filter on ``reading_date`` alone does not give."""
    folder = F.concat_ws("-", F.col(year), F.col(month))
    return df.where(
        folder.between(date_from[:7], date_to[:7]) & F.col("reading_date").between(date_from, date_to)
    )
