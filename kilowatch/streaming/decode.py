"""Messages to typed events. Works on streams and batches alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch import schemas
from kilowatch.functions import text


def decode_marked(messages: DataFrame) -> DataFrame:
    """``key, value`` messages as events with ``reject_reason``, null for a valid one.

    ``ts`` is an event-time timestamp, fit for a watermark; ``key`` and ``value`` stay with the row.
    """
    payload = F.from_json(F.col("value").cast("string"), schemas.METER_EVENT)
    decoded = messages.select(F.col("key").cast("string"), F.col("value").cast("string"), payload.alias("_event"))
    when = F.try_to_timestamp("_event.ts", F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    reason = (
        F.when(F.col("_event.meter_id").isNull(), "no_meter")
        .when(F.col("_event.kwh_hourly").isNull(), "no_value")
        .when(F.isnan("_event.kwh_hourly") | F.abs("_event.kwh_hourly").isin(float("inf")), "not_finite")
        .when(F.col("_event.kwh_hourly") < 0, "negative_value")
        .when(when.isNull(), "bad_timestamp")
    )
    marked = decoded.withColumns({"reject_reason": reason, "_ts": when})
    return marked.select("key", "value", "reject_reason", "_event.*", "_ts").withColumn("ts", F.col("_ts")).drop("_ts")


def decode_events(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, value`` messages -> (valid events, rejected messages with a reason)."""
    marked = decode_marked(messages)
    valid = marked.where(F.col("reject_reason").isNull()).drop("key", "value", "reject_reason")
    return valid, marked.where(F.col("reject_reason").isNotNull()).select("key", "value", "reject_reason")


def _number(name: str, blank: Column | None = None) -> Column:
    """Numeric cell; a blank gives the default where there is one."""
    cell = F.trim(name)
    value = cell.try_cast("double")
    return value if blank is None else F.when(cell.isNull() | (cell == ""), blank).otherwise(value)


def event_records(clean_text: DataFrame) -> DataFrame:
    """Text rows of the cleaned files to event records; malformed rows are left out."""
    hour = text.two_digits(F.col("hour"))
    date = F.trim("reading_date")
    zero = F.lit(0.0)
    out = clean_text.select(
        F.trim("meter_id").alias("meter_id"),
        F.concat(date, F.lit("T"), hour, F.lit(":00:00")).alias("ts"),
        _number("kwh_hourly").alias("kwh_hourly"),
        _number("kwh_max", zero).alias("kwh_max"),
        date.alias("reading_date"),
        hour.alias("hour"),
        F.trim("tariff_type").alias("tariff_type"),
        F.trim("acorn_group").alias("acorn_group"),
        _number("temp_high_c", zero).alias("temp_high_c"),
        _number("temp_low_c", zero).alias("temp_low_c"),
        _number("humidity", zero).alias("humidity"),
        F.lit(True).alias("simulated"),
        F.lit("none").alias("injected_anomaly"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("ingest_time"),
    )
    required = ["meter_id", "ts", "kwh_hourly", "kwh_max", "temp_high_c", "temp_low_c", "humidity"]
    return out.dropna(subset=required)


def event_messages(records: DataFrame) -> DataFrame:
    """Records as messages keyed by meter, so one meter stays in order inside one partition."""
    return records.select(F.col("meter_id").alias("key"), F.to_json(F.struct("*")).alias("value"))


def with_partition_folders(df: DataFrame) -> DataFrame:
    date = F.col("reading_date")
    return df.withColumns(
        {
            "reading_year": text.between_positions(date, 0, 4),
            "reading_month": text.between_positions(date, 5, 7),
        }
    )


def date_bounds(df: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Rows of the days from ``date_from`` to ``date_to``, both included."""
    if date_from is not None:
        df = df.where(F.col("reading_date") >= date_from)
    if date_to is not None:
        df = df.where(F.col("reading_date") <= date_to)
    return df


