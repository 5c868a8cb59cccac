"""Raw text rows to typed rows. Every rejected row keeps the reason it was rejected for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kilowatch.functions import clock, text

# Ids that mark repeated header lines, and the accepted kWh range of one slot.
READING_HEADERS = ["LCLid", "MAC"]
META_HEADER = "LCLid"
WEATHER_HEADER = "time"
KWH_RANGE = (0.0, 100.0)


def _parts() -> dict[str, Column]:
    """The checked parts of a raw row. A null marker never has the shape of a number."""
    kwh_text = F.trim("kwh_raw")
    stamp = text.between_positions(F.trim("ts_raw"), 0, 19)
    parsed = F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss"))
    return {
        "header": F.col("meter_id").isNull() | F.trim("meter_id").isin(READING_HEADERS),
        "null_marker": kwh_text.isNull() | kwh_text.isin(text.NULL_MARKERS),
        "not_numeric": ~kwh_text.rlike(text.NUMBER_PATTERN),
        "out_of_range": ~kwh_text.try_cast("double").between(*KWH_RANGE),
        "bad_timestamp": stamp.isNull() | (F.length(stamp) != 19) | parsed.isNull(),
    }


def _reject_reason() -> Column:
    reason = None
    for name, failed in _parts().items():
        reason = F.when(failed, name) if reason is None else reason.when(failed, name)
    return reason


def _is_valid() -> Column:
    """True exactly where there is no reason to reject: cheap checks first, nothing twice."""
    parts = _parts()
    del parts["null_marker"]
    valid = F.lit(True)
    for failed in parts.values():
        valid = valid & ~failed
    return valid


def clean_readings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Half-hourly text readings -> (valid typed rows, rejected rows with a reason).

    Input columns ``meter_id, ts_raw, kwh_raw``; both outputs are narrow, one scan each.
    """
    stamp = F.trim("ts_raw")
    valid = raw.where(_is_valid()).select(
        F.trim("meter_id").alias("meter_id"),
        text.between_positions(stamp, 0, 19).alias("ts_str"),
        F.trim("kwh_raw").try_cast("double").alias("kwh"),
        text.between_positions(stamp, 0, 10).alias("reading_date"),
        text.between_positions(stamp, 0, 7).alias("year_month"),
        text.between_positions(stamp, 0, 4).alias("year"),
        text.between_positions(stamp, 11, 13).alias("hour"),
    )
    rejected = raw.withColumn("reject_reason", _reject_reason()).where("reject_reason IS NOT NULL")
    return valid, rejected


def clean_meta(meta: DataFrame) -> DataFrame:
    names = ["meter_id", "tariff_type", "acorn", "acorn_group"]
    return meta.where(F.trim("meter_id") != META_HEADER).select(*[F.trim(c).alias(c) for c in names])


def clean_weather(weather: DataFrame) -> DataFrame:
    """Weather text rows (``time, temp_high, temp_low, humidity``) to typed rows per date."""
    kept = weather.where(
        (F.trim("time") != WEATHER_HEADER) & (F.trim("temp_high") != "") & (F.trim("temp_low") != "")
    )
    return kept.select(
        text.between_positions(F.trim("time"), 0, 10).alias("w_date"),
        F.trim("temp_high").try_cast("double").alias("temp_high_c"),
        F.trim("temp_low").try_cast("double").alias("temp_low_c"),
        F.trim("humidity").try_cast("double").alias("humidity"),
    )


def dedup(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` plans a partial limit before the exchange, so a key with very many copies
    sends one row per map task, not all its copies.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_readings(df: DataFrame) -> DataFrame:
    """One row per ``(meter_id, ts)``: largest kWh first, then every other column, descending."""
    rest = sorted(c for c in df.columns if c not in ("meter_id", "ts", "kwh_hourly"))
    order = [F.desc_nulls_last("kwh_hourly"), *[F.desc_nulls_last(c) for c in rest]]
    return dedup(df, ["meter_id", "ts"], order)


def with_reading_columns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Timestamp, partition and temperature-range columns of cleaned hourly rows.

    Rows whose date and hour form no timestamp would land in a null partition; they come back as
    the second frame instead.
    """
    stamped = df.withColumn("ts", clock.slot_timestamp(F.col("reading_date"), F.col("hour")))
    good = stamped.where(F.col("ts").isNotNull()).withColumns(
        {
            "year": clock.year_text(F.col("ts")),
            "month": clock.month_text(F.col("ts")),
            "temp_range_c": F.col("temp_high_c") - F.col("temp_low_c"),
        }
    )
    return good, stamped.where(F.col("ts").isNull())
