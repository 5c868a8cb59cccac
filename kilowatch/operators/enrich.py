"""Joins with household metadata and daily weather.

Metadata grow with the fleet and get no hint: the engine decides from their measured size and falls
back to a shuffled join whose skewed keys are split at run time. Daily weather has one row per
calendar day, under 40 000 rows a century, and is broadcast: a shuffle by date would spread the
readings over as few tasks as there are days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_meta(readings: DataFrame, meta: DataFrame, how: str = "inner") -> DataFrame:
    return readings.join(meta, "meter_id", how)


def attach_weather(hourly: DataFrame, weather_daily: DataFrame, how: str = "inner") -> DataFrame:
    """``weather_daily`` as :func:`rollup.daily_weather` gives it, one row per date."""
    weather = weather_daily.withColumnRenamed("w_date", "reading_date")
    return hourly.join(F.broadcast(weather), "reading_date", how)


def unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows an inner join would drop, to be counted or kept aside."""
    keys = right.select(F.col(right_key).alias("_key"))
    return left.join(keys, left[left_key] == keys["_key"], "left_anti")
