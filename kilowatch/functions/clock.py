"""Date, time and calendar expressions. Dates are text ``yyyy-MM-dd``; hours text ``00``-``23``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.functions.text import two_digits

# Day numbers (1 = Sunday) that make a weekend.
WEEKEND = [1, 7]


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_s(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def hour_text(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def slot_timestamp(date: Column, hour: Column) -> Column:
    """Timestamp of a date text and an hour text; NULL when they do not form one."""
    text = F.concat(F.trim(date), F.lit("T"), two_digits(hour), F.lit(":00:00"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def year_text(ts: Column) -> Column:
    return F.year(ts).cast("string")


def month_text(ts: Column) -> Column:
    return F.lpad(F.month(ts).cast("string"), 2, "0")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(WEEKEND)


def days_before(as_of: Column, days: int) -> Column:
    return F.date_sub(as_of.cast("date"), days)


def latest(df: DataFrame, column: str = "ts") -> Column:
    """Largest value of a column as a scalar subquery: no round trip to the driver."""
    return df.agg(F.max(column)).scalar()


def cyclic(col: Column, period: int, pi: float | None = None) -> tuple[Column, Column]:
    angle = F.lit(2.0) * (F.lit(pi) if pi else F.pi()) * col.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def with_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, day_of_week (1 = Sunday), is_weekend, year and month of a timestamp."""
    t = F.col(ts)
    return df.withColumns(
        {
            "year": year_text(t),
            "month": month_text(t),
            "hour": F.hour(t),
            "day_of_week": F.dayofweek(t),
            "is_weekend": is_weekend(t),
        }
    )
