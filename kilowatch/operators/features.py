"""Demand features for training and scoring. No Python functions: windows and joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kilowatch.functions import clock
from kilowatch.operators.grid import future_slots, lags_by_time

LAGS = [1, 2, 24, 168]
WEEK, DAY = 168, 24
# Fixed value: the rounded constant of the 21-column frame.
ROUNDED_PI = 3.14159

# Names and order of the 21 feature columns.
FEATURES = [
    "lag_1h", "lag_2h", "lag_24h", "lag_168h",
    "rolling_7d_mean", "rolling_7d_stddev", "rolling_24h_mean",
    "seasonal_index", "seasonal_deviation",
    "hour_sin", "hour_cos", "month_sin", "month_cos", "is_weekend",
    "dow_1", "dow_2", "dow_3", "dow_4", "dow_5", "dow_6", "dow_7",
]


def calendar_features(df: DataFrame, pi: float | None = None) -> DataFrame:
    """Cyclic hour and month, weekend flag and one-hot weekday (1 = Sunday), all double."""
    hour_sin, hour_cos = clock.cyclic(F.hour("ts"), 24, pi)
    month_sin, month_cos = clock.cyclic(F.month("ts"), 12, pi)
    day = F.dayofweek("ts")
    return df.withColumns(
        {
            "hour_sin": hour_sin, "hour_cos": hour_cos,
            "month_sin": month_sin, "month_cos": month_cos,
            "is_weekend": clock.is_weekend(F.col("ts")).cast("double"),
            **{f"dow_{d}": F.when(day == d, 1.0).otherwise(0.0) for d in range(1, 8)},
        }
    )


def lag_columns(mw: str = "mw_demand") -> dict[str, Column]:
    """Row lags; equal to time lags on a gap-free grid."""
    w = W.partitionBy("zone").orderBy("ts")
    return {f"lag_{k}h": F.lag(mw, k).over(w) for k in LAGS}


def rolling_columns(last_row: int, mw: str = "mw_demand") -> dict[str, Column]:
    """Rolling row windows that end at the current row (0) or the row before it (-1)."""
    w = W.partitionBy("zone").orderBy("ts")
    week, day = w.rowsBetween(last_row - WEEK + 1, last_row), w.rowsBetween(last_row - DAY + 1, last_row)
    return {
        "rolling_7d_mean": F.avg(mw).over(week),
        "rolling_7d_stddev": F.stddev_samp(mw).over(week),
        "rolling_24h_mean": F.avg(mw).over(day),
    }


def range_rolling(history: DataFrame, slots: DataFrame | None = None) -> DataFrame:
    """Rolling values over time ranges ``[ts - 7 d, ts]`` and ``[ts - 24 h, ts]``, both ends in.

    With ``slots`` the values are computed for those (possibly future) slots from the observations
    of ``history``; otherwise for the rows of ``history`` itself. The deviation is the population
    one; an empty 24-hour range falls back to the weekly mean, an empty week to 0.
    """
    rows = history.select("zone", "ts", "mw_demand")
    if slots is not None:
        rows = rows.withColumn("_slot", F.lit(False)).unionByName(
            slots.select("zone", "ts", F.lit(None).cast("double").alias("mw_demand"), F.lit(True).alias("_slot"))
        )
    seconds = clock.epoch_s(F.col("ts"))
    w = W.partitionBy("zone").orderBy("_s")
    week, day = w.rangeBetween(-7 * 86_400, 0), w.rangeBetween(-86_400, 0)
    out = rows.withColumn("_s", seconds).withColumns(
        {
            "rolling_7d_mean": F.coalesce(F.avg("mw_demand").over(week), F.lit(0.0)),
            "rolling_7d_stddev": F.coalesce(F.stddev_pop("mw_demand").over(week), F.lit(0.0)),
            "_day": F.avg("mw_demand").over(day),
        }
    )
    out = out.withColumn("rolling_24h_mean", F.coalesce("_day", "rolling_7d_mean")).drop("_s", "_day")
    return out.where("_slot").drop("_slot", "mw_demand") if slots is not None else out


def seasonal_index(demand: DataFrame) -> DataFrame:
    """Mean demand per zone, month and hour."""
    return demand.groupBy("zone", F.month("ts").alias("_month"), F.hour("ts").alias("_hour")).agg(
        F.avg("mw_demand").alias("seasonal_index")
    )


def attach_seasonal(df: DataFrame, fitted_on: DataFrame) -> DataFrame:
    """Left join of the seasonal index fitted on other rows.

    A month the fitted rows never saw falls back to the mean of that zone and hour. Both tables
    have at most zones x 12 x 24 rows.
    """
    by_month = seasonal_index(fitted_on)
    by_hour = fitted_on.groupBy("zone", F.hour("ts").alias("_hour")).agg(
        F.avg("mw_demand").alias("_any_month")
    )
    keyed = df.withColumns({"_month": F.month("ts"), "_hour": F.hour("ts")})
    joined = keyed.join(by_month, ["zone", "_month", "_hour"], "left").join(
        by_hour, ["zone", "_hour"], "left"
    )
    return joined.withColumn(
        "seasonal_index", F.coalesce("seasonal_index", "_any_month")
    ).drop("_month", "_hour", "_any_month")


def engineer_features(
    demand: DataFrame, *, leak_free: bool = True, cutoff: Column | None = None
) -> tuple[DataFrame, list[str]]:
    """The 21 feature columns of every (zone, ts) row of a gap-free demand table.

    ``leak_free=False`` gives the plain frame: rolling windows include the current row, the
    seasonal index is fitted on all rows, and the deviation is that of the current row (so index
    plus deviation is the label). ``leak_free=True`` ends the windows one row earlier, fits the
    index on rows up to ``cutoff`` only and takes the deviation of the row a day before.
    Rows with an unknown feature are dropped.
    """
    windows = {**lag_columns(), **rolling_columns(-1 if leak_free else 0)}
    base = demand.select("zone", "ts", "mw_demand").withColumns(windows)
    if leak_free:
        fitted_on = demand if cutoff is None else demand.where(F.col("ts") <= cutoff)
        out = attach_seasonal(base, fitted_on)
        observed = F.col("lag_24h")
    else:
        keyed = base.withColumns({"_month": F.month("ts"), "_hour": F.hour("ts")})
        out = keyed.join(seasonal_index(demand), ["zone", "_month", "_hour"], "left").drop(
            "_month", "_hour"
        )
        observed = F.col("mw_demand")
    out = out.withColumn("seasonal_deviation", observed - F.col("seasonal_index"))
    out = calendar_features(out, None if leak_free else ROUNDED_PI)
    return out.dropna(subset=FEATURES).select("zone", "ts", "mw_demand", *FEATURES), FEATURES


def recent_history(demand: DataFrame, hours: int = 200, zone: str | None = None) -> DataFrame:
    """Rows of the last ``hours`` hours of each zone, both ends included, of all zones or one.

    A zone that lags behind keeps its own last hours. A zone has one row per hour.
    """
    rows = demand if zone is None else demand.where(F.col("zone") == zone)
    start = F.max("ts").over(W.partitionBy("zone")) - F.make_dt_interval(hours=F.lit(hours))
    return rows.withColumn("_start", start).where(F.col("ts") >= F.col("_start")).drop("_start")


def forecast_window(history: DataFrame, hours: int = 24) -> DataFrame:
    """Feature rows of the next ``hours`` slots of every zone, from observed values only.

    Near lags are unknown beyond the first slots and stay NULL; rows without the daily and weekly
    lag are dropped. Seasonal index and deviation are the weekly mean and 0.
    """
    slots = future_slots(history, hours)
    lagged = lags_by_time(slots.select("zone", "ts"), history, LAGS)
    rolled = range_rolling(history, slots)
    out = lagged.join(rolled, ["zone", "ts"]).withColumns(
        {"seasonal_index": F.col("rolling_7d_mean"), "seasonal_deviation": F.lit(0.0)}
    )
    return calendar_features(out).dropna(subset=["lag_24h", "lag_168h"]).select(
        "zone", "ts", *FEATURES
    )


def time_split(
    df: DataFrame, ts: str = "ts", test_days: int = 73
) -> tuple[DataFrame, DataFrame, Column]:
    """Rows up to the cutoff, rows after it, and the cutoff: the last ``test_days`` days are test."""
    cutoff = df.agg(F.max(ts) - F.make_dt_interval(days=F.lit(test_days))).scalar()
    return df.where(F.col(ts) <= cutoff), df.where(F.col(ts) > cutoff), cutoff


def share_cutoff(df: DataFrame, ts: str = "ts", test_share: float = 0.2) -> Column:
    """The hour after which the last ``test_share`` of the span lies."""
    seconds = F.max(clock.epoch_s(F.col(ts))) - F.min(clock.epoch_s(F.col(ts)))
    hours = F.floor(seconds * test_share / 3600).cast("int")
    return df.agg(F.max(ts) - F.make_dt_interval(hours=hours)).scalar()


def split_share(df: DataFrame, ts: str = "ts", test_days: int = 73) -> DataFrame:
    """How many rows each side of the split really gets."""
    train, test, _ = time_split(df, ts, test_days)
    parts = train.select(F.lit("train").alias("part")).unionByName(
        test.select(F.lit("test").alias("part"))
    )
    return parts.groupBy("part").agg(F.count("*").alias("rows"))
