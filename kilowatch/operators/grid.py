"""Regular hourly grids of zone demand, and exact-time lags on them.

A demand table has at most one row per zone and hour, so a window per zone is bounded by the hours
of history, however many raw rows were summed into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOUR = "interval 1 hour"


def densify(observed: DataFrame, fill: float = 0.0) -> DataFrame:
    """``(zone, ts, mw_demand)`` on the gap-free grid from the first to the last hour of all zones."""
    zones = observed.select("zone").distinct()
    first = observed.agg(F.min("ts")).scalar()
    last = observed.agg(F.max("ts")).scalar()
    grid = zones.select(
        "zone", F.explode(F.sequence(first, last, F.expr(HOUR))).alias("ts")
    )
    joined = grid.join(observed.select("zone", "ts", "mw_demand"), ["zone", "ts"], "left")
    return joined.withColumn("mw_demand", F.coalesce("mw_demand", F.lit(fill)))


def future_slots(history: DataFrame, hours: int) -> DataFrame:
    """The next ``hours`` hourly slots of every zone after its own last observation."""
    anchors = history.groupBy("zone").agg(F.max("ts").alias("anchor_ts"))
    return anchors.select(
        "zone", "anchor_ts", F.explode(F.sequence(F.lit(1), F.lit(hours))).alias("h")
    ).withColumn("ts", F.col("anchor_ts") + F.make_dt_interval(hours=F.col("h")))


def lags_by_time(slots: DataFrame, history: DataFrame, hours: list[int]) -> DataFrame:
    """Add ``lag_<k>h``: demand exactly k hours before each slot, NULL where nothing was observed.

    Every observation is offered to the slots it can serve (its own time + k) and gathered once per
    (zone, ts), so any number of lags costs one aggregation and one equi-join.
    """
    offers = history.select(
        "zone", "ts", "mw_demand", F.explode(F.array(*[F.lit(k) for k in hours])).alias("_k")
    ).select(
        "zone", (F.col("ts") + F.make_dt_interval(hours=F.col("_k"))).alias("ts"), "_k", "mw_demand"
    )
    gathered = offers.groupBy("zone", "ts").agg(
        *[F.max(F.when(F.col("_k") == k, F.col("mw_demand"))).alias(f"lag_{k}h") for k in hours]
    )
    return slots.join(gathered, ["zone", "ts"], "left")
