"""Order ranges of keys, so that running values over one key stay parallel.

A running mean, counter or sum over ``partition by meter order by ts`` puts all rows of a meter in one
task, and a meter may hold a third of all rows. So all rows are laid out in one order, (meter, time), by a
range exchange, and every ``2**SLICE_BITS`` neighbours are a slice. A small meter lies in one slice or two, a
large one in as many as its rows ask for, however close in time they are. What a running value needs is
then folded per meter and slice, passed on over the few slices of a meter, and added to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kilowatch.session import stored

SLICE_BITS = 14
HOUR_US = 3_600_000_000


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """The rows with their place ``_at`` in the order of (meter_id, *order), nulls first, and ``_slice``.

    Stored, as a place must stay what it is however often the rows are read. Rows of equal order take
    any of their places.
    """
    keys = ["meter_id", *order, "_tie"]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    return stored(placed.withColumn("_slice", F.shiftright("_at", SLICE_BITS)), "in-order")


def before(key: str) -> W:
    """Window over the slices of a key that come before the current one."""
    return W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)


def within(key: str) -> W:
    """Running window inside one slice of a key."""
    return W.partitionBy(key, "_slice").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)


def same_slice(a: DataFrame, b: DataFrame):
    """Join condition on meter and slice; null meters are one meter."""
    return a["meter_id"].eqNullSafe(b["meter_id"]) & (a["_slice"] == b["_slice"])
