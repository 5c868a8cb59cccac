"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(col: Column | str, digits: int) -> Column:
    """ROUND of the value as a decimal, exact halves away from zero.

    The mean of decimal readings is often an exact half of the last digit. As a decimal with six digits
    more it is that half whatever the order of summation; the rounding itself is the plain one.
    """
    value = F.col(col) if isinstance(col, str) else col
    return F.round(value.cast(f"decimal(38,{digits + 6})"), digits).cast("double")
