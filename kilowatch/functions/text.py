"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Null markers and the shape of a number in the raw files.
NULL_MARKERS = ["Null", "NULL", "null", ""]
NUMBER_PATTERN = r"^-?[0-9]+\.?[0-9]*$"
# Fixed value: letters, digits and dashes, at least one letter or digit.
METER_ID_PATTERN = r"^-*[A-Za-z0-9][A-Za-z0-9-]*$"


def between_positions(col: Column, start: int, end: int) -> Column:
    """Characters ``start`` (0-based) up to but not including ``end``."""
    return F.substring(col, start + 1, end - start)


def two_digits(col: Column) -> Column:
    return F.lpad(F.trim(col.cast("string")), 2, "0")


def is_plain_number(col: Column) -> Column:
    return F.trim(col).rlike(NUMBER_PATTERN)


def is_meter_id(col: Column) -> Column:
    return col.rlike(METER_ID_PATTERN)


def zone_of_header(col: Column) -> Column:
    """``AEP_MW`` -> ``AEP``."""
    return F.regexp_replace(col, "_MW$", "")


def uniform_draw(*parts: Column, seed: int, salt: str = "") -> Column:
    """Uniform number in [0, 1) that depends only on the named values, never on partitioning."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(f"{seed}{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
