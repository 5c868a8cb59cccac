"""Labelled synthetic anomalies, and how well the scorer finds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.functions.numbers import half_up
from kilowatch.functions.text import uniform_draw

# Cumulative chances of the three kinds, and what each does to a reading.
SPIKE_BELOW, FLATLINE_BELOW, ELEVATION_BELOW = 0.003, 0.006, 0.008
SPIKE_FACTORS = (3.0, 10.0)
FLATLINE_KWH = 0.001
ELEVATION_FACTOR = 2.2


def inject_anomalies(
    readings: DataFrame, *, seed: int = 42, enabled: bool = True, row_id: str | Column = "reading_id",
    rate: float = 1.0,
) -> DataFrame:
    """Change a small share of readings and label them in ``injected_anomaly``.

    The draws are digests of meter, row and seed: the same rows change however the data are
    partitioned and however often a task is repeated. ``rate`` scales the chances.
    """
    if not enabled:
        return readings.withColumn("injected_anomaly", F.lit("none"))
    row = F.col(row_id) if isinstance(row_id, str) else row_id
    draw = uniform_draw(F.col("meter_id"), row, seed=seed)
    low, top = SPIKE_FACTORS
    factor = F.lit(low) + F.lit(top - low) * uniform_draw(
        F.col("meter_id"), row, seed=seed, salt="factor"
    )
    label = (
        F.when(draw < SPIKE_BELOW * rate, "sudden_spike")
        .when(draw < FLATLINE_BELOW * rate, "flatline")
        .when(draw < ELEVATION_BELOW * rate, "sustained_elevation")
        .otherwise("none")
    )
    kwh = F.col("kwh_hourly")
    out = readings.withColumn("injected_anomaly", label)
    changes = {
        "kwh_hourly": F.when(F.col("injected_anomaly") == "sudden_spike", F.round(kwh * factor, 4))
        .when(F.col("injected_anomaly") == "flatline", F.lit(FLATLINE_KWH))
        .when(F.col("injected_anomaly") == "sustained_elevation", F.round(kwh * ELEVATION_FACTOR, 4))
        .otherwise(kwh)
    }
    if "kwh_max" in readings.columns:
        changes["kwh_max"] = F.when(
            F.col("injected_anomaly") == "flatline", F.lit(FLATLINE_KWH)
        ).otherwise(F.col("kwh_max"))
    return out.withColumns(changes)


def detection_quality(scored: DataFrame) -> DataFrame:
    """Precision and recall of "any flag" and recall of "the right flag", in one pass."""
    injected = F.col("injected_anomaly") != "none"
    flagged = F.col("is_anomaly")
    counts = scored.agg(
        F.count_if(injected & flagged).alias("true_positive"),
        F.count_if(~injected & flagged).alias("false_positive"),
        F.count_if(injected & ~flagged).alias("false_negative"),
        F.count_if(injected & (F.col("injected_anomaly") == F.col("anomaly_type"))).alias("type_match"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return counts.withColumns(
        {
            "precision": half_up(F.try_divide(tp, tp + fp), 4),
            "recall": half_up(F.try_divide(tp, tp + fn), 4),
            "type_recall": half_up(F.try_divide(F.col("type_match"), tp + fn), 4),
        }
    )
