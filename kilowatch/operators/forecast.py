"""Gradient-boosted demand forecasts for all zones at once, and their accuracy."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.functions import clock
from kilowatch.operators.features import (
    FEATURES, attach_seasonal, calendar_features, engineer_features, lag_columns, rolling_columns,
)
from kilowatch.operators.grid import future_slots
from kilowatch.session import cut_lineage

# Parameters of the boosted trees.
TREES, DEPTH, STEP, SUBSAMPLE, SUBSET, SEED = 100, 6, 0.1, 0.8, "sqrt", 42
MODEL_NAME = "GBT_v1"
# Training rows of a partition: so many pay for a task of their own, and no more than so many lie in one.
LEAST_ROWS, MOST_ROWS = 100_000, 500_000
TEST_DAYS = 73

# Direct strategy: what is known at the anchor, what is known of the target hour, and the horizon.
DIRECT_FEATURES = [
    "anchor_mw", "anchor_lag_1h", "rolling_7d_mean", "rolling_7d_stddev", "rolling_24h_mean",
    "same_hour_day", "same_hour_week", "seasonal_index",
    "hour_sin", "hour_cos", "month_sin", "month_cos", "is_weekend",
    "dow_1", "dow_2", "dow_3", "dow_4", "dow_5", "dow_6", "dow_7", "h",
]


def build_pipeline(
    columns: list[str], *, trees: int = TREES, depth: int = DEPTH, step: float = STEP,
    subsample: float = SUBSAMPLE, subset: str = SUBSET, seed: int = SEED, label: str = "mw_demand",
) -> Pipeline:
    """Assemble, standardise, boost."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="skip"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            GBTRegressor(
                featuresCol="features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step,
                subsamplingRate=subsample, featureSubsetStrategy=subset, seed=seed,
            ),
        ]
    )


def partitions(rows: int, cores: int) -> int:
    """How many partitions the trees read. Every level of every tree is a job, so few rows lie in one; many
    are dealt over all cores, however small their file is (its columns repeat and compress well)."""
    if rows <= cores * MOST_ROWS:
        return max(1, min(cores, -(-rows // LEAST_ROWS)))
    return -(-rows // (cores * MOST_ROWS)) * cores


def regression_metrics(
    predictions: DataFrame, label: str = "mw_demand", prediction: str = "prediction"
) -> DataFrame:
    """rmse, mae and r2 of all rows in one aggregation."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    total = F.var_pop(y) * F.count(y)
    return predictions.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1.0 - F.try_divide(F.sum(e * e), total)).alias("r2"),
    )


def train(
    features: DataFrame, columns: list[str] = FEATURES, *, ts: str = "ts",
    test_days: int = TEST_DAYS, cutoff: Column | None = None, label: str = "mw_demand", **params,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the rows up to the cutoff, score the rest: (model, one metrics row)."""
    if cutoff is None:
        cutoff = features.agg(F.max(ts) - F.make_dt_interval(days=F.lit(test_days))).scalar()
    train_rows = features.where(F.col(ts) <= cutoff)
    test_rows = features.where(F.col(ts) > cutoff)
    parts = partitions(train_rows.count(), features.sparkSession.sparkContext.defaultParallelism)
    # By the values of the rows: the draws of a tree do not depend on the files then.
    dealt = train_rows.repartition(parts, *columns) if parts > 1 else train_rows
    model = build_pipeline(columns, label=label, **params).fit(dealt)
    measured = regression_metrics(model.transform(test_rows), label)
    metrics = measured.select(
        F.lit(MODEL_NAME).alias("model"),
        train_rows.agg(F.count(F.lit(1))).scalar().alias("train_rows"),
        "test_rows",
        *[F.round(m, 4).alias(m) for m in ("rmse", "mae", "r2")],
        F.lit(str(len(columns))).alias("features"),
        F.lit(str(params.get("trees", TREES))).alias("max_iter"),
    )
    return model, metrics


def feature_importance(model: PipelineModel, limit: int | None = 10) -> DataFrame:
    """Columns by importance, largest first."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    from pyspark.sql import SparkSession

    rows = [(n, float(w)) for n, w in zip(names, weights)]
    out = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    out = out.orderBy(F.desc("importance"), "feature")
    return out if limit is None else out.limit(limit)


# --- direct strategy: one row per (zone, anchor, h) ------------------------------------------


def _anchor_rows(demand: DataFrame) -> DataFrame:
    """What is known at each hour, the hour itself included."""
    rolled = rolling_columns(0)
    lag = lag_columns()["lag_1h"]
    return demand.select("zone", "ts", "mw_demand").withColumns({**rolled, "anchor_lag_1h": lag}).select(
        "zone", F.col("ts").alias("anchor_ts"), F.col("mw_demand").alias("anchor_mw"),
        "anchor_lag_1h", *rolled,
    )


def _known_before(slots: DataFrame, demand: DataFrame, period: int, name: str) -> DataFrame:
    """Demand at the last instant known at the anchor that is whole periods before the target."""
    back = F.ceil(F.col("h") / F.lit(period)).cast("int") * period
    keyed = slots.withColumn("_at", F.col("ts") - F.make_dt_interval(hours=back))
    seen = demand.select("zone", F.col("ts").alias("_at"), F.col("mw_demand").alias(name))
    return keyed.join(seen, ["zone", "_at"], "left").drop("_at")


def _direct_columns(slots: DataFrame, demand: DataFrame, fitted_on: DataFrame) -> DataFrame:
    out = _known_before(slots, demand, 24, "same_hour_day")
    out = _known_before(out, demand, 168, "same_hour_week")
    out = calendar_features(attach_seasonal(out, fitted_on))
    return out.withColumn("h", F.col("h").cast("double")).dropna(subset=DIRECT_FEATURES)


def direct_training_rows(
    demand: DataFrame, hours: int = 24, cutoff: Column | None = None, parts: int = 1
) -> DataFrame:
    """One labelled row per (zone, anchor, h): features at the anchor, label h hours later.

    An anchor makes ``hours`` rows, so a long history is dealt over ``parts`` partitions before.
    """
    fitted_on = demand if cutoff is None else demand.where(F.col("ts") <= cutoff)
    anchors = _anchor_rows(demand)
    slots = (
        (anchors.repartition(parts, "zone", "anchor_ts") if parts > 1 else anchors)
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(hours))))
        .withColumn("ts", F.col("anchor_ts") + F.make_dt_interval(hours=F.col("h")))
    )
    labelled = slots.join(demand.select("zone", "ts", "mw_demand"), ["zone", "ts"])
    return _direct_columns(labelled, demand, fitted_on)


def direct_future_rows(
    demand: DataFrame, hours: int = 24, cutoff: Column | None = None
) -> DataFrame:
    """The same features for the next hours of every zone."""
    fitted_on = demand if cutoff is None else demand.where(F.col("ts") <= cutoff)
    slots = future_slots(demand, hours).join(_anchor_rows(demand), ["zone", "anchor_ts"])
    return _direct_columns(slots, demand, fitted_on)


# --- recursive strategy: one pass per hour over all zones ------------------------------------


def _recursive(demand: DataFrame, model: PipelineModel, hours: int, cutoff: Column | None) -> DataFrame:
    """Each pass predicts the next slot of every zone and appends it to the history."""
    fitted_on = cut_lineage(demand if cutoff is None else demand.where(F.col("ts") <= cutoff))
    # One more than the longest lag is all a slot needs.
    anchors = demand.groupBy("zone").agg(F.max("ts").alias("_last"))
    oldest = F.col("_last") - F.make_dt_interval(hours=F.lit(169))
    known = demand.join(anchors, "zone").where(F.col("ts") >= oldest).select("zone", "ts", "mw_demand")
    predicted = None
    for _ in range(hours):
        slots = future_slots(known, 1).select("zone", "ts", F.lit(None).cast("double").alias("mw_demand"))
        rows = known.unionByName(slots).withColumns({**lag_columns(), **rolling_columns(-1)})
        rows = attach_seasonal(rows.where(F.col("mw_demand").isNull()), fitted_on)
        rows = rows.withColumn("seasonal_deviation", F.col("lag_24h") - F.col("seasonal_index"))
        step = model.transform(calendar_features(rows)).select(
            "zone", "ts", F.col("prediction").alias("mw_demand")
        )
        step = cut_lineage(step)
        known = cut_lineage(known.unionByName(step))
        predicted = step if predicted is None else predicted.unionByName(step)
    return predicted.withColumnRenamed("mw_demand", "prediction")


def forecast(
    demand: DataFrame, model: PipelineModel, hours: int = 24, *, strategy: str = "direct",
    cutoff: Column | None = None,
) -> DataFrame:
    """``(zone, ts, prediction)`` for the next ``hours`` hours of every zone.

    ``direct`` wants a model of :func:`direct_training_rows`, ``recursive`` one of
    :func:`engineer_features`.
    """
    if strategy == "recursive":
        return _recursive(demand, model, hours, cutoff)
    if strategy != "direct":
        raise ValueError(f"unknown strategy {strategy!r}")
    return model.transform(direct_future_rows(demand, hours, cutoff)).select("zone", "ts", "prediction")


def seasonal_naive(demand: DataFrame, hours: int = 24) -> DataFrame:
    """Demand of the day before as prediction: for every known hour and the next ``hours``."""
    back = F.make_dt_interval(hours=F.lit(24))
    future = future_slots(demand, hours).select("zone", "ts", F.lit(None).cast("double").alias("mw_demand"))
    slots = demand.select("zone", "ts").unionByName(future.select("zone", "ts"))
    seen = demand.select("zone", (F.col("ts") + back).alias("ts"), F.col("mw_demand").alias("prediction"))
    return slots.join(seen, ["zone", "ts"])


def forecast_rows(predictions: DataFrame, run_ts: str | Column) -> DataFrame:
    """Predictions in the shape of the forecast table. Actuals are joined when they are known."""
    stamp = F.lit(run_ts) if isinstance(run_ts, str) else run_ts
    return predictions.select(
        "ts", "zone", F.col("prediction").alias("predicted_mw"),
        F.lit(None).cast("double").alias("actual_mw"), stamp.alias("forecast_run_ts"),
        clock.year_text(F.col("ts")).alias("year"), clock.month_text(F.col("ts")).alias("month"),
    )


def confidence_band(
    predictions: DataFrame, tested: DataFrame, low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """Predictions with the band of the test residuals of the same hour of day.

    ``predictions`` and ``tested`` have ``zone, ts, prediction``; ``tested`` also ``mw_demand``.
    """
    residual = F.col("mw_demand") - F.col("prediction")
    by_hour = tested.groupBy(F.hour("ts").alias("_hour")).agg(
        F.percentile_approx(residual, [low, high], 10_000).alias("_q")
    )
    joined = predictions.withColumn("_hour", F.hour("ts")).join(by_hour, "_hour", "left")
    return joined.withColumns(
        {
            "lower": F.col("prediction") + F.col("_q")[0],
            "upper": F.col("prediction") + F.col("_q")[1],
        }
    ).drop("_hour", "_q")


__all__ = [
    "DIRECT_FEATURES", "FEATURES", "build_pipeline", "confidence_band", "direct_future_rows",
    "direct_training_rows", "engineer_features", "feature_importance", "forecast", "forecast_rows",
    "regression_metrics", "seasonal_naive", "train",
]
