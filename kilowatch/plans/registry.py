"""Every query by name: a function of (spark, folder of the test tables) that returns a DataFrame.

Values that the reports leave unrounded are rounded here, so that sums taken in another order
compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatch import schemas
from kilowatch.functions import clock
from kilowatch.functions.numbers import half_up
from kilowatch.operators import alerts as alert_ops
from kilowatch.operators import cleaning, enrich, features, forecast, inject, rollup
from kilowatch.operators.grid import future_slots, lags_by_time
from kilowatch.operators.scoring import score_batch, score_z
from kilowatch.plans import lookups, panels, reports, views
from kilowatch.session import stored, tune
from kilowatch.sources import crosswalk as x
from kilowatch.sources import warehouse
from kilowatch.streaming import decode, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Days after the cutoff of the feature queries; the models leave out a fifth of the span.
MODEL_TEST_DAYS = 6


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: half_up(c, digits) for c in columns})


def now(spark: SparkSession, sf_dir: str) -> Column:
    """The newest event time, from the events alone."""
    return clock.latest(x.table(spark, sf_dir, "events"))


# --- cleaning, joins, rollups ---------------------------------------------------------------


@query
def clean_readings(spark, d):
    return rounded(cleaning.clean_readings(x.raw_readings(spark, d))[0], 6, "kwh")


@query
def rejected_readings(spark, d):
    rejected = cleaning.clean_readings(x.raw_readings(spark, d))[1]
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("rows"))


@query
def readings_with_meta(spark, d):
    joined = enrich.attach_meta(x.readings(spark, d), x.households(spark, d))
    return rounded(joined.select(
        "meter_id", "reading_id", "ts", "kwh", "reading_date", "hour", "tariff_type", "acorn_group"
    ), 6, "kwh")


@query
def hourly_rollup(spark, d):
    enriched = enrich.attach_meta(x.readings(spark, d), x.households(spark, d))
    return rounded(rollup.rollup_hourly(enriched), 6, "kwh_hourly", "kwh_avg", "kwh_max")


@query
def hourly_rollup_complete(spark, d):
    out = rollup.rollup_then_enrich(x.readings(spark, d), x.households(spark, d), min_slots=2)
    return rounded(out, 6, "kwh_hourly", "kwh_avg", "kwh_max")


@query
def meter_stats(spark, d):
    out = rollup.meter_stats(x.readings(spark, d))
    return rounded(out, 6, "global_mean", "global_min", "global_max", "global_stddev")


@query
def daily_weather(spark, d):
    return rounded(rollup.daily_weather(x.weather(spark, d)), 6, "temp_high_c", "temp_low_c", "humidity")


@query
def readings_with_weather(spark, d):
    hourly = rollup.rollup_then_enrich(x.readings(spark, d), x.households(spark, d))
    joined = enrich.attach_weather(hourly, rollup.daily_weather(x.weather(spark, d)))
    return rounded(joined.select(*schemas.names(schemas.CLEAN_READING)), 6,
                   "kwh_hourly", "kwh_max", "temp_high_c", "temp_low_c", "humidity")


@query
def calendar_columns(spark, d):
    out = x.hourly_readings(spark, d).select(
        "meter_id", "reading_date", "hour", F.col("ts").cast("timestamp_ntz").alias("ts"), "year", "month", "temp_range_c",
        F.dayofweek("ts").alias("day_of_week"), clock.is_weekend(F.col("ts")).alias("is_weekend"),
    )
    return rounded(out, 6, "temp_range_c")


@query
def dedup_readings(spark, d):
    """One reading per meter and hour: the largest."""
    slots = x.readings(spark, d).select(
        "meter_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        F.round("kwh", 6).alias("kwh_hourly"), "reading_id",
    )
    return cleaning.dedup_readings(slots)


# --- consumption reports --------------------------------------------------------------------


@query
def peak_hours(spark, d):
    return reports.peak_hours(x.hourly_readings(spark, d))


@query
def monthly_trend(spark, d):
    return reports.monthly_trend(x.hourly_readings(spark, d))


@query
def top_consumers(spark, d):
    return reports.top_consumers(x.hourly_readings(spark, d), x.stats(spark, d))


@query
def weekend_weekday(spark, d):
    return reports.weekend_weekday(x.hourly_readings(spark, d))


@query
def weather_correlation(spark, d):
    return reports.weather_correlation(x.hourly_readings(spark, d))


@query
def tariff_by_hour(spark, d):
    return reports.tariff_by_hour(x.hourly_readings(spark, d))


@query
def daily_consumption(spark, d):
    return rounded(views.daily_consumption(x.hourly_readings(spark, d)), 6,
                   "total_kwh", "avg_kwh_per_meter_hour", "peak_kwh", "avg_temp_high")


@query
def consumption_heatmap(spark, d):
    return panels.consumption_heatmap(x.hourly_readings(spark, d))


@query
def load_curve(spark, d):
    return rounded(panels.load_curve(x.hourly_readings(spark, d)), 6, "total_kwh", "avg_kwh")


@query
def table_row_counts(spark, d):
    """Rows of the stored tables, as counted while they were written."""
    names = ["meter_readings", "household_stats", "pjm_demand", "streamed_readings", "demand_forecasts"]
    return warehouse.row_counts(spark, d, names)


# --- scoring --------------------------------------------------------------------------------

SCORES = [
    "meter_id", "reading_id", "n", "rolling_mean", "rolling_stddev", "z_score", "anomaly_type",
    "severity", "is_anomaly", "consecutive_high",
]


def _scores(df: DataFrame) -> DataFrame:
    return rounded(df.select(*SCORES), 6, "rolling_mean", "rolling_stddev", "z_score", "severity")


@query
def score_readings(spark, d):
    return _scores(score_batch(x.to_score(spark, d)))


@query
def score_readings_sustained(spark, d):
    """The same with the counter limit 1, where sustained elevations occur."""
    return _scores(score_batch(x.to_score(spark, d), sustained=1))


@query
def score_7d_window(spark, d):
    out = score_z(x.to_score(spark, d), window_days=7)
    return rounded(
        out.select("meter_id", "reading_id", "n", "rolling_mean", "rolling_stddev", "z_score"),
        6, "rolling_mean", "rolling_stddev", "z_score",
    )


@query
def anomaly_breakdown(spark, d):
    return reports.anomaly_breakdown(x.scored(spark, d))


@query
def anomaly_rate_trend(spark, d):
    return reports.anomaly_rate_trend(x.scored(spark, d, meta=False), now(spark, d))


@query
def hourly_anomaly_counts(spark, d):
    return rounded(views.hourly_anomaly_counts(x.scored(spark, d, meta=False), now(spark, d)), 6,
                   "avg_severity", "avg_kwh")


@query
def top_anomaly_meters(spark, d):
    return rounded(views.top_anomaly_meters(x.scored(spark, d)), 6, "avg_severity", "max_z_score")


@query
def live_alert_feed(spark, d):
    return rounded(panels.live_alert_feed(x.scored(spark, d), now(spark, d)), 6,
                   "severity", "kwh_hourly", "z_score")


@query
def anomaly_type_share(spark, d):
    return panels.anomaly_type_share(x.scored(spark, d, meta=False))


@query
def anomalies_by_day(spark, d):
    return panels.anomalies_by_day(x.scored(spark, d, meta=False), now(spark, d))


@query
def flagged_meters_top20(spark, d):
    return panels.flagged_meters(x.scored(spark, d))


@query
def anomalies_last_hour(spark, d):
    """The hour up to the newest anomaly."""
    scored = x.scored(spark, d, meta=False)
    return panels.anomalies_last_hours(scored, clock.latest(scored.where("is_anomaly")))


@query
def meter_drilldown(spark, d):
    """The meter of the newest event."""
    meter = x.newest_meter(spark, d)
    scored = x.scored(spark, d, meta=False, meter=meter)
    return rounded(panels.meter_drilldown(scored, meter), 6, "kwh_hourly", "z_score")


@query
def meter_kpis(spark, d):
    return rounded(panels.meter_kpis(x.scored(spark, d, meta=False), now(spark, d)), 6, "max_z_score", "avg_kwh")


@query
def household_status(spark, d):
    return rounded(panels.household_status(x.scored(spark, d)), 6, "max_z_score")


@query
def operations_kpis(spark, d):
    demand = x.demand(spark, d)
    out = panels.operations_kpis(
        x.hourly_readings(spark, d), x.scored(spark, d, meta=False), x.forecasts(spark, d), demand, now(spark, d)
    )
    return rounded(out, 4, "total_kwh", "mape_24h")


# --- alert table ----------------------------------------------------------------------------


def _alerts(spark, d, meta=True):
    return x.alerts(spark, d, meta=meta)


def _with_resolutions(spark, d, meta=True):
    """Operators have closed every alert older than a week."""
    table = _alerts(spark, d, meta)
    week_ago = now(spark, d) - F.make_dt_interval(days=F.lit(7))
    requests = table.where(F.col("ts") < week_ago).select(
        "meter_id", "ts", (F.col("ts") + F.make_dt_interval(days=F.lit(1))).alias("resolved_at")
    )
    return alert_ops.with_status(table, alert_ops.resolutions(table, requests))


@query
def recent_alerts_for_meter(spark, d):
    """The newest 20 alerts of the meter that has most."""
    table = x.alerts(spark, d, meta=False)
    most = lookups.top_meters(table, 1).agg(F.first("meter_id")).scalar()
    return lookups.recent_alerts(table, most, 20).select(
        "meter_id", "ts", "z_score", "anomaly_type", "severity", "status"
    )


@query
def open_alerts(spark, d):
    """The newest 200."""
    return lookups.open_alerts(_with_resolutions(spark, d), 200).select(
        "meter_id", "ts", "z_score", "anomaly_type", "severity", "acorn_group", "tariff_type", "status"
    )


@query
def alert_type_counts(spark, d):
    return lookups.alert_type_counts(_alerts(spark, d, meta=False))


@query
def top_meters_by_alerts(spark, d, meta=False):
    return lookups.top_meters(_alerts(spark, d, meta=False))


@query
def alert_summary(spark, d):
    return lookups.alert_summary(_with_resolutions(spark, d, meta=False))


@query
def alerts_by_zone(spark, d):
    scored = x.scored(spark, d)
    week_ago = now(spark, d) - F.make_dt_interval(days=F.lit(7))
    status = F.when(F.col("ts") < week_ago, alert_ops.RESOLVED).otherwise(alert_ops.OPEN)
    return panels.alerts_by_zone(scored.where("is_anomaly").withColumn("status", status))


@query
def meter_state_latest(spark, d):
    return rounded(x.states(spark, d), 5, "rolling_mean", "rolling_stddev")


@query
def latest_readings_30d(spark, d):
    rows = x.readings(spark, d).select("meter_id", "reading_id", "ts", F.round("kwh", 6).alias("kwh"))
    return lookups.latest_readings(rows, now(spark, d))


@query
def alert_versions_kept(spark, d):
    """Newest three versions per meter and day inside the horizon."""
    rows = x.readings(spark, d).select("meter_id", "reading_date", "ts", "reading_id")
    return alert_ops.compact(
        rows, ["meter_id", "reading_date"], "ts", "ts", alert_ops.ALERT_DAYS,
        alert_ops.ALERT_VERSIONS, now(spark, d),
    )


@query
def zscore_history(spark, d):
    out = alert_ops.zscore_history(score_z(x.to_score(spark, d)))
    # The array as text, for comparison.
    text = F.transform("last_n_zscore", lambda z: F.format_string("%.3f", z + F.lit(0.0)))
    return out.select("meter_id", F.concat_ws(",", text).alias("last_n_zscore"))


@query
def alert_keys(spark, d):
    alerts = _alerts(spark, d, meta=False)
    return alerts.select("meter_id", "ts", alert_ops.newest_first_key(F.col("meter_id"), F.col("ts")).alias("row_key"))


# --- injection ------------------------------------------------------------------------------


@query
def inject_anomalies(spark, d):
    out = inject.inject_anomalies(x.to_score(spark, d))
    return rounded(out.select("meter_id", "reading_id", "kwh_hourly", "injected_anomaly"), 4, "kwh_hourly")


@query
def injection_validation(spark, d):
    scored = score_batch(inject.inject_anomalies(x.to_score(spark, d)))
    return reports.injection_validation(scored)


@query
def detection_quality(spark, d):
    return inject.detection_quality(score_batch(inject.inject_anomalies(x.to_score(spark, d))))


# --- demand ---------------------------------------------------------------------------------


@query
def demand_grid(spark, d):
    return clock.with_calendar(x.demand(spark, d))


@query
def demand_lags(spark, d):
    demand = x.demand(spark, d)
    return lags_by_time(demand, demand, features.LAGS)


@query
def demand_row_lags(spark, d):
    return x.demand(spark, d).withColumns(features.lag_columns())


@query
def demand_rolling(spark, d):
    out = x.demand(spark, d).withColumns(features.rolling_columns(0))
    return rounded(out, 6, "rolling_7d_mean", "rolling_7d_stddev", "rolling_24h_mean")


@query
def demand_range_rolling(spark, d):
    return rounded(features.range_rolling(x.demand(spark, d)), 6,
                   "rolling_7d_mean", "rolling_7d_stddev", "rolling_24h_mean")


@query
def recent_history(spark, d):
    return features.recent_history(x.demand(spark, d))


@query
def seasonal_index(spark, d):
    demand = x.demand(spark, d)
    out = features.attach_seasonal(demand, demand).withColumn(
        "seasonal_deviation", F.col("mw_demand") - F.col("seasonal_index")
    )
    return rounded(out, 6, "seasonal_index", "seasonal_deviation")


@query
def cyclic_onehot(spark, d):
    out = features.calendar_features(x.demand(spark, d))
    return rounded(out, 6, "hour_sin", "hour_cos", "month_sin", "month_cos")


@query
def feature_frame(spark, d):
    out, names = features.engineer_features(x.demand(spark, d), leak_free=False)
    return rounded(out, 5, *names)


@query
def feature_frame_leak_free(spark, d):
    demand = x.demand(spark, d)
    _, _, cutoff = features.time_split(demand, test_days=MODEL_TEST_DAYS)
    out, names = features.engineer_features(demand, cutoff=cutoff)
    return rounded(out, 5, *names)


@query
def forecast_window(spark, d):
    """Feature rows of the next 24 hours, from observed values only."""
    out = features.forecast_window(features.recent_history(x.demand(spark, d)))
    return rounded(out, 5, *features.FEATURES)


@query
def time_split(spark, d):
    return features.split_share(x.demand(spark, d), test_days=MODEL_TEST_DAYS)


@query
def future_grid(spark, d):
    return future_slots(x.demand(spark, d), 24)


# --- forecast reports -----------------------------------------------------------------------


@query
def seasonal_naive_forecast(spark, d):
    return rounded(x.forecasts(spark, d), 4, "predicted_mw")


@query
def forecast_accuracy(spark, d):
    demand = x.demand(spark, d)
    return reports.forecast_accuracy(x.forecasts(spark, d), demand)


@query
def forecast_vs_actual(spark, d):
    out = views.forecast_vs_actual(x.forecasts(spark, d), x.demand(spark, d))
    return rounded(out, 4, "predicted_mw", "actual_mw", "abs_error_mw", "pct_error")


@query
def forecast_last_48h(spark, d):
    out = panels.forecast_last_hours(x.forecasts(spark, d), x.demand(spark, d))
    return rounded(out, 4, "predicted_mw", "actual_mw")


@query
def load_kpis_24h(spark, d):
    demand = x.demand(spark, d)
    out = panels.load_kpis(x.forecasts(spark, d), clock.latest(demand))
    return rounded(out, 4, "peak_predicted_24h", "avg_predicted_24h")


@query
def accuracy_kpis(spark, d):
    out = panels.accuracy_kpis(x.forecasts(spark, d), x.demand(spark, d))
    return rounded(out, 4, "mae", "rmse", "mape")


@query
def next_forecast_hours(spark, d):
    demand = x.demand(spark, d)
    return rounded(panels.next_forecast_hours(x.forecasts(spark, d), clock.latest(demand)), 4, "predicted_mw")


# --- fitted models --------------------------------------------------------------------------

_FITTED: dict[tuple[str, ...], tuple[PipelineModel, DataFrame]] = {}


def _cutoff(demand: DataFrame) -> Column:
    return features.share_cutoff(demand)


def _fitted(spark: SparkSession, d: str) -> tuple[PipelineModel, DataFrame]:
    """Direct model and its metrics row; fitted once per session and state of the demand table."""
    demand = x.demand(spark, d)
    state = demand.agg(F.count("*"), F.sum(F.xxhash64("zone", "ts", "mw_demand").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, *map(str, state))
    if key not in _FITTED:
        # Written once: the scaler and every tree read the rows again.
        parts = forecast.partitions(state[0] * 24, spark.sparkContext.defaultParallelism)
        rows = stored(forecast.direct_training_rows(demand, cutoff=_cutoff(demand), parts=parts), "training-rows")
        _FITTED[key] = forecast.train(rows, forecast.DIRECT_FEATURES, cutoff=_cutoff(demand))
    return _FITTED[key]


@query
def forecast_gbt(spark, d):
    """Next 24 hours of every zone by the boosted model."""
    demand = x.demand(spark, d)
    model, _ = _fitted(spark, d)
    out = forecast.forecast(demand, model, 24, cutoff=_cutoff(demand))
    return forecast.forecast_rows(out, "2024-01-31T00:00:00")


@query
def forecast_gbt_targets(spark, d):
    """What the boosted forecast determines without the trees: its zones and hours, and the last known hour."""
    demand = x.demand(spark, d)
    out = forecast.forecast(demand, _fitted(spark, d)[0], 24, cutoff=_cutoff(demand))
    return forecast.forecast_rows(out.where("prediction IS NOT NULL"), "2024-01-31T00:00:00").drop("predicted_mw")


@query
def forecast_metrics(spark, d):
    return _fitted(spark, d)[1]


@query
def feature_importance(spark, d):
    return forecast.feature_importance(_fitted(spark, d)[0])


@query
def forecast_band(spark, d):
    demand = x.demand(spark, d)
    model, _ = _fitted(spark, d)
    cutoff = _cutoff(demand)
    rows = forecast.direct_training_rows(demand, cutoff=cutoff)
    tested = model.transform(rows.where(F.col("ts") > cutoff)).select(
        "zone", "ts", "mw_demand", "prediction"
    )
    return forecast.confidence_band(forecast.forecast(demand, model, 24, cutoff=cutoff), tested)


@query
def naive_band(spark, d):
    """Band of the seasonal-naive forecast around the next 24 hours."""
    demand = x.demand(spark, d)
    naive = forecast.seasonal_naive(demand)
    tested = naive.join(demand, ["zone", "ts"])
    ahead = naive.where(F.col("ts") > clock.latest(demand))
    return rounded(forecast.confidence_band(ahead, tested), 4, "prediction", "lower", "upper")


@query
def naive_metrics(spark, d):
    """rmse, mae and r2 of the seasonal-naive forecast."""
    demand = x.demand(spark, d)
    tested = forecast.seasonal_naive(demand).join(demand, ["zone", "ts"])
    return rounded(forecast.regression_metrics(tested), 4, "rmse", "mae", "r2")


# --- streaming ------------------------------------------------------------------------------


@query
def event_decode(spark, d):
    """Events as JSON messages, decoded and filtered."""
    rows = x.readings(spark, d).select(
        "meter_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.col("kwh").alias("kwh_hourly"), "reading_date", "hour",
    )
    messages = rows.select(
        F.col("meter_id").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
    valid, _ = decode.decode_events(messages)
    out = valid.select(
        "meter_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "kwh_hourly", "reading_date", "hour"
    )
    return rounded(out, 6, "kwh_hourly")


@query
def alert_payload_json(spark, d):
    """Published alert messages, read back from their JSON."""
    messages = jobs.alert_messages(x.scored(spark, d).where("is_anomaly"))
    fields = (
        "meter_id string, ts string, kwh_hourly double, z_score double, anomaly_type string, "
        "severity double, rolling_mean double, rolling_stddev double, acorn_group string, "
        "reading_date string"
    )
    out = messages.select("key", F.from_json("value", fields).alias("_m")).select("key", "_m.*")
    return rounded(out, 6, "kwh_hourly", "z_score", "severity", "rolling_mean", "rolling_stddev")


@query
def score_stream(spark, d):
    """The whole event table replayed as a stream through the stateful scorer."""
    out = jobs.score_table_as_stream(spark, f"{d.rstrip('/')}/events.parquet", x.stream_columns)
    return rounded(
        out.select(*SCORES), 6, "rolling_mean", "rolling_stddev", "z_score", "severity"
    )
