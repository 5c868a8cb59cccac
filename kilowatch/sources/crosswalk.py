"""The engine's relations built from the star-schema test tables.

Meters are users, readings their events, households the customers, zones of demand the event
types. Each function reads only the columns it needs. What several reports read is a stored table
(``warehouse.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kilowatch.functions import clock
from kilowatch.operators import alerts as alert_ops
from kilowatch.operators import cleaning, enrich, rollup
from kilowatch.operators.forecast import forecast_rows, seasonal_naive
from kilowatch.operators.grid import densify
from kilowatch.operators.scoring import score_batch
from kilowatch.sources import warehouse


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the file footers once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def meter_id(user: Column) -> Column:
    """``MAC`` and at least six digits; longer numbers stay whole."""
    digits = user.cast("string")
    return F.concat(F.lit("MAC"), F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), F.lit("0")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot readings: meter_id, reading_id, ts, kwh, reading_date, hour."""
    events = table(spark, sf_dir, "events")
    return events.select(
        meter_id(F.col("user_id")).alias("meter_id"),
        F.col("event_id").alias("reading_id"),
        "ts",
        (F.col("value") / F.lit(100.0)).alias("kwh"),
        clock.date_text(F.col("ts")).alias("reading_date"),
        clock.hour_text(F.col("ts")).alias("hour"),
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as the text rows of a raw file, with its usual defects.

    Error events carry a null marker, view events surrounding blanks, sign-up events a negative
    value, purchases a value without leading digits when it is below one.
    """
    events = table(spark, sf_dir, "events")
    number = (F.col("value") / F.lit(100.0)).cast("decimal(18,4)").cast("string")
    kwh = (
        F.when(F.col("event_type") == "error", "Null")
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), number, F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("-"), number))
        .when(F.col("event_type") == "purchase", F.regexp_replace(number, r"^0\.", "."))
        .otherwise(number)
    )
    return events.select(
        meter_id(F.col("user_id")).alias("meter_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000")).alias("ts_raw"),
        kwh.alias("kwh_raw"),
    )


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Household metadata: meter_id, tariff_type, acorn_group, zone (region of the household)."""
    return warehouse.read(spark, sf_dir, "households")


@warehouse.table_of("households", inputs=("customer", "nation", "region"))
def _households(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    placed = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return customer.join(placed, customer["c_nationkey"] == placed["n_nationkey"]).select(
        meter_id(F.col("c_custkey")).alias("meter_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "Std").otherwise("ToU").alias("tariff_type"),
        F.col("c_mktsegment").alias("acorn_group"),
        F.col("r_name").alias("zone"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather rows per observation, taken from the JSON properties of the events."""
    k = F.get_json_object("props", "$.k").try_cast("double")
    return table(spark, sf_dir, "events").select(
        clock.date_text(F.col("ts")).alias("w_date"),
        k.alias("temp_high_c"), (k / 2.0).alias("temp_low_c"), (k / 100.0).alias("humidity"),
    )


@warehouse.table_of("meter_readings", inputs=("events", "customer", "nation", "region"), folders=("year", "month"), sort=("meter_id", "ts"))
def _hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = households(spark, sf_dir)
    hourly = rollup.rollup_then_enrich(readings(spark, sf_dir), meta)
    daily = rollup.daily_weather(weather(spark, sf_dir))
    return cleaning.with_reading_columns(enrich.attach_weather(hourly, daily))[0]


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meter-readings table: hourly totals with household, weather and calendar columns."""
    return warehouse.read(spark, sf_dir, "meter_readings")


@warehouse.table_of("household_stats", inputs=("events", "customer", "nation", "region"))
def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = households(spark, sf_dir).select("meter_id")
    return rollup.meter_stats(readings(spark, sf_dir)).join(meta, "meter_id", "left_semi")


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.read(spark, sf_dir, "household_stats")


def to_score(spark: SparkSession, sf_dir: str, meter: Column | None = None) -> DataFrame:
    """Columns the scorer needs, of all meters or one."""
    rows = readings(spark, sf_dir)
    rows = rows if meter is None else rows.where(F.col("meter_id") == meter)
    return rows.select("meter_id", "reading_id", "ts", F.col("kwh").alias("kwh_hourly"))


def newest_meter(spark: SparkSession, sf_dir: str) -> Column:
    """The meter of the newest event."""
    events = table(spark, sf_dir, "events")
    return meter_id(events.agg(F.max_by("user_id", F.struct("ts", "event_id"))).scalar())


@warehouse.table_of("streamed_readings", folders=("reading_date",), sort=("meter_id", "ts"))
def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_batch(to_score(spark, sf_dir)).withColumns(
        {"reading_date": clock.date_text(F.col("ts")), "processed_at": F.col("ts")}
    )


def scored(spark: SparkSession, sf_dir: str, meta: bool = True, meter: Column | None = None) -> DataFrame:
    """The scored-readings table, of all meters or one. Household columns are joined where a report shows
    them; a report on anomalies reads and joins anomalies only."""
    rows = warehouse.read(spark, sf_dir, "streamed_readings")
    rows = rows if meter is None else rows.where(F.col("meter_id") == meter)
    return enrich.attach_meta(rows, households(spark, sf_dir)) if meta else rows


@warehouse.table_of("meter_states")
def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_ops.meter_states(scored(spark, sf_dir, meta=False), digits=None)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest statistics of every meter."""
    return warehouse.read(spark, sf_dir, "meter_states")


@warehouse.table_of("alerts", folders=("reading_date",), sort=("meter_id", "ts"))
def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = alert_ops.alerts_from_scored(scored(spark, sf_dir, meta=False), created_at=F.col("ts"))
    return made.withColumn("reading_date", clock.date_text(F.col("ts")))


def alerts(spark: SparkSession, sf_dir: str, meta: bool = True) -> DataFrame:
    """The alert table: anomalies as open alerts, with household columns if wanted."""
    rows = warehouse.read(spark, sf_dir, "alerts").drop("reading_date")
    return enrich.attach_meta(rows, households(spark, sf_dir)) if meta else rows


@warehouse.table_of("observed_demand")
def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows are summed on the map side first; what is shuffled is zones x hours."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("zone"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
        .agg(F.round(F.sum("value"), 4).alias("mw_demand"))
    )


@warehouse.table_of("pjm_demand")
def _demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(warehouse.read(spark, sf_dir, "observed_demand"))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand per zone on a gap-free grid."""
    return warehouse.read(spark, sf_dir, "pjm_demand")


@warehouse.table_of("demand_forecasts")
def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_rows(seasonal_naive(demand(spark, sf_dir), 24), "2024-01-31T00:00:00")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal-naive forecast table over the known hours and the next 24."""
    return warehouse.read(spark, sf_dir, "demand_forecasts")


def stream_columns(events: DataFrame) -> DataFrame:
    """Columns the streaming scorer needs, from a batch or stream of events."""
    none = F.lit(None).cast("string")
    return events.select(
        meter_id(F.col("user_id")).alias("meter_id"),
        F.col("event_id").alias("reading_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") / F.lit(100.0)).alias("kwh_hourly"),
        none.alias("tariff_type"), none.alias("acorn_group"),
        clock.date_text(F.col("ts")).alias("reading_date"),
        F.lit("none").alias("injected_anomaly"),
    )
