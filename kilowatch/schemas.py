"""Declared schemas of inputs, tables and streams, as DDL text: readers, ``from_json`` and tables
take it as it is, and importing this module needs no session."""

RAW_READING = "meter_id string, ts_raw string, kwh_raw string"
HOUSEHOLD_META = (
    "meter_id string, tariff_type string, acorn string, acorn_group string, file string"
)
CLEAN_READING = (
    "meter_id string, reading_date string, hour string, tariff_type string, acorn_group string, "
    "kwh_hourly double, kwh_max double, temp_high_c double, temp_low_c double, humidity double"
)
# The same columns as text: malformed cells must reach the parser instead of being nulled on read.
CLEAN_READING_TEXT = CLEAN_READING.replace(" double", " string")
METER_STATS = (
    "meter_id string, total_readings bigint, global_mean double, global_min double, "
    "global_max double, global_stddev double"
)
METER_EVENT = (
    "meter_id string, ts string, kwh_hourly double, kwh_max double, reading_date string, "
    "hour string, tariff_type string, acorn_group string, temp_high_c double, temp_low_c double, "
    "humidity double, simulated boolean, injected_anomaly string, ingest_time string"
)
METER_STATE = (
    "count bigint, sum_kwh double, mean double, m2 double, consecutive_high bigint, "
    "zscores array<double>, last_ts timestamp"
)
SCORED_READING = (
    "meter_id string, ts timestamp, kwh_hourly double, rolling_mean double, rolling_stddev double, "
    "z_score double, anomaly_type string, severity double, is_anomaly boolean, tariff_type string, "
    "acorn_group string, reading_date string, injected_anomaly string, n bigint, "
    "consecutive_high bigint"
)
DEMAND = "ts timestamp, zone string, mw_demand double"
FORECAST = (
    "ts timestamp, zone string, predicted_mw double, actual_mw double, forecast_run_ts string, "
    "year string, month string"
)
ALERT = (
    "meter_id string, ts timestamp, kwh_hourly double, z_score double, anomaly_type string, "
    "severity double, acorn_group string, tariff_type string, status string, created_at timestamp"
)

# Columns of the published alert message, in message order.
ALERT_PAYLOAD = [
    "meter_id", "ts", "kwh_hourly", "z_score", "anomaly_type", "severity",
    "rolling_mean", "rolling_stddev", "acorn_group", "reading_date",
]


def names(ddl: str) -> list[str]:
    """Column names of a flat schema."""
    return [column.split()[0] for column in ddl.split(", ")]
