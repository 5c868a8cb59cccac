import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilowatch.operators import alerts
from kilowatch.plans import lookups, panels, reports, views

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def table(spark, rows):
    """rows: (meter, hour, type, status)"""
    data = [(m, at(h), 1.0, 3.5, t, 1.2, "A", "Std", s, at(h)) for m, h, t, s in rows]
    return spark.createDataFrame(
        data, "meter_id string, ts timestamp, kwh_hourly double, z_score double, anomaly_type string, "
        "severity double, acorn_group string, tariff_type string, status string, created_at timestamp",
    )


@pytest.fixture(scope="module")
def stored(spark):
    rows = [("MAC00001", h, "sudden_spike", "open") for h in range(3)]
    rows += [("MAC000010", h, "flatline", "open") for h in range(5)]
    return table(spark, rows)


def test_meter_lookup_never_matches_a_longer_id(stored):
    out = lookups.recent_alerts(stored, "MAC00001").collect()
    assert [r.ts for r in out] == [at(2), at(1), at(0)]
    with pytest.raises(ValueError):
        lookups.recent_alerts(stored, "a b")


def test_resolution_hides_an_alert_and_ignores_unknown_keys(spark, stored):
    requests = spark.createDataFrame(
        [("MAC00001", at(1), at(9)), ("NOBODY", at(1), at(9))],
        "meter_id string, ts timestamp, resolved_at timestamp",
    )
    status = alerts.resolutions(stored, requests)
    assert status.count() == 1
    now = alerts.with_status(stored, status)
    assert now.count() == stored.count()
    assert lookups.open_alerts(now).count() == 7
    resolved = now.where("status = 'resolved'").first()
    assert (resolved.meter_id, resolved.ts, resolved.resolved_at) == ("MAC00001", at(1), at(9))


def test_newest_status_wins(spark, stored):
    rows = [("MAC00001", at(0), "resolved", at(1), at(1)), ("MAC00001", at(0), "open", None, at(2))]
    status = spark.createDataFrame(
        rows, "meter_id string, ts timestamp, status string, resolved_at timestamp, updated_at timestamp"
    )
    assert lookups.open_alerts(alerts.with_status(stored, status)).count() == 8


def test_lookups_give_all_rows_or_as_many_as_asked(spark):
    rows = [("M", at(i), "open", "flatline", 0.0) for i in range(600)]
    table = spark.createDataFrame(rows, "meter_id string, ts timestamp, status string, anomaly_type string, z_score double")
    assert lookups.open_alerts(table).count() == 600
    assert lookups.open_alerts(table, 550).count() == 550
    assert lookups.recent_alerts(table, "M").count() == 600


def test_summary_and_top_meters(stored):
    row = lookups.alert_summary(stored).first()
    assert tuple(row) == (8, 3, 0, 5, "MAC000010")
    assert tuple(lookups.alert_summary(stored.limit(0)).first()) == (0, 0, 0, 0, "N/A")
    assert [tuple(r) for r in lookups.top_meters(stored, 1).collect()] == [("MAC000010", 5)]
    assert [tuple(r) for r in lookups.alert_type_counts(stored).collect()] == [("flatline", 5), ("sudden_spike", 3)]


@pytest.mark.parametrize("given,got", [(7, 7), ("9", 9), (9999, 500), ("x", 50), (None, 50), (-3, 0)])
def test_limits(given, got):
    assert lookups.clamp_limit(given) == got


def test_retention_and_versions(spark):
    rows = [("M1", at(h), h) for h in range(5)] + [("M2", at(-24 * 40), 0)]
    df = spark.createDataFrame(rows, "meter_id string, ts timestamp, version int")
    as_of = F.lit(at(5))
    kept = alerts.compact(df, ["meter_id"], "version", "ts", 30, 3, as_of)
    assert sorted((r.meter_id, r.version) for r in kept.collect()) == [("M1", 2), ("M1", 3), ("M1", 4)]
    assert alerts.retain(df, "ts", 90, as_of).count() == 6


def test_states_merge_over_the_snapshot(spark):
    names = "meter_id string, count bigint, rolling_mean double, rolling_stddev double, consecutive_high bigint, last_updated timestamp"
    old = spark.createDataFrame([("M1", 5, 1.0, 0.1, 0, at(0)), ("M2", 7, 2.0, 0.2, 1, at(0))], names)
    new = spark.createDataFrame([("M1", 6, 1.1, 0.1, 2, at(1)), ("M3", 1, 3.0, 0.0, 0, at(1))], names)
    merged = alerts.merge_states(old, new)
    assert {(r.meter_id, r["count"]) for r in merged.collect()} == {("M1", 6), ("M2", 7), ("M3", 1)}
    assert lookups.meter_state(merged, "M1").first().consecutive_high == 2
    assert lookups.meter_state(merged, "M9").count() == 0


def scored(spark, rows):
    data = [(m, at(h), 1.0, z, t, s, t != "normal", "A", "Std", str(at(h).date()), z0, at(h)) for m, h, z, t, s, z0 in rows]
    return spark.createDataFrame(
        data, "meter_id string, ts timestamp, kwh_hourly double, z_score double, anomaly_type string, "
        "severity double, is_anomaly boolean, acorn_group string, tariff_type string, "
        "reading_date string, zone string, processed_at timestamp",
    )


def test_panels_filter_and_grade(spark):
    df = scored(spark, [
        ("M1", 0, 5.0, "sudden_spike", 1.7, "N"), ("M2", 1, 3.2, "sudden_spike", 1.1, "S"),
        ("M3", 1, -1.0, "flatline", 1.0, "S"), ("M3", 2, 0.0, "normal", 0.0, "S"),
    ])
    assert [r.meter_id for r in panels.live_alert_feed(df, zone="S").collect()] == ["M2", "M3"]
    assert panels.live_alert_feed(df, meter="M1").count() == 1
    grades = {r.meter_id: r.status for r in panels.household_status(df).collect()}
    assert grades == {"M1": "Critical", "M2": "Warning", "M3": "Normal"}
    shares = {r.anomaly_type: r.pct for r in panels.anomaly_type_share(df).collect()}
    assert shares == {"sudden_spike": 67.0, "flatline": 33.0}
    assert panels.anomalies_last_hours(df).agg(F.sum("cnt")).first()[0] == 2
    old = F.lit(at(24 * 50))
    assert reports.anomaly_rate_trend(df, old).count() == 1
    assert reports.anomaly_rate_trend(df, F.lit(at(24 * 90))).count() == 0
    assert views.hourly_anomaly_counts(df, old).count() == 0


def test_alert_rounding(spark):
    df = scored(spark, [("M1", 0, 3.45678, "sudden_spike", 1.15226, "N")])
    row = alerts.alerts_from_scored(df).first()
    assert (row.z_score, row.severity, row.status) == (3.457, 1.15, "open")
