"""The same queries as ANSI SQL over the same tables, to check results against another engine.

Values are rounded as decimals, as ``half_up`` does: a mean of decimals is often an exact half.
"""

from __future__ import annotations

READINGS = """
r AS (
  SELECT printf('MAC%06d', user_id) AS meter_id, event_id AS reading_id, ts,
         value / 100.0 AS kwh, strftime(ts, '%Y-%m-%d') AS reading_date,
         strftime(ts, '%H') AS hour
  FROM events
)"""

HOUSEHOLDS = """
h AS (
  SELECT printf('MAC%06d', c_custkey) AS meter_id,
         CASE WHEN c_nationkey % 2 = 0 THEN 'Std' ELSE 'ToU' END AS tariff_type,
         c_mktsegment AS acorn_group, r_name AS zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

WEATHER = """
wd AS (
  SELECT strftime(ts, '%Y-%m-%d') AS reading_date, avg(k) AS temp_high_c,
         avg(k / 2.0) AS temp_low_c, avg(k / 100.0) AS humidity
  FROM (SELECT ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
  GROUP BY 1
)"""

HOURLY = f"""{READINGS}, {HOUSEHOLDS}, {WEATHER},
hr AS (
  SELECT meter_id, reading_date, hour, tariff_type, acorn_group,
         sum(kwh) AS kwh_hourly, avg(kwh) AS kwh_avg, max(kwh) AS kwh_max,
         count(kwh) AS reading_count
  FROM r JOIN h USING (meter_id)
  GROUP BY meter_id, reading_date, hour, tariff_type, acorn_group
),
mr AS (
  SELECT hr.*, temp_high_c, temp_low_c, humidity, temp_high_c - temp_low_c AS temp_range_c,
         strptime(reading_date || ' ' || hour, '%Y-%m-%d %H') AS ts,
         substr(reading_date, 1, 4) AS year, substr(reading_date, 6, 2) AS month
  FROM hr JOIN wd USING (reading_date)
)"""

NOW = "(SELECT max(ts) FROM events)"


def _scored(source: str = "SELECT meter_id, reading_id, ts, kwh AS kwh_hourly FROM r", k: int = 5) -> str:
    """CTEs up to ``s``: window statistics, then the counter row by row."""
    return f"""{READINGS}, {HOUSEHOLDS},
src AS ({source}),
st AS (
  SELECT *, count(*) OVER w AS n, avg(kwh_hourly) OVER w AS m, stddev_pop(kwh_hourly) OVER w AS sd
  FROM src
  WINDOW w AS (PARTITION BY meter_id ORDER BY ts, reading_id ROWS UNBOUNDED PRECEDING)
),
zs AS MATERIALIZED (
  SELECT *, CASE WHEN sd > 0.001 AND n >= 10 THEN (kwh_hourly - m) / sd ELSE 0.0 END AS z FROM st
),
step AS MATERIALIZED (
  SELECT meter_id, n,
         CASE WHEN n < 10 OR kwh_hourly < 0.005 THEN 0 WHEN z > 3.0 THEN 1 WHEN z > 2.0 THEN 2
              ELSE 3 END AS kind
  FROM zs
),
c(meter_id, n, c0, c1) AS (
  SELECT meter_id, n, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM step WHERE n = 1
  UNION ALL
  SELECT step.meter_id, step.n, c.c1,
         CASE WHEN kind = 1 THEN c.c1 + 1
              WHEN kind = 2 AND c.c1 < {k} THEN c.c1 + 1
              WHEN kind = 3 THEN greatest(0, c.c1 - 1)
              ELSE c.c1 END
  FROM c JOIN step ON step.meter_id = c.meter_id AND step.n = c.n + 1
),
lb AS (
  SELECT zs.*, c.c0, c.c1 AS consecutive_high,
         CASE WHEN zs.n < 10 THEN 'normal' WHEN kwh_hourly < 0.005 THEN 'flatline'
              WHEN z > 3.0 THEN 'sudden_spike'
              WHEN z > 2.0 AND c.c0 >= {k} THEN 'sustained_elevation'
              ELSE 'normal' END AS anomaly_type
  FROM zs JOIN c ON c.meter_id = zs.meter_id AND c.n = zs.n
),
s AS (
  SELECT lb.*, strftime(ts, '%Y-%m-%d') AS reading_date, strftime(ts, '%H') AS hour,
         anomaly_type <> 'normal' AS is_anomaly,
         CASE anomaly_type WHEN 'flatline' THEN 1.0 WHEN 'sudden_spike' THEN least(abs(z) / 3.0, 5.0)
              WHEN 'sustained_elevation' THEN 2.0 + c0 / 10.0 ELSE 0.0 END AS severity
  FROM lb
),
sh AS (SELECT s.*, tariff_type, acorn_group, zone FROM s JOIN h USING (meter_id))"""


SCORED = "WITH RECURSIVE " + _scored()

_DRAW = "CAST('0x' || substr(md5(concat_ws('|', meter_id, CAST(reading_id AS VARCHAR), '{salt}')), 1, 8) AS BIGINT) / 4294967296.0"
INJECTED = f"""
SELECT meter_id, reading_id, ts, injected_anomaly,
       CASE injected_anomaly WHEN 'sudden_spike' THEN round(kwh * (3.0 + 7.0 * f), 4)
            WHEN 'flatline' THEN 0.001
            WHEN 'sustained_elevation' THEN round(kwh * 2.2, 4) ELSE kwh END AS kwh_hourly
FROM (
  SELECT *, {_DRAW.format(salt='42factor')} AS f,
         CASE WHEN u < 0.003 THEN 'sudden_spike' WHEN u < 0.006 THEN 'flatline'
              WHEN u < 0.008 THEN 'sustained_elevation' ELSE 'none' END AS injected_anomaly
  FROM (SELECT *, {_DRAW.format(salt='42')} AS u FROM r)
)"""

DEMAND = """
ob AS (
  SELECT event_type AS zone, date_trunc('hour', ts) AS ts, round(sum(value), 4) AS mw
  FROM events GROUP BY 1, 2
),
d AS (
  SELECT g.zone, g.ts, coalesce(ob.mw, 0.0) AS mw_demand
  FROM (
    SELECT z.zone, t.ts
    FROM (SELECT DISTINCT zone FROM ob) z,
         (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM ob) t
  ) g LEFT JOIN ob ON ob.zone = g.zone AND ob.ts = g.ts
)"""

FORECASTS = f"""{DEMAND},
f AS (
  SELECT zone, ts + INTERVAL 24 HOUR AS ts, mw_demand AS predicted_mw FROM d
)"""

ACCURACY = f"""{FORECASTS},
fa AS (
  SELECT f.ts, f.zone, f.predicted_mw, d.mw_demand AS actual_mw,
         abs(f.predicted_mw - d.mw_demand) AS abs_error_mw,
         abs(f.predicted_mw - d.mw_demand) / nullif(d.mw_demand, 0) * 100 AS pct_error
  FROM f LEFT JOIN d ON d.zone = f.zone AND d.ts = f.ts
  WHERE f.ts >= CAST((SELECT max(ts) FROM d) AS DATE) - 7
)"""

_CALENDAR_LEAK_FREE = """
  sin(2 * pi() * extract(hour FROM ts) / 24) AS hour_sin,
  cos(2 * pi() * extract(hour FROM ts) / 24) AS hour_cos,
  sin(2 * pi() * extract(month FROM ts) / 12) AS month_sin,
  cos(2 * pi() * extract(month FROM ts) / 12) AS month_cos,
  CASE WHEN extract(dow FROM ts) IN (0, 6) THEN 1.0 ELSE 0.0 END AS is_weekend, """ + ", ".join(
    f"CASE WHEN extract(dow FROM ts) = {i - 1} THEN 1.0 ELSE 0.0 END AS dow_{i}" for i in range(1, 8)
)
_CALENDAR_PLAIN = _CALENDAR_LEAK_FREE.replace("pi()", "3.14159")
_DAYS = [f"dow_{i}" for i in range(1, 8)]
_NAMES = [
    "lag_1h", "lag_2h", "lag_24h", "lag_168h", "rolling_7d_mean", "rolling_7d_stddev",
    "rolling_24h_mean", "seasonal_index", "seasonal_deviation", "hour_sin", "hour_cos",
    "month_sin", "month_cos", "is_weekend", *_DAYS,
]
_ROUNDED = ", ".join(f"round(CAST(CAST({n} AS DOUBLE) AS DECIMAL(38,11)), 5)::DOUBLE AS {n}" for n in _NAMES)
_KNOWN = " AND ".join(f"{n} IS NOT NULL" for n in _NAMES)
_LAGS = ", ".join(
    f"lag(mw_demand, {k}) OVER (PARTITION BY zone ORDER BY ts) AS lag_{k}h" for k in (1, 2, 24, 168)
)


def _rolling(week: str, day: str) -> str:
    over = "OVER (PARTITION BY zone ORDER BY ts ROWS BETWEEN {})"
    return (
        f"avg(mw_demand) {over.format(week)} AS rolling_7d_mean, "
        f"stddev_samp(mw_demand) {over.format(week)} AS rolling_7d_stddev, "
        f"avg(mw_demand) {over.format(day)} AS rolling_24h_mean"
    )


_RANGE = """
  avg(mw_demand) OVER (PARTITION BY zone ORDER BY ts
    RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS rolling_7d_mean,
  stddev_pop(mw_demand) OVER (PARTITION BY zone ORDER BY ts
    RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS rolling_7d_stddev,
  avg(mw_demand) OVER (PARTITION BY zone ORDER BY ts
    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS rolling_24h_mean"""

_SCORE_COLUMNS = """meter_id, reading_id, n, round(CAST(m AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_mean, round(CAST(sd AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_stddev,
       round(CAST(z AS DECIMAL(38,12)), 6)::DOUBLE AS z_score, anomaly_type, round(CAST(severity AS DECIMAL(38,12)), 6)::DOUBLE AS severity, is_anomaly,
       consecutive_high"""

_NEWEST_METER = "(SELECT printf('MAC%06d', user_id) FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)"
_WEEK_AGO = f"({NOW} - INTERVAL 7 DAY)"

ORACLES: dict[str, str] = {
    # --- cleaning, joins, rollups
    "clean_readings": """
SELECT printf('MAC%06d', user_id) AS meter_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_str,
       CAST(CAST(value / 100.0 AS DECIMAL(18, 4)) AS DOUBLE) AS kwh,
       strftime(ts, '%Y-%m-%d') AS reading_date, strftime(ts, '%Y-%m') AS year_month,
       strftime(ts, '%Y') AS year, strftime(ts, '%H') AS hour
FROM events
WHERE event_type IN ('view', 'click') OR (event_type = 'purchase' AND value >= 100)
   OR (event_type = 'signup' AND CAST(value / 100.0 AS DECIMAL(18, 4)) = 0)""",
    "rejected_readings": """
SELECT reject_reason, count(*) AS rows FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'null_marker'
              WHEN event_type = 'purchase' AND value < 100 THEN 'not_numeric'
              WHEN event_type = 'signup' AND CAST(value / 100.0 AS DECIMAL(18, 4)) > 0
              THEN 'out_of_range' END AS reject_reason
  FROM events) WHERE reject_reason IS NOT NULL GROUP BY 1""",
    "readings_with_meta": f"""
WITH {READINGS}, {HOUSEHOLDS}
SELECT meter_id, reading_id, ts, round(CAST(kwh AS DECIMAL(38,12)), 6)::DOUBLE AS kwh, reading_date, hour, tariff_type, acorn_group
FROM r JOIN h USING (meter_id)""",
    "hourly_rollup": f"""
WITH {HOURLY}
SELECT meter_id, reading_date, hour, tariff_type, acorn_group, round(CAST(kwh_hourly AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly,
       round(CAST(kwh_avg AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_avg, round(CAST(kwh_max AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_max, reading_count FROM hr""",
    "hourly_rollup_complete": f"""
WITH {HOURLY}
SELECT meter_id, reading_date, hour, tariff_type, acorn_group, round(CAST(kwh_hourly AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly,
       round(CAST(kwh_avg AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_avg, round(CAST(kwh_max AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_max, reading_count
FROM hr WHERE reading_count >= 2""",
    "meter_stats": f"""
WITH {READINGS}
SELECT meter_id, count(kwh) AS total_readings, round(CAST(avg(kwh) AS DECIMAL(38,12)), 6)::DOUBLE AS global_mean,
       round(CAST(min(kwh) AS DECIMAL(38,12)), 6)::DOUBLE AS global_min, round(CAST(max(kwh) AS DECIMAL(38,12)), 6)::DOUBLE AS global_max,
       round(CAST(stddev_pop(kwh) AS DECIMAL(38,12)), 6)::DOUBLE AS global_stddev FROM r GROUP BY meter_id""",
    "daily_weather": f"""
WITH {WEATHER}
SELECT reading_date AS w_date, round(CAST(temp_high_c AS DECIMAL(38,12)), 6)::DOUBLE AS temp_high_c,
       round(CAST(temp_low_c AS DECIMAL(38,12)), 6)::DOUBLE AS temp_low_c, round(CAST(humidity AS DECIMAL(38,12)), 6)::DOUBLE AS humidity FROM wd""",
    "readings_with_weather": f"""
WITH {HOURLY}
SELECT meter_id, reading_date, hour, tariff_type, acorn_group, round(CAST(kwh_hourly AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly,
       round(CAST(kwh_max AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_max, round(CAST(temp_high_c AS DECIMAL(38,12)), 6)::DOUBLE AS temp_high_c,
       round(CAST(temp_low_c AS DECIMAL(38,12)), 6)::DOUBLE AS temp_low_c, round(CAST(humidity AS DECIMAL(38,12)), 6)::DOUBLE AS humidity FROM mr""",
    "calendar_columns": f"""
WITH {HOURLY}
SELECT meter_id, reading_date, hour, ts, year, month, round(CAST(temp_range_c AS DECIMAL(38,12)), 6)::DOUBLE AS temp_range_c,
       CAST(extract(dow FROM ts) + 1 AS INTEGER) AS day_of_week,
       extract(dow FROM ts) IN (0, 6) AS is_weekend FROM mr""",
    "dedup_readings": f"""
WITH {READINGS}
SELECT meter_id, ts, kwh_hourly, reading_id FROM (
  SELECT meter_id, date_trunc('hour', ts) AS ts, round(CAST(kwh AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly, reading_id,
         row_number() OVER (PARTITION BY meter_id, date_trunc('hour', ts)
                            ORDER BY round(CAST(kwh AS DECIMAL(38,12)), 6)::DOUBLE DESC, reading_id DESC) AS rn
  FROM r) WHERE rn = 1""",
    # --- consumption reports
    "peak_hours": f"""
WITH {HOURLY}
SELECT hour, round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh, round(CAST(max(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS peak_kwh,
       round(CAST(stddev_pop(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS stddev_kwh, count(DISTINCT meter_id) AS meters
FROM mr GROUP BY hour""",
    "monthly_trend": f"""
WITH {HOURLY}
SELECT year, month, round(CAST(sum(kwh_hourly) AS DECIMAL(38,8)), 2)::DOUBLE AS total_kwh,
       round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh_per_meter_hour,
       count(DISTINCT meter_id) AS active_meters, round(CAST(avg(temp_high_c) AS DECIMAL(38,8)), 2)::DOUBLE AS avg_temp_high_c
FROM mr GROUP BY year, month""",
    "top_consumers": f"""
WITH {HOURLY}
SELECT meter_id, acorn_group, tariff_type, round(CAST(sum(kwh_hourly) AS DECIMAL(38,8)), 2)::DOUBLE AS total_kwh,
       round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh_hourly, round(CAST(max(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS peak_kwh,
       count(*) AS reading_count
FROM mr WHERE meter_id IN (SELECT meter_id FROM r)
GROUP BY meter_id, acorn_group, tariff_type ORDER BY total_kwh DESC, meter_id LIMIT 20""",
    "weekend_weekday": f"""
WITH {HOURLY}
SELECT CASE WHEN extract(dow FROM CAST(reading_date AS DATE)) IN (0, 6) THEN 'Weekend'
            ELSE 'Weekday' END AS day_type, hour,
       round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh, round(CAST(stddev_pop(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS stddev_kwh
FROM mr GROUP BY 1, 2""",
    "weather_correlation": f"""
WITH {HOURLY}
SELECT year, month, round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh, round(CAST(avg(temp_high_c) AS DECIMAL(38,8)), 2)::DOUBLE AS avg_temp_high,
       round(CAST(avg(temp_low_c) AS DECIMAL(38,8)), 2)::DOUBLE AS avg_temp_low,
       round(CAST(corr(kwh_hourly, temp_high_c) AS DECIMAL(38,10)), 4)::DOUBLE AS corr_kwh_temp_high,
       round(CAST(corr(kwh_hourly, humidity) AS DECIMAL(38,10)), 4)::DOUBLE AS corr_kwh_humidity
FROM mr WHERE temp_high_c IS NOT NULL GROUP BY year, month""",
    "tariff_by_hour": f"""
WITH {HOURLY}
SELECT tariff_type, hour, round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh,
       count(DISTINCT meter_id) AS meter_count FROM mr GROUP BY tariff_type, hour""",
    "daily_consumption": f"""
WITH {HOURLY}
SELECT reading_date, acorn_group, tariff_type, count(DISTINCT meter_id) AS meter_count,
       round(CAST(sum(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS total_kwh, round(CAST(avg(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_kwh_per_meter_hour,
       round(CAST(max(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS peak_kwh, round(CAST(avg(temp_high_c) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_temp_high
FROM mr GROUP BY reading_date, acorn_group, tariff_type""",
    "consumption_heatmap": f"""
WITH {HOURLY}
SELECT acorn_group, CAST(hour AS INTEGER) AS hour_of_day, round(CAST(avg(kwh_hourly) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_kwh
FROM mr GROUP BY acorn_group, hour""",
    "load_curve": f"""
WITH {HOURLY}
SELECT CAST(hour AS INTEGER) AS hour_of_day, round(CAST(sum(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS total_kwh,
       round(CAST(avg(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_kwh FROM mr GROUP BY hour""",
    "table_row_counts": f"""
WITH {HOURLY}, {FORECASTS}
SELECT 'meter_readings' AS tbl, count(*) AS row_count FROM mr
UNION ALL SELECT 'household_stats', count(DISTINCT meter_id) FROM r JOIN h USING (meter_id)
UNION ALL SELECT 'pjm_demand', count(*) FROM d
UNION ALL SELECT 'streamed_readings', count(*) FROM r
UNION ALL SELECT 'demand_forecasts', count(*) FROM f""",
    # --- scoring
    "score_readings": f"{SCORED} SELECT {_SCORE_COLUMNS} FROM s",
    "score_readings_sustained": f"WITH RECURSIVE {_scored(k=1)} SELECT {_SCORE_COLUMNS} FROM s",
    "score_stream": f"{SCORED} SELECT {_SCORE_COLUMNS} FROM s",
    "score_7d_window": f"""
WITH {READINGS},
st AS (
  SELECT *, count(*) OVER w AS n, avg(kwh) OVER w AS m, stddev_pop(kwh) OVER w AS sd FROM r
  WINDOW w AS (PARTITION BY meter_id ORDER BY ts
               RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)
)
SELECT meter_id, reading_id, n, round(CAST(m AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_mean, round(CAST(sd AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_stddev,
       round(CAST(CASE WHEN sd > 0.001 AND n >= 10 THEN (kwh - m) / sd ELSE 0.0 END AS DECIMAL(38,12)), 6)::DOUBLE AS z_score
FROM st""",
    "anomaly_breakdown": f"""{SCORED}
SELECT acorn_group, anomaly_type, count(*) AS anomaly_count, round(CAST(avg(severity) AS DECIMAL(38,9)), 3)::DOUBLE AS avg_severity,
       round(CAST(avg(z) AS DECIMAL(38,9)), 3)::DOUBLE AS avg_zscore, count(DISTINCT meter_id) AS affected_meters
FROM sh WHERE is_anomaly GROUP BY acorn_group, anomaly_type""",
    "anomaly_rate_trend": f"""{SCORED}
SELECT reading_date, count(*) AS total_readings, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       round(CAST(count(*) FILTER (WHERE is_anomaly) * 100.0 / count(*) AS DECIMAL(38,8)), 2)::DOUBLE AS anomaly_rate_pct
FROM s WHERE CAST(reading_date AS DATE) >= CAST({NOW} AS DATE) - 60 GROUP BY reading_date""",
    "hourly_anomaly_counts": f"""{SCORED}
SELECT reading_date, hour, anomaly_type, count(*) AS anomaly_count,
       round(CAST(avg(severity) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_severity, round(CAST(avg(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_kwh
FROM s WHERE is_anomaly AND CAST(reading_date AS DATE) >= CAST({NOW} AS DATE) - 30
GROUP BY reading_date, hour, anomaly_type""",
    "top_anomaly_meters": f"""{SCORED}
SELECT meter_id, acorn_group, tariff_type, count(*) AS total_anomalies,
       count(*) FILTER (WHERE anomaly_type = 'sudden_spike') AS spikes,
       count(*) FILTER (WHERE anomaly_type = 'sustained_elevation') AS sustained,
       count(*) FILTER (WHERE anomaly_type = 'flatline') AS flatlines,
       round(CAST(avg(severity) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_severity, round(CAST(max(z) AS DECIMAL(38,12)), 6)::DOUBLE AS max_z_score
FROM sh WHERE is_anomaly GROUP BY meter_id, acorn_group, tariff_type
ORDER BY total_anomalies DESC, meter_id LIMIT 50""",
    "live_alert_feed": f"""{SCORED}
SELECT ts, meter_id, anomaly_type, round(CAST(severity AS DECIMAL(38,12)), 6)::DOUBLE AS severity,
       round(CAST(kwh_hourly AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly, round(CAST(z AS DECIMAL(38,12)), 6)::DOUBLE AS z_score, acorn_group
FROM sh WHERE is_anomaly AND CAST(reading_date AS DATE) >= CAST({NOW} AS DATE) - 1
ORDER BY ts DESC, meter_id LIMIT 50""",
    "anomaly_type_share": f"""{SCORED}
SELECT anomaly_type, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 0) AS pct
FROM s WHERE is_anomaly GROUP BY anomaly_type""",
    "anomalies_by_day": f"""{SCORED}
SELECT reading_date, anomaly_type, count(*) AS anomaly_count
FROM s WHERE is_anomaly AND CAST(reading_date AS DATE) >= CAST({NOW} AS DATE) - 30
GROUP BY reading_date, anomaly_type""",
    "flagged_meters_top20": f"""{SCORED}
SELECT meter_id, acorn_group, count(*) AS total_anomalies FROM sh WHERE is_anomaly
GROUP BY meter_id, acorn_group, tariff_type ORDER BY total_anomalies DESC, meter_id LIMIT 20""",
    "anomalies_last_hour": f"""{SCORED}
SELECT anomaly_type, count(*) AS cnt FROM s
WHERE is_anomaly AND ts >= (SELECT max(ts) FROM s WHERE is_anomaly) - INTERVAL 1 HOUR GROUP BY anomaly_type""",
    "meter_drilldown": f"""{SCORED}
SELECT ts, round(CAST(kwh_hourly AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly, round(CAST(z AS DECIMAL(38,12)), 6)::DOUBLE AS z_score, anomaly_type FROM s
WHERE meter_id = {_NEWEST_METER} ORDER BY ts DESC, kwh_hourly LIMIT 48""",
    "meter_kpis": f"""{SCORED}
SELECT meter_id,
       count(*) FILTER (WHERE is_anomaly) AS anomalies_48h,
       round(CAST(max(z) AS DECIMAL(38,12)), 6)::DOUBLE AS max_z_score, round(CAST(avg(kwh_hourly) AS DECIMAL(38,12)), 6)::DOUBLE AS avg_kwh,
       max(ts) FILTER (WHERE is_anomaly) AS last_anomaly_ts
FROM s WHERE ts > {NOW} - INTERVAL 48 HOUR GROUP BY meter_id""",
    "household_status": f"""{SCORED}
SELECT meter_id, zone, count(*) AS anomalies, round(CAST(max(z) AS DECIMAL(38,12)), 6)::DOUBLE AS max_z_score,
       CASE WHEN max(z) > 4.5 THEN 'Critical' WHEN max(z) > 3.0 THEN 'Warning' ELSE 'Normal' END AS status
FROM sh WHERE is_anomaly GROUP BY meter_id, zone ORDER BY anomalies DESC, meter_id LIMIT 20""",
    "operations_kpis": f"""{SCORED}, {FORECASTS},
k AS (
  SELECT abs(f.predicted_mw - d.mw_demand) / nullif(d.mw_demand, 0) * 100 AS pct
  FROM f JOIN d ON d.zone = f.zone AND d.ts = f.ts
  WHERE f.ts > {NOW} - INTERVAL 24 HOUR AND f.ts <= {NOW}
)
SELECT round(CAST(sum(kwh) AS DECIMAL(38,10)), 4)::DOUBLE AS total_kwh, count(DISTINCT meter_id) AS active_meters,
       (SELECT count(*) FROM s WHERE is_anomaly AND ts >= {NOW} - INTERVAL 1 HOUR) AS alerts_last_hour,
       (SELECT round(CAST(avg(pct) AS DECIMAL(38,10)), 4)::DOUBLE FROM k) AS mape_24h
FROM r JOIN h USING (meter_id)""",
    # --- alert table
    "recent_alerts_for_meter": f"""{SCORED}
SELECT meter_id, ts, round(z, 3) AS z_score, anomaly_type, round(severity, 2) AS severity,
       'open' AS status
FROM s WHERE is_anomaly AND meter_id = (
  SELECT meter_id FROM s WHERE is_anomaly GROUP BY meter_id ORDER BY count(*) DESC, meter_id LIMIT 1)
ORDER BY ts DESC, anomaly_type, z DESC LIMIT 20""",
    "open_alerts": f"""{SCORED}
SELECT meter_id, ts, round(z, 3) AS z_score, anomaly_type, round(severity, 2) AS severity,
       acorn_group, tariff_type, 'open' AS status
FROM sh WHERE is_anomaly AND ts >= {_WEEK_AGO} ORDER BY ts DESC, meter_id, anomaly_type, z DESC LIMIT 200""",
    "alert_type_counts": f"""{SCORED}
SELECT anomaly_type, count(*) AS count FROM s WHERE is_anomaly GROUP BY anomaly_type""",
    "top_meters_by_alerts": f"""{SCORED}
SELECT meter_id, count(*) AS alert_count FROM s WHERE is_anomaly
GROUP BY meter_id ORDER BY alert_count DESC, meter_id LIMIT 10""",
    "alert_summary": f"""{SCORED},
o AS (SELECT * FROM s WHERE is_anomaly AND ts >= {_WEEK_AGO})
SELECT count(*) AS total_open_alerts,
       count(*) FILTER (WHERE anomaly_type = 'sudden_spike') AS spike_count,
       count(*) FILTER (WHERE anomaly_type = 'sustained_elevation') AS sustained_count,
       count(*) FILTER (WHERE anomaly_type = 'flatline') AS flatline_count,
       coalesce((SELECT meter_id FROM o GROUP BY meter_id ORDER BY count(*) DESC, meter_id LIMIT 1),
                'N/A') AS top_offending_meter
FROM o""",
    "alerts_by_zone": f"""{SCORED}
SELECT zone, count(*) AS alerts, count(*) FILTER (WHERE ts >= {_WEEK_AGO}) AS open_alerts
FROM sh WHERE is_anomaly GROUP BY zone""",
    "meter_state_latest": f"""{SCORED}
SELECT meter_id, n AS count, round(CAST(m AS DECIMAL(38,11)), 5)::DOUBLE AS rolling_mean, round(CAST(sd AS DECIMAL(38,11)), 5)::DOUBLE AS rolling_stddev,
       consecutive_high, ts AS last_updated
FROM s QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) = 1""",
    "latest_readings_30d": f"""
WITH {READINGS}
SELECT meter_id, reading_id, ts, round(CAST(kwh AS DECIMAL(38,12)), 6)::DOUBLE AS kwh FROM r WHERE ts > {NOW} - INTERVAL 30 DAY
QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) = 1""",
    "alert_versions_kept": f"""
WITH {READINGS}
SELECT meter_id, reading_date, ts, reading_id FROM r WHERE ts > {NOW} - INTERVAL 90 DAY
QUALIFY row_number() OVER (PARTITION BY meter_id, reading_date ORDER BY ts DESC) <= 3""",
    "zscore_history": f"""{SCORED},
w AS (
  SELECT meter_id, ts, reading_id, printf('%.3f', round(z, 3) + 0.0) AS z3 FROM s
  QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) <= 48
)
SELECT meter_id, string_agg(z3, ',' ORDER BY ts, reading_id) AS last_n_zscore FROM w GROUP BY meter_id""",
    "alert_keys": f"""{SCORED}
SELECT meter_id, ts, meter_id || '_' || CAST(99999999999 - CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS row_key
FROM s WHERE is_anomaly""",
    # --- injection
    "inject_anomalies": f"""
WITH {READINGS}, src AS ({INJECTED})
SELECT meter_id, reading_id, round(CAST(kwh_hourly AS DECIMAL(38,10)), 4)::DOUBLE AS kwh_hourly, injected_anomaly FROM src""",
    "injection_validation": f"""WITH RECURSIVE {_scored(INJECTED)}
SELECT injected_anomaly, anomaly_type AS detected_as, count(*) AS count,
       round(CAST(avg(severity) AS DECIMAL(38,9)), 3)::DOUBLE AS avg_severity, round(CAST(avg(z) AS DECIMAL(38,9)), 3)::DOUBLE AS avg_zscore,
       count(*) FILTER (WHERE is_anomaly) AS correctly_flagged,
       count(*) FILTER (WHERE NOT is_anomaly) AS missed,
       count(*) FILTER (WHERE injected_anomaly = anomaly_type) AS type_match
FROM s WHERE injected_anomaly <> 'none' GROUP BY 1, 2""",
    "detection_quality": f"""WITH RECURSIVE {_scored(INJECTED)},
q AS (
  SELECT count(*) FILTER (WHERE injected_anomaly <> 'none' AND is_anomaly) AS true_positive,
         count(*) FILTER (WHERE injected_anomaly = 'none' AND is_anomaly) AS false_positive,
         count(*) FILTER (WHERE injected_anomaly <> 'none' AND NOT is_anomaly) AS false_negative,
         count(*) FILTER (WHERE injected_anomaly <> 'none' AND injected_anomaly = anomaly_type) AS type_match
  FROM s
)
SELECT *, round(CAST(true_positive / nullif(true_positive + false_positive, 0) AS DECIMAL(38,10)), 4)::DOUBLE AS precision,
       round(CAST(true_positive / nullif(true_positive + false_negative, 0) AS DECIMAL(38,10)), 4)::DOUBLE AS recall,
       round(CAST(type_match / nullif(true_positive + false_negative, 0) AS DECIMAL(38,10)), 4)::DOUBLE AS type_recall
FROM q""",
    # --- demand
    "demand_grid": f"""
WITH {DEMAND}
SELECT zone, ts, mw_demand, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       CAST(extract(hour FROM ts) AS INTEGER) AS hour,
       CAST(extract(dow FROM ts) + 1 AS INTEGER) AS day_of_week,
       extract(dow FROM ts) IN (0, 6) AS is_weekend FROM d""",
    "demand_lags": f"""
WITH {DEMAND}
SELECT d.zone, d.ts, d.mw_demand, a.mw_demand AS lag_1h, b.mw_demand AS lag_2h,
       e.mw_demand AS lag_24h, g.mw_demand AS lag_168h
FROM d LEFT JOIN d a ON a.zone = d.zone AND a.ts = d.ts - INTERVAL 1 HOUR
LEFT JOIN d b ON b.zone = d.zone AND b.ts = d.ts - INTERVAL 2 HOUR
LEFT JOIN d e ON e.zone = d.zone AND e.ts = d.ts - INTERVAL 24 HOUR
LEFT JOIN d g ON g.zone = d.zone AND g.ts = d.ts - INTERVAL 168 HOUR""",
    "demand_row_lags": f"WITH {DEMAND} SELECT zone, ts, mw_demand, {_LAGS} FROM d",
    "demand_rolling": f"""
WITH {DEMAND}, w AS (
  SELECT zone, ts, mw_demand, {_rolling('167 PRECEDING AND CURRENT ROW', '23 PRECEDING AND CURRENT ROW')}
  FROM d
)
SELECT zone, ts, mw_demand, round(CAST(rolling_7d_mean AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_7d_mean,
       round(CAST(rolling_7d_stddev AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_7d_stddev,
       round(CAST(rolling_24h_mean AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_24h_mean FROM w""",
    "demand_range_rolling": f"""
WITH {DEMAND}, w AS (SELECT zone, ts, mw_demand, {_RANGE} FROM d)
SELECT zone, ts, mw_demand, round(CAST(rolling_7d_mean AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_7d_mean,
       round(CAST(rolling_7d_stddev AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_7d_stddev,
       round(CAST(rolling_24h_mean AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_24h_mean FROM w""",
    "recent_history": f"""
WITH {DEMAND}
SELECT zone, ts, mw_demand FROM d QUALIFY ts >= max(ts) OVER (PARTITION BY zone) - INTERVAL 200 HOUR""",
    "seasonal_index": f"""
WITH {DEMAND}, i AS (
  SELECT *, avg(mw_demand) OVER (PARTITION BY zone, extract(month FROM ts), extract(hour FROM ts)) AS si
  FROM d
)
SELECT zone, ts, mw_demand, round(CAST(si AS DECIMAL(38,12)), 6)::DOUBLE AS seasonal_index,
       round(CAST(mw_demand - si AS DECIMAL(38,12)), 6)::DOUBLE AS seasonal_deviation FROM i""",
    "cyclic_onehot": f"""
WITH {DEMAND}, k AS (SELECT zone, ts, mw_demand, {_CALENDAR_LEAK_FREE} FROM d)
SELECT zone, ts, mw_demand, round(CAST(hour_sin AS DECIMAL(38,12)), 6)::DOUBLE AS hour_sin, round(CAST(hour_cos AS DECIMAL(38,12)), 6)::DOUBLE AS hour_cos,
       round(CAST(month_sin AS DECIMAL(38,12)), 6)::DOUBLE AS month_sin, round(CAST(month_cos AS DECIMAL(38,12)), 6)::DOUBLE AS month_cos,
       CAST(is_weekend AS DOUBLE) AS is_weekend,
       {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in _DAYS)} FROM k""",
    "feature_frame": f"""
WITH {DEMAND}, w AS (
  SELECT zone, ts, mw_demand, {_LAGS},
         {_rolling('167 PRECEDING AND CURRENT ROW', '23 PRECEDING AND CURRENT ROW')},
         avg(mw_demand) OVER (PARTITION BY zone, extract(month FROM ts), extract(hour FROM ts)) AS seasonal_index
  FROM d
), k AS (
  SELECT *, mw_demand - seasonal_index AS seasonal_deviation, {_CALENDAR_PLAIN} FROM w
)
SELECT zone, ts, mw_demand, {_ROUNDED} FROM k WHERE {_KNOWN}""",
    "feature_frame_leak_free": f"""
WITH {DEMAND}, w AS (
  SELECT zone, ts, mw_demand, {_LAGS},
         {_rolling('168 PRECEDING AND 1 PRECEDING', '24 PRECEDING AND 1 PRECEDING')} FROM d
), t AS (SELECT * FROM d WHERE ts <= (SELECT max(ts) FROM d) - INTERVAL 6 DAY),
m AS (SELECT zone, extract(month FROM ts) AS mo, extract(hour FROM ts) AS ho, avg(mw_demand) AS v
      FROM t GROUP BY 1, 2, 3),
o AS (SELECT zone, extract(hour FROM ts) AS ho, avg(mw_demand) AS v FROM t GROUP BY 1, 2),
i AS (
  SELECT w.*, coalesce(m.v, o.v) AS seasonal_index FROM w
  LEFT JOIN m ON m.zone = w.zone AND m.mo = extract(month FROM w.ts) AND m.ho = extract(hour FROM w.ts)
  LEFT JOIN o ON o.zone = w.zone AND o.ho = extract(hour FROM w.ts)
), k AS (
  SELECT *, lag_24h - seasonal_index AS seasonal_deviation, {_CALENDAR_LEAK_FREE} FROM i
)
SELECT zone, ts, mw_demand, {_ROUNDED} FROM k WHERE {_KNOWN}""",
    "forecast_window": f"""
WITH {DEMAND},
hist AS (SELECT * FROM d QUALIFY ts >= max(ts) OVER (PARTITION BY zone) - INTERVAL 200 HOUR),
slot AS (
  SELECT zone, max(ts) + CAST(q.i AS INTEGER) * INTERVAL 1 HOUR AS ts
  FROM hist, (SELECT unnest(generate_series(1, 24)) AS i) q GROUP BY zone, q.i
),
both_ AS (SELECT zone, ts, mw_demand, false AS ahead FROM hist
          UNION ALL SELECT zone, ts, NULL, true FROM slot),
w AS (SELECT zone, ts, ahead, {_RANGE} FROM both_),
l AS (
  SELECT w.zone, w.ts, a.mw_demand AS lag_1h, b.mw_demand AS lag_2h, e.mw_demand AS lag_24h,
         g.mw_demand AS lag_168h, coalesce(w.rolling_7d_mean, 0) AS rolling_7d_mean,
         coalesce(w.rolling_7d_stddev, 0) AS rolling_7d_stddev,
         coalesce(w.rolling_24h_mean, w.rolling_7d_mean, 0) AS rolling_24h_mean
  FROM w LEFT JOIN hist a ON a.zone = w.zone AND a.ts = w.ts - INTERVAL 1 HOUR
  LEFT JOIN hist b ON b.zone = w.zone AND b.ts = w.ts - INTERVAL 2 HOUR
  LEFT JOIN hist e ON e.zone = w.zone AND e.ts = w.ts - INTERVAL 24 HOUR
  LEFT JOIN hist g ON g.zone = w.zone AND g.ts = w.ts - INTERVAL 168 HOUR
  WHERE w.ahead
),
k AS (
  SELECT *, rolling_7d_mean AS seasonal_index, 0.0 AS seasonal_deviation, {_CALENDAR_LEAK_FREE} FROM l
  WHERE lag_24h IS NOT NULL AND lag_168h IS NOT NULL
)
SELECT zone, ts, {_ROUNDED} FROM k""",
    "time_split": f"""
WITH {DEMAND}
SELECT CASE WHEN ts <= (SELECT max(ts) FROM d) - INTERVAL 6 DAY THEN 'train' ELSE 'test' END AS part,
       count(*) AS rows FROM d GROUP BY 1""",
    "forecast_gbt_targets": f"""
WITH {DEMAND}, a AS (SELECT zone, max(ts) AS anchor_ts FROM d GROUP BY zone), t AS (
  SELECT zone, anchor_ts + CAST(i AS INTEGER) * INTERVAL 1 HOUR AS ts FROM a, (SELECT unnest(generate_series(1, 24)) AS i))
SELECT ts, zone, CAST(NULL AS DOUBLE) AS actual_mw, '2024-01-31T00:00:00' AS forecast_run_ts,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month FROM t""",
    "future_grid": f"""
WITH {DEMAND}, a AS (SELECT zone, max(ts) AS anchor_ts FROM d GROUP BY zone)
SELECT zone, anchor_ts, CAST(i AS INTEGER) AS h, anchor_ts + CAST(i AS INTEGER) * INTERVAL 1 HOUR AS ts
FROM a, (SELECT unnest(generate_series(1, 24)) AS i)""",
    # --- forecast reports
    "seasonal_naive_forecast": f"""
WITH {FORECASTS}
SELECT ts, zone, round(CAST(predicted_mw AS DECIMAL(38,10)), 4)::DOUBLE AS predicted_mw, CAST(NULL AS DOUBLE) AS actual_mw,
       '2024-01-31T00:00:00' AS forecast_run_ts, strftime(ts, '%Y') AS year,
       strftime(ts, '%m') AS month FROM f""",
    "forecast_accuracy": f"""
WITH {FORECASTS}
SELECT CAST(f.ts AS DATE) AS forecast_date, f.zone, count(*) AS forecast_points,
       round(CAST(avg(abs(f.predicted_mw - d.mw_demand)) AS DECIMAL(38,8)), 2)::DOUBLE AS mae_mw,
       round(CAST(sqrt(avg(power(f.predicted_mw - d.mw_demand, 2))) AS DECIMAL(38,8)), 2)::DOUBLE AS rmse_mw,
       round(CAST(avg(abs(f.predicted_mw - d.mw_demand) / d.mw_demand) * 100 AS DECIMAL(38,8)), 2)::DOUBLE AS mape_pct
FROM f JOIN d ON d.zone = f.zone AND d.ts = f.ts
WHERE f.ts >= CAST((SELECT max(ts) FROM d) AS DATE) - 7 AND d.mw_demand > 0
GROUP BY 1, 2""",
    "forecast_vs_actual": f"""
WITH {ACCURACY}
SELECT ts, zone, round(CAST(predicted_mw AS DECIMAL(38,10)), 4)::DOUBLE AS predicted_mw, round(CAST(actual_mw AS DECIMAL(38,10)), 4)::DOUBLE AS actual_mw,
       round(CAST(abs_error_mw AS DECIMAL(38,10)), 4)::DOUBLE AS abs_error_mw, round(CAST(pct_error AS DECIMAL(38,10)), 4)::DOUBLE AS pct_error FROM fa""",
    "forecast_last_48h": f"""
WITH {ACCURACY}
SELECT ts, zone, round(CAST(predicted_mw AS DECIMAL(38,10)), 4)::DOUBLE AS predicted_mw, round(CAST(actual_mw AS DECIMAL(38,10)), 4)::DOUBLE AS actual_mw FROM fa
WHERE ts > (SELECT max(ts) FROM d) - INTERVAL 48 HOUR AND ts <= (SELECT max(ts) FROM d)""",
    "load_kpis_24h": f"""
WITH {FORECASTS}
SELECT round(CAST(max(predicted_mw) AS DECIMAL(38,10)), 4)::DOUBLE AS peak_predicted_24h, round(CAST(avg(predicted_mw) AS DECIMAL(38,10)), 4)::DOUBLE AS avg_predicted_24h,
       max(ts) AS last_forecast_ts, '2024-01-31T00:00:00' AS last_forecast_run
FROM f WHERE ts >= (SELECT max(ts) FROM d) AND ts <= (SELECT max(ts) FROM d) + INTERVAL 24 HOUR""",
    "accuracy_kpis": f"""
WITH {ACCURACY}
SELECT round(CAST(avg(abs_error_mw) AS DECIMAL(38,10)), 4)::DOUBLE AS mae, round(CAST(sqrt(avg(power(abs_error_mw, 2))) AS DECIMAL(38,10)), 4)::DOUBLE AS rmse,
       round(CAST(avg(pct_error) AS DECIMAL(38,10)), 4)::DOUBLE AS mape FROM fa WHERE actual_mw IS NOT NULL""",
    "next_forecast_hours": f"""
WITH {FORECASTS}
SELECT ts, zone, round(CAST(predicted_mw AS DECIMAL(38,10)), 4)::DOUBLE AS predicted_mw, CAST(NULL AS DOUBLE) AS actual_mw FROM f
WHERE ts > (SELECT max(ts) FROM d) AND ts <= (SELECT max(ts) FROM d) + INTERVAL 6 HOUR""",
    "naive_metrics": f"""
WITH {FORECASTS}, e AS (
  SELECT d.mw_demand AS y, d.mw_demand - f.predicted_mw AS e FROM f JOIN d ON d.zone = f.zone AND d.ts = f.ts
)
SELECT count(*) AS test_rows, round(CAST(sqrt(avg(e * e)) AS DECIMAL(38,10)), 4)::DOUBLE AS rmse, round(CAST(avg(abs(e)) AS DECIMAL(38,10)), 4)::DOUBLE AS mae,
       round(CAST(1 - sum(e * e) / (var_pop(y) * count(*)) AS DECIMAL(38,10)), 4)::DOUBLE AS r2 FROM e""",
    "naive_band": f"""
WITH {FORECASTS}, e AS (
  SELECT extract(hour FROM d.ts) AS ho, d.mw_demand - f.predicted_mw AS e
  FROM f JOIN d ON d.zone = f.zone AND d.ts = f.ts
), k AS (
  SELECT ho, e, row_number() OVER (PARTITION BY ho ORDER BY e) AS i, count(*) OVER (PARTITION BY ho) AS n
  FROM e
), q AS (
  SELECT ho, max(e) FILTER (WHERE i = CAST(ceil(0.1 * n) AS BIGINT)) AS lo,
         max(e) FILTER (WHERE i = CAST(ceil(0.9 * n) AS BIGINT)) AS hi FROM k GROUP BY ho
)
SELECT zone, ts, round(CAST(predicted_mw AS DECIMAL(38,10)), 4)::DOUBLE AS prediction, round(CAST(predicted_mw + lo AS DECIMAL(38,10)), 4)::DOUBLE AS lower,
       round(CAST(predicted_mw + hi AS DECIMAL(38,10)), 4)::DOUBLE AS upper
FROM f LEFT JOIN q ON q.ho = extract(hour FROM f.ts) WHERE ts > (SELECT max(ts) FROM d)""",
    # --- streaming
    "alert_payload_json": f"""{SCORED}
SELECT meter_id AS key, meter_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts,
       round(CAST(kwh_hourly AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly, round(CAST(z AS DECIMAL(38,12)), 6)::DOUBLE AS z_score, anomaly_type,
       round(CAST(severity AS DECIMAL(38,12)), 6)::DOUBLE AS severity, round(CAST(m AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_mean,
       round(CAST(sd AS DECIMAL(38,12)), 6)::DOUBLE AS rolling_stddev, acorn_group, reading_date
FROM sh WHERE is_anomaly""",
    "event_decode": f"""
WITH {READINGS}
SELECT meter_id, date_trunc('second', ts) AS ts, round(CAST(kwh AS DECIMAL(38,12)), 6)::DOUBLE AS kwh_hourly, reading_date, hour FROM r""",
}
