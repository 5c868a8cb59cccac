from pyspark.sql import functions as F

from kilowatch.functions import text
from kilowatch.operators import cleaning, enrich, rollup
from kilowatch.operators.alerts import newest_first_key
from kilowatch.streaming import decode

RAW = "meter_id string, ts_raw string, kwh_raw string"
STAMP = "2012-10-12 00:30:00.0000000"


def reasons(spark, rows):
    valid, rejected = cleaning.clean_readings(spark.createDataFrame(rows, RAW))
    return valid.collect(), [r.reject_reason for r in rejected.collect()]


def test_reference_row(spark):
    (row,), none = reasons(spark, [(" MAC000002 ", STAMP, "0.078")])
    assert none == []
    assert tuple(row) == (
        "MAC000002", "2012-10-12 00:30:00", 0.078, "2012-10-12", "2012-10", "2012", "00"
    )


def test_headers_and_null_markers(spark):
    rows = [("LCLid", "tstp", "energy"), ("MAC", STAMP, "1"), (None, STAMP, "1")]
    rows += [("M1", STAMP, k) for k in ("Null", "NULL", "null", "", " Null ", None)]
    valid, why = reasons(spark, rows)
    assert valid == [] and sorted(why) == ["header"] * 3 + ["null_marker"] * 6


def test_number_shapes(spark):
    valid, why = reasons(spark, [("M1", STAMP, k) for k in ("1.", "-1", ".5", "1e3", "+1", "abc")])
    assert [r.kwh for r in valid] == [1.0]
    assert sorted(why) == ["not_numeric"] * 4 + ["out_of_range"]


def test_range_edges(spark):
    valid, why = reasons(spark, [("M1", STAMP, k) for k in ("0", "100", "100.0001")])
    assert sorted(r.kwh for r in valid) == [0.0, 100.0] and why == ["out_of_range"]


def test_timestamps(spark):
    valid, why = reasons(
        spark, [("M1", "2012-10-12 00:30:0", "1"), ("M1", "2012-13-45 00:00:00", "1"), ("M1", None, "1")]
    )
    assert valid == [] and why == ["bad_timestamp"] * 3


def slots(spark, rows):
    return spark.createDataFrame(rows, "meter_id string, reading_date string, hour string, kwh double")


def meta(spark, rows):
    return spark.createDataFrame(rows, "meter_id string, tariff_type string, acorn_group string")


def test_rollup_min_slots_and_two_tariffs(spark):
    rows = [("M1", "2012-01-01", "00", 1.0), ("M1", "2012-01-01", "00", 2.0), ("M1", "2012-01-01", "01", 4.0)]
    two = meta(spark, [("M1", "Std", "A"), ("M1", "ToU", "A")])
    for min_slots, expected in ((1, 4), (2, 2)):
        first = rollup.rollup_hourly(enrich.attach_meta(slots(spark, rows), two), min_slots)
        second = rollup.rollup_then_enrich(slots(spark, rows), two, min_slots)
        assert first.count() == expected
        assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.select(*first.columns).collect()))


def test_rollup_before_join_counts_repeated_metadata(spark):
    rows = [("M1", "2012-01-01", "00", 1.0), ("M1", "2012-01-01", "00", 2.0)]
    twice = meta(spark, [("M1", "Std", "A"), ("M1", "Std", "A")])
    first = rollup.rollup_hourly(enrich.attach_meta(slots(spark, rows), twice))
    second = rollup.rollup_then_enrich(slots(spark, rows), twice).select(*first.columns)
    assert first.collect() == second.collect()
    assert first.first().kwh_hourly == 6.0 and first.first().reading_count == 4


def test_inner_and_left_joins(spark):
    rows = slots(spark, [("M1", "2012-01-01", "00", 1.0), ("M2", "2012-01-02", "00", 1.0)])
    one = meta(spark, [("M1", "Std", "A")])
    assert enrich.attach_meta(rows, one).count() == 1
    assert enrich.attach_meta(rows, one, "left").count() == 2
    assert enrich.unmatched(rows, one, "meter_id", "meter_id").count() == 1
    weather = rollup.daily_weather(
        spark.createDataFrame([("2012-01-01", 9.0, 1.0, 0.5), ("2012-01-01", 11.0, 3.0, 0.7)],
                              "w_date string, temp_high_c double, temp_low_c double, humidity double")
    )
    assert enrich.attach_weather(rows, weather).first().temp_high_c == 10.0
    assert enrich.attach_weather(rows, weather, "left").count() == 2


def test_meter_stats_of_constant_series_is_no_nan(spark):
    rows = slots(spark, [("M1", "2012-01-01", "00", 0.1)] * 30)
    assert abs(rollup.meter_stats(rows).first().global_stddev) < 1e-9


def test_dedup_has_one_winner_for_any_partitioning(spark):
    rows = [("M1", "2012-01-01 00:00:00", k, g) for k in (1.0, 3.0, 3.0, 2.0) for g in ("a", "b")]
    df = spark.createDataFrame(rows, "meter_id string, ts string, kwh_hourly double, g string")
    winners = {tuple(cleaning.dedup_readings(df.repartition(n)).first()) for n in (1, 3, 7)}
    assert winners == {("M1", "2012-01-01 00:00:00", 3.0, "b")}


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 AS meter_id", "id % 2 AS ts", "id AS kwh_hourly")
    plan = cleaning.dedup_readings(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reading_columns_quarantine_bad_hours(spark):
    df = spark.createDataFrame(
        [("M1", "2012-01-01", "7", 9.0, 1.0), ("M1", "2012-01-01", "99", 9.0, 1.0)],
        "meter_id string, reading_date string, hour string, temp_high_c double, temp_low_c double",
    )
    good, bad = cleaning.with_reading_columns(df)
    row = good.first()
    assert (str(row.ts), row.year, row.month, row.temp_range_c) == ("2012-01-01 07:00:00", "2012", "01", 8.0)
    assert bad.count() == 1


def test_clean_meta_and_weather(spark):
    m = spark.createDataFrame(
        [("LCLid", "x", "x", "x", "f"), (" M1 ", " Std", "ACORN-A", "Affluent ", "b0")],
        "meter_id string, tariff_type string, acorn string, acorn_group string, file string",
    )
    assert [tuple(r) for r in cleaning.clean_meta(m).collect()] == [("M1", "Std", "ACORN-A", "Affluent")]
    w = spark.createDataFrame(
        [("time", "temp_high", "temp_low", "humidity"), ("2012-01-01 05:00:00", "9", " ", "0.5"),
         ("2012-01-01 05:00:00", "9", "1.5", "x")],
        "time string, temp_high string, temp_low string, humidity string",
    )
    assert [tuple(r) for r in cleaning.clean_weather(w).collect()] == [("2012-01-01", 9.0, 1.5, None)]


def test_event_records(spark):
    names = "meter_id reading_date hour tariff_type acorn_group kwh_hourly kwh_max temp_high_c temp_low_c humidity"
    rows = [
        (" M1", "2012-01-01", "7", "Std", "A", "0.5", "", "9", "", ""),
        ("M1", "2012-01-01", "8", "Std", "A", "bad", "1", "9", "1", "1"),
        ("M1", "2012-01-01", "9", "Std", "A", "0.5", "x", "9", "1", "1"),
    ]
    out = decode.event_records(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split())))
    (row,) = out.collect()
    assert (row.meter_id, row.ts, row.hour) == ("M1", "2012-01-01T07:00:00", "07")
    assert (row.kwh_max, row.temp_low_c, row.humidity, row.simulated) == (0.0, 0.0, 0.0, True)
    days = decode.date_bounds(out, "2012-01-01", "2012-01-01")
    assert days.count() == 1 and decode.date_bounds(out, "2012-01-02").count() == 0


def test_text_and_clock_functions(spark):
    row = spark.range(1).select(
        text.two_digits(F.lit(7)).alias("h"),
        text.zone_of_header(F.lit("AEP_MW")).alias("z"),
        text.is_meter_id(F.lit("MAC-1")).alias("ok"),
        text.is_meter_id(F.lit("--")).alias("dashes"),
        text.is_meter_id(F.lit("a b")).alias("blank"),
        text.is_plain_number(F.lit(" 1.5 ")).alias("num"),
        newest_first_key(F.lit("M1"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("key"),
    ).first()
    assert tuple(row) == ("07", "AEP", True, False, False, True, f"M1_{99_999_999_999 - 1_704_067_200}")
