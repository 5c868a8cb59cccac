import os

from pyspark.sql import functions as F

from kilowatch.operators import cleaning, rollup
from kilowatch.sinks import catalog, tables
from kilowatch.sources import files


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_zone_files_keep_their_own_zone(spark, tmp_path):
    write(f"{tmp_path}/AEP_hourly.csv", "Datetime,AEP_MW\n2024-01-06 00:00:00,10.5\nbad,1\n2024-01-06 01:00:00,x\n")
    write(f"{tmp_path}/DOM_hourly.csv", "Datetime,DOM_MW\n2024-01-08 05:00:00,20\n")
    rows = {r.zone: r for r in files.zone_demand(spark, f"{tmp_path}/*.csv").collect()}
    assert {z: r.mw_demand for z, r in rows.items()} == {"AEP": 10.5, "DOM": 20.0}
    assert (rows["AEP"].is_weekend, rows["AEP"].day_of_week, rows["AEP"].month) == (True, 7, "01")
    assert (rows["DOM"].is_weekend, rows["DOM"].hour, rows["DOM"].year) == (False, 5, "2024")


def test_raw_files_to_clean_hours(spark, tmp_path):
    stamp = "2012-01-01 00:{}:00.0000000"
    for i in range(2):
        write(f"{tmp_path}/raw/block_{i}.csv",
              "LCLid,tstp,energy(kWh/hh)\n" + "".join(f"M{i},{stamp.format(m)},0.{m}1\n" for m in ("00", "30")))
    write(f"{tmp_path}/meta.csv", 'LCLid,stdorToU,Acorn,Acorn_grouped,file\nM0,Std,"ACORN-A, B",Affluent,b\nM1,ToU,C,"Com, fort",b\n')
    write(f"{tmp_path}/weather.csv",
          'time,summary,icon,temperatureHigh,temperatureLow,humidity\n2012-01-01 00:00:00,"Cloudy, windy",c,9.5,1.5,0.8\n')
    valid, rejected = cleaning.clean_readings(files.raw_readings(spark, f"{tmp_path}/raw/*.csv"))
    assert valid.count() == 4 and {r.reject_reason for r in rejected.collect()} == {"header"}
    meta = cleaning.clean_meta(files.household_meta(spark, f"{tmp_path}/meta.csv"))
    hourly = rollup.rollup_then_enrich(valid, meta, min_slots=2)
    got = {(r.meter_id, r.acorn_group, round(r.kwh_hourly, 4)) for r in hourly.collect()}
    assert got == {("M0", "Affluent", 0.302), ("M1", "Com, fort", 0.302)}
    weather = files.weather(spark, f"{tmp_path}/weather.csv",
                            {"temp_high": "temperatureHigh", "temp_low": "temperatureLow"})
    assert tuple(cleaning.clean_weather(weather).first()) == ("2012-01-01", 9.5, 1.5, 0.8)


CLEAN = "MAC000001,2012-01-01,00,Std,Adversity,0.234,0.145,12.3,5.1,0.82\nMAC000002,2012-02-01,01,ToU,Comfortable,0.39,0.25,12.1,5.0,0.83\n"


def clean(spark, tmp_path):
    df = files.clean_readings(spark, write(f"{tmp_path}/clean/part.csv", CLEAN))
    return cleaning.with_reading_columns(df)[0]


def test_partitioned_table_roundtrip(spark, tmp_path):
    path = f"{tmp_path}/readings"
    df = clean(spark, tmp_path)
    tables.write_partitioned(df, path, ["year", "month"], ["meter_id", "ts"])
    assert sorted(os.listdir(f"{path}/year=2012"))[:2] == ["month=01", "month=02"]
    back = files.parquet(spark, path)
    assert dict(back.dtypes)["month"] == "string" and back.count() == 2
    # Overwriting one month leaves the other alone.
    tables.write_partitioned(df.where("month = '01'").withColumn("kwh_hourly", F.lit(9.0)), path, ["year", "month"])
    assert {r.month: r.kwh_hourly for r in files.parquet(spark, path).collect()} == {"01": 9.0, "02": 0.39}


def test_catalog_tables_and_views(spark, tmp_path):
    path = f"{tmp_path}/readings"
    tables.write_partitioned(clean(spark, tmp_path), path, ["year", "month"])
    catalog.use_database(spark, "energy")
    try:
        table = catalog.register_table(spark, "meter_readings", path)
        assert table.count() == 2
        plan = table.where("month = '02'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan
        catalog.register_views({"tou": table.where("tariff_type = 'ToU'")})
        assert spark.sql("SELECT meter_id FROM tou").first().meter_id == "MAC000002"
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_partition_bounds_prune(spark, tmp_path):
    df = clean(spark, tmp_path).withColumnsRenamed({"year": "reading_year", "month": "reading_month"})
    tables.write_partitioned(df, f"{tmp_path}/scored", ["reading_year", "reading_month"])
    bounded = files.with_partition_bounds(files.parquet(spark, f"{tmp_path}/scored"), "2012-02-01", "2012-02-28")
    assert [r.meter_id for r in bounded.collect()] == ["MAC000002"]
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_plain_text_metrics_and_summary(spark, tmp_path):
    df = clean(spark, tmp_path).select("meter_id", "kwh_hourly")
    tables.write_plain(df, f"{tmp_path}/plain")
    tables.write_text(df, f"{tmp_path}/text")
    tables.write_metrics(df, f"{tmp_path}/metrics")
    assert spark.read.csv(f"{tmp_path}/text").count() == 2
    assert spark.read.csv(f"{tmp_path}/metrics", header=True).columns == ["meter_id", "kwh_hourly"]
    counts = tables.summary(spark, {"plain": f"{tmp_path}/plain"}).first()
    assert tuple(counts) == ("plain", 2)
    stats = write(f"{tmp_path}/stats/part.csv", "M1,4,0.5,0.1,0.9,0.2\n")
    assert files.meter_stats(spark, stats).first().total_readings == 4
    assert files.clean_readings_text(spark, f"{tmp_path}/clean/part.csv").first().kwh_hourly == "0.234"


def test_forecast_table_keeps_other_zones_and_runs(spark):
    def rows(zone, run, mw):
        return spark.sql(
            f"SELECT timestamp'2024-01-01 00:00:00' AS ts, '{zone}' AS zone, {mw}D AS predicted_mw, "
            f"CAST(NULL AS DOUBLE) AS actual_mw, '{run}' AS forecast_run_ts, '2024' AS year, '01' AS month"
        )

    for zone, run, mw in (("AEP", "r1", 1), ("DOM", "r1", 2), ("AEP", "r2", 3), ("AEP", "r1", 4)):
        tables.save_forecast(rows(zone, run, mw), "forecasts_test")
    got = {(r.zone, r.forecast_run_ts): r.predicted_mw for r in spark.table("forecasts_test").collect()}
    assert got == {("AEP", "r1"): 4.0, ("DOM", "r1"): 2.0, ("AEP", "r2"): 3.0}
