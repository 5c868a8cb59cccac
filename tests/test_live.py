import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kilowatch.operators import alerts as alert_ops
from kilowatch.operators.scoring import score_batch
from kilowatch.sinks.alertlog import AlertLog, StatusLog
from kilowatch.sinks.snapshots import Snapshot, upsert_states
from kilowatch.streaming import jobs, live

START = dt.datetime(2024, 1, 1)
ALERT = "meter_id string, ts timestamp, z_score double, anomaly_type string, status string, created_at timestamp"
STATE = "meter_id string, count bigint, rolling_mean double, rolling_stddev double, consecutive_high bigint, last_updated timestamp"


def at(hours):
    return START + dt.timedelta(hours=hours)


def messages(rows):
    """JSON messages of (meter, hour, kwh)."""
    text = '{{"meter_id":"{0}","ts":"{1}","kwh_hourly":{2},"reading_date":"{3}"}}'
    return [(m, text.format(m, at(h).strftime("%Y-%m-%dT%H:%M:%S"), x, at(h).date())) for m, h, x in rows]


BAD = [("k", "not json"), ("k", '{"meter_id":"M1","ts":"yesterday","kwh_hourly":1}'), (None, '{"meter_id":"M1","ts":"2024-01-01T00:00:00","kwh_hourly":-1}')]


def put(spark, folder, rows):
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return jobs.stream_source(spark, "files", folder, schema="key string, value string", files_per_trigger=1)


def test_live_job_over_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"M{m}", h, round(rng.expovariate(2.0), 3)) for h in range(72) for m in range(3)]
    tables = live.LiveTables(f"{tmp_path}/live", "live_states")
    for batch in range(6):
        put(spark, f"{tmp_path}/in", messages([r for r in rows if 12 * batch <= r[1] < 12 * (batch + 1)]) + BAD[: batch % 4])
        if batch in (3, 5):  # five micro-batches and more, with a restart in between
            live.start_live(source(spark, f"{tmp_path}/in"), tables, bounded=True, sustained=1).awaitTermination()
    frame = spark.createDataFrame([(m, h, at(h), x) for m, h, x in rows], "meter_id string, reading_id bigint, ts timestamp, kwh_hourly double")
    want = score_batch(frame, sustained=1)
    scored = spark.read.parquet(tables.path("scored"))
    names = ["meter_id", "ts", "n", "anomaly_type", "consecutive_high", F.round("z_score", 7)]
    assert sorted(map(tuple, scored.select(*names).collect())) == sorted(map(tuple, want.select(*names).collect()))
    rejects = spark.read.parquet(tables.path("quarantine"))
    assert rejects.groupBy("reject_reason").count().orderBy("reject_reason").collect() == [("bad_timestamp", 2), ("negative_value", 1), ("no_meter", 4)]
    assert sorted(set(r.value for r in rejects.collect())) == sorted(v for _, v in BAD)
    found = AlertLog(spark, tables.path("alerts")).read()
    assert found.count() == want.where("is_anomaly").count() > 0
    states = spark.table("live_states")
    assert [tuple(r) for r in states.select("meter_id", "count").orderBy("meter_id").collect()] == [("M0", 72), ("M1", 72), ("M2", 72)]
    spark.sql("DROP TABLE live_states")


def test_state_upsert_may_be_repeated(spark, tmp_path):
    snapshot = Snapshot(spark, f"{tmp_path}/states", "upserted_states")
    for batch in range(6):
        rows = [("A", batch, 1.0, 0.1, 0, at(batch)), (f"M{batch}", 1, 2.0, 0.1, 0, at(batch))]
        updates = spark.createDataFrame(rows, STATE)
        upsert_states(snapshot, updates, batch)
        before = sorted(map(tuple, snapshot.read().collect()))
        upsert_states(snapshot, updates, batch)  # a repeated batch
        assert sorted(map(tuple, snapshot.read().collect())) == before and len(before) == batch + 2
    assert len(snapshot.generations()) == 3
    late = spark.createDataFrame([("A", 99, 9.0, 0.1, 0, at(0))], STATE)
    upsert_states(snapshot, late, 6)  # older than what is stored
    assert spark.table("upserted_states").where("meter_id = 'A'").first()["count"] == 5
    # A new session's view of the folder, and a generation that was never finished.
    (tmp_path / "states" / "generation=000000000099").mkdir()
    assert Snapshot(spark, f"{tmp_path}/states").read().count() == 7
    spark.sql("DROP TABLE upserted_states")


def test_status_survives_and_may_be_repeated(spark, tmp_path):
    alerts = spark.createDataFrame([(m, at(h), 4.0, "sudden_spike", "open", at(h)) for m, h in (("A", 1), ("A", 2), ("B", 1))], ALERT)
    log = StatusLog(spark, f"{tmp_path}/status")
    assert log.applied(alerts).where("status = 'open'").count() == 3
    requests = spark.createDataFrame([("A", at(1), at(5)), ("X", at(1), at(5))], "meter_id string, ts timestamp, resolved_at timestamp")
    for _ in range(2):
        log.resolve(alerts, requests, "r1")
    again = StatusLog(spark, f"{tmp_path}/status")  # after a restart
    assert again.read().count() == 1
    done = again.applied(alerts).where("status = 'resolved'").collect()
    assert [(r.meter_id, r.ts, r.resolved_at) for r in done] == [("A", at(1), at(5))]
    assert again.applied(alerts, F.lit(at(4))).where("status = 'open'").count() == 3
    log.resolve(alerts, requests.withColumn("ts", F.lit(at(2))), "r2")
    assert again.applied(alerts).where("status = 'open'").select("meter_id").first()[0] == "B"


def files(path):
    return len(list(path.rglob("part-*.parquet")))


def test_retention_bounds_files_and_keeps_open_readers(spark, tmp_path):
    log = AlertLog(spark, f"{tmp_path}/alerts")
    everything = []
    for batch in range(20):
        # Days 0 to 4 again and again: every batch writes a new version of each alert.
        rows = [(f"M{m}", at(24 * d + m), 4.0, "sudden_spike", "open", at(500 + batch)) for d in range(5) for m in range(2)]
        everything += rows
        log.append(spark.createDataFrame(rows, ALERT), batch)
        log.append(spark.createDataFrame(rows, ALERT), batch)  # repeated
    assert log.read().count() == 200 and files(tmp_path / "alerts") >= 100
    now = at(24 * 3 + 12)
    reader = log.read()
    log.retire(now, upto=18, days=2)
    assert reader.where(F.col("ts") >= at(48)).count() == 120  # opened before, still whole for the days kept
    want = alert_ops.compact(spark.createDataFrame([r for r in everything if r[5] <= at(518)], ALERT), alert_ops.ALERT_KEY, "created_at", "ts", 2, 3, F.lit(now))
    got = log.read().where(F.col("created_at") <= at(518))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert log.read().count() == want.count() + log.read().where(F.col("created_at") > at(518)).count()
    log.retire(now, upto=19, days=2)
    log.retire(now, upto=19, days=2)  # removes what the run before has merged
    assert files(tmp_path / "alerts") <= 8
    days = log.parts()
    assert all(len(p) == 1 for p in days.values()) and set(days) >= {"day=2024-01-03", "day=2024-01-05"}
    # A day in one part without expired rows is not rewritten.
    before = sorted(p.name for p in (tmp_path / "alerts" / "day=2024-01-05").rglob("part-*.parquet"))
    log.retire(now, upto=19, days=2)
    assert sorted(p.name for p in (tmp_path / "alerts" / "day=2024-01-05").rglob("part-*.parquet")) == before


def test_one_failed_query_ends_the_job(spark, tmp_path):
    log = live.ProgressLog()
    spark.streams.addListener(log)
    try:
        rate = spark.readStream.format("rate").option("rowsPerSecond", 20).load()
        good = rate.writeStream.queryName("good").format("noop").trigger(processingTime="200 milliseconds").start()

        def fail(batch, batch_id):
            if batch_id >= 2:
                raise RuntimeError("sink is gone")

        bad = rate.writeStream.queryName("bad").foreachBatch(fail).trigger(processingTime="200 milliseconds").start()
        with pytest.raises(Exception, match="sink is gone"):
            live.run_until_any_ends([good, bad], log, f"{tmp_path}/progress", poll_s=0.5, most_s=60)
        assert not good.isActive and not bad.isActive
    finally:
        spark.streams.removeListener(log)
    stored = spark.read.parquet(f"{tmp_path}/progress")
    assert {"good", "bad"} >= {r.name for r in stored.collect()} and stored.where("rows > 0").count() > 0
