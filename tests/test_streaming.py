import datetime as dt
import random
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kilowatch.operators.rollup import meter_stats
from kilowatch.operators.scoring import score_batch
from kilowatch.sources.replay import write_days
from kilowatch.streaming import decode, jobs, scorer
from kilowatch.streaming.scorer import score_stream
from tests.serial import serial_scores

EVENT = (
    "meter_id string, reading_id bigint, ts timestamp, kwh_hourly double, tariff_type string, "
    "acorn_group string, reading_date string, injected_anomaly string"
)


def events(spark, rows):
    """rows: (meter, hour number, kwh)"""
    start = dt.datetime(2024, 1, 1)
    times = {i: start + dt.timedelta(hours=i) for _, i, _ in rows}
    data = [
        (m, i, times[i], float(x), "Std", "A", str(times[i].date()), "none") for m, i, x in rows
    ]
    return spark.createDataFrame(data, EVENT)


def series(meters=3, hours=72, seed=7):
    rng = random.Random(seed)
    return [(f"M{m}", i, round(rng.expovariate(2.0), 4)) for m in range(meters) for i in range(hours)]


def run(spark, source, work, files=1, sinks=None, **options):
    jobs.use_rocksdb(spark)
    stream = jobs.stream_source(spark, "files", source, schema=EVENT, files_per_trigger=files)
    sinks = sinks or jobs.Sinks(scored=f"{work}/scored")
    query = jobs.start(score_stream(stream, **options), sinks, f"{work}/checkpoint", bounded=True)
    query.awaitTermination()
    return jobs.read_batches(spark, sinks.scored)


def labels(df):
    rows = df.select("meter_id", "reading_id", "n", "anomaly_type", "consecutive_high",
                     F.round("z_score", 8), F.round("severity", 8)).collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("files", [1, 2])
def test_stream_equals_batch_for_any_micro_batches(spark, tmp_path, files):
    df = events(spark, series())
    assert write_days(df.repartition(1), f"{tmp_path}/in") == 3
    out = run(spark, f"{tmp_path}/in", tmp_path, files=files, sustained=1)
    assert labels(out) == labels(score_batch(df, sustained=1))
    assert out.select("batch_id").distinct().count() == (3 if files == 1 else 2)


def test_any_layout_of_files_and_batches(spark, tmp_path):
    df = events(spark, series(meters=4, hours=120))
    df.orderBy(F.rand(3)).repartition(8).write.parquet(f"{tmp_path}/shuffled")
    out = jobs.score_table_as_stream(
        spark, f"{tmp_path}/shuffled", lambda d: d, files=7, files_per_trigger=1, sustained=1
    )
    assert out.select("batch_id").distinct().count() >= 5
    assert labels(out) == labels(score_batch(df, sustained=1))


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    rows = series()
    df = events(spark, rows)
    write_days(df.repartition(1), f"{tmp_path}/in", date_to="2024-01-02")
    assert run(spark, f"{tmp_path}/in", tmp_path).count() == 144
    write_days(df.repartition(1), f"{tmp_path}/in", date_from="2024-01-03")
    assert labels(run(spark, f"{tmp_path}/in", tmp_path)) == labels(score_batch(df))


def test_duplicate_events_are_dropped(spark, tmp_path):
    df = events(spark, series(hours=24))
    write_days(df.repartition(1), f"{tmp_path}/in")
    write_days(df.repartition(1), f"{tmp_path}/in")
    out = run(spark, f"{tmp_path}/in", tmp_path, late="2 days")
    assert labels(out) == labels(score_batch(df))


def test_idle_state_is_removed(spark, tmp_path):
    first = [("M1", i, 1.0 + i % 3) for i in range(5)]
    later = [("M2", i, 1.0) for i in range(24, 27)]
    again = [("M1", i, 1.0) for i in range(48, 50)]
    # Zero idle time: any later batch finds the state of a silent meter expired.
    for name, rows in (("a", first), ("b", later), ("c", again)):
        events(spark, rows).repartition(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = run(spark, f"{tmp_path}/in", tmp_path, idle_days=1e-7)
    seen = {(r.meter_id, r.reading_id): r.n for r in out.collect()}
    assert len(seen) == 10
    assert (seen["M1", 4], seen["M1", 48]) == (5, 1)


def test_warm_start_from_stored_statistics(spark, tmp_path):
    past = [("M1", i, 0.4 + 0.1 * (i % 3)) for i in range(30)]
    stats = meter_stats(events(spark, past).withColumnRenamed("kwh_hourly", "kwh"))
    now = [("M1", 30, 9.0), ("M2", 30, 9.0)]
    events(spark, now).repartition(1).write.parquet(f"{tmp_path}/in")
    out = {r.meter_id: r for r in run(spark, f"{tmp_path}/in", tmp_path, stats=stats).collect()}
    want = serial_scores(past + now)["M1", 30]
    assert (out["M1"].n, out["M1"].anomaly_type) == (31, "sudden_spike")
    assert out["M1"].z_score == pytest.approx(want[3], abs=1e-9)
    assert (out["M2"].n, out["M2"].anomaly_type) == (1, "normal")


def test_fan_out_feeds_every_sink_and_repeats_cleanly(spark, tmp_path):
    df = events(spark, series())
    scored = score_batch(df)
    sinks = jobs.Sinks(*[f"{tmp_path}/{n}" for n in ("scored", "alerts", "states", "messages")], console=True)
    write = jobs.fan_out(sinks)
    write(scored, 0)
    write(scored, 0)  # a repeated batch replaces its own output
    anomalies = scored.where("is_anomaly").count()
    assert anomalies > 0
    assert spark.read.parquet(sinks.scored).count() == 216
    assert spark.read.parquet(sinks.alerts).count() == anomalies
    assert spark.read.parquet(sinks.states).count() == 3
    message = spark.read.json(sinks.messages).first()
    assert message.key in ("M0", "M1", "M2") and '"anomaly_type"' in message.value
    write(scored.limit(5), 1)
    assert spark.read.parquet(sinks.scored).count() == 221


def test_decode_keeps_rejects(spark):
    good = '{"meter_id":"M1","ts":"2024-01-01T05:00:00","kwh_hourly":0.5,"reading_date":"2024-01-01"}'
    bad = [
        good.replace('"M1"', "null"), good.replace("0.5", "null"), good.replace("0.5", "-1"),
        good.replace("T05", " 05"), "not json", good.replace("0.5", "NaN"), good.replace("0.5", '"NaN"'), good.replace("0.5", '"Infinity"'),
    ]
    messages = spark.createDataFrame([("k", v) for v in [good, *bad]], "key string, value string")
    valid, rejected = decode.decode_events(messages)
    row = valid.first()
    assert valid.count() == 1 and (row.meter_id, str(row.ts), row.kwh_hourly) == ("M1", "2024-01-01 05:00:00", 0.5)
    why = sorted(r.reject_reason for r in rejected.collect())
    assert why == ["bad_timestamp", "negative_value", "no_meter", "no_meter", "no_value", "not_finite", "not_finite", "not_finite"]


def test_messages_are_keyed_and_decode_back(spark):
    records = decode.event_records(
        spark.createDataFrame([("M1", "2024-01-01", "5", "Std", "A", "0.5", "0.4", "9", "1", "0.5")],
                              ", ".join(f"{n} string" for n in (
                                  "meter_id", "reading_date", "hour", "tariff_type", "acorn_group",
                                  "kwh_hourly", "kwh_max", "temp_high_c", "temp_low_c", "humidity")))
    )
    messages = decode.event_messages(records)
    assert messages.first().key == "M1"
    valid, _ = decode.decode_events(messages)
    assert valid.first().kwh_max == 0.4


def test_sources(spark):
    assert jobs.stream_source(spark, "rate", "5").isStreaming
    with pytest.raises(ValueError):
        jobs.stream_source(spark, "pigeon", "x")


def test_cost_of_a_meter_does_not_come_on_top_of_its_rows(spark, tmp_path):
    """Python is called for a group of meters: a bound on the groups, whatever the number of meters."""
    meters = 4 * scorer.GROUPS
    rows = [(f"M{m}", i, 1.0 + (m + i) % 5) for m in range(meters) for i in range(2)]
    stream = events(spark, rows).repartition(1)
    stream.write.parquet(f"{tmp_path}/in")
    assert labels(run(spark, f"{tmp_path}/in", tmp_path)) == labels(score_batch(stream))
    states = spark.read.format("statestore").option("stateVarName", "meters").load(f"{tmp_path}/checkpoint")
    assert states.count() == meters
    assert states.select("key").distinct().count() <= scorer.GROUPS


@pytest.mark.parametrize("step", [7, 45])  # more readings than statistics in a group, and fewer
def test_meters_of_one_group_keep_their_own_statistics(spark, tmp_path, monkeypatch, step):
    monkeypatch.setattr(scorer, "GROUPS", 2)
    past = [(f"M{m}", i, m + 0.1 * (i % 3)) for m in range(40) for i in range(30)]
    stats = meter_stats(events(spark, past).withColumnRenamed("kwh_hourly", "kwh"))
    now = [(f"M{m}", 30 + i, m + 0.1 * i) for m in range(0, 50, step) for i in range(5 * (m + 1) // step)]
    events(spark, now + [(None, 30, 1.0), (None, 31, 2.0)]).repartition(1).write.parquet(f"{tmp_path}/in")
    out = {(r.meter_id, r.reading_id): r for r in run(spark, f"{tmp_path}/in", tmp_path, stats=stats).collect()}
    assert len(out) == len(now) + 2
    assert [out[None, i].n for i in (30, 31)] == [1, 2]
    known = serial_scores(past + now)
    for meter, i, _ in now:
        got, want = out[meter, i], known[meter, i]
        assert (got.n, got.anomaly_type, got.consecutive_high) == (want[0], want[4], want[6])
        assert (got.rolling_mean, got.z_score) == pytest.approx((want[1], want[3]), abs=1e-6)


class CountedMap:
    """A map state in memory that counts its calls."""

    def __init__(self, known):
        self.known, self.calls = dict(known), {"getValue": 0, "iterator": 0}

    def getValue(self, key):
        self.calls["getValue"] += 1
        return self.known.get(key)

    def iterator(self):
        self.calls["iterator"] += 1
        return iter(list(self.known.items()))

    def updateValue(self, key, value):
        self.known[key] = value


@pytest.mark.parametrize("meters, others, gets, scans", [
    (400, 0, 0, 1), (400, 2000, 0, 1),  # all at once
    (400, 4000, 400, 1),  # the scan ends before it comes to any of them
    (20, 4000, 20, 0),
])
def test_states_of_many_meters_are_read_at_once(meters, others, gets, scans):
    state = scorer.UNKNOWN[:1] + (1.0, 1.0, 0.0, 0, [], 0)
    known = {(f"X{m}",): state for m in range(others)} | {(f"M{m}",): (30, 30.0 * m, float(m), 3.0, 2, [0.5], 7) for m in range(0, meters, 2)}
    p = dict(threshold=3.0, sustained=5, warmup=24, two_sided=False, high=1.5, flatline=0.01, min_stddev=0.01)
    rows = pd.DataFrame({
        "meter_id": [f"M{m}" for m in range(meters)] * 2, "reading_id": range(2 * meters),
        "ts": [dt.datetime(2024, 1, 1, h) for h in (0, 1) for _ in range(meters)],
        "kwh_hourly": [m + 0.5 for m in range(meters)] * 2, **dict.fromkeys(scorer.CARRIED, "A"),
    })
    operator = scorer.MeterScorer(p, 1000)
    operator.meters = CountedMap(known)
    (out,) = operator.handleInputRows((0,), iter([rows]), None)
    assert operator.meters.calls == {"getValue": gets, "iterator": scans}
    assert out.groupby("meter_id")["n"].max().to_dict() == {f"M{m}": 2 if m % 2 else 32 for m in range(meters)}
    count, total, _, _, _, history, last = operator.meters.known["M2",]
    assert (count, total, len(history), last) == (32, 65.0, 3, int(dt.datetime(2024, 1, 1, 1, tzinfo=dt.UTC).timestamp() * 1e6))
    assert len(operator.meters.known) == meters + others


def test_states_read_at_once_continue_and_expire_like_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scorer, "BULK", 2)
    monkeypatch.setattr(scorer, "GROUPS", 2)
    df = events(spark, series(meters=9))
    write_days(df.repartition(1), f"{tmp_path}/in")
    assert labels(run(spark, f"{tmp_path}/in", f"{tmp_path}/a")) == labels(score_batch(df))
    out = run(spark, f"{tmp_path}/in", f"{tmp_path}/b", idle_days=1e-7)
    assert out.agg(F.max("n")).first()[0] == 24


def test_rows_reach_the_stateful_operator_packed():
    """A few messages a group, whatever the number of rows; nothing is lost or changed on the way."""
    n = 5000
    rows = pa.table({
        "meter_id": [None if i % 50 == 7 else f"M{i % 90}" for i in range(n)],
        "reading_id": pa.array([None if i % 11 == 3 else i for i in range(n)], pa.int64()),
        "ts": pa.array([None if i % 13 == 5 else 1_700_000_000_000_000 + 7 * i for i in range(n)], pa.timestamp("us", "America/New_York")),
        "kwh_hourly": [None if i % 17 == 2 else i / 7 for i in range(n)],
        "_group": pa.array([i % 9 for i in range(n)], pa.int32()),
    })
    batches = rows.to_batches(max_chunksize=700)
    batches.append(batches[0].slice(0, 0))
    packed = list(scorer.pack(iter(batches)))
    assert sum(b.num_rows for b in packed) == 9
    assert list(scorer.pack(iter([]))) == [] and list(scorer.pack(iter([batches[-1]]))) == []
    for group, message in pa.Table.from_batches(packed).to_pandas().groupby("_group"):
        want = rows.filter(pa.compute.equal(rows["_group"], group)).drop_columns("_group").to_pandas()
        want["ts"] = want["ts"].dt.tz_localize(None)
        pd.testing.assert_frame_equal(scorer.unpack(message), want)


def test_rows_are_packed_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(scorer, "PACKED_ROWS", 100)
    rows = pa.record_batch({"value": ["x" * 40] * 50, "ts": pa.array([0] * 50, pa.timestamp("us", "UTC")), "_group": pa.array([1] * 50, pa.int32())})
    pieces = list(scorer.pack(iter([rows] * 5)))
    assert [len(scorer.unpack(b.to_pandas())) for b in pieces] == [100, 100, 50]
    monkeypatch.setattr(scorer, "PACKED_BYTES", 1)
    assert len(list(scorer.pack(iter([rows] * 5)))) == 5


def test_the_operator_of_a_stream_reads_packed_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scorer, "PACKED_ROWS", 100)  # several messages a group
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = events(spark, series(meters=40, hours=60))
        df = df.withColumn("kwh_hourly", F.when(F.expr("reading_id % 9 <> 4"), F.col("kwh_hourly")))
        df.repartition(2).write.parquet(f"{tmp_path}/in")
        out = run(spark, f"{tmp_path}/in", tmp_path, files=2)
        assert labels(out) == labels(score_batch(df))
        assert out.select("meter_id", "reading_id", "ts").exceptAll(df.select("meter_id", "reading_id", "ts")).count() == 0
        states = spark.read.format("statestore").option("stateVarName", "meters").load(f"{tmp_path}/checkpoint")
        kept = states.selectExpr("user_map_key.meter_id", "user_map_value.value.zscores").collect()
        last = out.where("reading_id >= 12").groupBy("meter_id").agg(F.sort_array(F.collect_list(F.struct("reading_id", F.round("z_score", 3)))))
        want = {m: [z for _, z in zs] for m, zs in last.collect()}
        # The score of a missing reading is kept as NaN and comes out as null.
        assert {m: [None if np.isnan(z) else z for z in zs] for m, zs in kept} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_meters_of_equal_length_are_folded_at_once(monkeypatch):
    calls, folded = [], scorer.running_moments
    monkeypatch.setattr(scorer, "running_moments", lambda x, *before: calls.append(x.shape) or folded(x, *before))
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 6, 300)
    starts, x = np.cumsum([0, *lengths[:-1]]), rng.exponential(2.0, lengths.sum())
    x[rng.random(len(x)) < 0.2] = np.nan
    x[starts[3]:starts[4]] = np.nan
    states = [(0, 0.0, 0.0, 0) if i % 3 else (20 + i, 2.5, 90.0, 1) for i in range(300)]
    got = scorer.segment_moments(x, starts, states)
    assert len(calls) == 5
    for a, b, (n, mean, m2, _) in zip(starts, [*starts[1:], len(x)], states):
        for i in range(a, b):
            if not np.isnan(x[i]):
                n, before = n + 1, mean
                mean += (x[i] - mean) / n
                m2 += (x[i] - before) * (x[i] - mean)
            assert got[0][i] == n
            assert (got[1][i], got[2][i]) == pytest.approx((mean, m2), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("sinks, kept", [(["scored"], 0), (["scored", "alerts"], 1)])
def test_only_a_batch_of_several_sinks_is_kept(spark, tmp_path, monkeypatch, sinks, kept):
    scored, calls = score_batch(events(spark, series(meters=1))), []
    persist = type(scored).persist
    monkeypatch.setattr(type(scored), "persist", lambda df, *level: calls.append(df) or persist(df, *level))
    jobs.fan_out(jobs.Sinks(**{name: f"{tmp_path}/{name}" for name in sinks}))(scored, 0)
    assert len(calls) == kept
    assert spark.read.parquet(f"{tmp_path}/scored").count() == 72


def test_history_is_written_as_one_block():
    state = CountedMap({})
    operator = scorer.MeterScorer(dict(threshold=3.0, sustained=5, warmup=24, two_sided=False, high=1.5, flatline=0.01, min_stddev=0.01), 1000)
    operator.meters = state
    rows = pd.DataFrame({
        "meter_id": "M1", "reading_id": range(60), "ts": pd.date_range("2024-01-01", periods=60, freq="h"),
        "kwh_hourly": [0.5 + i % 3 for i in range(60)], **dict.fromkeys(scorer.CARRIED, "A"),
    })
    (out,) = operator.handleInputRows((0,), iter([rows]), None)
    history = state.known["M1",][5]
    assert isinstance(history, array) and history.tolist() == out["z_score"].round(3).tolist()[-48:]
