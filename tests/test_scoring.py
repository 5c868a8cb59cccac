import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from kilowatch.operators import scoring, slices
from kilowatch.operators.scoring import CountMap, end_state, next_count, score_batch, score_z
from tests.serial import serial_scores

SCHEMA = "meter_id string, reading_id bigint, ts timestamp, kwh_hourly double"


DAY = 86_400


def frame(spark, rows, step=1):
    """rows: (meter, order, kwh); the time is the order times ``step`` seconds."""
    pdf = pd.DataFrame(
        [(m, i, pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i * step), float(x)) for m, i, x in rows],
        columns=["meter_id", "reading_id", "ts", "kwh_hourly"],
    )
    return spark.createDataFrame(pdf, SCHEMA)


def check(spark, rows, step=1, **options):
    sustained = options.get("sustained", 5)
    want = serial_scores(rows, sustained=sustained)
    got = score_batch(frame(spark, rows, step), **options).collect()
    assert len(got) == len(rows)
    for g in got:
        n, mean, sd, z, label, severity, count = want[g.meter_id, g.reading_id]
        assert (g.n, g.anomaly_type, g.consecutive_high) == (n, label, count)
        assert g.z_score == pytest.approx(z, abs=1e-8)
        assert g.rolling_mean == pytest.approx(mean, abs=1e-9)
        assert g.rolling_stddev == pytest.approx(sd, abs=1e-8)
        assert g.severity == pytest.approx(severity, abs=1e-8)
        assert g.is_anomaly == (label != "normal")
    return want


def one(values, meter="M1"):
    return [(meter, i, x) for i, x in enumerate(values)]


def labels(want):
    return [w[4] for _, w in sorted(want.items())]


def test_constant_series_is_normal(spark):
    assert set(labels(check(spark, one([0.3] * 20)))) == {"normal"}


@pytest.mark.parametrize("position,label", [(9, "normal"), (10, "normal"), (12, "sudden_spike")])
def test_warm_up(spark, position, label):
    values = [0.3 + 0.01 * (i % 3) for i in range(14)]
    values[position - 1] = 50.0
    assert labels(check(spark, one(values)))[position - 1] == label


def test_flatline_edge(spark):
    want = labels(check(spark, one([0.3 + 0.01 * (i % 3) for i in range(12)] + [0.0049, 0.005])))
    assert want[-2:] == ["flatline", "normal"]


def climbing(n):
    """Every reading after warm-up is high but no spike: z stays near 2.24."""
    return [0.01 + 90 * (i / n) ** 2 for i in range(1, n + 1)]


def test_sustained_elevation(spark):
    want = check(spark, one(climbing(40)))
    assert labels(want).count("sustained_elevation") >= 20
    assert {w[6] for w in want.values()} == set(range(6))


@pytest.fixture(params=[2, 5])
def short_slices(request, monkeypatch):
    """Slices of 4 or 32 rows, so that small series lie in many."""
    monkeypatch.setattr(slices, "SLICE_BITS", request.param)
    return 2**request.param


def test_long_stretch_across_slices(spark, short_slices):
    rng = random.Random(5)
    values = climbing(120) + [rng.choice([0.1, 40.0, 99.0, 0.001, 5.0]) for _ in range(120)] + climbing(60)
    rows = one(values) + one([rng.random() for _ in range(25)], "M2")
    check(spark, rows)
    check(spark, rows, sustained=1)


def test_one_meter_with_most_rows_is_split(spark, short_slices):
    rng = random.Random(1)
    rows = one([rng.expovariate(2.0) for _ in range(3000)], "BIG")
    rows += [(f"M{m}", i, rng.expovariate(2.0)) for m in range(30) for i in range(40)]
    check(spark, rows, DAY // 10, sustained=2)


def test_dense_meter_spreads(spark):
    """400 000 readings of one meter in 23 days: no task counts more than a slice of it at once."""
    rows = spark.range(400_000).selectExpr(
        "'DENSE' AS meter_id", "id AS reading_id", "timestamp_seconds(1704067200 + id * 5) AS ts", "double(1 + id % 7) AS kwh_hourly"
    )
    cut = slices.in_order(rows, "ts", "reading_id")
    sizes = [r["count"] for r in cut.groupBy("meter_id", "_slice").count().collect()]
    assert max(sizes) <= 2**slices.SLICE_BITS and len(sizes) >= 24
    # Dealt by meter and slice, as the windows are, eight tasks get like shares.
    tasks = cut.repartition(8, "meter_id", "_slice").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 0.35 * 400_000
    order = [r["reading_id"] for r in cut.orderBy("_at").select("reading_id").collect()]
    assert order == list(range(400_000))
    got = score_batch(rows).orderBy(F.desc("ts")).first()
    assert (got.n, got.rolling_mean) == (400_000, pytest.approx(sum(1 + i % 7 for i in range(400_000)) / 400_000))


def test_dead_meter(spark, short_slices):
    """A third of all rows in a meter that reports 0 after three spikes: the counter rests for all slices."""
    rng = random.Random(2)
    values = [1.0 + 0.01 * rng.random() for _ in range(40)] + [50.0] * 3 + [0.0] * 700
    rows = one(values, "DEAD") + [(f"M{m}", i, rng.random()) for m in range(20) for i in range(70)]
    want = check(spark, rows, 3600)
    assert want["DEAD", len(values) - 1][6] > 0


def steps(rng, n):
    """Kinds with long runs of lows and bursts of the others."""
    out = []
    while len(out) < n:
        out += rng.choice([[3] * rng.randint(1, 9), [1] * rng.randint(1, 4), [2] * rng.randint(1, 8), [0], [rng.randint(0, 3)]])
    return out[:n]


def test_count_map_equals_the_counter():
    rng = random.Random(8)
    for _ in range(400):
        sustained, kinds = rng.randint(1, 6), steps(rng, rng.randint(0, 60))
        fold = CountMap(sustained)
        for kind, run in [(k, 1) for k in kinds]:
            {0: lambda: None, 1: fold.spike, 2: fold.high, 3: lambda: fold.lows(run)}[kind]()
        assert len(fold.head) <= sustained
        for entry in [*range(20), 10**6]:
            count = entry
            for kind in kinds:
                count = next_count(kind, count, sustained)
            assert fold.at(entry) == count


def test_batches_cut_anywhere():
    """The walk over Arrow batches gives the same wherever batches end."""
    rng = random.Random(9)
    segments = [("A", s, steps(rng, rng.randint(1, 30)), rng.randint(0, 9)) for s in range(12)]
    rows = [(m, s, k, i + 1, e) for m, s, kinds, e in segments for i, k in enumerate(kinds)]
    names = ["meter_id", "_slice", "_kind", "_row", "_entry"]
    counted = pa.schema([("_kind", pa.int64()), ("_before", pa.int64()), ("consecutive_high", pa.int64())])
    maps = pa.schema([("meter_id", pa.string()), ("_slice", pa.int64()), ("_low", pa.int64()), ("_head", pa.list_(pa.int64())), ("_tail", pa.int64())])
    whole = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    want = []
    for _, _, kinds, count in segments:
        for k in kinds:
            want.append((count, next_count(k, count, 3)))
            count = want[-1][1]
    ends = [next(iter(reversed(want[: i + 1]))) for i in np.cumsum([len(k) for _, _, k, _ in segments]) - 1]
    for _ in range(40):
        cuts = sorted(rng.sample(range(len(rows)), 5))
        batches = [whole.slice(lo, hi - lo) for lo, hi in zip([0, *cuts], [*cuts, len(rows)])]
        out = pa.Table.from_batches(scoring._count_along(iter(batches), 3, counted)).to_pydict()
        assert list(zip(out["_before"], out["consecutive_high"])) == want
        folded = pa.Table.from_batches(scoring._count_maps(iter(batches), 3, maps)).to_pylist()
        assert [scoring.count_at(f["_low"], f["_head"], f["_tail"], e) for f, (_, _, _, e) in zip(folded, segments)] == [a for _, a in ends]


def test_scoring_goes_on_from_a_state(spark, short_slices):
    """Day after day, each scored without reading the days before, equals one run over all."""
    rng = random.Random(6)
    rows = [(m, i, rng.expovariate(2.0)) for m in ("A", "B", "C") for i in range(90)] + one([0.2, 9.0] * 20, "D")
    rows += [("NEW", i, rng.random()) for i in range(60, 90)]
    want = {(g.meter_id, g.reading_id): g for g in score_batch(frame(spark, rows), sustained=2).collect()}
    state, got = None, []
    for lo in range(0, 90, 30):
        day = [r for r in rows if lo <= r[1] < lo + 30 and not (r[0] == "B" and lo == 30)]
        day += [r for r in rows if r[0] == "B" and 30 <= r[1] < 60] if lo == 60 else []  # B is late by a day
        scored = score_batch(frame(spark, day), sustained=2, state=state).cache()
        got += scored.collect()
        state = spark.createDataFrame(end_state(scored, before=state).collect())
    assert Counter((g.meter_id, g.reading_id) for g in got) == Counter(dict.fromkeys(want, 1))
    for g in got:
        w = want[g.meter_id, g.reading_id]
        assert (g.n, g.anomaly_type, g.consecutive_high) == (w.n, w.anomaly_type, w.consecutive_high)
        assert (g.rolling_mean, g.z_score) == (pytest.approx(w.rolling_mean, abs=1e-9), pytest.approx(w.z_score, abs=1e-7))
    assert state.count() == 5 and state.where("meter_id = 'D'").first().n == 40


@pytest.mark.parametrize("window_days", [None, 7])
def test_no_reading_is_lost(spark, window_days, short_slices):
    rng = random.Random(7)
    df = frame(spark, [(rng.choice("AB"), i, rng.random()) for i in range(300)], 3600).selectExpr(
        "if(reading_id % 5 = 0, null, meter_id) meter_id", "reading_id", "if(reading_id % 7 = 0, null, ts) ts",
        "if(reading_id % 11 = 0, null, kwh_hourly) kwh_hourly", "'x' AS _upto", "1 AS n_other",
    )
    got = score_batch(df, window_days=window_days).collect()
    assert sorted(g.reading_id for g in got) == list(range(300))
    if window_days:
        assert all((g.n, g.anomaly_type) == (0, "normal") for g in got if g.ts is None)
    else:
        last = max((g for g in got if g.meter_id is None), key=lambda g: (g.ts is not None, g.ts, g.reading_id))
        assert last.n == sum(1 for i in range(0, 300, 5) if i % 11)
    assert score_batch(df.limit(0), window_days=window_days).collect() == []


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(0, 100), min_size=1, max_size=60), min_size=1, max_size=5), st.integers(1, 6))
def test_any_series(spark, series, sustained):
    # Values on a coarse grid: z-scores of near-constant series would only compare rounding errors.
    rows = [(f"M{m}", i, round(x, 1)) for m, xs in enumerate(series) for i, x in enumerate(xs)]
    check(spark, rows, 2 * DAY, sustained=sustained)


def windowed(rows, meter, at, days=7):
    return [x for m, t, x in rows if m == meter and at - days * DAY <= t <= at]


def test_rolling_window_of_a_dense_meter(spark):
    """Linear in the readings: 200 000 of one meter in eight days, of which each sees up to 175 000."""
    rows = spark.range(200_000).selectExpr(
        "'D' AS meter_id", "id AS reading_id", "timestamp_millis(1704067200000 + id * 3456) AS ts", "double(id % 100) AS kwh_hourly"
    )
    got = score_z(rows, window_days=7).where("reading_id in (199999, 180000, 100000)").collect()
    for g in got:
        seen = range(max(0, g.reading_id - 175_000), g.reading_id + 1)
        values = np.array(seen) % 100
        assert (g.n, g.rolling_mean, g.rolling_stddev) == (len(values), pytest.approx(values.mean()), pytest.approx(values.std()))


@pytest.mark.parametrize("step,offset", [(5, 0.0), (1, 3e5), (60, 0.0)])
def test_rolling_window(spark, step, offset):
    rng = random.Random(3)
    rows = [(m, i * 3600 * step, offset + rng.random() * 5) for m in ("A", "B") for i in range(120)]
    rows[0] = ("A", 0, 5e7)
    rows += [(m, t, x + 1) for m, t, x in rows[10:60:7]]  # two readings at one instant
    got = score_z(frame(spark, rows), window_days=7).collect()
    assert len(got) == len(rows)
    for g in got:
        seen = windowed(rows, g.meter_id, g.reading_id)
        mean = sum(seen) / len(seen)
        sd = (sum((x - mean) ** 2 for x in seen) / len(seen)) ** 0.5
        z = (g.kwh_hourly - mean) / sd if sd > 0.001 and len(seen) >= 10 else 0.0
        assert g.n == len(seen)
        assert g.z_score == pytest.approx(z, abs=1e-6)


def test_rolling_window_forgets_a_nan(spark):
    rows = [("A", i * 3600, float("nan") if i == 3 else 1.0 + i % 5) for i in range(400)]
    df = frame(spark, rows).selectExpr("meter_id", "reading_id", "ts", "if(reading_id = 10800, double('NaN'), kwh_hourly) kwh_hourly")
    got = {g.reading_id: g.rolling_mean for g in score_z(df, window_days=7).collect()}
    assert got[10 * 3600] != got[10 * 3600] and got[300 * 3600] == pytest.approx(sum(windowed(rows, "A", 300 * 3600)) / 169)


def test_rolling_window_labels_follow_the_counter(spark):
    rng = random.Random(4)
    rows = [("A", i * 3600, rng.expovariate(1.0)) for i in range(1500)]
    got = score_batch(frame(spark, rows), window_days=7, sustained=1).orderBy("reading_id").collect()
    count = 0
    for g in got:
        kind = 0 if g.n < 10 or g.kwh_hourly < 0.005 else 1 if g.z_score > 3 else 2 if g.z_score > 2 else 3
        elevated = kind == 2 and count >= 1
        count = next_count(kind, count, 1)
        assert g.consecutive_high == count and (g.anomaly_type == "sustained_elevation") == elevated


def test_null_readings_do_not_count(spark):
    df = frame(spark, one([1.0, 2.0, 3.0, 4.0])).selectExpr("meter_id", "reading_id", "ts", "if(reading_id = 1, null, kwh_hourly) kwh_hourly")
    got = score_z(df).orderBy("reading_id").collect()
    assert [g.n for g in got] == [1, 1, 2, 3] and got[3].rolling_mean == pytest.approx(8 / 3)


def test_two_sided(spark):
    values = [5.0 + 0.1 * (i % 3) for i in range(30)] + [0.2]
    one_sided = score_batch(frame(spark, one(values))).where("reading_id = 30").first()
    both = score_batch(frame(spark, one(values)), two_sided=True).where("reading_id = 30").first()
    assert (one_sided.anomaly_type, both.anomaly_type) == ("normal", "sudden_spike")
