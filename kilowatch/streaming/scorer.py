"""The scorer as a keyed stateful stream operator.

The state of a meter is one typed value of constant size: the running moments, the counter and the last
48 z-scores. It lives in RocksDB and goes when the meter was silent for the idle time. Meters may start from
stored statistics, which are loaded once as initial state. Meters are dealt over a fixed number of groups,
and Python is called once per group and micro-batch, not once per meter: what a call costs besides its rows
does not grow with the fleet. States of many meters of a group are read in one go. Spark hands the rows of a
stateful operator to Python one by one, so each task first packs the rows of a group into Arrow messages, and the
operator gets a few messages a group. A micro-batch is bounded by the rate cap of its source, so the rows of one
group in one micro-batch are too. They are ordered by meter and time before they are scored; rows that arrive
in a later micro-batch with an older time are scored in arrival order.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kilowatch.operators.scoring import (
    ELEVATION, FLAT, FLATLINE, HIGH, K_HIGH, K_LOW, K_NONE, K_SPIKE, MAX_SPIKE_SEVERITY, MIN_STDDEV,
    NORMAL, SPIKE, SUSTAINED, THRESHOLD, WARMUP, walk,
)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HISTORY = 48
# Fixed value: groups that the meters are dealt over; a checkpoint holds its meters by group.
GROUPS = 1024
# From so many meters of a group on, their states are read in one go, along with so many times as many.
BULK, SCANNED = 256, 8
# Rows, and their bytes, that a task packs at a time.
PACKED_ROWS, PACKED_BYTES = 1 << 18, 1 << 26
UNKNOWN = (0, 0.0, 0.0, 0.0, 0, [], 0)
CARRIED = ["tariff_type", "acorn_group", "reading_date", "injected_anomaly"]
OUTPUT = (
    "meter_id string, reading_id bigint, ts timestamp, kwh_hourly double, rolling_mean double, "
    "rolling_stddev double, z_score double, anomaly_type string, severity double, "
    "is_anomaly boolean, tariff_type string, acorn_group string, reading_date string, "
    "injected_anomaly string, n bigint, consecutive_high bigint"
)
PASSED = ["key", "value", "reject_reason"]
PASSED_OUTPUT = "key string, value string, reject_reason string"
FIELDS = [field.split()[0] for field in OUTPUT.split(", ")]
STATE = (
    "count bigint, sum_kwh double, mean double, m2 double, consecutive_high bigint, "
    "zscores array<double>, last_ts_us bigint"
)


def running_moments(x: np.ndarray, n, mean, m2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and squared deviations after each value, on top of those so far; NaN does not count.
    Values of several meters come as rows, with the statistics so far as columns."""
    counted = ~np.isnan(x)
    any_counted = counted.any(axis=-1, keepdims=True)
    # Deviations from a mean near all values keep the sums well conditioned.
    near = np.where(counted, x, 0.0).sum(axis=-1, keepdims=True) / np.maximum(counted.sum(axis=-1, keepdims=True), 1)
    d = np.where(counted, x - near, 0.0)
    gap = np.where(np.asarray(n) > 0, mean - near, 0.0)
    ns = n + np.cumsum(counted, axis=-1)
    shift = np.divide(n * gap + np.cumsum(d, axis=-1), ns, out=np.zeros(x.shape), where=ns > 0)
    squares = m2 + n * gap * gap + np.cumsum(d * d, axis=-1) - ns * shift * shift
    means, squares = np.where(ns > 0, near + shift, mean), np.maximum(squares, 0.0)
    return ns, np.where(any_counted, means, mean), np.where(any_counted, squares, m2)


def segment_moments(x: np.ndarray, starts: np.ndarray, states: list[tuple]) -> list[np.ndarray]:
    """Running moments of each segment on top of its state; segments of equal length are done at once."""
    lengths = np.diff(starts, append=len(x))
    before = [np.array(column) for column in zip(*(state[:3] for state in states))]
    out = [np.empty(len(x), np.int64), np.empty(len(x)), np.empty(len(x))]
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        rows = starts[of, None] + np.arange(length)
        for column, values in zip(out, running_moments(x[rows], *(b[of, None] for b in before))):
            column[rows] = values
    return out


def score_segments(x: np.ndarray, starts: np.ndarray, states: list[tuple], p: dict) -> tuple[dict, list[tuple]]:
    """Readings in order, the segment of each meter from its start on top of its state (n, mean, m2,
    counter): columns of the result, and the new states."""
    ends = [*starts[1:], len(x)]
    ns, means, squares = segment_moments(x, starts, states)
    stddev = np.sqrt(np.divide(squares, ns, out=np.zeros(len(x)), where=ns > 0))
    warm, ready = ns >= p["warmup"], (stddev > p["min_stddev"]) & (ns >= p["warmup"])
    z = np.where(ready, np.divide(x - means, stddev, out=np.zeros(len(x)), where=stddev > 0), 0.0)
    reach = np.abs(z) if p["two_sided"] else z
    flat = warm & (x < p["flatline"])
    kinds = np.select([~warm | flat, reach > p["threshold"], z > p["high"]], [K_NONE, K_SPIKE, K_HIGH], K_LOW)
    firsts, entries = np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    firsts[starts], entries[starts] = True, [state[3] for state in states]
    before, after = walk(kinds, firsts, entries, 0, p["sustained"])
    lasting = (kinds == K_HIGH) & (before >= p["sustained"])
    spike = kinds == K_SPIKE
    columns = {
        "rolling_mean": means, "rolling_stddev": stddev, "z_score": z,
        "anomaly_type": np.select([flat, spike, lasting], [FLAT, SPIKE, ELEVATION], NORMAL),
        "severity": np.select(
            [flat, spike, lasting],
            [1.0, np.minimum(np.abs(z) / p["threshold"], MAX_SPIKE_SEVERITY), 2.0 + before / 10.0], 0.0,
        ),
        "n": ns, "consecutive_high": after,
    }
    return columns, [(int(ns[b - 1]), float(means[b - 1]), float(squares[b - 1]), int(after[b - 1])) for b in ends]


class MeterScorer(StatefulProcessor):
    """Scores the readings of a group of meters on top of their states; with ``passed`` rejects go through untouched."""

    def __init__(self, p: dict, idle_ms: int, passed: bool = False):
        self.p, self.idle_ms, self.passed = p, idle_ms, passed

    def init(self, handle: StatefulProcessorHandle) -> None:
        # An update starts the idle time anew; an expired value reads as none and is removed by the store.
        self.meters = handle.getMapState("meters", "meter_id string", STATE, ttlDurationMs=self.idle_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        known = zip(*(initialState[c] for c in ("meter_id", "total_readings", "global_mean", "global_stddev")))
        for meter, n, mean, stddev in known:
            n, mean = int(n), float(mean or 0.0)
            self.meters.updateValue((meter,), (n, mean * n, mean, float(stddev or 0.0) ** 2 * n, 0, [], 0))

    def known(self, meters: list[tuple]) -> list[tuple]:
        """States of these meters. Many are read by one scan of the group's map, which ends where it would read
        far more than is asked for; few, and what the scan left out, one by one."""
        if len(meters) < BULK:
            return [self.meters.getValue(m) or UNKNOWN for m in meters]
        entries, most = self.meters.iterator(), SCANNED * len(meters)
        found = dict(islice(entries, most))
        if len(found) < most:
            return [found.get(m, UNKNOWN) for m in meters]
        return [found.get(m) or self.meters.getValue(m) or UNKNOWN for m in meters]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        # Plain strings: text that came in several chunks does not fit Spark's rows.
        batch = batch.astype({c: object for c in ("meter_id", *CARRIED, *(PASSED if self.passed else ()))})
        if self.passed:
            bad = batch["reject_reason"].notna()
            if bad.any():
                yield batch[bad].assign(anomaly_type=None, is_anomaly=None).reindex(columns=[*FIELDS, *PASSED])
            batch = batch[~bad]
            if not len(batch):
                return
        # Readings without a meter are one meter.
        batch["_meter"] = pd.factorize(batch["meter_id"], use_na_sentinel=False)[0]
        batch = batch.sort_values(["_meter", "ts", "reading_id"], ignore_index=True)
        starts = np.flatnonzero(np.diff(batch["_meter"], prepend=-1))
        ends = [*starts[1:], len(batch)]
        meters = [(m if isinstance(m, str) else None,) for m in batch["meter_id"].iloc[starts]]
        known = self.known(meters)
        x = batch["kwh_hourly"].to_numpy(float)
        columns, states = score_segments(x, starts, [(n, mean, m2, c) for n, _, mean, m2, c, _, _ in known], self.p)
        z, sums = np.round(columns["z_score"], 3).tolist(), np.add.reduceat(np.nan_to_num(x, posinf=np.inf, neginf=-np.inf), starts)
        newest = batch["ts"].iloc[np.array(ends) - 1].astype("datetime64[us]").astype("int64")
        for m, a, b, before, state, kwh, at in zip(meters, starts, ends, known, states, sums.tolist(), newest.tolist()):
            _, total, _, _, _, history, last = before
            n, mean, m2, count = state
            # An array goes to the store as one block of numbers, a list number by number.
            history = array("d", [*history, *z[max(a, b - HISTORY):b]][-HISTORY:])
            total, last = total + kwh, max(last, at)
            self.meters.updateValue(m, (n, total, mean, m2, count, history, last))
        out = batch[["meter_id", "reading_id", "ts", "kwh_hourly"]].assign(**columns)
        out["is_anomaly"] = out["anomaly_type"] != NORMAL
        out[CARRIED] = batch[CARRIED]
        yield out[FIELDS].assign(**dict.fromkeys(PASSED)) if self.passed else out[FIELDS]

    def close(self) -> None:
        pass


class PackedMeterScorer(MeterScorer):
    """The same on rows that come packed."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return super().handleInputRows(key, map(unpack, rows), timerValues)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group of every so many rows: ``_group``, and ``packed``, its rows as an Arrow stream."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= PACKED_ROWS or size >= PACKED_BYTES:
            yield _pack(held)
            held, rows, size = [], 0, 0
    if held:
        yield _pack(held)


def _pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    groups = table.column("_group").to_numpy()
    order = np.argsort(groups, kind="stable")
    table, groups = table.drop_columns("_group").combine_chunks().take(order), groups[order]
    starts = np.flatnonzero(np.diff(groups, prepend=-1))
    messages = []
    for a, b in zip(starts, [*starts[1:], len(groups)]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table.slice(a, b - a))
        messages.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(groups[starts], pa.int32()), pa.array(messages, pa.binary())], names=["_group", "packed"])


def unpack(batch: pd.DataFrame) -> pd.DataFrame:
    """The packed rows, with times as Spark gives them to pandas: of the session's time zone, without it."""
    rows = pa.concat_tables([pa.ipc.open_stream(message).read_all() for message in batch["packed"]]).to_pandas()
    rows["ts"] = rows["ts"].dt.tz_localize(None)
    return rows


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on local disk with changelog checkpoints instead of on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _group(dealt: Column) -> Column:
    return F.pmod(F.xxhash64(dealt), F.lit(GROUPS)).cast("int")


def score_stream(
    stream: DataFrame, *, threshold: float = THRESHOLD, sustained: int = SUSTAINED,
    warmup: int = WARMUP, two_sided: bool = False, high: float = HIGH, flatline: float = FLATLINE,
    min_stddev: float = MIN_STDDEV, idle_days: float = 30, late: str | None = None,
    stats: DataFrame | None = None, passed: bool = False,
) -> DataFrame:
    """Score a stream of events; one output row per input row, append mode.

    ``late`` drops repeated ``(meter_id, ts)`` events that arrive within that delay; ``stats``, one row per
    meter as ``rollup.meter_stats`` gives them, is where meters start from when the query starts for the
    first time; after ``idle_days`` the state of a silent meter goes. A null reading is scored but not counted.
    ``passed``: rows as ``decode.decode_marked`` gives them; the rejected ones come out with their message
    and reason, and no scores.
    """
    use_rocksdb(stream.sparkSession)
    if "reading_id" not in stream.columns:
        stream = stream.withColumn("reading_id", F.lit(None).cast("bigint"))
    if late is not None:
        stream = stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["meter_id", "ts"])
    # Rejects without a meter are dealt by their text.
    dealt = F.coalesce("meter_id", "value") if passed else F.col("meter_id")
    rows = stream.select("meter_id", "reading_id", "ts", "kwh_hourly", *CARRIED, *(PASSED if passed else []))
    rows = rows.withColumn("_group", _group(dealt)).mapInArrow(pack, "_group int, packed binary")
    p = dict(
        threshold=threshold, sustained=sustained, warmup=warmup, two_sided=two_sided, high=high,
        flatline=flatline, min_stddev=min_stddev,
    )
    start = None
    if stats is not None:
        start = stats.select("meter_id", "total_readings", "global_mean", "global_stddev")
        start = start.withColumn("_group", _group(F.col("meter_id"))).groupBy("_group")
    scorer = PackedMeterScorer(p, max(1, int(idle_days * 86_400_000)), passed)
    output = f"{OUTPUT}, {PASSED_OUTPUT}" if passed else OUTPUT
    return rows.groupBy("_group").transformWithStateInPandas(scorer, output, "append", "processingTime", initialState=start)
