"""Anomaly scoring of meter readings.

Per meter, in time order, each reading gets the running mean and population deviation up to and
including itself, its z-score, and a label. ``z`` depends on the readings only, so it is a window
expression. The label of a high reading also depends on a counter of high readings, which is the
one thing here that no window expression gives:

* spike (``z > threshold``): counter + 1
* high (``z > high``): counter + 1 while below ``sustained``; from there on the reading is a
  sustained elevation and the counter rests
* anything else: counter - 1, not below 0
* warm-up and flatline readings leave it alone

The rows are laid out in order and cut into slices (``slices.py``); a meter that lies in several is put
together from what each slice passes on: its moments, and the map from the counter at its entry to the
counter at its end (``CountMap``, a few numbers whatever the length). So every row is scored in the
task of its slice, and a stored end state of earlier readings is just one more slice in front.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kilowatch.functions.clock import epoch_us
from kilowatch.operators.slices import HOUR_US, before, in_order, same_slice, within
from kilowatch.session import stored

# Scoring thresholds and label names.
THRESHOLD = 3.0
HIGH = 2.0
SUSTAINED = 5
WARMUP = 10
FLATLINE = 0.005
MIN_STDDEV = 0.001
MAX_SPIKE_SEVERITY = 5.0
NORMAL, SPIKE, ELEVATION, FLAT = "normal", "sudden_spike", "sustained_elevation", "flatline"
ANOMALY_TYPES = [SPIKE, ELEVATION, FLAT]

# Kinds of step the counter takes.
K_NONE, K_SPIKE, K_HIGH, K_LOW = 0, 1, 2, 3


def next_count(kind: int, count: int, sustained: int) -> int:
    """The counter after one reading. Shared by the batch and the streaming scorer."""
    if kind == K_SPIKE or (kind == K_HIGH and count < sustained):
        return count + 1
    if kind == K_LOW:
        return max(0, count - 1)
    return count


# --- running mean and deviation -------------------------------------------------------------


def _moments(rows: DataFrame, value: str) -> DataFrame:
    """n, rolling_mean, rolling_stddev over all readings of the meter so far; NULLs do not count.

    ``rows`` hold the moments of what came before their slice in _n0, _mean0 and _m20, or null.
    """
    w, x = within("meter_id"), F.col(value)
    inside = rows.withColumns({"_n1": F.count(x).over(w), "_mean1": F.avg(x).over(w), "_var1": F.var_pop(x).over(w)})
    n0, n1 = F.col("_n0"), F.col("_n1")
    n = n1 + F.coalesce(n0, F.lit(0))
    gap = F.col("_mean1") - F.col("_mean0")
    alone, none = F.coalesce(n0, F.lit(0)) == 0, n1 == 0
    mean = F.when(alone, F.col("_mean1")).when(none, F.col("_mean0")).otherwise(F.col("_mean0") + gap * n1 / n)
    joint = (F.col("_m20") + F.col("_var1") * n1 + gap * gap * n0 * n1 / n) / n
    var = F.when(alone, F.col("_var1")).when(none, F.col("_m20") / n0).otherwise(joint)
    return inside.withColumns(
        {"n": n, "rolling_mean": mean, "rolling_stddev": F.sqrt(F.greatest(var, F.lit(0.0)))}
    ).drop("_n0", "_mean0", "_m20", "_n1", "_mean1", "_var1")


def _spans(rows: DataFrame, value: str, state: DataFrame | None) -> DataFrame:
    """Slices of the meters that lie in several, or go on from a stored state: meter_id, _slice, whether a
    later one follows (_last false), and count, mean and squared deviations of what came before.

    A stored state is slice -1.
    """
    x = F.col(value)
    parts = rows.groupBy("meter_id", "_slice").agg(
        F.count(x).alias("_n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("_mu"),
        F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias("_m2"),
    )
    if state is not None:
        known = state.select(
            "meter_id", F.lit(-1).cast("long").alias("_slice"), F.col("n").alias("_n"),
            F.coalesce("mean", F.lit(0.0)).alias("_mu"), F.coalesce("m2", F.lit(0.0)).alias("_m2"),
        )
        meters = parts.select(F.col("meter_id").alias("_meter")).distinct()
        parts = parts.unionByName(known.join(meters, F.col("meter_id").eqNullSafe(F.col("_meter")), "left_semi"))
    # Deviations from the overall mean of the meter keep the sums of squares well conditioned.
    everything = W.partitionBy("meter_id")
    grand = F.sum(F.col("_n") * F.col("_mu")).over(everything) / F.sum("_n").over(everything)
    parts = parts.withColumns({
        "_g": F.coalesce(grand, F.lit(0.0)), "_slices": F.count(F.lit(1)).over(everything),
        "_last": F.max("_slice").over(everything) == F.col("_slice"),
    }).where("_slices > 1").withColumn("_d", F.col("_mu") - F.col("_g"))
    w = before("meter_id")
    n, d = F.col("_n"), F.col("_d")
    sums = parts.select(
        "meter_id", "_slice", "_last", "_g", F.sum("_n").over(w).alias("_n0"),
        F.sum(n * d).over(w).alias("_s0"), F.sum(F.col("_m2") + n * d * d).over(w).alias("_q0"),
    ).where("_slice >= 0")
    some, s0 = F.col("_n0") > 0, F.col("_s0") / F.col("_n0")
    return sums.select(
        "meter_id", "_slice", "_last", F.when(some, F.col("_n0")).alias("_n0"),
        F.when(some, F.col("_g") + s0).alias("_mean0"), F.when(some, F.col("_q0") - F.col("_s0") * s0).alias("_m20"),
    )


# --- z-score and step kind ------------------------------------------------------------------


def _with_z(df: DataFrame, p: dict) -> DataFrame:
    ready = (F.col("rolling_stddev") > p["min_stddev"]) & (F.col("n") >= p["warmup"])
    z = (F.col(p["value"]) - F.col("rolling_mean")) / F.col("rolling_stddev")
    out = df.withColumn("z_score", F.when(ready, z).otherwise(F.lit(0.0)))
    reach = F.abs("z_score") if p["two_sided"] else F.col("z_score")
    kind = (
        F.when((F.col("n") < p["warmup"]) | (F.col(p["value"]) < p["flatline"]), K_NONE)
        .when(reach > p["threshold"], K_SPIKE)
        .when(F.col("z_score") > p["high"], K_HIGH)
        .otherwise(K_LOW)
    )
    return out.withColumn("_kind", kind)


# --- counter --------------------------------------------------------------------------------

# A counter map that takes every entry to the same value.
CONSTANT = 1 << 62
MAPS = "_low long, _head array<long>, _tail long"


class CountMap:
    """The counter after some readings as a function of the counter before them.

    No step raises the difference of two counters, so the map is ``low`` at entry 0 and grows by one at
    some entries: those in ``head``, fewer than ``sustained``, and all from ``tail`` on.
    """

    def __init__(self, sustained: int):
        self.low, self.head, self.tail, self.sustained = 0, [], 0, sustained

    def spike(self) -> None:
        self.low += 1

    def high(self) -> None:
        # Counters of sustained - 1 and of sustained become one.
        if self.low >= self.sustained:
            return
        meet = self.sustained - 1 - self.low
        if meet < len(self.head):
            del self.head[meet]
        else:
            upto = self.tail + meet - len(self.head)
            self.head += range(self.tail, upto)
            self.tail = upto + 1
        self.low += 1

    def lows(self, times: int) -> None:
        fall = min(self.low, times)
        self.low, times = self.low - fall, times - fall
        gone = min(len(self.head), times)
        del self.head[:gone]
        self.tail += times - gone

    def at(self, entry: int) -> int:
        return count_at(self.low, self.head, self.tail, entry)


def count_at(low: int, head, tail: int, entry: int) -> int:
    return low + bisect_left(head, entry) + max(0, entry - tail)


def _events(kinds: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of spikes, highs and first rows of segments, and the number of lows before each row."""
    lows = np.concatenate([[0], np.cumsum(kinds == K_LOW)])
    return np.flatnonzero((kinds == K_SPIKE) | (kinds == K_HIGH) | firsts), lows


def _count_maps(batches: Iterator[pa.RecordBatch], sustained: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per meter and slice; rows come in order, segment after segment. ``_row`` counts in a segment."""
    key, fold, names = None, None, schema.names[:2]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, fold.low, fold.head, fold.tail)))], schema=schema)

    for batch in batches:
        kinds, firsts = np.asarray(batch.column("_kind")), np.asarray(batch.column("_row")) == 1
        at, lows = _events(kinds, firsts)
        done = 0
        for i in at.tolist():
            if key is not None:
                fold.lows(int(lows[i] - lows[done]))
            if firsts[i]:
                if key is not None:
                    yield row()
                key, fold = tuple(batch.column(n)[i].as_py() for n in names), CountMap(sustained)
            if kinds[i] == K_SPIKE:
                fold.spike()
            elif kinds[i] == K_HIGH:
                fold.high()
            elif kinds[i] == K_LOW:
                fold.lows(1)
            done = i + 1
        if key is not None:
            fold.lows(int(lows[-1] - lows[done]))
    if key is not None:
        yield row()


def _entries(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The counter at the end of each slice of a meter; rows come by meter and slice."""
    last, end = None, 0
    for batch in batches:
        out = []
        for meter, part, low, head, tail in zip(*(batch.column(c).to_pylist() for c in ("meter_id", "_slice", "_low", "_head", "_tail"))):
            end = count_at(low, head, tail, end if last is not None and last == (meter,) else 0)
            last = (meter,)
            out.append({"meter_id": meter, "_slice": part, "_end": end})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def walk(
    kinds: np.ndarray, firsts: np.ndarray, entries: np.ndarray, count: int, sustained: int
) -> tuple[np.ndarray, np.ndarray]:
    """The counter before and after each reading, ``count`` being the counter before the first.

    The counter of a segment starts at the entry of its first row. Only spikes, highs and first rows are
    walked; the counter falls evenly in between. Shared by the batch and the streaming scorer.
    """
    at, lows = _events(kinds, firsts)
    anchors, values, done = [0], [count], 0  # the counter before the rows from an anchor on
    for i in at.tolist():
        count = int(entries[i]) if firsts[i] else max(0, count - int(lows[i] - lows[done]))
        if firsts[i]:
            anchors.append(i)
            values.append(count)
        count = next_count(int(kinds[i]), count, sustained)
        done = i + 1
        anchors.append(done)
        values.append(count)
    # Of several anchors at one row the last holds.
    where = np.searchsorted(np.array(anchors), np.arange(len(kinds)), "right") - 1
    start = np.array(anchors)[where]
    befores = np.maximum(0, np.array(values)[where] - (lows[:-1] - lows[start]))
    rises = (kinds == K_SPIKE) | ((kinds == K_HIGH) & (befores < sustained))
    return befores, np.where(rises, befores + 1, np.where(kinds == K_LOW, np.maximum(0, befores - 1), befores))


def _count_along(batches: Iterator[pa.RecordBatch], sustained: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``_before`` and ``consecutive_high``: the counter before and after each reading.

    Rows come in order, segment after segment; the counter of a segment starts at its ``_entry``.
    """
    count = 0  # after the last row
    for batch in batches:
        kinds, firsts = np.asarray(batch.column("_kind")), np.asarray(batch.column("_row")) == 1
        entries = np.asarray(batch.column("_entry").fill_null(0))
        befores, afters = walk(kinds, firsts, entries, count, sustained)
        if len(kinds):
            count = int(afters[-1])
        columns = [*(batch.column(n) for n in schema.names[:-2]), pa.array(befores, pa.int64()), pa.array(afters, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _in_segments(rows: DataFrame) -> DataFrame:
    """Rows with their number ``_row`` in their meter and slice, segment after segment in every task."""
    w = W.partitionBy("meter_id", "_slice").orderBy("_at")
    return rows.withColumn("_row", F.row_number().over(w)).sortWithinPartitions("meter_id", "_slice", "_at")


def _ends(kinds: DataFrame, sustained: int, state: DataFrame | None) -> DataFrame:
    """meter_id, _slice, _end: the counter at the end of the slices that others follow."""
    meter = kinds.schema["meter_id"]
    keys = StructType([meter, StructField("_slice", LongType())])
    map_type = StructType([*keys.fields, *StructType.fromDDL(MAPS).fields])
    end_type = StructType([*keys.fields, StructField("_end", LongType())])
    arrow_map, arrow_end = _arrow(map_type), _arrow(end_type)
    maps = _in_segments(kinds).select("meter_id", "_slice", "_kind", "_row").mapInArrow(
        lambda it: _count_maps(it, sustained, arrow_map), map_type
    )
    if state is not None:
        maps = maps.unionByName(state.select(
            "meter_id", F.lit(-1).cast("long").alias("_slice"), F.col("consecutive_high").cast("long").alias("_low"),
            F.array().cast("array<long>").alias("_head"), F.lit(CONSTANT).alias("_tail"),
        ))
    return maps.repartition("meter_id").sortWithinPartitions("meter_id", "_slice").mapInArrow(
        lambda it: _entries(it, arrow_end), end_type
    )


def _carried(rows: DataFrame, p: dict, kinds_of, state: DataFrame | None) -> DataFrame:
    """Rows with _n0, _mean0, _m20 and _entry: what came before their slice."""
    spans = stored(_spans(rows, p["value"], state), "spans")
    slim = rows.select(*[c for c in rows.columns if c in {"meter_id", "_slice", "_at", p["value"], "n", "rolling_mean", "rolling_stddev"}])
    followed = spans.where("not _last")
    inner = slim.join(followed, same_slice(slim, followed)).select(slim["*"], "_n0", "_mean0", "_m20")
    ends = _ends(kinds_of(inner), p["sustained"], state)
    # The counter at the entry of a slice is that at the end of the one before.
    closed = spans.select("meter_id", "_slice").unionByName(ends.where("_slice < 0").select("meter_id", "_slice"))
    closed = closed.join(
        ends.withColumnsRenamed({"meter_id": "_m", "_slice": "_s"}),
        closed["meter_id"].eqNullSafe(F.col("_m")) & (closed["_slice"] == F.col("_s")), "left",
    ).withColumn("_entry", F.lag("_end").over(W.partitionBy("meter_id").orderBy("_slice")))
    entries = closed.where("_slice >= 0").select(F.col("meter_id").alias("_m"), F.col("_slice").alias("_s"), "_entry")
    carry = spans.join(entries, spans["meter_id"].eqNullSafe(F.col("_m")) & (spans["_slice"] == F.col("_s"))).select(
        spans["meter_id"], spans["_slice"], "_n0", "_mean0", "_m20", "_entry"
    )
    carry = stored(carry, "carry")
    return rows.join(carry, same_slice(rows, carry), "left").select(rows["*"], "_n0", "_mean0", "_m20", "_entry")


def _with_count(kinds: DataFrame, sustained: int) -> DataFrame:
    """``_before`` and ``consecutive_high``: the counter before and after each reading."""
    rows = _in_segments(kinds)
    schema = StructType([*rows.schema.fields, StructField("_before", LongType()), StructField("consecutive_high", LongType())])
    arrow = _arrow(schema)
    return rows.mapInArrow(lambda it: _count_along(it, sustained, arrow), schema)


def _label(df: DataFrame, p: dict) -> DataFrame:
    sustained = (F.col("_kind") == K_HIGH) & (F.col("_before") >= p["sustained"])
    kind = (
        F.when(F.col("n") < p["warmup"], NORMAL)
        .when(F.col(p["value"]) < p["flatline"], FLAT)
        .when(F.col("_kind") == K_SPIKE, SPIKE)
        .when(sustained, ELEVATION)
        .otherwise(NORMAL)
    )
    spike = F.least(F.abs("z_score") / p["threshold"], F.lit(MAX_SPIKE_SEVERITY))
    out = df.withColumn("anomaly_type", kind)
    severity = (
        F.when(F.col("anomaly_type") == FLAT, 1.0)
        .when(F.col("anomaly_type") == SPIKE, spike)
        .when(F.col("anomaly_type") == ELEVATION, 2.0 + F.col("_before") / 10.0)
        .otherwise(0.0)
    )
    return out.withColumns({"severity": severity, "is_anomaly": F.col("anomaly_type") != NORMAL}).drop(
        "_kind", "_before", "_slice", "_at", "_entry", "_row"
    )


# --- rolling window variant -----------------------------------------------------------------


def _window_moments(readings: DataFrame, days: int, value: str, ts: str) -> DataFrame:
    """n, rolling_mean, rolling_stddev over the last ``days`` days, both ends and all ties included.

    The window of a reading has three parts: its own hour up to the reading, the whole hours before, and
    the end of the hour that the window begins in. The first and last are running values inside an hour
    (the last one from behind, over the readings moved ``days`` days on); the hours are folded to
    count, mean and squared deviations once. So the cost is linear in the readings, however many fall into
    a window. A reading without time is in no window, and has an empty one.
    """
    x, hours = F.col(value), days * 24
    own = readings.withColumns({"_us": epoch_us(F.col(ts)), "_own": F.lit(True)})
    own = own.withColumn("_hour", F.floor(F.col("_us") / HOUR_US).cast("long"))
    slim = own.where("_us is not null").select("meter_id", "_us", "_hour", value)
    moved = slim.select(
        "meter_id", (F.col("_us") + hours * HOUR_US).alias("_us"), (F.col("_hour") + hours).alias("_hour"), value,
        F.lit(False).alias("_own"),
    )
    hourly = slim.groupBy("meter_id", "_hour").agg(
        F.count(x).alias("n"), F.avg(x).alias("mu"), (F.var_pop(x) * F.count(x)).alias("m2")
    )
    span = W.partitionBy("meter_id").orderBy("_hour").rangeBetween(1 - hours, -1)
    whole = hourly.select("meter_id", "_hour", F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mu", "m2"))).over(span).alias("_whole"))
    place = W.partitionBy("meter_id", "_hour")
    mine, theirs = F.when(F.col("_own"), x), F.when(~F.col("_own"), x)
    upto = place.orderBy("_us").rangeBetween(W.unboundedPreceding, 0)
    since = place.orderBy(F.desc("_us")).rangeBetween(W.unboundedPreceding, 0)

    def part(values: Column, w) -> Column:
        """A list of one part, or of none if it is empty."""
        n = F.count(values).over(w)
        one = F.struct(n.alias("n"), F.avg(values).over(w).alias("mu"), (F.var_pop(values).over(w) * n).alias("m2"))
        return F.when(n > 0, F.array(one)).otherwise(F.array())

    rows = own.unionByName(moved, allowMissingColumns=True).withColumns({"_upto": part(mine, upto), "_since": part(theirs, since)})
    rows = rows.where("_own")
    whole = whole.withColumnsRenamed({"meter_id": "_m", "_hour": "_h"})
    met = rows.join(whole, F.col("meter_id").eqNullSafe(F.col("_m")) & (F.col("_hour") == F.col("_h")), "left")
    parts = met.withColumn("_parts", F.when(F.col("_us").isNull(), F.array()).otherwise(
        F.concat("_upto", F.coalesce("_whole", F.array()), "_since")
    ))
    n = F.aggregate("_parts", F.lit(0).cast("long"), lambda a, p: a + p["n"])
    total = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["n"] * p["mu"])
    parts = parts.withColumn("n", n).withColumn("rolling_mean", F.when(F.col("n") > 0, total / F.col("n")))
    mean = F.col("rolling_mean")
    squares = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["m2"] + p["n"] * (p["mu"] - mean) * (p["mu"] - mean))
    return parts.withColumn("rolling_stddev", F.when(F.col("n") > 0, F.sqrt(squares / F.col("n")))).drop(
        "_us", "_own", "_hour", "_upto", "_since", "_whole", "_parts", "_m", "_h"
    )


# --- public ---------------------------------------------------------------------------------


def score_z(
    readings: DataFrame, *, window_days: int | None = None, value: str = "kwh_hourly",
    order: tuple[str, ...] = ("ts", "reading_id"), warmup: int = WARMUP,
    min_stddev: float = MIN_STDDEV,
) -> DataFrame:
    """Readings with n, rolling_mean, rolling_stddev and z_score; no labels."""
    if window_days is not None:
        moments = _window_moments(readings, window_days, value, order[0])
    else:
        rows = in_order(readings, *order)
        spans = _spans(rows, value, None)
        carried = rows.join(spans, same_slice(rows, spans), "left").select(rows["*"], "_n0", "_mean0", "_m20")
        moments = _moments(carried, value).drop("_slice", "_at")
    ready = (F.col("rolling_stddev") > min_stddev) & (F.col("n") >= warmup)
    z = (F.col(value) - F.col("rolling_mean")) / F.col("rolling_stddev")
    return moments.withColumn("z_score", F.when(ready, z).otherwise(F.lit(0.0)))


def score_batch(
    readings: DataFrame, *, threshold: float = THRESHOLD, sustained: int = SUSTAINED,
    warmup: int = WARMUP, window_days: int | None = None, two_sided: bool = False,
    high: float = HIGH, flatline: float = FLATLINE, min_stddev: float = MIN_STDDEV,
    value: str = "kwh_hourly", order: tuple[str, ...] = ("ts", "reading_id"), state: DataFrame | None = None,
) -> DataFrame:
    """Score every reading. Needs ``meter_id``, the value and the order columns; keeps the others.

    Adds n, rolling_mean, rolling_stddev, z_score, anomaly_type, severity, is_anomaly and
    consecutive_high. ``window_days`` replaces the running statistics by those of the last days.
    ``state``, as ``end_state`` gives it, is what the meters have behind them: the readings are scored as if
    those behind it came first. No reading is lost: null meters are one meter, null times come first
    (and have an empty window with ``window_days``); a null value is not counted.
    """
    if state is not None and window_days is not None:
        raise ValueError("a window of days needs its readings, not a state")
    p = dict(
        threshold=threshold, sustained=sustained, warmup=warmup, two_sided=two_sided, high=high,
        flatline=flatline, min_stddev=min_stddev, value=value,
    )
    if window_days is not None:
        readings = _window_moments(readings, window_days, value, order[0])

    def kinds_of(rows: DataFrame) -> DataFrame:
        none = ["_n0", "_mean0", "_m20"]
        return _with_z(rows.drop(*none) if window_days is not None else _moments(rows, value), p)

    rows = in_order(readings, *order)
    return _label(_with_count(kinds_of(_carried(rows, p, kinds_of, state)), sustained), p)


def end_state(scored: DataFrame, order: tuple[str, ...] = ("ts", "reading_id"), before: DataFrame | None = None) -> DataFrame:
    """What ``score_batch`` needs to go on: meter_id, n, mean, m2 and consecutive_high after the last reading.

    ``before`` is the state that the scored readings went on from; meters without a new reading keep theirs.
    """
    last = F.max_by(F.struct("n", "rolling_mean", "rolling_stddev", "consecutive_high"), F.struct(*order))
    fresh = scored.groupBy("meter_id").agg(last.alias("s")).select(
        "meter_id", "s.n", F.col("s.rolling_mean").alias("mean"),
        (F.col("s.rolling_stddev") * F.col("s.rolling_stddev") * F.col("s.n")).alias("m2"), "s.consecutive_high",
    )
    if before is None:
        return fresh
    names = fresh.select(F.col("meter_id").alias("_m"))
    return fresh.unionByName(before.join(names, F.col("meter_id").eqNullSafe(F.col("_m")), "left_anti"))
