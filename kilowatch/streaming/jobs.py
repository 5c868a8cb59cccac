"""The streaming job: sources, one scored query, and its fan-out to all sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kilowatch import schemas
from kilowatch.operators.alerts import alerts_from_scored, meter_states
from kilowatch.session import scratch_path, tune
from kilowatch.sources.replay import write_in_order
from kilowatch.streaming.decode import with_partition_folders
from kilowatch.streaming.scorer import score_stream, use_rocksdb

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Rate cap and trigger of the live job.
MAX_OFFSETS_PER_TRIGGER = 50_000
TRIGGER = "30 seconds"

BYTES_PER_TRIGGER = 128 * 1024 * 1024


def stream_source(
    spark: SparkSession, kind: str, location: str, *, schema: StructType | str | None = None,
    topic: str = "meter-readings", files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None, file_format: str = "parquet",
) -> DataFrame:
    """A stream of messages from Kafka, or of rows from files that appear in a folder.

    A micro-batch is what the stateful scorer orders in memory per meter: cap it.
    """
    if kind == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic)
            .option("startingOffsets", "latest")
            .option("maxOffsetsPerTrigger", MAX_OFFSETS_PER_TRIGGER)
            .option("failOnDataLoss", "false")
            .load()
        )
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")
    if kind == "rate":
        return spark.readStream.format("rate").option("rowsPerSecond", location).load()
    if kind != "files":
        raise ValueError(f"unknown stream source {kind!r}")
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(location)


def alert_messages(anomalies: DataFrame) -> DataFrame:
    """Anomalies as JSON messages keyed by meter."""
    stamped = anomalies.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    payload = F.to_json(F.struct(*schemas.ALERT_PAYLOAD))
    return stamped.select(F.col("meter_id").alias("key"), payload.alias("value"))


@dataclass
class Sinks:
    """Where a micro-batch goes. Unset sinks are skipped."""

    scored: str | None = None
    alerts: str | None = None
    states: str | None = None
    messages: str | None = None
    message_servers: str | None = None
    message_topic: str = "anomaly-alerts"
    console: bool = False


def overwrite_batch(df: DataFrame, batch_id: int, path: str, *folders: str, fmt: str = "parquet") -> None:
    """Write a micro-batch into its own folder. A repeated batch replaces what it wrote before."""
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders, "batch_id")
        .format(fmt)
        .save(path)
    )


def fan_out(sinks: Sinks) -> Callable[[DataFrame, int], None]:
    """One pass over the state feeds every sink. Nothing is collected; a failed write fails the
    batch, and the checkpoint repeats it."""

    # A table that is read once is not worth keeping.
    shared = sinks != Sinks(scored=sinks.scored)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = with_partition_folders(batch.withColumn("processed_at", F.current_timestamp()))
        if shared:
            batch.persist()
        try:
            if sinks.scored:
                overwrite_batch(batch, batch_id, sinks.scored, "reading_year", "reading_month")
            anomalies = batch.where("is_anomaly")
            if sinks.alerts:
                overwrite_batch(alerts_from_scored(batch), batch_id, sinks.alerts)
            if sinks.states:
                overwrite_batch(meter_states(batch), batch_id, sinks.states)
            messages = alert_messages(anomalies)
            if sinks.messages:
                overwrite_batch(messages, batch_id, sinks.messages, fmt="json")
            if sinks.message_servers:
                (
                    messages.write.format("kafka")
                    .option("kafka.bootstrap.servers", sinks.message_servers)
                    .option("topic", sinks.message_topic)
                    .save()
                )
            if sinks.console:
                anomalies.select(
                    "meter_id", "ts", "kwh_hourly", "z_score", "anomaly_type", "severity", "acorn_group"
                ).show(20, truncate=False)
        finally:
            if shared:
                batch.unpersist()

    return write


def start(
    scored: DataFrame, sinks: Sinks, checkpoint: str, *, every: str = TRIGGER, bounded: bool = False
) -> StreamingQuery:
    """Start the one query of the job. ``bounded`` processes what is there and ends."""
    return started(scored, fan_out(sinks), checkpoint, every=every, bounded=bounded)


def started(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *, every: str = TRIGGER, bounded: bool = False
) -> StreamingQuery:
    """Start a query whose micro-batches go to ``write``.

    A query with processing-time timeouts keeps running empty batches to look for them, which a
    bounded run must not do: it would never end.
    """
    writer = rows.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    if not bounded:
        return writer.trigger(processingTime=every).start()
    with _settings(rows.sparkSession, {EMPTY_BATCHES: "false"}):
        return writer.trigger(availableNow=True).start()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for a query that is started inside; the query keeps its own copy of them."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches of a sink."""
    return spark.read.parquet(path)


def score_table_as_stream(
    spark: SparkSession, path: str, columns: Callable[[DataFrame], DataFrame], *,
    files: int | None = None, files_per_trigger: int | None = None, **options
) -> DataFrame:
    """Run a stored table through the streaming scorer to its end and return the scored rows.

    The rows are written once in the order of time, so the result does not depend on how the files of
    the table lie, nor on how many of them one micro-batch of bounded size takes.
    """
    tune(spark)
    use_rocksdb(spark)
    work = scratch_path(spark, "score-stream")
    rows = columns(spark.read.parquet(path))
    write_in_order(rows, f"{work}/in", files=files)
    source = stream_source(
        spark, "files", f"{work}/in", schema=rows.schema, files_per_trigger=files_per_trigger,
        bytes_per_trigger=None if files_per_trigger else BYTES_PER_TRIGGER,
    )
    scored = score_stream(source, **options)
    # State is split once for all, so by the cores of the cluster, not by a batch default.
    cores = str(spark.sparkContext.defaultParallelism)
    with _settings(spark, {"spark.sql.shuffle.partitions": cores}):
        query = start(scored, Sinks(scored=f"{work}/scored"), f"{work}/checkpoint", bounded=True)
    query.awaitTermination()
    return read_batches(spark, f"{work}/scored")
