"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilowatch.session import scratch_path, tune

# Rows of an Arrow batch; Spark's own limit in bytes holds for long texts.
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; also sets what the operators need of the session."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows, written once below the shared folder and read back; survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that tasks of one worker share it.

    A worker serves all stages of a job: it keeps the dict of one name only, that asked for last.
    """
    holder = sys.modules.setdefault("_kilowatch_worker", types.ModuleType("_kilowatch_worker"))
    caches = holder.__dict__.setdefault("caches", {})
    if name not in caches:
        caches.clear()
    return caches.setdefault(name, {})


def tidy(results: Iterator) -> Iterator:
    """The results of a task; afterwards what its Python worker no longer uses goes back to the system.

    A worker lives on beside the workers and the JVM of its executor.
    """
    yield from results
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def row_shares(part_sizes: DataFrame, part: str, size: str) -> DataFrame:
    """Running total of ``size`` before each part, in order of ``part``.

    One row per part: the table is as long as a stage has partitions, whatever the input.
    """
    from pyspark.sql import Window

    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return part_sizes.select(
        part, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long").alias("before")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def schema_of(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


def bounded_sample(df: DataFrame, most: int, keys: list[str]) -> DataFrame:
    """At most ``most`` rows of a table of distinct ``keys``: the first in the order of their hash.

    A cut on the hash, set from the row count, leaves few more rows than that before any are
    ordered, however many tasks there are. For fitting models only.
    """
    h, rows = F.xxhash64(*keys), df.count()
    if rows > most:
        df = df.where(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * most / rows)))
    return df.orderBy(h, *keys).limit(most)


# Ids that are sent to every executor, at most; about 32 MB there. More are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def matching_rows(df: DataFrame, column: str, ids: DataFrame, keep: bool = True) -> DataFrame:
    """Rows whose ``column`` is among the distinct ``ids`` (or is not, with ``keep`` false).

    Their number decides whether the ids travel to the rows or both are shuffled. Nulls match none.
    """
    ids = ids.toDF("matching_id")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = F.broadcast(ids) if few else ids
    return df.join(ids, df[column] == ids["matching_id"], "left_semi" if keep else "left_anti")
