"""The stored tables that reports read.

Readings, statistics, demand, scored readings, meter states and forecasts are derived from the events
once, written below the shared folder and read from there by every report. A table is built anew when
the files that it is derived from have changed. Rows are counted while they are written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kilowatch.session import scratch_path, tune
from kilowatch.sinks.tables import write_partitioned


@dataclass
class Table:
    """How a table is derived: from which inputs, and by which columns it is cut into folders."""

    build: Callable[[SparkSession, str], DataFrame]
    inputs: tuple[str, ...] = ("events",)
    folders: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()


@dataclass
class Built:
    state: tuple
    path: str
    schema: StructType
    rows: int


TABLES: dict[str, Table] = {}
_BUILT: dict[tuple[str, str, str], Built] = {}


def table_of(name: str, **settings) -> Callable:
    """Register the function that derives the table ``name``."""

    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        TABLES[name] = Table(build, **settings)
        return build

    return register


def input_state(spark: SparkSession, sf_dir: str, inputs: tuple[str, ...]) -> tuple:
    """Bytes, files and time of change of the inputs, from their file system."""
    out = []
    for name in inputs:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        content = store.getContentSummary(path)
        changed = max([f.getModificationTime() for f in store.listStatus(path)], default=0)
        out.append((name, content.getLength(), content.getFileCount(), changed))
    return tuple(out)


def written(df: DataFrame, path: str, folders: tuple[str, ...] = (), sort: tuple[str, ...] = ()) -> int:
    """Write a table and return its rows, which the write itself counts."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if folders:
        write_partitioned(counted, path, list(folders), list(sort))
    else:
        counted.write.mode("overwrite").parquet(path)
    return int(seen.get["rows"])


def built(spark: SparkSession, sf_dir: str, name: str) -> Built:
    """The table, derived now if it is not stored yet or its inputs have changed."""
    spec, key = TABLES[name], (tune(spark).sparkContext.applicationId, sf_dir.rstrip("/"), name)
    state = input_state(spark, sf_dir, spec.inputs)
    if key not in _BUILT or _BUILT[key].state != state:
        df = spec.build(spark, sf_dir)
        path = scratch_path(spark, name)
        rows = written(df, path, spec.folders, spec.sort)
        _BUILT[key] = Built(state, path, df.schema, rows)
    return _BUILT[key]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = built(spark, sf_dir, name)
    return spark.read.schema(table.schema).parquet(table.path).select(*table.schema.names)


def row_counts(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """One row per table: its name and the rows counted when it was written. Reads no table."""
    rows = [(name, built(spark, sf_dir, name).rows) for name in names]
    return spark.createDataFrame(rows, "tbl string, row_count bigint")
