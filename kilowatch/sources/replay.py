"""Replay of stored rows as a stream, in the order of their time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatch.session import stored
from kilowatch.streaming.decode import date_bounds


def write_in_order(rows: DataFrame, path: str, order: tuple[str, ...] = ("ts", "reading_id"), files: int | None = None) -> None:
    """Write a folder whose files a stream reads in the order of time, however the rows lay before.

    One job: rows are range-partitioned, so file after file holds later rows. A file stream takes files
    by modification time, so these times are set in the order of the file names, which is that of the
    ranges. Only file names pass the driver.
    """
    ranged = rows.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
    ranged.write.parquet(path)
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def parts():
        found = [f for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda f: f.getPath().getName())

    written = parts()
    newest = max((f.getModificationTime() for f in written), default=0)
    for i, f in enumerate(written):
        store.setTimes(f.getPath(), newest - 1000 * (len(written) - i), -1)
    times = [f.getModificationTime() for f in parts()]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise RuntimeError("this file system keeps no modification times: use write_days")


def write_days(
    records: DataFrame, path: str, date_from: str | None = None, date_to: str | None = None,
    file_format: str = "parquet",
) -> int:
    """Append the rows of each day to a folder, oldest day first; returns the number of days.

    A file stream reads files in the order they appeared, so a reader of the folder sees the days
    in order. The loop runs over days, the rows never pass the driver.
    """
    bounded = stored(date_bounds(records, date_from, date_to).repartition("reading_date").sortWithinPartitions("reading_date"), "replay")
    days = [r[0] for r in bounded.select("reading_date").distinct().orderBy("reading_date").toLocalIterator()]
    for day in days:
        bounded.where(F.col("reading_date") == day).write.mode("append").format(file_format).save(path)
    return len(days)
