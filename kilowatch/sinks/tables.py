"""Batch writers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame, path: str, folders: list[str], sort: list[str] | None = None
) -> None:
    """Overwrite the partitions present in ``df``, leave the others.

    The rebalance hint groups rows by folder, splits a folder with very many rows over several
    tasks and merges small ones, so neither one task per month nor fifty small files per month
    come out. Sorting inside the files lets their statistics skip row groups.
    """
    out = df.hint("rebalance", *[F.col(c) for c in folders])
    if sort:
        out = out.sortWithinPartitions(*folders, *sort)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def write_plain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_text(df: DataFrame, path: str) -> None:
    """Delimited text without header: the exchange form of the cleaned tables."""
    df.write.mode("overwrite").csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").csv(path, header=True)


def save_forecast(rows: DataFrame, table: str) -> None:
    """Insert forecast rows; a repeated run replaces only its own zone and run."""
    spark = rows.sparkSession
    folders = ["zone", "forecast_run_ts"]
    if not spark.catalog.tableExists(table):
        rows.limit(0).write.format("parquet").partitionBy(*folders).saveAsTable(table)
    columns = spark.table(table).columns
    (
        rows.select(*columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .insertInto(table)
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def summary(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row counts of stored tables; Parquet answers them from its footers."""
    from kilowatch.operators.rollup import row_counts

    return row_counts({name: spark.read.parquet(path) for name, path in paths.items()})
