import shutil

from pyspark.sql import functions as F

from kilowatch.operators.grid import future_slots
from kilowatch.operators import features
from kilowatch.plans.registry import QUERIES
from kilowatch.sources import crosswalk, warehouse
from tests.conftest import SF_DIR


def test_a_table_is_written_once_and_again_after_a_change(spark, tmp_path):
    for name in ("events", "customer", "nation", "region"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    first = warehouse.built(spark, str(tmp_path), "household_stats")
    assert warehouse.built(spark, f"{tmp_path}/", "household_stats") is first
    assert first.rows == crosswalk.stats(spark, str(tmp_path)).count() > 0
    half = spark.read.parquet(f"{SF_DIR}/events.parquet").where("user_id % 2 = 0").coalesce(1)
    half.write.parquet(f"{tmp_path}/half")
    (part,) = (tmp_path / "half").glob("part-*.parquet")
    shutil.copy(part, tmp_path / "events.parquet")
    again = warehouse.built(spark, str(tmp_path), "household_stats")
    assert again.path != first.path and 0 < again.rows < first.rows


def test_rows_are_counted_by_the_write(spark, tmp_path):
    df = spark.range(1000).withColumn("part", (F.col("id") % 3).cast("string"))
    assert warehouse.written(df, f"{tmp_path}/a") == 1000
    assert warehouse.written(df, f"{tmp_path}/b", ("part",), ("id",)) == 1000
    assert warehouse.written(df.limit(0), f"{tmp_path}/c") == 0


def jobs_of(spark, run):
    """Jobs that ``run`` starts."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "jobs of a query")
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_reports_read_stored_tables(spark):
    """After the tables are built a report on anomalies is a scan of the stored table, not a scoring run."""
    for name in ("table_row_counts", "anomaly_breakdown", "open_alerts", "meter_state_latest"):
        QUERIES[name](spark, SF_DIR).collect()
    assert jobs_of(spark, lambda: QUERIES["table_row_counts"](spark, SF_DIR).collect()) <= 1
    assert jobs_of(spark, lambda: QUERIES["anomaly_breakdown"](spark, SF_DIR).collect()) <= 8
    assert jobs_of(spark, lambda: QUERIES["meter_state_latest"](spark, SF_DIR).collect()) <= 1
    plan = QUERIES["anomaly_breakdown"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "is_anomaly" in plan


def test_union_of_equally_dealt_inputs(spark):
    """A window over a union sees the rows of both sides, however their exchanges are coalesced."""
    demand = crosswalk.demand(spark, SF_DIR)
    history = features.recent_history(demand)
    rolled = features.range_rolling(history, future_slots(history, 24))
    assert rolled.where("rolling_7d_mean = 0").count() == 0
    out = features.forecast_window(history)
    assert out.where("rolling_7d_mean = 0").count() == 0
