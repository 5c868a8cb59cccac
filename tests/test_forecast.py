import datetime as dt
import math
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from kilowatch.operators import features, forecast, grid
from kilowatch.plans import panels, reports, views
from kilowatch.sinks import tables

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def load(zone, hour, rng):
    return 100.0 + (20 if zone == "AEP" else 0) + 30 * math.sin(2 * math.pi * hour / 24) + rng.random()


@pytest.fixture(scope="module")
def demand(spark):
    rng = random.Random(2)
    rows = [(at(h), z, load(z, h, rng)) for z in ("AEP", "DOM") for h in range(24 * 21)]
    df = spark.createDataFrame(rows, "ts timestamp, zone string, mw_demand double")
    return df.repartition(4).cache()


@pytest.fixture(scope="module")
def model(spark, demand):
    rows = forecast.direct_training_rows(demand, hours=24)
    return forecast.train(rows, forecast.DIRECT_FEATURES, test_days=3, trees=3, depth=3)


def test_densify_keeps_sums_and_fills_gaps(spark):
    rows = [(at(0), "A", 1.0), (at(5), "A", 2.0), (at(2), "B", 4.0)]
    dense = grid.densify(spark.createDataFrame(rows, "ts timestamp, zone string, mw_demand double"))
    assert dense.count() == 12
    assert {r.zone: r.s for r in dense.groupBy("zone").agg(F.sum("mw_demand").alias("s")).collect()} == {"A": 3.0, "B": 4.0}


def test_lags_are_by_time_not_by_row(spark):
    rows = [(at(0), "A", 1.0), (at(2), "A", 2.0), (at(3), "A", 3.0)]
    df = spark.createDataFrame(rows, "ts timestamp, zone string, mw_demand double")
    got = {r.ts: (r.lag_1h, r.lag_2h) for r in grid.lags_by_time(df, df, [1, 2]).collect()}
    assert got == {at(0): (None, None), at(2): (None, 1.0), at(3): (2.0, None)}


@pytest.mark.parametrize("hours", [24, 48])
def test_direct_forecast_has_every_hour_of_every_zone(spark, demand, hours):
    rows = forecast.direct_training_rows(demand, hours=hours)
    fitted, _ = forecast.train(rows, forecast.DIRECT_FEATURES, test_days=3, trees=2, depth=2)
    out = forecast.forecast(demand, fitted, hours)
    assert out.count() == 2 * hours == out.select("zone", "ts").distinct().count()
    assert out.agg(F.min("ts"), F.max("ts")).first() == (at(24 * 21), at(24 * 21 + hours - 1))


def test_recursive_forecast_has_every_hour_of_every_zone(spark, demand):
    rows, names = features.engineer_features(demand)
    fitted, _ = forecast.train(rows, names, test_days=3, trees=2, depth=2)
    out = forecast.forecast(demand, fitted, 4, strategy="recursive")
    assert out.count() == 8 == out.select("zone", "ts").distinct().count()
    with pytest.raises(ValueError):
        forecast.forecast(demand, fitted, 4, strategy="guess")


def test_metrics_equal_the_evaluator(model, demand):
    fitted, metrics = model
    rows = forecast.direct_training_rows(demand)
    cutoff = rows.agg(F.max("ts") - F.make_dt_interval(days=F.lit(3))).scalar()
    tested = fitted.transform(rows.where(F.col("ts") > cutoff))
    row = metrics.first()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="mw_demand", predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(tested), abs=1e-4)
    assert (row.test_rows, row.train_rows) == (tested.count(), rows.count() - tested.count())
    assert (row.features, row.max_iter, row.model) == ("21", "3", "GBT_v1")


def test_importances_and_stored_model(model, demand, tmp_path):
    fitted, _ = model
    top = forecast.feature_importance(fitted).collect()
    assert len(top) == 10 and [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    tables.save_model(fitted, f"{tmp_path}/model")
    loaded = tables.load_model(f"{tmp_path}/model")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(forecast.forecast(demand, loaded)) == key(forecast.forecast(demand, fitted))


def test_leak_free_features_do_not_know_the_present(demand):
    cutoff = F.lit(at(24 * 14))
    shifted = demand.withColumn(
        "mw_demand", F.when(F.col("ts") > at(24 * 18), F.col("mw_demand") + 500).otherwise(F.col("mw_demand"))
    )
    now = at(24 * 18 + 1)
    pick = lambda df: sorted(
        tuple(round(r[c], 9) for c in features.FEATURES) + (r.zone,)
        for r in features.engineer_features(df, cutoff=cutoff)[0].where(F.col("ts") == now).collect()
    )
    assert pick(demand) == pick(shifted)
    plain, _ = features.engineer_features(demand, leak_free=False)
    row = plain.first()
    assert row.seasonal_index + row.seasonal_deviation == pytest.approx(row.mw_demand)


def test_forecast_window_uses_observed_values_only(demand):
    out = {(r.zone, r.ts): r for r in features.forecast_window(features.recent_history(demand)).collect()}
    assert len(out) == 48
    last = {(r.zone, r.ts): r.mw_demand for r in demand.collect()}
    row = out["DOM", at(24 * 21 + 2)]
    assert row.lag_1h is None and row.lag_2h is None
    assert row.lag_24h == last["DOM", at(24 * 20 + 2)] and row.lag_168h == last["DOM", at(24 * 14 + 2)]
    seen = [v for (z, t), v in last.items() if z == "DOM" and at(24 * 14 + 2) <= t]
    assert row.rolling_7d_mean == pytest.approx(sum(seen) / len(seen))


def test_one_zone_history(demand):
    assert features.recent_history(demand, 200, "AEP").count() == 201


def test_a_zone_that_lags_keeps_its_history(demand):
    late = demand.where(~((F.col("zone") == "AEP") & (F.col("ts") > at(24 * 7))))
    history = features.recent_history(late, 100)
    assert {r.zone: r.n for r in history.groupBy("zone").agg(F.count("*").alias("n")).collect()} == {"AEP": 101, "DOM": 101}


def test_next_hours_of_every_zone(spark):
    f = spark.createDataFrame(
        [(at(h), z, 1.0, None) for h in range(20) for z in "ABCDE"],
        "ts timestamp, zone string, predicted_mw double, actual_mw double",
    )
    rows = panels.next_forecast_hours(f, F.lit(at(3))).collect()
    assert sorted({r.ts for r in rows}) == [at(h) for h in range(4, 10)] and len(rows) == 30


def test_split_is_by_days(demand):
    assert {r.part: r.rows for r in features.split_share(demand, test_days=3).collect()} == {"train": 864, "test": 144}


def test_forecast_rows_and_naive(demand):
    out = forecast.forecast_rows(forecast.seasonal_naive(demand, 24), "run")
    assert out.count() == 2 * 24 * 21
    assert out.where(F.col("actual_mw").isNotNull()).count() == 0
    assert set(out.columns) == {"ts", "zone", "predicted_mw", "actual_mw", "forecast_run_ts", "year", "month"}


def test_band_contains_most_residuals(demand):
    tested = forecast.seasonal_naive(demand).join(demand, ["zone", "ts"])
    band = forecast.confidence_band(tested.drop("mw_demand"), tested).join(demand, ["zone", "ts"])
    inside = band.where(F.col("mw_demand").between(F.col("lower"), F.col("upper"))).count()
    assert 0.75 < inside / band.count() < 0.95


def test_zero_demand_is_no_percentage(spark):
    d = spark.createDataFrame([(at(0), "A", 0.0), (at(1), "A", 10.0)], "ts timestamp, zone string, mw_demand double")
    f = spark.createDataFrame(
        [(at(h), "A", 5.0, None, "r") for h in range(3)],
        "ts timestamp, zone string, predicted_mw double, actual_mw double, forecast_run_ts string",
    )
    shown = {r.ts: (r.actual_mw, r.pct_error) for r in views.forecast_vs_actual(f, d).collect()}
    assert shown == {at(0): (0.0, None), at(1): (10.0, 50.0), at(2): (None, None)}
    row = reports.forecast_accuracy(f, d).first()
    assert (row.forecast_points, row.mae_mw, row.mape_pct) == (1, 5.0, 50.0)
    kpis = panels.accuracy_kpis(f, d).first()
    assert (kpis.mae, kpis.mape) == (5.0, 50.0)
    assert panels.next_forecast_hours(f, F.lit(at(1)), zone="A").count() == 1
    assert panels.load_kpis(f, F.lit(at(1))).first().peak_predicted_24h == 5.0


def test_training_rows_are_dealt_by_their_number(spark, demand, monkeypatch):
    assert [forecast.partitions(n, 12) for n in (0, 100_000, 100_001, 6_000_000, 6_000_001)] == [1, 1, 2, 12, 24]
    monkeypatch.setattr(forecast, "LEAST_ROWS", 1000)
    cutoff = F.lit(at(24 * 18))
    key = lambda df: sorted(map(tuple, df.collect()))
    whole = forecast.direct_training_rows(demand, cutoff=cutoff)
    rows = forecast.direct_training_rows(demand, cutoff=cutoff, parts=4)
    assert key(rows) == key(whole)
    seen, build = [], forecast.build_pipeline

    class Watched:
        def __init__(self, pipeline):
            self.pipeline = pipeline

        def fit(self, df):
            seen.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
            return self.pipeline.fit(df)

    monkeypatch.setattr(forecast, "build_pipeline", lambda *a, **k: Watched(build(*a, **k)))
    _, metrics = forecast.train(whole, forecast.DIRECT_FEATURES, cutoff=cutoff, trees=2, depth=2)
    (counts,) = seen
    assert sum(counts) == metrics.first().train_rows > 5000
    assert len(counts) >= 5 and max(counts) < 2 * sum(counts) / len(counts)
