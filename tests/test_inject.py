from pyspark.sql import functions as F

from kilowatch.operators.inject import detection_quality, inject_anomalies
from kilowatch.operators.scoring import score_batch


def readings(spark, n=4000):
    return spark.range(n).select(
        F.format_string("M%d", F.col("id") % 7).alias("meter_id"),
        F.col("id").alias("reading_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"),
        (F.lit(0.5) + (F.col("id") % 11) / 100.0).alias("kwh_hourly"),
        F.lit(0.4).alias("kwh_max"),
    )


def test_injection_does_not_depend_on_partitioning(spark):
    df = readings(spark)
    pick = lambda d: sorted(map(tuple, d.select("reading_id", "kwh_hourly", "injected_anomaly").collect()))
    assert pick(inject_anomalies(df.repartition(1))) == pick(inject_anomalies(df.repartition(5, "reading_id")))
    assert pick(inject_anomalies(df)) != pick(inject_anomalies(df, seed=1))


def test_injected_shares_and_values(spark):
    out = inject_anomalies(readings(spark), rate=20.0)
    counts = {r.injected_anomaly: r["count"] for r in out.groupBy("injected_anomaly").count().collect()}
    assert 180 < counts["sudden_spike"] < 300 and 180 < counts["flatline"] < 300
    assert 110 < counts["sustained_elevation"] < 210
    assert out.where("injected_anomaly = 'flatline'").select("kwh_hourly", "kwh_max").distinct().collect() == [(0.001, 0.001)]
    factors = out.where("injected_anomaly = 'sudden_spike'").join(
        readings(spark).withColumnRenamed("kwh_hourly", "old").select("reading_id", "old"), "reading_id"
    ).selectExpr("min(kwh_hourly / old)", "max(kwh_hourly / old)").first()
    assert 2.99 < factors[0] < 3.5 and 9.5 < factors[1] < 10.01


def test_injection_can_be_off(spark):
    out = inject_anomalies(readings(spark, 50), enabled=False)
    assert out.where("injected_anomaly <> 'none'").count() == 0


def test_quality_adds_up(spark):
    scored = score_batch(inject_anomalies(readings(spark), rate=2.0))
    q = detection_quality(scored).first()
    assert q.true_positive + q.false_negative == scored.where("injected_anomaly <> 'none'").count()
    assert q.true_positive + q.false_positive == scored.where("is_anomaly").count()
    assert q.precision == round(q.true_positive / (q.true_positive + q.false_positive), 4)
