import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.operators.monitor import (
    categorical_drift,
    exact_sample,
    input_report,
    missing_share,
    monitoring_frame,
    numeric_drift,
    quality_report,
)
from tripflow.schema import INPUT_MONITORING_COLUMNS


@pytest.fixture()
def frame(spark):
    """F-D: six hourly rows; duration 10..15, prediction +0.1."""
    base = dt.datetime(2026, 1, 1)
    rows = [(1 + i % 2, base + dt.timedelta(hours=i), 1 + i % 3, 2 + i % 2, 1.0 + i % 2, None if i == 3 else 1.0,
             10.0 + i, 10.1 + i) for i in range(6)]
    df = spark.createDataFrame(rows, "VendorID bigint, lpep_pickup_datetime timestamp_ntz, PULocationID bigint, "
                                     "DOLocationID bigint, passenger_count double, trip_type double, duration double, "
                                     "prediction double")
    return monitoring_frame(df, keep=("duration", "prediction"))


def test_frame_shape_and_sentinel(frame):
    assert frame.columns[:8] == INPUT_MONITORING_COLUMNS
    types = dict(frame.dtypes)
    assert types["VendorID"] == "string" and types["passenger_count"] == "double"
    assert sorted(r.trip_type for r in frame.collect())[-1] == "__MISSING__"
    assert {r.trip_type for r in frame.collect()} == {"1.0", "__MISSING__"}


def test_self_comparison_has_no_drift(frame):
    rep = input_report(frame, frame).first()
    assert rep.input_drifted_columns_share == 0.0 and rep.input_drifted_columns_count == 0.0
    assert all(r.drift_score == 0.0 for r in categorical_drift(frame, frame).collect())
    assert all(r.drift_score == 0.0 for r in numeric_drift(frame, frame, ["duration"]).collect())


def test_quality_metrics(frame):
    q = quality_report(frame, frame).first()
    assert q.quality_rmse == pytest.approx(0.1) and q.quality_mae == pytest.approx(0.1)
    assert q.quality_mse_from_rmse == pytest.approx(0.01)
    assert q.quality_failed_tests == 0.0


def test_shift_scores_shift_over_std(spark, frame):
    shifted = frame.withColumn("duration", F.col("duration") + 2.0)
    score = numeric_drift(frame, shifted, ["duration"]).first().drift_score
    std = frame.agg(F.stddev_pop("duration")).first()[0]
    assert score == pytest.approx(2.0 / std)


def test_wasserstein_matches_direct_formula_with_many_blocks(spark):
    import random

    from tripflow.operators import ordered

    rng = random.Random(7)
    a = [round(rng.gauss(10, 3), 3) for _ in range(400)]
    b = [round(rng.gauss(11, 2), 3) for _ in range(300)]
    ra = spark.createDataFrame([(x,) for x in a], "duration double")
    rb = spark.createDataFrame([(x,) for x in b], "duration double")
    old = ordered.BLOCK_ROWS
    ordered.BLOCK_ROWS = 50  # many blocks
    try:
        got = numeric_drift(ra, rb, ["duration"]).first().drift_score
    finally:
        ordered.BLOCK_ROWS = old
    # direct: integral of |Fa - Fb|
    xs = sorted(set(a) | set(b))
    w = 0.0
    for x, nx in zip(xs, xs[1:]):
        fa = sum(v <= x for v in a) / len(a)
        fb = sum(v <= x for v in b) / len(b)
        w += abs(fa - fb) * (nx - x)
    mu = sum(a) / len(a)
    sd = (sum((v - mu) ** 2 for v in a) / len(a)) ** 0.5
    assert got == pytest.approx(w / sd, rel=1e-9)


def test_missing_share(frame):
    r = missing_share(frame).first()
    assert r.missing_cells == 0  # the null trip type became the sentinel
    assert r.missing_share == 0.0


def test_exact_sample_is_stable(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 17)
    a = {r.id for r in exact_sample(df, 100, 42).collect()}
    b = {r.id for r in exact_sample(df.repartition(5), 100, 42).collect()}
    assert len(a) == 100 and a == b
    assert exact_sample(df, 5000, 42).count() == 1000


def test_empty_or_all_missing_current_side_does_not_fail(spark, frame):
    """An empty or all-missing side does not fail the report, and it is never flagged as drift."""
    missing = frame.withColumn("passenger_count", F.lit(None).cast("double"))
    r = {x.column: x for x in numeric_drift(frame, missing, ["passenger_count"]).collect()}
    assert r["passenger_count"].drift_detected == 0.0
    empty = frame.limit(0)
    assert categorical_drift(frame, empty).count() == 6
    rep = input_report(frame, missing).first()
    assert rep.input_missing_value_share == pytest.approx(6 / 48)


def test_exact_sample_orders_only_what_is_left(spark):
    """The threshold is found from counts: the limit sits above a filter on the hash, and results equal a full sort."""
    from tripflow.operators import monitor

    df = spark.range(20_000).withColumnRenamed("id", "k")
    want = [r.k for r in df.withColumn("h", monitor.sample_hash(7, ["k"])).orderBy("h", "k").limit(50).collect()]
    got = monitor.exact_sample(df, 50, 7)
    assert sorted(r.k for r in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # what reaches the last ordering has been cut to the least rows of each partition, in one scan
    assert "Limit" in plan and "MapInArrow" in plan.split("Limit")[-1] and plan.count("Range (") == 1
    assert monitor.exact_sample(df, 19_999, 7).count() == 19_999 and monitor.exact_sample(df, 20_000, 7).count() == 20_000
