import math

from pyspark.sql import functions as F

from conftest import RAW_SCHEMA, ts
from tripflow.operators.prepare import prepare_training_data, require_columns
from tripflow.schema import MODEL_INPUT_COLUMNS


def test_drops_negative_duration_and_keeps_contract(spark):
    rows = [
        (1, ts("2026-02-01 10:00:00"), ts("2026-02-01 10:15:00"), 1, 2, 1.0, 2.0, 1.0, 10.0),
        (2, ts("2026-02-01 11:00:00"), ts("2026-02-01 10:50:00"), 2, 3, 1.0, 3.0, 1.0, 10.0),
    ]
    out = prepare_training_data(spark.createDataFrame(rows, RAW_SCHEMA))
    assert out.columns == MODEL_INPUT_COLUMNS + ["duration"]
    assert [r.duration for r in out.collect()] == [15.0]


def test_filter_edges(spark):
    base = ts("2026-02-01 10:00:00")
    import datetime as dt

    def row(dist, minutes, fare):
        return (1, base, base + dt.timedelta(minutes=minutes), 1, 2, 1.0, dist, 1.0, fare)

    cases = {
        "dist0": (row(0.0, 10, 1.0), False), "dist100": (row(100.0, 10, 1.0), True),
        "dist_over": (row(100.0001, 10, 1.0), False), "dist_null": (row(None, 10, 1.0), False),
        "dist_nan": (row(float("nan"), 10, 1.0), False), "dur0": (row(1.0, 0, 1.0), False),
        "dur300": (row(1.0, 300, 1.0), True), "dur_over": (row(1.0, 300.01, 1.0), False),
        "fare_neg": (row(1.0, 10, -0.01), False), "fare0": (row(1.0, 10, 0.0), True),
        "fare_nan": (row(1.0, 10, float("nan")), False), "fare_null": (row(1.0, 10, None), False),
    }
    for name, (r, keep) in cases.items():
        n = prepare_training_data(spark.createDataFrame([r], RAW_SCHEMA)).count()
        assert n == (1 if keep else 0), name


def test_fare_column_is_optional(spark):
    rows = [(1, ts("2026-02-01 10:00:00"), ts("2026-02-01 10:15:00"), 1, 2, 1.0, 2.0, 1.0, -5.0)]
    df = spark.createDataFrame(rows, RAW_SCHEMA).drop("fare_amount")
    assert prepare_training_data(df).count() == 1


def test_missing_inputs_raise_sorted(spark, labelled):
    import pytest

    with pytest.raises(ValueError, match=r"\['PULocationID', 'VendorID'\]"):
        require_columns(labelled.drop("VendorID", "PULocationID"), MODEL_INPUT_COLUMNS)


def test_durations_and_truncation(spark, labelled):
    out = prepare_training_data(labelled).orderBy("lpep_pickup_datetime").collect()
    assert [r.duration for r in out][:4] == [11.0, 12.0, 13.0, 14.0]
    frac = spark.createDataFrame([(1, ts("2026-02-01 10:00:00"), ts("2026-02-01 10:15:00"), 1, 2, 1.0, 2.0, 1.0, 1.0)],
                                 RAW_SCHEMA).withColumn("lpep_pickup_datetime",
                                                        F.col("lpep_pickup_datetime") + F.expr("INTERVAL 0.7 SECONDS"))
    r = prepare_training_data(frac).first()
    assert str(r.lpep_pickup_datetime) == "2026-02-01 10:00:00"
    assert math.isclose(r.duration, 15.0 - 0.7 / 60, rel_tol=1e-12)


def test_haversine_is_positive_and_plausible(spark):
    from tripflow.functions.geo import haversine_miles

    d = spark.range(1).select(haversine_miles(F.lit(40.75), F.lit(-73.99), F.lit(40.65), F.lit(-73.95)).alias("d")).first().d
    assert 6.5 < d < 7.5


def test_wall_clock_survives_a_dst_session_zone(spark):
    """Pickup truncation, formatting and durations use wall-clock fields, whatever the session zone."""
    from tripflow.functions.timefeat import format_second

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(1, ts("2024-03-10 02:30:15"), ts("2024-03-10 03:10:15"), 1, 2, 1.0, 2.0, 1.0, 1.0)]
        out = prepare_training_data(spark.createDataFrame(rows, RAW_SCHEMA))
        r = out.select(format_second(F.col("lpep_pickup_datetime")).alias("p"), "duration").first()
        assert (r.p, r.duration) == ("2024-03-10 02:30:15", 40.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
