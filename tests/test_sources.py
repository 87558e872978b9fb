import uuid

import pytest
from pyspark.sql import functions as F

from tripflow.functions.columns import signature_cast
from tripflow.session import scratch_path
from tripflow.sources.monthly import month_grid, read_periods, write_raw


def test_union_of_drifting_months(spark, labelled):
    base = scratch_path(spark, f"test-months-{uuid.uuid4().hex}")
    grid = month_grid(base, [2026], [1, 2, 3])
    labelled.limit(3).write.parquet(grid["2026-01"])
    labelled.drop("fare_amount").withColumn("passenger_count", F.col("passenger_count").cast("int")) \
        .withColumn("VendorID", F.col("VendorID").cast("double")).write.parquet(grid["2026-02"])
    scan = read_periods(spark, grid)
    assert scan.loaded == ["2026-01", "2026-02"] and scan.missing == ["2026-03"]
    assert scan.frame.count() == 9
    types = dict(scan.frame.dtypes)
    assert types["passenger_count"] == "double" and types["VendorID"] == "bigint"
    assert scan.frame.where("period = '2026-02' AND fare_amount IS NOT NULL").count() == 0
    write_raw(scan.frame.drop("period"), f"{base}/raw")
    assert spark.read.parquet(f"{base}/raw").where("pickup_month = '2026-02'").count() == 9


def test_all_months_missing_is_an_error(spark):
    base = scratch_path(spark, f"test-none-{uuid.uuid4().hex}")
    with pytest.raises(ValueError, match="requested periods has a file"):
        read_periods(spark, month_grid(base, [2026], [1]))


def test_signature_cast(spark):
    df = spark.createDataFrame([("2", "74.0", "42", "1", "x")],
                               "VendorID string, PULocationID string, DOLocationID string, passenger_count string, "
                               "trip_type string")
    r = signature_cast(df).first()
    assert (r.VendorID, r.PULocationID, r.passenger_count, r.trip_type) == (2, 74, 1.0, None)
    bad = spark.createDataFrame([("abc", "1", "1", None, None)], df.schema)
    with pytest.raises(Exception):
        signature_cast(bad).collect()


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert set(df.columns) == {"segment_name", "segment", "rows", "rmse", "mae"}
    df.collect()
    assert set(entry.oracle_sql()).issubset(entry.queries())


def test_columns_outside_the_contract_are_kept(spark):
    base = scratch_path(spark, f"test-extra-{uuid.uuid4().hex}")
    spark.createDataFrame([(1, 5, "h1")], "VendorID int, tip_amount int, license string").write.parquet(f"{base}/a")
    spark.createDataFrame([(2, float("nan"))], "VendorID bigint, tip_amount double").write.parquet(f"{base}/b")
    rows = {r.VendorID: r for r in read_periods(spark, {"a": f"{base}/a", "b": f"{base}/b"}).frame.collect()}
    assert (rows[1].tip_amount, rows[1].license, rows[1].period) == (5.0, "h1", "a")
    assert (rows[2].tip_amount, rows[2].license, rows[2].total_amount) == (None, None, None)
