import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import local_session

    s = local_session(cpus=4, shuffle_partitions=4, app="tripflow-tests")
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


@pytest.fixture()
def zones(spark):
    from tripflow.operators.joins import checked_zones

    rows = [(1, "Manhattan", "A", 40.75, -73.99), (2, "Queens", "B", 40.76, -73.90), (3, "Brooklyn", "C", 40.65, -73.95)]
    df = spark.createDataFrame(rows, "LocationID bigint, Borough string, Zone string, latitude double, longitude double")
    return checked_zones(df)


RAW_SCHEMA = ("VendorID bigint, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
              "PULocationID bigint, DOLocationID bigint, passenger_count double, trip_distance double, "
              "trip_type double, fare_amount double")


@pytest.fixture()
def labelled(spark):
    """F-A: six raw trips, 2026-02-01..."""
    rows = [
        (1, ts("2026-02-01 08:00:00"), ts("2026-02-01 08:11:00"), 1, 2, 1.0, 2.0, 1.0, 10.0),
        (2, ts("2026-02-01 09:00:00"), ts("2026-02-01 09:12:00"), 2, 3, None, 3.0, None, 11.0),
        (1, ts("2026-02-02 10:00:00"), ts("2026-02-02 10:13:00"), 1, 3, 2.0, 2.5, 2.0, 12.0),
        (2, ts("2026-02-03 17:00:00"), ts("2026-02-03 17:14:00"), 3, 1, 1.0, 4.0, 1.0, 13.0),
        (1, ts("2026-02-07 18:00:00"), ts("2026-02-07 18:20:00"), 2, 2, 1.0, 1.0, 1.0, 9.0),
        (2, ts("2026-02-08 07:30:00"), ts("2026-02-08 07:45:00"), 3, 99, 3.0, 5.0, 1.0, 14.0),
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)
