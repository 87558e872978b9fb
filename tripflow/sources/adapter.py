"""Adapter: the driver's generic tables -> the trip engine's inputs.

``events`` plays the raw trip table (one trip per event, ``event_id`` as the
unique tie-break key ``trip_id``); ``nation`` joined with ``region`` plays the
zone dimension. Everything here is a projection (no shuffle) except the zone
join, which is a dimension-only join. The same derivations are spelled in SQL in
``tripflow/oracle.py`` so DuckDB can check every query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.timefeat import format_ntz, format_second
from tripflow.schema import DROPOFF, PICKUP
from tripflow.sources.tables import read_table

TRIP_KEY = "trip_id"


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trips with every cleaning branch exercised (nulls, zero distance, negative fares, long trips)."""
    eid = F.col("event_id")
    k = _k()
    seconds = F.round(F.col("value") * 60, 6).cast("decimal(18,6)")
    return events.select(
        eid.alias(TRIP_KEY),
        (F.lit(1) + F.col("user_id") % 2).cast("bigint").alias("VendorID"),
        F.col("ts").alias(PICKUP),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias(DROPOFF),
        (F.col("user_id") % 25).cast("bigint").alias("PULocationID"),
        (k % 27).cast("bigint").alias("DOLocationID"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(F.lit(1) + eid % 6).cast("double").alias("passenger_count"),
        k.cast("double").alias("trip_distance"),
        F.when(eid % 5 == 0, F.lit(None)).otherwise(F.lit(1) + F.floor((eid % 3) / 2)).cast("double").alias("trip_type"),
        (eid % 20 - 1).cast("double").alias("fare_amount"),
    )


def landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with all columns of a trip file: the payment ones too, and one outside the contract."""
    trips = raw_trips(spark, sf_dir)
    eid, fare = F.col(TRIP_KEY), F.col("fare_amount")
    return trips.select(
        "*", (eid % 3).cast("double").alias("extra"), F.lit(0.5).alias("mta_tax"),
        F.when(eid % 4 != 0, eid % 9).cast("double").alias("tip_amount"), (eid % 2).cast("double").alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"), (fare + eid % 3).cast("double").alias("total_amount"),
        (eid % 5 + 1).cast("double").alias("payment_type"), F.lit(2.75).alias("congestion_surcharge"),
        F.lit(0.75).alias("cbd_congestion_fee"), F.lit(None).cast("double").alias("ehail_fee"),
        F.when(eid % 6 == 0, "Y").otherwise("N").alias("store_and_fwd_flag"), (eid % 7).cast("double").alias("RatecodeID"),
        F.concat(F.lit("h"), (eid % 8).cast("string")).alias("hvfhs_license"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, sf_dir, "events"))


def zones_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        key.cast("bigint").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        # exact decimal arithmetic, then one rounding to double (same as the SQL oracle)
        F.expr("CAST(40.5 + 0.02 * n_nationkey AS DOUBLE)").alias("latitude"),
        F.expr("CAST(-74.2 + 0.015 * n_nationkey AS DOUBLE)").alias("longitude"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones_from_nation(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving request log (A15): one request per event."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    latency = (F.col("value") / 1000.0).cast("double")
    started = F.col("ts")
    ended = started + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.round(latency, 6).cast("decimal(18,6)"))
    return ev.select(
        eid.alias("request_id"),
        F.element_at(F.array(F.lit(1), F.lit(10), F.lit(100)), (eid % 3 + 1).cast("int")).alias("batch_size"),
        F.element_at(F.array(F.lit(1), F.lit(5), F.lit(10)), (F.floor(eid / 3) % 3 + 1).cast("int")).alias("concurrency"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        started.alias("started_at"),
        ended.alias("ended_at"),
        latency.alias("latency_s"),
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered model versions (W2): model per event type, version = event id, test rmse = value."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        F.col("event_type").alias("model"),
        eid.alias("version"),
        F.when(eid % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("rmse_test"),
    )


def tuning_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuning trials (O4): study per user, trial = event id, validation rmse = value."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("study"),
        F.col("event_id").alias("trial"),
        F.col("value").alias("rmse_val"),
        (F.col("event_id") % 7 + 3).alias("max_depth"),
        F.get_json_object(F.col("props"), "$.k").cast("int").alias("min_child_weight"),
    )


REQUEST_SIZE = 10


def request_trip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of ten consecutive trips (``event_id DIV 10``); ids in order. Groups are bounded by 10 rows."""
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.floor(F.col("event_id") / REQUEST_SIZE).alias("request_id")).agg(
        F.array_sort(F.collect_list(F.col("event_id"))).alias("trip_ids"))


def _json_value(text, quoted=False):
    return F.concat(F.lit('"'), text, F.lit('"')) if quoted else text


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests as JSON text (S7): ten consecutive trips per request, built from ``events``.

    Trips exercise the contract: ids quoted as strings (``event_id % 13 = 0``), a fractional vendor
    (``% 101``), one with a type suffix (``% 103``), one beyond 2**53 (``% 107``), unpadded datetimes (``% 89``), a wrong datetime format (``% 97``) and absent optional
    fields (nulls are omitted).
    """
    t = trips_from_events(read_table(spark, sf_dir, "events"))
    eid = F.col(TRIP_KEY)
    ts = F.col(PICKUP)
    pickup = (F.when(eid % 97 == 0, format_ntz(ts, "%3$02d/%2$02d/%1$04d"))
              .when(eid % 89 == 0, format_ntz(ts, "%d-%d-%d %d:%d:%d"))
              .otherwise(format_second(ts)))
    vendor = (F.when(eid % 101 == 0, F.lit("1.5"))
              .when(eid % 103 == 0, F.lit('"2d"'))
              .when(eid % 107 == 0, F.lit("9007199254740993"))
              .when(eid % 13 == 0, F.concat(F.lit('"'), F.col("VendorID").cast("string"), F.lit('"')))
              .otherwise(F.col("VendorID").cast("string")))
    parts = [
        F.concat(F.lit('"VendorID":'), vendor),
        F.concat(F.lit('"lpep_pickup_datetime":"'), pickup, F.lit('"')),
        F.concat(F.lit('"PULocationID":'), F.col("PULocationID").cast("string")),
        F.concat(F.lit('"DOLocationID":'), F.col("DOLocationID").cast("string")),
        F.concat(F.lit('"passenger_count":'), F.col("passenger_count").cast("string")),  # null -> omitted
        F.concat(F.lit('"trip_type":'), F.col("trip_type").cast("string")),
    ]
    trip_json = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    grouped = t.groupBy(F.floor(eid / REQUEST_SIZE).alias("request_id")).agg(
        F.array_sort(F.collect_list(F.struct(eid.alias("k"), trip_json.alias("j")))).alias("items"))
    body = F.concat(F.lit('{"trips":['), F.array_join(F.transform("items", lambda x: x["j"]), ","), F.lit("]}"))
    return grouped.select("request_id", body.alias("body"))
