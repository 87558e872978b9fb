"""Dimension joins with a checked broadcast.

A side is hinted for broadcast only after its row count is known to be under a
limit; beyond it the join is left to the optimizer (sort-merge / AQE), so a
dimension that grows with the data never gets shipped whole to every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.geo import haversine_miles
from tripflow.functions.columns import same_value_flag

BROADCAST_MAX_ROWS = 2_000_000


class Dimension:
    """A small table plus its checked size. ``rows`` is computed once, or passed when known."""

    def __init__(self, df: DataFrame, rows: int | None = None, max_rows: int = BROADCAST_MAX_ROWS):
        self.df = df
        self._rows = rows
        self.max_rows = max_rows

    @property
    def rows(self) -> int:
        if self._rows is None:
            self._rows = self.df.count()
        return self._rows

    @property
    def broadcastable(self) -> bool:
        return self.rows <= self.max_rows

    def side(self, df: DataFrame | None = None) -> DataFrame:
        frame = self.df if df is None else df
        return F.broadcast(frame) if self.broadcastable else frame


def checked_zones(zones: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> Dimension:
    """S5 contract: ``LocationID`` must be unique (a duplicate would fan rows out). One job checks both."""
    row = zones.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("LocationID").alias("d"),
                    F.count_if(F.col("LocationID").isNull()).alias("z")).first()
    if row["n"] != row["d"] + row["z"] or row["z"]:
        raise ValueError("Zone lookup must have one row per non-null LocationID")
    return Dimension(zones, rows=row["n"], max_rows=max_rows)


def enrich_zones(df: DataFrame, zones: Dimension, with_zone_name: bool = True) -> DataFrame:
    """J1 + J2 + F5 + F8: pickup and dropoff zone columns, haversine distance, same-borough flag."""
    z = zones.df
    pu = z.select(
        F.col("LocationID").alias("__pu_id"),
        F.col("Borough").alias("PU_Borough"),
        *([F.col("Zone").alias("PU_Zone")] if with_zone_name else []),
        F.col("latitude").alias("PU_lat"),
        F.col("longitude").alias("PU_long"),
    )
    do = z.select(
        F.col("LocationID").alias("__do_id"),
        F.col("Borough").alias("DO_Borough"),
        *([F.col("Zone").alias("DO_Zone")] if with_zone_name else []),
        F.col("latitude").alias("DO_lat"),
        F.col("longitude").alias("DO_long"),
    )
    out = df.join(zones.side(pu), F.col("PULocationID") == F.col("__pu_id"), "left").drop("__pu_id")
    out = out.join(zones.side(do), F.col("DOLocationID") == F.col("__do_id"), "left").drop("__do_id")
    return out.withColumn(
        "estimated_distance_miles", haversine_miles(F.col("PU_lat"), F.col("PU_long"), F.col("DO_lat"), F.col("DO_long"))
    ).withColumn("same_borough", same_value_flag(F.col("PU_Borough"), F.col("DO_Borough")))


def pickup_borough(df: DataFrame, zones: Dimension, unknown: str) -> DataFrame:
    """Pickup borough with a fallback label for unknown zones."""
    pu = zones.df.select(F.col("LocationID").alias("__pu_id"), F.col("Borough").alias("__pu_borough"))
    return (
        df.join(zones.side(pu), F.col("PULocationID") == F.col("__pu_id"), "left")
        .withColumn("PU_Borough", F.coalesce(F.col("__pu_borough"), F.lit(unknown)))
        .drop("__pu_id", "__pu_borough")
    )
