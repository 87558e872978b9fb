"""Scorers: anything that maps a frame of model inputs to the same frame plus ``prediction``.

The trained model (``plans/train.py``) is one; these two are SQL-expressible and
serve tests and oracle-checked queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.geo import haversine_miles
from tripflow.operators.joins import Dimension


class ConstantScorer:
    def __init__(self, value: float = 12.5):
        self.value = float(value)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.value))


class DistanceFormulaScorer:
    """prediction = intercept + slope * zone-centroid distance (fallback when a zone is unknown)."""

    def __init__(self, zones: Dimension, intercept: float = 10.0, slope: float = 2.0, fallback: float = 1.0):
        self.zones = zones
        self.intercept, self.slope, self.fallback = float(intercept), float(slope), float(fallback)

    def transform(self, df: DataFrame) -> DataFrame:
        z = self.zones.df
        pu = z.select(F.col("LocationID").alias("__pu"), F.col("latitude").alias("__pu_lat"),
                      F.col("longitude").alias("__pu_lon"))
        do = z.select(F.col("LocationID").alias("__do"), F.col("latitude").alias("__do_lat"),
                      F.col("longitude").alias("__do_lon"))
        out = df.join(self.zones.side(pu), F.col("PULocationID") == F.col("__pu"), "left")
        out = out.join(self.zones.side(do), F.col("DOLocationID") == F.col("__do"), "left")
        dist = haversine_miles(F.col("__pu_lat"), F.col("__pu_lon"), F.col("__do_lat"), F.col("__do_lon"))
        pred = F.lit(self.intercept) + F.lit(self.slope) * F.coalesce(dist, F.lit(self.fallback))
        return out.withColumn("prediction", pred).drop("__pu", "__pu_lat", "__pu_lon", "__do", "__do_lat", "__do_lon")
