"""Error analytics over a scored frame.

Input: a DataFrame with ``duration`` (actual) and ``prediction``. All metrics are
map-side partial aggregates: a hot segment is pre-aggregated in every task, so
skew never concentrates raw rows in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import with_sentinel
from tripflow.functions.timefeat import hour
from tripflow.operators.joins import Dimension, pickup_borough
from tripflow.schema import FEATURE_MISSING, PICKUP, SEGMENT_COLUMNS, SEGMENT_MIN_ROWS, UNKNOWN_BOROUGH


def residual(actual: str = "duration", predicted: str = "prediction"):
    """Actual - predicted."""
    return F.col(actual) - F.col(predicted)


def error_aggs(actual: str = "duration", predicted: str = "prediction"):
    e = residual(actual, predicted)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
    ]


def split_metrics(scored: DataFrame, split_col: str = "split") -> DataFrame:
    """A5: rmse and mae per split, one aggregate for all splits."""
    return scored.groupBy(split_col).agg(*error_aggs())


def segment_frame(scored: DataFrame, zones: Dimension) -> DataFrame:
    """Segment keys as strings: hour, pickup borough (``Unknown`` when not in the lookup), trip type."""
    with_borough = pickup_borough(scored, zones, UNKNOWN_BOROUGH)
    return with_borough.select(
        hour(F.col(PICKUP)).cast("string").alias("pickup_hour"),
        F.col("PU_Borough"),
        with_sentinel(F.col("trip_type"), FEATURE_MISSING).alias("trip_type"),
        F.col("duration"),
        F.col("prediction"),
    )


def segment_metrics(scored: DataFrame, zones: Dimension, minimum_rows: int = SEGMENT_MIN_ROWS) -> DataFrame:
    """Error per segment for three keys in ONE pass (grouping sets), keeping groups of ``minimum_rows``+ rows.

    Output ``(segment_name, segment, rows, rmse, mae)`` ordered by segment_name, rmse desc (O3).
    """
    seg = segment_frame(scored, zones)
    grouped = seg.groupingSets([[c] for c in SEGMENT_COLUMNS], *SEGMENT_COLUMNS).agg(
        *error_aggs(), *[F.grouping(c).alias(f"__g_{c}") for c in SEGMENT_COLUMNS]
    )
    name = F.when(F.col(f"__g_{SEGMENT_COLUMNS[0]}") == 0, F.lit(SEGMENT_COLUMNS[0]))
    for c in SEGMENT_COLUMNS[1:]:
        name = name.when(F.col(f"__g_{c}") == 0, F.lit(c))
    return (
        grouped.where(F.col("rows") >= minimum_rows)
        .select(name.alias("segment_name"), F.coalesce(*[F.col(c) for c in SEGMENT_COLUMNS]).alias("segment"),
                "rows", "rmse", "mae")
        .orderBy("segment_name", F.desc("rmse"), "segment")
    )


def axis_limits(scored: DataFrame) -> DataFrame:
    """Common axis range of actual and predicted values."""
    return scored.agg(
        F.least(F.min("duration"), F.min("prediction")).alias("axis_min"),
        F.greatest(F.max("duration"), F.max("prediction")).alias("axis_max"),
    )


def residual_histogram(scored: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width residual histogram; empty bins are present with count 0.

    Two small jobs: a global min/max, then a grouped count of bucket ids. Bin i
    covers [lo + (i-1)w, lo + i*w), the last bin is closed on the right.
    """
    spark = scored.sparkSession
    res = scored.select(residual().alias("r"))
    bounds = res.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return all_bins.select("bin", F.lit(None).cast("double").alias("bin_start"),
                               F.lit(None).cast("double").alias("bin_end"), F.lit(0).cast("bigint").alias("count"))
    if hi == lo:
        bucket = F.lit(1)
    else:
        bucket = F.least(F.floor((F.col("r") - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)) + 1, F.lit(bins))
    counts = res.groupBy(bucket.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / bins if hi != lo else 0.0
    return (
        all_bins.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_end"),
            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        )
        .orderBy("bin")
    )
