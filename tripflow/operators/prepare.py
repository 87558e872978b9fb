"""Training-data preparation (P1-P9): duration, cleaning filters, leakage removal, input contract.

Everything is a narrow projection + filter: no shuffle. The distance and fare
predicates reach the parquet scan; the duration bound filters a derived value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.timefeat import as_timestamp, to_second, wall_diff_micros
from tripflow.schema import (
    DROPOFF,
    LEAKAGE_AND_PAYMENT_COLUMNS,
    MAX_DURATION_MINUTES,
    MAX_TRIP_DISTANCE,
    MODEL_INPUT_COLUMNS,
    PICKUP,
)


def require_columns(df: DataFrame, required, what: str = "model inputs not in the data") -> None:
    """P5: fail before any job with the sorted missing names."""
    missing = set(required).difference(df.columns)
    if missing:
        raise ValueError(f"{what}: {sorted(missing)}")


def duration_minutes(pickup, dropoff):
    """Wall-clock difference in minutes, from the fields (no session zone, so DST never shifts it)."""
    return wall_diff_micros(pickup, dropoff).cast("double") / F.lit(1e6) / F.lit(60.0)


def clean_trip_filter(df: DataFrame, duration_col: str = "duration"):
    """P2-P4 as one predicate. NaN >= 0 is true in Spark, so the fare rule excludes NaN explicitly."""
    dist = F.col("trip_distance")
    cond = (dist > 0) & (dist <= MAX_TRIP_DISTANCE) & ~F.isnan(dist)
    dur = F.col(duration_col)
    cond = cond & (dur > 0) & (dur <= MAX_DURATION_MINUTES)
    if "fare_amount" in df.columns:
        fare = F.col("fare_amount")
        cond = cond & (fare >= 0) & ~F.isnan(fare)
    return cond


def drop_leakage(df: DataFrame) -> DataFrame:
    """What is only known after the trip, by the fixed list."""
    return df.drop(*LEAKAGE_AND_PAYMENT_COLUMNS, DROPOFF, "trip_distance")


def prepare_training_data(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw trips -> model inputs (ordered contract) + ``duration`` (+ ``keep`` pass-through keys).

    Pickup is truncated to whole seconds, exactly what the reference's string contract keeps.
    """
    require_columns(raw, [PICKUP, DROPOFF, "trip_distance"], "columns needed for cleaning are not in the data")
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    pickup = as_timestamp(F.col(PICKUP), types[PICKUP])
    dropoff = as_timestamp(F.col(DROPOFF), types[DROPOFF])
    df = raw.withColumn("duration", duration_minutes(pickup, dropoff)).withColumn(PICKUP, pickup)
    df = df.where(clean_trip_filter(df))
    require_columns(df, MODEL_INPUT_COLUMNS)
    df = drop_leakage(df)
    out = [F.col(c) for c in MODEL_INPUT_COLUMNS]
    out[1] = to_second(F.col(PICKUP)).alias(PICKUP)
    return df.select(*out, F.col("duration").cast("double").alias("duration"), *[F.col(c) for c in keep])


def select_model_inputs(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Unlabelled path (serving-shaped batches): the six inputs, pickup parsed and truncated."""
    require_columns(raw, MODEL_INPUT_COLUMNS, "serving fields not in the data")
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    pickup = to_second(as_timestamp(F.col(PICKUP), types[PICKUP])).alias(PICKUP)
    cols = [pickup if c == PICKUP else F.col(c) for c in MODEL_INPUT_COLUMNS]
    return raw.select(*cols, *[F.col(c) for c in keep])
