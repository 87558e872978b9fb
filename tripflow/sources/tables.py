"""Reading and writing the landed tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schema import TRIP_REQUEST_FIELDS, ZONE


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_zone_csv(spark: SparkSession, path: str):
    """The zone dimension from CSV with a declared schema, uniqueness of ``LocationID`` checked."""
    from tripflow.operators.joins import checked_zones

    return checked_zones(spark.read.schema(ZONE).option("header", True).option("mode", "FAILFAST").csv(path))


def with_row_key(spark: SparkSession, path: str, schema=None, key: str = "trip_id") -> DataFrame:
    """A table written in one go, with a unique stable bigint for each row: its file's number in the write and its
    place in that file. Both are read from the files' metadata, so no shuffle and no counting is needed."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    name = F.col("_metadata.file_name")
    part = F.regexp_extract(name, r"^part-([0-9]+)-", 1).cast("bigint")
    more = F.regexp_extract(name, r"-c([0-9]+)\.", 1).cast("bigint")  # further files of the same task
    number = F.shiftleft(part * 64 + more, 35)
    return reader.parquet(path).select("*", (number + F.col("_metadata.row_index")).alias(key))


def land_keyed(raw: DataFrame, path: str, key: str = "trip_id") -> DataFrame:
    """Write trips that have no unique key and read them back with one (an own column of that name is replaced)."""
    raw = raw.drop(key)
    raw.write.mode("errorifexists").parquet(path)
    return with_row_key(raw.sparkSession, path, raw.schema, key)


def write_zone_csv(zones: DataFrame, path: str) -> None:
    zones.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_splits(assigned: DataFrame, path: str, split_col: str = "split") -> None:
    """S3: all three splits in ONE write, partitioned by split (a split read prunes to its folder)."""
    assigned.write.mode("overwrite").partitionBy(split_col).parquet(path)


def load_split(spark: SparkSession, path: str, split: str, prepare=True, split_col: str = "split") -> DataFrame:
    """One split from the split table: it must exist, is prepared, and must not be empty."""
    from tripflow.operators.prepare import prepare_training_data
    from tripflow.sources.monthly import path_exists

    if not path_exists(spark, f"{path}/{split_col}={split}"):
        raise FileNotFoundError(f"Split not found: {path} ({split})")
    df = spark.read.parquet(path).where(F.col(split_col) == split).drop(split_col)
    out = prepare_training_data(df, keep=tuple(c for c in ("trip_id",) if c in df.columns)) if prepare else df
    if out.isEmpty():
        raise ValueError(f"Split {split!r} has no rows after preparation")
    return out


def read_trip_records(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array (or JSON lines) of trip records; string fields, validated downstream."""
    return spark.read.schema(TRIP_REQUEST_FIELDS).option("multiLine", True).json(path)


def write_metrics_json(spark: SparkSession, metrics: dict, path: str) -> None:
    """A metrics record as JSON with sorted keys (one small file)."""
    text = json.dumps(metrics, sort_keys=True, default=float)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_metrics_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
