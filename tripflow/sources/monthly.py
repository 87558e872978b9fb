"""Monthly trip files: scan a period grid, skip missing periods, union drifting schemas.

Each existing file is read on its own and conformed to the canonical raw schema
(each present column cast to its canonical type, absent ones left to
``unionByName(allowMissingColumns=True)``), so an int column in one month and a
double in the next never meets parquet schema merging. Only a *missing path* is
skipped (and reported); an unreadable file fails the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.schema import PICKUP, RAW_TRIP


@dataclass
class MonthlyScan:
    frame: DataFrame
    loaded: list[str]
    missing: list[str]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def conform(df: DataFrame, schema: T.StructType = RAW_TRIP) -> DataFrame:
    """Cast every canonical column that is present; NaN in doubles becomes null (pandas merges the two).

    Columns outside the contract are kept as they are.
    """
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name).cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            c = F.nanvl(c, F.lit(None).cast("double"))
        cols.append(c.alias(f.name))
    return df.select(*cols, *[F.col(c) for c in df.columns if c not in schema.fieldNames()])


def read_periods(spark: SparkSession, paths: dict[str, str]) -> MonthlyScan:
    """S1 + U1: union of every existing period file, all its columns kept (tagged with ``period``); error when none
    exists."""
    loaded, missing, frames = [], [], []
    for period, path in paths.items():
        if not path_exists(spark, path):
            missing.append(period)
            continue
        frames.append(conform(spark.read.parquet(path)).withColumn("period", F.lit(period)))
        loaded.append(period)
    if not frames:
        raise ValueError(f"none of the {len(paths)} requested periods has a file")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    # columns absent everywhere are still part of the contract
    for f in RAW_TRIP.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return MonthlyScan(out, loaded, missing)


def month_grid(base: str, years, months) -> dict[str, str]:
    return {f"{y}-{m:02d}": f"{base}/trips_{y}-{m:02d}.parquet" for y in years for m in months}


def write_raw(df: DataFrame, path: str) -> None:
    """The merged raw table, partitioned by pickup month so period filters prune files."""
    month = F.format_string("%04d-%02d", F.year(PICKUP), F.month(PICKUP))  # wall-clock fields, no zone
    df.withColumn("pickup_month", month).write.mode("overwrite") \
        .partitionBy("pickup_month").parquet(path)


def write_raw_sorted(df: DataFrame, path: str, order=(PICKUP,)) -> None:
    """O1: the raw table in pickup order. Ranges of the order are dealt to files and sorted inside each, so reading
    the files by name gives the whole order and no task sorts everything; null pickups come last."""
    by = [F.col(c).asc_nulls_last() for c in order]
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
