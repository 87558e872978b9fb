"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import ensure_checkpoint_dir

#: A word of the corpus contracts: a run of characters other than space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame) -> DataFrame:
    """The documents contract, whatever other columns the input has."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
    )


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table under the shared checkpoint folder and read it back: cuts lineage, survives lost executors.

    Unlike ``checkpoint()`` the files are compressed and the optimizer sees their size.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, size: Column, per_part: int, least: int | None = None) -> int:
    """How many partitions hold ``sum(size)`` at ``per_part`` each, at least the session's shuffle partitions."""
    total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    floor = least if least is not None else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-int(total) // per_part))
