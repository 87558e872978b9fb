"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id that it is linked to) of every vertex of ``edges`` (a, b: long).

    Rounds of hooking: every vertex follows its smallest neighbour, chains are shortened eightfold, and the edges are
    rewritten between what is left until none remains. Each round is a few joins and partial aggregates over tables
    that shrink; a hub's edges are pre-aggregated, and nothing is collected.
    """
    def between(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    members = materialise(ids.withColumn("component", F.col("id")), "members")
    left = materialise(between(edges), "edges")
    while not left.isEmpty():
        hooks = left.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("to"))
        for _ in range(3):  # where it hooks to may hook on
            on = hooks.select(F.col("id").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(on, "to", "left").select("id", F.coalesce("further", "to").alias("to"))
        hooks = materialise(hooks, "hooks")

        def moved(df: DataFrame, column: str) -> DataFrame:
            to = hooks.select(F.col("id").alias(column), F.col("to").alias("_to"))
            return df.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

        members = materialise(moved(members, "component").select("id", "component"), "members")
        left = materialise(between(moved(moved(left, "a"), "b")), "edges")
    return members
