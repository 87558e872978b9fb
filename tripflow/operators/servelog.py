"""Serving analytics (A15 latency profile) and batch tiling.

A15 needs exact percentiles per (batch size, concurrency). ``percentile`` keeps
a value->count map per group in one task; a hot case would hold a third of all
values there. Instead: count per (case, value) (map-side combined), one blocked
ordered scan for the running count, then one aggregate per case picks the two
ranks around each percentile position and interpolates linearly (the usual (n-1)*p definition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.timefeat import wall_diff_micros
from tripflow.operators.joins import Dimension
from tripflow.operators.ordered import Running, ordered_scan

PERCENTILES = (("p50", 0.50), ("p95", 0.95), ("p99", 0.99))


def exact_percentiles(df: DataFrame, groups: list[str], value: str, percentiles=PERCENTILES) -> DataFrame:
    """(groups..., one column per named percentile) with linear interpolation between closest ranks."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__c"))
    sizes = counts.groupBy(*groups).agg(F.sum("__c").alias("__n"))
    scanned = ordered_scan(counts, groups, value, [Running("__cum", F.col("__c"))])
    position = lambda p: (F.col("__n") - 1) * F.lit(p)
    # one row per case; checked before broadcast
    ranked = scanned.join(Dimension(sizes).side(), groups, "inner")
    holds = lambda rank: (rank >= F.col("__cum") - F.col("__c")) & (rank < F.col("__cum"))
    ends = []
    for name, p in percentiles:
        lo = F.floor(position(p))
        ends += [F.max(F.when(holds(lo), F.col(value))).alias(f"__lo_{name}"),
                 F.max(F.when(holds(F.least(lo + 1, F.col("__n") - 1)), F.col(value))).alias(f"__hi_{name}")]
    picked = ranked.groupBy(*groups).agg(F.first("__n").alias("__n"), *ends)
    share = lambda p: position(p) - F.floor(position(p))
    return picked.select(*groups, *[
        (F.col(f"__lo_{n}") + share(p) * (F.col(f"__hi_{n}") - F.col(f"__lo_{n}"))).alias(n) for n, p in percentiles])


def latency_profile(log: DataFrame) -> DataFrame:
    """Per (batch_size, concurrency): requests, success rate, requests/s, latency p50/p95/p99 in ms."""
    keys = ["batch_size", "concurrency"]
    case = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg((F.col("status") == 200).cast("double")).alias("success_rate"),
        (wall_diff_micros(F.min("started_at"), F.max("ended_at")) / F.lit(1e6)).alias("elapsed_s"),
    )
    pct = exact_percentiles(log, keys, "latency_s")
    out = case.join(Dimension(pct).side(), keys, "left")  # one row per case; broadcast after a size check
    return out.select(
        *keys, "request_count", "success_rate",
        F.when(F.col("elapsed_s") > 0, F.col("request_count") / F.col("elapsed_s")).alias("requests_per_second"),
        *[(F.col(n) * 1000.0).alias(f"latency_ms_{n}") for n, _ in PERCENTILES],
    )


def tile_array(arr, size: int):
    """O7 on an array column: ``size`` elements taken cyclically (element i = arr[i mod len])."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                       lambda i: F.element_at(arr, (i % F.size(arr) + 1).cast("int")))
