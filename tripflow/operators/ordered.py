"""Ordered scans (running sums, running minima, next value) without a single-partition window.

``Window.partitionBy(g).orderBy(o)`` puts a whole group into one task; with one
hot group (a third of all rows) that task holds a third of the data. Instead the
rows are range-partitioned on (group, order) into blocks of bounded size, each
block's totals form a small table whose own prefix gives every block its
offset, and the running value inside a block is a window over that block only.
The block id is materialised before the table is checkpointed, so a recomputed
task (lost executor) sees the same blocks. When the row count proves the input
fits one block, a window per group is already bounded and is used directly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.operators.joins import Dimension
from tripflow.session import ensure_checkpoint_dir

BLOCK_ROWS = 1_000_000
MAX_BLOCKS = 16_384  # beyond this, blocks grow instead (a block's window sort spills like any sort)
BLOCK = "__block"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is ``sum`` or ``min``; ``inclusive`` counts the current row."""

    name: str
    value: Column
    kind: str = "sum"
    inclusive: bool = True


def _block_agg(kind: str, col: Column) -> Column:
    return F.sum(col) if kind == "sum" else F.min(col)


def _combine(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.least(a, b)  # least() skips nulls


def ordered_scan(df: DataFrame, groups: list[str], order: str, running: list[Running], next_col: str | None = None,
                 block_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` plus one column per ``running`` spec (and the next ``order`` value in the group when ``next_col``).

    ``order`` must be unique within a group (callers group by it first).
    """
    n = df.count() if rows is None else rows
    blocks = min(MAX_BLOCKS, max(1, math.ceil(n / (block_rows or BLOCK_ROWS))))
    tmp = [f"__v{i}" for i in range(len(running))]
    base = df.select("*", *[r.value.alias(t) for r, t in zip(running, tmp)])
    if blocks == 1 and groups:
        # the count proves the whole input fits one block: a window per group is already bounded
        w = Window.partitionBy(*groups).orderBy(order)
        cols = [_block_agg(r.kind, F.col(t)).over(w.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1))
                .alias(r.name) for r, t in zip(running, tmp)]
        if next_col:
            cols.append(F.lead(order).over(w).alias(next_col))
        return base.select(*[F.col(c) for c in df.columns], *cols)
    ranged = base.repartitionByRange(blocks, *[F.col(g) for g in groups], F.col(order))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.withColumn(BLOCK, F.spark_partition_id()).checkpoint(eager=True)

    keys = [*groups, BLOCK]
    totals = ranged.groupBy(*keys).agg(
        *[_block_agg(r.kind, F.col(t)).alias(f"{t}_tot") for r, t in zip(running, tmp)],
        F.min(order).alias("__first"),
    )
    wb = Window.partitionBy(*groups).orderBy(BLOCK)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *[(_block_agg(r.kind, F.col(f"{t}_tot")).over(before)).alias(f"{t}_off") for r, t in zip(running, tmp)],
        F.lead("__first").over(wb).alias("__next_first"),
    )
    # bounded by (#groups + #blocks) rows; broadcast only when that is small
    side = Dimension(offsets, rows=None).side()
    joined = ranged.join(side, keys, "left")

    w = Window.partitionBy(*keys).orderBy(order)
    out_cols = []
    for r, t in zip(running, tmp):
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1)
        inner = _block_agg(r.kind, F.col(t)).over(frame)
        out_cols.append(_combine(r.kind, F.col(f"{t}_off"), inner).alias(r.name))
    if next_col:
        out_cols.append(F.coalesce(F.lead(order).over(w), F.col("__next_first")).alias(next_col))
    return joined.select(*[F.col(c) for c in df.columns], *out_cols)
