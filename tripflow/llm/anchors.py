"""Winnowed anchors: what the two substring operators share.

Every window of ``width`` consecutive gram hashes has an anchor, its least hash (the rightmost on a tie). Equal windows
have equal anchors, so repeats of a whole window are found among the windows with a common anchor.

Documents are dealt to blocks by hash. A block is the unit in which rows are pre-aggregated: what it sends to be
compared with other blocks has one row for each distinct key, so a passage that a third of all documents share costs a
row per block. The blocked documents are one exchange, which Spark reuses for every pass over them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import parts_for

#: UTF-8 bytes of text in a block, on average.
BLOCK_BYTES = 16 << 20


def block_of(n: int) -> Column:
    """By doc_id and text, so that rows with null or equal ids spread; only rows that repeat both meet for certain."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")


def blocked(docs: DataFrame) -> tuple[DataFrame, int]:
    """``block, doc_id, text`` dealt out by block, and the number of blocks."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = parts_for(rows, F.octet_length("text"), BLOCK_BYTES)
    return rows.select(block_of(n).alias("block"), "doc_id", "text").repartition(n, "block"), n


def window_anchors(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the least hash (rightmost on a tie) of each window of ``width`` hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at, size = h, np.arange(len(h)), 1
    while 2 * size <= width:  # windows of doubled size from two halves
        right = least[size:] <= least[:-size]
        at = np.where(right, at[size:], at[:-size])
        least = np.where(right, least[size:], least[:-size])
        size *= 2
    shift = width - size
    if shift:
        right = least[shift:] <= least[:-shift]
        at = np.where(right, at[shift:], at[:-shift])
    return at[:n]


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by their first ``keys`` columns, cut so that equal keys stay together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        if not len(now[0]):
            continue
        last = np.ones(len(now[0]), bool)
        for k in range(keys):
            last &= now[k] == now[k][-1]
        cut = int(last.argmax())
        if cut:
            yield [c[:cut] for c in now]
        held = [c[cut:] for c in now]
    if held is not None and len(held[0]):
        yield held


def run_ids(columns: list[np.ndarray]) -> np.ndarray:
    """Number of the run of equal values that each row of sorted columns belongs to."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def met(seen: DataFrame) -> DataFrame:
    """``block, key`` of rows (key, block, several) whose key is in several blocks, or several times in one."""

    def run(batches):
        for key, block, several in whole_runs(batches, 1):
            of = run_ids([key])
            keep = (np.bincount(of)[of] > 1) | (np.bincount(of, several)[of] > 0)
            yield pa.RecordBatch.from_arrays([pa.array(block[keep]), pa.array(key[keep])], names=["block", "key"])

    return seen.repartition("key").sortWithinPartitions("key").mapInArrow(run, "block int, key bigint")


def found_in(wanted: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each wanted value in a sorted table, -1 where it is not there."""
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()
