"""Substring duplicates of documents by seed and extend.

Windows are 13 consecutive words. Seeds are winnowed 5-word grams, so every window holds one, and equal windows the
same one. (1) Blocks of documents send their distinct seeds; seeds met in several documents come back. (2) Around each
such seed the documents extend to both sides, to every window that has it as its anchor, and send the distinct
windows; a window met in a smaller doc_id comes back with that doc_id. (3) Runs of such windows are the maximal repeats;
their words go. Rows are compared in sorted streams, with a row for each block and distinct key.

Equal texts are one: all windows of a copy are in the first document with its text, so copies are marked by their
digests beforehand and send no windows.
"""

from __future__ import annotations


import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.anchors import block_of, blocked, column, found_in, met, run_ids, whole_runs, window_anchors
from tripflow.llm.common import materialise
from tripflow.llm.hashing import mix, sequences, slices, word_hashes, word_spans

WINDOW, GRAM = 13, 5
_LAST = np.iinfo(np.int64).max  # a null doc_id comes after all others


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(int(_LAST)).to_numpy()


def _windows(texts: list[bytes], window: int, gram: int):
    """Word hashes of all texts; start, anchor hash and text of every window inside one text."""
    h, n = word_hashes(texts)
    grams = sequences(h, gram)
    at = window_anchors(grams, window - gram + 1)
    own = np.repeat(np.arange(len(n)), n)
    start = np.flatnonzero(np.arange(len(at)) + window <= np.cumsum(n)[own[: len(at)]])
    return h, n, start, grams[at[start]].view(np.int64), own[start]


def _keys(h: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window's word sequence."""
    a, b = np.full(len(start), window, np.uint64), np.full(len(start), ~np.uint64(window), np.uint64)
    for k in range(window):
        w = h[start + k]
        a, b = mix(a ^ w), (b + w) * np.uint64(0xD6E8FEB86659FD93) ^ (b >> np.uint64(32))
    return a.view(np.int64), mix(b).view(np.int64)


def _seeds(window: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        ids, texts = _ids(table), [t.encode() for t in table.column("text").to_pylist()]
        seeds, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in slices(texts):
            _, _, _, seed, own = _windows(texts[lo:hi], window, gram)
            # once for each text
            _, first = np.unique(mix(seed.view(np.uint64)) ^ own.astype(np.uint64), return_index=True)
            seeds.append(seed[first])
            owners.append(ids[lo + own[first]])
        seed, owner = np.concatenate(seeds), np.concatenate(owners)
        order = np.lexsort((owner, seed))
        seed, owner = seed[order], owner[order]
        of = run_ids([seed]) if len(seed) else np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(of, prepend=-1))
        last = np.append(first[1:], len(seed)) - 1
        block = table.column("block")[0].as_py() if len(table) else 0
        return pa.table({"key": seed[first], "block": pa.array(np.full(len(first), block, np.int32)),
                         "several": pa.array((owner[first] != owner[last]).astype(np.int32) if len(first) else np.zeros(0, np.int32))})

    return run


def copies(docs: DataFrame, n: int) -> DataFrame:
    """``block, key, crc`` of documents whose whole text a smaller doc_id has too; the key is the doc_id."""
    texts = docs.where("doc_id is not null").select(
        block_of(n).alias("block"), "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.crc32(F.col("text").cast("binary")).alias("crc"))
    first = texts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return texts.join(first, "digest").where("doc_id > first").select("block", F.col("doc_id").alias("key"), "crc").distinct()


def _is_copy(ids: np.ndarray, texts: list[bytes], marks: pa.Table) -> np.ndarray:
    """Which documents are marked as copies: rows (key, crc) of ``marks`` with a crc."""
    crc = column(marks, "crc")
    marked = set(zip(column(marks, "key")[crc >= 0].tolist(), crc[crc >= 0].tolist()))
    of = {k for k, _ in marked}
    return np.array([k in of and (k, zlib.crc32(t)) in marked for k, t in zip(ids.tolist(), texts)], bool)


def _extend(window: int, gram: int):
    def run(table: pa.Table, wanted: pa.Table) -> pa.Table:
        ids, texts = _ids(table), [t.encode() for t in table.column("text").to_pylist()]
        own_text = np.flatnonzero(~_is_copy(ids, texts, wanted))
        ids, texts = ids[own_text], [texts[k] for k in own_text]
        seeds = np.sort(column(wanted, "key")[column(wanted, "crc") < 0])
        parts = [[np.zeros(0, np.int64)] * 3]
        for lo, hi in slices(texts):
            h, _, start, seed, own = _windows(texts[lo:hi], window, gram)
            hit = found_in(seed, seeds) >= 0
            parts.append([*_keys(h, start[hit], window), ids[lo + own[hit]]])
        a, b, owner = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((owner, b, a))
        a, b, owner = a[order], b[order], owner[order]
        first = np.flatnonzero(np.diff(run_ids([a, b]), prepend=-1)) if len(a) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(a)) - 1 if len(first) else first
        block = table.column("block")[0].as_py() if len(table) else 0
        return pa.table({"a": a[first], "b": b[first], "block": pa.array(np.full(len(first), block, np.int32)),
                         "least": owner[first], "most": owner[last]})

    return run


def _earlier(batches):
    """Windows that a block holds in a document behind the first one that has them, with that first doc_id."""
    for a, b, block, least, most in whole_runs(batches, 2):
        of = run_ids([a, b])
        first = np.full(of[-1] + 1, _LAST)
        np.minimum.at(first, of, least)
        keep = most > first[of]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (block, a, b)] + [pa.array(first[of][keep])], names=["block", "key", "b", "first"])


def _removed(window: int, gram: int):
    def run(table: pa.Table, repeated: pa.Table) -> pa.Table:
        ids, texts = _ids(table), [t.encode() for t in table.column("text").to_pylist()]
        copy = _is_copy(ids, texts, repeated)
        a, b, first = (column(repeated, k)[column(repeated, "crc") < 0] for k in ("key", "b", "first"))
        order = np.argsort(a)
        a, b, first = a[order], b[order], first[order]
        rows: dict[str, list] = {k: [] for k in ("n_words", "spans", "kept")}
        for lo, hi in slices(texts):
            h, n, start, _, own = _windows(texts[lo:hi], window, gram)
            ka, kb = _keys(h, start, window)
            at = found_in(ka, a)
            hit = at >= 0
            if hit.any():
                hit[hit] = (b[at[hit]] == kb[hit]) & (first[at[hit]] < ids[lo + own[hit]])
            cover = np.zeros(len(h) + 1, np.int64)
            np.add.at(cover, start[hit], 1)
            np.add.at(cover, start[hit] + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            gone |= np.repeat(copy[lo:hi] & (n >= window), n)
            stop = 0
            for text, size in zip(texts[lo:hi], n.tolist()):
                mine, stop = gone[stop : stop + size], stop + size
                edge = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
                rows["n_words"].append(size)
                rows["spans"].append([{"start": int(x), "stop": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                data = np.frombuffer(text, np.uint8)
                x, y = word_spans(data)
                rows["kept"].append(b" ".join(text[i:j] for i, j in zip(x[~mine].tolist(), y[~mine].tolist())).decode())
        return pa.table({"doc_id": table.column("doc_id"), "n_words": pa.array(rows["n_words"], pa.int64()),
                         "spans": pa.array(rows["spans"], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                         "kept": pa.array(rows["kept"], pa.string())})

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, spans, kept``: the maximal runs of words (start, stop) of each text that are covered by
    windows which a smaller doc_id has too, and the words that are left, joined by one space.

    Null text has no words. A null doc_id counts as larger than all others; rows with the same doc_id do not repeat one
    another. An empty table gives no rows; other columns are not carried.
    """
    x, n = blocked(docs)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = materialise(copies(plain, n), "copies")
    seeds = x.groupBy("block").applyInArrow(_seeds(window, gram), "key bigint, block int, several int")
    again = met(seeds).withColumn("crc", F.lit(-1).cast("bigint")).unionByName(marks).repartition(n, "block")
    sent = x.groupBy("block").cogroup(again.groupBy("block")).applyInArrow(
        _extend(window, gram), "a bigint, b bigint, block int, least bigint, most bigint")
    earlier = sent.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_earlier, "block int, key bigint, b bigint, first bigint")
    earlier = earlier.withColumn("crc", F.lit(-1).cast("bigint")).unionByName(marks, allowMissingColumns=True).fillna(0, ["b", "first"])
    return x.groupBy("block").cogroup(earlier.repartition(n, "block").groupBy("block")).applyInArrow(
        _removed(window, gram), "doc_id bigint, n_words bigint, spans array<struct<start: bigint, stop: bigint>>, kept string")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated 13-word windows of all documents, removed behind their first document."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split),
windows AS (SELECT doc_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS w FROM starts),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM windows JOIN firsts USING (w) WHERE first < doc_id),
places AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM split),
left_over AS (
  SELECT l.doc_id, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY l.p) FILTER (g.p IS NULL) AS kept
  FROM places l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p GROUP BY l.doc_id
)
SELECT s.doc_id, len(s.words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN left_over o ON s.doc_id = o.doc_id"""
