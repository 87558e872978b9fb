"""Exact substring duplicates with suffix arrays.

A window is 400 bytes of one document; windows that start anywhere else too are removed. Each window belongs to one
anchor, the least hash among its 200-byte grams (``anchors``), and equal windows have equal anchors. The windows of one
anchor occurrence are consecutive, so they are one segment of bytes, and the work goes by anchor:

1. Blocks of documents send their distinct anchors; anchors met more than once come back.
2. Of those the blocks send a fingerprint of each distinct segment. A segment met more than once is removed whole; an
   anchor with several distinct segments, as at the edges of a copied passage, needs a comparison of their bytes.
3. Shards, each the distinct segments of many anchors, get a suffix array by Larsson-Sadakane refinement (prefix
   doubling that only sorts what is still unsorted) and common prefixes by Kasai's rule; windows whose neighbour in the
   array shares 400 bytes are repeated. An anchor with very many segments (a passage with a different ending in every
   document) is dealt to several shards: each lists its distinct windows, Spark's exchange brings the ranges of the
   lists together, and binary search finds the windows that other shards have.
4. The runs come back to the blocks, which cut them out.

What a block sends has one row for each distinct key, so the copies of a passage inside a block cost one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.anchors import blocked, column, found_in, met, run_ids, whole_runs
from tripflow.llm.common import materialise
from tripflow.llm.hashing import Substrings, slices

WINDOW, GRAM = 400, 200
#: Bytes of segments in one suffix array, and distinct segments of one anchor in one shard.
SHARD_BYTES, SHARD_SEGMENTS = 2 << 20, 4096
_END = 0xFF  # never a byte of UTF-8


# ---- suffix arrays ---------------------------------------------------------------------------------------------


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number, padded behind the end."""
    padded = np.append(data, np.full(8, _END, np.uint8)).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes in order of their first ``depth`` bytes or more, the rank of each, and the depth that was reached.

    Larsson and Sadakane: suffixes with equal prefixes form a group whose number is its place; each round sorts the
    groups of more than one by the rank of what follows the prefix, which doubles the prefix.
    """
    n = len(data)
    key = words_at(data)
    order = np.argsort(key)
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    known = 8
    while known < depth:
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        suffix = order[at]
        group, follow = rank[suffix], suffix + known
        follow = np.where(follow < n, rank[np.minimum(follow, n - 1)], n)  # the padding comes last
        by = np.argsort(group * (n + 1) + follow)
        suffix, group, follow = suffix[by], group[by], follow[by]
        order[at] = suffix
        first = np.ones(len(at), bool)
        first[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        new[at] = first
        rank[suffix] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        known *= 2
    return order, rank, known


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, stops: np.ndarray, enough: int) -> np.ndarray:
    """For each position of the stretches ``starts[k]..stops[k]``: bytes in common with the suffix before it in order,
    up to ``enough``; 0 elsewhere.

    Kasai's rule, in step for all stretches: behind a common prefix of length l with the suffix at j, the next
    position shares l - 1 bytes with j + 1, if that still precedes it, so bytes are not compared twice.
    """
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.full(len(order), -1)
    before[order[1:]] = order[:-1]
    word = words_at(data)
    n = len(data)
    out = np.zeros(n, np.int64)
    i, stop = starts.copy(), stops
    length = np.zeros(len(i), np.int64)
    lanes = np.flatnonzero(i < stop)
    i, stop, length = i[lanes], stop[lanes], length[lanes]
    while len(i):
        j = before[i]
        x, y = i + length, np.maximum(j, 0) + length
        inside = (j >= 0) & (x < n) & (y < n) & (length < enough)
        differ = np.where(inside, word[np.minimum(x, n - 1)] ^ word[np.minimum(y, n - 1)], ~np.uint64(0))
        same = np.zeros(len(i), np.int64)
        for k in range(8):
            same += differ < (np.uint64(1) << np.uint64(8 * k))
        length = np.minimum(length + same, enough)
        done = (same < 8) | (length >= enough)
        out[i[done]] = length[done]
        # on to the next position, with what is known about it
        nxt = i + 1
        held = (j >= 0) & (nxt < n) & (j + 1 < n)
        held &= place[np.minimum(j + 1, n - 1)] < place[np.minimum(nxt, n - 1)]
        length = np.where(done, np.where(held, np.maximum(length - 1, 0), 0), length)
        i = np.where(done, nxt, i)
        going = i < stop
        i, stop, length = i[going], stop[going], length[going]
    return out


def repeated_windows(segments: list[bytes], window: int = WINDOW) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each segment: is the window at each start also elsewhere in these segments; and is it its first place in
    the suffix array's order (one place for each distinct window)."""
    data = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    sizes = np.array([len(s) for s in segments])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order, rank, _ = suffix_array(data, window)
    stops = starts + np.maximum(sizes - window + 1, 0)
    valid = np.zeros(len(data) + 1, np.int64)
    np.add.at(valid, starts, 1)
    np.add.at(valid, stops, -1)
    valid = np.cumsum(valid[:-1]) > 0
    common = common_prefixes(data, order, rank, starts, stops, window)
    # a window starts a run of equal ones unless it shares all its bytes with a window before it
    linked = (common[order] >= window) & valid[order] & np.concatenate([[False], valid[order][:-1]])
    twice = linked | np.append(linked[1:], False)
    repeated, first = np.zeros(len(data), bool), np.zeros(len(data), bool)
    repeated[order] = twice
    first[order] = ~linked & valid[order]
    return [repeated[a:b] for a, b in zip(starts, stops)], [first[a:b] for a, b in zip(starts, stops)]


# ---- passes over the blocks ------------------------------------------------------------------------------------

#: Windows whose anchors are found at a time, so that the arrays stay in a core's cache; the low bits hold a place.
STEP = 1 << 15
_PLACE = (1 << 20) - 1


def least_grams(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the gram with the least hash (upper 44 bits, rightmost on a tie) of each window of ``width`` grams.

    The place replaces the low bits of the hash, falling from left to right, so one minimum finds hash and place;
    equal windows have equal anchors, since all of this follows from what the window holds.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    step = min(STEP, _PLACE - width)
    low = np.uint64(_PLACE)
    down = np.arange(_PLACE, _PLACE - step - width, -1, dtype=np.uint64)
    out = np.empty(n, np.int64)
    for at in range(0, n, step):
        to = min(n, at + step)
        least = h[at : to + width - 1] & ~low
        least |= down[: len(least)]
        size = 1
        while 2 * size <= width:  # windows of doubled size from two halves
            least = np.minimum(least[size:], least[:-size])
            size *= 2
        if width > size:
            least = np.minimum(least[width - size :], least[: size - width])
        out[at:to] = (at + _PLACE) - (least & low).view(np.int64)
    return out


class _Slice:
    """Some documents of a block as bytes, and the segments of their windows."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        data = b"".join(texts)
        self.data = np.frombuffer(data, np.uint8)
        self.bytes = data
        sizes = np.array([len(t) for t in texts])
        self.stops = np.cumsum(sizes)
        self.window = window
        empty = np.zeros(0, np.int64)
        self.low, self.high, self.anchor, self.key = empty, empty, empty, empty
        if len(data) < window:
            return
        h = Substrings(self.data).every(gram)
        at = least_grams(h, window - gram + 1)
        doc = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
        start = np.flatnonzero(np.arange(len(at)) + window <= self.stops[doc])
        if not len(start):
            return
        own, doc = at[start], doc[start]
        new = np.ones(len(start), bool)
        new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        self.low, self.high, self.anchor = start[first], start[last] + window, own[first]  # bytes low..high
        self.key = h[self.anchor].view(np.int64)

    def prints(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each segment: its bytes and the anchor's place in it."""
        found = [xxhash.xxh3_128_intdigest(self.bytes[a:b], seed=c - a)
                 for a, b, c in zip(self.low[at].tolist(), self.high[at].tolist(), self.anchor[at].tolist())]
        low = np.array([x & 0xFFFFFFFFFFFFFFFF for x in found], np.uint64)
        return low.view(np.int64), np.array([x >> 64 for x in found], np.uint64).view(np.int64)


def _texts(table: pa.Table) -> list[bytes]:
    return table.column("text").cast(pa.binary()).to_pylist()


def _block(table: pa.Table) -> int:
    return table.column("block")[0].as_py() if len(table) else 0


def _first_of_runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First row and length of each run of equal rows."""
    if not len(columns[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(run_ids(columns), prepend=-1))
    return first, np.diff(np.append(first, len(columns[0])))


def _anchors(window: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        texts = _texts(table)
        key = np.sort(np.concatenate([np.zeros(0, np.int64), *[_Slice(texts[a:b], window, gram).key for a, b in slices(texts)]]))
        first, n = _first_of_runs([key])
        return pa.table({"key": key[first], "block": pa.array(np.full(len(first), _block(table), np.int32)),
                         "several": pa.array((n > 1).astype(np.int32))})

    return run


def _segments(window: int, gram: int):
    def run(table: pa.Table, again: pa.Table) -> pa.Table:
        texts, wanted = _texts(table), np.sort(column(again, "key"))
        parts = [[np.zeros(0, np.int64)] * 3]
        for lo, hi in slices(texts):
            part = _Slice(texts[lo:hi], window, gram)
            at = np.flatnonzero(found_in(part.key, wanted) >= 0)
            parts.append([part.key[at], *part.prints(at)])
        a, f, g = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((g, f, a))
        a, f, g = a[order], f[order], g[order]
        first, n = _first_of_runs([a, f, g])
        return pa.table({"a": a[first], "f": f[first], "g": g[first],
                         "block": pa.array(np.full(len(first), _block(table), np.int32)), "n": pa.array(n)})

    return run


def decided(prints: DataFrame, most: int) -> DataFrame:
    """Of the segments that each block holds: which are met twice (whole), which need comparing, which block sends
    their bytes, and to which of the anchor's shards.

    Aggregates and joins: an anchor with a segment in a third of all documents is pre-aggregated and its join split.
    """
    keys = ["a", "f", "g"]
    segments = prints.groupBy(*keys).agg((F.sum("n") > 1).alias("whole"), F.min("block").alias("sender"))
    shards = prints.groupBy(*keys).agg(F.lit(1).alias("one")).groupBy("a").agg(
        F.count("*").alias("distinct"), F.ceil(F.count("*") / most).cast("int").alias("shards"))
    known = segments.join(shards, "a").where("whole or distinct > 1")
    return prints.select("block", *keys).join(known, keys).select(
        "block", *keys, "whole", ((F.col("block") == F.col("sender")) & (F.col("distinct") > 1)).alias("send"),
        F.pmod("f", "shards").cast("int").alias("shard"), "shards",
    )


def _sent(window: int, gram: int):
    def run(table: pa.Table, wanted: pa.Table) -> pa.Table:
        texts = _texts(table)
        order = np.argsort(column(wanted, "f"))
        f, g, a, shard, shards = (column(wanted, k)[order] for k in ("f", "g", "a", "shard", "shards"))
        todo = np.ones(len(f), bool)
        rows, out = [], []
        keys = np.sort(a)
        for lo, hi in slices(texts):
            part = _Slice(texts[lo:hi], window, gram)
            at = np.flatnonzero(found_in(part.key, keys) >= 0)
            pf, pg = part.prints(at)
            place = found_in(pf, f)
            for k, p in zip(at.tolist(), place.tolist()):
                if p >= 0 and todo[p]:
                    todo[p] = False
                    rows.append(p)
                    out.append(part.bytes[part.low[k] : part.high[k]])
        rows = np.array(rows, np.int64)
        return pa.table({"a": a[rows], "shard": shard[rows], "shards": shards[rows], "f": f[rows], "g": g[rows],
                         "segment": pa.array(out, pa.binary())})

    return run


_FOUND = "f bigint, g bigint, start int, stop int, w bigint, v bigint, listed int"


def _sharded(window: int, shard_bytes: int):
    """Suffix arrays of shards: runs of repeated windows (listed 0), and the distinct windows of split anchors (1)."""
    schema = pa.schema([("f", pa.int64()), ("g", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()),
                        ("w", pa.int64()), ("v", pa.int64()), ("listed", pa.int32())])

    def built(shard: list[tuple]):
        repeated, first = repeated_windows([s for *_, s in shard], window)
        out = []
        for (_, split, f, g, segment), twice, one in zip(shard, repeated, first):
            edge = np.flatnonzero(np.diff(twice.astype(np.int8), prepend=0, append=0))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                out.append((f, g, a, b, f, g, 0))
            if split:
                for a in np.flatnonzero(one).tolist():
                    h = xxhash.xxh3_128_intdigest(segment[a : a + window])
                    w, v = np.array([h & 0xFFFFFFFFFFFFFFFF, h >> 64], np.uint64).view(np.int64).tolist()
                    out.append((f, g, a, a + 1, w, v, 1))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], schema.field(k).type) for k in range(7)], schema=schema)

    def run(batches):
        group: list[tuple] = []  # of one (anchor, shard)
        shard: list[tuple] = []  # of several
        size = own = 0
        key = None
        for batch in batches:
            for a, k, shards, f, g, segment in zip(*(batch.column(c).to_pylist() for c in ("a", "shard", "shards", "f", "g", "segment"))):
                split = shards > 1
                if (a, k) != key:
                    # the shards of a split anchor stay apart, other groups share a suffix array
                    if shard and (size + own > shard_bytes or shard[-1][1] or (group and group[0][1])):
                        yield from built(shard)
                        shard, size = [], 0
                    shard += group
                    size += own
                    group, own, key = [], 0, (a, k)
                group.append((a, split, f, g, segment))
                own += len(segment) + 1
        if shard and (shard[-1][1] or (group and group[0][1])):
            yield from built(shard)
            shard = []
        if shard + group:
            yield from built(shard + group)

    return run


def _merged(batches):
    """Runs as they are, and of the listed windows those that more than one shard has."""
    for w, v, f, g, start, stop, listed in whole_runs(batches, 2):
        of = run_ids([w, v])
        # equal windows of the shards' lists lie together: binary search counts them
        met_in = np.searchsorted(of, of, "right") - np.searchsorted(of, of, "left")
        keep = (listed == 0) | (met_in > 1)
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (f, g, start, stop)], names=["f", "g", "start", "stop"])


def _cut(window: int, gram: int):
    def run(table: pa.Table, runs: pa.Table) -> pa.Table:
        texts = _texts(table)
        order = np.argsort(column(runs, "f"))
        a, f, g, start, stop = (column(runs, k)[order] for k in ("a", "f", "g", "start", "stop"))
        keys = np.sort(a)
        none = np.zeros(0, np.int64)
        first, last, spans, kept, left_over = [none], [none], [none], [none], [np.zeros(0, np.uint8)]
        for lo, hi in slices(texts):
            part = _Slice(texts[lo:hi], window, gram)
            at = np.flatnonzero(found_in(part.key, keys) >= 0)
            pf, pg = part.prints(at)
            left, right = np.searchsorted(f, pf, "left"), np.searchsorted(f, pf, "right")
            n = right - left
            which = np.repeat(np.arange(len(at)), n)
            row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
            same = g[row] == pg[which]
            which, row = which[same], row[same]
            low = part.low[at[which]]
            whole = stop[row] < 0  # the whole segment
            begin = np.where(whole, low, low + start[row])
            end = np.where(whole, part.high[at[which]], low + stop[row] - 1 + window)
            size = len(part.data)
            cover = np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
            gone = np.cumsum(cover[:-1]) > 0
            # runs end with their document
            stops = part.stops
            starts = np.concatenate([[0], stops[:-1]])
            joined = np.zeros(size + 1, bool)  # with the byte before it
            joined[1:size] = gone[1:] & gone[:-1]
            joined[stops] = False
            joined[starts] = False
            x = np.flatnonzero(gone & ~joined[:-1])
            y = np.flatnonzero(gone & ~joined[1:]) + 1
            own = np.searchsorted(stops, x, "right")
            first.append(x - starts[own])
            last.append(y - starts[own])
            spans.append(np.bincount(own, minlength=len(stops)))
            before = np.concatenate([[0], np.cumsum(~gone)])
            kept.append(before[stops] - before[starts])
            left_over.append(part.data[~gone])
        first, last, spans, kept = (np.concatenate(k) for k in (first, last, spans, kept))
        runs_of = pa.StructArray.from_arrays([pa.array(first), pa.array(last)], names=["start", "stop"])
        places, data = np.concatenate([[0], np.cumsum(kept)]), np.concatenate(left_over)
        return pa.table({"doc_id": table.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                         "spans": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(spans)]), pa.int32()), runs_of),
                         "kept": pa.LargeBinaryArray.from_buffers(
                             pa.large_binary(), len(texts), [None, pa.py_buffer(places), pa.py_buffer(data)]).cast(pa.binary())})

    return run


def remove_repeated_bytes(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, shard_segments: int = SHARD_SEGMENTS
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the maximal runs of bytes (start, stop) of each text that are covered by
    windows which start elsewhere too, and the bytes that are left.

    Texts are UTF-8 bytes, null is empty; what is left need not be UTF-8. Matches never cross documents; repeated rows
    are documents of their own. An empty table gives no rows; other columns are not carried.
    """
    x, n = blocked(docs)
    by = x.groupBy("block")
    again = met(by.applyInArrow(_anchors(window, gram), "key bigint, block int, several int")).repartition(n, "block")
    prints = materialise(by.cogroup(again.groupBy("block")).applyInArrow(
        _segments(window, gram), "a bigint, f bigint, g bigint, block int, n bigint"), "segments")
    verdict = materialise(decided(prints, shard_segments), "segments-decided")
    wanted = verdict.where("send").drop("whole", "send").repartition(n, "block")
    sent = by.cogroup(wanted.groupBy("block")).applyInArrow(
        _sent(window, gram), "a bigint, shard int, shards int, f bigint, g bigint, segment binary")
    found = sent.repartition("a", "shard").sortWithinPartitions("a", "shard").mapInArrow(_sharded(window, shard_bytes), _FOUND)
    merged = found.select("w", "v", "f", "g", "start", "stop", "listed").repartition("w").sortWithinPartitions("w", "v").mapInArrow(
        _merged, "f bigint, g bigint, start int, stop int")
    partly = verdict.where("not whole").join(merged, ["f", "g"]).select("block", "a", "f", "g", "start", "stop")
    whole = verdict.where("whole").select("block", "a", "f", "g", F.lit(0).alias("start"), F.lit(-1).alias("stop"))
    runs = partly.unionByName(whole).repartition(n, "block")
    return by.cogroup(runs.groupBy("block")).applyInArrow(
        _cut(window, gram), "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary")


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes of all documents that 400-byte repeats cover, removed."""
    found = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
