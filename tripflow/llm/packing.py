"""Best-fit packing: tokenise documents, cut the long ones, pack the pieces into sequences of fixed capacity.

Best-fit decreasing only looks at lengths, and lengths are integers up to the capacity. So the whole corpus is packed
exactly from its histogram of lengths (at most ``capacity`` rows): open bins with equal room are interchangeable and
are kept as ranges of sequence numbers, and a segment tree over the room finds the tightest open bin. The result is a
small table of moves, "the pieces of this length with ranks lo..hi go to sequences from here, at this offset". Ranks
within a length come from counts per (length, hash bucket) and a window inside each bucket, so a length that a third
of all pieces share is spread over many tasks.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import threading
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.anchors import found_in
from tripflow.llm.common import materialise
from tripflow.llm.hashing import Substrings, sub_batches, word_spans

CAPACITY = 2048
#: Pieces that one window task ranks, at most on average.
RANK_ROWS = 200_000
#: Words whose ids a Python worker remembers, over all its tasks: about 40 bytes each. Beyond, the half used last stays.
REMEMBERED = 1_000_000
#: Bytes of text that are encoded at a time.
SLICE = 2_000_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# Characters for which lower case, composition and the pre-token classes are plain; words with others go to the
# tokenizer as they stand.
_UNSAFE = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]|<\\|")
_PRETOKEN = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")


class Encoder:
    """Ids of whole texts, remembered by word (a run between ASCII white space) in sorted arrays.

    The tokenizer drops white space, lower-cases and never joins characters of two pre-tokens, so the ids of a text
    are those of its words in order, and those of plain words can be asked for many at a time. Words are known by a
    64-bit hash of their bytes: among ten million words, two are mixed up with a probability of 3e-6.
    """

    def __init__(self, path: str, remembered: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered or REMEMBERED
        self.turn = 0
        #: Hashes of the words, ascending; where in ``ids`` theirs begin, how many they are, and when they were last used.
        self.hashes = np.zeros(0, np.uint64)
        self.at, self.size, self.used = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))
        self.ids = np.zeros(1, np.uint32)  # the closing 0 of a document is at 0

    def _parts(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of pre-tokens, many as one text, and how many each has: the tokenizer numbers them."""
        for k in range(0, len(parts), 2000):
            some = parts[k : k + 2000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            of = np.array(found.word_ids, np.int64)
            if len(of) and of[-1] == len(some) - 1:
                yield np.array(found.ids, np.uint32), np.bincount(of, minlength=len(some))
            else:
                yield from self._words(some)

    def _words(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            yield np.array(e.ids, np.uint32), np.array([len(e.ids)])

    def _add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = np.cumsum(size) - size + len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        return at

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Odd words go to the tokenizer as they stand; the others are put together from their pre-tokens, of which
        only those that are not known as words already go there."""
        none = (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        odd = np.array([bool(_UNSAFE.search(w)) for w in words], bool)
        ids, size = (np.concatenate(x) for x in zip(none, *self._words([w for w, o in zip(words, odd) if o])))
        rows = [(hashes[odd], self._add(ids, size), size)]

        known: dict[str, int] = {}
        split = [[w.lower()] if w.isalpha() else _PRETOKEN.findall(w.lower()) for w, o in zip(words, odd) if not o]
        flat = np.array([known.setdefault(p, len(known)) for own in split for p in own], np.int64)
        parts = list(known)
        raw = np.frombuffer(" ".join(parts).encode(), np.uint8)
        own = Substrings(raw)(*word_spans(raw))
        place = found_in(own, self.hashes)
        new = np.flatnonzero(place < 0)
        ids, size = (np.concatenate(x) for x in zip(none, *self._parts([parts[k] for k in new.tolist()])))
        part_at, part_size = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        part_at[new], part_size[new] = self._add(ids, size), size
        old = np.flatnonzero(place >= 0)
        part_at[old], part_size[old] = self.at[place[old]], self.size[place[old]]
        rows.append((own[new], part_at[new], part_size[new]))

        many = np.array([len(x) for x in split], np.int64)
        of = np.repeat(np.arange(len(split)), many)
        size = np.bincount(of, part_size[flat], len(split)).astype(np.int64)
        rows.append((hashes[~odd], self._add(self.ids[gather(part_at[flat], part_size[flat])], size), size))

        merged, at, size = (np.concatenate(x) for x in zip((self.hashes, self.at, self.size), *rows))
        self.hashes, first = np.unique(merged, return_index=True)
        used = np.concatenate([self.used, np.full(len(merged) - len(self.used), self.turn, np.int32)])
        self.at, self.size, self.used = at[first], size[first].astype(np.int32), used[first]

    def forget(self) -> None:
        """Keep the half of the words that were used last, and their ids."""
        if len(self.hashes) <= self.remembered and len(self.ids) <= 8 * self.remembered:
            return
        keep = np.sort(np.argsort(-self.used, kind="stable")[: self.remembered // 2])
        keep = keep[np.cumsum(self.size[keep]) <= 4 * self.remembered]
        size = self.size[keep]
        self.ids = np.concatenate([np.zeros(1, np.uint32), self.ids[gather(self.at[keep], size)]])
        self.hashes, self.at, self.size, self.used = self.hashes[keep], np.cumsum(size) - size + 1, size, self.used[keep]

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8), each with its closing 0, and how many each has."""
        data = b" ".join(texts)
        raw = np.frombuffer(data, np.uint8)
        start, stop = word_spans(raw)
        hashes, first, own = np.unique(Substrings(raw)(start, stop), return_index=True, return_inverse=True)
        self.turn += 1
        new = np.flatnonzero(found_in(hashes, self.hashes) < 0)
        if len(new):
            self.learn(hashes[new], [data[a:b].decode() for a, b in zip(start[first[new]].tolist(), stop[first[new]].tolist())])
        place = found_in(hashes, self.hashes)
        self.used[place] = self.turn
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        ends = np.append(np.searchsorted(start, offsets[1:]), len(start)) if texts else np.zeros(0, np.int64)
        at, size = np.insert(self.at[place][own], ends, 0), np.insert(self.size[place][own], ends, 1)
        out = self.ids[gather(at, size)]
        lengths = np.cumsum(size)[ends + np.arange(len(ends))] if len(ends) else ends
        self.forget()
        return out, np.diff(lengths, prepend=0)


def gather(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of runs of ``size`` from ``at``, one after the other."""
    size = size.astype(np.int64)
    return np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())


#: Seconds that a Python worker keeps an encoder without a task; then its memory is there for other work.
KEPT_S = 10.0
_encoders: dict[str, Encoder] = {}
_timers: dict[str, threading.Timer] = {}


def _taken(path: str) -> Encoder:
    """The worker's encoder, or a new one; until it is given back nothing else takes or drops it."""
    encoder = _encoders.pop(path, None)
    return encoder if encoder is not None else Encoder(path)


def _given_back(path: str, encoder: Encoder) -> None:
    _encoders[path] = encoder
    if path in _timers:
        _timers[path].cancel()
    timer = _timers[path] = threading.Timer(KEPT_S, _dropped, [path])
    timer.daemon = True
    timer.start()


def _dropped(path: str) -> None:
    """Forget an idle encoder and hand the free memory back, which allocators otherwise keep for this worker."""
    if _encoders.pop(path, None) is None:
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def tokenise(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its ids and a closing 0; null text is empty (the closing 0 alone). Only longer documents are cut.
    Repeated rows give pieces of their own; a null doc_id stays null.
    """

    def run(batches):
        # one for all tasks of a worker; its memory is bounded
        encode = _taken(tokenizer_path)
        try:
            for batch in batches:
                for part in sub_batches(batch, "text", SLICE):
                    yield pieces_of(encode, part)
        finally:
            _given_back(tokenizer_path, encode)

    def pieces_of(encode: Encoder, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = encode([(t or "").encode() for t in part.column("text").to_pylist()])
        ids = ids.astype("<u4", copy=False)
        pieces = -(-lengths // capacity)
        row = np.repeat(np.arange(len(lengths)), pieces)
        piece = np.arange(len(row)) - (np.cumsum(pieces) - pieces)[row]
        start = piece * capacity
        length = np.minimum(capacity, lengths[row] - start)
        low = 4 * ((np.cumsum(lengths) - lengths)[row] + start)
        view = memoryview(ids).cast("B") if len(ids) else memoryview(b"")
        cuts = [view[a:b] for a, b in zip(low.tolist(), (low + 4 * length).tolist())]
        columns = [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                   pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
        if with_ids:
            columns.append(pa.array([bytes(c) for c in cuts], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


class RoomTree:
    """Segment tree over room 0..capacity: which amounts some open bin has; finds the least that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def put(self, room: int, there: bool) -> None:
        at = self.leaves + room
        self.any[at] = there
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = self.leaves + least
        while not self.any[at]:
            while at & 1:  # a right child: nothing more below the parent
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing of ``counts[length]`` pieces: moves ``(length, lo, hi, sequence, offset)`` and the number of sequences.

    Pieces with ranks lo..hi-1 of that length go to sequences ``sequence + rank - lo``, at ``offset``. The tightest bin
    for a piece stays the tightest for the next one of equal length while it has room, so each bin taken is filled
    with as many pieces of the length as fit.
    """
    tree, bins = RoomTree(capacity), defaultdict(list)  # room -> ranges of sequences
    moves: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, rank: int, lo: int, n: int, each: int, room: int) -> None:
        for j in range(each):
            moves.append((length, rank + j * n, rank + (j + 1) * n, lo, capacity - room + j * length))
        left = room - each * length
        if left:
            bins[left].append((lo, lo + n))
            tree.put(left, True)

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                lo, hi, room = opened, opened + -(-todo // each), capacity
                opened = hi
            else:
                each = room // length
                lo, hi = bins[room].pop()
                if not bins[room]:
                    tree.put(room, False)
            full = min(hi - lo, todo // each)
            if full:
                place(length, rank, lo, full, each, room)
                rank, todo, lo = rank + full * each, todo - full * each, lo + full
            if lo < hi and todo:  # fewer pieces left than one bin takes
                place(length, rank, lo, 1, todo, room)
                rank, todo, lo = rank + todo, 0, lo + 1
            if lo < hi:
                bins[room].append((lo, hi))
                tree.put(room, True)
    return moves, opened


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id, piece, length`` and others, 1 <= length <= capacity).

    ``pieces`` is read three times, so it should be a written table. Sequences are filled without gaps from offset 0;
    an empty table gives no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    moves, _ = best_fit(counts, capacity)
    plan = spark.createDataFrame(moves, "length bigint, _lo bigint, _hi bigint, _sequence bigint, offset bigint")

    buckets = max(1, -(-sum(counts.values()) // RANK_ROWS))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")
    sizes = sizes.select("length", "_bucket", before.alias("_before"))
    order = [c for c in ("doc_id", "piece", "ids_crc32", "start") if c in pieces.columns]
    rank = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)) - 1
    ranked = spread.withColumn("_in", rank).join(sizes, ["length", "_bucket"]).withColumn("_rank", F.col("_in") + F.col("_before"))
    # the plan's rows are bounded by the capacity (lengths times bins' ranges), whatever the corpus
    placed = ranked.alias("r").join(
        F.broadcast(plan).alias("p"),
        (F.col("r.length") == F.col("p.length")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")),
    )
    return placed.select(
        *[F.col(f"r.{c}") for c in pieces.columns],
        (F.col("_sequence") + F.col("_rank") - F.col("_lo")).alias("sequence_id"), F.col("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack; see ``tokenise`` and ``pack``."""
    return pack(materialise(tokenise(docs, tokenizer_path, capacity, with_ids), "pieces"), capacity)


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
