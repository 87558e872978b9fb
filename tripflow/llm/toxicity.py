"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, pairs of neighbouring words, and pairs with one or two words skipped, hashed to
2**BITS numbers; each counts once. Every coordinate has its own learning rate, from the gradients it has seen, and L1
keeps all but a few thousand weights at zero, so what the scan needs is a small sorted table of numbers and weights.

The fit is on a bounded sample (SAMPLE_ROWS documents, SAMPLE_CHARS code points): the labels with the least hash of
their doc_id, in that order, whole texts. Features are extracted in parallel; the pass over them is one task of
that bounded size. Scoring is one scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import materialise, table
from tripflow.llm.hashing import Substrings, mix, slices, sub_batches

#: The bounds of the sample that the weights are learned from.
SAMPLE_ROWS, SAMPLE_CHARS = 20_000, 24_000_000
BITS = 22
#: FTRL-proximal: learning rate, its smoothing, the two penalties, and passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 6.0, 1.0, 4
#: A score from here on is predicted toxic.
THRESHOLD = 0.3
#: Bytes of one text that are hashed at a time.
PIECE = 4 << 20
SKIPS = 2  # words skipped at most

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARKS = re.compile("[ -⁯¡«»¿]")  # punctuation beyond ASCII


def _bytes(text: str | None) -> bytes:
    text = (text or "").lower()
    return (text if text.isascii() else _MARKS.sub(" ", text)).encode()


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _LETTER[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], Substrings(raw)(edge[::2], edge[1::2])


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes that end between words."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        while to < len(data) and _LETTER[data[to]]:
            to += 1
        yield data[at:to]
        at = to


def grams(texts: list[str | None], piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (index of the text, feature); a feature of a text may come several times. Long texts come in pieces."""
    for lo, hi in slices(texts, piece // 4):
        whole = [_bytes(t) for t in texts[lo:hi]]
        offsets = np.cumsum([0] + [len(t) + 1 for t in whole])
        joined = [b" ".join(whole)] if hi - lo > 1 else _pieces(whole[0], piece)
        tail = np.zeros(0, np.uint64)  # the last words of the piece before
        for data in joined:
            start, h = _words(data)
            own = np.searchsorted(offsets[1:], start, side="right") if hi - lo > 1 else np.zeros(len(h), np.int64)
            h, own = np.concatenate([tail, h]), np.concatenate([np.zeros(len(tail), np.int64), own])
            known = len(tail)
            found, owner = [h[known:]], [own[known:]]
            for k in range(1, SKIPS + 2):
                new = np.arange(max(known, k), len(h))  # the later word is of this piece
                new = new[own[new - k] == own[new]]
                found.append(mix(mix(h[new - k] + np.uint64(k)) ^ h[new]))
                owner.append(own[new])
            yield lo + np.concatenate(owner), (mix(np.concatenate(found)) >> np.uint64(64 - BITS)).astype(np.int64)
            tail = h[-(SKIPS + 1) :]


@dataclass
class Weights:
    """Features with a weight, ascending, their weights, and the bias."""

    features: np.ndarray
    values: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        margin = np.full(len(texts), self.bias)
        hits = [np.zeros(0, np.int64)]
        dense = np.zeros(1 << BITS, bool)
        dense[self.features] = True
        for own, feature in grams(texts):
            met = np.flatnonzero(dense[feature])
            hits.append(np.unique((own[met] << BITS) | feature[met]))
        hit = np.unique(np.concatenate(hits))  # once for each text
        if len(hit):
            np.add.at(margin, hit >> BITS, self.values[np.searchsorted(self.features, hit & ((1 << BITS) - 1))])
        # nothing learned: no text is toxic at all
        return np.where(margin == -np.inf, 0.0, 1 / (1 + np.exp(-np.clip(margin, -700, 700))))


def ftrl(rows: list[tuple[np.ndarray, int]], alpha=ALPHA, beta=BETA, l1=L1, l2=L2, epochs=EPOCHS) -> Weights:
    """FTRL-proximal over rows of (distinct features, label 0 or 1) in their order; the bias has no penalty.

    No rows give a bias of minus infinity: a score of 0 for every text.
    """
    if not rows:
        return Weights(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    z, n, bias_z, bias_n = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0

    def weight(z, n, l1=l1, l2=l2):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for features, label in rows:
            zi, ni = z[features], n[features]
            w, bias = weight(zi, ni), float(weight(bias_z, bias_n, 0.0, 0.0))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -700, 700))) - label
            z[features] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[features] = ni + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    w = weight(z, n)
    has = np.flatnonzero(w)
    return Weights(has, w[has], float(weight(bias_z, bias_n, 0.0, 0.0)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning (false without a doc_id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """``place, text, toxic`` of at most ``rows`` labelled documents that are not held out, up to the one whose text
    reaches ``chars`` code points.

    A doc_id with several labels is toxic if one says so; with several texts, one of them is taken (by hash). Null ids,
    labels and texts are not learned from.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    # labels without a document take no place; semi-joined before the cut, hot ids being one row by then
    there = texts.select("doc_id").join(known, "doc_id").dropDuplicates(["doc_id"])
    place = F.xxhash64("doc_id")
    first = materialise(there.orderBy(place, "doc_id").limit(rows), "labelled")  # at most ``rows`` rows
    hashed = texts.select("doc_id", F.xxhash64("text").alias("h"), F.length("text").cast("long").alias("n"))
    chosen = hashed.join(F.broadcast(first), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("h", "n")).alias("t"), F.first("toxic").alias("toxic"))
    before = F.sum("t.n").over(Window.orderBy(place, "doc_id").rowsBetween(Window.unboundedPreceding, -1))  # at most ``rows`` rows
    chosen = materialise(chosen.select("doc_id", "t.h", "toxic", F.coalesce(before, F.lit(0)).alias("before"))
                         .where(F.col("before") < chars).drop("before"), "chosen")
    return texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "h"]).groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text")).select(place.alias("place"), "doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, **settings) -> Weights:
    """Weights learned from the bounded sample; ``settings`` go to ``ftrl``."""

    def extract(batches):
        for batch in batches:
            for part in sub_batches(batch, "text"):
                texts = part.column("text").to_pylist()
                own, feature = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for o, f in grams(texts):
                    key = np.unique((o << BITS) | f)
                    own.append(key >> BITS)
                    feature.append(key & ((1 << BITS) - 1))
                key = np.unique((np.concatenate(own) << BITS) | np.concatenate(feature))
                ends = np.searchsorted(key, np.arange(len(texts) + 1) << BITS)
                low = (key & ((1 << BITS) - 1)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("place"), part.column("doc_id"), part.column("toxic"),
                     pa.array([low[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())], names=["place", "doc_id", "toxic", "features"])

    def learn(batches):
        known = []
        for batch in batches:
            for features, label in zip(batch.column("features").to_pylist(), batch.column("toxic").to_pylist()):
                known.append((np.frombuffer(features, "<u4"), 1 if label else 0))
        found = ftrl(known, **settings)
        yield pa.RecordBatch.from_arrays([pa.array([*found.features.tolist(), -1], pa.int64()), pa.array([*found.values.tolist(), found.bias], pa.float64())],
                                         names=["feature", "weight"])

    extracted = sample(docs, labels, rows, chars).repartition("doc_id").mapInArrow(extract, "place bigint, doc_id bigint, toxic int, features binary")
    found = extracted.repartition(1).sortWithinPartitions("place", "doc_id").mapInArrow(learn, "feature bigint, weight double").toPandas()
    found = found.sort_values("feature")
    features, values = found["feature"].to_numpy(), found["weight"].to_numpy()
    if not len(features):
        return ftrl([])
    return Weights(features[1:], values[1:], float(values[0]))


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """``doc_id, score`` of every document; null and empty texts have the score of the bias. Rows and doc_ids stay as
    they are, further columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # features with a weight: at most 2**BITS, in practice thousands

    def run(batches):
        for batch in batches:
            for part in sub_batches(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(shared.value.scores(part.column("text").to_pylist()))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by weights learned from the labels of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
