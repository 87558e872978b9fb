"""Language identification with interpolated Kneser-Ney character models.

Fitting reads a bounded sample of labelled rows (``bounded_sample``). Spark counts its character 5-grams; from the
distinct ones come, order by order, the continuation counts and the interpolated probabilities. The models are kept as
sorted arrays: per order the hashes of the n-grams, each with the log probabilities of the languages that have it, and
the hashes of the contexts with the weights that those languages leave to the shorter model. Their size is bounded by
the sample, whatever the number of languages.

A text is scored whole: its n-grams are looked up by binary search, a language that does not know one backs off to the
shorter orders, and the language with the lowest cross-entropy per symbol wins. Rejection is calibrated on documents
that were kept from the counts, whole and in pieces, so that a few long ones are many measurements; where they give too
few, on pieces kept from a second count. It looks at the cross-entropy when each symbol may pick the language that
knows it best, so that a text in two known languages is not taken for noise: for a text of n symbols this is m, give or
take sqrt(t + s / n); a text that lies further above m than those documents do, with a margin, is in none of the
known languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import documents, materialise
from tripflow.llm.hashing import sub_batches

ORDER = 5
#: Code points of the sample over all languages; a language has a twentieth at least while there are up to 100 of them.
SAMPLE_CHARS = 2_000_000
#: Labels with fewer distinct rows do not lower the others' bound: together they have as much again among themselves.
LEAST_ROWS = 20
#: A text counts in by pieces of this part of its language's bound: the first pieces of all texts, then the second ones.
PIECES = 10
#: Every fifth document is not counted; of those up to so many of each language, and so much of each, calibrate.
CALIBRATION, CALIBRATION_ROWS, CALIBRATION_TEXT = 5, 200, 20_000
#: Code points of a piece that is measured; the second where the first gives too few measurements.
MEASURED, LEAST_MEASURED = (500, 50), 20
#: A text is rejected above this many deviations, or above the calibration's 99th percentile times the margin.
LEAST_LIMIT, MARGIN = 6.0, 1.5
UNDETERMINED = "und"
STRETCH = 1 << 17  # symbols of a long text that are scored at once

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def symbols(text: str) -> np.ndarray:
    """Lower-case letters as code points, every run of anything else as one 0; a context of zeros in front, one behind."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(letters()[code], code, 0)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    code = code[keep]
    start = int(len(code) > 0 and code[0] == 0)
    stop = len(code) - int(len(code) > start and code[-1] == 0)
    return np.concatenate([np.zeros(ORDER - 1), code[start:stop], np.zeros(1)]).astype(np.uint64)


def hashes(code: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """64-bit hash of the ``order`` symbols that end at each of ``ends``."""
    h = np.full(len(ends), order, np.uint64)
    for k in range(order):
        h = (h + code[ends - (order - 1 - k)]) * _FACTOR
        h ^= h >> np.uint64(29)
    return h


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search: where each wanted hash is in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


@dataclass
class Sparse:
    """Sorted hashes, and for each of them the values of the languages that have it (``start[i]`` to ``start[i + 1]``)."""

    keys: np.ndarray
    start: np.ndarray
    language: np.ndarray
    value: np.ndarray

    def entries(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``wanted``, languages and values of all entries found."""
        at, hit = _find(self.keys, wanted)
        rows = np.flatnonzero(hit)
        at = at[rows]
        n = self.start[at + 1] - self.start[at]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        where = np.repeat(self.start[at], n) + inside
        return np.repeat(rows, n), self.language[where], self.value[where]


@dataclass
class Models:
    """By order - 1: log probabilities of the n-grams, and back-off weights (logs) of the contexts."""

    languages: list[str]
    grams: list[Sparse]
    contexts: list[Sparse]
    unknown: float
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    noise: float = 0.0
    limit: float = np.inf

    def probabilities(self, code: np.ndarray, ends: np.ndarray, order: int = ORDER) -> np.ndarray:
        """[end, language]: log probability of the symbol at each end, given the ``order - 1`` before it."""
        if order == 0:
            return np.full((len(ends), len(self.languages)), self.unknown, np.float32)
        # equal n-grams are looked up once; sorted ones are found faster
        wanted, first, back = np.unique(hashes(code, ends, order), return_index=True, return_inverse=True)
        ends = ends[first]
        out = self.probabilities(code, ends, order - 1)
        row, language, weight = self.contexts[order - 1].entries(hashes(code, ends - 1, order - 1))
        out[row, language] += weight
        row, language, log = self.grams[order - 1].entries(wanted)
        out[row, language] = log
        return out[back]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per symbol [text, language], the same with the best language for each symbol, and the number
        of symbols of each text."""
        total, count = np.zeros((len(texts), len(self.languages) + 1)), np.zeros(len(texts), np.int64)
        codes, owners, held = [], [], 0
        # a stretch has a row of the languages for each symbol
        stretch = max(1000, STRETCH * 8 // max(8, len(self.languages)))
        for i, text in enumerate(texts):
            code = symbols(text)
            for at in range(0, len(code) - ORDER + 1, stretch):
                part = code[at : at + stretch + ORDER - 1]
                codes.append(part)
                owners.append(i)
                held += len(part)
                if held >= 2 * stretch:
                    self._add(codes, owners, total, count)
                    codes, owners, held = [], [], 0
        if codes:
            self._add(codes, owners, total, count)
        entropy = -total / np.maximum(count, 1)[:, None]
        return entropy[:, :-1], entropy[:, -1], count

    def _add(self, codes, owners, total, count) -> None:
        sizes = np.array([len(c) - ORDER + 1 for c in codes])
        code = np.concatenate(codes)
        starts = np.concatenate([[0], np.cumsum(sizes + ORDER - 1)[:-1]])
        ends = np.concatenate([np.arange(s + ORDER - 1, s + ORDER - 1 + n) for s, n in zip(starts, sizes)])
        own = self.probabilities(code, ends)
        own = np.column_stack([own, own.max(axis=1)])
        sums = np.add.reduceat(own, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0, dtype=np.float64)
        np.add.at(total, owners, sums)
        np.add.at(count, owners, sizes)

    def choose(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, confidence, rejection and cross-entropy of each text."""
        known = letters()
        there = np.array([any(known[ord(c)] for c in t) if t else False for t in texts], bool)
        if not self.languages:
            there[:] = False
        pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rejected, entropy = ~there, np.full(len(texts), np.nan)
        at = np.flatnonzero(there)
        if len(at):
            h, free, n = self.entropies([texts[i] for i in at])
            best = h.argmin(axis=1)
            least = h[np.arange(len(at)), best]
            # odds over the symbols of a phrase: longer texts are no independent evidence
            odds = np.exp(-np.minimum(n, 40)[:, None] * (h - least[:, None])).sum(axis=1)
            score[at], entropy[at] = 1 / odds, least
            rejected[at] = self.deviations(best, free, n) > self.limit
            for i, k in zip(at, best):
                pred[i] = self.languages[k]
        return pred, score, rejected, entropy

    def deviations(self, language: np.ndarray, entropy: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.zeros(len(n))
        return (entropy - self.mean[language]) / np.sqrt(self.spread[language] ** 2 + self.noise / np.maximum(n, 1))


# ---- fitting ---------------------------------------------------------------------------------------------------


def _hash() -> Column:
    """Names a row by id and text: rows with a null or repeated doc_id are as many as their texts."""
    return F.xxhash64("doc_id", "text")


def _index(rows: DataFrame) -> DataFrame:
    """``lang, _h, _n`` of the distinct rows: a row that is repeated any number of times is one."""
    found = rows.where("lang is not null and length(text) > 0").groupBy("lang", _hash().alias("_h")).agg(F.max(F.length("text")).alias("_n"))
    return materialise(found, "langid-index")


def _shared_out(index: DataFrame, chars: int) -> DataFrame:
    """``index`` with the ``_share`` of its language: code points that may be learned from."""
    by = index.groupBy("lang").agg(F.count("*").alias("_rows"))
    many, few = by.agg(F.count_if(F.col("_rows") >= LEAST_ROWS), F.count_if(F.col("_rows") < LEAST_ROWS)).first()
    share = max(chars // max(many, 1), min(chars // 20, 5 * chars // max(many, 1)), PIECES)
    least = max(min(share, chars // max(few, 1)), PIECES)
    shares = by.select("lang", F.when(F.col("_rows") >= LEAST_ROWS, share).otherwise(least).alias("_share"))
    # a row per label; dealt out by label, the index would go to as many tasks as there are languages
    return index.join(F.broadcast(shares), "lang")


def _draw(rows: DataFrame, index: DataFrame, upto: str = "int(_take)") -> DataFrame:
    """``lang, _h, doc_id, text`` of the rows of ``index`` (lang, _h, _n, _share) with the least hashes, up to
    ``_share`` code points for each language, or as many units of ``_n``; of each text the first ``upto`` code points.

    A text comes in pieces of a tenth of the share, the first pieces of all texts before the second ones: long texts
    count in, and one alone takes the share only where there are no others. What is drawn of a text is its beginning.
    Hashes are sliced at powers of 2**(1/8), so a small aggregate finds the slice that crosses the share, and only the
    distinct rows of that slice are put in order.
    """
    place = F.pmod("_h", F.lit(1 << 53))
    unit = F.ceil(F.col("_share") / PIECES)
    last = F.least(F.floor((F.col("_n") - 1) / unit), F.lit(PIECES - 1)).cast("int")
    pieces = index.withColumn("_slice", F.floor(-8 * F.log2((place + 1) / F.lit(float(1 << 53)))).cast("int")).select(
        "lang", "_h", "_slice", "_share", "_n", F.explode(F.sequence(F.lit(0), last)).alias("_piece")
    ).withColumn("_n", F.least(F.col("_n") - F.col("_piece") * unit, unit))
    keys = ["lang", "_piece", "_slice"]
    sums = pieces.groupBy(*keys).agg(F.sum("_n").alias("_all"), F.first("_share").alias("_share"))
    running = F.sum("_all").over(Window.partitionBy("lang").orderBy("_piece", F.desc("_slice")))
    # the slices that begin before the share is full; the last of them may cross it
    begun = sums.withColumn("_before", running - F.col("_all")).where(F.col("_before") < F.col("_share")).drop("_share")
    near = pieces.join(F.broadcast(begun), keys)
    full = F.col("_before") + F.col("_all") <= F.col("_share")
    inside = F.sum("_n").over(Window.partitionBy(*keys).orderBy(place, "_h"))
    crossing = near.where(~full).withColumn("_room", F.col("_share") - F.col("_before") - inside + F.col("_n"))
    taken = near.where(full).select("lang", "_h", "_n").unionByName(
        crossing.where("_room > 0").select("lang", "_h", F.least("_n", "_room").alias("_n")))
    chosen = materialise(taken.groupBy("lang", "_h").agg(F.sum("_n").alias("_take")), "langid-chosen")
    found = rows.withColumn("_h", _hash()).join(chosen, ["lang", "_h"])
    text = F.expr(f"substring(text, 1, {upto})").alias("text")
    return found.select("lang", "_h", "doc_id", text).dropDuplicates(["lang", "_h"])


def bounded_sample(rows: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Distinct ``rows`` (doc_id, text, lang), those with the least hash of id and text first, for each language up to
    its share: ``chars / languages``, and ``chars / 20`` at least while that makes no more than five times ``chars``.
    Labels with under ``LEAST_ROWS`` distinct rows are not counted there; they share ``chars`` among themselves.
    """
    return _draw(rows, _shared_out(_index(rows), chars)).select("doc_id", "text", "lang")


_COUNTS = "lang string, " + ", ".join(f"g{k} bigint, c{k} bigint" for k in range(1, ORDER + 1)) + ", n bigint"


def _count_grams(batches):
    """Distinct 5-grams of each batch by language, with the hashes of their suffixes (g) and contexts (c)."""
    schema = pa.schema([("lang", pa.string())] + [(f"{x}{k}", pa.int64()) for k in range(1, ORDER + 1) for x in "gc"] + [("n", pa.int64())])
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist())
        for lang in np.unique(langs):
            code = np.concatenate([symbols(texts[i]) for i in np.flatnonzero(langs == lang)])
            ends = np.arange(ORDER - 1, len(code))
            # a pad of zeros is context, not something to predict
            ends = ends[(code[ends] != 0) | (code[ends - 1] != 0)]
            _, first, n = np.unique(hashes(code, ends, ORDER), return_index=True, return_counts=True)
            ends = ends[first]
            arrays = [pa.array([str(lang)] * len(ends), pa.string())]
            for k in range(1, ORDER + 1):
                arrays += [pa.array(hashes(code, ends, k).view(np.int64)), pa.array(hashes(code, ends - 1, k - 1).view(np.int64))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(n.astype(np.int64))], schema=schema)


def kneser_ney(counts) -> Models:
    """Models from a pandas table of distinct 5-grams (columns of ``_COUNTS``)."""
    languages = sorted(counts["lang"].unique())
    lang = np.searchsorted(np.array(languages), counts["lang"].to_numpy()) if languages else np.zeros(0, np.int64)
    column = lambda name: counts[name].to_numpy().astype(np.int64).view(np.uint64)
    g, c = ({k: column(f"{x}{k}") for k in range(1, ORDER + 1)} for x in "gc")
    out = Models(languages, [], [], -np.log(1000.0))
    wide = max(len(languages), 1)

    def sparse(keys, entry, value):
        """Values by entry (key number times languages, plus language; sorted)."""
        start = np.searchsorted(entry // wide, np.arange(len(keys) + 1))
        return Sparse(keys, start, (entry % wide).astype(np.int32), value.astype(np.float32))

    # from the distinct n-grams of the order above: each is one continuation of its suffix
    tables = {}
    rows, own = np.arange(len(lang)), counts["n"].to_numpy().astype(np.float64)
    for k in range(ORDER, 0, -1):
        grams, back = np.unique(g[k][rows], return_inverse=True)
        entry, pair, at = np.unique(back * wide + lang[rows], return_index=True, return_inverse=True)
        # distinct (n-gram, language) pairs go on to the next shorter order
        rows, own = rows[pair], np.bincount(at, own, len(entry))
        tables[k] = (grams, entry, rows, own)
        own = np.ones(len(rows))
    below = shorter_grams = shorter_entry = None
    for k in range(1, ORDER + 1):
        grams, entry, rows, count = tables[k]
        of = lang[rows]
        contexts, back = np.unique(c[k][rows], return_inverse=True)
        outer, at = np.unique(back * wide + of, return_inverse=True)
        total, types = np.bincount(at, count, len(outer)), np.bincount(at, minlength=len(outer))
        once, twice = (np.bincount(of[count == n], minlength=wide) for n in (1, 2))
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        weight = discount[outer % wide] * types / total
        if k == 1:
            shorter = np.full(len(entry), np.exp(out.unknown))
        else:
            where, there = _find(shorter_grams, g[k - 1][rows])
            assert there.all(), "every suffix is an n-gram of the order below"
            shorter = below[np.searchsorted(shorter_entry, where * wide + of)]
        below = np.maximum(count - discount[of], 0) / total[at] + weight[at] * shorter
        shorter_grams, shorter_entry = grams, entry
        out.grams.append(sparse(grams, entry, np.log(below)))
        out.contexts.append(sparse(contexts, outer, np.log(weight)))
    return out


def fit(rows: DataFrame, chars: int = SAMPLE_CHARS) -> Models:
    """Models of every language of ``rows`` (doc_id, text, lang): from text and lang alone; id and text pick the sample.

    Rows with null text or null lang are passed over; no rows give models without languages. Labelled texts that have
    fewer than 20 pieces of 50 code points to keep out (under about 5,000 in all) calibrate nothing: then only texts
    without letters are rejected.
    """
    labelled = rows.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    index = _index(labelled)
    kept_out = F.pmod(F.xxhash64("_h", F.lit("calibration")), F.lit(CALIBRATION)) == 0
    # a language whose rows would all be kept out is counted
    free = index.groupBy("lang").agg(F.count_if(~kept_out).alias("_free"))
    index = materialise(index.join(F.broadcast(free), "lang").select("lang", "_h", "_n", (kept_out & (F.col("_free") > 0)).alias("_held")), "langid-split")
    learn = index.where("not _held").drop("_held")
    sample = materialise(_draw(labelled, _shared_out(learn, chars)).select("lang", "_h", "text"), "langid-sample")
    models = kneser_ney(_counted(sample))
    if not models.languages:
        return models
    # a row counts as one, so this draws rows
    calibrate = index.where("_held").select("lang", "_h", F.lit(1).alias("_n"), F.lit(CALIBRATION_ROWS).alias("_share"))
    held = materialise(_draw(labelled, calibrate, str(CALIBRATION_TEXT)).select("lang", "text"), "langid-held")
    for size in MEASURED:
        found = _measured(held, models, size)
        if len(found) >= LEAST_MEASURED:
            return _calibrated(models, found)
    # too little was kept out: every fifth piece of the sample, under models of the other pieces
    for size in MEASURED:
        start = F.explode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(size))).alias("_at")
        pieces = sample.select("lang", "_h", "text", start).select(
            "lang", "_h", "_at", F.expr(f"substring(text, _at + 1, {size})").alias("text"))
        out = F.pmod(F.xxhash64("_h", "_at"), F.lit(CALIBRATION)) == 0
        others = kneser_ney(_counted(pieces.where(~out)))
        found = _measured(pieces.where(out), others, size) if others.languages else []
        if len(found) >= LEAST_MEASURED:
            found["l"] = [models.languages.index(others.languages[k]) for k in found["l"]]
            return _calibrated(models, found)
    return models


def _counted(sample: DataFrame):
    keys = ["lang", f"g{ORDER}"]
    rest = [F.first(x).alias(x) for x in (f"{y}{k}" for k in range(1, ORDER + 1) for y in "gc") if x not in keys]
    counted = sample.select("lang", "text").mapInArrow(_count_grams, _COUNTS)
    return counted.groupBy(*keys).agg(F.sum("n").alias("n"), *rest).toArrow().to_pandas()


def _measured(held: DataFrame, models: Models, size: int):
    """Language, cross-entropy and symbols of each text with letters and, where there are several, of its pieces."""
    shared = held.sparkSession.sparkContext.broadcast(models)

    def measure(batches):
        m = shared.value
        number = {x: k for k, x in enumerate(m.languages)}
        for batch in batches:
            for b in sub_batches(batch, "text"):
                own, texts = [], []
                for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                    pieces = [text[at : at + size] for at in range(0, len(text), size)]
                    for x in [text, *pieces] if len(pieces) > 1 else [text]:
                        if lang in number and any(ch.isalpha() for ch in x):
                            own.append(number[lang])
                            texts.append(x)
                _, h, n = m.entropies(texts)
                yield pa.RecordBatch.from_pydict({
                    "l": pa.array(own, pa.int32()), "h": pa.array(h, pa.float64()), "n": pa.array(n, pa.int64())
                })

    found = held.select("lang", "text").mapInArrow(measure, "l int, h double, n bigint").toArrow().to_pandas()
    shared.destroy()  # the calibrated models are broadcast anew; executors hold them once
    return found


def _calibrated(models: Models, found) -> Models:
    lang, h, n = (found[x].to_numpy() for x in "lhn")
    models.mean = np.array([np.median(h[lang == k]) if (lang == k).sum() >= 5 else np.median(h) for k in range(len(models.languages))])
    off = h - models.mean[lang]
    models.spread = np.full(len(models.languages), 0.02) * models.mean
    models.noise = float(np.median(off**2 * n) / 0.455)  # the median of a squared unit normal
    models.limit = max(LEAST_LIMIT, MARGIN * float(np.quantile(models.deviations(lang, h, n), 0.99)))
    return models


def predict(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, text, lang, source`` of all documents with ``lang_pred, score, rejected, entropy``.

    Only the text is an input. Null text and text without a letter are ``und`` with score 0, and rejected. Other
    columns are not carried; repeated rows are predicted alike; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the sample

    def run(batches):
        m = shared.value
        for b in batches:
            for own in sub_batches(b, "text"):
                pred, score, rejected, entropy = m.choose(own.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(rejected),
                     pa.array(entropy, from_pandas=True)],
                    names=[*own.schema.names, "lang_pred", "score", "rejected", "entropy"],
                )

    schema = "doc_id bigint, text string, lang string, source string, lang_pred string, score double, rejected boolean, entropy double"
    return documents(docs).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    found = predict(docs, fit(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")
