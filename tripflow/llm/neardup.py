"""Near duplicates by weighted MinHash (BagMinHash) over multisets of word shingles.

A document is the multiset of its shingles. Its weighted Jaccard similarity with another is the sum of the smaller
multiplicities over the sum of the larger ones. Every shingle owns a hierarchy of Poisson processes over the weight
axis, one to each doubling (0..1, 1..2, 2..4, ..), seeded by the shingle and the level; a point has a time, a weight
and a signature component, and counts for a document if its weight is within the shingle's multiplicity. The earliest
point of each component is the signature: two documents share a component with a probability equal to their
similarity. A process stops once its time is past the latest component, so most shingles cost one point.

Signatures are banded. Equal texts are one vertex. In each bucket the members are first compared with its most
central member, a linear number of pairs, and the links found are joined to components. What is left are buckets in which
several components meet, mostly texts that share a passage and are not similar enough. Their members are compared
through rare shingles: of two multisets with similarity t, each ordered by how many of these documents have a shingle,
the first n - t n + 1 elements must share one; and what a document shares with any other at all bounds their overlap.
So texts that only share what many have are not paired. Every pair is verified on the exact multisets of both texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import materialise
from tripflow.llm.components import connected_components
from tripflow.llm.hashing import mix, sequences, slices, sub_batches, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
#: 42 bands of 6: a pair at the threshold is missed with probability (1 - 0.8**6)**42 = 3e-6.
ROWS, BANDS = 6, 42
#: Of 252 components reduced to two bits a pair at the threshold differs in 38 +- 5.7; four and a half deviations more
#: are let through, so that a pair is missed with probability 4e-6.
SKETCH_DIFFER = 63
#: Of a document's rare shingles so many, the least ones, go with each of its rows to tell where a pair came before.
LEAST_RARE = 64
#: Equal rows that one step of the output makes at once.
ROWS_AT_ONCE = 100_000


def text_digest(text: Column) -> Column:
    """128 bits of the text's SHA-256; null texts are empty ones."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), 1, 32))


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, and the text of each; a text with fewer words is one shingle of all of them."""
    h, n = word_hashes(texts)
    stops = np.cumsum(n)
    out, own = sequences(h, size), np.repeat(np.arange(len(n)), n)
    ok = np.arange(len(out)) + size <= stops[own[: len(out)]]
    short = [(i, h[stops[i] - n[i] : stops[i]]) for i in np.flatnonzero((n > 0) & (n < size))]
    some = np.array([sequences(x, len(x))[0] for _, x in short], np.uint64)
    return np.concatenate([out[ok], some]), np.concatenate([own[: len(out)][ok], np.array([i for i, _ in short], np.int64)])


def bag_minhash(shingle: np.ndarray, owner: np.ndarray, n: int, components: int) -> np.ndarray:
    """Signatures [document, component] of the multisets; owners without shingles have infinite components."""
    _, first, weight = np.unique(
        mix(shingle + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True
    )
    shingle, owner = shingle[first], owner[first]
    # one process to each level that the multiplicity reaches into
    levels = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    which = np.repeat(np.arange(len(weight)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, weight = owner[which], weight[which].astype(np.float64)
    seed = mix(shingle[which] + level.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    low = np.where(level > 0, np.exp2(level - 1.0), 0.0)
    rate = np.maximum(low, 1.0)  # the level's length
    out = np.full(n * components, np.inf)
    time = np.zeros(len(seed))
    while len(seed):
        seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
        time = time - np.log(((seed >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / rate
        more = mix(seed ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        component = (more >> np.uint64(32)).astype(np.int64) * components >> 32
        at = low + (more & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * rate
        slot = owner * components + component
        counts = (at < weight) & (time < out[slot])
        np.minimum.at(out, slot[counts], time[counts])
        going = time < out.reshape(n, components).max(axis=1)[owner]
        seed, time, owner, weight, low, rate = (x[going] for x in (seed, time, owner, weight, low, rate))
    return out.reshape(n, components)


_SIGNED = "doc_id bigint, digest binary, n bigint, bands array<bigint>, sketch array<bigint>"


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, n, bands, sketch`` of every document: text digest, shingles, band hashes, two bits a component."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()),
                            ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
        for batch in batches:
            for part in sub_batches(batch, "text"):
                some = [(t or "").encode() for t in part.column("text").to_pylist()]
                shingle, owner = shingles(some)
                n = np.bincount(owner, minlength=len(some))
                value = bag_minhash(shingle, owner, len(some), ROWS * BANDS).view(np.uint64)
                band = sequences_across(value.reshape(len(some), BANDS, ROWS))
                code = mix(value)
                planes = [((code >> np.uint64(k)) & np.uint64(1)).astype(bool) for k in (0, 1)]
                packed = np.hstack([np.packbits(np.pad(x, ((0, 0), (0, 256 - x.shape[1]))), axis=1).view(np.int64) for x in planes])
                lists = lambda x: pa.ListArray.from_arrays(
                    np.arange(len(some) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("digest").cast(pa.binary()),
                    pa.array(n.astype(np.int64)), lists(band.view(np.int64)), lists(packed),
                ], schema=schema)

    return docs.select("doc_id", "text", text_digest(F.col("text")).alias("digest")).mapInArrow(run, _SIGNED)


def sequences_across(values: np.ndarray) -> np.ndarray:
    """Hash of each band, [document, band], with the band's number."""
    out = np.broadcast_to(np.arange(values.shape[1], dtype=np.uint64) + np.uint64(1), values.shape[:2]).copy()
    for k in range(values.shape[2]):
        out = mix(out ^ values[:, :, k]) + np.uint64(k)
    return out


def _differ(x: Column, y: Column) -> Column:
    """In how many components two sketches differ: in either of their two bit planes of four words."""
    return sum(F.bit_count(x[k].bitwiseXOR(y[k]).bitwiseOR(x[k + 4].bitwiseXOR(y[k + 4]))) for k in range(4))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity reaches the threshold."""

    def run(batches):
        remembered: dict[int, tuple] = {}

        def bag(v: int, text: str):
            if v not in remembered:
                if len(remembered) > 200:
                    remembered.clear()
                remembered[v] = np.unique(shingles([text.encode()])[0], return_counts=True)
            return remembered[v]

        for batch in batches:
            a, b, ta, tb = (batch.column(k).to_pylist() for k in ("a", "b", "ta", "tb"))
            keep = []
            for i in range(len(a)):
                (x, nx), (y, ny) = bag(a[i], ta[i]), bag(b[i], tb[i])
                _, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                both = np.minimum(nx[ix], ny[iy]).sum()
                keep.append(both >= threshold * (nx.sum() + ny.sum() - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("v").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("v").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def _rare_pairs(unsettled: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of ``unsettled`` vertices (v, c, n, sketch) of different components that share a rare shingle, one of the
    first ``n - threshold * n + 1`` elements, and whose sizes and sketches allow the threshold."""

    def run(batches):
        for batch in batches:
            ids, some = batch.column("v").to_numpy(), [t.encode() for t in batch.column("text").to_pylist()]
            for lo, hi in slices(some):
                shingle, owner = shingles(some[lo:hi])
                _, first, weight = np.unique(mix(shingle + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                                             return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + owner[first]]), pa.array(shingle[first].view(np.int64)), pa.array(weight.astype(np.int64))],
                    names=["v", "shingle", "weight"])

    rows = texts.join(unsettled.select("v"), "v", "left_semi").mapInArrow(run, "v bigint, shingle bigint, weight bigint")
    rows = materialise(rows, "shingles")
    shared = rows.groupBy("shingle").agg(F.count("*").alias("f")).where("f > 1")
    order = Window.partitionBy("v").orderBy("f", "shingle")  # one document's shingles
    before = F.sum("weight").over(order) - F.col("weight")
    whole = Window.partitionBy("v")
    size, common = F.sum("weight").over(whole), F.sum(F.when(F.col("f") > 1, F.col("weight")).otherwise(0)).over(whole)
    rare = rows.join(shared, "shingle", "left").withColumn("f", F.coalesce("f", F.lit(1))).select(
        "v", "shingle", "f", before.alias("before"), size.alias("size"), common.alias("common")
    ).where((F.col("before") < F.col("size") - F.ceil(threshold * F.col("size") - 1e-9) + 1) & (F.col("f") > 1))
    rare = materialise(rare.select("v", "shingle", "common"), "rare")
    least = rare.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("shingle")), 1, LEAST_RARE).alias("least"))
    rare = materialise(rare.join(unsettled.join(least, "v"), "v"), "rare")
    x, y = rare.alias("x"), rare.alias("y")
    differ = _differ(F.col("x.sketch"), F.col("y.sketch"))
    # similarity t of sizes n and m takes an overlap of t / (1 + t) * (n + m), all of it in shared shingles
    enough = F.least("x.common", "y.common") >= threshold / (1 + threshold) * (F.col("x.n") + F.col("y.n")) - 1e-9
    # not where the pair has met before, at a lesser shingle of both lists; longer documents may meet more than once
    met = F.coalesce(F.array_min(F.array_intersect("x.least", "y.least")) < F.col("x.shingle"), F.lit(False))
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.v") < F.col("y.v")) & (F.col("x.c") != F.col("y.c"))
                  & (F.least("x.n", "y.n") >= threshold * F.greatest("x.n", "y.n")) & enough & (differ <= SKETCH_DIFFER) & ~met
                  ).select(F.col("x.v").alias("a"), F.col("y.v").alias("b")).distinct()


def text_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, digest, times, class_id, kept``: a row for each distinct pair of doc_id and text, and how often it comes.

    Of the rows of a kept doc_id the text with the least digest is kept. See ``near_duplicates``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialise(signatures(docs), "signatures")
    distinct = materialise(signed.groupBy("doc_id", "digest").agg(F.count("*").alias("times"), F.max("n").alias("n")), "distinct")
    able = distinct.where("doc_id is not null and n > 0")
    # a vertex is a text; its number is written with it and means nothing else
    copies = able.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    reps = signed.where("n > 0").join(copies, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
    reps = materialise(reps.select(F.monotonically_increasing_id().alias("v"), "doc_id", "digest", "n", "bands", "sketch"), "reps")
    banded = reps.select(F.explode("bands").alias("band"), "v")
    buckets = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    # members of buckets with company; the more company over all bands, the more central a document is
    members = materialise(banded.join(buckets, "band"), "members")
    central = members.groupBy("v").agg(F.sum("size").alias("company"))
    pivots = members.join(central, "v").groupBy("band").agg(F.max_by("v", F.struct(F.col("company"), -F.col("v"))).alias("pivot"))
    paired = members.join(pivots, "band").where("v <> pivot").select(
        F.least("v", "pivot").alias("a"), F.greatest("v", "pivot").alias("b"), F.col("v").alias("of"))
    sketches = reps.select("v", "n", "sketch")

    a = sketches.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sketches.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    differ = _differ(F.col("sa"), F.col("sb"))
    sized = F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    # pairs whose sizes and sketches allow the threshold
    starred = materialise(paired.distinct().join(a, "a").join(b, "b").where(sized & (differ <= SKETCH_DIFFER)).select(
        "a", "b", "of", differ.alias("differ")), "starred")
    wanted = reps.join(members.select("v").distinct(), "v", "left_semi").select("v", "doc_id", "digest")
    texts = docs.withColumn("digest", text_digest(F.col("text"))).join(wanted, ["doc_id", "digest"])
    texts = materialise(texts.dropDuplicates(["doc_id", "digest"]).select("v", "text"), "texts")

    nearest = starred.groupBy("of").agg(F.min_by(F.struct("a", "b"), F.struct("differ", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    links = materialise(_verified(nearest, texts, threshold), "links")
    parts = connected_components(links)

    def across(pairs: DataFrame) -> DataFrame:
        """Pairs that are not in one component yet."""
        a = parts.select(F.col("id").alias("a"), F.col("component").alias("ca"))
        b = parts.select(F.col("id").alias("b"), F.col("component").alias("cb"))
        own = F.coalesce("ca", "a") != F.coalesce("cb", "b")
        return pairs.join(a, "a", "left").join(b, "b", "left").where(own).select("a", "b")

    starred = starred.select("a", "b").distinct()
    more = materialise(_verified(across(starred), texts, threshold), "links")
    links = links.unionByName(more)
    parts = connected_components(links)

    placed = members.join(parts.withColumnRenamed("id", "v"), "v", "left").select("band", "v", F.coalesce("component", "v").alias("c"))
    several = placed.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("band")
    unsettled = placed.join(several, "band", "left_semi").select("v", "c").distinct()
    unsettled = materialise(unsettled.join(sketches, "v"), "unsettled")
    rest = _rare_pairs(unsettled, texts, threshold).join(starred, ["a", "b"], "left_anti")
    last = materialise(_verified(rest, texts, threshold), "links")
    # texts of one doc_id belong together
    several = able.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1").select("doc_id")
    held = able.select("doc_id", "digest").join(several, "doc_id", "left_semi").join(reps.select("digest", "v"), "digest")
    held = materialise(held.select("doc_id", "v"), "held")
    same = held.join(held.groupBy("doc_id").agg(F.min("v").alias("a")), "doc_id").where("v <> a").select("a", F.col("v").alias("b"))
    parts = connected_components(links.unionByName(last).unionByName(same))

    # the smallest doc_id of a component, by its texts' smallest ones
    named = reps.select("v", "doc_id", "digest").join(parts.withColumnRenamed("id", "v"), "v", "left").select(
        "doc_id", "digest", F.coalesce("component", "v").alias("c"))
    named = materialise(named, "named")
    smallest = named.groupBy("c").agg(F.min("doc_id").alias("class_id"))
    classes = named.join(smallest, "c").select("digest", "class_id")
    found = able.select("doc_id", "digest").join(classes, "digest")
    # a text without words beside others of its doc_id is in their class
    by_id = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    kept = distinct.where("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("least"))
    verdicts = kept.join(by_id, "doc_id", "left").select("doc_id", "least", F.coalesce("class_id", "doc_id").alias("class_id"))
    whole = distinct.where("doc_id is not null").join(verdicts, "doc_id").select(
        "doc_id", "digest", "times", "class_id", ((F.col("class_id") == F.col("doc_id")) & (F.col("digest") == F.col("least"))).alias("kept"))
    none = distinct.where("doc_id is null").select("doc_id", "digest", "times", F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("kept"))
    return whole.unionByName(none)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, kept`` for every row: the smallest doc_id of its class, and whether it stands for it.

    A class is everything linked by equal texts or similarities of ``threshold`` and more over five-word shingles
    (fewer words: one shingle), or by a common doc_id: of a repeated doc_id every text has its links. Texts without
    words, null ones too, are never duplicates. Rows with a null doc_id cannot be linked: their class is null and they
    are kept. Of rows that repeat a doc_id one is kept, with the least digest. An empty table gives no rows; other
    columns are not carried.
    """
    rows = text_classes(docs, threshold)
    # equal rows come back as often as they were there, in steps
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / ROWS_AT_ONCE)))
    rows = rows.select("*", step.alias("_step"))
    upto = F.least(F.col("times") - F.col("_step") * ROWS_AT_ONCE, F.lit(ROWS_AT_ONCE).cast("long"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), upto)).alias("_row"))
    one = (F.col("_step") == 0) & (F.col("_row") == 1)
    return rows.select("doc_id", "class_id", (F.col("kept") & (one | F.col("doc_id").isNull())).alias("kept"))


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM split),
bags AS (
  SELECT doc_id, array_to_string(words[i : i + {SHINGLE - 1}], ' ') AS s, count(*) AS c FROM starts GROUP BY ALL
  UNION ALL SELECT doc_id, array_to_string(words, ' '), 1 FROM split WHERE len(words) BETWEEN 1 AND {SHINGLE - 1}
), sizes AS (SELECT doc_id, sum(c) AS n FROM bags GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS o FROM bags x JOIN bags y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), pairs AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE o >= CAST({THRESHOLD} AS DOUBLE) * (x.n + y.n - o)
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(b, doc_id)) AS class_id, doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM split LEFT JOIN least_of ON a = doc_id"""
