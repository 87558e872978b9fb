"""Mixing sources to target weights by temperature.

A source with token share s gets weight s**a / sum(s**a). The exponent a is bisected on the table of sources to the
flattest mix that keeps a limit on repetition, or to a target entropy. Weights times the total budget give each source
a number of tokens; the source is cut into hash blocks, every pass over it (epoch) is a permutation of its blocks, and
the last pass takes blocks until the budget is met. All of it is DataFrame expressions; the corpus is only scanned,
hot sources are split into blocks, and what is joined to it is the plan of blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, documents, materialise

#: Words of a block on average, and the least number of blocks of a source: a budget is met to half a block.
BLOCK_TOKENS, LEAST_BLOCKS = 200_000, 64
#: The query's repetition limit.
MAX_REPEAT = 2.0
DIGITS = 6  # of the exponent


def hashed(*parts: Column) -> Column:
    """60 bits of md5 over the parts, the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def digest(text: Column) -> Column:
    """Documents are dealt by doc_id and this, so that null or repeated ids spread; null texts have none."""
    return F.md5(F.encode(text, "UTF-8"))


def tokens(text: Column) -> Column:
    """The unit of budgets: words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _measures(sources: DataFrame, exponents: list[float], budget: int | None) -> list[tuple[float, float]]:
    """(entropy, largest repetition) of the mix at each exponent, in one aggregate over the sources."""
    share = F.log(F.col("n") / F.col("total"))
    aggs = []
    for i, a in enumerate(exponents):
        power = F.exp(a * share)
        aggs += [F.sum(power).alias(f"z{i}"), F.sum(power * a * share).alias(f"e{i}"),
                 F.max(F.exp((a - 1) * share)).alias(f"most{i}"), F.min(F.exp((a - 1) * share)).alias(f"least{i}")]
    r = sources.where("n > 0").agg(F.max("total").alias("total"), *aggs).first()
    out = []
    for i in range(len(exponents)):
        z = r[f"z{i}"]
        # repetition of a source: budget * weight / tokens = budget / total * share**(a - 1) / z
        scale = budget / (r["total"] * z) if budget else 1 / r[f"least{i}"]
        out.append((math.log(z) - r[f"e{i}"] / z, r[f"most{i}"] * scale))
    return out


def bisect_exponent(
    sources: DataFrame, max_repeat: float | None = None, entropy: float | None = None, budget: int | None = None
) -> float:
    """The least exponent in 0..1 whose largest repetition keeps ``max_repeat``, or the largest with ``entropy`` at least.

    Both fall as the exponent rises. Sixteen cuts per aggregate narrow the interval; 1 if nothing satisfies the limit,
    0 for an entropy beyond that of equal weights.
    """
    lo, hi = 0.0, 1.0
    for _ in range(7):
        cuts = [lo + (hi - lo) * k / 16 for k in range(17)]
        found = _measures(sources, cuts, budget)
        # the first cut that is far enough down
        past = [k for k, (h, rep) in enumerate(found) if (rep <= max_repeat * (1 + 1e-12) if max_repeat else h < entropy)]
        if not past:
            return 1.0
        if past[0] == 0:
            return round(cuts[0], DIGITS)
        lo, hi = cuts[past[0] - 1], cuts[past[0]]
    # rounded towards keeping the condition
    up = max_repeat is not None
    return (math.ceil(hi * 10**DIGITS - 1e-3) if up else math.floor(lo * 10**DIGITS + 1e-3)) / 10**DIGITS


def mix(
    docs: DataFrame, max_repeat: float | None = MAX_REPEAT, entropy: float | None = None, budget: int | None = None,
    seed: int = 0, block_tokens: int = BLOCK_TOKENS, least_blocks: int = LEAST_BLOCKS,
) -> DataFrame:
    """Documents in the mix, a row for each use: ``doc_id, text, lang, source, tokens, epoch, block, place, weight``.

    ``place`` in 0..1 orders the mix: sorted by it, every stretch has the sources in their weights. Without ``budget``
    (tokens) the budget is the least that uses every document once, so nothing is dropped and smaller sources repeat.

    A null source is a source of its own. Null and blank texts have no tokens; a source without any tokens is used
    once, outside the weights. Null and repeated doc_ids are dealt out by their texts. Repeated rows (doc_id and text)
    are documents of their own that stay together: they are in one block and at one place. An empty table gives no rows;
    other columns of the input are not carried.
    """
    rows = documents(docs).withColumn("tokens", tokens(F.col("text"))).withColumn("digest", digest(F.col("text")))
    slim = materialise(rows.select("doc_id", "source", "tokens", "digest"), "mix-sizes")
    totals = materialise(slim.groupBy("source").agg(F.sum("tokens").alias("n")), "mix-sources")
    total = totals.agg(F.sum("n").alias("total")).first()["total"] or 0
    totals = totals.withColumn("total", F.lit(total).cast("bigint"))
    known = totals.where("n > 0").agg(F.max("n").alias("n"), F.count("*").alias("k")).first()
    if not known["k"]:
        a, scale = 1.0, 1.0
    else:
        a = bisect_exponent(totals, None if entropy is not None else max_repeat, entropy, budget)
        z = totals.where("n > 0").agg(
            F.sum(F.pow(F.col("n") / F.col("total"), F.lit(a))).alias("z"), F.max("total").alias("total"),
            F.min(F.pow(F.col("n") / F.col("total"), F.lit(a - 1))).alias("least"),
        ).first()
        scale = budget / (z["total"] * z["z"]) if budget else 1 / z["least"]
    share = F.col("n") / F.col("total")
    weight = F.when(F.col("n") > 0, F.pow(share, F.lit(a)) / F.lit(z["z"] if known["k"] else 1.0)).otherwise(0.0)
    repeat = F.when(F.col("n") > 0, F.round(F.pow(share, F.lit(a - 1)) * scale, 9)).otherwise(1.0)
    targets = totals.select(
        "source", "n", weight.alias("weight"), repeat.alias("repeat"),
        F.greatest(F.lit(least_blocks), F.ceil(F.col("n") / block_tokens)).cast("bigint").alias("n_blocks"),
    )

    def blocked(df: DataFrame) -> DataFrame:
        own = targets.select(F.col("source").alias("_source"), F.col("n_blocks").alias("_blocks"))
        return df.join(own, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
            "block", F.pmod(hashed(F.lit(seed), F.col("doc_id"), F.col("digest")), F.col("_blocks"))
        ).drop("_source", "_blocks")

    blocks = blocked(slim).groupBy("source", "block").agg(F.sum("tokens").alias("in_block"))
    passes = blocks.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        "b.source", "b.block", "in_block", "n", "weight", "repeat",
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("repeat").cast("int") - 1, F.lit(0)))).alias("epoch"),
    )
    order = Window.partitionBy("source", "epoch").orderBy(hashed(F.lit(seed), F.col("source"), F.col("epoch"), F.col("block")), "block")
    before = F.sum("in_block").over(order) - F.col("in_block")
    left = (F.col("repeat") - F.col("epoch")) * F.col("n")  # of the budget, when this pass begins
    plan = passes.withColumn("before", before).where(
        (F.col("before") + F.col("in_block") / 2 <= left) | (F.col("epoch") + 1 <= F.col("repeat"))
    )
    plan = materialise(plan.select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "epoch", "weight", "in_block", "before", "n", "repeat"
    ), "mix-plan")

    within = hashed(F.lit(seed), F.col("epoch"), F.col("doc_id"), F.col("digest")) / F.lit(float(1 << 60))
    place = F.when(F.col("n") > 0, (F.col("epoch") * F.col("n") + F.col("before") + within * F.col("in_block")) / (F.col("repeat") * F.col("n"))).otherwise(within)
    return blocked(rows).join(
        plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    ).select("doc_id", "text", "lang", "source", "tokens", "epoch", "block", place.alias("place"), "weight")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed at the least exponent that repeats no source more than twice."""
    used = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return used.select(
        "doc_id", "source", "tokens", "epoch", "block", F.round("place", 9).alias("place"), F.round("weight", 9).alias("weight")
    )


def _sql() -> str:
    def h(*parts: str) -> str:
        return "CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts) + ")), 1, 15) AS BIGINT)"

    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens, md5(text) AS digest
  FROM documents
), totals AS (
  SELECT source, CAST(sum(tokens) AS BIGINT) AS n, CAST(sum(sum(tokens)) OVER () AS BIGINT) AS total FROM sized GROUP BY source
), exponent AS (  -- largest repetition is (largest / smallest source) ** (1 - a)
  SELECT CASE WHEN max(n) <= {MAX_REPEAT} * min(n) THEN 0
    ELSE ceil((1 - ln({MAX_REPEAT}) / ln(max(n)::DOUBLE / min(n))) * 1e{DIGITS} - 1e-3) / 1e{DIGITS} END AS a
  FROM totals WHERE n > 0
), scales AS (
  SELECT any_value(a) AS a, sum(pow(n::DOUBLE / total, a)) AS z, min(pow(n::DOUBLE / total, a - 1)) AS least FROM totals, exponent WHERE n > 0
), targets AS (
  SELECT source, n, CASE WHEN n > 0 THEN pow(n::DOUBLE / total, a) / z ELSE 0 END AS weight,
    CASE WHEN n > 0 THEN round(pow(n::DOUBLE / total, a - 1) / least, 9) ELSE 1 END AS repeat,
    greatest({LEAST_BLOCKS}, CAST(ceil(n / {BLOCK_TOKENS}) AS BIGINT)) AS n_blocks
  FROM totals, scales
), blocked AS (
  SELECT s.*, {h('0', 's.doc_id', 's.digest')} % n_blocks AS block FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT b.source, b.block, in_block, n, weight, repeat, unnest(range(greatest(CAST(ceil(repeat) AS BIGINT), 1))) AS epoch
  FROM (SELECT source, block, sum(tokens) AS in_block FROM blocked GROUP BY source, block) b
  JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), plan AS (
  SELECT *, sum(in_block) OVER (PARTITION BY source, epoch ORDER BY {h('0', 'source', 'epoch', 'block')}, block) - in_block AS before FROM passes
), used AS (
  SELECT b.doc_id, b.source, b.tokens, epoch, b.block, n, repeat, weight, in_block, before,
    {h('0', 'epoch', 'b.doc_id', 'b.digest')} / pow(2, 60) AS within
  FROM blocked b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source AND b.block = p.block
  WHERE before + in_block / 2 <= (repeat - epoch) * n OR epoch + 1 <= repeat
)
SELECT doc_id, source, tokens, CAST(epoch AS INT) AS epoch, block,
  round(CASE WHEN n > 0 THEN (epoch * n + before + within * in_block) / (repeat * n) ELSE within END, 9) AS place, round(weight, 9) AS weight
FROM used"""


OP9_SQL = _sql()
