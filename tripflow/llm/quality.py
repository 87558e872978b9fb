"""Quality rules: text statistics, and robust multivariate outliers per language and source.

Statistics of each document become a vector of transformed rates. For every group (language and source) the minimum covariance
determinant estimate, the mean and covariance of the most concentrated share of the group, comes from concentration
steps: measure distances, keep the nearest share, estimate again. One step is one aggregate: moments are summed per
(group, distance bin), and the cumulative sums up to the bin that completes the share give the new estimate, so a group
of any size is pre-aggregated to a bounded number of rows. Several starts run side by side and the least determinant
wins. Documents beyond a cut of the Mahalanobis distance are outliers.

Only column expressions are used: no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import documents, materialise, words

SYMBOLS = r"[^#*$%&|<>]+"
#: Least words, and most percent of words in repeated 3-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Components of the vector; the first is a covariate (longer texts repeat more), not a reason to reject.
VECTOR = {
    "x1": lambda: F.log(F.col("n_words")),
    "x2": lambda: F.log(F.col("word_chars") / F.col("n_words")),
    "x3": lambda: F.log1p(1000 * F.col("n_symbols") / F.col("word_chars")),
    "x4": lambda: F.log1p(100 * F.col("n_dup_lines") / F.col("n_words")),
    "x5": lambda: F.asin(F.sqrt(F.col("n_repeat_words") / F.col("n_words"))),
}
#: Least standard deviation of each component: most texts have no symbols at all, and a few are no fault.
FLOOR = {"x1": 0.2, "x2": 0.05, "x3": 0.8, "x4": 0.9, "x5": 0.12}
#: Share of a group that the estimate rests on, and the chi-square quantile (5 degrees) of that share.
SHARE, CHI_SHARE = 0.75, 6.626
#: Chi-square quantiles: 0.975 with 5 degrees for reweighting, 0.99999 with 4 degrees for rejection.
CHI_REWEIGHT, CUT = 12.833, 28.473
STEPS = 4
#: Groups below this pool with the small groups of their language, then with all small ones; below LEAST_POOL all stay.
LEAST_GROUP, LEAST_POOL = 200, 30

_X = list(VECTOR)
_PAIRS = [(a, b) for i, a in enumerate(_X) for b in _X[: i + 1]]


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    Null text has no words. Other columns of the input are not carried; repeated rows are measured each for itself.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = documents(docs).select(
        "doc_id", "lang", "source", words(F.col("text")).alias("_words"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint").alias("n_symbols"), filled.alias("_lines"),
    )
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    df = df.select(
        "doc_id", "lang", "source", "n_symbols", F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.slice(windows, F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))).alias("_windows"),
    )
    # windows with their places, in order of the window, where any occurs twice
    order = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    df = df.withColumn("_order", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), order).otherwise(none))
    same = lambda a, b: a["h"] == b["h"]
    found = F.filter("_order", lambda x, j: F.coalesce(
        same(x, F.get("_order", j + 1)) | ((j > 0) & same(x, F.get("_order", F.greatest(j - 1, F.lit(0))))),
        (j > 0) & same(x, F.get("_order", F.greatest(j - 1, F.lit(0)))),
    ))
    starts = F.sort_array(F.transform(found, lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(3))).alias("n")), lambda acc: acc["n"],
    )
    df = df.withColumn("n_repeat_words", covered.cast("bigint"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_windows", "_order")


def _grouped(rows: DataFrame) -> DataFrame:
    """Add ``grp``: language and source, or a pool for small groups; null where even the pool is small."""

    def pooled(df: DataFrame, key: Column, then: Column, least: int) -> DataFrame:
        # the table of counts has a row per group; Spark broadcasts it if it is small
        counts = materialise(df.groupBy("grp").agg(F.count("*").alias("_n")), "groups")
        return df.join(counts.withColumnRenamed("grp", "_grp"), F.col("grp") == F.col("_grp")).withColumn(
            "grp", F.when(F.col("_n") >= least, F.col("grp")).otherwise(then)).drop("_n", "_grp")

    own = F.to_json(F.struct("lang", "source"))
    df = rows.withColumn("grp", own)
    df = pooled(df, own, F.concat(F.lit("pool"), F.to_json(F.struct("lang"))), LEAST_GROUP)
    df = pooled(df, own, F.lit("pool"), LEAST_GROUP)
    return pooled(df, own, F.lit(None).cast("string"), LEAST_POOL)


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(x).alias(f"s_{x}") for x in _X],
            *[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in _PAIRS]]


def _estimate(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, floored covariance as its Cholesky factor, and log determinant, from sums of moments."""
    mean = {x: F.col(f"s_{x}") / F.col("n") for x in _X}
    cov = [(F.col(f"s_{a}_{b}") / F.col("n") - mean[a] * mean[b]).alias(f"c_{a}_{b}") for a, b in _PAIRS]
    df = sums.select(*keys, *[m.alias(f"m_{x}") for x, m in mean.items()], *cov)
    return _factored(df, keys)


def _factored(df: DataFrame, keys: list[str]) -> DataFrame:
    for i, a in enumerate(_X):
        for j, b in enumerate(_X[: i + 1]):
            left = F.col(f"c_{a}_{b}")
            for k in _X[:j]:
                left = left - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}")
            if a == b:
                # never below the floor: a component without spread would make any other value infinitely far
                entry = F.sqrt(F.greatest(left, F.lit(FLOOR[a] ** 2)))
            else:
                entry = left / F.col(f"l_{b}_{b}")
            df = df.withColumn(f"l_{a}_{b}", entry)
    logdet = reduce(lambda s, x: s + F.log(F.col(f"l_{x}_{x}")), _X, F.lit(0.0))
    return df.select(*keys, *[f"m_{x}" for x in _X], *[f"l_{a}_{b}" for a, b in _PAIRS], logdet.alias("logdet"))


def _distances(df: DataFrame) -> DataFrame:
    """Squared distance ``d2`` and, without the covariate's own part, ``d2_rest``, by forward substitution."""
    for i, a in enumerate(_X):
        left = F.col(a) - F.col(f"m_{a}")
        for b in _X[:i]:
            left = left - F.col(f"l_{a}_{b}") * F.col(f"y_{b}")
        df = df.withColumn(f"y_{a}", left / F.col(f"l_{a}_{a}"))
    square = [F.col(f"y_{x}") * F.col(f"y_{x}") for x in _X]
    rest = reduce(lambda s, c: s + c, square[1:])
    return df.withColumn("d2", square[0] + rest).withColumn("d2_rest", rest).drop(*[f"y_{x}" for x in _X])


def _joined(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Vectors beside the estimates of their group (a row per group and start)."""
    return _distances(vectors.join(estimates.withColumnRenamed("grp", "_grp"), F.col("grp") == F.col("_grp")).drop("_grp"))


def _nearest(measured: DataFrame, keys: list[str], sizes: DataFrame) -> DataFrame:
    """Moments of the nearest share of each group: complete distance bins, 32 to each doubling of the distance."""
    binned = measured.withColumn("bin", F.floor(32 * F.log2(F.col("d2") + F.lit(1e-6))).cast("int"))
    sums = binned.groupBy(*keys, "bin").agg(*_moments())
    upto = Window.partitionBy(*keys).orderBy("bin")
    names = ["n", *[f"s_{x}" for x in _X], *[f"s_{a}_{b}" for a, b in _PAIRS]]
    running = sums.select(*keys, "bin", *[F.sum(c).over(upto).alias(c) for c in names])
    full = running.join(sizes.withColumnRenamed("grp", "_grp"), F.col("grp") == F.col("_grp")).where(F.col("n") >= F.col("_h"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("bin"))
    return full.withColumn("_first", first).where("_first = 1").drop("_first", "_grp", "_h")


def mcd(vectors: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates, one row per ``grp`` of ``vectors`` (grp, x1..x5; a written table).

    Starts: all rows, and the nearest rows around the medians measured with the floors.
    """
    sizes = materialise(vectors.groupBy("grp").agg(F.ceil(F.count("*") * SHARE).alias("_h")), "mcd-sizes")
    # medians to 1/64, from counts per value bin: bounded rows for any group
    longer = vectors.select("grp", F.explode(F.create_map(*[c for x in _X for c in (F.lit(x), F.floor(F.col(x) * 64))])).alias("x", "v"))
    counts = longer.groupBy("grp", "x", "v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("grp", "x").orderBy("v")
    middle = counts.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("grp", "x")))
    medians = middle.where(2 * F.col("upto") >= F.col("all")).groupBy("grp", "x").agg((F.min("v") / 64).alias("v"))
    centre = medians.groupBy("grp").agg(*[F.max(F.when(F.col("x") == x, F.col("v"))).alias(f"m_{x}") for x in _X])
    around = _factored(
        centre.withColumns({f"c_{a}_{b}": F.lit(FLOOR[a] ** 2 if a == b else 0.0) for a, b in _PAIRS}), ["grp"]
    ).withColumn("start", F.lit(1))
    whole = _estimate(vectors.groupBy("grp").agg(*_moments()), ["grp"]).withColumn("start", F.lit(0))
    now = materialise(whole.unionByName(around), "mcd-0")
    for step in range(1, STEPS + 1):
        nearest = _nearest(_joined(vectors, now), ["grp", "start"], sizes)
        now = materialise(_estimate(nearest, ["grp", "start"]), f"mcd-{step}")
    best = F.row_number().over(Window.partitionBy("grp").orderBy("logdet", "start"))
    raw = materialise(now.withColumn("_best", best).where("_best = 1").drop("_best", "start"), "mcd-raw")
    # the share's own radius tells how much its covariance must grow to hold for the whole; never less than it is
    reach = _joined(vectors, raw).groupBy("grp", F.floor(32 * F.log2(F.col("d2") + F.lit(1e-6))).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    upto = reach.withColumn("n", F.sum("n").over(Window.partitionBy("grp").orderBy("bin")))
    radius = upto.join(sizes.withColumnRenamed("grp", "_grp"), F.col("grp") == F.col("_grp")).where("n >= _h").groupBy("_grp").agg(
        F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.min("bin") + 1) / 32) / CHI_SHARE).alias("_grow"))
    grown = raw.join(radius, F.col("grp") == F.col("_grp")).withColumns(
        {f"l_{a}_{b}": F.col(f"l_{a}_{b}") * F.sqrt("_grow") for a, b in _PAIRS}).drop("_grp", "_grow")
    grown = materialise(grown, "mcd-grown")
    kept = _joined(vectors, grown).where(F.col("d2") <= CHI_REWEIGHT)
    return materialise(_estimate(kept.groupBy("grp").agg(*_moments()), ["grp"]), "mcd")


def quality(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """``text_statistics`` of every document with ``distance`` (squared, null where none is measured) and ``kept``.

    A document fails by the base rules, or as an outlier of its group beyond ``cut``. Null languages and sources are
    groups of their own; small groups are pooled. An empty table gives no rows.
    """
    stats = materialise(text_statistics(docs), "quality")
    able = stats.where(~F.col("base_failed")).withColumns({x: f() for x, f in VECTOR.items()})
    vectors = materialise(_grouped(able), "quality-vectors")
    slim = vectors.where("grp is not null").select("grp", *_X)
    measured = vectors.join(mcd(slim).withColumnRenamed("grp", "_grp"), F.col("grp") == F.col("_grp"), "left").drop("_grp")
    columns = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    passed = _distances(measured).select(
        *columns, F.col("d2_rest").alias("distance"), F.coalesce(F.col("d2_rest") <= cut, F.lit(True)).alias("kept"))
    failed = stats.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return passed.unionByName(failed)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Quality verdict on all documents."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("lang", "source")
