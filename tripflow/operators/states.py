"""Mergeable monitoring states (D2, D5, D6 over time) and drift of continuous columns (KS, Wasserstein).

The state of a batch is a small table, a row for each column and category: counts, moments, extremes and a quantile
sketch (KLL, Spark's own aggregate). Its size depends on the columns, their categories and SKETCH_K, never on the rows
of the batch. States of any batches add up to the state of their union, so a report over the last batches reads their
states and no trip again.

What comes out is exact for counts, missing cells, means, deviations, extremes, errors and categorical drift. Of
numeric columns, the KS statistic and the Wasserstein distance come from the sketches: a rank is off by at most
``rank_error()`` with 99 % confidence, and by nothing while a column has fewer values than SKETCH_K.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.operators.evaluate import residual
from tripflow.operators.monitor import DRIFT_THRESHOLD, MIN_NORM_STD, NULL_TALLY, js_from_counts, stacked_counts
from tripflow.operators.ordered import Running, ordered_scan
from tripflow.schema import CATEGORICAL_MONITORING_COLUMNS, INPUT_MONITORING_COLUMNS
from tripflow.session import ensure_checkpoint_dir

#: Size of a sketch, and the number of quantiles a comparison looks at.
SKETCH_K, GRID = 4096, 2000
#: A KS test finds drift below this probability of equal distributions.
KS_SIGNIFICANCE = 0.05
ERROR, ABS_ERROR = "__error__", "__abs_error__"
CATEGORY, NUMBER, TALLY = "category", "number", "tally"


def rank_error(k: int = SKETCH_K) -> float:
    """Largest error of a rank (as a share of all values) with 99 % confidence: KLL's published fit."""
    return 2.296 / k ** 0.9021


# ---------------------------------------------------------------- exact KS
def ks_probability(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Probability of a statistic at least so large if both sides are alike (asymptotic, 100 terms)."""
    ne = n_ref * n_cur / (n_ref + n_cur)
    root = F.sqrt(ne)
    x = (root + F.lit(0.12) + F.lit(0.11) / root) * statistic
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * x * x))
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    # the series does not converge towards 0, where the probability is 1
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def _ks_out(df: DataFrame) -> DataFrame:
    p = ks_probability(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    p = F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), p)
    return df.withColumn("p_value", p).withColumn(
        "drift_detected", F.coalesce(F.col("p_value") < F.lit(KS_SIGNIFICANCE), F.lit(False)).cast("double"))


def ks_drift(reference: DataFrame, current: DataFrame, cols) -> DataFrame:
    """D5, exact two-sample Kolmogorov-Smirnov test: (column, n_ref, n_cur, ks_statistic, p_value, drift_detected).

    Missing values are left out; a column without values on a side has no statistic and no drift. The running shares
    come from the blocked ordered scan over the distinct values of both sides.
    """
    ensure_checkpoint_dir(reference.sparkSession)
    counts = stacked_counts(reference, current, numeric=cols).where(F.col("num").isNotNull()).select(
        "column", F.col("num").alias("value"), "n_ref", "n_cur").checkpoint(eager=True)
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    scanned = ordered_scan(counts, ["column"], "value", [Running("cum_ref", F.col("n_ref")), Running("cum_cur", F.col("n_cur"))])
    # one row per monitored column
    gap = F.abs(F.try_divide(F.col("cum_ref"), F.col("t_ref")) - F.try_divide(F.col("cum_cur"), F.col("t_cur")))
    found = scanned.join(F.broadcast(totals), "column").groupBy("column").agg(
        F.first("t_ref").alias("n_ref"), F.first("t_cur").alias("n_cur"), F.max(gap).alias("ks_statistic"))
    return _ks_out(found)


# ---------------------------------------------------------------- states
def batch_state(frame: DataFrame, categorical=tuple(CATEGORICAL_MONITORING_COLUMNS), numeric=("passenger_count",),
                inputs=tuple(INPUT_MONITORING_COLUMNS), by: tuple = (), k: int = SKETCH_K) -> DataFrame:
    """The state of a monitoring frame, or of each of its batches where ``by`` names the column that tells them apart.

    ``column, kind, value, n, missing, mean, m2, lo, hi, sketch``: a category's count under its ``value``; a number's
    count, missing cells, mean, sum of squared deviations, extremes and sketch; how many rows miss how many input
    cells. A labelled frame (duration, prediction) has both as numbers too, and its residuals. One aggregate.
    """
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    labelled = {"duration", "prediction"} <= set(frame.columns)
    numbers = {c: F.col(c).cast("double") for c in (*numeric, *(("duration", "prediction") if labelled else ()))}
    if labelled:
        numbers |= {ERROR: residual(), ABS_ERROR: F.abs(residual())}

    def item(column, kind, value=none_s, num=none_d):
        return F.struct(F.lit(column).alias("column"), F.lit(kind).alias("kind"), value.alias("value"), num.alias("num"))

    items = [item(c, CATEGORY, F.col(c).cast("string")) for c in categorical]
    items += [item(c, NUMBER, num=F.nanvl(x, none_d)) for c, x in numbers.items()]
    items.append(item(NULL_TALLY, TALLY, sum((F.col(c).isNull().cast("int") for c in inputs), F.lit(0)).cast("string")))
    long = frame.select(*by, F.inline(F.array(*items)))
    is_number = F.col("kind") == NUMBER
    return long.groupBy(*by, "column", "kind", "value").agg(
        F.when(F.first("kind") == NUMBER, F.count("num")).otherwise(F.count(F.lit(1))).alias("n"),
        F.count_if(is_number & F.col("num").isNull()).alias("missing"), F.avg("num").alias("mean"),
        (F.var_pop("num") * F.count("num")).alias("m2"), F.min("num").alias("lo"), F.max("num").alias("hi"),
        F.kll_sketch_agg_double("num", k).alias("sketch"))


def merge_states(states: DataFrame, by: tuple = (), k: int = SKETCH_K) -> DataFrame:
    """The state of the union of the batches in ``states`` (one for each value of ``by``)."""
    n, mean = F.col("n"), F.coalesce("mean", F.lit(0.0))
    total = F.sum("n")
    first, second = F.sum(n * mean), F.sum(F.coalesce("m2", F.lit(0.0)) + n * mean * mean)
    merged = states.groupBy(*by, "column", "kind", "value").agg(
        total.alias("n"), F.sum("missing").alias("missing"), first.alias("s1"), second.alias("s2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"))
    has = (F.col("kind") == NUMBER) & (F.col("n") > 0)
    average = F.when(has, F.try_divide(F.col("s1"), F.col("n")))
    return merged.select(*by, "column", "kind", "value", "n", "missing", average.alias("mean"),
                         F.greatest(F.col("s2") - F.col("s1") * average, F.lit(0.0)).alias("m2"), "lo", "hi", "sketch")


def write_state(state: DataFrame, path: str, batch: str) -> None:
    """The state of one batch in its own folder: writing a batch again replaces it, so a retried run counts once."""
    state.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def write_states(states: DataFrame, path: str, by: str = "batch") -> None:
    """States of many batches (``by`` names them), a folder each; batches that are there already are replaced."""
    states.withColumnRenamed(by, "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("batch").parquet(path)


def read_states(spark: SparkSession, path: str, batches=None) -> DataFrame:
    """States of the named batches (all without a name); a batch that was never written fails."""
    from tripflow.sources.monthly import path_exists

    if batches is not None:
        lost = sorted(b for b in batches if not path_exists(spark, f"{path}/batch={b}"))
        if lost:
            raise FileNotFoundError(f"no state of batches {lost}")
    states = spark.read.option("basePath", path).parquet(path).withColumn("batch", F.col("batch").cast("string"))
    return states if batches is None else states.where(F.col("batch").isin(list(batches)))


def _pairs(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Numeric columns of two states side by side (a row for each monitored column)."""
    side = lambda df, s: df.where(F.col("kind") == NUMBER).select("column", *[F.col(c).alias(f"{c}_{s}") for c in ("n", "mean", "m2", "sketch")])
    both = side(reference, "ref").join(side(current, "cur"), "column")
    return both.where(~F.col("column").isin([ERROR, ABS_ERROR]) & (F.col("n_ref") > 0) & (F.col("n_cur") > 0))


def _grid(sketch: str, grid: int) -> Column:
    """The quantiles at the middle of ``grid`` equal shares (the sketch functions take literal shares)."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*[F.lit((j + 0.5) / grid) for j in range(grid)]))


def ks_from_states(reference: DataFrame, current: DataFrame, grid: int = GRID) -> DataFrame:
    """As ``ks_drift``, from two states: the largest gap between both sides' shares of grid quantiles up to each of
    them. It is off by at most ``2 * rank_error() + 1 / grid`` with the confidence of the sketches."""
    pairs = _pairs(reference, current)
    point = lambda s: F.transform(_grid(f"sketch_{s}", grid), lambda x: F.struct(F.lit(s).alias("side"), x.alias("at")))
    points = pairs.select("column", "n_ref", "n_cur", F.inline(F.concat(point("ref"), point("cur"))))
    upto = Window.partitionBy("column").orderBy("at")  # 2 * grid rows a column; equal values count together
    share = lambda s: F.count_if(F.col("side") == s).over(upto) / F.lit(float(grid))
    gaps = points.select("column", "n_ref", "n_cur", F.abs(share("ref") - share("cur")).alias("gap"))
    return _ks_out(gaps.groupBy("column").agg(F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"), F.max("gap").alias("ks_statistic")))


def wasserstein_from_states(reference: DataFrame, current: DataFrame, grid: int = GRID) -> DataFrame:
    """D5 from two states: (column, drift_score, drift_detected). The distance is the mean gap between equal quantiles
    of both sides, divided by max(reference std, 0.001); the std is exact."""
    gaps = F.zip_with(_grid("sketch_ref", grid), _grid("sketch_cur", grid), lambda a, b: F.abs(a - b))
    distance = F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b) / F.lit(float(grid))
    std = F.sqrt(F.try_divide(F.col("m2_ref"), F.col("n_ref")))
    scored = _pairs(reference, current).select("column", (distance / F.greatest(std, F.lit(MIN_NORM_STD))).alias("drift_score"))
    return scored.withColumn("drift_detected", (F.col("drift_score") >= F.lit(DRIFT_THRESHOLD)).cast("double"))


def js_from_states(reference: DataFrame, current: DataFrame) -> DataFrame:
    """D4 from two states: exact, as ``categorical_drift`` over the frames."""
    side = lambda df, s: df.where(F.col("kind") == CATEGORY).select("column", "value", F.col("n"), F.lit(s).alias("side"))
    counts = side(reference, 0).unionByName(side(current, 1)).groupBy("column", "value").agg(
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("n_ref"),
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("n_cur"))
    return js_from_counts(counts)


def window_report(reference: DataFrame, current: DataFrame) -> DataFrame:
    """D2 and D6 from the merged states of a reference and of a window of batches: (metric, value), one row each.

    Per column its drift score; per number its mean and standard deviation; rows, missing share of the input cells,
    and rmse and mae where the batches are labelled.
    """
    numbers = current.where(F.col("kind") == NUMBER)
    std = F.sqrt(F.try_divide(F.col("m2"), F.col("n")))
    figures = numbers.where(~F.col("column").isin([ERROR, ABS_ERROR])).select(F.inline(F.array(
        F.struct(F.concat("column", F.lit("_mean")).alias("metric"), F.col("mean").alias("value")),
        F.struct(F.concat("column", F.lit("_std")).alias("metric"), std.alias("value")))))
    errors = numbers.where(F.col("column").isin([ERROR, ABS_ERROR])).select(
        F.when(F.col("column") == ERROR, F.lit("rmse")).otherwise(F.lit("mae")).alias("metric"),
        F.when(F.col("column") == ERROR, F.sqrt(F.try_divide(F.col("m2"), F.col("n")) + F.col("mean") * F.col("mean"))).otherwise(F.col("mean")).alias("value"))
    cells = F.lit(float(len(INPUT_MONITORING_COLUMNS)))
    tally = current.where(F.col("kind") == TALLY).agg(F.sum("n").alias("rows"), F.sum(F.col("value").cast("double") * F.col("n")).alias("cells"))
    missing = tally.select(F.inline(F.array(
        F.struct(F.lit("rows").alias("metric"), F.coalesce(F.col("rows"), F.lit(0)).cast("double").alias("value")),
        F.struct(F.lit("missing_share").alias("metric"), F.coalesce(F.try_divide(F.col("cells"), F.col("rows") * cells), F.lit(0.0)).alias("value")))))
    drift = js_from_states(reference, current).unionByName(wasserstein_from_states(reference, current)).select(
        F.concat("column", F.lit("_drift_score")).alias("metric"), F.col("drift_score").alias("value"))
    return figures.unionByName(errors).unionByName(missing).unionByName(drift)
