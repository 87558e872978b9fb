"""Monitoring: batch frames, missing share, drift and quality reports.

The statistics are our documented choice (the reference delegates them to a
report library); the output contract is the reference's:

* categorical columns: Jensen-Shannon distance (natural log) of the two value
  distributions, drift when >= 0.1;
* numeric columns: 1-D Wasserstein distance divided by max(reference population
  std, 0.001), drift when >= 0.1.

Plan: each side is stacked to long form (column, value) by a narrow Generate,
both sides are unioned and counted in ONE grouped aggregate (map-side partial,
so hot values are pre-combined), and every score is a second aggregate over
that value-count table: small for categories, for continuous columns as long as
they have distinct values. The Wasserstein integral needs values in order;
that runs as a blocked ordered scan (``operators/ordered.py``), never as a
single-partition window. The whole batch is used; sampling (O5) is optional.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import lax_double, with_sentinel
from tripflow.functions.timefeat import as_timestamp, ntz_micros, to_second, weekday_monday0
from tripflow.operators.evaluate import residual
from tripflow.operators.ordered import Running, ordered_scan
from tripflow.schema import (
    CATEGORICAL_MONITORING_COLUMNS,
    DRIFT_MONITORING_COLUMNS,
    DRIFT_WARNING_SHARE,
    INPUT_MONITORING_COLUMNS,
    MONITOR_MISSING,
    PICKUP,
)
from tripflow.session import ensure_checkpoint_dir

# fixed choices of our drift statistics
DRIFT_THRESHOLD = 0.1
MIN_NORM_STD = 0.001
NUMERIC_INPUT_COLUMNS = ["passenger_count"]
QUALITY_TOLERANCE = 0.10


# ---------------------------------------------------------------- frames
def monitoring_frame(inputs: DataFrame, keep=()) -> DataFrame:
    """P14 + P11: the 8 monitored input columns (+ ``keep``); categoricals as strings with the sentinel."""
    types = {f.name: f.dataType for f in inputs.schema.fields}
    ts = to_second(as_timestamp(F.col(PICKUP), types[PICKUP]))
    values = {
        "VendorID": F.col("VendorID").cast("bigint"),
        "PULocationID": F.col("PULocationID").cast("bigint"),
        "DOLocationID": F.col("DOLocationID").cast("bigint"),
        "trip_type": lax_double(F.col("trip_type")),
        "pickup_hour": F.hour(ts),
        "pickup_day_of_week": weekday_monday0(ts),
        "passenger_count": lax_double(F.col("passenger_count")),
        PICKUP: ts,
    }
    out = []
    for c in INPUT_MONITORING_COLUMNS:
        v = values[c]
        out.append((with_sentinel(v, MONITOR_MISSING) if c in CATEGORICAL_MONITORING_COLUMNS else v).alias(c))
    return inputs.select(*out, *[F.col(k) for k in keep])


#: Partitions whose least rows one task of the merge tree puts together.
SAMPLE_FAN_IN = 32


def sample_hash(seed: int, cols) -> Column:
    """60 bits of md5 over the seed and the key as text, the same in any engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def exact_sample(df: DataFrame, n: int, seed: int, key_cols=None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, those with the least seeded hash of the key (ties by key); stable under
    repartitioning.

    A bottom-k sketch in one scan: every task keeps its n least rows, and a tree of merges of SAMPLE_FAN_IN each
    keeps the n least of those, from the session's shuffle partitions down: no task orders more than it is sent. Rows of equal hash and key
    are interchangeable.
    """
    cols = key_cols or df.columns
    by = ["__h", *cols]

    def least(part: DataFrame) -> DataFrame:
        # sorted inside each partition, without an exchange; only the first n leave
        def first(batches):
            left = n
            for batch in batches:
                if left <= 0:
                    return
                yield batch.slice(0, left)
                left -= batch.num_rows

        return part.sortWithinPartitions(*by).mapInArrow(first, part.schema)

    kept = least(df.withColumn("__h", sample_hash(seed, cols)))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while parts > SAMPLE_FAN_IN:
        parts = -(-parts // SAMPLE_FAN_IN)
        kept = least(kept.repartition(parts, F.pmod(F.col("__h"), F.lit(parts))))
    return kept.orderBy(*by).limit(n).drop("__h")


def missing_share(frame: DataFrame, cols=INPUT_MONITORING_COLUMNS) -> DataFrame:
    """Share of null cells over rows x columns, one aggregate."""
    nulls = sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))
    return frame.agg(F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("missing_cells")).select(
        "rows", F.coalesce(F.col("missing_cells"), F.lit(0)).alias("missing_cells"),
        F.when(F.col("rows") > 0, F.col("missing_cells") / (F.col("rows") * F.lit(len(cols))))
        .otherwise(F.lit(0.0)).alias("missing_share"),
    )


@dataclass
class MonitoringBatch:
    input_frame: DataFrame
    quality_frame: DataFrame | None


def load_monitoring_batch(raw: DataFrame, scorer, max_rows: int | None = None, seed: int = 42,
                          keep=()) -> MonitoringBatch:
    """Labelled (has dropoff time) or unlabelled batch, chosen from the columns at plan time.

    Labelled: the training preparation (so rows are filtered exactly as in training), then a
    quality frame with ``duration`` and ``prediction``. Unlabelled: the six serving inputs only.
    ``max_rows`` optionally applies the seeded exact sample (O5) *before* scoring; by default the
    whole batch is monitored.
    """
    from tripflow.operators.prepare import prepare_training_data, select_model_inputs
    from tripflow.schema import DROPOFF

    if DROPOFF in raw.columns:
        if "trip_distance" not in raw.columns:
            raise ValueError("a batch with dropoff times needs trip_distance too, to be filtered as in training")
        inputs = prepare_training_data(raw, keep=tuple(keep))
        labelled = True
    else:
        inputs = select_model_inputs(raw, keep=tuple(keep))
        labelled = False
    if max_rows is not None:
        inputs = exact_sample(inputs, max_rows, seed)
    scored = scorer.transform(inputs)
    extra = (*keep, "duration", "prediction") if labelled else tuple(keep)
    frame = monitoring_frame(scored, keep=extra)
    if not labelled:
        return MonitoringBatch(frame, None)
    return MonitoringBatch(frame.drop("duration", "prediction"), frame)


def column_summary(frame: DataFrame, categorical=CATEGORICAL_MONITORING_COLUMNS,
                   numeric=tuple(NUMERIC_INPUT_COLUMNS), times=(PICKUP,), target: str = "duration",
                   prediction: str = "prediction") -> DataFrame:
    """D3: per monitored column: role, rows, missing, distinct, top value (+ min/max/mean/std when numeric).

    Roles are categorical, numerical, datetime and, for a labelled frame, target and prediction. A time is summed up
    by seconds since 1970 of its wall clock.

    One stacked value count over the frame (the frame is read once, hot values pre-combined),
    checkpointed; every figure is an aggregate over that table. Top value: highest count,
    lowest value on ties. Numeric std is the sample std over non-missing values.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    roles = {**{c: "numerical" for c in numeric}, **{c: "datetime" for c in times},
             **{c: role for c, role in ((target, "target"), (prediction, "prediction")) if c in frame.columns}}
    frame = frame.withColumns({c: ntz_micros(F.col(c)) / F.lit(1e6) for c in times})
    numeric = tuple(roles)
    counts = stacked_counts(frame.limit(0), frame, categorical=categorical, numeric=numeric) \
        .select("column", "value", "num", F.col("n_cur").alias("n")).checkpoint(eager=True)
    cat = counts.where(F.col("column").isin(list(categorical))).groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count("value").alias("distinct"),
        F.min_by(F.col("value"), F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
    ).select("column", F.lit("categorical").alias("role"), "rows", "missing", "distinct", "top_value",
             *[F.lit(None).cast("double").alias(x) for x in ("min", "max", "mean", "std")])
    nums = counts.where(F.col("column").isin(list(numeric)))
    present = F.col("num").isNotNull()
    first = nums.groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(F.when(~present, F.col("n")).otherwise(0)).alias("missing"),
        F.count("num").alias("distinct"), F.min("num").alias("min"), F.max("num").alias("max"),
        F.try_divide(F.sum(F.col("num") * F.col("n")), F.sum(F.when(present, F.col("n")))).alias("mean"))
    # one row per numeric column: a proven-small broadcast
    spread = nums.join(F.broadcast(first.select("column", "mean")), "column").groupBy("column").agg(
        F.sum(F.when(present, F.col("n") * (F.col("num") - F.col("mean")) ** 2)).alias("ss"),
        F.sum(F.when(present, F.col("n"))).alias("k"))
    num = first.join(F.broadcast(spread), "column").select(
        "column", F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])[F.col("column")].alias("role"),
        "rows", "missing", "distinct", F.lit(None).cast("string").alias("top_value"), "min", "max", "mean",
        F.when(F.col("k") > 1, F.sqrt(F.col("ss") / (F.col("k") - 1))).alias("std"))
    return cat.unionByName(num)


# ---------------------------------------------------------------- value counts
NULL_TALLY = "__null_cells__"  # pseudo column: per-row count of missing cells, counted like a value


def stacked_counts(reference: DataFrame, current: DataFrame, categorical=(), numeric=(), tally=()) -> DataFrame:
    """ONE grouped count over both sides: (column, value, num, n_ref, n_cur).

    Categorical columns count their string ``value``; numeric columns their double ``num``
    (NaN -> null = missing); with ``tally``, the pseudo column ``__null_cells__`` counts rows by
    how many of those columns are null, so the missing share comes from the same pass. The
    two sides are aligned by the grouping itself (a full outer join in effect), and map-side
    partial aggregation absorbs hot values.
    """
    def side(frame: DataFrame, s: int) -> DataFrame:
        none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
        items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), none_d.alias("num"))
                 for c in categorical]
        items += [F.struct(F.lit(c).alias("column"), none_s.alias("value"),
                           F.nanvl(F.col(c).cast("double"), none_d).alias("num")) for c in numeric]
        if tally:
            nulls = sum((F.col(c).isNull().cast("int") for c in tally), F.lit(0))
            items.append(F.struct(F.lit(NULL_TALLY).alias("column"), none_s.alias("value"),
                                  nulls.cast("double").alias("num")))
        return frame.select(F.inline(F.array(*items))).withColumn("side", F.lit(s))

    long = side(reference, 0).unionByName(side(current, 1))
    return long.groupBy("column", "value", "num").agg(
        F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))


def _with_totals(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    # one row per monitored column: a proven-small broadcast
    return counts.join(F.broadcast(totals), "column")


def _detected(score: Column) -> Column:
    return F.coalesce(score >= F.lit(DRIFT_THRESHOLD), F.lit(False)).cast("double")


def _scored(df: DataFrame) -> DataFrame:
    return df.select("column", "drift_score", _detected(F.col("drift_score")).alias("drift_detected"))


def js_from_counts(counts: DataFrame) -> DataFrame:
    """D4 over categorical count rows: Jensen-Shannon distance per column."""
    c = _with_totals(counts)
    p = F.try_divide(F.col("n_ref"), F.col("t_ref"))  # an empty side gives null, not a division error
    q = F.try_divide(F.col("n_cur"), F.col("t_cur"))
    m = (p + q) / 2.0
    term = F.when(p > 0, p * F.ln(p / m)).otherwise(0.0) + F.when(q > 0, q * F.ln(q / m)).otherwise(0.0)
    return _scored(c.groupBy("column").agg(F.sqrt(F.greatest(F.sum(term) / 2.0, F.lit(0.0))).alias("drift_score")))


def wasserstein_from_counts(counts: DataFrame) -> DataFrame:
    """D5 over numeric count rows: W1 / max(std_ref, 0.001) per column; missing values are ignored.

    W1 = sum over distinct values x_i of |F_ref(x_i) - F_cur(x_i)| * (x_{i+1} - x_i), the running
    shares coming from a blocked ordered scan.
    """
    c = _with_totals(counts.where(F.col("num").isNotNull()).select(
        "column", F.col("num").alias("value"), "n_ref", "n_cur"))
    mean = c.groupBy("column").agg(F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.first("t_ref")).alias("mu"))
    std = (
        c.join(F.broadcast(mean), "column")
        .groupBy("column")
        .agg(F.sqrt(F.try_divide(F.sum(F.col("n_ref") * (F.col("value") - F.col("mu")) ** 2), F.first("t_ref")))
             .alias("std_ref"))
    )
    scanned = ordered_scan(
        c, ["column"], "value",
        [Running("cum_ref", F.col("n_ref")), Running("cum_cur", F.col("n_cur"))],
        next_col="next_value",
    )
    gap = F.abs(F.try_divide(F.col("cum_ref"), F.col("t_ref")) - F.try_divide(F.col("cum_cur"), F.col("t_cur"))) * (
        F.col("next_value") - F.col("value"))
    w1 = scanned.groupBy("column").agg(F.sum(F.coalesce(gap, F.lit(0.0))).alias("wasserstein"))
    out = w1.join(F.broadcast(std), "column").select(
        "column", (F.col("wasserstein") / F.greatest(F.coalesce(F.col("std_ref"), F.lit(0.0)), F.lit(MIN_NORM_STD)))
        .alias("drift_score"))
    return _scored(out)


def categorical_drift(reference: DataFrame, current: DataFrame, cols=CATEGORICAL_MONITORING_COLUMNS) -> DataFrame:
    """(column, drift_score, drift_detected) by Jensen-Shannon distance (each frame read once)."""
    ensure_checkpoint_dir(reference.sparkSession)
    return js_from_counts(stacked_counts(reference, current, categorical=cols).checkpoint(eager=True))


def numeric_drift(reference: DataFrame, current: DataFrame, cols) -> DataFrame:
    """(column, drift_score, drift_detected) by normalised Wasserstein distance."""
    ensure_checkpoint_dir(reference.sparkSession)
    counts = stacked_counts(reference, current, numeric=cols).checkpoint(eager=True)
    return wasserstein_from_counts(counts)


# ---------------------------------------------------------------- reports
def input_report(reference: DataFrame, current: DataFrame, drift_warning_share: float = DRIFT_WARNING_SHARE) -> DataFrame:
    """D1 (+A9, A10, A11): one row of input metrics, names as in the reference's metric dictionary.

    Each frame is read ONCE: one stacked count (categorical values, numeric values and the
    per-row null tally) is checkpointed, and every metric is an aggregate over that small table.
    """
    ensure_checkpoint_dir(reference.sparkSession)
    counts = stacked_counts(reference, current, categorical=CATEGORICAL_MONITORING_COLUMNS,
                            numeric=NUMERIC_INPUT_COLUMNS, tally=INPUT_MONITORING_COLUMNS).checkpoint(eager=True)
    cat = js_from_counts(counts.where(F.col("column").isin(CATEGORICAL_MONITORING_COLUMNS)))
    num = wasserstein_from_counts(counts.where(F.col("column").isin(NUMERIC_INPUT_COLUMNS)))
    per_col = cat.unionByName(num)
    n_cols = len(DRIFT_MONITORING_COLUMNS)
    flags = per_col.groupBy().pivot("column", DRIFT_MONITORING_COLUMNS).agg(F.first("drift_detected"))
    summary = per_col.agg(F.sum("drift_detected").alias("input_drifted_columns_count"))
    cells = F.lit(float(len(INPUT_MONITORING_COLUMNS)))
    miss = counts.where(F.col("column") == NULL_TALLY).agg(
        F.sum(F.col("num") * F.col("n_cur")).alias("missing"), F.sum("n_cur").alias("rows")).select(
        F.when(F.col("rows") > 0, F.col("missing") / (F.col("rows") * cells)).otherwise(F.lit(0.0))
        .alias("input_missing_value_share"))
    # three one-row frames: combine by a constant key (a 1x1 equi-join, broadcast)
    k = F.lit(1).alias("__k")
    out = (
        summary.select(k, "*")
        .join(F.broadcast(flags.select(k, "*")), "__k")
        .join(F.broadcast(miss.select(k, "*")), "__k")
    )
    share = F.col("input_drifted_columns_count") / F.lit(float(n_cols))
    return out.select(
        F.col("input_drifted_columns_count").cast("double").alias("input_drifted_columns_count"),
        share.alias("input_drifted_columns_share"),
        F.col("input_missing_value_share").cast("double").alias("input_missing_value_share"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(f"input_{c}_drift_detected") for c in DRIFT_MONITORING_COLUMNS],
        (share >= F.lit(drift_warning_share)).cast("double").alias("input_drift_warning"),
    )


def quality_report(reference: DataFrame, current: DataFrame) -> DataFrame:
    """D2 (+A12-A14): one row of quality metrics for a labelled current batch.

    Checks (ours, named; a check fails when its status is not SUCCESS): current
    rmse and mae within 10 % of the reference batch's, no drift of ``duration``
    and of ``prediction``.

    rmse and mae are partial aggregates of the scored frames; only the two drift columns are counted by value.
    """
    ensure_checkpoint_dir(reference.sparkSession)
    drift = numeric_drift(reference, current, ["duration", "prediction"])
    scores = drift.groupBy().pivot("column", ["duration", "prediction"]).agg(
        F.first("drift_score").alias("s"), F.first("drift_detected").alias("d"))
    sides = reference.select(F.lit(0).alias("side"), residual().alias("e")).unionByName(
        current.select(F.lit(1).alias("side"), residual().alias("e")))
    e = F.nanvl(F.col("e"), F.lit(None).cast("double"))
    on = lambda side: F.when(F.col("side") == side, e)
    errors = sides.agg(
        F.sqrt(F.avg(on(1) * on(1))).alias("rmse"), F.avg(F.abs(on(1))).alias("mae"),
        F.sqrt(F.avg(on(0) * on(0))).alias("ref_rmse"), F.avg(F.abs(on(0))).alias("ref_mae"),
    )
    k = F.lit(1).alias("__k")
    row = errors.select(k, "*").join(F.broadcast(scores.select(k, "*")), "__k")

    def within(a: str, b: str) -> Column:
        return F.abs(F.col(a) - F.col(b)) <= F.lit(QUALITY_TOLERANCE) * F.abs(F.col(b))

    checks = F.array(
        F.struct(F.lit("rmse_within_tolerance").alias("check"), within("rmse", "ref_rmse").alias("ok")),
        F.struct(F.lit("mae_within_tolerance").alias("check"), within("mae", "ref_mae").alias("ok")),
        F.struct(F.lit("duration_no_drift").alias("check"), (F.col("duration_d") == 0).alias("ok")),
        F.struct(F.lit("prediction_no_drift").alias("check"), (F.col("prediction_d") == 0).alias("ok")),
    )
    failed = F.size(F.filter(checks, lambda s: ~F.coalesce(s["ok"], F.lit(False))))
    return row.select(
        F.col("rmse").alias("quality_rmse"),
        F.col("mae").alias("quality_mae"),
        (F.col("rmse") * F.col("rmse")).alias("quality_mse_from_rmse"),
        failed.cast("double").alias("quality_failed_tests"),
        F.col("duration_s").alias("quality_duration_drift_score"),
        F.col("prediction_s").alias("quality_prediction_drift_score"),
    )
