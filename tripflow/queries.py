"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

Doubles are rounded to 6 places at the edge so results compare across engines
(summation order and libm last bits differ); timestamps leave as strings.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.columns import round6
from tripflow.functions.timefeat import (
    cyclical,
    format_micros,
    format_second,
    hour,
    is_rush_hour,
    is_weekend,
    weekday_monday0,
)
from tripflow.operators.evaluate import segment_metrics
from tripflow.operators.joins import Dimension, checked_zones, enrich_zones
from tripflow.operators.prepare import prepare_training_data
from tripflow.operators.split import ChronologicalSplit
from tripflow.plans.scorers import DistanceFormulaScorer
from tripflow.schema import PICKUP
from tripflow.sources import adapter
from tripflow.sources.adapter import TRIP_KEY


class Inputs:
    """Lazily built inputs of one (session, sf_dir) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return adapter.raw_trips(self.spark, self.sf_dir)

    @cached_property
    def zones(self) -> Dimension:
        return checked_zones(adapter.zones(self.spark, self.sf_dir))

    @cached_property
    def splitter(self) -> ChronologicalSplit:
        return ChronologicalSplit(key_col=TRIP_KEY).fit(self.raw)

    def split_raw(self, name: str) -> DataFrame:
        return self.splitter.take(self.raw, name)

    def prepared(self, name: str | None = None, keep=(TRIP_KEY,)) -> DataFrame:
        raw = self.raw if name is None else self.split_raw(name)
        return prepare_training_data(raw, keep=keep)

    @cached_property
    def prepared_split(self) -> DataFrame:
        """Every clean trip with its split label (the split is decided on raw rows, before cleaning)."""
        return prepare_training_data(self.splitter.assign(self.raw), keep=(TRIP_KEY, "split"))

    @cached_property
    def scorer(self) -> DistanceFormulaScorer:
        return DistanceFormulaScorer(self.zones)

    def scored(self, name: str | None = None) -> DataFrame:
        """Formula-scored prepared trips of one split (or of all, with ``split``)."""
        if name is None:
            return self.scorer.transform(self.prepared_split)
        return self.scorer.transform(self.prepared(name))

    def monitoring(self, name: str) -> DataFrame:
        """Monitoring frame of one split: 8 monitored inputs + duration and prediction."""
        from tripflow.operators.monitor import monitoring_frame

        return monitoring_frame(self.scored(name), keep=(TRIP_KEY, "duration", "prediction"))

    @cached_property
    def features(self):
        from tripflow.plans.features import TripFeatures

        return TripFeatures(zones=self.zones, keepCols=[TRIP_KEY, "duration"]).fit(self.prepared("train"))


# --------------------------------------------------------------------------- slice 1
def q_prepared_trips(spark, sf_dir):
    df = Inputs(spark, sf_dir).prepared()
    return df.select(
        TRIP_KEY, "VendorID", format_second(F.col(PICKUP)).alias(PICKUP), "PULocationID", "DOLocationID",
        "passenger_count", "trip_type", round6(F.col("duration")).alias("duration"),
    )


def q_chronological_split(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return inp.splitter.assign(inp.raw).select(TRIP_KEY, "split")


def q_split_report(spark, sf_dir):
    """W1 + A7 + A8: rows, share of all rows, time coverage and clean-row count per split."""
    from tripflow.operators.prepare import clean_trip_filter, duration_minutes
    from tripflow.schema import DROPOFF

    inp = Inputs(spark, sf_dir)
    raw = inp.splitter.assign(inp.raw).withColumn("duration", duration_minutes(F.col(PICKUP), F.col(DROPOFF)))
    clean = clean_trip_filter(raw)
    agg = raw.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(clean).alias("clean_rows"),
        format_micros(F.min(PICKUP)).alias("start"),
        format_micros(F.max(PICKUP)).alias("end"),
    )
    share = F.try_divide(F.col("rows") * 100.0, F.lit(inp.splitter.n_rows))
    return agg.select("split", "rows", "clean_rows", round6(share).alias("share_pct"),
                      "start", "end")


def q_zone_enriched(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    df = enrich_zones(inp.raw.select(TRIP_KEY, "PULocationID", "DOLocationID"), inp.zones)
    return df.select(
        TRIP_KEY, "PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone",
        round6(F.col("estimated_distance_miles")).alias("estimated_distance_miles"), "same_borough",
    )


def q_time_features(spark, sf_dir):
    df = Inputs(spark, sf_dir).prepared()
    ts = F.col(PICKUP)
    h, d = hour(ts), weekday_monday0(ts)
    hs, hc = cyclical(h, 24.0)
    ds, dc = cyclical(d, 7.0)
    return df.select(
        TRIP_KEY, h.alias("pickup_hour"), d.alias("day_of_week"), F.month(ts).alias("pickup_month"),
        F.dayofmonth(ts).alias("day_of_month"), round6(hs).alias("hour_sin"), round6(hc).alias("hour_cos"),
        round6(ds).alias("day_sin"), round6(dc).alias("day_cos"), is_weekend(d).alias("is_weekend"),
        is_rush_hour(h).alias("is_rush_hour"),
    )


def q_segment_metrics(spark, sf_dir):
    """Flagship: test split -> prepare -> score -> error by hour / borough / trip type (one pass)."""
    inp = Inputs(spark, sf_dir)
    scored = DistanceFormulaScorer(inp.zones).transform(inp.prepared("test"))
    seg = segment_metrics(scored, inp.zones)
    return seg.select("segment_name", "segment", "rows", round6(F.col("rmse")).alias("rmse"),
                      round6(F.col("mae")).alias("mae"))


# --------------------------------------------------------------------------- fitted features
def q_route_frequency(spark, sf_dir):
    """A2 + F9: normalised route counts over train rows, keyed by the PU_DO route string."""
    from tripflow.functions.columns import route_key

    m = Inputs(spark, sf_dir).features
    t = m.route_frequency_table()
    return t.select(route_key(F.col("PULocationID"), F.col("DOLocationID")).alias("PU_DO_route"),
                    round6(F.col("route_frequency")).alias("route_frequency"))


def q_zone_frequency_lookup(spark, sf_dir):
    """A2 + J3: train frequencies looked up for every prepared trip (unseen -> 0.0)."""
    inp = Inputs(spark, sf_dir)
    out = inp.features.transform(inp.prepared())
    return out.select(TRIP_KEY, *[round6(F.col(c)).alias(c) for c in
                                  ("PU_zone_frequency", "DO_zone_frequency", "route_frequency")])


def q_distance_median(spark, sf_dir):
    """A1 + P12: exact median of positive zone distances over train rows, fallback 1.0."""
    from tripflow.plans.features import enrich_summary

    inp = Inputs(spark, sf_dir)
    m = inp.features
    d = F.col("estimated_distance_miles")
    return enrich_summary(m.summary, inp.zones).agg(
        round6(F.coalesce(F.percentile(F.when(d > 0, d), F.lit(0.5), F.col("n")), F.lit(1.0))).alias("median_distance"),
        F.sum("n").alias("train_rows"),
    )


def q_trip_type_mode(spark, sf_dir):
    """A3 + P10: learned trip-type mode applied to every prepared trip (and passenger default)."""
    inp = Inputs(spark, sf_dir)
    m = inp.features
    from tripflow.functions.columns import lax_double

    return inp.prepared().select(
        TRIP_KEY,
        F.coalesce(lax_double(F.col("trip_type")), F.lit(m.trip_type_fallback)).alias("trip_type"),
        F.coalesce(lax_double(F.col("passenger_count")), F.lit(1.0)).alias("passenger_count"),
    )


def q_categories(spark, sf_dir):
    """A4 + P11: sorted train categories per categorical column; position 1 is the dropped one."""
    from tripflow.functions.columns import with_sentinel
    from tripflow.plans.features import enrich_summary
    from tripflow.schema import CATEGORICAL_FEATURE_COLUMNS

    inp = Inputs(spark, sf_dir)
    enriched = enrich_summary(inp.features.summary, inp.zones)
    arrays = enriched.agg(*[F.array_sort(F.collect_set(with_sentinel(F.col(c)))).alias(c)
                            for c in CATEGORICAL_FEATURE_COLUMNS])
    stacked = arrays.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("cats")) for c in CATEGORICAL_FEATURE_COLUMNS])).alias("s"))
    return stacked.select(F.col("s.column").alias("column"), F.posexplode(F.col("s.cats"))).select(
        "column", (F.col("pos") + 1).cast("int").alias("position"), F.col("col").alias("category"))


def _long_features(spark, sf_dir, only_one_hot: bool):
    from tripflow.plans.features import BASE_FEATURES

    inp = Inputs(spark, sf_dir)
    m = inp.features
    long = m.long_form(m.transform(inp.prepared()), [TRIP_KEY])
    if only_one_hot:
        long = long.where(~F.col("feature").isin(BASE_FEATURES))
    return long.select(TRIP_KEY, "feature", round6(F.col("value")).alias("value"))


def q_one_hot(spark, sf_dir):
    """one-hot columns (first train category dropped, unseen -> all zeros), long form."""
    return _long_features(spark, sf_dir, True)


def q_feature_matrix(spark, sf_dir):
    """M1 + M2 + M3 + P13 + F11: the full fitted feature matrix for every prepared trip, long form."""
    return _long_features(spark, sf_dir, False)


# --------------------------------------------------------------------------- evaluation
def q_split_metrics(spark, sf_dir):
    """A5: rows, rmse and mae per split in one aggregate."""
    from tripflow.operators.evaluate import split_metrics

    m = split_metrics(Inputs(spark, sf_dir).scored())
    return m.select("split", "rows", round6(F.col("rmse")).alias("rmse"), round6(F.col("mae")).alias("mae"))


def q_residual_histogram(spark, sf_dir):
    """A16 + P15: 40-bin residual histogram of the test split, empty bins included."""
    from tripflow.operators.evaluate import residual_histogram

    h = residual_histogram(Inputs(spark, sf_dir).scored("test"))
    return h.select("bin", round6(F.col("bin_start")).alias("bin_start"), round6(F.col("bin_end")).alias("bin_end"),
                    "count")


def q_axis_limits(spark, sf_dir):
    """Common actual/predicted axis range of the test split."""
    from tripflow.operators.evaluate import axis_limits

    a = axis_limits(Inputs(spark, sf_dir).scored("test"))
    return a.select(round6(F.col("axis_min")).alias("axis_min"), round6(F.col("axis_max")).alias("axis_max"))


# --------------------------------------------------------------------------- monitoring
def q_monitoring_frame(spark, sf_dir):
    """S6 + P14 + P11: the labelled monitoring frame of the test split."""
    m = Inputs(spark, sf_dir).monitoring("test")
    return m.select(
        TRIP_KEY, "VendorID", "PULocationID", "DOLocationID", "trip_type", "pickup_hour", "pickup_day_of_week",
        "passenger_count", format_second(F.col(PICKUP)).alias(PICKUP), round6(F.col("duration")).alias("duration"),
        round6(F.col("prediction")).alias("prediction"),
    )


def q_missing_share(spark, sf_dir):
    """Missing cells over the test split's monitored inputs."""
    from tripflow.operators.monitor import missing_share

    m = missing_share(Inputs(spark, sf_dir).monitoring("test"))
    return m.select("rows", "missing_cells", round6(F.col("missing_share")).alias("missing_share"))


def q_data_summary(spark, sf_dir):
    """D3: per monitored column of the test split: role, rows, missing, distinct, top value, numeric stats."""
    from tripflow.operators.monitor import column_summary

    c = column_summary(Inputs(spark, sf_dir).monitoring("test"))
    return c.select("column", "role", "rows", "missing", "distinct", "top_value",
                    *[round6(F.col(x)).alias(x) for x in ("min", "max", "mean", "std")])


def _drift_out(df):
    return df.select("column", round6(F.col("drift_score")).alias("drift_score"), "drift_detected")


def q_categorical_drift(spark, sf_dir):
    """J6 + D4: Jensen-Shannon drift of the six categorical inputs, train (reference) vs test (current)."""
    from tripflow.operators.monitor import categorical_drift

    inp = Inputs(spark, sf_dir)
    return _drift_out(categorical_drift(inp.monitoring("train"), inp.monitoring("test")))


def q_numeric_drift(spark, sf_dir):
    """Normalised Wasserstein drift of passenger_count, duration, prediction, train vs test."""
    from tripflow.operators.monitor import numeric_drift

    inp = Inputs(spark, sf_dir)
    return _drift_out(numeric_drift(inp.monitoring("train"), inp.monitoring("test"),
                                    ["passenger_count", "duration", "prediction"]))


def q_input_report(spark, sf_dir):
    """D1 + D3 + A10 + A11: input drift/missing metrics, train inputs vs test inputs."""
    from tripflow.operators.monitor import input_report

    inp = Inputs(spark, sf_dir)
    r = input_report(inp.monitoring("train"), inp.monitoring("test"))
    return r.select(*[round6(F.col(c)).alias(c) for c in r.columns])


def q_quality_report(spark, sf_dir):
    """D2 + A12-A14: quality metrics, validation (reference) vs test (current)."""
    from tripflow.operators.monitor import quality_report

    inp = Inputs(spark, sf_dir)
    r = quality_report(inp.monitoring("val"), inp.monitoring("test"))
    return r.select(*[round6(F.col(c)).alias(c) for c in r.columns])


# --------------------------------------------------------------------------- lineage
def q_lineage_coverage(spark, sf_dir):
    """Rows and pickup time range of every prepared split (the fingerprint is in ``lineage_gate``)."""
    from tripflow.operators.lineage import split_fingerprints

    fp = split_fingerprints(Inputs(spark, sf_dir).prepared_split)
    return fp.select("dataset", "n_rows", "start", "end")


def q_lineage_fingerprint(spark, sf_dir):
    """Content fingerprint of every prepared split."""
    from tripflow.operators.lineage import split_fingerprints

    return split_fingerprints(Inputs(spark, sf_dir).prepared_split).select("dataset", "n_rows", "fingerprint")


def q_lineage_gate(spark, sf_dir):
    """D8 + F13: tags recorded at training against later states of the same splits: untouched, one row altered, one row
    lost, one row added; a pass/fail row per reference split and state."""
    from tripflow.operators.lineage import lineage_checks, split_fingerprints, training_lineage

    inp = Inputs(spark, sf_dir)
    trips = _landed_splits(inp)
    first = trips.agg(F.min(F.when(F.col("split") == "train", F.col(TRIP_KEY)))).first()[0]
    hit = F.col(TRIP_KEY) == F.lit(first)
    states = [trips.withColumn("state", F.lit("untouched")),
              trips.withColumn("state", F.lit("altered")).withColumn("DOLocationID", F.col("DOLocationID") + hit.cast("bigint")),
              trips.where(~hit).withColumn("state", F.lit("lost")),
              trips.withColumn("state", F.lit("added")), trips.where(hit).withColumn("state", F.lit("added"))]
    later = states[0]
    for s in states[1:]:
        later = later.unionByName(s)
    prints = split_fingerprints(later, ["state", "split"]).collect()  # one row per state and split
    now = spark.createDataFrame(prints, "state string, dataset string, n_rows bigint, start string, end string, fingerprint string")
    tags = training_lineage(now.where("state = 'untouched'"),
                            {k: f"{sf_dir}/events.parquet#{k}" for k in ("train", "val")})
    out = None
    for state in ("untouched", "altered", "lost", "added"):
        checked = lineage_checks(tags, now.where(F.col("state") == state)).select(
            F.lit(state).alias("state"), "dataset", "n_rows", "matches")
        out = checked if out is None else out.unionByName(checked)
    return out


def _scratch(spark, name: str) -> str:
    import uuid

    from tripflow.session import scratch_path

    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _landed_splits(inp: "Inputs", name: str | None = None) -> DataFrame:
    """The clean trips of the split table as it is landed (S3): the split is fitted and written once."""
    from tripflow.sources.tables import write_splits

    path = _scratch(inp.spark, "splits")
    write_splits(inp.splitter.assign(inp.raw), path)
    return prepare_training_data(inp.spark.read.parquet(path), keep=(TRIP_KEY, "split"))


def q_monitoring_history(spark, sf_dir):
    """The summary of a labelled monitoring run, appended to the history table and read back by metric."""
    from tripflow.operators.lineage import monitoring_summary
    from tripflow.operators.monitor import input_report, quality_report

    inp = Inputs(spark, sf_dir)
    train, val, test = (inp.monitoring(x) for x in ("train", "val", "test"))
    metrics = {**input_report(train, test).first().asDict(), **quality_report(val, test).first().asDict()}
    path = _scratch(spark, "history")
    monitoring_summary(
        spark, current_name="test", current_path=f"{sf_dir}/events.parquet", rows_reference=train.count(), rows_current=test.count(),
        has_labels=True, model={**MODEL_METADATA, "run_id": "run-1"}, lineage={"code.git_revision": "r1"}, metrics=metrics,
    ).write.mode("append").parquet(path)
    return spark.read.parquet(path).select(
        "current_name", "rows_reference", "rows_current", "has_labels", "model_run_id", "code_revision", F.explode("metrics").alias("metric", "value")
    ).withColumn("value", round6(F.col("value")))


# --------------------------------------------------------------------------- landed tables
def q_split_keyless(spark, sf_dir):
    """W1 on trips without an id: landed with a row key, then split; rows and time range of each split."""
    from tripflow.sources.tables import land_keyed

    trips = land_keyed(Inputs(spark, sf_dir).raw.drop(TRIP_KEY), _scratch(spark, "keyless"), TRIP_KEY)
    split = ChronologicalSplit(key_col=TRIP_KEY).fit(trips)
    return split.assign(trips).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), format_micros(F.min(PICKUP)).alias("start"), format_micros(F.max(PICKUP)).alias("end"))


def q_raw_sorted(spark, sf_dir):
    """O1: the raw table written in pickup order; rows, range, and what is out of order inside and between its files."""
    from pyspark.sql import Window

    from tripflow.sources.monthly import write_raw_sorted

    path = _scratch(spark, "sorted")
    write_raw_sorted(Inputs(spark, sf_dir).raw, path, (PICKUP, TRIP_KEY))
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), F.col(PICKUP).alias("ts"))
    before = F.lag("ts").over(Window.partitionBy("file").orderBy("at"))  # a file is one range of the order
    files = rows.withColumn("late", F.coalesce(before > F.col("ts"), F.lit(False)).cast("bigint")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.sum("late").alias("late"))
    # one entry per file
    whole = files.agg(F.sum("n").alias("rows"), F.min("lo").alias("first"), F.max("hi").alias("last"),
                      F.sum("late").alias("out_of_order"), F.array_sort(F.collect_list(F.struct("file", "lo", "hi"))).alias("f"))
    overlaps = F.filter("f", lambda x, i: (i > 0) & (F.get("f", F.greatest(i - 1, F.lit(0)))["hi"] > x["lo"]))
    return whole.select("rows", format_micros(F.col("first")).alias("first"), format_micros(F.col("last")).alias("last"),
                        "out_of_order", F.size(overlaps).cast("bigint").alias("overlapping_files"))


def q_split_roundtrip(spark, sf_dir):
    """S3 + S4 + P5: the splits in one write, each loaded and prepared again."""
    from tripflow.sources.tables import load_split, write_splits

    inp = Inputs(spark, sf_dir)
    path = _scratch(spark, "splits")
    write_splits(inp.splitter.assign(inp.raw), path)
    out = None
    for name in ("train", "val", "test"):
        part = load_split(spark, path, name).select(
            TRIP_KEY, F.lit(name).alias("split"), format_second(F.col(PICKUP)).alias(PICKUP), round6(F.col("duration")).alias("duration"))
        out = part if out is None else out.unionByName(part)
    return out


def q_zone_csv(spark, sf_dir):
    """The zone dimension written as CSV and read back under its schema, ids checked."""
    from tripflow.sources.tables import read_zone_csv, write_zone_csv

    path = _scratch(spark, "zones")
    write_zone_csv(Inputs(spark, sf_dir).zones.df, path)
    zones = read_zone_csv(spark, path).df
    return zones.select("LocationID", "Borough", "Zone", round6(F.col("latitude")).alias("latitude"), round6(F.col("longitude")).alias("longitude"))


def q_monitoring_unlabelled(spark, sf_dir):
    """S6 + F3: a batch without dropoff times, pickups as text: every trip is monitored, there is no quality frame."""
    from tripflow.operators.monitor import load_monitoring_batch
    from tripflow.schema import DROPOFF

    inp = Inputs(spark, sf_dir)
    raw = inp.raw.drop(DROPOFF, "trip_distance").withColumn(PICKUP, format_second(F.col(PICKUP)))
    batch = load_monitoring_batch(raw, inp.scorer, keep=(TRIP_KEY,))
    return batch.input_frame.select(
        TRIP_KEY, "VendorID", "PULocationID", "DOLocationID", "trip_type", "pickup_hour", "pickup_day_of_week",
        "passenger_count", format_second(F.col(PICKUP)).alias(PICKUP), F.lit(batch.quality_frame is not None).alias("labelled"))


def q_input_example(spark, sf_dir):
    """The first three model inputs of the train split."""
    from tripflow.plans.train import input_example

    e = input_example(Inputs(spark, sf_dir).prepared("train"), (PICKUP, TRIP_KEY))
    return e.select(TRIP_KEY, "VendorID", format_second(F.col(PICKUP)).alias(PICKUP), "PULocationID", "DOLocationID", "passenger_count", "trip_type")


# --------------------------------------------------------------------------- registry, tuning, serving log
def q_champion_fold(spark, sf_dir):
    """Alias decision of every registered version, in one blocked ordered scan per model."""
    from tripflow.operators.registry import champion_fold

    d = champion_fold(adapter.model_versions(spark, sf_dir))
    return d.select("model", "version", "rmse_test", "champion_metric_before", "decision")


def q_model_aliases(spark, sf_dir):
    """W2 (final state): current champion and challenger version per model."""
    from tripflow.operators.registry import champion_fold, current_aliases

    return current_aliases(champion_fold(adapter.model_versions(spark, sf_dir)))


def q_best_trial(spark, sf_dir):
    """Lowest validation rmse per study, with the trial's parameters."""
    from tripflow.operators.registry import best_trial

    b = best_trial(adapter.tuning_trials(spark, sf_dir))
    return b.select("study", "n_trials", "best_trial", round6(F.col("best_rmse_val")).alias("best_rmse_val"),
                    "max_depth", "min_child_weight")


def q_latency_profile(spark, sf_dir):
    """Latency percentiles, success rate and throughput per (batch size, concurrency) case."""
    from tripflow.operators.servelog import latency_profile

    p = latency_profile(adapter.request_log(spark, sf_dir))
    return p.select("batch_size", "concurrency", "request_count", *[round6(F.col(c)).alias(c) for c in (
        "success_rate", "requests_per_second", "latency_ms_p50", "latency_ms_p95", "latency_ms_p99")])


TILE_SIZE = 100


def q_tiled_batch(spark, sf_dir):
    """Every request's trips tiled cyclically to the largest benchmark batch size."""
    from tripflow.operators.servelog import tile_array

    reqs = adapter.request_trip_ids(spark, sf_dir)
    tiled = reqs.where(F.size("trip_ids") > 0).select("request_id", F.posexplode(tile_array(F.col("trip_ids"), TILE_SIZE)))
    return tiled.select("request_id", F.col("pos").cast("int").alias("pos"), F.col("col").alias(TRIP_KEY))


# --------------------------------------------------------------------------- requests and streaming
MODEL_METADATA = {"model_name": "trip_duration_model", "model_version": 1, "model_alias": "champion"}


def _validated_requests(spark, sf_dir):
    from tripflow.plans.scoring import parse_requests, validate_requests

    return validate_requests(parse_requests(adapter.request_bodies(spark, sf_dir)))


def q_request_validation(spark, sf_dir):
    """S7 + P16: every request parsed from JSON and validated; one bad trip rejects the request."""
    v = _validated_requests(spark, sf_dir)
    # integer outputs stay non-null (-1 = no invalid trip) so both engines hand over plain integers
    return v.select("request_id", "n_trips", "valid", "n_invalid_trips",
                    F.coalesce(F.col("first_invalid_pos"), F.lit(-1)).alias("first_invalid_pos"), "first_invalid_field")


def q_request_scoring(spark, sf_dir):
    """M8 + M9: predictions per request in trip order with model metadata (rejected requests: 422)."""
    from tripflow.plans.scoring import score_requests

    inp = Inputs(spark, sf_dir)
    r = score_requests(_validated_requests(spark, sf_dir), inp.scorer, MODEL_METADATA)
    text = F.array_join(F.transform("predictions", lambda x: F.format_string("%.6f", x)), ",")
    n = F.when(F.col("predictions").isNull(), F.lit(0)).otherwise(F.size("predictions"))  # non-null integer
    return r.select("request_id", "status", n.alias("n_predictions"),
                    text.alias("predictions_text"), "model_name", "model_version", "model_alias")


def q_stream_scoring(spark, sf_dir):
    """ST1: the same requests as a file stream; scored trips of valid requests (equals the batch answer)."""
    import uuid

    from tripflow.session import scratch_path
    from tripflow.streaming.scoring import run_available

    inp = Inputs(spark, sf_dir)
    run = scratch_path(spark, f"stream-scoring-{uuid.uuid4().hex}")
    lines = adapter.request_bodies(spark, sf_dir).select(
        F.concat(F.lit('{"request_id":'), F.col("request_id").cast("string"), F.lit(","),
                 F.expr("substring(body, 2)")).alias("value"))
    lines.write.text(f"{run}/source")
    run_available(spark, f"{run}/source", f"{run}/sink", f"{run}/checkpoint", inp.scorer)
    out = spark.read.parquet(f"{run}/sink/scored")
    return out.select("request_id", F.col("pos").cast("int").alias("pos"), round6(F.col("prediction")).alias("prediction"))


# --------------------------------------------------------------------------- model
def _fitted_pipeline(inp: "Inputs"):
    """The champion's parameters, unchanged, fitted on the train split."""
    from tripflow.plans.train import fit_pipeline
    from tripflow.schema import CHAMPION_PARAMS

    return fit_pipeline(inp.zones, inp.prepared("train"), CHAMPION_PARAMS)


def q_gbt_scoring(spark, sf_dir):
    """M4 + M5 + M8: fit the champion's parameters on train, score every prepared trip. What holds for any sound
    learner is returned: each trip once with a finite prediction, and whether its split's squared error is below that of
    the train mean on train and within twice that elsewhere (the generated durations hold no signal to learn)."""
    from tripflow.plans.train import score

    inp = Inputs(spark, sf_dir)
    s = score(_fitted_pipeline(inp), inp.prepared_split, keep=(TRIP_KEY, "split", "duration")).persist()
    p, y = F.col("prediction"), F.col("duration")
    mean = s.where("split = 'train'").agg(F.avg("duration")).first()[0]
    error, plain = F.avg((y - p) ** 2), F.avg((y - F.lit(mean)) ** 2)
    sound = F.when(F.col("split") == "train", error < plain).otherwise(error < 2.0 * plain)
    by_split = s.groupBy("split").agg(sound.alias("sound"))
    # one row per split
    return s.join(F.broadcast(by_split), "split").select(
        TRIP_KEY, "split", round6(y).alias("duration"),
        (p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))).alias("finite"), "sound")


def q_feature_importance(spark, sf_dir):
    """O2: the top-20 features of the champion's trees; per rank, what holds for any sound learner: the feature is one
    of the fitted ones, importances fall with the rank and sum to no more than one."""
    from pyspark.sql import Window

    from tripflow.plans.train import feature_importance, feature_model

    model = _fitted_pipeline(Inputs(spark, sf_dir))
    names = feature_model(model).getFeatureNamesOut()
    by_rank = Window.orderBy("rank")  # twenty rows
    return feature_importance(model).select(
        "rank", F.col("feature").isin(names).alias("fitted"),
        F.coalesce(F.lag("importance").over(by_rank) >= F.col("importance"), F.lit(True)).alias("falling"),
        (F.sum("importance").over(by_rank) <= 1 + 1e-9).alias("within_one"))


# --------------------------------------------------------------------------- sources, contracts, sampling
def q_monthly_union(spark, sf_dir):
    """S1 + U1 + P6: trips landed as ten-day files with drifting schemas (one without fares, one with integer counts,
    one with a column of its own), read back over a grid with one missing period, all columns conformed and unioned."""
    import datetime as dt

    from tripflow.schema import RAW_TRIP
    from tripflow.sources.monthly import read_periods

    raw = adapter.landed_trips(spark, sf_dir)
    start = raw.agg(F.min(PICKUP)).first()[0].replace(hour=0, minute=0, second=0, microsecond=0)
    at = [F.lit(start + dt.timedelta(days=d)).cast("timestamp_ntz") for d in (10, 20)]
    ts, base = F.col(PICKUP), _scratch(spark, "monthly")
    raw.where(ts < at[0]).drop("hvfhs_license").write.parquet(f"{base}/p0")
    raw.where((ts >= at[0]) & (ts < at[1])).drop("fare_amount", "hvfhs_license").write.parquet(f"{base}/p1")
    raw.where(ts >= at[1]).withColumn("passenger_count", F.col("passenger_count").cast("bigint")) \
        .withColumn("VendorID", F.col("VendorID").cast("int")).write.parquet(f"{base}/p2")
    grid = {f"p{i}": f"{base}/p{i}" for i in range(4)}  # p3 was never landed
    scan = read_periods(spark, grid)
    if scan.missing != ["p3"]:
        raise RuntimeError(f"unexpected missing periods {scan.missing}")
    kept = [f.name for f in RAW_TRIP.fields if f.name not in (PICKUP, "lpep_dropoff_datetime")]
    return scan.frame.select(TRIP_KEY, "period", *kept, "hvfhs_license", format_second(ts).alias(PICKUP))


def q_signature_cast(spark, sf_dir):
    """Request fields of valid requests cast to the model signature (ids integral, counts lax)."""
    from tripflow.functions.columns import signature_cast
    from tripflow.plans.scoring import parse_requests, validate_requests

    v = validate_requests(parse_requests(adapter.request_bodies(spark, sf_dir)), raw_col="sent").where("valid")
    rows = v.select("request_id", F.posexplode("sent").alias("pos", "t"))
    flat = rows.select("request_id", F.col("pos").cast("int").alias("pos"), "t.*")
    return signature_cast(flat).select("request_id", "pos", "VendorID", "PULocationID", "DOLocationID",
                                       "passenger_count", "trip_type")


def q_exact_sample(spark, sf_dir):
    """Exactly 500 seeded rows of the test monitoring frame (the sampling operator; stable under repartitioning)."""
    from tripflow.operators.monitor import exact_sample
    from tripflow.schema import RANDOM_SEED

    m = Inputs(spark, sf_dir).monitoring("test")
    return exact_sample(m, 500, RANDOM_SEED, key_cols=[TRIP_KEY]).select(TRIP_KEY, "VendorID", "trip_type")


QUERIES = {
    "prepared_trips": q_prepared_trips,
    "chronological_split": q_chronological_split,
    "split_report": q_split_report,
    "zone_enriched": q_zone_enriched,
    "time_features": q_time_features,
    "segment_metrics": q_segment_metrics,
    "route_frequency": q_route_frequency,
    "zone_frequency_lookup": q_zone_frequency_lookup,
    "distance_median": q_distance_median,
    "trip_type_mode": q_trip_type_mode,
    "categories": q_categories,
    "one_hot": q_one_hot,
    "feature_matrix": q_feature_matrix,
    "split_metrics": q_split_metrics,
    "residual_histogram": q_residual_histogram,
    "axis_limits": q_axis_limits,
    "monitoring_frame": q_monitoring_frame,
    "missing_share": q_missing_share,
    "data_summary": q_data_summary,
    "categorical_drift": q_categorical_drift,
    "numeric_drift": q_numeric_drift,
    "input_report": q_input_report,
    "quality_report": q_quality_report,
    "lineage_coverage": q_lineage_coverage,
    "lineage_gate": q_lineage_gate,
    "champion_fold": q_champion_fold,
    "model_aliases": q_model_aliases,
    "best_trial": q_best_trial,
    "latency_profile": q_latency_profile,
    "tiled_batch": q_tiled_batch,
    "request_validation": q_request_validation,
    "request_scoring": q_request_scoring,
    "stream_scoring": q_stream_scoring,
    "gbt_scoring": q_gbt_scoring,
    "feature_importance": q_feature_importance,
    "monthly_union": q_monthly_union,
    "signature_cast": q_signature_cast,
    "exact_sample": q_exact_sample,
    "lineage_fingerprint": q_lineage_fingerprint,
    "monitoring_history": q_monitoring_history,
    "monitoring_unlabelled": q_monitoring_unlabelled,
    "split_keyless": q_split_keyless,
    "split_roundtrip": q_split_roundtrip,
    "raw_sorted": q_raw_sorted,
    "zone_csv": q_zone_csv,
    "input_example": q_input_example,
}
