"""Further registered queries with their DuckDB SQL side by side: KS drift, monitoring windows, request streams, trees,
saved pipelines, the period source, typed requests and the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import round6
from tripflow.oracle import BASE, FEATURE_CTES, MON, MON_CTES, ORACLE, RAW, REQUESTS, SCORED_ALL, SPLIT, ZONES, cat_drift_cte, with_ctes
from tripflow.queries import Inputs, _scratch
from tripflow.schema import PICKUP

MORE: dict = {}
MORE_ORACLE: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def keep(fn):
        MORE[name] = fn
        if sql:
            MORE_ORACLE[name] = sql
        return fn

    return keep


# --------------------------------------------------------------------------- drift
@registered("numeric_drift_ks", with_ctes(*MON_CTES, """long AS (
  UNPIVOT (SELECT CASE WHEN split = 'train' THEN 0 ELSE 1 END AS side, passenger_count, duration, prediction FROM mon WHERE split IN ('train', 'test'))
  ON passenger_count, duration, prediction INTO NAME "column" VALUE value),
counts AS (
  SELECT "column", value, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c
  FROM long WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY "column", value),
cdf AS (
  SELECT "column", sum(r) OVER (PARTITION BY "column") AS n_ref, sum(c) OVER (PARTITION BY "column") AS n_cur,
         sum(r) OVER w / sum(r) OVER (PARTITION BY "column") AS fr, sum(c) OVER w / sum(c) OVER (PARTITION BY "column") AS fc
  FROM counts WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT "column", max(n_ref) AS n_ref, max(n_cur) AS n_cur, max(abs(fr - fc)) AS d FROM cdf GROUP BY "column"),
x AS (SELECT *, sqrt(n_ref * n_cur / (n_ref + n_cur)) AS root FROM ks),
y AS (SELECT *, (root + 0.12 + 0.11 / root) * d AS x FROM x),
p AS (
  SELECT "column", n_ref, n_cur, d, x, greatest(0.0, least(1.0, sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x)))) AS p
  FROM y, (SELECT CAST(range AS DOUBLE) AS k FROM range(1, 101)) GROUP BY ALL)""", body="""
SELECT "column", CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, round(d, 6) AS ks_statistic,
       round(CASE WHEN x < 0.2 THEN 1.0 ELSE p END, 6) AS p_value, CAST(CASE WHEN x < 0.2 THEN 1.0 ELSE p END < 0.05 AS DOUBLE) AS drift_detected
FROM p"""))
def q_numeric_drift_ks(spark, sf_dir) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of passenger_count, duration, prediction, train vs test, exact."""
    from tripflow.operators.states import ks_drift

    inp = Inputs(spark, sf_dir)
    d = ks_drift(inp.monitoring("train"), inp.monitoring("test"), ["passenger_count", "duration", "prediction"])
    return d.select("column", "n_ref", "n_cur", round6(F.col("ks_statistic")).alias("ks_statistic"), round6(F.col("p_value")).alias("p_value"), "drift_detected")


WINDOW_BATCHES = 7
_CONTINUOUS = ["passenger_count", "duration", "prediction"]


@registered("monitoring_window", with_ctes(*BASE, ZONES, SCORED_ALL, MON.replace("mon AS", "mon_base AS"), """last_days AS (
  SELECT DISTINCT CAST(lpep_pickup_datetime AS DATE) AS day FROM mon_base WHERE split = 'test' ORDER BY day DESC LIMIT 7),
mon AS (
  SELECT * REPLACE (CASE WHEN split = 'test' AND CAST(lpep_pickup_datetime AS DATE) IN (SELECT day FROM last_days) THEN 'window' ELSE split END AS split)
  FROM mon_base)""", cat_drift_cte("train", "window"), body="""
, w AS (SELECT *, duration - prediction AS e FROM mon WHERE split = 'window')
SELECT "column" || '_drift_score' AS metric, round(drift_score, 6) AS value FROM cat_scores
UNION ALL SELECT unnest(['passenger_count_drift_score_within', 'duration_drift_score_within', 'prediction_drift_score_within',
                         'passenger_count_ks_within', 'duration_ks_within', 'prediction_ks_within']), 1.0
UNION ALL SELECT 'rows', CAST(count(*) AS DOUBLE) FROM w
UNION ALL SELECT 'missing_share', round(count(*) FILTER (WHERE passenger_count IS NULL) / (count(*) * 8.0), 6) FROM w
UNION ALL SELECT 'rmse', round(sqrt(avg(e * e)), 6) FROM w
UNION ALL SELECT 'mae', round(avg(abs(e)), 6) FROM w
UNION ALL SELECT 'passenger_count_mean', round(avg(passenger_count), 6) FROM w
UNION ALL SELECT 'passenger_count_std', round(stddev_pop(passenger_count), 6) FROM w
UNION ALL SELECT 'duration_mean', round(avg(duration), 6) FROM w
UNION ALL SELECT 'duration_std', round(stddev_pop(duration), 6) FROM w
UNION ALL SELECT 'prediction_mean', round(avg(prediction), 6) FROM w
UNION ALL SELECT 'prediction_std', round(stddev_pop(prediction), 6) FROM w"""))
def q_monitoring_window(spark, sf_dir) -> DataFrame:
    """D2 + D6 over time: each day of the test split leaves its state; the report over the last seven batches comes from
    the states alone. Exact figures are returned as they are; drift of continuous columns as whether it is within the
    sketches' bound of the exact figure over the same trips."""
    from tripflow.operators.monitor import numeric_drift
    from tripflow.operators.states import (
        GRID, batch_state, ks_drift, ks_from_states, merge_states, rank_error, read_states, window_report, write_state, write_states,
    )

    inp = Inputs(spark, sf_dir)
    day = F.date_format(F.col(PICKUP).cast("date"), "yyyy-MM-dd")
    train, test = inp.monitoring("train"), inp.monitoring("test").withColumn("day", day)
    path = _scratch(spark, "states")
    write_states(batch_state(test, by=("day",)), f"{path}/current", "day")
    write_state(batch_state(train), f"{path}/reference", "train")
    # one row for each batch that was ever written
    batches = sorted((r["batch"] for r in read_states(spark, f"{path}/current").select("batch").distinct().collect()), reverse=True)[:WINDOW_BATCHES]
    reference = merge_states(read_states(spark, f"{path}/reference", ["train"]))
    current = merge_states(read_states(spark, f"{path}/current", batches))
    report = window_report(reference, current)

    union = test.where(F.col("day").isin(batches))
    exact_w = numeric_drift(train, union, _CONTINUOUS).select(F.concat("column", F.lit("_drift_score")).alias("metric"), F.col("drift_score").alias("exact"))
    exact_ks = ks_drift(train, union, _CONTINUOUS).select("column", F.col("ks_statistic").alias("exact"))
    # one row for each monitored column
    near = report.join(F.broadcast(exact_w), "metric").select(
        F.concat("metric", F.lit("_within")).alias("metric"), (F.abs(F.col("value") - F.col("exact")) <= 0.02).cast("double").alias("value"))
    ks = ks_from_states(reference, current).join(F.broadcast(exact_ks), "column").select(
        F.concat("column", F.lit("_ks_within")).alias("metric"),
        (F.abs(F.col("ks_statistic") - F.col("exact")) <= 2 * rank_error() + 1 / GRID).cast("double").alias("value"))
    plain = report.join(F.broadcast(exact_w.select("metric")), "metric", "left_anti").select("metric", round6(F.col("value")).alias("value"))
    return plain.unionByName(near).unionByName(ks)


# --------------------------------------------------------------------------- streams
#: Appends in which the lines of the requests arrive, and seconds by which trips of a request are apart at most.
APPENDS, JITTER_S = 4, 60


@registered("stream_request_answers", ORACLE["request_scoring"])
def q_stream_request_answers(spark, sf_dir) -> DataFrame:
    """ST1 per request: the trips of all requests arrive one per line, out of order, some twice, over several appends
    and micro-batches; the answers equal those of ``request_scoring``."""
    import datetime as dt

    from tripflow.queries import MODEL_METADATA
    from tripflow.sources import adapter
    from tripflow.streaming.answers import run_answers

    inp, run = Inputs(spark, sf_dir), _scratch(spark, "answers")
    whole = adapter.request_bodies(spark, sf_dir).select("request_id", F.from_json("body", "trips array<string>")["trips"].alias("trips"))
    last = whole.agg(F.max("request_id")).first()[0] or 0
    trips = whole.select("request_id", F.size("trips").alias("n_trips"), F.posexplode("trips").alias("pos", "trip"))
    late = F.pmod(F.xxhash64("request_id", "pos"), F.lit(JITTER_S))
    at = trips.withColumn("second", F.col("request_id") + late)
    again = at.where(F.pmod(F.xxhash64("pos", "request_id"), F.lit(9)) == 0).withColumn("second", F.col("second") + JITTER_S // 2)
    lines = at.unionByName(again).select(
        "second", F.to_json(F.struct("request_id", "pos", "n_trips", F.date_format(
            F.timestamp_seconds(F.lit(1_767_225_600) + F.col("second")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("sent_at"), "trip")).alias("value"))
    span = (int(last) + 2 * JITTER_S) // APPENDS + 1
    for k in range(APPENDS):
        lines.where((F.col("second") >= k * span) & (F.col("second") < (k + 1) * span)).select("value").write.mode("append").text(f"{run}/in")
    run_answers(spark, f"{run}/in", f"{run}/out", f"{run}/checkpoint", inp.scorer, MODEL_METADATA,
                patience=dt.timedelta(minutes=10), delay=f"{span + JITTER_S} seconds", max_files_per_trigger=16)
    r = spark.read.parquet(f"{run}/out")
    text = F.array_join(F.transform("predictions", lambda x: F.format_string("%.6f", x)), ",")
    n = F.when(F.col("predictions").isNull(), F.lit(0)).otherwise(F.size("predictions"))
    return r.select("request_id", "status", n.alias("n_predictions"), text.alias("predictions_text"), "model_name", "model_version", "model_alias")


# --------------------------------------------------------------------------- trees
#: Trees of the queries whose subject is evaluating, saving and explaining a model rather than its quality.
FEW_TREES = {"n_estimators": 40, "learning_rate": 0.15}


def _with_signal(prepared: DataFrame, zones) -> DataFrame:
    """The trips with a duration that follows from distance, hour and passengers, and a little noise from the trip's id,
    so that there is something to learn."""
    from tripflow.functions.geo import haversine_miles
    from tripflow.functions.timefeat import is_rush_hour
    from tripflow.sources.adapter import TRIP_KEY

    z = zones.df
    side = lambda p: zones.side(z.select(F.col("LocationID").alias(f"{p}k"), F.col("latitude").alias(f"{p}a"), F.col("longitude").alias(f"{p}o")))
    joined = prepared.join(side("p"), F.col("PULocationID") == F.col("pk"), "left").join(side("d"), F.col("DOLocationID") == F.col("dk"), "left")
    miles = F.coalesce(haversine_miles(F.col("pa"), F.col("po"), F.col("da"), F.col("do")), F.lit(1.0))
    noise = (F.pmod(F.col(TRIP_KEY) * 7919, F.lit(101)) - 50) / 100.0
    duration = 4.0 + 6.0 * miles + 5.0 * is_rush_hour(F.hour(PICKUP)) + F.coalesce("passenger_count", F.lit(1.0)) / 2.0 + noise
    return joined.withColumn("duration", duration).select(*prepared.columns)


def _signal_model(inp: Inputs):
    from tripflow.plans.train import fit_pipeline
    from tripflow.schema import CHAMPION_PARAMS

    trips = _with_signal(inp.prepared_split, inp.zones)
    return fit_pipeline(inp.zones, trips.where("split = 'train'"), {**CHAMPION_PARAMS, **FEW_TREES}), trips


@registered("learner_signal", with_ctes(*BASE, body="""
SELECT split, count(*) AS "rows", true AS learned FROM prepared GROUP BY split"""))
def q_learner_signal(spark, sf_dir) -> DataFrame:
    """M4 on durations that can be learned: per split, whether the squared error is below a tenth of the train mean's."""
    from tripflow.plans.ensemble import EnsembleScorer

    model, trips = _signal_model(Inputs(spark, sf_dir))
    mean = trips.where("split = 'train'").agg(F.avg("duration")).first()[0]
    y, p = F.col("duration"), F.col("prediction")
    return EnsembleScorer(model).transform(trips).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), (F.avg((y - p) ** 2) < 0.1 * F.avg((y - F.lit(mean)) ** 2)).alias("learned"))


@registered("ensemble_scoring", with_ctes(*BASE, body="""
SELECT 'trip' AS scored, trip_id AS id, true AS equal FROM prepared
UNION ALL SELECT 'request', request_id, true FROM (""" + "{requests}" + """)"""))
def q_ensemble_scoring(spark, sf_dir) -> DataFrame:
    """M8 + M9 by bit vectors: every prepared trip, and every request in one narrow stage; whether the predictions equal
    those of the learner's own transform (to 1e-9)."""
    from tripflow.plans.ensemble import EnsembleScorer
    from tripflow.plans.scoring import score_requests
    from tripflow.plans.train import PipelineScorer, score
    from tripflow.queries import MODEL_METADATA, _validated_requests
    from tripflow.sources.adapter import TRIP_KEY

    model, trips = _signal_model(Inputs(spark, sf_dir))
    fast = EnsembleScorer(model)
    own = score(model, trips, keep=(TRIP_KEY,)).withColumnRenamed("prediction", "want")
    by_trip = fast.transform(trips).join(own, TRIP_KEY).select(
        F.lit("trip").alias("scored"), F.col(TRIP_KEY).alias("id"), (F.abs(F.col("prediction") - F.col("want")) < 1e-9).alias("equal"))
    requests = _validated_requests(spark, sf_dir)
    want = score_requests(requests, PipelineScorer(model), MODEL_METADATA).select("request_id", F.col("status").alias("s"), F.col("predictions").alias("want"))
    near = F.when(F.col("want").isNull(), F.col("predictions").isNull()).otherwise(
        (F.size("want") == F.size("predictions")) & ~F.exists(F.zip_with("want", "predictions", lambda a, b: F.abs(a - b) < 1e-9), lambda x: ~x))
    by_request = fast.score_requests(requests, MODEL_METADATA).join(want, "request_id").select(
        F.lit("request").alias("scored"), F.col("request_id").alias("id"), ((F.col("status") == F.col("s")) & near).alias("equal"))
    return by_trip.unionByName(by_request)


MORE_ORACLE["ensemble_scoring"] = MORE_ORACLE["ensemble_scoring"].replace("{requests}", "SELECT DISTINCT event_id // 10 AS request_id FROM events")


@registered("pipeline_roundtrip", with_ctes(*BASE, body="SELECT trip_id, true AS equal FROM prepared"))
def q_pipeline_roundtrip(spark, sf_dir) -> DataFrame:
    """M5 as one artefact: the fitted pipeline saved, loaded as a Spark ML pipeline, and every trip scored by both."""
    from pyspark.ml import PipelineModel

    from tripflow.plans.train import save_pipeline, score
    from tripflow.sources.adapter import TRIP_KEY

    model, trips = _signal_model(Inputs(spark, sf_dir))
    path = _scratch(spark, "pipeline")
    save_pipeline(model, path)
    again = score(PipelineModel.load(path), trips, keep=(TRIP_KEY,)).withColumnRenamed("prediction", "again")
    return score(model, trips, keep=(TRIP_KEY,)).join(again, TRIP_KEY).select(TRIP_KEY, (F.col("prediction") == F.col("again")).alias("equal"))


@registered("importance_values", """
SELECT CAST(range AS INTEGER) AS rank, true AS equal FROM range(1, 21)""")
def q_importance_values(spark, sf_dir) -> DataFrame:
    """O2 by value: the importances of the ranked features against those recomputed from the exported tree nodes (the
    gain of every split times its rows, summed by feature); a feature that never splits has none."""
    from tripflow.plans.ensemble import importance_from_nodes, tree_nodes
    from tripflow.plans.train import feature_importance, feature_model

    model, _ = _signal_model(Inputs(spark, sf_dir))
    nodes = importance_from_nodes(tree_nodes(model.stages[-1]), feature_model(model).getFeatureNamesOut()).withColumnRenamed("importance", "own")
    return feature_importance(model).join(nodes, "feature", "left").select(
        "rank", (F.abs(F.col("importance") - F.coalesce("own", F.lit(0.0))) < 1e-9).alias("equal"))


# --------------------------------------------------------------------------- requests by JSON type
@registered("request_validation_typed", with_ctes(RAW, ZONES, REQUESTS, body="""
, hit AS (
  SELECT event_id // 10 AS request_id, count(*) FILTER (WHERE event_id % 7 <> 0) AS with_passengers,
         count(*) FILTER (WHERE event_id % 20 = 4 AND event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0 AND event_id % 13 <> 0) AS n
  FROM events GROUP BY 1)
SELECT v.request_id, v.n_trips, CASE v.request_id % 6
         WHEN 2 THEN v.valid AND h.with_passengers = 0 WHEN 3 THEN v.valid AND h.with_passengers = 0 WHEN 5 THEN false ELSE v.valid END AS valid
FROM validated v JOIN hit h USING (request_id)"""))
def q_request_validation_typed(spark, sf_dir) -> DataFrame:
    """S7 + P16 by JSON type, over all requests with types exchanged by request: vendors as true (a number, 1), passenger
    counts as arrays or as the text "true" (no numbers) and as false (0), a pickup that is a number."""
    from tripflow.plans.scoring import parse_requests_typed, validate_requests
    from tripflow.sources import adapter

    body, kind = F.col("body"), F.col("request_id") % 6
    count = r'"passenger_count":[0-9.]+'
    mixed = (F.when(kind == 1, F.regexp_replace(body, r'"VendorID":[12],', '"VendorID":true,'))
             .when(kind == 2, F.regexp_replace(body, count, '"passenger_count":[1]'))
             .when(kind == 3, F.regexp_replace(body, count, '"passenger_count":"true"'))
             .when(kind == 4, F.regexp_replace(body, count, '"passenger_count":false'))
             .when(kind == 5, F.regexp_replace(body, r'"lpep_pickup_datetime":"[^"]*"', '"lpep_pickup_datetime":20260115')).otherwise(body))
    v = validate_requests(parse_requests_typed(adapter.request_bodies(spark, sf_dir).withColumn("body", mixed)))
    return v.select("request_id", "n_trips", "valid")


# --------------------------------------------------------------------------- landed tables, contracts, jobs
@registered("raw_by_month", with_ctes(RAW, body="""
SELECT strftime(lpep_pickup_datetime, '%Y-%m') AS pickup_month, count(*) AS "rows", min(trip_id) AS first_trip, max(trip_id) AS last_trip
FROM raw_trips GROUP BY 1"""))
def q_raw_by_month(spark, sf_dir) -> DataFrame:
    """The merged raw table written by pickup month and read back, a folder a month."""
    from tripflow.sources.adapter import TRIP_KEY
    from tripflow.sources.monthly import write_raw

    path = _scratch(spark, "by-month")
    write_raw(Inputs(spark, sf_dir).raw, path)
    return spark.read.parquet(path).groupBy(F.col("pickup_month").cast("string").alias("pickup_month")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(TRIP_KEY).alias("first_trip"), F.max(TRIP_KEY).alias("last_trip"))


@registered("metrics_json", with_ctes(*BASE, ZONES, SCORED_ALL, body="""
, m AS (SELECT split, CAST(count(*) AS DOUBLE) AS n, sqrt(avg((duration - prediction) * (duration - prediction))) AS rmse, avg(abs(duration - prediction)) AS mae
        FROM scored_all GROUP BY split)
SELECT 'rows_' || split AS metric, n AS value FROM m UNION ALL SELECT 'rmse_' || split, round(rmse, 6) FROM m
UNION ALL SELECT 'mae_' || split, round(mae, 6) FROM m"""))
def q_metrics_json(spark, sf_dir) -> DataFrame:
    """The metrics of all splits as one JSON record with sorted keys, written and read back by name."""
    from tripflow.operators.evaluate import split_metrics
    from tripflow.sources.tables import write_metrics_json

    found = split_metrics(Inputs(spark, sf_dir).scored()).collect()  # one row a split
    path = _scratch(spark, "metrics")
    write_metrics_json(spark, {f"{k}_{r['split']}": r[k] for r in found for k in ("rows", "rmse", "mae")}, path)
    return spark.read.text(path).select(F.explode(F.from_json("value", "map<string,double>")).alias("metric", "value")).withColumn("value", round6(F.col("value")))


@registered("missing_optionals", with_ctes(*FEATURE_CTES, body="""
SELECT trip_id, 'passenger_count' AS feature, 1.0 AS value FROM prepared
UNION ALL
SELECT p.trip_id, 'trip_type_' || c.cat, CAST(CAST((SELECT trip_type_mode FROM fit_mode) AS VARCHAR) = c.cat AS DOUBLE)
FROM prepared p CROSS JOIN cats_ranked c WHERE c.col = 'trip_type' AND c.pos > 1"""))
def q_optional_defaults(spark, sf_dir) -> DataFrame:
    """Trips without the optional columns get the passenger default and the learned trip type."""
    from tripflow.sources.adapter import TRIP_KEY

    inp = Inputs(spark, sf_dir)
    bare = inp.prepared().drop("passenger_count", "trip_type")
    long = inp.features.long_form(inp.features.transform(bare), [TRIP_KEY])
    return long.where((F.col("feature") == "passenger_count") | F.col("feature").startswith("trip_type_")).select(TRIP_KEY, "feature", round6(F.col("value")).alias("value"))


@registered("column_sets", """
SELECT c AS dropped, CASE WHEN c IN ('tip_amount') THEN '' ELSE c END AS missing, (SELECT count(*) FROM events) AS "rows"
FROM (SELECT unnest(['VendorID', 'lpep_pickup_datetime', 'PULocationID', 'DOLocationID', 'passenger_count', 'trip_type', 'tip_amount']) AS c)""")
def q_column_sets(spark, sf_dir) -> DataFrame:
    """The landed trips without one column at a time: which model inputs are then said to be missing."""
    from tripflow.operators.prepare import require_columns
    from tripflow.schema import MODEL_INPUT_COLUMNS
    from tripflow.sources import adapter

    landed, rows = adapter.landed_trips(spark, sf_dir), []
    for dropped in [*MODEL_INPUT_COLUMNS, "tip_amount"]:
        try:
            require_columns(landed.drop(dropped), MODEL_INPUT_COLUMNS, "missing")
            rows.append((dropped, ""))
        except ValueError as exc:
            rows.append((dropped, ",".join(sorted(c for c in MODEL_INPUT_COLUMNS if repr(c) in str(exc)))))
    said = spark.createDataFrame(rows, "dropped string, missing string")  # a row a column set
    return said.crossJoin(F.broadcast(landed.agg(F.count(F.lit(1)).alias("rows"))))


@registered("file_digest", with_ctes(RAW, SPLIT, body="""
SELECT split, sha256(string_agg(CAST(trip_id AS VARCHAR), chr(10) ORDER BY trip_id) || chr(10)) AS sha256 FROM split_trips GROUP BY split
UNION ALL SELECT 'nowhere', 'unavailable'"""))
def q_file_digest(spark, sf_dir) -> DataFrame:
    """sha-256 of the bytes of one file a split (its trips' ids, a line each), and of a file that is not there."""
    from tripflow.operators.lineage import file_sha256
    from tripflow.sources.adapter import TRIP_KEY

    inp, path = Inputs(spark, sf_dir), _scratch(spark, "digest")
    ids = inp.splitter.assign(inp.raw)
    rows = []
    for split in ("train", "val", "test"):
        # one file is what the operator takes (see file_sha256); splits of any size have content fingerprints
        ids.where(F.col("split") == split).select(TRIP_KEY).repartitionByRange(1, TRIP_KEY).sortWithinPartitions(TRIP_KEY).select(
            F.col(TRIP_KEY).cast("string")).write.text(f"{path}/{split}")
        name = spark.read.text(f"{path}/{split}").select(F.col("_metadata.file_path")).first()[0]
        rows.append((split, file_sha256(spark, name)))
    rows.append(("nowhere", file_sha256(spark, f"{path}/nowhere.txt")))
    return spark.createDataFrame(rows, "split string, sha256 string")


@registered("train_job", with_ctes(*BASE, body="""
SELECT 'rows_' || split AS name, CAST(count(*) AS BIGINT) AS "rows", true AS sound FROM prepared GROUP BY split
UNION ALL SELECT 'residual_histogram', 40, true UNION ALL SELECT 'axis_limits', 1, true
UNION ALL SELECT 'feature_importance', 20, true UNION ALL SELECT 'model_scores', (SELECT count(*) FROM prepared), true"""))
def q_train_job(spark, sf_dir) -> DataFrame:
    """M6: the whole training job on durations that can be learned: metrics record, report tables and the saved model,
    read back; errors must be below those of the train mean, and the loaded model must score every trip."""
    from tripflow.plans.train import load_pipeline, run_training, score
    from tripflow.schema import CHAMPION_PARAMS
    from tripflow.sources.adapter import TRIP_KEY
    from tripflow.sources.tables import read_metrics_json

    inp, path = Inputs(spark, sf_dir), _scratch(spark, "training")
    trips = _with_signal(inp.prepared_split, inp.zones)
    run_training(inp.zones, trips, path, {**CHAMPION_PARAMS, **FEW_TREES})
    metrics = read_metrics_json(spark, f"{path}/metrics.json")
    spread_of = {r["split"]: r["s"] for r in trips.groupBy("split").agg(F.stddev_pop("duration").alias("s")).collect()}  # a row a split
    rows = [(f"rows_{s}", int(metrics[f"rows_{s}"]), bool(0 < metrics[f"mae_{s}"] <= metrics[f"rmse_{s}"] < v)) for s, v in spread_of.items()]
    rows += [(name, spark.read.parquet(f"{path}/{name}").count(), True) for name in ("residual_histogram", "axis_limits", "feature_importance")]
    again = score(load_pipeline(spark, f"{path}/model"), trips, keep=(TRIP_KEY,)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull() | F.isnan("prediction")).alias("bad")).first()
    rows.append(("model_scores", again["n"], again["bad"] == 0))
    return spark.createDataFrame(rows, "name string, rows bigint, sound boolean")


@registered("search_trials", """
SELECT * FROM (VALUES (0, 9, 5, 3, true), (1, 3, 10, 1, true), (2, 1, 20, 1, true)) AS t(rung, trials, n_estimators, survivors, rule)""")
def q_search_trials(spark, sf_dir) -> DataFrame:
    """M7: successive halving of nine trials over the validation split: per rung its trials, trees and survivors, and
    whether the survivors are the trials of least error and the next rung's trials."""
    from pyspark.sql import Window

    from tripflow.plans.train import successive_halving

    inp = Inputs(spark, sf_dir)
    trips = _with_signal(inp.prepared_split, inp.zones)
    t = successive_halving(inp.zones, trips.where("split = 'train'"), trips.where("split = 'val'"), 9, rungs=(5, 10, 20), parallelism=3)
    place = F.row_number().over(Window.partitionBy("rung").orderBy("rmse_val", "trial"))  # a row a fit
    ranked = t.withColumn("place", place).join(
        t.select((F.col("rung") - 1).alias("rung"), "trial", F.lit(True).alias("goes_on")), ["rung", "trial"], "left")
    last = F.col("rung") == 2
    rule = (F.col("survives") == (F.col("place") <= F.when(last, 1).otherwise(F.ceil(F.pow(F.lit(3.0), 1 - F.col("rung")))))) & (
        last | (F.col("survives") == F.coalesce("goes_on", F.lit(False))))
    return ranked.groupBy("rung").agg(F.count(F.lit(1)).cast("int").alias("trials"), F.max("n_estimators").alias("n_estimators"),
                                      F.count_if("survives").cast("int").alias("survivors"), F.every(rule).alias("rule"))


@registered("registry_commits", """
WITH v AS (SELECT event_type AS model, event_id AS version, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS m FROM events),
last AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY version DESC) AS back FROM v),
recent AS (SELECT * FROM last WHERE back <= 5),
folded AS (SELECT *, min(m) OVER (PARTITION BY model ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM recent)
SELECT model, version, 6 - back AS commit, CASE WHEN m IS NOT NULL AND (before IS NULL OR m <= before) THEN 'champion' ELSE 'challenger' END AS decision
FROM folded""")
def q_registry_commits(spark, sf_dir) -> DataFrame:
    """W2 as it is appended: the five newest versions of each model, committed one by one; the decision of each commit."""
    from pyspark.sql import Window

    from tripflow.operators.registry import register_version, registered_versions
    from tripflow.sources import adapter

    newest = adapter.model_versions(spark, sf_dir).withColumn(
        "back", F.row_number().over(Window.partitionBy("model").orderBy(F.desc("version")))).where("back <= 5")
    path = _scratch(spark, "registry")
    for r in newest.orderBy("model", "version").collect():  # five a model: what a training job registers
        register_version(spark, path, r["model"], r["version"], r["rmse_test"])
    return registered_versions(spark, path).select("model", "version", F.col("commit"), "decision")
