import pytest
from pyspark.sql import functions as F

from tripflow.operators.evaluate import axis_limits, residual_histogram, segment_metrics
from tripflow.operators.prepare import prepare_training_data
from tripflow.operators.registry import best_trial
from tripflow.plans.train import (
    PipelineScorer,
    build_pipeline,
    feature_importance,
    random_search,
    score,
    train_and_evaluate,
)

FAST = {"n_estimators": 3, "max_depth": 3, "min_child_weight": 1, "subsample": 1.0, "colsample_bytree": 1.0,
        "gamma": 0.0}


def test_end_to_end_smoke(spark, zones, labelled):
    """prepare -> fit -> predict -> importance -> segments, on six rows."""
    train = prepare_training_data(labelled)
    splits = train.withColumn("split", F.lit("test"))
    model, metrics, scored = train_and_evaluate(zones, train, splits, FAST)
    m = metrics.first()
    assert m.rows == 6 and m.rmse >= 0 and m.mae >= 0
    fi = feature_importance(model).collect()
    assert 0 < len(fi) <= 20 and fi[0].rank == 1
    assert abs(sum(r.importance for r in fi) - 1.0) < 1e-9 or len(fi) == 20
    seg = segment_metrics(scored, zones, minimum_rows=1).collect()
    assert {r.segment_name for r in seg} == {"pickup_hour", "PU_Borough", "trip_type"}
    hist = residual_histogram(scored).collect()
    assert len(hist) == 40 and sum(r["count"] for r in hist) == 6
    lim = axis_limits(scored).first()
    assert lim.axis_min <= lim.axis_max


def test_pipeline_scores_raw_serving_rows(spark, zones, labelled):
    model = build_pipeline(zones, FAST).fit(prepare_training_data(labelled))
    rows = spark.createDataFrame([(9, "2026-02-04 08:00:00", 1, 3)],
                                 "VendorID bigint, lpep_pickup_datetime string, PULocationID bigint, DOLocationID bigint")
    out = score(model, rows).collect()
    assert len(out) == 1 and out[0].prediction > 0
    scored = PipelineScorer(model).transform(rows.withColumn("request_id", F.lit(5)))
    assert scored.first().request_id == 5


def test_random_search_selects_on_validation(spark, zones, labelled):
    data = prepare_training_data(labelled)
    trials = random_search(zones, data, data, n_trials=2, overrides={"n_estimators": 2, "max_depth": 2})
    assert trials.count() == 2
    b = best_trial(trials, params=("max_depth", "min_child_weight")).first()
    assert b.best_rmse_val == min(r.rmse_val for r in trials.collect())


def test_winner_keeps_all_parameters_and_retrains(spark, zones, labelled):
    from tripflow.plans.train import fit_pipeline
    from tripflow.schema import SEARCH_SPACE

    data = prepare_training_data(labelled).persist()
    trials = random_search(zones, data, data, n_trials=2, overrides={"n_estimators": 2, "max_depth": 2, "min_child_weight": 1})
    best = best_trial(trials, params=tuple(SEARCH_SPACE)).first().asDict()
    params = {k: best[k] for k in SEARCH_SPACE}
    again = score(fit_pipeline(zones, data, params), data, keep=("duration",))
    rmse = again.agg(F.sqrt(F.avg((F.col("duration") - F.col("prediction")) ** 2))).first()[0]
    assert rmse == pytest.approx(best["best_rmse_val"], rel=1e-9)
    data.unpersist()


def test_a_fit_leaves_the_callers_cache_alone(spark, zones, labelled):
    from pyspark import StorageLevel

    from tripflow.plans.train import fit_pipeline

    data = prepare_training_data(labelled).coalesce(1).persist()
    fit_pipeline(zones, data, FAST)
    assert data.storageLevel != StorageLevel.NONE
    data.unpersist()


def test_too_deep_trees_are_refused():
    from tripflow.plans.train import gbt_from_params

    with pytest.raises(ValueError, match="at most 30"):
        gbt_from_params({"max_depth": 31})
    assert gbt_from_params({}, max_bins=64).getMaxBins() == 64


def test_repeatable_fit(spark, zones, labelled):
    data = prepare_training_data(labelled)
    a = score(build_pipeline(zones, FAST).fit(data), data).agg(F.sum("prediction")).first()[0]
    b = score(build_pipeline(zones, FAST).fit(data), data).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(b)


def test_request_scoring_with_the_fitted_pipeline(spark, zones, labelled):
    """M9 with the real model: empty requests answer [], predictions keep trip order."""
    import json

    from tripflow.plans.scoring import parse_requests, score_requests, validate_requests

    model = build_pipeline(zones, FAST).fit(prepare_training_data(labelled))
    trip = {"VendorID": 2, "lpep_pickup_datetime": "2026-02-04 08:00:00", "PULocationID": 1, "DOLocationID": 3}
    reqs = [{"trips": [trip, {**trip, "PULocationID": 2}]}, {"trips": []}, {"trips": [{**trip, "VendorID": "x"}]}]
    bodies = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(reqs)], "request_id bigint, body string")
    out = {r.request_id: r for r in score_requests(validate_requests(parse_requests(bodies)), PipelineScorer(model),
                                                   {"model_name": "m", "model_version": 1, "model_alias": "a"}).collect()}
    direct = score(model, spark.createDataFrame([(2, "2026-02-04 08:00:00", p, 3) for p in (1, 2)],
                                                "VendorID bigint, lpep_pickup_datetime string, PULocationID bigint, "
                                                "DOLocationID bigint")).collect()
    assert out[0].predictions == pytest.approx([r.prediction for r in direct])
    assert out[1].status == 200 and out[1].predictions == []
    assert out[2].status == 422


def test_spread_bounds_the_rows_of_a_task(spark, monkeypatch):
    """As many partitions as cores pass, but not with all rows in one of them, nor with more rows than a task takes."""
    from tripflow.plans import train

    monkeypatch.setattr(train, "TASK_ROWS", 50)
    monkeypatch.setattr(train, "MOST_ROWS", 200)
    cores = spark.sparkContext.defaultParallelism
    sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    rows = spark.range(0, 5000, 1, 4 * cores)
    uneven = rows.where("id < 1200")  # the last partitions are empty
    one = spark.range(0, 5000, 1, cores).where("id >= 0")
    for df in (uneven, one, spark.range(0, 5000, 1, 1)):
        got = train.spread(df)
        assert max(sizes(got)) <= 400 and sorted(r.id for r in got.collect()) == sorted(r.id for r in df.collect())
    assert train.spread(rows) is rows  # even and small: no shuffle
    assert train.spread(spark.range(0, 60, 1, 1)).rdd.getNumPartitions() == 2
    assert train.spread(spark.range(0).repartition(1)).count() == 0
