"""Trees by bit vectors against the learner's own transform; the pipeline as one saved artefact."""

import json
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tripflow.operators.prepare import prepare_training_data
from tripflow.plans import ensemble
from tripflow.plans.ensemble import Ensemble, EnsembleScorer, importance_from_nodes, tree_nodes
from tripflow.plans.scoring import parse_requests, score_requests, validate_requests
from tripflow.plans.train import PipelineScorer, build_pipeline, save_pipeline, score

META = {"model_name": "m", "model_version": 1, "model_alias": "champion"}
FAST = {"n_estimators": 5, "max_depth": 3, "min_child_weight": 1, "subsample": 1.0, "colsample_bytree": 1.0, "gamma": 0.0}


@pytest.mark.parametrize("depth,trees", [(1, 2), (4, 7), (8, 5)])
def test_equal_to_the_learner(spark, depth, trees, monkeypatch):
    rng = random.Random(depth)
    rows = [[rng.random(), rng.choice([0.0, 1.0]), rng.gauss(0, 3), float(rng.randint(0, 4))] for _ in range(700)]
    df = spark.createDataFrame([(Vectors.dense(r), r[0] * 5 + r[1] * r[2] + r[3]) for r in rows], ["features", "label"])
    model = GBTRegressor(maxIter=trees, maxDepth=depth, seed=1).fit(df)
    tests = rows + [[float("inf"), -1.0, float("-inf"), 9.0]]
    want = [r.prediction for r in model.transform(spark.createDataFrame([(Vectors.dense(r),) for r in tests], ["features"])).collect()]
    fast = Ensemble.of(model)
    for chunk in (64, 1 << 14):
        monkeypatch.setattr(ensemble, "CHUNK", chunk)
        assert np.allclose(fast.predict(np.array(tests).T), want, rtol=0, atol=1e-9)
    assert fast.predict(np.zeros((4, 0))).shape == (0,)


def test_importance_from_nodes(spark):
    rng = random.Random(3)
    rows = [[rng.random() for _ in range(5)] for _ in range(400)]
    df = spark.createDataFrame([(Vectors.dense(r), r[0] * 5 + r[3] * r[2]) for r in rows], ["features", "label"])
    model = GBTRegressor(maxIter=6, maxDepth=4, seed=2).fit(df)
    got = {r.feature: r.importance for r in importance_from_nodes(tree_nodes(model), list("abcde")).collect()}
    want = {n: v for n, v in zip("abcde", model.featureImportances.toArray()) if v}
    assert got == pytest.approx(want, abs=1e-9)


def _trip(k, **over):
    return {"VendorID": 1 + k % 2, "lpep_pickup_datetime": "2026-02-03 10:00:00", "PULocationID": 1 + k % 3, "DOLocationID": 1 + (k * 2) % 4, "passenger_count": k % 3, **over}


def test_scorer_keeps_columns_and_requests_need_no_shuffle(spark, zones, labelled, monkeypatch):
    data = prepare_training_data(labelled)
    model = build_pipeline(zones, FAST).fit(data)
    fast = EnsembleScorer(model)
    raw = data.withColumn("month", F.lit("x")).withColumn("prediction", F.lit(-1.0))
    got = fast.transform(raw)
    assert got.columns == raw.columns
    want = {tuple(r)[:4]: r.prediction for r in score(model, data, keep=tuple(data.columns)).collect()}
    assert {tuple(r)[:4]: r.prediction for r in got.collect()} == pytest.approx(want, abs=1e-9)
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().toString()

    reqs = [[_trip(k) for k in range(n)] for n in (3, 0, 25, 1)] + [[_trip(0), _trip(1, VendorID="x")], [_trip(5)] * 4]
    bodies = spark.createDataFrame([(i, json.dumps({"trips": r})) for i, r in enumerate(reqs)], "request_id bigint, body string")
    valid = validate_requests(parse_requests(bodies)).repartition(3).checkpoint()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # requests go over batches
    try:
        answers = fast.score_requests(valid, META)
        rows = {r.request_id: r for r in answers.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = answers._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    for r in score_requests(valid, PipelineScorer(model), META).collect():
        assert (rows[r.request_id].status, rows[r.request_id].model_alias) == (r.status, r.model_alias)
        assert rows[r.request_id].predictions == (None if r.predictions is None else pytest.approx(r.predictions, abs=1e-9))
    # lookups too large to broadcast: the same answers by the regrouping shuffle
    monkeypatch.setattr(EnsembleScorer, "lookups_are_broadcast", lambda self: False)
    again = {r.request_id: r.predictions for r in fast.score_requests(valid, META).collect()}
    assert {k: r.predictions and pytest.approx(r.predictions) for k, r in rows.items()} == again


def test_pipeline_is_one_artefact(spark, zones, labelled):
    from tripflow.session import scratch_path

    data = prepare_training_data(labelled)
    model = build_pipeline(zones, FAST).fit(data)
    path = scratch_path(spark, "test-artefact")
    save_pipeline(model, path)
    save_pipeline(model, path)  # replaces
    other = PipelineModel.load(path)
    assert [s.uid for s in other.stages] == [s.uid for s in model.stages]
    keep = ("lpep_pickup_datetime",)
    want = sorted(map(tuple, score(model, data, keep=keep).collect()))
    assert sorted(map(tuple, score(other, data, keep=keep).collect())) == want
    # plain Spark ML: the stages' own transform
    loaded = PipelineModel.load(path)
    assert loaded.stages[0].getFeatureNamesOut() == model.stages[0].getFeatureNamesOut()
    assert sorted(r.prediction for r in loaded.transform(data).collect()) == pytest.approx(sorted(p for _, p in want))


def test_too_deep_trees_are_refused(spark):
    with pytest.raises(ValueError, match="deeper"):
        rng = random.Random(1)
        df = spark.createDataFrame([(Vectors.dense([float(i)]), rng.random()) for i in range(400)], ["features", "label"])
        ensemble_depth, ensemble.DEEPEST = ensemble.DEEPEST, 1
        try:
            Ensemble.of(GBTRegressor(maxIter=1, maxDepth=4, seed=1).fit(df))
        finally:
            ensemble.DEEPEST = ensemble_depth
