"""Requests by JSON type, the registry's commits with two writers, the one-pass sample, successive halving."""

import json
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from tripflow.operators import monitor
from tripflow.operators.monitor import exact_sample, sample_hash
from tripflow.operators.prepare import prepare_training_data
from tripflow.operators.registry import champion_fold, last_commit, register_version, registered_versions
from tripflow.plans.scoring import parse_requests, parse_requests_typed, validate_requests
from tripflow.plans.train import successive_halving
from tripflow.session import scratch_path


def _trip(**over):
    t = {"VendorID": 2, "lpep_pickup_datetime": "2026-01-15 08:30:00", "PULocationID": 74, "DOLocationID": 42, "passenger_count": 1, "trip_type": 1}
    t.update(over)
    return {k: v for k, v in t.items() if v is not ...}


def test_types_of_every_field(spark):
    """What a request model of whole numbers, text and optional numbers accepts, type by type."""
    whole = [(2, 2), (2.0, 2), ("2", 2), ("2.0", 2), (True, 1), (False, 0), (2.5, None), ("true", None), ("", None), (None, None), ([2], None), ({"a": 2}, None), (..., None)]
    real = [(1, 1.0), (1.5, 1.5), ("1.5", 1.5), (True, 1.0), (None, "null"), (..., "null"), ("true", None), ([1], None), ({}, None)]
    text = [("2026-01-15 08:30:00", True), (20260115, None), (True, None), (None, None), (["2026-01-15 08:30:00"], None), (..., None)]
    cases = [("VendorID", v, w) for v, w in whole] + [("DOLocationID", v, w) for v, w in whole] + [("passenger_count", v, w) for v, w in real] + [
        ("lpep_pickup_datetime", v, w) for v, w in text]
    bodies = [json.dumps({"trips": [_trip(), _trip(**{f: v})]}) for f, v, _ in cases]
    df = spark.createDataFrame(list(enumerate(bodies)), "request_id bigint, body string")
    rows = {r.request_id: r for r in validate_requests(parse_requests_typed(df)).collect()}
    for i, (field, value, want) in enumerate(cases):
        r = rows[i]
        assert r.valid == (want is not None), (field, value)
        if want is None:
            assert (r.first_invalid_pos, r.first_invalid_field) == (1, field)
        elif want == "null":
            assert r.trips[1][field] is None
        elif want is not True:
            assert r.trips[1][field] == want, (field, value)


def test_shapes_that_are_no_request(spark):
    bodies = ["", "no json", "[]", "{}", '{"trips":5}', '{"trips":[5]}', '{"trips":[[]]}', '{"trips":null}', '{"trips":[]}', None, '{"trips":[{}]}']
    df = spark.createDataFrame(list(enumerate(bodies)), "request_id bigint, body string")
    rows = {r.request_id: r for r in validate_requests(parse_requests_typed(df)).collect()}
    assert [i for i in rows if rows[i].valid] == [8] and rows[8].n_trips == 0
    assert {i for i in rows if rows[i].first_invalid_field == "trips"} == {0, 1, 2, 3, 4, 5, 6, 7, 9}
    assert rows[10].first_invalid_field == "VendorID"


def test_agrees_with_the_text_route_where_types_do_not_matter(spark):
    bodies = [json.dumps({"trips": [_trip(VendorID=v, passenger_count=p)]}) for v in (1, "7", 3.0, 9007199254740993, "1e3", 2.5, "2d") for p in (1, "2", 2.5, ..., None)]
    df = spark.createDataFrame(list(enumerate(bodies)), "request_id bigint, body string")
    a, b = (sorted(map(str, validate_requests(parse(df)).collect())) for parse in (parse_requests, parse_requests_typed))
    assert a == b


def test_two_writers_agree_on_one_order(spark):
    path = scratch_path(spark, f"test-registry-{uuid.uuid4().hex}")
    metrics = {v: [9.0, 8.0, None, 8.5, 7.0, 7.0, float("nan"), 6.5, 9.5, 6.0][v % 10] for v in range(20)}
    said, failed = {}, []

    def writer(versions):
        try:
            for v in versions:
                said[v] = register_version(spark, path, "m", v, metrics[v])
        except Exception as exc:  # noqa: BLE001
            failed.append(exc)

    threads = [threading.Thread(target=writer, args=(range(k, 20, 2),)) for k in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    commits = registered_versions(spark, path)
    rows = sorted(commits.collect(), key=lambda r: r.commit)
    assert [r.commit for r in rows] == list(range(1, 21)) and {r.version for r in rows} == set(range(20))
    # the fold over the order of commits gives every decision again
    order = commits.select("model", F.col("commit").alias("version"), "rmse_test")
    folded = {r.version: r.decision for r in champion_fold(order).collect()}
    assert {r.commit: r.decision for r in rows} == folded and {r.version: r.decision for r in rows} == said
    assert last_commit(spark, path, "m")["champion_metric"] == 6.0
    assert register_version(spark, path, "m", 1, 0.1) == said[1]  # registered before: nothing new
    assert register_version(spark, path, "other", 1, None) == "challenger" and last_commit(spark, path, "other")["champion_version"] is None


def test_sample_is_one_scan_and_the_least_hashes(spark, monkeypatch):
    monkeypatch.setattr(monitor, "SAMPLE_FAN_IN", 3)
    df = spark.range(5000, numPartitions=20).select(F.col("id"), (F.col("id") % 7).alias("x"))
    got = exact_sample(df, 40, 42, key_cols=["id"])
    want = [r.id for r in df.orderBy(sample_hash(42, ["id"]), "id").limit(40).collect()]
    assert sorted(r.id for r in got.collect()) == sorted(want) and got.columns == df.columns
    assert sorted(r.id for r in exact_sample(df.repartition(5), 40, 42, key_cols=["id"]).collect()) == sorted(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert exact_sample(df.limit(3), 40, 42).count() == 3 and exact_sample(df.limit(0), 40, 42).count() == 0


def test_halving(spark, zones, labelled):
    data = prepare_training_data(labelled)
    t = successive_halving(zones, data, data, 5, rungs=(1, 2), keep_one_in=2, overrides={"max_depth": 2, "min_child_weight": 1})
    rows = t.collect()
    first, second = ([r for r in rows if r.rung == k] for k in (0, 1))
    assert len(first) == 5 and len(second) == 3 and {r.n_estimators for r in second} == {2}
    best = {r.trial for r in sorted(first, key=lambda r: (r.rmse_val, r.trial))[:3]}
    assert {r.trial for r in first if r.survives} == best == {r.trial for r in second} and sum(r.survives for r in second) == 2
    again = successive_halving(zones, data, data, 5, rungs=(1, 2), keep_one_in=2, overrides={"max_depth": 2, "min_child_weight": 1})
    assert {(r.rung, r.trial): r.rmse_val for r in again.collect()} == pytest.approx({(r.rung, r.trial): r.rmse_val for r in rows})
