"""Requests put together from single trips: order, repetition, lateness, restart."""

import datetime as dt
import json
import uuid

import pytest

from tripflow.plans.scorers import DistanceFormulaScorer
from tripflow.plans.scoring import parse_requests, score_requests, validate_requests
from tripflow.session import scratch_path
from tripflow.streaming.answers import run_answers

META = {"model_name": "m", "model_version": 3, "model_alias": "champion"}
START = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)


def trip(k, **over):
    return {"VendorID": 1 + k % 2, "lpep_pickup_datetime": "2026-03-02 10:00:00", "PULocationID": 1 + k % 3, "DOLocationID": 1 + (k * 2) % 3, **over}


def line(request, pos, n, minute=0.0, body=None):
    sent = (START + dt.timedelta(minutes=minute)).isoformat()
    return json.dumps({"request_id": request, "pos": pos, "n_trips": n, "sent_at": sent, "trip": body and json.dumps(body)})


class Run:
    def __init__(self, spark, zones):
        self.spark, self.scorer = spark, DistanceFormulaScorer(zones)
        self.base = scratch_path(spark, f"test-answers-{uuid.uuid4().hex}")

    def feed(self, lines):
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{self.base}/in")
        run_answers(self.spark, f"{self.base}/in", f"{self.base}/out", f"{self.base}/ckpt", self.scorer, META,
                    patience=dt.timedelta(minutes=5), delay="2 minutes", max_files_per_trigger=1)

    def answers(self):
        rows = self.spark.read.parquet(f"{self.base}/out").collect()
        assert len({r.request_id for r in rows}) == len(rows)  # each request is answered once
        return {r.request_id: r for r in rows}


def test_restart_order_and_repetition(spark, zones):
    run = Run(spark, zones)
    trips = [trip(k) for k in range(4)]
    run.feed([line(1, 3, 4, 0, trips[3]), line(1, 0, 4, 0.1, trips[0]), line(2, 0, 1, 0, trip(1, lpep_pickup_datetime="bad")), line(3, None, 0)])
    assert set(run.answers()) == {2, 3}
    # the stream was stopped in between: what is half there is in the checkpoint
    run.feed([line(1, 1, 4, 0.5, trips[1]), line(1, 0, 4, 0.5, trip(9)), line(2, 0, 1, 0.5, trip(1)), line(1, 2, 4, 0.6, trips[2]), "no json", "{}"])
    got = run.answers()
    body = spark.createDataFrame([(1, json.dumps({"trips": trips}))], "request_id bigint, body string")
    want = score_requests(validate_requests(parse_requests(body)), run.scorer, META).first()
    assert got[1].predictions == pytest.approx(want.predictions) and got[1].status == 200 and got[1].model_version == 3
    assert got[2].status == 422 and got[2].predictions is None  # one bad trip rejects its request; the repeat changes nothing
    assert got[3].status == 200 and got[3].predictions == []


def test_incomplete_malformed_and_late(spark, zones):
    run = Run(spark, zones)
    run.feed([line(1, 0, 2, 0, trip(1)), line(2, 5, 2, 0, trip(1)), line(3, 0, 2, 0, trip(1)), line(3, 1, 3, 0, trip(1))])
    assert {k: r.status for k, r in run.answers().items()} == {2: 422, 3: 422}
    run.feed([line(9, 0, 1, 20, trip(1))])  # the watermark moves to minute 18
    run.feed([line(8, 0, 1, 21, trip(1)), line(1, 1, 2, 0.2, trip(2))])  # far too late for request 1
    got = {k: (r.status, r.predictions is None) for k, r in run.answers().items()}
    assert got == {1: (408, True), 2: (422, True), 3: (422, True), 8: (200, False), 9: (200, False)}


def test_a_batch_is_read_once(spark, zones):
    """A second look at a batch of the stream would run its stateful step again."""
    from tripflow.streaming.answers import answer

    batch = spark.range(3).selectExpr("id AS request_id", "element_at(array('complete', 'malformed', 'incomplete'), CAST(id + 1 AS INT)) AS state",
                                      "0 AS n_received", "IF(id = 0, '{\"trips\":[]}', NULL) AS body")
    got = answer(batch, DistanceFormulaScorer(zones), META)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert {r.request_id: (r.status, r.predictions) for r in got.collect()} == {0: (200, []), 1: (422, None), 2: (408, None)}
    assert got.columns == ["request_id", "status", "predictions", "model_name", "model_version", "model_alias"]


def test_trips_wait_over_several_batches(spark, zones):
    run = Run(spark, zones)
    trips = [trip(k) for k in range(3)]
    run.feed([line(1, 0, 3, 0, trips[0]), line(2, 0, 2, 0, trip(1)), line(3, 1, 2, 0), line(4, 0, 1, 0, trip(1))])
    run.feed([line(1, 2, 3, 0.1, trips[2]), line(1, 2, 3, 0.1, trip(7)), line(2, 1, 3, 0.1, trip(2)), line(1, 0, 3, 0.1, trip(8))])
    assert {k: r.status for k, r in run.answers().items()} == {2: 422, 4: 200}  # another n_trips than the first one
    run.feed([line(1, 1, 3, 0.2, trips[1]), line(3, 0, 2, 0.2, trip(1))])
    got = run.answers()
    first = json.dumps(min([trips[2], trip(7)], key=json.dumps))  # within a batch the smallest text
    body = '{"trips":[' + ",".join([json.dumps(trips[0]), json.dumps(trips[1]), first]) + "]}"
    want = score_requests(validate_requests(parse_requests(spark.createDataFrame([(1, body)], "request_id bigint, body string"))), run.scorer, META).first()
    assert got[1].predictions == pytest.approx(want.predictions) and got[1].status == 200
    assert got[3].status == 422  # a trip that is null
