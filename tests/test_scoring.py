import json
import uuid

import pytest

from tripflow.plans.scorers import ConstantScorer
from tripflow.plans.scoring import parse_requests, score_requests, validate_requests

META = {"model_name": "trip_duration_model", "model_version": 7, "model_alias": "champion"}


def _trip(**over):
    t = {"VendorID": 2, "lpep_pickup_datetime": "2026-01-15 08:30:00", "PULocationID": 74, "DOLocationID": 42,
         "passenger_count": 1, "trip_type": 1}
    t.update(over)
    return {k: v for k, v in t.items() if v is not ...}


def _bodies(spark, reqs):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(reqs)], "request_id bigint, body string")


def test_validation_cases(spark):
    reqs = [
        {"trips": [_trip()]},                                                   # 0 valid
        {"trips": [_trip(passenger_count=..., trip_type=...)]},                 # 1 optional fields absent
        {"trips": [_trip(), _trip(lpep_pickup_datetime="15/01/2026")]},        # 2 bad datetime rejects all
        {"trips": [_trip(VendorID="2", PULocationID=74.0)]},                   # 3 lax ints accepted
        {"trips": [_trip(VendorID=2.5)]},                                       # 4 fractional id
        {"trips": [_trip(lpep_pickup_datetime="2026-1-5 8:3:0")]},             # 5 unpadded accepted
        {"trips": [_trip(lpep_pickup_datetime="2026-02-30 10:00:00")]},        # 6 not a calendar date
        {"trips": [_trip(passenger_count="many")]},                             # 7 optional but not numeric
        {"trips": []},                                                          # 8 empty request
        {"nothing": 1},                                                         # 9 no trips
        {"trips": [_trip(DOLocationID=None)]},                                  # 10 required id null
    ]
    v = {r.request_id: r for r in validate_requests(parse_requests(_bodies(spark, reqs))).collect()}
    assert [v[i].valid for i in range(11)] == [True, True, False, True, False, True, False, False, True, False, False]
    assert (v[2].first_invalid_pos, v[2].first_invalid_field) == (1, "lpep_pickup_datetime")
    assert v[4].first_invalid_field == "VendorID" and v[7].first_invalid_field == "passenger_count"
    assert v[9].first_invalid_field == "trips" and v[10].first_invalid_field == "DOLocationID"


def test_scoring_keeps_order_and_metadata(spark):
    reqs = [{"trips": [_trip(), _trip(), _trip()]}, {"trips": []}, {"trips": [_trip(VendorID="x")]}]
    out = {r.request_id: r for r in
           score_requests(validate_requests(parse_requests(_bodies(spark, reqs))), ConstantScorer(12.34), META).collect()}
    assert out[0].status == 200 and out[0].predictions == [12.34, 12.34, 12.34] and out[0].model_version == 7
    assert out[1].status == 200 and out[1].predictions == []
    assert out[2].status == 422 and out[2].predictions is None


def test_order_follows_positions(spark, zones):
    from tripflow.plans.scorers import DistanceFormulaScorer

    reqs = [{"trips": [_trip(PULocationID=1, DOLocationID=2), _trip(PULocationID=1, DOLocationID=1),
                       _trip(PULocationID=1, DOLocationID=3)]}]
    r = score_requests(validate_requests(parse_requests(_bodies(spark, reqs))), DistanceFormulaScorer(zones), META).first()
    p = r.predictions
    assert p[1] == 10.0 and p[0] > 10.0 and p[2] > 10.0 and p[0] != p[2]


def test_stream_equals_batch(spark, zones):
    from tripflow.plans.scorers import DistanceFormulaScorer
    from tripflow.session import scratch_path
    from tripflow.streaming.scoring import run_available

    reqs = [{"trips": [_trip(PULocationID=i % 3 + 1, DOLocationID=(i * 2) % 3 + 1) for _ in range(i % 4)]}
            for i in range(20)] + [{"trips": [_trip(lpep_pickup_datetime="bad")]}]
    base = scratch_path(spark, f"test-stream-{uuid.uuid4().hex}")
    lines = [json.dumps({"request_id": i, **r}) for i, r in enumerate(reqs)]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(f"{base}/src")
    scorer = DistanceFormulaScorer(zones)
    run_available(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", scorer)
    streamed = {(r.request_id, r.pos): r.prediction for r in spark.read.parquet(f"{base}/sink/scored").collect()}
    batch = score_requests(validate_requests(parse_requests(_bodies(spark, reqs))), scorer, META)
    expected = {(r.request_id, i): p for r in batch.collect() if r.status == 200 for i, p in enumerate(r.predictions)}
    assert streamed == pytest.approx(expected)
    rejected = spark.read.parquet(f"{base}/sink/rejected").collect()
    assert [r.request_id for r in rejected] == [20]


def test_numbers_in_requests_are_exact_and_plain(spark):
    from tripflow.plans.scoring import parse_requests, validate_requests

    def body(vendor):
        return f'{{"trips":[{{"VendorID":{vendor},"lpep_pickup_datetime":"2026-02-01 08:00:00","PULocationID":1,"DOLocationID":2}}]}}'

    cases = {'"2d"': None, '"2f"': None, "9007199254740993": 9007199254740993, '"2.0"': 2, "2.5": None, '" 7 "': 7, '"0x10"': None,
             "1e3": 1000, "true": None, '"9223372036854775808"': None}
    df = spark.createDataFrame([(i, body(v)) for i, v in enumerate(cases)], "request_id bigint, body string")
    rows = {r.request_id: r for r in validate_requests(parse_requests(df)).collect()}
    for i, (text, want) in enumerate(cases.items()):
        assert rows[i].valid == (want is not None), text
        assert want is None or rows[i].trips[0].VendorID == want, text
