import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import ordered
from tripflow.operators.registry import best_trial, champion_fold, current_aliases
from tripflow.operators.servelog import exact_percentiles, latency_profile, tile_array


def test_champion_fold_fixture(spark):
    """F-H."""
    rows = [("m", 1, 9.5), ("m", 2, None), ("m", 3, 9.1), ("m", 4, 9.3), ("m", 5, 9.1)]
    v = spark.createDataFrame(rows, "model string, version int, rmse_test double")
    d = {r.version: r.decision for r in champion_fold(v).collect()}
    assert d == {1: "champion", 2: "challenger", 3: "champion", 4: "challenger", 5: "champion"}
    a = current_aliases(champion_fold(v)).first()
    assert (a.champion_version, a.challenger_version) == (5, 4)


def test_champion_fold_hot_model_many_blocks(spark):
    import random

    rng = random.Random(3)
    rows = [("hot", i, None if i % 11 == 0 else rng.uniform(5, 15)) for i in range(600)] + [("cold", 1, 3.0)]
    v = spark.createDataFrame(rows, "model string, version int, rmse_test double")
    old = ordered.BLOCK_ROWS
    ordered.BLOCK_ROWS = 37
    try:
        got = {(r.model, r.version): r.decision for r in champion_fold(v).collect()}
    finally:
        ordered.BLOCK_ROWS = old
    champ = None
    for m, ver, r in rows[:600]:  # sequential reference fold
        if r is None:
            exp = "challenger"
        elif champ is None or r <= champ:
            exp, champ = "champion", r
        else:
            exp = "challenger"
        assert got[(m, ver)] == exp
    assert got[("cold", 1)] == "champion"


def test_best_trial_ties_take_lowest_trial(spark):
    rows = [(0, 1, 8.5, 5, 3), (0, 2, 8.4, 6, 4), (0, 3, 8.4, 7, 5), (0, 4, None, 8, 6)]
    t = spark.createDataFrame(rows, "study int, trial int, rmse_val double, max_depth int, min_child_weight int")
    b = best_trial(t).first()
    assert (b.best_trial, b.best_rmse_val, b.max_depth, b.n_trials) == (2, 8.4, 6, 3)


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = {k: rng.exponential(0.05, size=n).round(5) for k, n in (("a", 1), ("b", 2), ("c", 333))}
    rows = [(k, float(x)) for k, xs in vals.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, v double")
    old = ordered.BLOCK_ROWS
    ordered.BLOCK_ROWS = 40
    try:
        got = {r.g: r for r in exact_percentiles(df, ["g"], "v").collect()}
    finally:
        ordered.BLOCK_ROWS = old
    for k, xs in vals.items():
        for name, p in (("p50", 50), ("p95", 95), ("p99", 99)):
            assert got[k][name] == pytest.approx(float(np.percentile(xs, p)), rel=1e-12, abs=1e-15)


def test_latency_profile(spark):
    t0 = dt.datetime(2026, 1, 1)
    rows = [(1, 1, 200 if i % 4 else 500, t0 + dt.timedelta(seconds=i), t0 + dt.timedelta(seconds=i + 0.5), 0.5)
            for i in range(8)]
    log = spark.createDataFrame(rows, "batch_size int, concurrency int, status int, started_at timestamp_ntz, "
                                      "ended_at timestamp_ntz, latency_s double")
    r = latency_profile(log).first()
    assert r.request_count == 8 and r.success_rate == 0.75
    assert r.requests_per_second == pytest.approx(8 / 7.5)
    assert r.latency_ms_p50 == pytest.approx(500.0)


def test_tile_array(spark):
    """Samples repeated cyclically."""
    r = spark.range(1).select(tile_array(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 7).alias("t")).first()
    assert r.t == ["a", "b", "c", "a", "b", "c", "a"]


def test_register_version_appends_and_promotes(spark):
    import uuid

    from tripflow.operators.registry import register_version
    from tripflow.session import scratch_path

    path = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    got = [register_version(spark, path, "m", v, r) for v, r in [(1, 9.5), (2, None), (3, 9.1), (4, 9.3), (5, 9.1)]]
    assert got == ["champion", "challenger", "champion", "challenger", "champion"]
    assert register_version(spark, path, "other", 1, 20.0) == "champion"  # models are folded separately


def test_nan_metric_is_no_metric(spark):
    from tripflow.operators.registry import champion_fold

    nan = float("nan")
    rows = spark.createDataFrame([("m", 1, nan), ("m", 2, 5.0), ("m", 3, nan), ("m", 4, 6.0), ("m", 5, 5.0)], "model string, version bigint, rmse_test double")
    got = {r.version: r.decision for r in champion_fold(rows).collect()}
    assert got == {1: "challenger", 2: "champion", 3: "challenger", 4: "challenger", 5: "champion"}
