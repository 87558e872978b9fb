"""Property tests (hypothesis): split = positional split, ordered scan = sequential scan, drift(x, x) = 0."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.operators import ordered
from tripflow.operators.monitor import categorical_drift, numeric_drift
from tripflow.operators.ordered import Running, ordered_scan
from tripflow.operators.split import ChronologicalSplit

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.datetime(2026, 1, 1)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 40)), min_size=1, max_size=60))
def test_split_equals_positional(spark, minutes):
    times = [None if m is None else BASE + dt.timedelta(minutes=m) for m in minutes]
    keys = [(i * 7919) % 1009 for i in range(len(times))]
    df = spark.createDataFrame(list(zip(keys, times)), "trip_id bigint, lpep_pickup_datetime timestamp_ntz")
    got = {r.trip_id: r.split for r in ChronologicalSplit(buckets=3, exact_rows=2).fit(df).assign(df).collect()}
    order = sorted(zip(times, keys), key=lambda p: (p[0] is None, p[0] or BASE, p[1]))
    n = len(order)
    exp = {k: ("train" if i < n * 6 // 10 else "val" if i < n * 8 // 10 else "test") for i, (_, k) in enumerate(order)}
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-50, 50)), min_size=1, max_size=80,
                unique_by=lambda t: (t[0], t[1])), st.integers(1, 9))
def test_ordered_scan_equals_sequential(spark, rows, block):
    df = spark.createDataFrame([(g, o, float(o % 7)) for g, o in rows], "g string, o int, v double")
    old = ordered.BLOCK_ROWS
    ordered.BLOCK_ROWS = block
    try:
        out = ordered_scan(df, ["g"], "o", [Running("s", F.col("v")), Running("m", F.col("v"), "min", False)],
                           next_col="nx").collect()
    finally:
        ordered.BLOCK_ROWS = old
    got = {(r.g, r.o): (r.s, r.m, r.nx) for r in out}
    for g in {g for g, _ in rows}:
        seq = sorted(o for gg, o in rows if gg == g)
        run, mn = 0.0, None
        for i, o in enumerate(seq):
            v = float(o % 7)
            run += v
            nxt = seq[i + 1] if i + 1 < len(seq) else None
            assert got[(g, o)] == (run, mn, nxt)
            mn = v if mn is None else min(mn, v)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "__MISSING__"]), st.one_of(st.none(), st.floats(0, 9))),
                min_size=1, max_size=40))
def test_self_drift_is_zero(spark, rows):
    df = spark.createDataFrame(rows, "VendorID string, passenger_count double")
    assert all(r.drift_score == 0.0 for r in categorical_drift(df, df, ["VendorID"]).collect())
    assert all(r.drift_score == 0.0 for r in numeric_drift(df, df, ["passenger_count"]).collect())


def _strptime_ok(text: str) -> bool:
    import datetime as _dt

    try:
        _dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        return True
    except ValueError:
        return False


def _field(lo: int, hi: int):
    return st.tuples(st.integers(lo, hi), st.booleans()).map(lambda t: f"{t[0]:02d}" if t[1] else str(t[0]))


DATETIME_TEXT = st.tuples(
    st.integers(1000, 9999).map(str), _field(0, 13), _field(0, 32), _field(0, 25), _field(0, 61), _field(0, 61),
    st.sampled_from(["-", "/"]), st.sampled_from([" ", "T"]),
).map(lambda t: f"{t[0]}{t[6]}{t[1]}{t[6]}{t[2]}{t[7]}{t[3]}:{t[4]}:{t[5]}")


@settings(max_examples=1, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture,
                                                            HealthCheck.large_base_example, HealthCheck.too_slow])
@given(st.lists(DATETIME_TEXT, min_size=200, max_size=200))
def test_pickup_validation_equals_strptime(spark, texts):
    """A pickup is valid exactly when Python's strptime accepts it with the contract format."""
    from tripflow.plans.scoring import _pickup

    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = {r.s: r.ok for r in df.select("s", _pickup(F.col("s")).isNotNull().alias("ok")).collect()}
    assert got == {t: _strptime_ok(t) for t in texts}
