"""Queries held against brute force or their oracle with a short training run."""

import hashlib

import duckdb

import __spark_entry__ as entry
from tripflow.schema import CHAMPION_PARAMS, RANDOM_SEED

SF = "/root/testdata/sf0.01"


def _row_hash(trip_id: int, seed: int) -> int:
    """60 bits of md5 over seed and key, as text."""
    return int(hashlib.md5(f"{seed}|{trip_id}".encode()).hexdigest()[:15], 16)


def test_exact_sample_equals_brute_force(spark):
    con = duckdb.connect()
    for t in ("events", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    ids = [r[0] for r in con.execute(entry.oracle_sql()["monitoring_frame"]).fetchall()]  # test-split trips (oracle)
    expected = {i for _, i in sorted((_row_hash(i, RANDOM_SEED), i) for i in ids)[:500]}
    got = {r.trip_id for r in entry.queries()["exact_sample"](spark, SF).collect()}
    assert len(ids) > 500 and got == expected


def test_gbt_queries_equal_their_oracle(spark, monkeypatch):
    """The registered queries train all of the champion's trees; what they report about a learner holds for 20 too."""
    import tripflow.queries as q
    from tripflow.plans.train import fit_pipeline

    assert CHAMPION_PARAMS["n_estimators"] == 550
    monkeypatch.setattr(q, "_fitted_pipeline", lambda inp: fit_pipeline(
        inp.zones, inp.prepared("train"), {"n_estimators": 20, "max_depth": 4, "learning_rate": 0.2}))
    con = duckdb.connect()
    for t in ("events", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, key in (("gbt_scoring", "trip_id"), ("feature_importance", "rank")):
        want = con.execute(entry.oracle_sql()[name]).df().sort_values(key)
        got = q.QUERIES[name](spark, SF).toPandas().sort_values(key)
        assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
        for c in want.columns:
            assert got[c].tolist() == want[c].tolist(), c
