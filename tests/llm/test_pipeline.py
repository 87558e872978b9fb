"""The pipeline, stage by stage, and the registered queries against their SQL."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tripflow.llm.common import materialise
from tripflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    norm = lambda df: sorted((tuple(None if pd.isna(v) else round(v, 6) if isinstance(v, float) else v for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)
    assert norm(got) == norm(want)


@pytest.fixture(scope="module")
def stages(spark):
    out = {"documents": spark.read.parquet(f"{SF}/documents.parquet")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialise(stage(spark, docs, SF), name)
    return out


def test_stages_keep_the_columns(stages):
    for name, df in list(stages.items())[:-1]:
        assert df.columns == COLUMNS, name
        assert df.where("n_chars <> length(text)").count() == 0


def test_decisions_take_effect(stages):
    n = {k: df.count() for k, df in stages.items()}
    assert 0.95 * n["documents"] < n["language_id"] <= n["documents"]
    assert 0.8 * n["language_id"] < n["near_duplicates"] < n["language_id"]
    assert stages["near_duplicates"].select("doc_id").distinct().count() == n["near_duplicates"]
    assert n["personal_data"] == n["near_duplicates"] <= n["mixing"]
    assert stages["personal_data"].where("text like '%[EMAIL]%'").count() > 0
    assert stages["personal_data"].where(r"text rlike '[a-z]@[a-z]+\\.[a-z]'").count() == 0
    assert stages["mixing"].select("doc_id").distinct().count() == n["personal_data"]
    assert stages["packing"].where("piece = 0").count() == n["mixing"]
    full = stages["packing"].groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert full.max() <= 2048 and len(full) <= 1.02 * full.sum() / 2048 + 1


def test_near_copies_are_left_once(stages):
    from tests.llm.test_neardup import classes

    docs = {r.doc_id: r.text for r in stages["language_id"].collect()}
    kept = {r.doc_id for r in stages["near_duplicates"].collect()}
    assert kept == set(classes(docs).values())


def test_run_and_empty_table(spark, stages, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() == stages["packing"].count()
    stages["documents"].where("1 = 0").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_pass(spark):
    rows = [(1, None, None, None, None), (None, "the and of this", "en", None, 15), (2, "", "en", "s", 0), (3, "the of and that is", None, "s", 18), (3, "the of and that is", None, "s", 18)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, piece int, tokens string")
    labelled = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text", "lang", "source", "n_chars", "1 as piece", "'x' as tokens")
    out = docs.unionByName(labelled)
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, out, SF), name)
    got = {r.doc_id for r in out.where("doc_id is null or doc_id < 100").collect()}
    assert got == {None, 3}
