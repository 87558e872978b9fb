import pytest
from pyspark.sql import functions as F

from tripflow.operators.lineage import (
    lineage_checks,
    monitoring_summary,
    split_fingerprints,
    training_lineage,
    verify_reference_lineage,
)
from tripflow.operators.prepare import prepare_training_data


@pytest.fixture()
def splits(labelled):
    p = prepare_training_data(labelled)
    return p.withColumn("split", F.when(F.dayofmonth("lpep_pickup_datetime") <= 2, "train")
                        .when(F.dayofmonth("lpep_pickup_datetime") <= 3, "val").otherwise("test"))


def test_time_coverage_and_rows(splits):
    fp = {r.dataset: r for r in split_fingerprints(splits).collect()}
    assert (fp["train"].n_rows, fp["val"].n_rows, fp["test"].n_rows) == (3, 1, 2)
    assert fp["train"].start == "2026-02-01 08:00:00" and fp["train"].end == "2026-02-02 10:00:00"


def test_fingerprint_ignores_layout_but_not_content(splits):
    a = {r.dataset: r.fingerprint for r in split_fingerprints(splits).collect()}
    b = {r.dataset: r.fingerprint for r in split_fingerprints(splits.repartition(4)).collect()}
    assert a == b
    changed = splits.withColumn("duration", F.when(F.col("duration") == 11.0, 11.5).otherwise(F.col("duration")))
    c = {r.dataset: r.fingerprint for r in split_fingerprints(changed).collect()}
    assert c["train"] != a["train"] and c["val"] == a["val"]


def test_gate_passes_and_names_changed_split(spark, splits):
    tags = training_lineage(split_fingerprints(splits), {"train": "t", "val": "v"}, "abc123")
    verify_reference_lineage(tags, split_fingerprints(splits))
    lost = splits.where("duration <> 11.0")
    with pytest.raises(ValueError, match="train split hash"):
        verify_reference_lineage(tags, split_fingerprints(lost))
    assert [r.matches for r in lineage_checks(tags, split_fingerprints(lost)).orderBy("dataset").collect()] == [False, True]


def test_gate_requires_tags(spark, splits):
    tags = spark.createDataFrame([("data.train.path", "x")], "tag string, value string")
    with pytest.raises(ValueError, match="cannot be checked without the tags"):
        verify_reference_lineage(tags, split_fingerprints(splits))


def test_summary_record(spark, tmp_path):
    for name, rmse in (("feb", 1.5), ("mar", None)):  # a labelled batch without clean rows has no rmse
        monitoring_summary(spark, current_name=name, current_path="/d/x", rows_reference=10, rows_current=5,
                           has_labels=True, model={"name": "m", "version": 3, "run_id": "r7"}, lineage={"code.git_revision": "abc"},
                           metrics={"quality_rmse": rmse}).write.mode("append").parquet(str(tmp_path))
    rows = {r.current_name: r for r in spark.read.parquet(str(tmp_path)).collect()}
    assert rows["feb"].metrics == {"quality_rmse": 1.5} and rows["mar"].metrics == {"quality_rmse": None}
    assert rows["feb"].model["version"] == "3" and (rows["feb"].model_run_id, rows["feb"].code_revision) == ("r7", "abc")
    assert spark.read.parquet(str(tmp_path)).where("metrics['quality_rmse'] > 1").count() == 1


def test_large_file_is_refused(spark, tmp_path, monkeypatch):
    from tripflow.operators import lineage

    (tmp_path / "f").write_bytes(b"x" * 100)
    assert lineage.file_sha256(spark, str(tmp_path / "f")) == __import__("hashlib").sha256(b"x" * 100).hexdigest()
    monkeypatch.setattr(lineage, "LARGEST_FILE", 50)
    with pytest.raises(ValueError, match="split_fingerprints"):
        lineage.file_sha256(spark, str(tmp_path / "f"))
