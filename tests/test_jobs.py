import uuid

import pytest
from pyspark.sql import functions as F

from tripflow.operators.lineage import file_sha256, split_fingerprints, training_lineage
from tripflow.operators.monitor import column_summary, load_monitoring_batch
from tripflow.operators.prepare import prepare_training_data
from tripflow.plans.monitoring import run_monitoring
from tripflow.plans.scorers import ConstantScorer
from tripflow.plans.train import input_example, load_pipeline, run_training, score
from tripflow.session import scratch_path
from tripflow.sources.tables import (
    load_split,
    read_metrics_json,
    read_trip_records,
    read_zone_csv,
    write_metrics_json,
    write_splits,
    write_zone_csv,
)

FAST = {"n_estimators": 3, "max_depth": 3, "min_child_weight": 1, "subsample": 1.0, "colsample_bytree": 1.0,
        "gamma": 0.0}


def _splits(labelled):
    return labelled.withColumn("split", F.when(F.dayofmonth("lpep_pickup_datetime") <= 2, "train")
                               .when(F.dayofmonth("lpep_pickup_datetime") <= 3, "val").otherwise("test"))


def test_split_sinks_and_loader(spark, labelled):
    base = scratch_path(spark, f"test-splits-{uuid.uuid4().hex}")
    write_splits(_splits(labelled), base)
    assert load_split(spark, base, "train").count() == 3
    with pytest.raises(FileNotFoundError):
        load_split(spark, base, "holdout")


def test_zone_csv_roundtrip_and_duplicate_key(spark, zones):
    base = scratch_path(spark, f"test-zones-{uuid.uuid4().hex}")
    write_zone_csv(zones.df, f"{base}/ok")
    assert read_zone_csv(spark, f"{base}/ok").rows == 3
    write_zone_csv(zones.df.unionByName(zones.df.limit(1)), f"{base}/dup")
    with pytest.raises(ValueError, match="one row per"):
        read_zone_csv(spark, f"{base}/dup")


def test_trip_records_and_metrics_json(spark):
    import json

    base = scratch_path(spark, f"test-json-{uuid.uuid4().hex}")
    recs = [{"VendorID": 2, "lpep_pickup_datetime": "2026-01-15 08:30:00", "PULocationID": 74, "DOLocationID": 42}]
    spark.createDataFrame([(json.dumps(recs),)], "value string").coalesce(1).write.text(f"{base}/trips")
    r = read_trip_records(spark, f"{base}/trips").first()
    assert r.VendorID == "2" and r.passenger_count is None
    write_metrics_json(spark, {"b": 1.0, "a": 2.0}, f"{base}/m")
    assert spark.read.text(f"{base}/m").first()[0] == '{"a": 2.0, "b": 1.0}'
    assert read_metrics_json(spark, f"{base}/m") == {"a": 2.0, "b": 1.0}


def test_file_hash(spark, labelled):
    base = scratch_path(spark, f"test-hash-{uuid.uuid4().hex}")
    spark.createDataFrame([("abc",)], "value string").coalesce(1).write.text(f"{base}/f")
    part = [f.path for f in spark.read.format("binaryFile").load(f"{base}/f/*.txt").select("path").collect()][0]
    import hashlib

    assert file_sha256(spark, part) == hashlib.sha256(b"abc\n").hexdigest()
    assert file_sha256(spark, f"{base}/missing") == "unavailable"


def test_monitoring_batch_shapes(spark, labelled):
    lab = load_monitoring_batch(labelled, ConstantScorer(12.5))
    assert lab.quality_frame is not None and lab.quality_frame.count() == 6
    assert "duration" not in lab.input_frame.columns
    unl = load_monitoring_batch(labelled.drop("lpep_dropoff_datetime", "trip_distance"), ConstantScorer(12.5))
    assert unl.quality_frame is None and unl.input_frame.count() == 6
    with pytest.raises(ValueError, match="trip_distance"):
        load_monitoring_batch(labelled.drop("trip_distance"), ConstantScorer(12.5))
    assert load_monitoring_batch(labelled, ConstantScorer(12.5), max_rows=4).input_frame.count() == 4


def test_column_summary(spark, labelled):
    s = {r.column: r for r in column_summary(load_monitoring_batch(labelled, ConstantScorer(1.0)).input_frame).collect()}
    assert s["trip_type"].top_value == "1.0" and s["trip_type"].distinct == 3
    assert s["passenger_count"].role == "numerical" and s["passenger_count"].missing == 1


def test_training_job_and_monitoring_run(spark, zones, labelled):
    out = scratch_path(spark, f"test-train-{uuid.uuid4().hex}")
    prepared = prepare_training_data(_splits(labelled), keep=("split",))
    metrics = run_training(zones, prepared, out, FAST)
    assert set(metrics) == {"train", "val", "test"}
    model = load_pipeline(spark, f"{out}/model")
    assert score(model, prepared).count() == 6
    assert spark.read.parquet(f"{out}/feature_importance").count() > 0
    assert input_example(prepared).count() == 3

    tags = spark.read.parquet(f"{out}/lineage")
    from tripflow.plans.train import PipelineScorer

    res = run_monitoring(spark, splits=_splits(labelled).where("split <> 'test'"), tags=tags,
                         current_raw=_splits(labelled).where("split = 'test'").drop("split"),
                         scorer=PipelineScorer(model), current_name="feb", current_path="mem",
                         model={"name": "m", "version": 1}, history_path=f"{out}/history")
    assert res["has_labels"] and "quality_rmse" in res["metrics"] and "input_drifted_columns_share" in res["metrics"]
    assert spark.read.parquet(f"{out}/history").count() == 1
    # tampered reference data is refused before any report
    with pytest.raises(ValueError, match="train split hash"):
        run_monitoring(spark, splits=_splits(labelled).where("split = 'val' OR PULocationID <> 1"), tags=tags,
                       current_raw=labelled, scorer=PipelineScorer(model), current_name="x", current_path="x", model={})


def test_lineage_tags_shape(spark, labelled):
    prepared = prepare_training_data(_splits(labelled), keep=("split",))
    tags = {r.tag: r.value for r in training_lineage(split_fingerprints(prepared), {"train": "a", "val": "b"}).collect()}
    assert tags["data.train.start"] == "2026-02-01 08:00:00" and tags["data.split_strategy"] == "chronological_60_20_20"
