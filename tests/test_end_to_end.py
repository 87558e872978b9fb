"""The reference's stage flow on the generated tables: split -> train job -> lineage -> promote -> monitoring run."""

import uuid

from tripflow.operators.registry import champion_fold
from tripflow.plans.monitoring import run_monitoring
from tripflow.plans.train import PipelineScorer, load_pipeline, run_training
from tripflow.queries import Inputs
from tripflow.session import scratch_path
from tripflow.sources.tables import write_splits

SF = "/root/testdata/sf0.001"
FAST = {"n_estimators": 3, "max_depth": 4}


def test_stage_flow_on_generated_tables(spark):
    inp = Inputs(spark, SF)
    base = scratch_path(spark, f"e2e-{uuid.uuid4().hex}")
    write_splits(inp.splitter.assign(inp.raw), f"{base}/splits")  # S3
    splits = spark.read.parquet(f"{base}/splits")

    metrics = run_training(inp.zones, inp.prepared_split, f"{base}/run", FAST)  # M6
    assert set(metrics) == {"train", "val", "test"} and all(m["rows"] > 0 for m in metrics.values())
    from tripflow.sources.tables import read_metrics_json

    record = read_metrics_json(spark, f"{base}/run/metrics.json")
    assert record["rmse_test"] == metrics["test"]["rmse"] and record["training_time"] > 0
    seg = spark.read.parquet(f"{base}/run/segments")
    assert seg.where("rows < 100").count() == 0

    # Register this run's test rmse after earlier versions
    versions = spark.createDataFrame([("m", 1, 50.0), ("m", 2, None), ("m", 3, float(metrics["test"]["rmse"]))],
                                     "model string, version int, rmse_test double")
    assert champion_fold(versions).where("version = 3").first().decision == "champion"

    model = load_pipeline(spark, f"{base}/run/model")
    tags = spark.read.parquet(f"{base}/run/lineage")
    current = splits.where("split = 'test'").drop("split")  # the landed test split plays the new batch
    res = run_monitoring(spark, splits=inp.splitter.assign(inp.raw).where("split <> 'test'"), tags=tags,
                         current_raw=current, scorer=PipelineScorer(model), current_name="test", current_path=base,
                         model={"name": "m", "version": 3}, history_path=f"{base}/history")
    assert res["has_labels"] and res["rows_current"] == metrics["test"]["rows"]
    m = res["metrics"]
    assert 0.0 <= m["input_drifted_columns_share"] <= 1.0 and m["quality_rmse"] > 0
    assert abs(m["quality_rmse"] - metrics["test"]["rmse"]) < 1e-9  # the same model on the same rows
    assert spark.read.parquet(f"{base}/history").count() == 1
