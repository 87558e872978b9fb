"""The monitoring run (D6 orchestration of D1, D2, D8, S6).

1. Gate: the champion's lineage tags must match the reference data on disk (fails before any other work).
2. Reference input frame from the train split, reference quality frame from the validation split.
3. Current batch: labelled or unlabelled (S6), scored by the champion.
4. Input report always; quality report only for a labelled batch.
5. One summary row appended to the monitoring history table (parquet, append).

Every step is a Spark job over whole frames; the driver only sees the final few
dozen metric values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.lineage import monitoring_summary, split_fingerprints, verify_reference_lineage
from tripflow.operators.monitor import input_report, load_monitoring_batch, quality_report
from tripflow.schema import DRIFT_WARNING_SHARE


def run_monitoring(spark: SparkSession, *, splits: DataFrame, tags: DataFrame, current_raw: DataFrame, scorer,
                   current_name: str, current_path: str, model: dict, history_path: str | None = None,
                   reference_max_rows: int | None = None, current_max_rows: int | None = None, seed: int = 42,
                   drift_warning_share: float = DRIFT_WARNING_SHARE) -> dict:
    """``splits``: raw rows of the reference splits with a ``split`` column (train / val)."""
    from tripflow.operators.prepare import prepare_training_data

    prepared = prepare_training_data(splits, keep=("split",))
    verify_reference_lineage(tags, split_fingerprints(prepared))

    ref_train = load_monitoring_batch(splits.where("split = 'train'").drop("split"), scorer, reference_max_rows, seed)
    ref_val = load_monitoring_batch(splits.where("split = 'val'").drop("split"), scorer, reference_max_rows, seed)
    current = load_monitoring_batch(current_raw, scorer, current_max_rows, seed)

    metrics = input_report(ref_train.input_frame, current.input_frame, drift_warning_share).first().asDict()
    if current.quality_frame is not None:
        metrics.update(quality_report(ref_val.quality_frame, current.quality_frame).first().asDict())
    rows_ref = ref_train.input_frame.count()
    rows_cur = current.input_frame.count()
    lineage = {r["tag"]: r["value"] for r in tags.collect()}
    summary = monitoring_summary(spark, current_name=current_name, current_path=current_path, rows_reference=rows_ref,
                                 rows_current=rows_cur, has_labels=current.quality_frame is not None, model=model,
                                 lineage=lineage, metrics=metrics)
    if history_path:
        summary.write.mode("append").parquet(history_path)
    return {"metrics": metrics, "rows_reference": rows_ref, "rows_current": rows_cur,
            "has_labels": current.quality_frame is not None}
