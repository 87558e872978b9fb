"""ST1: continuous scoring of arriving trip requests (Structured Streaming).

File source of request lines -> JSON, the line kept -> the same validation expressions as batch
(P16) -> explode valid trips -> scorer (stateless; stream-static broadcast
joins only) -> two sinks through ``foreachBatch``: scored trips and rejected
requests with their bodies. Each micro-batch writes into its own ``batch=<id>`` folder with
overwrite, so a retried batch replaces its own output (idempotent), and the
checkpoint folder lives under the session's shared ``spark.checkpoint.dir``.
No state and no watermark are needed: every output row depends on one input row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.plans.scoring import explode_trips, request_schema_with_key, validate_requests


def start_stream_scoring(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, scorer,
                         key: str = "request_id", available_now: bool = True, max_files_per_trigger: int = 64):
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(source_dir)
    request = F.from_json("value", request_schema_with_key(key))
    stream = lines.select(F.col("value").alias("body"), request.alias("r")).select("body", f"r.{key}", "r.trips")
    validated = validate_requests(stream)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            scored = scorer.transform(explode_trips(batch, key))
            scored.select(key, "pos", "prediction").write.mode("overwrite").parquet(f"{sink_dir}/scored/batch={batch_id}")
            batch.where(~F.col("valid")).select(key, "body", "n_trips", "first_invalid_pos", "first_invalid_field") \
                .write.mode("overwrite").parquet(f"{sink_dir}/rejected/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = validated.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_available(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, scorer,
                  timeout_s: float | None = None):
    """Process everything currently in ``source_dir`` and stop (availableNow); without ``timeout_s``, however long it takes."""
    q = start_stream_scoring(spark, source_dir, sink_dir, checkpoint_dir, scorer)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream scoring did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q
