"""Model registry decisions as table operators (W2 champion fold, O4 best trial).

W2: versions arrive in version order per model. A version with no metric stays a
challenger; otherwise it becomes champion when there is no champion yet or its
metric is <= the current champion's. Every promotion lowers (or keeps) the
champion's metric, so the current champion's metric is the running minimum of
the earlier versions' metrics, and the fold is one ordered scan: exact, and
blocked so a model with a third of all versions never lands in one task.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.ordered import Running, ordered_scan

CHAMPION, CHALLENGER = "champion", "challenger"


def champion_fold(versions: DataFrame, model: str = "model", version: str = "version",
                  metric: str = "rmse_test") -> DataFrame:
    """Per version: the champion metric before it and the alias it receives (a NaN metric is no metric)."""
    versions = versions.withColumn(metric, F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double")))
    scanned = ordered_scan(versions, [model], version,
                           [Running("champion_metric_before", F.col(metric), kind="min", inclusive=False)])
    m, before = F.col(metric), F.col("champion_metric_before")
    decision = (
        F.when(m.isNull(), F.lit(CHALLENGER))
        .when(before.isNull() | (m <= before), F.lit(CHAMPION))
        .otherwise(F.lit(CHALLENGER))
    )
    return scanned.withColumn("decision", decision)


def current_aliases(decided: DataFrame, model: str = "model", version: str = "version") -> DataFrame:
    """Final aliases: the last version promoted to each alias (one partial aggregate per model)."""
    return decided.groupBy(model).agg(
        F.max(F.when(F.col("decision") == CHAMPION, F.col(version))).alias("champion_version"),
        F.max(F.when(F.col("decision") == CHALLENGER, F.col(version))).alias("challenger_version"),
        F.count(F.lit(1)).alias("versions"),
    )


def best_trial(trials: DataFrame, study: str = "study", trial: str = "trial", metric: str = "rmse_val",
               params=("max_depth", "min_child_weight")) -> DataFrame:
    """The trial with the lowest metric per study (lowest trial number on ties); trials without a metric never win."""
    best = F.min_by(F.struct(F.col(trial).alias("t"), F.col(metric).alias("m"), *[F.col(p) for p in params]),
                    F.struct(F.col(metric), F.col(trial)))
    out = trials.where(F.col(metric).isNotNull() & ~F.isnan(metric)).groupBy(study).agg(best.alias("b"), F.count(F.lit(1)).alias("n_trials"))
    return out.select(study, "n_trials", F.col("b.t").alias("best_trial"), F.col("b.m").alias(f"best_{metric}"),
                      *[F.col(f"b.{p}").alias(p) for p in params])


def _commits(spark, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def last_commit(spark, versions_path: str, model: str) -> dict | None:
    """The newest commit of a model, null before the first: it states the champion, so nothing is folded again."""
    jvm, fs, folder = _commits(spark, f"{versions_path}/model={model}")
    if not fs.exists(folder):
        return None
    names = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("commit-"))
    if not names:
        return None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _create(spark, versions_path: str, record: dict) -> bool:
    """Publish the commit if there is none of its number: false if another writer has taken it.

    The record is written beside and then takes its name, so a reader never sees half of one. A rename that must not
    replace is atomic in HDFS; a local file takes its name by a hard link, which is atomic there.
    """
    jvm, fs, folder = _commits(spark, f"{versions_path}/model={record['model']}")
    path = jvm.org.apache.hadoop.fs.Path
    target, beside = (path(folder, f"{n}{record['commit']:012d}{e}") for n, e in (("commit-", ".json"), ("_new-", f"-{uuid.uuid4().hex}")))
    stream = fs.create(beside, False)
    stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            local = lambda p: jvm.java.nio.file.Path.of(p.toUri())
            jvm.java.nio.file.Files.createLink(local(fs.makeQualified(target)), local(fs.makeQualified(beside)))
            fs.delete(beside, False)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
            context.rename(beside, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as exc:  # noqa: BLE001 - py4j wraps what the store raises
        fs.delete(beside, False)
        if "AlreadyExists" in str(exc):
            return False
        raise
    return True


def register_version(spark, versions_path: str, model: str, version: int, metric: float | None,
                     metric_name: str = "rmse_test") -> str:
    """Commit one version of a model and return the alias it receives.

    Commits of a model are numbered files. A writer reads the last one, decides by the champion that it states, and
    creates the next number; if another writer was faster it starts again from that one's champion. So two writers
    never decide by the same champion, the order of commits is the order of decisions, and a decision reads one file.
    Registering a version again returns its first decision.
    """
    metric = None if metric is None or metric != metric else float(metric)
    while True:
        last = last_commit(spark, versions_path, model) or {"commit": 0, "champion_version": None, "champion_metric": None}
        if last["commit"]:
            done = registered_versions(spark, versions_path, metric_name).where((F.col("model") == model) & (F.col("version") == int(version))).first()
            if done is not None:
                return done["decision"]
        before = last["champion_metric"]
        wins = metric is not None and (before is None or metric <= before)
        record = {"model": model, "commit": last["commit"] + 1, "version": int(version), "metric": metric,
                  "decision": CHAMPION if wins else CHALLENGER, "champion_version": int(version) if wins else last["champion_version"],
                  "champion_metric": metric if wins else before}
        if _create(spark, versions_path, record):
            return record["decision"]


def registered_versions(spark, versions_path: str, metric_name: str = "rmse_test") -> DataFrame:
    """All commits as a table: model, commit, version, the metric, decision, champion_version, champion_metric."""
    schema = "commit bigint, version bigint, metric double, decision string, champion_version bigint, champion_metric double"
    return spark.read.schema(f"{schema}, model string").json(versions_path).select(
        F.col("model").cast("string").alias("model"), "commit", "version", F.col("metric").alias(metric_name), "decision", "champion_version", "champion_metric")
