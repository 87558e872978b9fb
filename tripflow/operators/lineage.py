"""Training lineage and the reference-data gate.

The reference hashes split files; we fingerprint split *content* with an
order-insensitive aggregate: row count, sum and xor of 60 bits of each row's
md5, and the pickup time range. The row's text is spelt out below, so any engine
can recompute it. It is one partial aggregate per split (no shuffle of
rows), is unchanged by repartitioning or file layout, and changes when a row is
added, lost or altered.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.timefeat import format_second
from tripflow.schema import LINEAGE_REQUIRED_TAGS, MODEL_INPUT_COLUMNS, PICKUP

SPLIT_STRATEGY = "chronological_60_20_20"


def fingerprint_column():
    """One string: ``rows:sum:xor`` (the sha256 slot of the reference's tags)."""
    return F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), F.col("hash_sum"),
                              F.col("hash_xor").cast("string")), 256)


CONTENT_COLUMNS = [*MODEL_INPUT_COLUMNS, "duration"]


def content_hash(frame: DataFrame, cols):
    """Row hash: the columns in order of name, joined by ``|``; null is ``~``, numbers with a fraction are whole
    millionths, times go to the second."""
    kinds = dict(frame.dtypes)

    def text(c: str):
        v = F.col(c)
        if kinds[c] in ("double", "float"):
            v = F.round(v * 1e6).cast("bigint")
        elif kinds[c].startswith("timestamp"):
            v = format_second(v)
        return F.coalesce(v.cast("string"), F.lit("~"))

    joined = F.concat_ws("|", *[text(c) for c in sorted(cols)])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def split_fingerprints(frame: DataFrame, split_col: str = "split", ts_col: str = PICKUP, cols=None) -> DataFrame:
    """D7 for every split at once: (dataset, n_rows, start, end, fingerprint) — one grouped aggregate.

    The fingerprint covers the split's content: the model inputs and the target (``cols``
    to override), never pass-through keys, so training and monitoring fingerprint the same thing.
    """
    cols = cols or [c for c in CONTENT_COLUMNS if c in frame.columns]
    by = [split_col] if isinstance(split_col, str) else list(split_col)
    named = frame.select("*", content_hash(frame, cols).alias("__h"))
    h = F.col("__h")
    agg = named.groupBy(*[F.col(c).alias("dataset" if c == "split" or len(by) == 1 else c) for c in by]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor(h).alias("hash_xor"),
        format_second(F.min(ts_col)).alias("start"),
        format_second(F.max(ts_col)).alias("end"),
    )
    return agg.select(*[c for c in agg.columns if c not in ("hash_sum", "hash_xor")], fingerprint_column().alias("fingerprint"))


def training_lineage(fingerprints: DataFrame, paths: dict[str, str], code_revision: str = "unavailable") -> DataFrame:
    """Lineage tags (tag, value) for train and validation, as the champion's run would carry them."""
    spark = fingerprints.sparkSession
    rows = {r["dataset"]: r for r in fingerprints.collect()}  # one row per split: bounded
    tags = [("code.git_revision", code_revision), ("data.split_strategy", SPLIT_STRATEGY)]
    for split, label in (("train", "train"), ("val", "validation")):
        r = rows.get(split)
        tags += [
            (f"data.{label}.path", paths.get(split, "unavailable")),
            (f"data.{label}.sha256", r["fingerprint"] if r else "unavailable"),
            (f"data.{label}.start", r["start"] if r else None),
            (f"data.{label}.end", r["end"] if r else None),
        ]
    return spark.createDataFrame(tags, "tag string, value string")


def lineage_checks(tags: DataFrame, current: DataFrame) -> DataFrame:
    """D8 + F13 as a table: one row per required split, ``matches`` false when the content changed.

    ``current`` is ``split_fingerprints`` of the data on disk now.
    """
    expected = tags.where(F.col("tag").isin("data.train.sha256", "data.validation.sha256")).select(
        F.when(F.col("tag") == "data.train.sha256", F.lit("train")).otherwise(F.lit("val")).alias("dataset"),
        F.col("value").alias("expected"),
    )
    now = current.select("dataset", "n_rows", F.col("fingerprint").alias("actual"))
    # one row per split on each side: a proven-small broadcast
    return expected.join(F.broadcast(now), "dataset", "left").select(
        "dataset", "n_rows", "expected", "actual",
        F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("matches"))


def verify_reference_lineage(tags: DataFrame, current: DataFrame) -> None:
    """Raise before any monitoring work: missing tags, or changed train/validation content (named)."""
    present = {r["tag"]: r["value"] for r in tags.collect()}  # a few dozen tags
    missing = [t for t in LINEAGE_REQUIRED_TAGS if not present.get(t)]
    if missing:
        raise ValueError(f"the champion's lineage cannot be checked without the tags {missing}; train and register it again")
    bad = [r["dataset"] for r in lineage_checks(tags, current).collect() if not r["matches"]]
    if bad:
        names = ", ".join(f"{'validation' if d == 'val' else d} split hash" for d in sorted(bad, key=lambda d: d != "train"))
        raise ValueError(f"the reference data has changed since the champion was trained: {names}")


SUMMARY = ("run_at timestamp, current_name string, current_path string, rows_reference bigint, rows_current bigint, "
           "has_labels boolean, model_run_id string, code_revision string, model map<string,string>, "
           "lineage map<string,string>, metrics map<string,double>")


def monitoring_summary(spark: SparkSession, *, current_name: str, current_path: str, rows_reference: int,
                       rows_current: int, has_labels: bool, model: dict, lineage: dict, metrics: dict) -> DataFrame:
    """The one-row summary record appended to a monitoring history table.

    Metrics are a map, so the history can be filtered by metric; one that could not be computed is null.
    """
    words = lambda d: {k: None if v is None else str(v) for k, v in d.items()}
    row = (
        _dt.datetime.now(_dt.timezone.utc), current_name, current_path, int(rows_reference), int(rows_current),
        bool(has_labels), None if model.get("run_id") is None else str(model["run_id"]), lineage.get("code.git_revision"),
        words(model), words(lineage), {k: None if v is None else float(v) for k, v in metrics.items()},
    )
    return spark.createDataFrame([row], SUMMARY)


#: A row holds one value of less than 2 GB; larger files are compared by content (``split_fingerprints``).
LARGEST_FILE = (1 << 31) - (1 << 20)


def file_sha256(spark: SparkSession, path: str) -> str:
    """sha-256 of one file's bytes, or ``unavailable`` when it does not exist.

    A check for small files: the file is one value in one task. Above what a row holds it raises; for data of any size
    ``split_fingerprints`` is the check.
    """
    from tripflow.sources.monthly import path_exists

    if not path_exists(spark, path):
        return "unavailable"
    file = spark.read.format("binaryFile").load(path)
    size = file.select("length").first()["length"]
    if size > LARGEST_FILE:
        raise ValueError(f"{path} has {size} bytes, more than one value holds; compare its content by split_fingerprints")
    return file.select(F.sha2(F.col("content"), 256).alias("h")).first()["h"]
