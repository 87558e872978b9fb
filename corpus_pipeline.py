"""Training-data pipeline over documents: language, near duplicates, personal data, mixing, packing.

A stage takes (spark, docs, sf_dir), works on all documents that the stage before it kept, and returns a DataFrame. All
but the last return the columns of documents: doc_id, text, lang, source, n_chars (the code points of the text as it
leaves the stage). ``run`` writes each result as Parquet under the cluster's shared folder and reads it back.

Nulls, empty texts, ties, repeated rows and further columns are treated as the operators' docstrings say; an empty
table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import materialise
from tripflow.llm.langid import fit, predict
from tripflow.llm.mixing import mix
from tripflow.llm.neardup import text_classes, text_digest
from tripflow.llm.packing import pack_documents
from tripflow.llm.pii import find_pii, redact


def _documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in none of the languages of the labelled ones; fills in a missing language."""
    found = predict(docs, fit(docs)).where(~F.col("rejected"))
    return _documents(found.withColumn("lang", F.coalesce("lang", "lang_pred")))


def near_duplicate_classes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near duplicates, once: of several texts the one with the least
    digest, of equal ones the row with the least language and source. Documents without an id stay."""
    docs = _documents(docs)
    found = materialise(text_classes(docs), "classes")
    kept = found.where("kept and doc_id is not null").select("doc_id", "digest", "times")
    rows = docs.withColumn("digest", text_digest(F.col("text"))).join(kept, ["doc_id", "digest"])
    least = F.min(F.struct("text", "lang", "source")).alias("r")
    repeated = rows.where("times > 1").groupBy("doc_id").agg(least).select("doc_id", "r.*")
    return _documents(rows.where("times = 1").select(*repeated.columns).unionByName(repeated)
                      .unionByName(docs.where("doc_id is null").select(*repeated.columns)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind in brackets."""
    return _documents(redact(find_pii(docs)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix, small sources up to twice; each is used at least once."""
    used = mix(docs)
    return _documents(used.repartitionByRange("place").sortWithinPartitions("place"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset; a repeated document has pieces for each use."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicate_classes),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: Trained models, hashing and tokenizers are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
