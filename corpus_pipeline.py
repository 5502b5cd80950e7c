"""Cleaning a text corpus in five stages, each of which applies one operator to what is left.

Every stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``, and
returns a DataFrame that is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm import decontamination, secret_scans, sentencepiece_codec, simhash_dedup, toxicity
from txnflow.llm.queries import PIECES, table
from txnflow.llm.text import fold
from txnflow.session import work_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECTED = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.5 or more; a row without doc_id stays."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    toxic = toxicity.score_toxicity(docs, labels).where(F.col("score") >= REJECTED)
    return docs.join(toxic.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component, of its smallest doc_id; a null one where it has no other.

    Rows are judged by their own text's component, also where ids are null or repeated.
    """
    return simhash_dedup.component_survivors(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; a row without doc_id stays."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark and counts the characters anew; a null text becomes empty."""
    scanned = secret_scans.scan_secrets(docs, keep=("lang", "source"))
    return scanned.withColumn("text", secret_scans.redact(F.col("text"), F.col("spans"))).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether decoding them gave back its text."""
    return sentencepiece_codec.encode_documents(docs, sentencepiece_codec.load_pieces(PIECES))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("encoding", encoding_stage),
]

#: No SQL: SimHash, nearest examples and Viterbi are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "corpus-pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
