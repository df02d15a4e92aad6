"""From raw documents to packed training sequences.

Every stage gets what the one before it kept, written as Parquet and read again, and all but
the last return the columns of ``documents``. Rows with a null text count as empty
documents, null and repeated doc_ids are handled as each operator states, and an empty
table passes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.llm import decontaminate, neardups, packing, quality, secrets, tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least the threshold; the others go."""
    tables.ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.where("quality_kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, found by SimHash and a prefix filter: that with the least doc_id."""
    tables.ready(spark)
    return neardups.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    tables.ready(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret; n_chars follows the text."""
    tables.ready(spark)
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of all documents in sequences of 1,024 tokens."""
    tables.ready(spark)
    return packing.pack(docs, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]
# SQL cannot fit the classifier; the tests compare each stage with a plain version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = tables.stored(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
