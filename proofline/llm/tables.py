"""Helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import proofline
from proofline.session import scratch_path

# rows that one Arrow batch hands to a Python worker: whole texts may be long
BATCH_ROWS = 500


def ready(spark: SparkSession) -> None:
    """Hand whole texts to Python workers in small batches, and tell them where this package is.

    A cluster has the package installed; a local session may run from another folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    home = str(Path(proofline.__file__).parent.parent)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read from there on.

    Later reads neither repeat the work nor depend on executors that are still alive.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, as ``doc_id`` and ``text``; no text is an empty one."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of structs with these fields, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Other Arrow batches for jobs that run inside: narrow rows go in larger ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
