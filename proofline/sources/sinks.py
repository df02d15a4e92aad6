"""Sinks: tables, the hand-off file, reports and the append-only log."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """A2: Parquet keeps column metadata; CSV is the deliverable for people."""
    if fmt == "csv":
        # NULL as an empty cell, an empty string quoted: what read_raw_csv tells apart
        df.write.mode(mode).csv(path, header=True, nullValue="", emptyValue='""', escape='"')
    else:
        df.write.mode(mode).format(fmt).save(path)


def handoff_metadata(df: DataFrame) -> DataFrame:
    """A3: one row per column: position, name, type, nullability, sensitivity, metadata."""
    rows = [
        (
            i,
            f.name,
            f.dataType.simpleString(),
            f.nullable,
            bool(f.metadata.get("sensitive", False)),
            json.dumps(f.metadata, sort_keys=True),
        )
        for i, f in enumerate(df.schema)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "position int, column_name string, data_type string, nullable boolean, "
        "sensitive boolean, metadata string",
    )


def write_handoff(df: DataFrame, path: str) -> None:
    """The hand-off file as JSON lines; one row per column, so one file."""
    handoff_metadata(df).coalesce(1).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """A4: add records to the JSON log."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    """A5: one Parquet table per report under ``folder``."""
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def list_outputs(spark, path: str, depth: int = 1) -> DataFrame:
    """Names and lengths of the outputs under ``path``; the contents are not read.

    ``depth`` 1 lists files, 2 the folders that hold them, such as tables, with the
    bytes of all their files. Files without bytes are not listed, as Spark's readers pass
    over them: an empty output counts as absent.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return (
        listed.select(F.element_at(F.split("path", "/"), -depth).alias("name"), F.col("length"))
        .groupBy("name")
        .agg(F.sum("length").alias("length"))
    )
