"""Publishing: outputs become visible only when the gate has let them through.

Every run writes its outputs into a folder of its own, which no reader looks into. What lies
there is then gated: the files as they are, not the tables they were meant to be. The verdict
becomes a record of the manifest, and readers go by the manifest: they see the outputs of the
last run that was not blocked, all of them from the same run. A blocked run leaves
everything as it was; its outputs stay for inspection.

A version is never changed, so a reader that has resolved one keeps a consistent view while
the next is written. A record is one file that appears at once when its write commits.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.operators.contract import as_violations, gate
from proofline.sources.listing import OutputSpec, expected_outputs, listed_files, output_faults, outputs_of
from proofline.sources.sinks import append_log, write_table

MANIFEST = "run_id string, seq long, decision string, reason string, published_at timestamp_ntz, outputs array<string>"


class NothingPublished(Exception):
    """No run has passed the gate, or the one asked for has not."""


def _version(folder: str, run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][\w.-]*", run_id):
        raise ValueError(f"a run is named by letters, digits and . _ -, not {run_id!r}")
    return f"{folder.rstrip('/')}/versions/{run_id}"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A record of every run: run_id, seq, decision, reason, published_at, outputs."""
    # a folder that does not exist has no records
    path = f"{folder.rstrip('/')}/manifest"
    if listed_files(spark, folder).where((F.col("name") == "manifest") & (F.col("length") > 0)).isEmpty():
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(path)


def publish(
    spark: SparkSession,
    folder: str,
    run_id: str,
    outputs: Mapping[str, DataFrame],
    expected: Mapping[str, OutputSpec],
    violations: DataFrame | None = None,
    at: datetime | None = None,
) -> str:
    """Stage, gate, and record; returns the decision.

    ``violations`` are those of contracts on what was written, beside the check of the files.
    A run that is repeated under its name overwrites what it staged, unless it was published: a
    published version is not written again.
    """
    records = manifest(spark, folder)
    known = records.agg(F.coalesce(F.max("seq"), F.lit(0)), F.count_if((F.col("run_id") == run_id) & (F.col("decision") != "block"))).first()
    if known[1]:
        raise ValueError(f"run {run_id!r} is published already")
    place = _version(folder, run_id)
    for name, df in outputs.items():
        write_table(df, f"{place}/{name}", mode="overwrite")
    found = as_violations(output_faults(expected_outputs(spark, expected), outputs_of(spark, place)), "outputs")
    if violations is not None:
        found = found.unionByName(violations)
    # one row
    verdict = gate(found).first()
    record = (run_id, known[0] + 1, verdict["decision"], verdict["reason"], at or datetime.now(), sorted(outputs))
    append_log(spark.createDataFrame([record], MANIFEST).coalesce(1), f"{folder.rstrip('/')}/manifest")
    return verdict["decision"]


def resolve(spark: SparkSession, folder: str, run_id: str | None = None) -> str:
    """The folder of the last published run, or of the one named."""
    passed = manifest(spark, folder).where(F.col("decision") != "block")
    if run_id is not None:
        passed = passed.where(F.col("run_id") == run_id)
    last = passed.orderBy(F.desc("seq"), F.desc("run_id")).select("run_id").first()
    if last is None:
        raise NothingPublished(f"{folder}: nothing published" + (f" by {run_id}" if run_id else ""))
    return _version(folder, last["run_id"])


def read_published(spark: SparkSession, folder: str, name: str, run_id: str | None = None) -> DataFrame:
    """One output of the last published run, or of the one named."""
    return spark.read.parquet(f"{resolve(spark, folder, run_id)}/{name}")
