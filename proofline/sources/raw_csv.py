"""Raw delimited text, read without losing what the header and the cells say."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.functions.expressions import MALFORMED

# no text file holds this control character, so only an unquoted empty cell reads as NULL
NO_VALUE = "\u0001"


def read_raw_csv(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> tuple[DataFrame, list[str]]:
    """A1: all cells as text under positional names ``c0..cn``, and the header apart.

    Spark's own header handling renames repeated names, which would hide them. An
    unquoted empty cell is NULL, a quoted empty cell is an empty string. A row with too few
    or too many cells has its whole text in the column ``_malformed``, which is NULL
    otherwise; the contract counts such rows. ``multi_line`` lets quoted cells hold line
    breaks; files are then read whole by one task each, so keep them small. All files under
    ``path`` must share one header, or a ``ValueError`` says which does not.
    """
    lines = spark.read.text(path)
    first = lines.first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    if len(lines.inputFiles()) > 1:
        _one_header(lines, first["value"], path)
    header = next(csv.reader([first["value"]], delimiter=sep))
    names = [*[f"c{i}" for i in range(len(header))], MALFORMED]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # a parser that skips cells would not see how many there are
    rows = spark.read.schema(schema).option("columnPruning", "false").csv(
        path,
        sep=sep,
        header=True,
        enforceSchema=True,
        nullValue=NO_VALUE,
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=MALFORMED,
    )
    # said so that no filter on it reaches the parser, which would drop the rows it asks for
    told = F.nullif(F.coalesce(F.col(MALFORMED), F.lit(NO_VALUE)), F.lit(NO_VALUE))
    return rows.withColumn(MALFORMED, told), header


def _one_header(lines: DataFrame, header: str, path: str) -> None:
    """Compare the first lines of all files; empty files have none."""
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    ).where(F.col("start") == 0)
    firsts = placed.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    other = firsts.where(F.col("header") != header).first()
    if other is not None:
        raise ValueError(f"{other['file']} has another header than other files in {path}: {other['header']}")
