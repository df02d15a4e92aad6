"""What a run really wrote: files, bytes, rows and columns of its outputs, as a data source.

Spark's own file readers pass over files without bytes and folders without files, so a listing
made with them cannot tell an empty output from one that is absent. This one can, and it reads
the structure of an output from the footers of its files, not from their rows.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# workers get the functions of this module by value; they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "proofline_outputs"
# files whose footers one task reads
FILES_PER_TASK = 256
# Spark's name for its own schema in the footer of a Parquet file
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

_COLUMNS = "array<struct<name: string, type: string>>"
LISTING = f"name string, file string, length long, n_rows long, columns {_COLUMNS}, fault string"


@dataclass
class _Files(InputPartition):
    """Files (output, path, length) whose footers a task reads; no path stands for a folder without files."""

    files: list

    def __init__(self, files: list) -> None:
        super().__init__(len(files))
        self.files = files


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _hidden(name: str) -> bool:
    """What Spark's readers leave aside as well: markers, checksums, unfinished attempts."""
    return name.startswith(("_", "."))


def _listed(path: str) -> list[tuple[str, str | None, int]]:
    from pyarrow import fs

    store, root = _opened(path)
    found: list[tuple[str, str | None, int]] = []
    for top in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if _hidden(top.base_name):
            continue
        if top.type == fs.FileType.File:
            found.append((top.base_name, top.path, top.size))
            continue
        inside = [
            (top.base_name, x.path, x.size)
            for x in store.get_file_info(fs.FileSelector(top.path, recursive=True))
            if x.type == fs.FileType.File and not any(map(_hidden, x.path[len(top.path) :].strip("/").split("/")))
        ]
        found += inside or [(top.base_name, None, 0)]
    return found


def _structure(store, path: str, length: int) -> tuple:
    """Rows, columns and fault of one file; only Parquet and CSV say what they hold."""
    if length == 0:
        return None, None, None
    if path.endswith(".parquet"):
        import pyarrow.parquet as pq

        try:
            with store.open_input_file(path) as file:
                footer = pq.ParquetFile(file)
                said = (footer.schema_arrow.metadata or {}).get(SPARK_SCHEMA)
                if said:
                    schema = T.StructType.fromJson(json.loads(said))
                else:
                    from pyspark.sql.pandas.types import from_arrow_schema

                    schema = from_arrow_schema(footer.schema_arrow)
                return footer.metadata.num_rows, [(f.name, f.dataType.simpleString()) for f in schema], None
        except (OSError, ValueError) as error:
            return None, None, f"unreadable: {type(error).__name__}"
    if path.endswith(".csv"):
        import csv
        import io

        with store.open_input_stream(path) as file:
            lines = file.read(1 << 20).decode("utf-8", "replace").splitlines()
        header = next(csv.reader(io.StringIO(lines[0])), []) if lines else []
        return 0 if len(lines) < 2 else None, [(name, None) for name in header], None
    return None, None, None


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> Sequence[InputPartition]:
        files = _listed(self.path)
        return [_Files(files[i : i + FILES_PER_TASK]) for i in range(0, len(files), FILES_PER_TASK)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        store, root = _opened(self.path)
        for name, path, length in partition.files:
            if path is None:
                yield name, None, 0, None, None, None
            else:
                yield name, path[len(root) :].strip("/"), length, *_structure(store, path, length)


class OutputListing(DataSource):
    """A row for each file under ``path``, by the output (top folder or file) that it belongs to."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LISTING

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"])


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """name, file, length, n_rows, columns and fault of every file under ``path``.

    Hidden names (of ``_`` or ``.``) are left out. A folder without files is listed with a null
    file. Rows and columns come from the footers of Parquet files; a CSV file tells the names
    of its header and whether a row follows it.
    """
    spark.dataSource.register(OutputListing)
    return spark.read.format(FORMAT).load(path)


def outputs_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per output: name, n_files, length, n_rows, columns, n_structures, n_unreadable.

    n_rows is null where a file does not tell it, columns are those of any file that has some,
    and n_structures is above 1 where files of one output differ.
    """
    known = F.count("n_rows") == F.count_if(F.col("length") > 0)
    return (
        listed_files(spark, path)
        .groupBy("name")
        .agg(
            F.count("file").alias("n_files"),
            F.sum("length").alias("length"),
            F.when(known, F.sum("n_rows")).when(F.max("n_rows") == 0, F.sum("n_rows")).alias("n_rows"),
            F.max("columns").alias("columns"),
            F.count_distinct("columns").alias("n_structures"),
            F.count("fault").alias("n_unreadable"),
        )
    )


@dataclass(frozen=True)
class OutputSpec:
    """What an output must be: its columns (None: any), in any order, and its least number of rows."""

    columns: str | T.StructType | None = None
    rows: int = 1


def expected_outputs(spark: SparkSession, specs: Mapping[str, OutputSpec]) -> DataFrame:
    """The specs as a table: name, wanted, least."""
    rows = []
    for name, spec in specs.items():
        schema = T.StructType.fromDDL(spec.columns) if isinstance(spec.columns, str) else spec.columns
        rows.append((name, None if schema is None else [(f.name, f.dataType.simpleString()) for f in schema], spec.rows))
    return spark.createDataFrame(rows, f"name string, wanted {_COLUMNS}, least long")


def output_faults(expected: DataFrame, outputs: DataFrame) -> DataFrame:
    """C14 with structure: name, status and detail of every expected output that is not as it must be.

    ``absent``, ``empty`` (files, but no bytes), ``unreadable``, ``mixed columns`` (files that
    differ), ``wrong columns`` or ``no rows`` (fewer than the least): the first that holds. A
    type that the file does not tell is not compared.
    """
    both = expected.join(outputs, "name", "left")
    names = lambda columns: F.transform(columns, lambda c: c["name"])
    lacking = F.array_except(names("wanted"), names("columns"))
    surplus = F.array_except(names("columns"), names("wanted"))
    other = F.filter(
        "columns",
        lambda c: c["type"].isNotNull() & F.exists("wanted", lambda w: (w["name"] == c["name"]) & (w["type"] != c["type"])),
    )
    parts = [
        F.when(F.size(lacking) > 0, F.concat(F.lit("lacks "), F.array_join(F.array_sort(lacking), ", "))),
        F.when(F.size(surplus) > 0, F.concat(F.lit("has "), F.array_join(F.array_sort(surplus), ", "))),
        F.when(
            F.size(other) > 0,
            F.concat(F.lit("type of "), F.array_join(F.array_sort(F.transform(other, lambda c: F.concat_ws(" ", c["name"], c["type"]))), ", ")),
        ),
    ]
    wrong = F.concat_ws("; ", *parts)
    none = F.lit(None).cast("string")
    cases = [
        ("absent", F.col("n_files").isNull() | (F.col("n_files") == 0), none),
        ("empty", F.col("length") == 0, none),
        ("unreadable", F.col("n_unreadable") > 0, F.concat(F.col("n_unreadable"), F.lit(" files"))),
        ("mixed columns", F.col("n_structures") > 1, F.concat(F.col("n_structures"), F.lit(" structures"))),
        ("wrong columns", F.col("wanted").isNotNull() & F.col("columns").isNotNull() & (wrong != ""), wrong),
        ("no rows", F.col("n_rows") < F.col("least"), F.concat(F.col("n_rows"), F.lit(" of "), F.col("least"))),
    ]
    status, detail = none, none
    for name, holds, what in reversed(cases):
        status, detail = F.when(holds, name).otherwise(status), F.when(holds, what).otherwise(detail)
    return both.select("name", status.alias("status"), detail.alias("detail")).where("status IS NOT NULL")
