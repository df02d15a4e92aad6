"""From wide aggregates to rows, and from columns to value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.expressions import col, is_numeric


def rows_of(wide: DataFrame, entries: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn the columns of a small wide table into rows, one per entry and wide row."""
    structs = [F.struct(*[c.alias(name) for name, c in entry.items()]) for entry in entries]
    return wide.select(F.inline(F.array(*structs)))


def names_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(position, column_name): one row per named column, also where the table is empty."""
    position = F.col("id").cast("int")
    return df.sparkSession.range(len(cols)).select(
        position.alias("position"), F.get(F.array(*[F.lit(c) for c in cols]), position).alias("column_name")
    )


def long_values(df: DataFrame, cols: Sequence[str], cast: str = "string") -> DataFrame:
    """(column_name, value): one row per cell of the named columns, nulls left out."""
    narrow = df.select(*[col(c).cast(cast).alias(c) for c in cols])
    return narrow.unpivot([], [col(c) for c in cols], "column_name", "value").where(
        F.col("value").isNotNull()
    )


def value_counts(df: DataFrame, cols: Sequence[str], cast: str = "string") -> DataFrame:
    """(column_name, value, n): one map-side combined shuffle for all columns."""
    return long_values(df, cols, cast).groupBy("column_name", "value").agg(
        F.count("*").alias("n")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if is_numeric(df, c)]
