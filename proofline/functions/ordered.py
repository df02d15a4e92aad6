"""Ordered work that never sends a whole column through one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.longform import long_values, value_counts
from proofline.session import materialize

# size of the quantile sketches, whose ranks are off by about a thousandth, and how far
# the brackets around a wanted rank reach
SKETCH_SIZE = 4096
MARGIN = 0.005
# sketches of one column that are merged side by side before their results meet
SKETCH_PARTS = 512


def running_totals(
    df: DataFrame,
    order: Sequence,
    totals: dict[str, str],
    within: Sequence[str] = (),
    only: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """Add, for each (new name, column), the sum over all rows ordered before this one.

    ``order`` must be unique per row and start with ``within``, the columns at whose
    change the sums restart; ``<new name>_all`` is the sum over the whole restart group.
    Rows are range-partitioned on ``order``. Each slice is summed on its own and shifted
    by the total of the slices before it. The slices are checkpointed so that a
    recomputed task cannot draw other range bounds.

    ``only`` keeps the slices for which it holds, given where the first total starts and
    ends in the slice and its sum over the group; the rest is neither sorted nor summed.
    """
    slices = materialize(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    # as slices follow the order, this holds at most one row per slice and per group:
    # no more than spark.sql.shuffle.partitions plus the number of groups
    sums = slices.groupBy("_slice", *within).agg(
        *[F.sum(source).alias(f"_of_{name}") for name, source in totals.items()]
    )
    group = Window.partitionBy(*within)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        "_slice",
        *within,
        *[F.coalesce(F.sum(f"_of_{n}").over(before), F.lit(0)).alias(f"_shift_{n}") for n in totals],
        *[F.sum(f"_of_{n}").over(group).alias(f"{n}_all") for n in totals],
        *[F.col(f"_of_{n}") for n in totals],
    )
    if only is not None:
        first = next(iter(totals))
        start = F.col(f"_shift_{first}")
        shifts = shifts.where(only(start, start + F.col(f"_of_{first}"), F.col(f"{first}_all")))
    shifts = shifts.drop(*[f"_of_{n}" for n in totals])
    inside = (
        Window.partitionBy("_slice", *within)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        slices.join(F.broadcast(shifts), ["_slice", *within])
        .withColumns(
            {
                n: F.coalesce(F.sum(source).over(inside), F.lit(0)) + F.col(f"_shift_{n}")
                for n, source in totals.items()
            }
        )
        .drop("_slice", *[f"_shift_{n}" for n in totals])
    )


def row_numbers(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Number the rows from 0 in a global order that is unique per row."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(counted, order, {name: "_one"}).drop("_one", f"{name}_all")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column_name, p, value): exact quantiles, linear between neighbouring ranks.

    A sketch first brackets each quantile. Values outside the brackets are counted as
    whole segments, so only those inside are shuffled one by one. Should a bracket miss
    its rank, the columns concerned are counted value by value. The built-in exact
    percentile would hold all distinct values of a column in one task.
    """
    found = _ranked(_segment_counts(df, cols, probs), probs).collect()
    missed = sorted({r["column_name"] for r in found if None in (r["low"], r["high"])})
    if missed:
        found = [r for r in found if r["column_name"] not in missed]
        counts = value_counts(df, missed, "double").where(~F.isnan("value"))
        found += _ranked(counts.withColumn("segment", F.lit(0)), probs).collect()
    # one row per column and wanted quantile
    rows = [(r["column_name"], r["p"], r["low"] + (r["high"] - r["low"]) * r["part"]) for r in found]
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")


def sketched_quantiles(cells: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column_name, quantiles): about these quantiles of the values of each column.

    Every map task sends one sketch per column. They are merged in ``SKETCH_PARTS`` parts
    first, so that no task merges those of all map tasks.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS))
    parts = cells.withColumn("__part", part).groupBy("column_name", "__part").agg(
        F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch")
    )
    merged = parts.groupBy("column_name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    return merged.select("column_name", F.kll_sketch_get_quantile_double("sketch", ranks).alias("quantiles"))


def _segment_counts(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column_name, segment, value, n): counts by value inside the brackets, by segment elsewhere."""
    lows = [max(p - MARGIN, 0.0) for p in probs]
    highs = [min(p + MARGIN, 1.0) for p in probs]
    name, v = F.col("column_name"), F.col("value")
    cells = long_values(df, cols, "double").where(~F.isnan(v))
    # one row per column, two numbers per wanted quantile
    bounds = {r["column_name"]: r["quantiles"] for r in sketched_quantiles(cells, lows + highs).collect()}
    # one branch per column; a column without values has no cells to place
    segment, inside = F.when(name.isNull(), 0), F.when(name.isNull(), False)
    for c, found in bounds.items():
        pairs = list(zip(found[: len(probs)], found[len(probs) :]))
        crossed = X.added([(v >= lo).cast("int") + (v > hi).cast("int") for lo, hi in pairs])
        kept = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in pairs])
        segment, inside = segment.when(name == c, crossed), inside.when(name == c, kept)
    return (
        cells.select("column_name", segment.alias("segment"), F.when(inside, v).alias("value"))
        .groupBy("column_name", "segment", "value")
        .agg(F.count("*").alias("n"))
    )


def _ranked(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column_name, p, low, high, part): the values at the ranks around each quantile."""

    def holds(p: Column, start: Column, end: Column, total: Column) -> Column:
        rank = p * (total - 1)
        low, high = F.floor(rank), F.ceil(rank)
        return ((start <= low) & (low < end)) | ((start <= high) & (high < end))

    wanted = F.array(*[F.lit(float(p)) for p in probs])
    placed = running_totals(
        counts,
        ["column_name", "segment", "value"],
        {"before": "n"},
        within=["column_name"],
        only=lambda start, end, total: F.exists(wanted, lambda p: holds(p, start, end, total)),
    )
    start, end, total = F.col("before"), F.col("before") + F.col("n"), F.col("before_all")
    hits = placed.withColumn("p", F.explode(F.filter(wanted, lambda p: holds(p, start, end, total))))
    rank = F.col("p") * (total - 1)
    low, high = F.floor(rank), F.ceil(rank)
    return hits.groupBy("column_name", "p").agg(
        F.max(F.when((start <= low) & (low < end), F.col("value"))).alias("low"),
        F.max(F.when((start <= high) & (high < end), F.col("value"))).alias("high"),
        F.max(rank - low).alias("part"),
    )


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence, k: int, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark keeps only ``k`` rows per group and map task before the shuffle as long as
    ``k`` is below its window group limit; beyond it the group is cut into salted parts
    that are reduced to ``k`` rows each first.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        part = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(64))
        salted = df.withColumn("_part", part)
        w = Window.partitionBy(*group, "_part").orderBy(*order)
        df = salted.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r", "_part")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
