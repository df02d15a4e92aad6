"""Joins to lookup tables: broadcast below a checked size, hot keys spread above it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.session import materialize

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
# rows of one key that a task may join; a key with more is spread over as many tasks as it needs
TARGET_ROWS = 1_000_000

# names of helper columns, which no table is expected to have
HOT, PARTS, PART = "__hot_key", "__hot_parts", "__hot_part"


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure a lookup table; reads at most ``rows`` + 1 rows of it."""
    text = F.octet_length(F.to_json(F.struct("*")))
    n, used = df.limit(rows + 1).agg(F.count("*"), F.sum(text)).first()
    return n <= rows and (used or 0) <= size


def hot_keys(df: DataFrame, keys: Sequence[str], target: int | None = None, n: str | None = None) -> DataFrame:
    """Hashes of the keys with more than ``target`` rows, and how many parts they need.

    Rows are counted by key before the shuffle, so a hot key reaches one task only as
    one count from each. ``n`` names a column of ``df`` that holds such counts already. The
    result is kept as a table: it has at most rows / ``target`` rows, and both sides of a
    join must see the same.
    """
    target = TARGET_ROWS if target is None else target
    hashed = df.select(F.xxhash64(*keys).alias(HOT), F.lit(1).alias("n") if n is None else F.col(n).alias("n"))
    counts = hashed.groupBy(HOT).agg(F.sum("n").alias("n")).where(F.col("n") > target)
    return materialize(counts.select(HOT, F.ceil(F.col("n") / target).cast("int").alias(PARTS)))


def join_unique(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    target: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to a table with one row per key, neither side small.

    Rows of a key with more than ``target`` rows are spread over as many parts as keep to
    it, and the key's lookup row is copied to each. The part is a hash of the row and of its
    input partition: copies of a row spread too, and a rerun task sends every row to the
    same place. ``big`` is read once more for its keys unless ``hot`` (see ``hot_keys``) is
    given; keep it as a table first if it is costly.
    """
    hot = hot_keys(big, keys, target) if hot is None else hot
    if hot.isEmpty():
        return big.join(lookup, list(keys), how)
    hot = F.broadcast(hot)
    plain = [f.name for f in big.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c.replace('`', '``')}`") for c in plain])
    part = F.when(F.col(PARTS).isNotNull(), F.pmod(row, F.col(PARTS))).otherwise(F.lit(0))
    spread = big.join(hot, F.xxhash64(*keys) == F.col(HOT), "left").withColumn(PART, part.cast("int"))
    copies = F.sequence(F.lit(0), F.coalesce(PARTS, F.lit(1)) - 1)
    copied = lookup.join(hot, F.xxhash64(*keys) == F.col(HOT), "left").withColumn(PART, F.explode(copies)).drop(HOT, PARTS)
    return spread.drop(HOT, PARTS).join(copied, [*keys, PART], how).drop(PART)


def lookup_join(big: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a table with one row per key, by the way its measured size allows.

    A lookup that has to be computed is best kept as a table first, as it is measured here.
    """
    if fits_broadcast(lookup):
        return big.join(F.broadcast(lookup), list(keys), how)
    return join_unique(big, lookup, keys, how)
