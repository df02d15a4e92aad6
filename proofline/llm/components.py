"""Connected components of links, and spanning forests that keep few links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import tables


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same vertices as the links a - b, at most one for each vertex."""
    if not len(a):
        return a, b
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
        if not len(left):
            break
    while not np.array_equal(root, root[root]):
        root = root[root]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) for the vertices of ``links`` (a, b: long); component is the least of them.

    Rounds of large and small stars: every round hangs the neighbours of each vertex on the
    least of them. A round keeps its links as a table in the shared folder, and rows of a
    vertex with very many links may be split over tasks, as they are only aggregated and
    joined. Null ends and links of a vertex to itself are left out; repeated links count once.
    """
    kept = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    kept = tables.stored(kept.distinct(), "links")
    state = None
    while True:
        now = kept.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now[0] == 0 or now == state:
            break
        state = now
        # large star: neighbours above a vertex go to the least of its neighbours and itself
        both = kept.unionByName(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = tables.stored(large, "links")
        # small star: the other neighbours below a vertex and itself go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = tables.stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return kept.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        kept.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )
