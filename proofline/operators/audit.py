"""The audit trail: validation records, and questions asked of the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.expressions import col
from proofline.functions.ordered import row_numbers, top_per_group
from proofline.session import materialize


def audit_rows(violations: DataFrame, checks: Sequence[str], run_id: str, at: Column) -> DataFrame:
    """G1: one record per check of a run, passed or failed."""
    found = violations.groupBy("check").agg(F.count("*").alias("n_violations"))
    names = violations.sparkSession.createDataFrame([(c,) for c in checks], "check string")
    # both sides hold at most one row per check
    n = F.coalesce("n_violations", F.lit(0))
    return names.join(F.broadcast(found), "check", "left").select(
        F.lit(run_id).alias("run_id"),
        at.alias("checked_at"),
        "check",
        F.when(n == 0, "pass").otherwise("fail").alias("result"),
        n.alias("n_violations"),
    )


def trace_back(log: DataFrame, entity: str, order: Sequence[str], n: int, shown: str) -> DataFrame:
    """The latest ``n`` entries per entity, each with the entry before it.

    ``order`` must be unique within an entity. Only ``n`` + 1 entries of an entity reach
    a shuffle from any map task, so a busy entity stays small.
    """
    latest_first = [F.desc(c) for c in order]
    kept = top_per_group(log, [entity], latest_first, n + 1, "step")
    w = Window.partitionBy(entity).orderBy(*latest_first)
    return kept.withColumn("previous", F.lead(col(shown)).over(w)).where(F.col("step") <= n)


def recurring(log: DataFrame, by: Sequence[str], run: str, k: int) -> DataFrame:
    """The ``k`` most frequent failures, with the number of runs they appear in.

    Failures are counted per run first, so one run or check may hold most of the log.
    """
    per_run = log.groupBy(*by, run).agg(F.count("*").alias("n"))
    totals = per_run.groupBy(*by).agg(F.sum("n").alias("n_failures"), F.count("*").alias("n_runs"))
    return totals.orderBy(F.desc("n_failures"), *by).limit(k)


def run_manifest(runs: DataFrame, fields: Sequence[str], at: str) -> DataFrame:
    """One row per distinct setting, with its fingerprint and its repeats in time."""
    # the JSON form keeps NULL apart from any text and shows where a field ends
    record = F.to_json(F.struct(*[col(f).cast("string").alias(f) for f in fields]), {"ignoreNullFields": "false"})
    counted = runs.groupBy(*fields).agg(
        F.count("*").alias("n_runs"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )
    return counted.withColumn("fingerprint", F.sha2(record, 256))


def scorecard(scores: DataFrame, model: str, criteria: Sequence[str]) -> DataFrame:
    """Mean of each criterion per model and the overall position, ties in name order."""
    means = scores.groupBy(model).agg(
        F.count("*").alias("n"), *[F.avg(col(c)).alias(f"mean_{c}") for c in criteria]
    )
    overall = X.added([F.col(f"mean_{c}") for c in criteria]) / len(criteria)
    rated = means.withColumn("overall", F.round(overall, 9))
    placed = row_numbers(rated, [F.desc("overall"), F.asc(model)], "position")
    return placed.withColumn("position", F.col("position") + 1)


def ranked_match(docs: DataFrame, key: str, text: str, query: str, k: int) -> DataFrame:
    """The ``k`` texts that answer a description best, by summed TF-IDF.

    Words outside the query are dropped before any row is exploded, and the counts of
    the rest are kept as a narrow table, so the texts are read once.
    """
    wanted = sorted(set(X.words_of(query)))
    words = F.filter(X.tokens_of(col(text)), lambda w: w.isin(*wanted))
    hits = docs.select(col(key), F.explode(words).alias("term")).groupBy(key, "term").agg(
        F.count("*").alias("tf")
    )
    hits = materialize(hits)
    total = docs.agg(F.count("*")).scalar()
    # one row per query word
    rarity = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.ln((total + 1) / (F.col("df") + 1)) + 1
    weighed = hits.join(F.broadcast(rarity), "term").groupBy(key).agg(
        F.round(F.sum(F.col("tf") * idf), 9).alias("score"), F.count("*").alias("n_terms")
    )
    return weighed.orderBy(F.desc("score"), key).limit(k)
