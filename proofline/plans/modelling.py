"""Fit the same model on two feature sets and compare them on the same held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.operators.clean import drop_missing, impute
from proofline.operators.evaluate import Logit, binary_metrics, compare_models, fit_logit, split
from proofline.operators.features import feat, one_hot, scale
from proofline.session import materialize


Fit = Callable[[DataFrame, Sequence[str], str], Logit]


def evaluate_set(df: DataFrame, key: str, label: str, cols: Sequence[str], name: str, fit: Fit = fit_logit) -> DataFrame:
    """Metrics of one feature set on the test side: feature_set, n, accuracy, f1, auc.

    Fill values and scaling statistics come from the training side alone.
    """
    rows = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in cols])
    train, _ = split(rows, key)
    filled = impute(rows, {c: "mean" for c in cols}, fit_on=train)
    filled_train, _ = split(filled, key)
    ready = scale(filled, cols, fit_on=filled_train)
    scaled = [feat(f"{c}_standard") for c in cols]
    # a column without spread has no scaled value and tells a model nothing
    ready = materialize(ready.select(key, label, *scaled).fillna(0.0, scaled))
    train, test = split(ready, key)
    model = fit(train, scaled, label)
    metrics = binary_metrics(model.score(test), label, "score")
    return metrics.select(F.lit(name).alias("feature_set"), "n", "accuracy", "f1", "auc")


def rushed_set(
    df: DataFrame, key: str, label: str, numbers: Sequence[str], categories: Sequence[str] = (), name: str = "rushed", fit: Fit = fit_logit
) -> DataFrame:
    """Metrics of the quick way: rows with missing values dropped, categories one-hot, numbers scaled."""
    rows = materialize(drop_missing(df.select(key, label, *numbers, *categories)))
    train, _ = split(rows, key)
    made = rows
    for c in categories:
        made = one_hot(made, c, fit_on=train)
    ready = scale(made, numbers, fit_on=train)
    used = [c for c in ready.columns if c not in rows.columns]
    ready = materialize(ready.select(key, label, *used).fillna(0.0, used))
    train, test = split(ready, key)
    model = fit(train, used, label)
    metrics = binary_metrics(model.score(test), label, "score")
    return metrics.select(F.lit(name).alias("feature_set"), "n", "accuracy", "f1", "auc")


def published_row(spark: SparkSession, accuracy: float, f1: float, auc: float, n: int | None = None) -> DataFrame:
    """Metrics that others have published, to stand beside one's own."""
    return spark.createDataFrame(
        [("published", n, accuracy, f1, auc)], "feature_set string, n long, accuracy double, f1 double, auc double"
    )


def compare_feature_sets(
    df: DataFrame, key: str, label: str, sets: Mapping[str, Sequence[str]], more: Sequence[DataFrame] = (), fit: Fit = fit_logit
) -> DataFrame:
    """Comparison table over named feature sets, one of them called ``baseline``.

    ``more`` are rows of metrics from elsewhere: ``rushed_set``, ``published_row``.

    ``fit`` is how models are fitted: ``fit_logit``, or ``fit_newton`` for few features.

    The features are computed once and kept as a narrow table, as fitting reads its rows
    several times.
    """
    used = sorted({c for cols in sets.values() for c in cols})
    narrow = materialize(df.select(key, label, *used))
    measured = [evaluate_set(narrow, key, label, cols, name, fit) for name, cols in sets.items()]
    return compare_models(reduce(DataFrame.unionByName, [*measured, *more]))
