"""Split, fit, score and compare binary classifiers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.expressions import col, free_names
from proofline.functions.longform import rows_of
from proofline.functions.ordered import running_totals
from proofline.session import materialize


def bucket(key: str, seed: int = 42) -> Column:
    """A bucket from 0 to 99 that depends on the key alone."""
    digest = F.md5(F.concat(col(key).cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def split(df: DataFrame, key: str, pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """train and test side; a row's side never depends on partitioning."""
    side = bucket(key, seed) < pct
    return df.where(side), df.where(~side)


@dataclass(frozen=True)
class Logit:
    """A fitted logistic regression, applied as a plain column expression."""

    columns: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def probability(self) -> Column:
        z = F.lit(self.intercept)
        for name, weight in zip(self.columns, self.weights):
            z = z + F.lit(weight) * col(name).cast("double")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        return df.withColumn(name, self.probability())


def fit_logit(
    train: DataFrame, cols: Sequence[str], label: str, max_iter: int = 50, reg: float = 0.0
) -> Logit:
    """logistic regression. Fill missing values first; a NULL feature raises."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    rows = assembler.transform(train.select(*[col(c).cast("double").alias(c) for c in [*cols, label]]))
    fitted = LogisticRegression(
        labelCol=label, maxIter=max_iter, regParam=reg, aggregationDepth=3
    ).fit(rows.select("features", label))
    return Logit(tuple(cols), tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def fit_newton(train: DataFrame, cols: Sequence[str], label: str, steps: int = 8, reg: float = 1e-3) -> Logit:
    """F2 by Newton's method, for a handful of features: every step is one aggregate of the rows.

    A step gathers the gradient and the matrix of second derivatives, (features + 1)^2 / 2 means,
    and solves them on the driver. The penalty ``reg`` / 2 on the squared weights, not on the
    intercept, keeps the matrix away from zero where the classes can be told apart entirely.
    The number of steps is fixed, so a fit is a plain formula over the rows. Keep ``train`` as a
    table: it is read once a step. Fill missing values first; a row with one is left out.
    """
    size = len(cols) + 1
    x = [F.lit(1.0), *[col(c).cast("double") for c in cols]]
    weights = [0.0] * size
    for _ in range(steps):
        z = X.added([F.lit(w) * v for w, v in zip(weights, x)])
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        miss, curve = col(label).cast("double") - p, p * (F.lit(1.0) - p)
        row = train.agg(
            *[F.avg(miss * x[i]).alias(f"g{i}") for i in range(size)],
            *[F.avg(curve * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(size) for j in range(i, size)],
        ).first()
        if row["g0"] is None:
            raise ValueError("no rows to fit")
        penalty = [0.0] + [reg] * len(cols)
        gradient = [row[f"g{i}"] - penalty[i] * weights[i] for i in range(size)]
        matrix = [[row[f"h{min(i, j)}_{max(i, j)}"] + (penalty[i] if i == j else 0.0) for j in range(size)] for i in range(size)]
        weights = [w + s for w, s in zip(weights, _solved(matrix, gradient))]
    return Logit(tuple(cols), tuple(weights[1:]), weights[0])


def _solved(matrix: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a small positive definite system, by elimination in the given order."""
    size = len(right)
    matrix, right = [list(row) for row in matrix], list(right)
    for c in range(size):
        for r in range(c + 1, size):
            factor = matrix[r][c] / matrix[c][c]
            matrix[r] = [a - factor * b for a, b in zip(matrix[r], matrix[c])]
            right[r] -= factor * right[c]
    found = [0.0] * size
    for r in reversed(range(size)):
        found[r] = (right[r] - sum(matrix[r][j] * found[j] for j in range(r + 1, size))) / matrix[r][r]
    return found


def fit_sparse_logit(
    train: DataFrame, cols: Sequence[str], label: str, max_iter: int = 50, reg: float = 0.0
) -> Callable[[DataFrame, str], DataFrame]:
    """F2 on numbers and sparse vectors alike; returns what adds a score column to a table.

    Weights of a vector with very many places stay in the model, where ``Logit`` would
    spell out a column expression for each.
    """
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    rows = assembler.transform(train.select(*[col(c) for c in cols], col(label).cast("double").alias(label)))
    fitted = LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg, aggregationDepth=3).fit(rows.select("features", label))

    def score(df: DataFrame, name: str = "score") -> DataFrame:
        features, raw, probability, prediction = free_names(df, ["features", "raw", "probability", "prediction"])
        ready = VectorAssembler(inputCols=list(cols), outputCol=features).transform(df)
        model = fitted.copy().setFeaturesCol(features).setRawPredictionCol(raw).setProbabilityCol(probability).setPredictionCol(prediction)
        scored = model.transform(ready).withColumn(name, vector_to_array(probability)[1])
        return scored.drop(features, raw, probability, prediction)

    return score


def auc_table(df: DataFrame, scores: Sequence[str], label: str) -> DataFrame:
    """Area under the curve per score column, ties counted as half.

    Rows shrink to one per distinct score before they are ordered, and the order is cut
    into ranges, so neither a frequent score nor a near-unique one fills a single task.
    """
    narrow = df.select(
        col(label).cast("bigint").alias("label"), *[X.present(df, c).cast("double").alias(c) for c in scores]
    )
    cells = narrow.unpivot(["label"], [col(c) for c in scores], "score_name", "value").where(
        F.col("value").isNotNull() & F.col("label").isNotNull()
    )
    counts = cells.groupBy("score_name", "value").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")
    )
    placed = running_totals(
        counts, ["score_name", "value"], {"below": "neg"}, within=["score_name"]
    )
    totals = placed.groupBy("score_name").agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("wins"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )
    auc = F.try_divide(F.col("wins"), F.col("n_pos").cast("double") * F.col("n_neg"))
    return totals.select("score_name", "n_pos", "n_neg", auc.alias("auc"))


def metrics_table(scored: DataFrame, label: str, thresholds: Mapping[str, float]) -> DataFrame:
    """F3 for several score columns, a row each: score_name, n, accuracy, f1, auc.

    One aggregate counts the hits of all of them and one order of their values gives the
    areas. ``scored`` is read twice; keep it as a table if it is costly.
    """
    actual = col(label).cast("int")
    aggs = []
    for i, (score, threshold) in enumerate(thresholds.items()):
        value = X.present(scored, score)
        known = value.isNotNull() & actual.isNotNull()
        hit = value >= threshold
        aggs += [
            F.count_if(known).alias(f"n{i}"),
            F.count_if(known & hit & (actual == 1)).alias(f"tp{i}"),
            F.count_if(known & hit & (actual == 0)).alias(f"fp{i}"),
            F.count_if(known & ~hit & (actual == 1)).alias(f"fn{i}"),
        ]
    counts = rows_of(
        scored.agg(*aggs),
        [
            {"score_name": F.lit(s), **{part: F.col(f"{part}{i}") for part in ("n", "tp", "fp", "fn")}}
            for i, s in enumerate(thresholds)
        ],
    )
    areas = auc_table(scored, list(thresholds), label).select("score_name", "auc")
    tp2, wrong = F.col("tp") * 2, F.col("fp") + F.col("fn")
    # one row per score on both sides
    return counts.join(F.broadcast(areas), "score_name", "left").select(
        "score_name",
        "n",
        F.try_divide((F.col("n") - wrong).cast("double"), F.col("n")).alias("accuracy"),
        F.try_divide(tp2.cast("double"), tp2 + wrong).alias("f1"),
        "auc",
    )


def binary_metrics(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """accuracy, F1 and AUC of scored rows."""
    return metrics_table(scored, label, {score: threshold}).drop("score_name")


def compare_models(metrics: DataFrame, baseline: str = "baseline") -> DataFrame:
    """metrics per feature set with the lift over the baseline in points.

    ``metrics`` holds one row per feature set: feature_set, accuracy, f1, auc. It is
    computed once, as the baseline row is read again for every other row.
    """
    metrics = materialize(metrics)
    base = metrics.where(F.col("feature_set") == baseline).select(F.struct("accuracy", "f1", "auc")).scalar()
    return metrics.select(
        "feature_set",
        "accuracy",
        "f1",
        "auc",
        *[((F.col(m) - base[m]) * 100).alias(f"{m}_lift") for m in ("accuracy", "f1", "auc")],
    )
