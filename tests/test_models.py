"""Fits, levels and modes against plain versions."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from proofline.operators import clean, evaluate, features
from proofline.session import materialize


def labelled(spark, n=400, seed=1):
    draw = random.Random(seed)
    rows = [(i, a := draw.gauss(0, 1), b := draw.gauss(0, 2), int(a - b / 2 + draw.gauss(0, 1) > 0)) for i in range(n)]
    return rows, materialize(spark.createDataFrame(rows, "id long, a double, b double, y int"))


def test_elimination_solves():
    draw = np.random.default_rng(1)
    for size in (1, 2, 5):
        half = draw.normal(size=(size, size))
        matrix, right = half @ half.T + np.eye(size), draw.normal(size=size)
        assert np.allclose(evaluate._solved(matrix.tolist(), right.tolist()), np.linalg.solve(matrix, right))


def test_newton_finds_the_best_weights(spark):
    rows, df = labelled(spark)
    model = evaluate.fit_newton(df, ["a", "b"], "y", reg=0.01)
    x = np.array([[1.0, r[1], r[2]] for r in rows])
    y = np.array([r[3] for r in rows])
    weights = np.array([model.intercept, *model.weights])
    p = 1 / (1 + np.exp(-x @ weights))
    assert np.abs(((y - p)[:, None] * x).mean(axis=0) - 0.01 * np.array([0, *model.weights])).max() < 1e-10
    other = evaluate.fit_logit(df, ["a", "b"], "y", reg=0.0)
    free = evaluate.fit_newton(df, ["a", "b"], "y", reg=0.0)
    assert np.allclose(free.weights, other.weights, atol=1e-3)


def test_newton_with_classes_apart(spark):
    df = materialize(spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "x double, y int"))
    model = evaluate.fit_newton(df, ["x"], "y")
    assert all((r["score"] > 0.5) == (r["y"] == 1) for r in model.score(df).collect())
    with pytest.raises(ValueError, match="no rows"):
        evaluate.fit_newton(df.where("false"), ["x"], "y")


def test_modes_of_many_columns_in_their_own_order(spark):
    rows = [
        (10, "b", 2.5, datetime.date(2024, 1, 9), Decimal("10.0")),
        (9, "a", float("nan"), datetime.date(2023, 12, 31), Decimal("9.5")),
        (10, "a", float("nan"), None, None),
        (9, "b", 10.0, None, None),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "n long, s string, d double, day date, m decimal(5,1)")
    found = df.limit(1).select([v.alias(c) for c, v in clean.fill_values(df, {c: "mode" for c in df.columns}).items()])
    # 9 goes before 10 as a number; NaN is missing
    assert found.first() == (9, "a", 2.5, datetime.date(2023, 12, 31), Decimal("9.5"))
    plan = clean.fill_values(df, {c: "mode" for c in df.columns})
    assert len(plan) == 5
    alone = clean.fill_values(df.where("n IS NULL"), {"n": "mode"})
    assert df.limit(1).select(alone["n"].alias("n")).first()["n"] is None


def test_many_levels_are_a_vector(spark, monkeypatch):
    monkeypatch.setattr(features, "LEVEL_COLUMNS", 3)
    train = spark.createDataFrame([(i, f"v{i:02}") for i in range(12)], "id int, place string")
    other = spark.createDataFrame([(1, "v03"), (2, "new"), (3, None), (4, "v11")], "id int, place string")
    made = features.one_hot(other, "place", fit_on=train)
    assert made.columns == ["id", "place", "feat_place_onehot"]
    vectors = {r["id"]: r["feat_place_onehot"] for r in made.collect()}
    assert {i: v.toArray().tolist() for i, v in vectors.items()} == {
        i: [float(j == at) for j in range(12)] for i, at in ((1, 3), (2, None), (3, None), (4, 11))
    }
    long = features.one_hot_long(other, ["id"], "place", train)
    assert sorted(map(tuple, long.collect())) == [(1, "v03", 3), (4, "v11", 11)]
    # few levels are columns, as ever
    few = features.one_hot(other, "place", fit_on=train.where("id < 2"))
    assert few.columns == ["id", "place", "feat_place_v00", "feat_place_v01"]


def test_no_levels_at_all(spark):
    df = spark.createDataFrame([(1, None)], "id int, place string")
    assert features.one_hot_sparse(df, "place").first()["feat_place_onehot"].toArray().sum() == 0


def test_a_fit_on_sparse_vectors(spark):
    df = spark.range(400).select("id", (F.col("id") % 40).cast("string").alias("place"), (F.col("id") % 40 < 20).cast("int").alias("y"), F.lit(1).alias("features"))
    ready = materialize(features.one_hot_sparse(df, "place"))
    score = evaluate.fit_sparse_logit(ready, ["feat_place_onehot"], "y", reg=0.001)
    scored = score(ready, "p")
    assert scored.columns == [*ready.columns, "p"]
    assert evaluate.binary_metrics(scored, "y", "p").first()["accuracy"] == 1.0
