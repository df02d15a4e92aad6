"""The whole way from a messy credit table to compared models."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from proofline.operators import features as E
from proofline.operators.clean import Step, compare_tables
from proofline.operators.profile import ProfileRules, cryptic_names
from proofline.plans.modelling import compare_feature_sets
from proofline.plans.preparation import Recipe, prepare

NAMES = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
NAMES += [f"PAY_{i}" for i in range(1, 7)] + [f"BILL_AMT{i}" for i in range(1, 7)] + [f"PAY_AMT{i}" for i in range(1, 7)]


def credit_rows(n=300):
    """Rows of the shape 23 attributes and a target, clean and messy side by side."""
    rng = random.Random(42)
    clean, messy = [], []
    for i in range(n):
        limit = rng.choice([10_000, 20_000, 50_000, 200_000, 0])
        bills = [rng.randint(0, 60_000) for _ in range(6)]
        row = [limit, rng.randint(1, 2), rng.choice(["university", "graduate", "school"]), rng.randint(1, 3), rng.randint(21, 70)]
        row += [rng.randint(-2, 4) for _ in range(6)] + bills + [rng.randint(0, 9000) for _ in range(6)]
        target = int(limit > 0 and bills[0] / limit > 1.0) if rng.random() < 0.9 else rng.randint(0, 1)
        clean.append((i, *row, target))
        dirty = [str(v) for v in row]
        for j in range(len(dirty)):
            if rng.random() < 0.05:
                dirty[j] = "?"
        if dirty[2] != "?" and i % 10 == 0:
            dirty[2] = dirty[2].upper() + " "
        messy.append((str(i), *dirty, str(target)))
    return clean, messy


def recipe():
    names = {f"X{i + 1}": n for i, n in enumerate(NAMES)}
    numbers = [n for n in NAMES if n != "EDUCATION"]
    return Recipe(
        key="ID",
        names={**names, "Y": "DEFAULT"},
        types={"ID": "bigint", **{n: "bigint" for n in numbers}, "DEFAULT": "int", "EDUCATION": "string"},
        steps=[Step("EDUCATION", "fold case", "one spelling per level", lambda c: F.lower(F.trim(c)))],
        fills={**{n: "median" for n in numbers}, "EDUCATION": "mode"},
        rules=ProfileRules(categories=["EDUCATION"]),
    )


def raw_table(spark, messy):
    header = ["ID", *[f"X{i}" for i in range(1, 24)], "Y"]
    return spark.createDataFrame(messy, ", ".join(f"c{i} string" for i in range(25))), header


def test_messy_table_becomes_the_clean_one(spark, tmp_path):
    clean, messy = credit_rows()
    raw, header = raw_table(spark, messy)
    assert cryptic_names(spark, header).where("is_cryptic").count() == 23
    made = prepare(raw, recipe(), header)

    issues = {(r["column_name"], r["issue"]) for r in made.issues.collect()}
    assert ("EDUCATION", "mixed_casing") in issues
    assert ("LIMIT_BAL", "masked_null") in issues

    schema = "ID bigint, " + ", ".join(f"{n} {'string' if n == 'EDUCATION' else 'bigint'}" for n in NAMES) + ", DEFAULT int"
    truth = spark.createDataFrame(clean, schema)
    # rows, missing values and types all match the published table
    facts = compare_tables(made.table, truth).collect()
    assert len(facts) == 25
    assert all(r["same_rows"] and r["same_missing"] and r["same_type"] for r in facts)

    masked = {r["column_name"]: r["n_nulled"] for r in made.changes.where("what = 'masked null to NULL'").collect()}
    assert masked["LIMIT_BAL"] == sum(m[1] == "?" for m in messy)
    assert made.mistakes.count() == 0
    flagged = {r["column_name"] for r in made.handoff.where("sensitive").collect()}
    assert flagged == {"SEX", "EDUCATION", "MARRIAGE", "AGE"}

    made.write(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out" / "table"))
    assert back.count() == 300
    assert spark.read.json(str(tmp_path / "out" / "handoff")).where("sensitive").count() == 4
    assert json.loads(json.dumps(back.schema["AGE"].metadata))["sensitive"] is True
    # sensitive columns are left out of the plan
    planned = {r["column_name"] for r in E.plan_features(made.profile).collect()}
    assert not planned & flagged


def test_engineered_features_lift_the_model(spark):
    clean, _ = credit_rows()
    schema = "ID bigint, " + ", ".join(f"{n} {'string' if n == 'EDUCATION' else 'bigint'}" for n in NAMES) + ", DEFAULT int"
    table = spark.createDataFrame(clean, schema)
    made = E.ratio(table, "BILL_AMT1", "LIMIT_BAL", "bill_to_limit_ratio")
    made = E.row_aggregates(made, [f"BILL_AMT{i}" for i in range(1, 7)], "bills")
    zero = made.where("LIMIT_BAL = 0")
    assert zero.count() > 0 and zero.where("feat_bill_to_limit_ratio IS NOT NULL").isEmpty()
    sets = {
        "baseline": ["BILL_AMT1", "LIMIT_BAL", "AGE"],
        "engineered": ["BILL_AMT1", "LIMIT_BAL", "AGE", "feat_bill_to_limit_ratio", "feat_bills_mean"],
    }
    rows = {r["feature_set"]: r for r in compare_feature_sets(made, "ID", "DEFAULT", sets).collect()}
    assert rows["baseline"]["auc_lift"] == 0.0
    assert rows["engineered"]["auc"] > rows["baseline"]["auc"]
