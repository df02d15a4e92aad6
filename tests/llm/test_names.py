"""Stages of the pipeline on tables whose other columns have the names that the stages use."""

from __future__ import annotations

import pytest

from proofline.llm import decontaminate, neardups, secrets

ROWS = [(1, "password = hunter2hunter2 and more words"), (2, None), (2, "one two three four five six seven eight"), (None, "x"), (3, "")]
NAMES = "__doc_id long, __key long, __spans string, found_doc_id long, _found_key int, found_spans int, kept_key long, row long, key long, spans string"


@pytest.fixture(scope="module")
def clashing(docs_of):
    return docs_of(ROWS, extra=NAMES)


def test_redaction(clashing):
    made = secrets.redacted(clashing)
    assert made.columns == clashing.columns
    assert sorted(r["text"] or "" for r in made.collect()) == ["", "", "[assign] and more words", "one two three four five six seven eight", "x"]


def test_near_duplicates(clashing):
    kept = neardups.without_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(["", ROWS[0][1], ROWS[2][1], "x"])


def test_decontamination(spark, clashing):
    items = spark.createDataFrame([(7, "two three four five six seven", "q")], "item_id long, text string, key string")
    kept = decontaminate.without_leaks(clashing, items)
    assert kept.columns == clashing.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(["", "", ROWS[0][1], "x"])
