"""Recall of benchmark items: many of them, long ones and repetitive ones."""

from __future__ import annotations

import numpy as np
import pytest

from proofline.llm import decontaminate
from tests.llm.test_learned import plain_common


def planted(spark, docs_of, items, rows):
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    return sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs_of(rows), benchmark).collect())


def speaker(seed):
    draw = np.random.default_rng(seed)
    vocabulary = ["".join(draw.choice(list("abcdefghij"), 6)) for _ in range(5000)]
    return draw, lambda n: draw.choice(vocabulary, n).tolist()


def test_many_items_are_found(spark, docs_of):
    draw, say = speaker(21)
    items = [say(int(draw.integers(16, 60))) for _ in range(2000)]
    rows = []
    for i, own in enumerate(items):
        told = list(own)
        if i % 2:
            for k in range(3, len(told), 8):
                told[k] = "changed"
            assert plain_common(own, told) >= decontaminate.STRONG * len(own)
        rows.append((i, " ".join(say(int(draw.integers(0, 60))) + told + say(30))))
    assert planted(spark, docs_of, items, rows) == [(i, i) for i in range(2000)]


@pytest.mark.parametrize("at_once", [100_000, 2])
def test_short_items_are_found_as_sequences(spark, docs_of, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "SHORT_AT_ONCE", at_once)
    draw, say = speaker(23)
    items = [(1, "gamma", None), (2, "two plus two", ""), (3, "who wrote it now", "the quiet author"), (4, "two plus two", None), (5, "...", None), (None, "no id", None)]
    answered = f"{' '.join(say(40))} Who wrote it now? {' '.join(say(9))} The QUIET author"
    rows = [
        (0, None),
        (1, "GAMMA"),
        (2, f"{' '.join(say(30))} two, plus two"),
        (3, "two plus; minus two plus"),
        (4, answered),
        (5, "who wrote it now " + " ".join(say(80)) + " the quiet author"),
        (6, "who wrote it not now: the quiet author"),
        (7, "word " * 50_000 + "two plus two " * 1000),
        (7, "gammas"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string, answer string")
    got = decontaminate.contaminated(docs_of(rows), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["word_share"]) for r in got) == [(1, 1, 1.0), (2, 2, 1.0), (2, 4, 1.0), (4, 3, 1.0), (7, 2, 1.0), (7, 4, 1.0)]
    # beside long items
    long = say(20)
    both = spark.createDataFrame([*items, (9, " ".join(long), None)], benchmark.schema)
    got = decontaminate.contaminated(docs_of([*rows, (9, " ".join([*say(9), *long]))]), both).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 2), (2, 4), (4, 3), (7, 2), (7, 4), (9, 9)]


def test_long_and_repetitive_items_are_found(spark, docs_of):
    draw, say = speaker(22)
    items = [say(n) for n in (65, 100, 300, 400, 400, 1000, 3000)]
    # few words over and over
    items += [say(4) * 8 for _ in range(3)]
    rows = [(i, " ".join(say(int(draw.integers(5, 60))) + own + say(40))) for i, own in enumerate(items)]
    rows += [(100, " ".join(items[3][:150]))]
    assert planted(spark, docs_of, items, rows) == [(i, i) for i in range(len(items))]
