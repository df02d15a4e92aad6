from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from proofline.llm import search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def by_force(docs, items, k=20):
    """Every document scored for every item."""
    split = [(i, Counter(TERMS.findall((t or "").translate(UPPER)))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    n_docs, words = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    found = []
    for item, text in items:
        terms = TERMS.findall((text or "").translate(UPPER))
        scored = []
        for i, c in split:
            m = 75 + (25 * sum(c.values()) * n_docs) // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i, score))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item, rank, s[2], s[3]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def found(spark, docs, items, **more):
    asked = spark.createDataFrame([(i, t, "x", 1.5) for i, t in items], "item_id long, text string, key string, score double")
    return sorted(map(tuple, search.search(docs, asked, **more).collect()), key=repr)


@pytest.mark.parametrize(("segment", "block", "share"), [(4096, 64, 0.5), (16, 2, 0.0), (50, 8, 100.0), (40, 4, 0.3)])
def test_best_of_all_documents(spark, docs_of, monkeypatch, segment, block, share):
    for name, value in (("SEGMENT_DOCS", segment), ("BLOCK_DOCS", block), ("SHORT_SHARE", share)):
        monkeypatch.setattr(search, name, value)
    draw = random.Random(segment)
    vocabulary = ["the", "Of", "é", "x9", *("".join(draw.choices("abcdeÀß", k=3)) for _ in range(60))]
    weights = [40, 30, 20, 10, *[1 + 8 / (i + 1) for i in range(60)]]
    docs = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([0, 1, 5, 40, 400])))) for i in range(300)]
    items = [(j, "-".join(draw.choices(vocabulary, weights, k=draw.choice([1, 3, 20])))) for j in range(12)]
    assert found(spark, docs_of(docs), items) == by_force(docs, items)
    assert found(spark, docs_of(docs), items[:3], k=3) == by_force(docs, items[:3], k=3)


def test_blocks_of_searches(spark, docs_of, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 40)
    docs = [(i, f"w{i % 7} w{i % 5} common") for i in range(60)]
    items = [(j, f"w{j} common w{j + 1} absent") for j in range(8)]
    assert found(spark, docs_of(docs), items) == by_force(docs, items)


def test_odd_rows(spark, docs_of):
    docs = [
        (1, None), (2, ""), (3, " .,;"), (4, "Ünder ÜNDER under"), (5, "a b"), (5, "a b"), (None, "a b"), (None, "b a"), (6, "A\tB\x00c"),
        (7, "b " * 30_000), (8, "common a"), (9, "10-20 x_y"),
    ]
    items = [(1, "a A b"), (2, None), (3, "..."), (4, "nothing"), (None, "under ÜNDER"), (1, "x y 10"), (5, "a a a a")]
    got = found(spark, docs_of(docs), items)
    assert got == by_force(docs, items)
    # an item that comes twice counts once
    assert found(spark, docs_of(docs), [*items, (5, "a a a a")]) == got


def test_a_term_of_all_documents_weighs_nothing(spark, docs_of):
    docs = [(i, "every" if i else "every one") for i in range(2000)]
    assert by_force(docs, [(1, "every")]) == [] == found(spark, docs_of(docs), [(1, "every")])


def test_empty_tables(spark, docs_of):
    assert found(spark, docs_of([]), [(1, "a")]) == []
    assert found(spark, docs_of([(1, "a")]), []) == []
    assert found(spark, docs_of([(1, "")]), [(1, "a")]) == []
