from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from proofline.llm import collocations as C

UPPER = {c: c + 32 for c in range(65, 91)}


def by_force(rows, least=10, first=2000):
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if any(100 * b >= 50 * a for q, b in cands.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            phrase = " ".join(p)
            rows.append((-score, -a, phrase.encode(), phrase, a, left, right, n, score))
        found += [(lang, rank, *r[3:]) for rank, r in enumerate(sorted(rows)[:first], 1)]
    return sorted(found)


def found(spark, rows, **more):
    docs = spark.createDataFrame([(1, la, t, 5, "p") for la, t in rows], "n int, lang string, text string, score long, phrase string").repartition(5)
    return sorted(map(tuple, C.collocations(docs, **more).collect()))


def corpus(seed):
    draw = random.Random(seed)
    words = ["the", "Of", "a", "new", "york", "é", "\x01b", "a\x01", "x-y", *("".join(draw.choices("abcß", k=2)) for _ in range(20))]
    weights = [30, 20, 10, *[3] * (len(words) - 3)]
    rows = []
    for _ in range(150):
        made = []
        for _ in range(draw.choice([0, 1, 5, 60])):
            made.append(draw.choice([" ".join(draw.choices(words, weights, k=2)), "New  york\tcity", "of the", "New York"]))
            made.append(draw.choice([" ", " ", "\t ", ". ", ",", "\n", "\r\n", "\x0b"]))
        rows.append((draw.choice(["en", "en", "en", "de", None, "und", ""]), "".join(made)))
    return rows


@pytest.mark.parametrize(("places", "held"), [(2_000_000, 400_000), (800, 50), (80, 5)])
def test_phrases(spark, monkeypatch, places, held):
    monkeypatch.setattr(C, "GROUP_PLACES", places)
    monkeypatch.setattr(C, "HELD", held)
    rows = corpus(places)
    wanted = by_force(rows)
    assert len(wanted) > 40
    assert found(spark, rows) == wanted


def test_long_subtrees_go_on_over_batches(spark, monkeypatch):
    # the rows of a batch that a worker gets
    monkeypatch.setattr(C, "ROWS", 7)
    rows = corpus(3)
    assert found(spark, rows, least=4, first=50) == by_force(rows, least=4, first=50)


def test_a_filter_that_is_full(spark, monkeypatch):
    monkeypatch.setattr(C, "FILTER_BITS", 64)
    rows = corpus(4)
    assert found(spark, rows) == by_force(rows)


def test_one_word_everywhere(spark):
    rows = [("en", "x " * 40_000), ("en", "x y " * 3000), (None, None), ("en", ""), ("de", "x y z")]
    assert found(spark, rows) == by_force(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", None), (None, "...")]) == []
