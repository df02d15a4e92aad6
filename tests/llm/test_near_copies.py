"""Near copies against the Jaccard similarity of all pairs of texts, whatever makes them candidates."""

from __future__ import annotations

import random

import numpy as np
import pytest

from proofline.llm import neardups
from tests.llm.test_similar import kept_of_all_pairs


def edited_texts(seed):
    """Groups of copies with edited words, on both sides of the similarity, with phrases that many share."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    phrase = draw.choices(vocabulary, k=40)
    rows, number = [], 0
    for _ in range(25):
        base = draw.choices(vocabulary, k=draw.choice([6, 60, 150, 300])) + phrase[: draw.choice([0, 12, 40])]
        for _ in range(draw.choice([1, 2, 5, 25])):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2, 4, 6])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((number, " ".join(words)))
            number += 1
    return rows


@pytest.mark.parametrize("seed, block", [(8, 200_000), (2, 600), (3, 1)])
def test_no_near_copy_is_missed(spark, docs_of, monkeypatch, seed, block):
    monkeypatch.setattr(neardups, "BLOCK_SHINGLES", block)
    rows = edited_texts(seed)
    got = sorted(r["doc_id"] for r in neardups.without_near_duplicates(docs_of(rows)).collect())
    assert got == kept_of_all_pairs(rows)
    assert len(got) < 0.8 * len(rows)


def test_no_near_copy_of_the_given_table_is_missed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 2 = 0")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = sorted(r["doc_id"] for r in neardups.without_near_duplicates(docs).collect())
    assert got == kept_of_all_pairs(rows)


def test_no_estimate_decides_before_the_similarity():
    # 8 in common of 10 are exactly 0.8
    draw = np.random.default_rng(9)
    for _ in range(3000):
        both = draw.integers(0, 2**62, 10, dtype=np.uint64)
        a, b = np.unique(both[:9]), np.unique(both[1:])
        assert neardups.similar_pairs([a, b], 0.8) == [(0, 1)]


def near_copies(n):
    """Texts of 150 words with two edits each: most pairs are just below the similarity."""
    draw = random.Random(1)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    base = draw.choices(vocabulary, k=150)
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(2):
            words[draw.randrange(150)] = draw.choice(vocabulary)
        rows.append((i, " ".join(words)))
    return rows


def test_near_copies_meet_once(spark, docs_of):
    sent = {}
    for n in (300, 1200):
        named = docs_of(near_copies(n)).select("doc_id", "text")
        shared = spark.sparkContext.broadcast(neardups.frequencies(named))
        schema = "doc_id long, key long, key2 long, size int, firsts binary"
        rows = named.select("doc_id", *neardups._keys(named["text"]), "text").mapInArrow(neardups._prefixed(shared, 0.8), schema)
        sent[n] = neardups._cells(rows.withColumnRenamed("doc_id", "node"), 0.8).count()
    # about a text's place in one cell each, not in one for every shingle of its prefix
    assert sent[1200] <= 5 * sent[300]
    assert sent[1200] <= 6 * 1200


def test_a_large_group_of_near_copies(spark, docs_of):
    rows = near_copies(400)
    got = sorted(r["doc_id"] for r in neardups.without_near_duplicates(docs_of(rows)).collect())
    assert got == kept_of_all_pairs(rows)
