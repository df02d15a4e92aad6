"""SimHash in the search for near copies: what it finds, what its check refuses, and what it spares the prefix filter."""

from __future__ import annotations

import functools
import random

import pytest

import corpus_pipeline
from proofline.llm import neardups, simhash
from tests.llm.test_similar import kept_of_all_pairs, shingles_of


def texts(seed):
    """Texts with copies of few edits, of more edits, and pairs whose fingerprints agree although their words do not."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    made = []
    for _ in range(20):
        base = draw.choices(vocabulary, k=300)
        for edits in (0, 1, 1, 2, 8):
            words = list(base)
            for _ in range(edits):
                words[draw.randrange(300)] = draw.choice(vocabulary)
            made.append(" ".join(words))
        # one line again and again decides all bits, but few of the different shingles
        line = draw.choices(vocabulary, k=7)
        made += [" ".join(line * 60 + draw.choices(vocabulary, k=20)) for _ in range(2)]
    draw.shuffle(made)
    return list(enumerate(made))


fingerprint = functools.cache(simhash.fingerprint)
shingles = functools.cache(shingles_of)


def bits(a, b):
    return (fingerprint(a) ^ fingerprint(b)).bit_count()


def alike(a, b):
    return len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b))


def kept_by_prints(rows):
    """The least ids of the groups that similar texts of a SimHash group make."""

    def grouped(near):
        root = {i: i for i, _ in rows}
        for i, a in rows:
            for j, b in rows[:i]:
                if root[i] != root[j] and near(i, a, j, b):
                    low, high = sorted((root[i], root[j]))
                    root = {k: low if r == high else r for k, r in root.items()}
        return root

    group = grouped(lambda i, a, j, b: bits(a, b) <= simhash.MAX_BITS)
    root = grouped(lambda i, a, j, b: group[i] == group[j] and alike(a, b))
    return sorted(set(root.values()))


def ids(table):
    return sorted(r["doc_id"] for r in table.collect())


@pytest.fixture
def no_filter(spark, monkeypatch):
    """The prefix filter finds nothing."""
    none = spark.createDataFrame([], "cell long, node long")
    monkeypatch.setattr(neardups, "_cells", lambda *_: none)


def test_the_stage_finds_near_copies_by_simhash(spark, docs_of, no_filter):
    rows = texts(5)
    got = ids(corpus_pipeline.drop_near_duplicates(spark, docs_of(rows), ""))
    assert got == kept_by_prints(rows)
    assert len({t for _, t in rows}) - len(got) >= 15


def test_the_stage_looks_at_the_fingerprints_of_all_texts(spark, docs_of, monkeypatch):
    seen = []
    search = simhash.links
    monkeypatch.setattr(simhash, "links", lambda prints, *more: seen.append(prints) or search(prints, *more))
    rows = [*texts(6)[:30], (30, None), (31, " "), (32, "short"), (None, "without an id")]
    corpus_pipeline.drop_near_duplicates(spark, docs_of(rows), "")
    want = {simhash.fingerprint(t or "") for _, t in rows}
    assert {r["fingerprint"] % 2**64 for made in seen for r in made.collect()} == want


@pytest.mark.parametrize("block", [200_000, 1000])
def test_fingerprints_neither_lose_nor_remove_more(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(neardups, "BLOCK_SHINGLES", block)
    rows = texts(7)
    pairs = [(a, b) for i, a in rows for _, b in rows[:i]]
    far = [p for p in pairs if alike(*p) and bits(*p) > simhash.MAX_BITS]
    unlike = [p for p in pairs if bits(*p) <= simhash.MAX_BITS and not alike(*p)]
    assert far and unlike
    got = ids(corpus_pipeline.drop_near_duplicates(spark, docs_of(rows), ""))
    assert got == kept_of_all_pairs(rows)


def test_a_large_simhash_group_is_connected_across_its_blocks(spark, docs_of, monkeypatch, no_filter):
    monkeypatch.setattr(neardups, "BLOCK_SHINGLES", 2000)
    base = ["".join(random.Random(i).choices("abcdefghij", k=6)) for i in range(1000)]
    rows = [(i, " ".join([*base, f"tail{i}"])) for i in range(40)]
    assert all(bits(rows[0][1], t) <= simhash.MAX_BITS for _, t in rows)
    assert ids(neardups.without_near_duplicates(docs_of(rows))) == [0]


def test_what_simhash_connects_does_not_meet_again(spark, docs_of):
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    # a large and a small group of near copies, and a pair that is not connected yet
    rows, number = [], 0
    for size in (40, 5, 2):
        base = draw.choices(vocabulary, k=200)
        for _ in range(size):
            words = list(base)
            words[draw.randrange(200)] = draw.choice(vocabulary)
            rows.append((number, " ".join(words)))
            number += 1
    named = docs_of(rows).select("doc_id", "text")
    shared = spark.sparkContext.broadcast(neardups.frequencies(named))
    schema = "doc_id long, key long, key2 long, size int, firsts binary"
    single = named.select("doc_id", *neardups._keys(named["text"]), "text").mapInArrow(neardups._prefixed(shared, 0.8), schema)
    single = single.withColumnRenamed("doc_id", "node")
    rooted = spark.createDataFrame([(i, 0) for i in range(40)] + [(i, 40) for i in range(40, 45)], "node long, root long")
    assert {r["node"] for r in neardups._cells(single, 0.8).collect()} == set(range(47))
    assert {r["node"] for r in neardups._cells(single, 0.8, rooted).collect()} == {45, 46}
