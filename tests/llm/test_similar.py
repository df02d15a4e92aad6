"""SimHash, vectors and components against brute force over all pairs."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from proofline.llm import covertree, neardups, simhash
from proofline.llm.components import components, forest
from proofline.llm.queries import ORACLES, QUERIES
from proofline.session import shared_dir
from tests.oracle import connect, difference, from_duck, from_spark


def least_reachable(linked, ids):
    label = np.array(ids)
    linked = linked | np.eye(len(ids), dtype=bool)
    while True:
        new = np.array([label[row].min() for row in linked])
        if (new == label).all():
            return label.tolist()
        label = new


def plain_fingerprint(text, words=3):
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    shingles = [b" ".join(split[i : i + words]) for i in range(len(split) - words + 1)] or [b" ".join(split)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="abAB \t\n\x0b\xa0éß", max_size=60))
@settings(max_examples=300, deadline=None)
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_every_word_decodes_within_three_bits():
    words = np.random.default_rng(3).integers(0, 1 << 23, 20_000)
    numbers = simhash.decode(words)
    codewords = {}
    for number in range(1 << 12):
        word = rest = number << 11
        for high in range(22, 10, -1):
            if rest >> high & 1:
                rest ^= simhash.GENERATOR << (high - 11)
        codewords[number] = word | rest
    near = np.array([codewords[n] for n in numbers.tolist()])
    assert (np.bitwise_count((near ^ words).astype(np.uint64)) <= 3).all()


def test_keys_meet_for_all_pairs_within_three_bits():
    draw = np.random.default_rng(4)
    prints = draw.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for bits in range(4):
        flips = np.zeros(len(prints), np.uint64)
        for i in range(len(prints)):
            for b in draw.choice(64, bits, replace=False):
                flips[i] |= np.uint64(1) << np.uint64(b)
        own, rows, home = simhash.keys_of(prints, True)
        assert home.all() and len(own) == 3 * len(prints)
        keys, at, _ = simhash.keys_of(prints ^ flips, False)
        theirs = [set() for _ in prints]
        for key, row in zip(keys.tolist(), at.tolist()):
            theirs[row].add(key)
        mine = [set() for _ in prints]
        for key, row in zip(own.tolist(), rows.tolist()):
            mine[row].add(key)
        assert all(a & b for a, b in zip(mine, theirs))
        assert max(map(len, theirs)) <= 108


def planted_prints():
    """Clusters of prints a few bits apart, and others."""
    draw = random.Random(6)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for _ in range(6):
        chain = draw.getrandbits(64)
        for _ in range(60):
            prints.add(chain)
            for _ in range(draw.randint(1, 3)):
                chain ^= 1 << draw.randrange(64)
    return sorted(prints)


@pytest.mark.parametrize("rows", [4096, 3])
def test_links_connect_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", rows)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    prints = np.array(planted_prints(), np.uint64)
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint long")
    rooted = {r["vertex"]: r["component"] for r in components(simhash.links(table)).collect()}
    linked = np.bitwise_count(prints[:, None] ^ prints) <= 3
    want = least_reachable(linked, prints.view(np.int64).tolist())
    assert [rooted.get(p, p) for p in prints.view(np.int64).tolist()] == want
    assert len(set(want)) < len(prints) - 300


ODD = [(9, "a b c d e f"), (3, "A B C  d e\tf"), (None, "a b c d e f"), (5, None), (6, ""), (7, " \n"), (8, "long text " * 9000), (8, "long text " * 9000)]


def test_near_duplicates_of_odd_rows(docs_of):
    got = simhash.near_duplicates(docs_of(ODD, extra="key long, component_id long, root long, fingerprint string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [(0, 3), (3, 3), (5, 5), (6, 5), (7, 5), (8, 8), (8, 8), (9, 3)]
    assert {r["fingerprint"] for r in got if r["doc_id"] in (5, 6, 7)} == {"0" * 16}
    assert simhash.near_duplicates(docs_of(ODD).where("false")).count() == 0


def test_one_row_of_each_component_stays(docs_of):
    docs = docs_of(ODD, extra="key long, component_id long, node long, first string, __doc_id long, __key long, kept_n int, _kept_key int, kept_doc_id int")
    kept = neardups.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 8]
    unnamed = docs_of([(None, "x y z"), (None, "x y z"), (None, "other words here")])
    assert sorted(r["text"] for r in neardups.without_near_duplicates(unnamed).collect()) == ["other words here", "x y z"]
    assert neardups.without_near_duplicates(docs.where("false")).count() == 0


def shingles_of(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def kept_of_all_pairs(rows):
    """The least ids of the groups that all pairs of texts with a similarity of 0.8 make."""
    sets = [shingles_of(t or "") for _, t in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for a in range(len(rows)):
        for b in range(a):
            linked[a, b] = linked[b, a] = len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    return sorted(set(least_reachable(linked, [i for i, _ in rows])))


@pytest.mark.parametrize("block", [200_000, 2000])
def test_groups_of_near_copies(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(neardups, "BLOCK_SHINGLES", block)
    draw = random.Random(12)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(4000)]
    rows, number = [], 0
    for _ in range(25):
        base = draw.choices(vocabulary, k=draw.randint(120, 300))
        for _ in range(draw.choice([1, 2, 5, 25])):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((number, " ".join(words)))
            number += 1
    got = sorted(r["doc_id"] for r in neardups.without_near_duplicates(docs_of(rows)).collect())
    assert got == kept_of_all_pairs(rows)
    assert len(got) < 0.7 * len(rows)


def test_similar_pairs_equal_all_pairs():
    draw = np.random.default_rng(1)
    for _ in range(20):
        base = draw.choice(2**62, 400, replace=False).astype(np.uint64)
        sets = []
        for _ in range(30):
            own = base[draw.random(400) < draw.choice([0.6, 0.9, 0.97])]
            sets.append(np.unique(np.concatenate([own, draw.choice(2**62, draw.integers(0, 40)).astype(np.uint64)])))
        linked = np.array([[len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b)) for b in sets] for a in sets])
        few = np.zeros_like(linked)
        for i, j in neardups.similar_pairs(sets, 0.8):
            few[i, j] = few[j, i] = True
            assert linked[i, j]
        assert least_reachable(linked, range(30)) == least_reachable(few, range(30))


def test_query_of_simhash(spark, sf):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_golay_simhash"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    ids = [d["doc_id"] for d in docs]
    prints = np.array([plain_fingerprint(d["text"]) for d in docs], np.uint64)
    want = least_reachable(np.bitwise_count(prints[:, None] ^ prints) <= 3, ids)
    assert [got[i] for i in ids] == [(f"{p:016x}", c) for p, c in zip(prints.tolist(), want)]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
@settings(max_examples=200, deadline=None)
def test_forests_connect_the_same(pairs):
    a, b = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    full, few = np.zeros((31, 31), bool), np.zeros((31, 31), bool)
    full[a, b] = full[b, a] = True
    x, y = forest(a, b)
    few[x, y] = few[y, x] = True
    assert least_reachable(full, range(31)) == least_reachable(few, range(31))
    assert len(x) <= len(set(a.tolist()) | set(b.tolist()))


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 700)] + [(7, 7), (None, 4), (3, 2), (3, 2)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 100 for i in range(100, 181)}, **{i: 500 for i in range(500, 700)}, 2: 2, 3: 2}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_vectors(rows, vectors, cosine=0.95):
    ids = sorted(vectors)
    good = [i for i in ids if vectors[i] and all(x is not None and np.isfinite(x) for x in vectors[i]) and any(vectors[i])]
    linked = np.zeros((len(ids), len(ids)), bool)
    for a in good:
        for b in good:
            if a != b and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a], float), np.array(vectors[b], float)
                linked[ids.index(a), ids.index(b)] = x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine
    want = least_reachable(linked, ids)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows}
    assert got == {i: (int(n), c, i == c) for i, n, c in zip(ids, linked.sum(axis=1), want)}
    return int(linked.sum())


def planted_vectors(n, seed, size=8):
    draw = np.random.default_rng(seed)
    vectors = {}
    centres = draw.normal(size=(6, size))
    for i in range(n):
        point = centres[i % 6] + draw.normal(size=size) * draw.choice([0.02, 0.15, 1.0])
        vectors[i * 3 + 1] = np.float32(point).tolist()
    for i in range(0, n, 9):
        vectors[i * 3 + 2] = vectors[i * 3 + 1]
    return vectors


@pytest.mark.parametrize("block, leaf", [(2048, 128), (40, 8), (25, 1)])
def test_vectors_equal_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(covertree, "LEAF_ROWS", leaf)
    vectors = planted_vectors(400, 5)
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").repartition(5)
    assert check_vectors(covertree.similar_vectors(table, block_rows=block).collect(), vectors) > 1000


def test_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = {1: None, 2: [], 3: [0.0, 0.0], 4: [nan, 1.0], 5: [inf, 1.0], 6: [None, 1.0], 7: [1.0, 0.0], 8: [2.0, 0.0], 9: [1.0, 0.1], 10: [-1.0, 0.0], 11: [1.0, 0.0, 0.0], 12: [1e-30, 0.0]}
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in vectors.items()], "vec_id long, embedding array<float>, unit int, node string")
    check_vectors(covertree.similar_vectors(table).collect(), vectors)
    assert covertree.similar_vectors(table.where("false")).count() == 0
    same = spark.createDataFrame([(5, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in covertree.similar_vectors(same).collect()]
    assert sorted(got, key=str) == [(5, 2, 5), (5, 2, 5), (None, 2, 5)]


@given(st.integers(0, 10**6), st.integers(1, 6), st.sampled_from([0.5, 0.9, 0.99]))
@settings(max_examples=40, deadline=None)
def test_dual_traversal(seed, leaf, cosine):
    before = covertree.LEAF_ROWS
    covertree.LEAF_ROWS = leaf
    try:
        points = np.array(list(planted_vectors(60, seed, 3).values()))
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        copies = np.random.default_rng(seed).integers(1, 4, len(points))
        counts, _ = covertree.dual(points, copies, None, None, cosine)
        assert counts.tolist() == ((points @ points.T >= cosine) @ copies - 1).tolist()
        (a, b), _ = covertree.dual(points[:25], copies[:25], points[25:], copies[25:], cosine)
        near = points[:25] @ points[25:].T >= cosine
        assert a.tolist() == (near @ copies[25:]).tolist() and b.tolist() == (copies[:25] @ near).tolist()
    finally:
        covertree.LEAF_ROWS = before


def test_query_of_vectors(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    found = QUERIES["op10_cover_tree"](spark, sf)
    check_vectors(found.collect(), {r["vec_id"]: r["embedding"] for r in table})
    assert difference(from_spark(found), from_duck(connect(sf), ORACLES["op10_cover_tree"])) is None


def test_links_of_chunks_equal_all_pairs(spark, monkeypatch):
    # every other block meets the broadcast ones; many rounds, several lengths, parts and cells
    monkeypatch.setattr(covertree, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(covertree, "CELL_ROWS", 16)
    vectors = planted_vectors(300, 7, 64)
    draw = np.random.default_rng(8)
    vectors |= {5000 + i: draw.normal(size=64).tolist() for i in range(700)} | {9000 + i: v[:5] for i, v in planted_vectors(60, 9).items()}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(4)
    assert check_vectors(covertree.similar_vectors(table, block_rows=64).collect(), vectors) > 1000


def test_descent_with_folded_vectors():
    draw = np.random.default_rng(3)
    for spread in (0.02, 0.05, 1.0):
        raw = (draw.normal(size=(3, 64)).repeat(400, axis=0) + spread * draw.normal(size=(1200, 64))).astype(np.float32)
        units = covertree._units(raw)
        basis = covertree._basis(units, 0.95)
        some = np.ascontiguousarray(np.eye(64)[:, :6])
        # few components let every linked pair pass, whatever they are
        folded = covertree._folded(units, some)
        assert ((folded @ folded.T >= 0.95 - covertree.ROOM) >= (units @ units.T >= 0.95)).all()
        for own in (basis, some, None):
            points = covertree.Points(raw, own)
            links = covertree._Links()
            descent = covertree._Descent(points, np.ones(1200, np.int64), np.arange(1200), points, np.ones(1200, np.int64), np.arange(1200), 0.95, links)
            descent.run(covertree.tree(units), np.arange(1200))
            near = units @ units.T >= 0.95
            assert descent.left_counts.tolist() == descent.right_counts.tolist() == near.sum(axis=1).tolist()
            few = np.zeros_like(near)
            a, b = links.forest()
            few[a, b] = few[b, a] = True
            assert least_reachable(few, range(1200)) == least_reachable(near, range(1200))


def written(spark):
    """Files of shuffles and of tables in the shared folder, with their bytes."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    shared = [os.path.join(d, f) for d, _, names in os.walk(shared_dir(spark)) for f in names]
    shuffled = {blocks.apply(i).getPath(): blocks.apply(i).length() for i in range(blocks.size())}
    return shuffled | {f: os.path.getsize(f) for f in shared}


def test_disk_follows_the_rows(spark, tmp_path):
    # vectors without structure: no bound leaves out a pair of blocks
    draw = np.random.default_rng(2)
    vectors = pa.array(draw.normal(size=(8000, 64)).astype(np.float32).tolist(), pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": pa.array(range(8000), pa.int64()), "embedding": vectors}), tmp_path / "rows.parquet", use_dictionary=False)
    table = spark.read.parquet(f"{tmp_path}/rows.parquet")
    before = written(spark)
    assert covertree.similar_vectors(table, block_rows=200).where("n_links > 0").count() == 0
    grown = sum(size for f, size in written(spark).items() if f not in before)
    print("written, by bytes of input:", grown / (8000 * 264))
    assert 8000 * 256 < grown < 4 * 8000 * 264
