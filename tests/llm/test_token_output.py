"""Round trips of the plane format and of packing against a plain version."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from proofline.llm import bitplanes, packing
from proofline.llm.queries import QUERIES
from proofline.llm.tokens import word_tokenizer

ROWS = [(3, "a b c"), (1, None), (2, ""), (None, "null id"), (7, "long word " * 5000), (3, "a b c"), (3, "other"), (-5, "é ß\n\n x")]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["byte", "bit"]))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids, planes):
    packed = np.array(ids, "<u4").tobytes()
    made = bitplanes.to_planes(packed, planes)
    assert len(made) == {"byte": 4, "bit": 32}[planes]
    assert bitplanes.from_planes(made, len(ids)) == packed


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_written_ids_read_back(spark, docs_of, tmp_path, planes):
    path = str(tmp_path / "ids")
    bitplanes.write_ids(docs_of(ROWS), path, end_id=9, planes=planes, block_ids=100, segment_ids=250)
    got = sorted(bitplanes.read_ids(spark, path).collect(), key=lambda r: r["start"])
    t = word_tokenizer()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == sorted(
        (i is not None, i or 0, t.encode_whole(x or "") + b"\x09\0\0\0") for i, x in ROWS
    )
    ids = [r["doc_id"] for r in got]
    assert ids == [None, -5, 1, 2, 3, 3, 3, 7]
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    blocks = sorted(spark.read.parquet(f"{path}/index").collect(), key=lambda r: r["first_id"])
    assert [b["first_id"] for b in blocks] == [0, *np.cumsum([b["n_ids"] for b in blocks])[:-1]]
    assert sum(b["n_ids"] for b in blocks) == sum(r["n_tokens"] for r in got)
    assert max(b["n_ids"] for b in blocks) == 100


def test_no_documents(spark, docs_of, tmp_path):
    path = str(tmp_path / "none")
    bitplanes.write_ids(docs_of([(1, "a")]).where("false"), path)
    assert bitplanes.read_ids(spark, path).count() == 0
    assert packing.pack(docs_of([(1, "a")]).where("false")).count() == 0


def test_query_of_token_output(spark, sf):
    t, docs = word_tokenizer(), spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want, start = [], 0
    for d in docs:
        ids = t.encode_whole(d["text"] or "") + bytes(4)
        want.append((d["doc_id"], start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = QUERIES["op1_bit_planes"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def check_packing(rows, size):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_query_of_packing(spark, sf):
    t, docs = word_tokenizer(), spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = QUERIES["op9_best_fit"](spark, sf).collect()
    n = check_packing(rows, 1024)
    ids = {d["doc_id"]: t.encode_whole(d["text"] or "") + b"\x02\0\0\0" for d in docs}
    assert n <= 1.02 * sum(len(x) // 4 for x in ids.values()) / 1024 + 1
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert by_doc.keys() == ids.keys()
    for doc_id, pieces in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[doc_id][4 * at : 4 * (at + r["length"])])
            assert k == 0 or r["length"] == 1024
            at += r["length"]
        assert at == len(ids[doc_id]) // 4


def test_packing_of_odd_rows(docs_of):
    rows = packing.pack(docs_of(ROWS, extra="rank long, first long, task int"), limits=packing.Limits(tokens=64)).collect()
    check_packing(rows, 64)
    assert len({(r["doc_id"], r["piece"]) for r in rows if r["doc_id"] != 3}) == len([r for r in rows if r["doc_id"] != 3])
    assert sum(r["doc_id"] == 3 for r in rows) == 3


@given(
    st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=20),
    st.sampled_from(["norm", "dot"]),
    st.integers(1, 6),
    st.integers(2500, 6000),
)
@settings(max_examples=150, deadline=None)
def test_plans_keep_every_limit(counts, score, documents, attention):
    slots, n = packing.plan(counts, packing.Limits(50, documents, attention, score=score))
    used, ranks = {}, {}
    for length, first, last, sequence, each, offset in slots:
        for rank in range(first, last):
            i = rank - first
            used.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
            ranks.setdefault(length, []).append(rank)
    assert {k: len(v) for k, v in ranks.items()} == counts
    assert all(sorted(v) == list(range(counts[k])) for k, v in ranks.items())
    assert sorted(used) == list(range(n))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 50 and len(places) <= documents and sum(x * x for _, x in places) <= attention
