"""The pipeline, each stage against a plain version on its own input."""

from __future__ import annotations

import re
import zlib

import pytest

import corpus_pipeline
from proofline.llm import secrets
from proofline.llm.tokens import word_tokenizer
from tests.llm.test_learned import leaks_by_force
from tests.llm.test_similar import kept_of_all_pairs
from tests.llm.test_spans import SECRETS, base_spans, weak_by_pairs
from tests.llm.test_token_output import check_packing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def by_id(table):
    rows = table.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: r for r in rows}


def test_stages_keep_the_columns(stages):
    for table in stages[1:-1]:
        assert table.dtypes == stages[0].dtypes


def test_quality_drops_poor_documents(spark, stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [i for i in labels if i in before and zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(i in after for i in held if labels[i] == 1) >= 0.95 * sum(labels[i] == 1 for i in held)
    assert sum(i not in after for i in held if labels[i] == 0) >= 0.7 * sum(labels[i] == 0 for i in held)
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_group_of_copies_stays(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    want = kept_of_all_pairs([(i, before[i]["text"]) for i in sorted(before)])
    assert sorted(after) == want
    assert len(want) < len(before)
    # of equal texts one stays
    texts = [r["text"].lower().split() for r in after.values()]
    assert len(set(map(tuple, texts))) == len(texts)


def test_documents_with_benchmark_items_go(spark, stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    leaks = {i for i, _ in leaks_by_force(before.values(), items)}
    gone = set(before) - set(after)
    assert leaks and leaks <= gone
    assert len(gone - leaks) <= 0.05 * len(leaks) + 1


def redacted_by_force(text):
    base = base_spans(text, SECRETS)
    spans = sorted((a, secrets.KINDS.index(k), k, b) for k, a, b in [*base, *weak_by_pairs(text, base, secrets.SCOPE)])
    made, at = "", 0
    for a, _, kind, b in spans:
        if a >= at:
            made += f"{text[at:a]}[{kind}]"
        at = max(at, b)
    return made + text[at:]


def test_secrets_are_redacted(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert row["text"] == redacted_by_force(before[i]["text"])
        assert row["n_chars"] == len(row["text"])
        assert (row["lang"], row["source"]) == (before[i]["lang"], before[i]["source"])
    assert any(re.search(r"\[(assign|access|hex)\]", r["text"]) for r in after.values())


def test_all_that_is_left_is_packed(stages):
    left, rows = by_id(stages[4]), stages[5].collect()
    check_packing(rows, 1024)
    t = word_tokenizer()
    sizes = {}
    for r in rows:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    assert sizes == {i: len(t.encode_whole(r["text"] or "")) // 4 + 1 for i, r in left.items()}


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[5].columns
    assert got.select("doc_id", "piece", "length").exceptAll(stages[5].select("doc_id", "piece", "length")).isEmpty()


def test_odd_rows_pass_through(spark, docs_of, tmp_path):
    rows = [(1, None), (2, ""), (None, "token=abcdefgh1 and words"), (4, "some words here"), (4, "some words here"), (5, "long word " * 20_000)]
    docs = docs_of(rows).select("doc_id", "text", "lang", "source", "n_chars")
    for table in (docs, docs.where("false")):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, table, "/root/testdata/sf0.001")
            path = str(tmp_path / f"{number}-{table is docs}-{id(table)}")
            made.write.parquet(path)
            table = spark.read.parquet(path)
        assert set(table.columns) >= {"doc_id", "piece", "sequence_id", "offset"}
