"""Licence sentences and ordered rules against a plain version."""

from __future__ import annotations

import random
import re

import pytest

from proofline.llm import licenses
from proofline.llm.queries import QUERIES


def plain_normalised(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).strip()
    words = re.sub(r"^(\d{1,2}|[a-z]) (?=[^\W\d_]{2})", "", words)
    return re.sub(r"\bnon infringement\b", "noninfringement", re.sub(r"\blicence", "license", words))


ALONE = re.compile(f"{licenses._TITLE}|{licenses._NOTICE}", re.ASCII)


def paragraphs(text):
    """Lines joined up, but for titles, copyright notices and blank lines; one line has none."""
    lines = re.split(r"\r\n|\r|\n", text)
    if len(lines) == 1:
        return []
    made, own = [], []
    for line in lines:
        if not line.strip(" \t") or ALONE.fullmatch(line.strip(" \t")):
            made += [" ".join(own), line]
            own = []
        else:
            own.append(line)
    return [*made, " ".join(own)]


def by_force(text, sentences, rules):
    known = {plain_normalised(s): i for i, s in sorted(sentences.items(), reverse=True)}
    stop = r"(?<=[.;:!?])\s+"
    joined = [re.split(stop, re.sub(r"\s+", " ", p)) for p in (text, *paragraphs(text))]
    passes = [re.split(rf"[\r\n]+|{stop}", text), joined[0], [s for p in joined[1:] for s in p]]
    ids = [[known[n] for n in map(plain_normalised, cut) if n in known] for cut in passes]
    names = set()
    for own in ids:
        for name, wanted in rules:
            left = iter(own)
            if all(any(x == w for x in left) for w in wanted):
                names.add(name)
    return ",".join(sorted(names)), ",".join(ids[0] or ids[1] or ids[2])


def test_query_of_licenses(spark, sf):
    got = {r["doc_id"]: (r["licenses"], r["sentences"]) for r in QUERIES["op6_sentence_rules"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got == {d["doc_id"]: by_force(d["text"] or "", licenses.SENTENCES, licenses.RULES) for d in docs}
    assert any(names for names, _ in got.values())


@pytest.mark.parametrize("listed", [1000, 0])
def test_ordered_rules_equal_the_plain_version(spark, docs_of, monkeypatch, listed):
    monkeypatch.setattr(licenses, "LISTED", listed)
    draw = random.Random(4)
    texts = []
    for _ in range(150):
        parts = [draw.choice([*licenses.SENTENCES.values(), "Other words here", "x"]) for _ in range(draw.randint(0, 9))]
        text = "".join(p + draw.choice([".\n", ". ", ";\n\n", ": ", "\n", ".  "]) for p in parts)
        texts.append(draw.choice([text, text.upper(), text.replace("icense", "icence"), re.sub(r" (\w+ \w+) ", r"\n\1 ", text)]))
    texts += ["1. " + licenses.SENTENCES["bsd-source"] + ".", "(a) Released under the MIT License"]
    got = {r["doc_id"]: (r["licenses"], r["sentences"]) for r in licenses.licenses(docs_of(list(enumerate(texts)))).collect()}
    want = {i: by_force(t, licenses.SENTENCES, licenses.RULES) for i, t in enumerate(texts)}
    assert got == want
    assert len({names for names, _ in want.values()}) > 20


def test_order_matters(spark, docs_of):
    grant, condition = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-condition"]
    rows = [(1, f"{grant}: and more. {condition}."), (2, f"{condition}. {grant}:"), (3, f"{grant}:"), (4, "Copyright 2020. " + grant.replace(" software", "\nsoftware") + ":\n\n" + condition + ".")]
    got = {r["doc_id"]: r["licenses"] for r in licenses.licenses(docs_of(rows)).collect()}
    assert got == {1: "MIT", 2: "", 3: "", 4: "MIT"}


def test_licenses_of_odd_rows(spark, docs_of):
    notice = "Released under the MIT License."
    rows = [(1, None), (2, ""), (None, notice), (4, notice), (4, notice), (5, "word. " * 20_000 + notice)]
    docs = docs_of(rows, extra="row long, found string, licenses string, sentences string")
    got = sorted((r["doc_id"] or 0, r["licenses"]) for r in licenses.licenses(docs).collect())
    assert got == [(0, "MIT"), (1, ""), (2, ""), (4, "MIT"), (4, "MIT"), (5, "MIT")]
    assert licenses.licenses(docs.where("false")).count() == 0
    assert {r["licenses"] for r in licenses.licenses(docs, {}, []).collect()} == {""}
