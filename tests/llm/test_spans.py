"""Personal data and secrets against plain regular expressions, and what the methods add."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from proofline.llm import pii, secrets
from proofline.llm.queries import QUERIES


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def is_card(text):
    digits = re.sub("[ -]", "", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: is_card(m.group())),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15),
]
SECRETS = [
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m.group(2)) >= 8,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
]


def base_spans(text, kinds):
    found = []
    for rank, (kind, pattern, valid) in enumerate(kinds):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if valid(m)]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


@given(st.text(alphabet="019.@+-%_ ()aZ\n:/", max_size=80))
@settings(max_examples=1500, deadline=None)
def test_anchors_equal_the_patterns(text):
    got = [(k, a, b) for a, b, k in pii.find(text) if k in pii.BASE_KINDS]
    assert got == base_spans(text, PII)


@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (650) 253-0000", "10.0.0.1", "256.1.1.1.1", "a@b.co", "@", "+", ".", " ", "x", "5", "é"]), max_size=12))
@settings(max_examples=600, deadline=None)
def test_anchors_equal_the_patterns_near_real_ones(parts):
    text = "".join(parts)
    got = [(k, a, b) for a, b, k in pii.find(text) if k in pii.BASE_KINDS]
    assert got == base_spans(text, PII)


def test_cues_add_validated_spans():
    text = "IBAN: DE89 3704 0044 0532 0130 00 and SSN 078-05-1120; account no. 12345678, see https://me:pw1@host.example/x"
    found = {k: text[a:b] for a, b, k in pii.find(text) if k in pii.MORE_KINDS}
    assert found == {
        "iban": "DE89 3704 0044 0532 0130 00",
        "ssn": "078-05-1120",
        "account": "12345678",
        "login": "https://me:pw1@host.example",
    }
    assert not [k for _, _, k in pii.find("IBAN: DE89 3704 0044 0532 0130 01, SSN 000-12-3456, classnumber 5")]


ROWS = [(1, None), (2, ""), (None, "mail a@b.co"), (4, "mail a@b.co"), (4, "mail a@b.co"), (5, "x@y.z " * 4000)]


def test_personal_data_of_odd_rows(docs_of):
    rows = pii.personal_data(docs_of(ROWS)).collect()
    assert sorted((r["doc_id"] or 0, len(r["spans"])) for r in rows) == [(0, 1), (1, 0), (2, 0), (4, 1), (4, 1), (5, 4000)]
    assert pii.personal_data(docs_of(ROWS).where("false")).count() == 0


@pytest.mark.parametrize("name, kinds", [("op2_anchored_pii", PII), ("op7_linked_secrets", SECRETS)])
def test_span_queries(spark, sf, name, kinds):
    got = {r["doc_id"]: r for r in QUERIES[name](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, row = base_spans(d["text"] or "", kinds), got[d["doc_id"]]
        assert row["base_sha256"] == digest(want)
        assert [row[f"n_{k}"] for k, _, _ in kinds] == [sum(s[0] == k for s in want) for k, _, _ in kinds]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(row["spans"].split(","))


def secret_text(draw):
    parts = ["password", "api_key", "Token", "=", ":", " ", "'", '"', "AKIA", "ABCDEF0123456789", "deadbeef" * 4, "abc", "\n", "é😀", ";", "user", "https://h.example/"]
    return "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))


def test_secrets_equal_the_patterns(spark, docs_of):
    draw = random.Random(5)
    texts = [secret_text(draw) for _ in range(600)]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.secrets(docs_of(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in secrets.BASE] == base_spans(text, SECRETS), repr(text)


def weak_by_pairs(text, base, scope):
    """The linked spans of a text, every pair of parts compared."""
    parts = []
    for kind, (pattern, group, least) in secrets.WEAK.items():
        for m in re.finditer(pattern, text):
            mixed = all(re.search(c, m.group()) for c in ("[0-9]", "[A-Z]", "[a-z]"))
            if len(m.group(group)) >= least and (kind != "weak_secret" or mixed):
                parts.append((kind, m.start(), m.end()))
    parts = [p for p in parts if not any(a < p[2] and p[1] < b for _, a, b in base)]
    every = parts + base
    near = lambda p, kinds: any(k in kinds and abs(a - p[1]) <= scope for k, a, _ in every)
    ids, keys = ("access", "weak_id"), ("assign", "hex", "weak_secret")
    wanted = {"weak_id": [keys], "weak_secret": [ids], "weak_endpoint": [ids, keys]}
    return sorted(p for p in parts if all(near(p, kinds) for kinds in wanted[p[0]]))


def test_links_equal_all_pairs(docs_of):
    draw = random.Random(9)
    bits = ["user: bob1", "account=42x", "Zx9" * 8, "https://db.example:5432", "password=hunter2hunter2", "AKIA" + "Q" * 14, "word " * 9, "\n", "client_id = 'abc'"]
    texts = [" ".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(200)]
    rows = secrets.secrets(docs_of(list(enumerate(texts))), scope=60).collect()
    linked = 0
    for r in rows:
        text, spans = texts[r["doc_id"]], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        want = weak_by_pairs(text, base_spans(text, SECRETS), 60)
        assert sorted(s for s in spans if s[0] in secrets.WEAK) == want
        linked += len(want)
    assert linked > 100


def test_weak_parts_alone_are_not_reported(docs_of):
    rows = [(1, "user: bob1 went home"), (2, "user: bob1 " + "x " * 300 + "Zx9" * 8), (3, "user: bob1 / " + "Zx9" * 8 + " at https://db.example")]
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.secrets(docs_of(rows)).collect()}
    assert got == {1: [], 2: [], 3: ["weak_id", "weak_secret", "weak_endpoint"]}


def test_secrets_of_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (None, "token=abcdefgh1"), (4, "token=abcdefgh1"), (4, "token=abcdefgh1"), (5, "secret: abcdefgh1 " * 3000)]
    got = secrets.secrets(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, len(r["spans"])) for r in got) == [(0, 1), (1, 0), (2, 0), (4, 1), (4, 1), (5, 3000)]
    assert secrets.secrets(docs_of(rows).where("false")).count() == 0


def redacted_by_force(text, spans):
    """``[kind]`` in place of spans, which are taken by start; those that overlap become one."""
    made, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            made.append(text[at:a] + f"[{kind}]")
        at = max(at, b)
    return "".join(made) + text[at:]


def test_redaction_equals_cutting_the_text(docs_of, monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 7)
    draw = random.Random(11)
    bits = ["user: bob1", "Zx9" * 8, "https://db.example:5432", "password=" + "deadbeef" * 4, "AKIA" + "Q" * 14, "é😀\n", "api_key: 'AKIA" + "7" * 16 + "'"]
    docs = docs_of([(i, " ".join(draw.choice(bits) for _ in range(draw.randint(0, 20)))) for i in range(150)])
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.secrets(docs).collect()}
    got = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got == {i: redacted_by_force(texts[i], spans[i]) for i in texts}
    # spans that overlap are among them
    assert any(b > c for own in spans.values() for (_, _, b), (_, c, _) in zip(own, own[1:]))


def test_a_text_of_very_many_secrets(docs_of):
    # a text of 100,000 assignments and as many weak parts took time with the square of both
    text = "password: é" + "token=abcdefgh1 user: bob1 é\n" * 100_000
    started = time.monotonic()
    (row,) = secrets.secrets(docs_of([(1, text)])).collect()
    assert [s["kind"] for s in row["spans"]].count("assign") == 100_000 and len(row["spans"]) == 200_000
    assert [text[s["start"] : s["end"]] for s in row["spans"][-2:]] == ["token=abcdefgh1", "user: bob1"]
    (row,) = secrets.redacted(docs_of([(1, text)])).collect()
    assert row["text"] == "password: é" + "[assign] [weak_id] é\n" * 100_000
    assert time.monotonic() - started < 120
