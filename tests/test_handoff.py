"""The two verdicts that users of the contract rely on, and what leads to them."""

from __future__ import annotations

import json

import pytest

from proofline.operators.contract import (
    Contract,
    ContractBlocked,
    check_casing,
    check_date_formats,
    check_duplicate_columns,
    check_missing,
    check_mixed_types,
    enforce,
    gate,
    run_contract,
)
from proofline.plans import handoff
from proofline.plans.handoff import check_handoff
from proofline.sources.raw_csv import read_raw_csv
from proofline.sources.sinks import write_table

# The sample that must be blocked and the verdicts, to the letter.
BAD = '''customer_id,revenue,revenue,signup_date,category
101,500,,2024-01-15,Premium
102,,"",2024/02/20,basic
103,300,300,,PREMIUM
'''
BLOCKED = {
    "decision": "block",
    "reason": "Handoff contract violations: Duplicate column names: ['revenue']; Column 'revenue' has mixed types (numeric + string)",
}
ALLOWED = {"decision": "allow", "reason": "All handoff contract checks passed."}

GOOD = '''customer_id,revenue,signup_date,category
101,500,2024-01-15,premium
102,250,2024-02-20,basic
103,300,2024-03-02,premium
'''
STRICT = Contract(date_columns=["signup_date"], max_missing=0.0, categories=["category"], rows=(1, 1000))


@pytest.fixture
def bad(tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(BAD)
    return str(path)


@pytest.fixture
def good(tmp_path):
    path = tmp_path / "good.csv"
    path.write_text(GOOD)
    return str(path)


def test_bad_file_is_blocked(spark, bad):
    assert check_handoff(spark, bad).first().asDict() == BLOCKED


def test_good_file_passes(spark, good):
    assert check_handoff(spark, good).first().asDict() == ALLOWED
    assert check_handoff(spark, good, STRICT).first().asDict() == ALLOWED


def test_enforce_stops_on_block_only(spark, bad, good):
    with pytest.raises(ContractBlocked, match="Duplicate column names"):
        enforce(check_handoff(spark, bad))
    assert enforce(check_handoff(spark, good)) == "allow"


def test_warnings_do_not_block(spark, bad):
    contract = Contract(warn=("duplicate_columns", "mixed_types"))
    assert enforce(check_handoff(spark, bad, contract)) == "warn"


def test_command_prints_the_verdict(spark, bad, good, capsys):
    assert handoff.main([bad]) == 2
    assert json.loads(capsys.readouterr().out) == BLOCKED
    assert handoff.main([good]) == 0
    assert json.loads(capsys.readouterr().out) == ALLOWED


def test_raw_scan_keeps_header_and_empty_cells(spark, bad):
    rows, header = read_raw_csv(spark, bad)
    assert header == ["customer_id", "revenue", "revenue", "signup_date", "category"]
    cells = {r["c0"]: (r["c1"], r["c2"], r["c3"]) for r in rows.collect()}
    assert cells["101"] == ("500", None, "2024-01-15")
    assert cells["102"] == (None, "", "2024/02/20")


def test_opt_in_checks_find_the_rest(spark, bad):
    rows, header = read_raw_csv(spark, bad)
    names = ["customer_id", "r1", "r2", "signup_date", "category"]
    named = rows.drop("_malformed").toDF(*names)
    assert check_date_formats(named, ["signup_date"]).first()["formats"] == "yyyy-MM-dd + yyyy/MM/dd"
    assert check_casing(named, ["category"]).first()["n_spellings"] == 2
    assert {r["column_name"] for r in check_missing(named, 0.5).collect()} == {"r2"}
    found = [r["check"] for r in run_contract(rows, STRICT, header).orderBy("seq").collect()]
    assert found == ["duplicate_columns", "mixed_types", "formats", "missing", "missing", "casing"]


def test_names_that_differ_in_case_only(spark):
    assert check_duplicate_columns(spark, ["a", "A", "b"]).count() == 0
    found = check_duplicate_columns(spark, ["a", "A", "b"], case_sensitive=False).first()
    assert (found["column_name"], found["n_columns"], found["positions"]) == ("a", 2, "0,1")


def test_empty_table_passes_the_default_contract(spark):
    empty = spark.createDataFrame([], "a string, b string")
    assert gate(run_contract(empty)).first().asDict() == ALLOWED
    assert gate(run_contract(empty, Contract(rows=(1, None)))).first()["decision"] == "block"


def test_mixed_types_of_dates_and_numbers(spark):
    df = spark.createDataFrame([("1",), ("2024-01-01",), ("2024-02-30",)], "v string")
    row = check_mixed_types(df).first()
    # the 30th of February is no date
    assert row["kinds"] == "numeric + date + string"


def test_csv_round_trip_keeps_null_apart_from_empty(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", 'say "hi", twice')], "k string, v string")
    write_table(df, str(tmp_path / "out"), "csv")
    rows, header = read_raw_csv(spark, str(tmp_path / "out"))
    assert header == ["k", "v"]
    assert {r["c0"]: r["c1"] for r in rows.collect()} == {"1": None, "2": "", "3": 'say "hi", twice'}
