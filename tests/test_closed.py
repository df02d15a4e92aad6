"""Faults that must be seen: ragged rows, absent columns, failed checks, odd values."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.ordered import sketched_quantiles
from proofline.operators import audit, clean, contract, features, profile
from proofline.operators.contract import Contract, gate, run_contract
from proofline.plans import handoff
from proofline.sources.raw_csv import read_raw_csv
from proofline.sources.sinks import write_table


def written(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_ragged_rows_are_violations(spark, tmp_path):
    rows, header = read_raw_csv(spark, written(tmp_path, "a,b\n1,2\n3,4,EXTRA\n5\n"))
    kept = {r["c0"]: r["_malformed"] for r in rows.collect()}
    assert kept == {"1": None, "3": "3,4,EXTRA", "5": "5"}
    verdict = gate(run_contract(rows, Contract(), header)).first()
    assert verdict["decision"] == "block"
    assert "Table has 2 rows with too few or too many cells" in verdict["reason"]
    soft = gate(run_contract(rows, Contract(warn=("row_shape",)), header)).first()
    assert soft["decision"] == "warn"


def test_quoted_line_breaks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "one\ntwo"), (2, 'say "x"'), (3, None), (4, "")], "k int, t string").coalesce(1)
    path = str(tmp_path / "csv")
    write_table(df, path, "csv")
    rows, header = read_raw_csv(spark, path, multi_line=True)
    assert header == ["k", "t"]
    got = {int(r["c0"]): r["c1"] for r in rows.collect()}
    assert got == {1: "one\ntwo", 2: 'say "x"', 3: None, 4: ""}
    assert not [r for r in rows.collect() if r["_malformed"] is not None]


def test_part_files_share_one_header(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    written(folder, "a,b\n1,2\n", "p1.csv")
    written(folder, "a,b\n3,4\n", "p2.csv")
    rows, _ = read_raw_csv(spark, str(folder))
    assert rows.count() == 2
    written(folder, "a,c\n5,6\n", "p3.csv")
    with pytest.raises(ValueError, match="another header"):
        read_raw_csv(spark, str(folder))


@pytest.mark.parametrize("text", ["", None])
def test_the_command_fails_closed(spark, tmp_path, capsys, monkeypatch, text):
    monkeypatch.setattr(handoff, "build_session", lambda: spark)
    path = str(tmp_path / "absent.csv") if text is None else written(tmp_path, text)
    assert handoff.main([path]) == 2
    assert json.loads(capsys.readouterr().out)["decision"] == "block"
    assert handoff.main([]) == 2


def test_absent_and_wrongly_typed_columns_block(spark):
    df = spark.createDataFrame([("1", "x"), ("b", "y"), ("", "z")], "k string, t string")
    wanted = Contract(required={"k": "int", "gone": None}, patterns={"lost": "x"}, date_columns=["day"], categories=["kind"])
    found = {(r["check"], r["column_name"]): r["n"] for r in run_contract(df, wanted).collect()}
    assert found[("structure", "k")] == 1
    assert {c for check, c in found if check == "structure"} == {"k", "gone", "lost", "day", "kind"}
    assert gate(run_contract(df, wanted)).first()["decision"] == "block"


def test_rules_hold_for_every_column_of_a_name(spark):
    df = spark.createDataFrame([("a1", "b", "A"), ("a2", "a3", "a")], "c0 string, c1 string, c2 string")
    rules = Contract(patterns={"code": r"^a\d$"}, categories=["code"])
    found = {r["check"]: r["n"] for r in run_contract(df, rules, ["code", "code", "code"]).collect()}
    assert found["formats"] == 3 and found["casing"] == 2


def test_unknown_types_and_other_checks_can_be_gated(spark):
    df = spark.createDataFrame([(1, "a", '{"k":1}'), (2, "b", '{"k":1}'), (3, None, '{"k":1}'), (4, "a", "{}"), (5, "a", "no")], "id int, t string, j string")
    found = contract.check_json_keys(df, "id", "t", "j", {"a": ["k"]})
    assert {r["id"]: r["status"] for r in found.collect()} == {2: "unknown_type", 3: "unknown_type", 4: "missing_keys", 5: "invalid"}
    verdict = gate(contract.as_violations(found, "json_keys")).first()
    assert verdict["decision"] == "block" and "unknown_type (2)" in verdict["reason"]
    none = contract.check_json_keys(df.where("id = 1"), "id", "t", "j", {"a": ["k"]})
    assert gate(contract.as_violations(none, "json_keys")).first()["decision"] == "allow"
    sections = contract.missing_sections(spark.createDataFrame([(1, "# A")], "id int, t string"), "id", "t", ["# A", "# B"])
    assert "missing section '# B' (1)" in gate(contract.as_violations(sections, "missing_sections")).first()["reason"]


def test_date_shapes(spark):
    cases = {"d/M/yyyy": ["1/2/2024", "31/12/2024"], "dd-MMM-yyyy": ["05-Jan-2024"], "yyyy-MM-dd'T'HH:mm": ["2024-01-05T10:30"]}
    for fmt, texts in cases.items():
        df = spark.createDataFrame([(t,) for t in [*texts, "x"]], "t string")
        got = [r[0] is not None for r in df.select(X.parsed_date(F.col("t"), [fmt])).collect()]
        assert got == [True] * len(texts) + [False], fmt


def test_white_space_means_the_same_everywhere(spark):
    df = spark.createDataFrame([("\t",), ("?\t",), ("\t2024-01-01",), ("\n7\r",)], "t string")
    got = profile.column_counts(df, tokens=("?",)).first()
    assert (got["n_empty"], got["n_masked"], got["n_date"], got["n_numeric"]) == (1, 1, 1, 1)
    typed = df.select(X.typed(F.col("t"), "date").isNotNull().alias("d"), X.typed(F.col("t"), "int").alias("i")).collect()
    assert [r["d"] for r in typed] == [False, False, True, False] and typed[3]["i"] == 7


def test_modes_are_typed(spark):
    nan = float("nan")
    df = spark.createDataFrame([(9, "NaN", nan), (10, "NaN", nan), (None, "NaN", 2.0), (None, "x", None)], "n int, t string, d double")
    got = clean.impute(df, {"n": "mode", "t": "mode", "d": "mode"}).collect()
    assert [r["n"] for r in got] == [9, 10, 9, 9]
    assert [r["d"] for r in got] == [2.0] * 4
    assert clean.fill_values(df, {"t": "mode"})["t"] is not None
    filled = clean.impute(df.withColumn("t", F.when(F.col("n").isNotNull(), F.col("t"))), {"t": "mode"})
    assert {r["t"] for r in filled.collect()} == {"NaN"}


def test_nan_is_missing_in_aggregates(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, nan), (3.0, 2.0), (nan, nan)], "a double, b double")
    rows = features.row_aggregates(df, ["a", "b"], "ab").collect()
    assert [(r["feat_ab_sum"], r["feat_ab_missing"]) for r in rows] == [(1.0, 1), (5.0, 0), (None, 2)]
    assert [r["feat_a_minmax"] for r in features.scale(df, ["a"], "minmax").collect()] == [0.0, 1.0, None]
    assert {r["bin"]: r["n"] for r in profile.histogram(df, ["a"], 2).collect()} == {1: 1, 2: 1}


def test_fingerprints_tell_settings_apart(spark):
    df = spark.createDataFrame([("a\u001fb", "c", 1), ("a", "b\u001fc", 1), (None, "\u0000", 1), ("\u0000", None, 1)], "m string, p string, t int")
    made = audit.run_manifest(df, ["m", "p"], "t")
    assert made.select("fingerprint").distinct().count() == 4


def test_dictionary_lists_every_feature(spark):
    df = spark.createDataFrame([("a b", "x"), ("c", None)], "t string, s string")
    spec = features.FeatureSpec
    specs = [
        spec("counts", "text", ("t",), "counts", "signs", "none", lambda d: features.text_features(d, "t")),
        spec("joined", "encoding", ("t", "s"), "joined", "both", "NULL", lambda d: features.interactions(d, [("t", "s")])),
        spec("level", "encoding", ("s",), "one-hot", "level", "0", lambda d: features.one_hot(d, "s")),
    ]
    made = features.build_features(df, specs).withColumn("feat_other", F.lit(1))
    found = {r["name"]: r for r in features.data_dictionary(made, specs).collect()}
    assert set(found) == {c for c in made.columns if c.startswith("feat_")}
    assert found["feat_t_x_s"]["min_text"] == "a b_x" and found["feat_t_x_s"]["n_missing"] == 1
    assert found["feat_t_chars"]["description"] == "signs" and found["feat_other"]["description"] == features.UNDOCUMENTED
    assert features.data_dictionary(df, specs).count() == 0


def test_contradictory_mappings_and_clashing_names(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "v string, value_ int")
    mapping = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "value string, canonical string")
    got = clean.canonicalize(df, "v", mapping)
    assert sorted(tuple(r) for r in got.collect()) == [("x", 1), ("z", 2)]
    assert [tuple(r) for r in clean.contradictory(mapping).collect()] == [("a", 2, "x")]


def test_dropped_rows_are_logged(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    (entry,) = clean.drop_log(df).collect()
    assert (entry["n_rows"], entry["n_changed"]) == (2, 1)


def test_sketches_are_near_in_two_levels(spark):
    cells = spark.range(0, 200_000, 1, 37).select(F.lit("x").alias("column_name"), F.col("id").cast("double").alias("value"))
    plan = sketched_quantiles(cells, [0.25, 0.5])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") >= 2
    low, mid = sketched_quantiles(cells, [0.25, 0.5]).first()["quantiles"]
    assert abs(low - 50_000) < 1000 and abs(mid - 100_000) < 1000
