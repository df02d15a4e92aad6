"""Outputs as files, the gate before publishing, and what readers see."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from proofline.operators import features as E
from proofline.operators.profile import flag_sensitive
from proofline.session import materialize
from proofline.sources.listing import OutputSpec, expected_outputs, listed_files, output_faults, outputs_of
from proofline.sources.publishing import NothingPublished, manifest, publish, read_published, resolve

AT = datetime(2024, 1, 1)


def faults(spark, path, specs):
    return {r["name"]: (r["status"], r["detail"]) for r in output_faults(expected_outputs(spark, specs), outputs_of(spark, str(path))).collect()}


def test_files_of_every_kind(spark, tmp_path):
    (tmp_path / "empty.parquet").write_bytes(b"")
    (tmp_path / "broken.parquet").write_bytes(b"not a table")
    (tmp_path / "rows.csv").write_text("a,b\n1,2\n")
    (tmp_path / "header.csv").write_text("a,b\n")
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "_SUCCESS").write_bytes(b"")
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "x").write_text("x")
    spark.range(5).select("id", (F.col("id") % 2).alias("p")).write.partitionBy("p").parquet(str(tmp_path / "parts"))
    listed = {r["name"] for r in listed_files(spark, str(tmp_path)).collect()}
    assert listed == {"empty.parquet", "broken.parquet", "rows.csv", "header.csv", "folder", "parts"}
    found = {r["name"]: r for r in outputs_of(spark, str(tmp_path)).collect()}
    assert (found["parts"]["n_rows"], found["parts"]["n_files"] >= 2) == (5, True)
    assert found["rows.csv"]["n_rows"] is None and found["header.csv"]["n_rows"] == 0
    specs = {name: OutputSpec("a int, b int") for name in ("rows.csv", "header.csv")}
    specs |= {name: OutputSpec() for name in ("empty.parquet", "broken.parquet", "folder", "lost")} | {"parts": OutputSpec("id bigint", 6)}
    assert faults(spark, tmp_path, specs) == {
        "empty.parquet": ("empty", None),
        "broken.parquet": ("unreadable", "1 files"),
        "header.csv": ("no rows", "0 of 1"),
        "folder": ("absent", None),
        "lost": ("absent", None),
        "parts": ("no rows", "5 of 6"),
    }


def test_a_folder_that_does_not_exist_has_no_outputs(spark, tmp_path):
    assert faults(spark, tmp_path / "nowhere", {"x": OutputSpec()}) == {"x": ("absent", None)}


def test_readers_see_the_last_run_that_passed(spark, tmp_path):
    folder, expected = str(tmp_path / "out"), {"t": OutputSpec("id bigint"), "u": OutputSpec("id bigint")}
    with pytest.raises(NothingPublished):
        resolve(spark, folder)
    both = lambda n: {"t": spark.range(n), "u": spark.range(n)}
    assert publish(spark, folder, "a", both(3), expected, at=AT) == "allow"
    # an output is missing
    assert publish(spark, folder, "b", {"t": spark.range(9)}, expected, at=AT) == "block"
    assert (read_published(spark, folder, "t").count(), read_published(spark, folder, "u").count()) == (3, 3)
    with pytest.raises(NothingPublished):
        read_published(spark, folder, "t", "b")
    # the same run once more, now complete
    assert publish(spark, folder, "b", both(4), expected, at=AT) == "allow"
    assert read_published(spark, folder, "u").count() == 4
    assert read_published(spark, folder, "u", "a").count() == 3
    with pytest.raises(ValueError, match="published already"):
        publish(spark, folder, "a", both(1), expected)
    with pytest.raises(ValueError, match="named by"):
        publish(spark, folder, "../a", both(1), expected)
    log = manifest(spark, folder).orderBy("seq").collect()
    assert [(r["run_id"], r["decision"], r["outputs"]) for r in log] == [("a", "allow", ["t", "u"]), ("b", "block", ["t"]), ("b", "allow", ["t", "u"])]
    assert "absent 'u'" in log[1]["reason"]


def test_violations_of_contracts_block_as_well(spark, tmp_path):
    found = spark.createDataFrame([(1, "size", None, 1, "block", "Table has 0 rows")], "seq int, check string, column_name string, n long, severity string, message string")
    assert publish(spark, str(tmp_path), "a", {"t": spark.range(1)}, {"t": OutputSpec()}, found, AT) == "block"
    assert not os.path.exists(tmp_path / "t")


def spec(name, batch, sources, build):
    return E.FeatureSpec(name, batch, sources, "", "", "", build)


def test_flags_go_through_features_of_features(spark):
    df = flag_sensitive(spark.range(20).select("id", (F.col("id") % 3).alias("sex"), F.lit(2.0).alias("limit")), ["sex"])
    specs = [
        spec("scaled", "scaling", ("feat_share",), E.Scaled("feat_share")),
        spec("share", "ratio", ("limit", "people"), lambda d: E.ratio_of("limit", "feat_people")),
        spec("people", "aggregate", ("sex",), E.Grouped(("sex",), {"people": "count(*)"})),
        spec("double", "ratio", ("limit",), lambda d: F.col("limit") * 2),
    ]
    made = E.build_features(df, specs)
    flagged = {f.name: f.metadata.get("from") for f in made.schema if f.metadata.get("sensitive")}
    assert flagged == {"sex": None, "feat_people": "sex", "feat_share": "sex", "feat_scaled": "sex"}
    rows = {(r["feature"], r["source"], r["sensitive"]) for r in E.feature_lineage(made).collect()}
    assert rows == {
        ("feat_people", "sex", True), ("feat_share", "sex", True), ("feat_share", "limit", False),
        ("feat_scaled", "sex", True), ("feat_scaled", "limit", False), ("feat_double", "limit", False),
    }
    # a second run on top of the first goes on from its sources
    again = E.build_features(made, [spec("more", "ratio", ("feat_scaled",), lambda d: F.col("feat_scaled") + 1)])
    assert again.schema["feat_more"].metadata["from"] == "sex"


def test_a_source_that_nobody_knows_is_refused(spark):
    with pytest.raises(ValueError, match="unknown sources"):
        E.build_features(spark.range(3), [spec("x", "ratio", ("nothing",), lambda d: F.col("id"))])
    # a batch sees earlier ones only
    later = [spec("y", "ratio", ("z",), lambda d: F.col("id")), spec("z", "scaling", ("id",), E.Scaled("id"))]
    with pytest.raises(ValueError, match="unknown sources"):
        E.build_features(spark.range(3), later)


def test_specs_share_shuffles_and_scans(spark, monkeypatch):
    calls = {"groups": [], "scans": []}
    real = E.group_aggregates, E.scaled_by
    monkeypatch.setattr(E, "group_aggregates", lambda df, keys, aggs: calls["groups"].append((keys, sorted(aggs))) or real[0](df, keys, aggs))
    monkeypatch.setattr(E, "scaled_by", lambda df, wanted: calls["scans"].append(list(wanted)) or real[1](df, wanted))
    df = materialize(spark.range(30).select("id", (F.col("id") % 3).alias("k"), (F.col("id") % 2).alias("l")))
    specs = [
        spec("n", "aggregate", ("k",), E.Grouped(("k",), {"n": "count(*)"})),
        spec("m", "aggregate", ("l",), E.Grouped(("l",), {"m": "count(*)"})),
        spec("top", "aggregate", ("k", "id"), E.Grouped(("k",), {"top": F.max("id")})),
        *[spec(f"s{c}{m}", "scaling", (c,), E.Scaled(c, m)) for c in ("id", "feat_top") for m in ("standard", "minmax")],
    ]
    made = E.build_features(df, specs)
    assert calls["groups"] == [(("k",), ["n", "top"]), (("l",), ["m"])]
    assert calls["scans"] == [[(c, m) for c in ("feat_top", "id") for m in ("minmax", "standard")]]
    row = made.where("id = 4").first()
    assert (row["feat_n"], row["feat_m"], row["feat_top"], row["feat_sidminmax"]) == (10, 15, 28, 4 / 29)
    assert made.count() == 30


def test_kept_tables_hold_what_parquet_cannot_name(spark):
    odd = spark.range(3).select(
        F.col("id").alias("a"), F.lit("x").alias("A"), F.lit(1).alias("with ,;{}()=\n"), F.lit(None).cast("int").alias("n", metadata={"sensitive": True}),
        F.create_map(F.lit("k"), F.col("id")).alias("m"),
    )
    kept = materialize(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert kept.schema["n"].metadata == {"sensitive": True}
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))
    void = materialize(spark.range(2).select("id", F.lit(None).alias("nothing")))
    assert void.dtypes == [("id", "bigint"), ("nothing", "void")] and void.count() == 2
