"""Edges: empty tables, all-null columns, zero denominators, single values, skew, repartitioning."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from proofline.functions import lookups
from proofline.functions.expressions import typed
from proofline.functions.ordered import exact_quantiles, row_numbers, running_totals, top_per_group
from proofline.operators import audit as G
from proofline.operators import clean as D
from proofline.operators import contract as C
from proofline.operators import evaluate as M
from proofline.operators import features as E
from proofline.operators import profile as P
from tests.oracle import connect, difference, from_duck, from_spark


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b double")
    row = P.null_profile(empty).where("column_name = 'b'").first()
    assert (row["n_rows"], row["n_null"], row["missing_share"]) == (0, 0, None)
    summary = P.numeric_summary(empty).first()
    assert (summary["n"], summary["mean"], summary["median"]) == (0, None, None)
    assert P.quality_issues(empty).count() == 0
    assert P.cardinality(empty, ["a"]).first()["n_distinct"] == 0


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    assert P.numeric_summary(df, ["v"]).first()["median"] is None
    assert P.histogram(df, ["v"], 5).count() == 0
    filled = D.impute(df, {"v": ("constant", 7.0)}).collect()
    assert [r["v"] for r in filled] == [7.0, 7.0]
    assert [r["v"] for r in D.impute(df, {"v": "mean"}).collect()] == [None, None]


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r["feat_r"] for r in E.ratio(df, "a", "b", "r").collect()] == [None, None, 0.5]


def test_single_valued_column(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    assert {r["feat_v_standard"] for r in E.scale(df, ["v"]).collect()} == {None}
    assert {r["feat_v_minmax"] for r in E.scale(df, ["v"], "minmax").collect()} == {None}
    bins = P.histogram(df, ["v"], 5).collect()
    assert [(b["bin"], b["n"]) for b in bins] == [(1, 4)]


@pytest.mark.parametrize(
    "text,type_name,wanted",
    [
        ("5", "int", 5),
        (" 5 ", "bigint", 5),
        ("5.5", "int", None),
        ("99999999999", "int", None),
        ("1e3", "double", 1000.0),
        ("12d", "double", None),
        ("NaN", "double", None),
        ("", "double", None),
        ("2024/02/29", "date", "2024-02-29"),
        ("2023-02-29", "date", None),
    ],
)
def test_typing_of_text(spark, text, type_name, wanted):
    got = spark.createDataFrame([(text,)], "v string").select(typed(F.col("v"), type_name)).first()[0]
    assert (str(got) if type_name == "date" and got else got) == wanted


def test_exact_quantiles_against_brute_force(spark):
    rng = random.Random(7)
    # a third of the rows share one value
    values = [50.0] * 1000 + [rng.uniform(0, 100) for _ in range(2001)] + [math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    clean = sorted(v for v in values if v is not None and not math.isnan(v))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        rank = p * (len(clean) - 1)
        low, high = clean[math.floor(rank)], clean[math.ceil(rank)]
        assert got[p] == pytest.approx(low + (high - low) * (rank - math.floor(rank)))


def test_quantiles_survive_a_sketch_that_misses(spark, monkeypatch):
    from proofline.functions import ordered

    real = ordered._segment_counts

    def off(df, cols, probs):
        # brackets that hold no wanted rank
        return real(df, cols, probs).withColumn("value", F.lit(None).cast("double")).groupBy(
            "column_name", "segment", "value"
        ).agg(F.sum("n").alias("n"))

    monkeypatch.setattr(ordered, "_segment_counts", off)
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert [r["value"] for r in exact_quantiles(df, ["v"], [0.5]).collect()] == [50.0]


def test_running_totals_restart_per_group(spark):
    rows = [(g, v, v % 5 + 1) for g in "abc" for v in range(50)]
    df = spark.createDataFrame(rows, "g string, v int, n bigint").repartition(5)
    got = running_totals(df, ["g", "v"], {"before": "n"}, within=["g"]).collect()
    for r in got:
        assert r["before"] == sum(v % 5 + 1 for v in range(r["v"]))
        assert r["before_all"] == sum(v % 5 + 1 for v in range(50))
    assert len(got) == 150


def test_row_numbers_are_global(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(9)
    assert all(r["v"] == r["i"] for r in row_numbers(df, ["v"], "i").collect())


def test_top_per_group_beyond_the_group_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        got = top_per_group(df, ["g"], [F.desc("v")], 20).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert sorted(r["v"] for r in got) == list(range(4960, 5000))


def skewed(spark, n=3000):
    # a third of the rows share one key, some have none
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 97)
    return spark.range(n).select(key.cast("int").alias("k"), F.col("id").alias("v"))


def test_join_unique_equals_a_plain_join_on_skewed_keys(spark):
    big = skewed(spark)
    lookup = spark.range(50).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("twice"))
    # with keys of every size spread, with the hot ones only, and with none
    for how, target in (("left", 10), ("inner", 10), ("left", 100), ("inner", None)):
        got = lookups.join_unique(big, lookup, ["k"], how, target).select("k", "v", "twice")
        wanted = big.join(lookup, "k", how).select("k", "v", "twice")
        assert got.count() == wanted.count()
        assert got.exceptAll(wanted).isEmpty()


def test_hot_keys_finds_the_hot_key(spark):
    hot = {r[lookups.HOT]: r[lookups.PARTS] for r in lookups.hot_keys(skewed(spark), ["k"], 100).collect()}
    wanted, none = spark.range(1).select(F.xxhash64(F.lit(0)), F.xxhash64(F.lit(None).cast("int"))).first()
    n = skewed(spark).where("k = 0").count()
    missing = skewed(spark).where("k IS NULL").count()
    assert hot == {wanted: -(-n // 100), none: -(-missing // 100)}


@pytest.fixture
def no_broadcast(monkeypatch):
    """Take the way for tables that are too large to broadcast."""
    for module in (lookups, C, E, D):
        if hasattr(module, "fits_broadcast"):
            monkeypatch.setattr(module, "fits_broadcast", lambda *a, **k: False)


def test_large_lookup_ways_give_the_same(spark, no_broadcast, sf):
    con = connect(sf)
    for name in (
        "unresolved_refs",
        "jargon_hits_of_term_table",
        "label_codes",
        "label_codes_of_many_values",
        "canonical_values_from_table",
        "group_aggregates",
    ):
        got = from_spark(queries()[name](spark, sf))
        assert difference(got, from_duck(con, oracle_sql()[name])) is None, name


def test_lookup_size_is_measured(spark):
    assert lookups.fits_broadcast(spark.range(10))
    assert not lookups.fits_broadcast(spark.range(11), rows=10)
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert not lookups.fits_broadcast(wide, size=2000)
    assert lookups.fits_broadcast(spark.range(0))


def test_label_codes_keep_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "v string")
    got = {(r["v"], r["feat_v_code"]) for r in E.label_encode(df, "v").collect()}
    assert got == {("a", 0), ("b", 1), (None, None)}


def test_one_hot_of_many_levels_and_of_other_casing(spark):
    wide = E.one_hot(spark.range(60), "id")
    assert len(wide.columns) == 61
    df = spark.createDataFrame([("F",), ("f",), (None,), ("P",)], "v string")
    made = E.one_hot(df, "v")
    assert made.columns == ["v", "feat_v_F", "feat_v_P", "feat_v_f_2"]
    assert [tuple(r)[1:] for r in made.collect()] == [(1, 0, 0), (0, 0, 1), (0, 0, 0), (0, 1, 0)]
    other = spark.createDataFrame([("Q",), ("P",)], "v string")
    fitted = E.one_hot(other, "v", fit_on=df)
    assert fitted.columns == made.columns
    assert sorted(tuple(r) for r in fitted.collect()) == [("P", 0, 1, 0), ("Q", 0, 0, 0)]
    long = E.one_hot_long(df.withColumn("k", F.lit(1)), ["k"], "v")
    assert sorted(r["level"] for r in long.collect()) == ["F", "P", "f"]


def test_auc_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 9))) for _ in range(200)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    df = spark.createDataFrame(rows, "y int, s double").repartition(6)
    assert M.auc_table(df, ["s"], "y").first()["auc"] == pytest.approx(wins / len(pos) / len(neg))


def test_metrics_of_one_class_only(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.9)], "y int, s double")
    row = M.binary_metrics(df, "y", "s").first()
    assert (row["accuracy"], row["f1"], row["auc"]) == (0.5, 0.0, None)


def test_split_ignores_partitioning(spark):
    a, _ = M.split(spark.range(1000), "id")
    b, _ = M.split(spark.range(1000).repartition(13), "id")
    assert {r["id"] for r in a.collect()} == {r["id"] for r in b.collect()}
    assert 750 < a.count() < 850


def test_repartitioning_changes_nothing(spark):
    rows = [(i, ["x", "X", " x", "y"][i % 4], i % 7 / 7, "?" if i % 9 == 0 else str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, c string, v double, t string")
    other = df.repartition(11)
    rules = P.ProfileRules(categories=["c", "t"])
    for made in (
        lambda d: P.quality_issues(d, rules),
        lambda d: P.top_values(d, ["c"], 2),
        lambda d: P.case_variants(d, "c"),
        lambda d: C.run_contract(d, C.Contract(categories=["c"])),
        lambda d: E.group_aggregates(d, ["c"], {"n": F.count("*")}),
        lambda d: E.label_encode(d, "c"),
    ):
        left, right = made(df), made(other)
        assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def test_cleaning_twice_equals_once(spark):
    df = spark.createDataFrame([("?", " A"), ("1", "a"), (None, "B ")], "v string, c string")

    def clean(d):
        return D.fold_case(D.unmask_nulls(d, ["v"]), ["c"])

    once = clean(df)
    assert clean(once).collect() == once.collect()


def test_impute_from_the_training_side(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 99.0)], "k int, v double")
    filled = D.impute(df, {"v": "median"}, fit_on=df.where("k < 3"))
    assert [r["v"] for r in filled.orderBy("k").collect()] == [10.0, 10.0, 99.0]


def test_mode_takes_the_least_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert [r["v"] for r in D.impute(df, {"v": "mode"}).where("v = 'a'").collect()] == ["a"] * 3


def test_canonical_diff_tells_null_from_empty(spark):
    bank = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    found = spark.createDataFrame([(1, ""), (2, "x"), (2, "x"), (4, "z")], "k int, v string")
    got = {r["k"]: r["status"] for r in C.canonical_diff(found, bank, "k", ["v"]).collect()}
    assert got == {1: "changed", 2: "repeated", 3: "missing", 4: "extra"}


def test_flags_survive_steps_and_tables(spark, tmp_path):
    df = P.flag_sensitive(spark.createDataFrame([(1, "f")], "k int, sex string"), ["sex"])
    stepped = D.apply_steps(df, [D.Step("sex", "fold", "one spelling", lambda c: F.upper(c))])
    stepped.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert P.sensitive_columns(back).where("flagged_by = 'metadata'").first()["column_name"] == "sex"


def test_caveats_score_sixty_seven(spark):
    rows = [
        ("feat_bill_to_limit_ratio", "caveat"),
        ("feat_bill_to_limit_ratio", "resolved"),
        ("feat_bill_to_limit_ratio", "none"),
        ("clear", "none"),
        ("settled", "resolved"),
        ("turned_down", "rejected"),
        ("turned_down", "none"),
        ("open", "pending"),
    ]
    got = {r["proposal"]: (r["score"], r["band"]) for r in E.confidence(spark.createDataFrame(rows, "proposal string, outcome string")).collect()}
    assert got == {
        "feat_bill_to_limit_ratio": (67, "medium"),
        "clear": (95, "high"),
        "settled": (82, "high"),
        "turned_down": (35, "low"),
        "open": (None, None),
    }


def test_unknown_batch_is_refused(spark):
    spec = E.FeatureSpec("x", "later", ("id",), "", "", "", lambda df: F.lit(1))
    with pytest.raises(ValueError, match="later"):
        E.build_features(spark.range(3), [spec])


def test_trace_back_of_a_busy_entity(spark):
    log = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "busy").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("entity"),
        F.col("id").alias("at"),
        F.concat(F.lit("x"), F.col("id")).alias("what"),
    )
    rows = G.trace_back(log, "entity", ["at"], 2, "what").where("entity = 'busy'").orderBy("step").collect()
    assert [(r["what"], r["previous"]) for r in rows] == [("x1998", "x1995"), ("x1995", "x1992")]


def test_phrases_overlap(spark):
    docs = spark.createDataFrame([(1, "Go go go, Machine  learning!"), (2, None), (3, "")], "k int, t string")
    got = {(r["k"], r["term"], r["n"]) for r in C.jargon_hits(docs, "k", "t", ["go go", "machine learning", "go"]).collect()}
    assert got == {(1, "go go", 2), (1, "machine learning", 1), (1, "go", 3)}
    terms = spark.createDataFrame([("go go",), ("Machine Learning",), ("go",)], "term string")
    assert got == {(r["k"], r["term"], r["n"]) for r in C.jargon_hits(docs, "k", "t", terms).collect()}


def test_fitted_weights_have_no_gradient(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((a, b, int(rng.random() < 1 / (1 + math.exp(-(0.5 + 1.5 * a - b))))))
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = M.fit_logit(df, ["a", "b"], "y", max_iter=100)
    # at the optimum the residuals are orthogonal to every feature
    left = model.score(df).agg(
        *[F.avg((F.col("score") - F.col("y")) * x) for x in (F.lit(1.0), F.col("a"), F.col("b"))]
    ).first()
    assert all(abs(v) < 1e-4 for v in left)


def test_hot_entity_gets_its_aggregates(spark):
    got = E.group_aggregates(skewed(spark), ["k"], {"rows": F.count("*"), "top": F.max("v")})
    wanted = {r["k"]: (r["n"], r["m"]) for r in skewed(spark).groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m")).collect()}
    rows = got.collect()
    assert len(rows) == 3000
    assert all((r["feat_rows"], r["feat_top"]) == (wanted[r["k"]] if r["k"] is not None else (None, None)) for r in rows)


def test_plan_of_typed_and_nested_columns(spark):
    df = spark.createDataFrame(
        [(1, [1.0], "a", float("nan")), (2, None, "", 1.0)], "k int, v array<double>, t string, d double"
    )
    got = {r["column_name"]: (r["n_null"], r["n_empty"], r["n_numeric"], r["n_string"]) for r in P.type_profile(df).collect()}
    assert got == {"k": (0, 0, 2, 0), "v": (1, 0, 0, 1), "t": (0, 1, 0, 1), "d": (1, 0, 1, 0)}


def test_copies_of_a_hot_row_spread(spark):
    # a third of the rows are copies of one row, in many input partitions
    copies = spark.range(0, 4000, 1, 40).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("k")
    )
    lookup = spark.range(4000).select(F.col("id").cast("int").alias("k"), (F.col("id") + 1).alias("next"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookups.join_unique(copies, lookup, ["k"], target=100).withColumn("task", F.spark_partition_id())
        sizes = [r["n"] for r in got.groupBy("task").agg(F.count("*").alias("n")).collect()]
        wrong = got.where("next <> k + 1").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 4000 and wrong == 0
    # evenly cut, each of the 8 tasks holds 500 rows; unsalted, one would hold over 1600
    assert max(sizes) < 1000
