"""Deliverables of whole runs: staged, gated as files, published, and read back."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.operators import features as E
from proofline.operators.audit import audit_rows, recurring
from proofline.operators.contract import Contract, run_contract
from proofline.operators.profile import flag_sensitive, null_profile
from proofline.plans.deliverables import deliver
from proofline.plans.preparation import prepare
from proofline.session import materialize, scratch_path
from proofline.sources.listing import OutputSpec, expected_outputs, output_faults, outputs_of
from proofline.sources.publishing import manifest, publish, read_published
from proofline.sources.sinks import append_log, handoff_metadata, write_table
from registered.base import DIRTY_ORDERS_SQL, ORDER_COLUMNS, count_class, dirty_orders, query, table, union_all
from registered.engineering import BUILT_SQL, order_line_specs, order_lines
from registered.handoffs import order_recipe

ORDERS_DDL = "o_orderkey bigint, o_custkey bigint, o_totalprice double"
RUNS = {
    # run: what it takes of the orders, and whether it does its job
    "first": ("o_orderstatus <> 'P'", True),
    "second": ("o_orderstatus = 'F'", False),
    "third": ("o_orderstatus = 'O'", True),
}


def order_outputs(spark, sf, rows: str, good: bool) -> dict[str, DataFrame]:
    """Orders and their totals by customer; a run that fails drops a column and writes no totals."""
    orders = table(spark, sf, "orders").where(rows).select("o_orderkey", "o_custkey", "o_totalprice")
    totals = orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return {"orders": orders if good else orders.drop("o_custkey"), "totals": totals.where(F.lit(good))}


@query(
    "published_versions",
    "WITH seen AS (SELECT run, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_totals FROM orders JOIN (VALUES ('first', 'P', false), ('third', 'O', true)) v(run, s, is_s) "
    "ON (o_orderstatus = s) = is_s GROUP BY run) "
    "SELECT t.run_id, t.seq, t.decision, t.reason, seen.n_orders, seen.n_totals FROM (VALUES ('first', 1, 'allow', 'All handoff contract checks passed.', 'first'), "
    "('second', 2, 'block', 'Handoff contract violations: wrong columns: lacks o_custkey ''orders'' (1); no rows: 0 of 1 ''totals'' (1)', 'first'), "
    "('third', 3, 'allow', 'All handoff contract checks passed.', 'third')) t(run_id, seq, decision, reason, visible) JOIN seen ON seen.run = t.visible",
)
def published_versions(spark, sf):
    folder = scratch_path(spark, "published")
    expected = {"orders": OutputSpec(ORDERS_DDL), "totals": OutputSpec("o_custkey bigint, total double")}
    seen = []
    for run, (rows, good) in RUNS.items():
        publish(spark, folder, run, order_outputs(spark, sf, rows, good), expected, at=datetime(2024, 1, 1))
        # what a reader sees after each run
        counts = [read_published(spark, folder, name).agg(F.count("*")).scalar().alias(f"n_{name}") for name in expected]
        seen.append(spark.range(1).select(F.lit(run).alias("run_id"), *counts))
    visible = seen[0].unionByName(seen[1]).unionByName(seen[2])
    return manifest(spark, folder).join(F.broadcast(visible), "run_id").select("run_id", "seq", "decision", "reason", "n_orders", "n_totals")


@query(
    "output_structure",
    "SELECT t.*, CASE WHEN name IN ('good', 'retyped', 'renamed', 'mixed') THEN (SELECT count(*) FROM orders) * CASE name WHEN 'mixed' THEN 2 ELSE 1 END "
    "WHEN name = 'no_rows' THEN 0 END AS n_rows FROM (VALUES ('good', 'as expected', NULL), ('absent', 'absent', NULL), ('no_bytes', 'empty', NULL), ('no_rows', 'no rows', '0 of 1'), "
    "('retyped', 'wrong columns', 'type of o_totalprice string'), ('renamed', 'wrong columns', 'lacks o_custkey; has customer'), ('mixed', 'mixed columns', '2 structures')) t(name, status, detail)",
)
def output_structure(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    folder = scratch_path(spark, "outputs")
    retyped = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    for name, df in {
        "good": orders,
        "no_rows": orders.where("false"),
        "retyped": retyped,
        "renamed": orders.withColumnRenamed("o_custkey", "customer"),
        "mixed": orders,
    }.items():
        write_table(df, f"{folder}/{name}")
    write_table(retyped, f"{folder}/mixed", mode="append")
    # a text file without a line has no bytes
    orders.where("false").selectExpr("CAST(o_orderkey AS STRING) AS value").coalesce(1).write.text(f"{folder}/no_bytes")
    names = ("good", "absent", "no_bytes", "no_rows", "retyped", "renamed", "mixed")
    expected = expected_outputs(spark, {name: OutputSpec(ORDERS_DDL) for name in names})
    found = materialize(outputs_of(spark, folder))
    faults = output_faults(expected, found)
    # one row per output
    listed = expected.select("name").join(F.broadcast(faults), "name", "left").join(F.broadcast(found.select("name", "n_rows")), "name", "left")
    return listed.select("name", F.coalesce("status", F.lit("as expected")).alias("status"), "detail", "n_rows")


_FLAGGED = {
    # feature: its sensitive sources, and all its sources
    "pieces": ("l_quantity", "l_orderkey,l_quantity"),
    "ordered_year": (None, "o_orderdate"),
    "priority_length": ("o_orderpriority", "o_orderpriority"),
    "tax_to_discount": (None, "l_discount,l_tax"),
    "net": (None, "l_discount,l_extendedprice"),
    "share_of_order": ("l_quantity", "l_orderkey,l_quantity"),
    "returned": (None, "l_returnflag"),
    "net_scaled": (None, "l_discount,l_extendedprice"),
}


@query(
    "feature_flags",
    f"WITH {BUILT_SQL} "
    + union_all(
        [
            f"SELECT 'feat_{name}' AS column_name, {str(flagged is not None).lower()} AS sensitive, CAST({f"'{flagged}'" if flagged else 'NULL'} AS VARCHAR) AS flagged_from, "
            f"'{sources}' AS comes_from, count(*) AS n_rows, count(*) - count(feat_{name}) AS n_null FROM g"
            for name, (flagged, sources) in _FLAGGED.items()
        ]
    ),
)
def feature_flags(spark, sf):
    lines = flag_sensitive(order_lines(spark, sf), ["o_orderpriority", "l_quantity"])
    made = E.features_only(E.build_features(materialize(lines), order_line_specs()))
    path = scratch_path(spark, "features")
    # what the next stage gets
    write_table(made, path)
    back = spark.read.parquet(path)
    origin = E.feature_lineage(back).groupBy("feature").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("sensitive"), F.col("source")))), ",").alias("flagged_from"),
        F.array_join(F.array_sort(F.collect_list("source")), ",").alias("comes_from"),
    )
    filled = null_profile(back).select("column_name", "n_rows", "n_null")
    # one row per feature in all of them
    found = handoff_metadata(back).join(F.broadcast(origin), F.col("column_name") == F.col("feature")).join(F.broadcast(filled), "column_name")
    flagged = F.when(F.col("flagged_from") != "", F.col("flagged_from"))
    return found.select("column_name", "sensitive", flagged.alias("flagged_from"), "comes_from", "n_rows", "n_null")


def order_feature_specs() -> list[E.FeatureSpec]:
    """Features of prepared orders."""
    spec = E.FeatureSpec
    return [
        spec("month", "date-time", ("ordered_on",), "month", "month of the order", "NULL without a date", lambda df: F.month("ordered_on")),
        spec("priority_length", "text", ("priority",), "length", "length of the priority", "none", lambda df: F.length("priority")),
        spec("orders_of_client", "aggregate", ("client",), "count", "orders of the client", "none", E.Grouped(("client",), {"orders_of_client": "count(*)"})),
        spec("latest", "aggregate", ("client", "ordered_on"), "latest", "last day of the client", "NULL without a date", E.Grouped(("client",), {"latest": "max(ordered_on)"})),
        spec("open", "encoding", ("status",), "0/1", "order is open", "0", lambda df: F.coalesce(F.col("status") == "O", F.lit(False)).cast("int")),
        spec("busy", "scaling", ("feat_orders_of_client",), "standard", "orders of the client, scaled", "NULL without spread", E.Scaled("feat_orders_of_client")),
    ]


@query(
    "deliverables",
    f"""WITH {DIRTY_ORDERS_SQL}, r AS (SELECT *, customer LIKE 'C%' AS unsure, ordered_on = 'soon' AS undated FROM raw),
    mode AS (SELECT customer FROM r WHERE NOT unsure GROUP BY customer ORDER BY count(*) DESC, CAST(customer AS BIGINT) LIMIT 1),
    c AS (SELECT CASE WHEN unsure THEN (SELECT customer FROM mode) ELSE customer END AS client, bool_and(undated) AS never, count(*) AS n FROM r GROUP BY 1)
    SELECT 'features' AS deliverable, 'rows' AS name, count(*) AS n FROM r
    UNION ALL SELECT 'data_dictionary', 'feat_month', count(*) FILTER (WHERE undated) FROM r
    UNION ALL SELECT 'data_dictionary', 'feat_latest', coalesce(CAST(sum(n) FILTER (WHERE never) AS BIGINT), 0) FROM c
    UNION ALL SELECT 'data_dictionary', x, 0 FROM (VALUES ('feat_priority_length'), ('feat_orders_of_client'), ('feat_open'), ('feat_busy')) v(x)
    UNION ALL SELECT 'handoff', x, 1 FROM (VALUES ('feat_latest'), ('feat_orders_of_client'), ('feat_busy')) v(x)
    UNION ALL SELECT 'transformation_report', 'status: upper case', count(*) FILTER (WHERE status <> upper(trim(status))) FROM raw
    UNION ALL SELECT 'transformation_report', x, 0 FROM (VALUES ('id: renamed from order_id'), ('client: renamed from customer'), ('client: masked null to NULL'), ('ordered_on: masked null to NULL')) v(x)
    UNION ALL SELECT 'transformation_report', 'client: text to bigint', count(*) FILTER (WHERE unsure) FROM r
    UNION ALL SELECT 'transformation_report', 'client: missing values filled by the mode', count(*) FILTER (WHERE unsure) FROM r
    UNION ALL SELECT 'transformation_report', 'ordered_on: text to date', count(*) FILTER (WHERE undated) FROM r
    UNION ALL SELECT 'transformation_report', 'priority: missing values filled by a constant', count(*) FILTER (WHERE priority IS NULL) FROM raw""",
)
def deliverables(spark, sf):
    folder = scratch_path(spark, "deliveries")
    recipe = replace(order_recipe(), sensitive=["client"])
    made = prepare(dirty_orders(spark, sf), recipe)
    settled = lambda asked: asked.select("proposal", F.lit("none").alias("outcome"))
    if deliver(made, order_feature_specs(), ["id"], folder, "run-1", settled, datetime(2024, 1, 1)) != "allow":
        raise ValueError(manifest(spark, folder).first()["reason"])
    read = {name: read_published(spark, folder, name) for name in ("features", "data_dictionary", "transformation_report", "handoff")}
    parts = [
        read["features"].agg(F.lit("features").alias("deliverable"), F.lit("rows").alias("name"), F.count("*").alias("n")),
        read["data_dictionary"].select(F.lit("data_dictionary"), "name", "n_missing"),
        # the flag of the client is on the features made from it
        read["handoff"].where("sensitive").select(F.lit("handoff"), "column_name", F.lit(1).cast("long")),
        read["transformation_report"].where("score = 95").select(F.lit("transformation_report"), F.concat_ws(": ", "column_name", "what"), "n_changed"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    "recurring_failures_of_runs",
    f"""WITH {DIRTY_ORDERS_SQL}, v AS (SELECT upper(trim(status)) AS run,
      {" + ".join(f"CAST((({count_class(c, 'numeric', False)}) > 0)::INT + (({count_class(c, 'date', False)}) > 0)::INT + (({count_class(c, 'string', False)} + {count_class(c, 'empty', False)}) > 0)::INT > 1 AS INT)" for c in ORDER_COLUMNS)} AS mixed_types,
      CAST(count(*) FILTER (WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) > 0 AS INT) AS formats FROM raw GROUP BY 1)
    SELECT * FROM (SELECT 'mixed_types' AS "check", count(*) FILTER (WHERE mixed_types > 0) AS n_failures, count(*) FILTER (WHERE mixed_types > 0) AS n_runs FROM v
    UNION ALL SELECT 'formats', count(*) FILTER (WHERE formats > 0), count(*) FILTER (WHERE formats > 0) FROM v) WHERE n_failures > 0""",
)
def recurring_failures_of_runs(spark, sf):
    contract = Contract(patterns={"priority": r"^[1-5]-[A-Z ]+$"})
    orders = materialize(dirty_orders(spark, sf))
    path = scratch_path(spark, "gate-log")
    for run in "FOP":
        # every gate leaves its records in the log; the questions are asked of what lies there
        violations = run_contract(orders.where(F.upper(F.trim("status")) == run), contract)
        append_log(audit_rows(violations, contract.active(), run, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), path)
    log = spark.read.schema("run_id string, checked_at timestamp_ntz, check string, result string, n_violations long").json(path)
    return recurring(log.where("result = 'fail'"), ["check"], "run_id", 10)
