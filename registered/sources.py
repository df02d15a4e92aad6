"""A1 to A5: write, then read back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators.audit import audit_rows
from proofline.operators.contract import CHECKS, Contract, run_contract
from proofline.operators.profile import flag_sensitive, null_profile, top_values
from proofline.session import scratch_path
from proofline.sources.raw_csv import read_raw_csv
from proofline.sources.sinks import append_log, handoff_metadata, write_reports, write_table
from registered.base import (
    DIRTY_CUSTOMERS_SQL,
    DIRTY_ORDERS_SQL,
    ORDER_COLUMNS,
    count_class,
    dirty_customers,
    dirty_orders,
    query,
    table,
    union_all,
)


@query(
    "raw_csv_scan",
    f"WITH {DIRTY_ORDERS_SQL} SELECT " + ", ".join(f"{c} AS c{i}" for i, c in enumerate(ORDER_COLUMNS)) + " FROM raw",
)
def raw_csv_scan(spark, sf):
    path = scratch_path(spark, "raw-orders")
    # blanks at the edges of a cell are part of the raw text
    dirty_orders(spark, sf).write.option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false"
    ).csv(path, header=True, nullValue="", emptyValue='""')
    rows, header = read_raw_csv(spark, path)
    if header != ORDER_COLUMNS:
        raise ValueError(f"unexpected header {header}")
    return rows.drop("_malformed")


_SINKS_SQL = "l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity, CAST(sum(l_linenumber) AS BIGINT) AS numbers, max(l_shipdate) AS last_day FROM lineitem GROUP BY l_returnflag"


@query("table_sinks", f"SELECT 'parquet' AS format, {_SINKS_SQL} UNION ALL SELECT 'csv', {_SINKS_SQL}")
def table_sinks(spark, sf):
    items = table(spark, sf, "lineitem")
    found = []
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, f"items-{fmt}")
        write_table(items, path, fmt)
        reader = spark.read.schema(items.schema)
        back = reader.csv(path, header=True) if fmt == "csv" else reader.parquet(path)
        found.append(
            back.groupBy(F.lit(fmt).alias("format"), "l_returnflag").agg(
                F.count("*").alias("n"),
                F.round(F.sum("l_quantity"), 2).alias("quantity"),
                F.sum("l_linenumber").alias("numbers"),
                F.max("l_shipdate").alias("last_day"),
            )
        )
    return found[0].unionByName(found[1])


CUSTOMER_TYPES = [("customer_id", "bigint", "false"), ("nation", "string", "true"), ("segment", "string", "false")]


@query(
    "handoff_metadata",
    f"WITH {DIRTY_CUSTOMERS_SQL} "
    + union_all(
        [
            f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, {s} AS sensitive, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM raw"
            for i, (c, t, s) in enumerate(CUSTOMER_TYPES)
        ]
    ),
)
def handoff(spark, sf):
    df = flag_sensitive(dirty_customers(spark, sf), ["nation"])
    path = scratch_path(spark, "customers")
    # the flags must survive the table format
    write_table(df, path)
    back = spark.read.parquet(path)
    filled = null_profile(back).select("column_name", "n_rows", "n_null")
    return handoff_metadata(back).join(F.broadcast(filled), "column_name").select(
        "position", "column_name", "data_type", "sensitive", "n_rows", "n_null"
    )


@query(
    "append_log",
    f"""WITH {DIRTY_ORDERS_SQL}, v AS (
      SELECT 0 AS duplicate_columns,
        {" + ".join(f"CAST((({count_class(c, 'numeric', False)}) > 0)::INT + (({count_class(c, 'date', False)}) > 0)::INT + (({count_class(c, 'string', False)} + {count_class(c, 'empty', False)}) > 0)::INT > 1 AS INT)" for c in ORDER_COLUMNS)} AS mixed_types,
        CAST(count(*) FILTER (WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) > 0 AS INT) AS formats
      FROM raw)
    SELECT 'duplicate_columns' AS "check", 2 AS n_records, CASE WHEN duplicate_columns > 0 THEN 'fail' ELSE 'pass' END AS result, 2 * duplicate_columns AS n_violations FROM v
    UNION ALL SELECT 'structure', 2, 'pass', 0 FROM v UNION ALL SELECT 'row_shape', 2, 'pass', 0 FROM v
    UNION ALL SELECT 'mixed_types', 2, CASE WHEN mixed_types > 0 THEN 'fail' ELSE 'pass' END, 2 * mixed_types FROM v
    UNION ALL SELECT 'formats', 2, CASE WHEN formats > 0 THEN 'fail' ELSE 'pass' END, 2 * formats FROM v""",
)
def appended_log(spark, sf):
    contract = Contract(patterns={"priority": r"^[1-5]-[A-Z ]+$"})
    violations = run_contract(dirty_orders(spark, sf), contract)
    path = scratch_path(spark, "run-log")
    for run in ("first", "second"):
        at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        append_log(audit_rows(violations, contract.active(), run, at), path)
    log = spark.read.schema("check string, result string, run_id string, n_violations bigint").json(path)
    return log.groupBy("check", "result").agg(
        F.count("*").cast("int").alias("n_records"), F.sum("n_violations").alias("n_violations")
    )


@query(
    "report_tables",
    union_all(
        [f"SELECT 'nulls' AS report, '{c}' AS name, count(*) AS n FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")]
    )
    + " UNION ALL SELECT 'top', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus",
)
def report_tables(spark, sf):
    orders = table(spark, sf, "orders")
    folder = scratch_path(spark, "reports")
    write_reports(
        {"nulls": null_profile(orders), "top": top_values(orders, ["o_orderstatus"], 10)},
        folder,
    )
    nulls = spark.read.parquet(f"{folder}/nulls").selectExpr("'nulls' AS report", "column_name AS name", "n_rows AS n")
    top = spark.read.parquet(f"{folder}/top").selectExpr("'top' AS report", "value AS name", "n")
    return nulls.unionByName(top)
