"""B1 to B13."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators import profile as P
from proofline.functions.longform import long_values
from proofline.operators.clean import rename
from registered.base import (
    DIRTY_CUSTOMERS_SQL,
    DIRTY_ORDERS_SQL,
    DOCS_LABELS_SQL,
    ORDER_COLUMNS,
    class_sql,
    count_class,
    date_sql,
    dirty_customers,
    dirty_orders,
    documents_with_labels,
    query,
    rounded,
    table,
    union_all,
)


@query("shape", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def shape(spark, sf):
    return P.shape(table(spark, sf, "orders"))


SUMMARY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SUMMARY_SQL = union_all(
    [
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 4) AS p25, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS median, "
        f"round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
        for c in SUMMARY_COLUMNS
    ]
)


def _rounded_summary(df):
    parts = [rounded(c, 4).alias(c) for c in ("mean", "stddev")]
    quartiles = [rounded(c, 4).alias(c) for c in ("p25", "median", "p75")]
    return df.select("column_name", "n", *parts, "min", *quartiles, "max")


@query("numeric_summary", SUMMARY_SQL)
def numeric_summary(spark, sf):
    return _rounded_summary(P.numeric_summary(table(spark, sf, "lineitem"), SUMMARY_COLUMNS))


@query(
    "numeric_summary_sketched",
    union_all(
        [
            f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, true AS near FROM lineitem"
            for c in SUMMARY_COLUMNS
        ]
    ),
)
def numeric_summary_sketched(spark, sf):
    """The estimates hold if the share of smaller values is within a hundredth of what they stand for."""
    items = table(spark, sf, "lineitem")
    found = P.numeric_summary(items, SUMMARY_COLUMNS, exact=False)
    # one row per column
    cells = long_values(items, SUMMARY_COLUMNS, "double").join(F.broadcast(found), "column_name")
    near = F.lit(True)
    for name, p in P.QUANTILES.items():
        below, upto = F.avg((F.col("value") < F.col(name)).cast("int")), F.avg((F.col("value") <= F.col(name)).cast("int"))
        near = near & (below <= p + 0.01) & (upto >= p - 0.01)
    checked = cells.groupBy("column_name").agg(near.alias("near"))
    return found.join(F.broadcast(checked), "column_name").select("column_name", "n", rounded("mean", 4).alias("mean"), "min", "max", "near")


def _null_sql(source: str, cols: list[str], text: set[str]) -> str:
    parts = []
    for c in cols:
        empty = f"count(*) FILTER (WHERE trim({c}) = '')" if c in text else "0"
        masked = f"count(*) FILTER (WHERE trim({c}) = '?')" if c in text else "0"
        missing = f"(count(*) FILTER (WHERE {c} IS NULL) + {empty} + {masked})"
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, CAST({empty} AS BIGINT) AS n_empty, "
            f"CAST({masked} AS BIGINT) AS n_masked, round({missing}::DOUBLE / count(*), 6) AS missing_share FROM {source}"
        )
    return union_all(parts)


def _rounded_share(df, name):
    return df.withColumn(name, rounded(name))


@query(
    "null_profile",
    f"WITH {DOCS_LABELS_SQL} " + _null_sql("d", ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"], {"text", "lang", "source"}),
)
def null_profile(spark, sf):
    return _rounded_share(P.null_profile(documents_with_labels(spark, sf)), "missing_share")


@query("null_profile_of_raw_text", f"WITH {DIRTY_ORDERS_SQL} " + _null_sql("raw", ORDER_COLUMNS, set(ORDER_COLUMNS)))
def null_profile_of_raw_text(spark, sf):
    return _rounded_share(P.null_profile(dirty_orders(spark, sf)), "missing_share")


@query(
    "masked_nulls",
    f"WITH {DIRTY_ORDERS_SQL}, m AS ("
    + union_all(
        [
            f"SELECT '{c}' AS column_name, '{t}' AS token, count(*) FILTER (WHERE trim({c}) = '{t}') AS n, count(*) AS rows FROM raw"
            for c in ORDER_COLUMNS
            for t in ("?", "soon")
        ]
    )
    + ") SELECT column_name, token, n, round(n::DOUBLE / rows, 6) AS share FROM m WHERE n > 0",
)
def masked_nulls(spark, sf):
    return _rounded_share(P.masked_nulls(dirty_orders(spark, sf), ["?", "soon"]), "share")


@query(
    "type_profile",
    f"WITH {DIRTY_CUSTOMERS_SQL}, t AS (SELECT CAST(customer_id AS VARCHAR) AS customer_id, nation, segment FROM raw) "
    + union_all(
        [
            f"SELECT '{c}' AS column_name, "
            + ", ".join(f"{count_class(c, k, False)} AS n_{k}" for k in ("null", "empty", "numeric", "date", "string"))
            + " FROM t"
            for c in ("customer_id", "nation", "segment")
        ]
    ),
)
def type_profile(spark, sf):
    df = dirty_customers(spark, sf)
    return P.type_profile(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))


@query(
    "histogram",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    b AS (SELECT lo, hi, least(CAST(floor((o_totalprice - lo) / (hi - lo) * 20) AS INT) + 1, 20) AS bin FROM orders, s)
    SELECT 'o_totalprice' AS column_name, bin, round(lo + (hi - lo) / 20 * (bin - 1), 4) AS lower, round(lo + (hi - lo) / 20 * bin, 4) AS upper, count(*) AS n
    FROM b GROUP BY bin, lo, hi""",
)
def histogram(spark, sf):
    found = P.histogram(table(spark, sf, "orders"), ["o_totalprice"], 20)
    return found.select("column_name", "bin", rounded("lower", 4).alias("lower"), rounded("upper", 4).alias("upper"), "n")


TOP_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query(
    "top_values",
    "WITH c AS ("
    + union_all(
        [
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY {c}"
            for c in TOP_COLUMNS
        ]
    )
    + "), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INT) AS rank FROM c) "
    "SELECT * FROM r WHERE rank <= 5",
)
def top_values(spark, sf):
    return P.top_values(table(spark, sf, "orders"), TOP_COLUMNS, 5)


@query(
    "cardinality",
    union_all(
        [
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) > 100 AS is_high FROM orders"
            for c in TOP_COLUMNS
        ]
    ),
)
def cardinality(spark, sf):
    return P.cardinality(table(spark, sf, "orders"), TOP_COLUMNS)


@query("cardinality_sketched", union_all([f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS near FROM orders" for c in TOP_COLUMNS]))
def cardinality_sketched(spark, sf):
    """The estimates hold if they are within a fifth, four times the sketch's deviation, of the exact counts."""
    orders = table(spark, sf, "orders")
    exact = P.cardinality(orders, TOP_COLUMNS).select("column_name", "n_distinct")
    about = P.cardinality(orders, TOP_COLUMNS, exact=False).select("column_name", F.col("n_distinct").alias("about"))
    near = F.abs(F.col("about") - F.col("n_distinct")) <= 0.2 * F.col("n_distinct")
    # one row per column
    return exact.join(F.broadcast(about), "column_name").select("column_name", "n_distinct", near.alias("near"))


FORMAT_SQL = (
    "CASE WHEN ordered_on IS NULL OR trim(ordered_on) = '' THEN 'missing' "
    "WHEN try_strptime(ordered_on, '%Y-%m-%d') IS NOT NULL THEN 'yyyy-MM-dd' "
    "WHEN try_strptime(ordered_on, '%Y/%m/%d') IS NOT NULL THEN 'yyyy/MM/dd' ELSE 'other' END"
)


@query("date_formats", f"WITH {DIRTY_ORDERS_SQL} SELECT {FORMAT_SQL} AS format, count(*) AS n FROM raw GROUP BY 1")
def date_formats(spark, sf):
    return P.date_formats(dirty_orders(spark, sf), "ordered_on")


@query(
    "case_variants",
    f"""WITH {DIRTY_CUSTOMERS_SQL}, s AS (SELECT lower(trim(segment)) AS folded, segment AS variant, count(*) AS n FROM raw GROUP BY ALL)
    SELECT folded, variant, n, n_variants FROM (SELECT *, count(*) OVER (PARTITION BY folded) AS n_variants FROM s) WHERE n_variants > 1""",
)
def case_variants(spark, sf):
    return P.case_variants(dirty_customers(spark, sf), "segment")


@query(
    "cryptic_names",
    union_all(
        [
            f"SELECT {i} AS position, '{n}' AS column_name, {b} AS is_cryptic, count({c}) AS n_filled FROM customer"
            for i, (c, n, b) in enumerate(
                [
                    ("c_custkey", "X1", "true"),
                    ("c_name", "name", "false"),
                    ("c_nationkey", "X2", "true"),
                    ("c_acctbal", "X3", "true"),
                    ("c_mktsegment", "segment", "false"),
                ]
            )
        ]
    ),
)
def cryptic_names(spark, sf):
    names = {"c_custkey": "X1", "c_name": "name", "c_nationkey": "X2", "c_acctbal": "X3", "c_mktsegment": "segment"}
    df = rename(table(spark, sf, "customer"), names)
    filled = P.null_profile(df).select("column_name", (F.col("n_rows") - F.col("n_null")).alias("n_filled"))
    return P.cryptic_names(spark, df.columns).join(F.broadcast(filled), "column_name").select(
        "position", "column_name", "is_cryptic", "n_filled"
    )


@query(
    "sensitive_columns",
    union_all(
        [
            f"SELECT '{n}' AS column_name, {s} AS sensitive, {b} AS flagged_by, count({c}) AS n_filled FROM customer"
            for c, n, s, b in [
                ("c_custkey", "customer", "false", "NULL"),
                ("c_name", "name", "true", "'declared'"),
                ("c_nationkey", "AGE", "true", "'name'"),
                ("c_acctbal", "balance", "true", "'metadata'"),
                ("c_mktsegment", "segment", "false", "NULL"),
            ]
        ]
    ),
)
def sensitive_columns(spark, sf):
    names = {"c_custkey": "customer", "c_name": "name", "c_nationkey": "AGE", "c_acctbal": "balance", "c_mktsegment": "segment"}
    df = P.flag_sensitive(rename(table(spark, sf, "customer"), names), ["balance"])
    filled = P.null_profile(df).select("column_name", (F.col("n_rows") - F.col("n_null")).alias("n_filled"))
    return P.sensitive_columns(df, declared=["name"]).join(F.broadcast(filled), "column_name").select(
        "column_name", "sensitive", "flagged_by", "n_filled"
    )


def _issue(name: str, issue: str, n: str, source: str = "raw") -> str:
    return f"SELECT '{name}' AS column_name, '{issue}' AS issue, CAST({n} AS BIGINT) AS n FROM {source}"


def _minority(c: str) -> str:
    kinds = [count_class(c, k) for k in ("numeric", "date", "string")]
    return f"{' + '.join(kinds)} - greatest({', '.join(kinds)})"


ISSUES_SQL = (
    f"WITH {DIRTY_ORDERS_SQL}, i AS ("
    + union_all(
        [
            _issue(c, issue, n)
            for c in ORDER_COLUMNS
            for issue, n in {
                "null": count_class(c, "null"),
                "empty": count_class(c, "empty"),
                "masked_null": count_class(c, "masked"),
                "mixed_types": _minority(c),
            }.items()
        ]
        + [
            _issue(
                "ordered_on",
                "mixed_date_formats",
                "least(count(*) FILTER (WHERE ordered_on LIKE '%-%-%'), count(*) FILTER (WHERE ordered_on LIKE '%/%/%'))",
            )
        ]
        + [
            f"SELECT '{c}', 'mixed_casing', CAST(sum(CASE WHEN variants > 1 THEN n ELSE 0 END) AS BIGINT) FROM "
            f"(SELECT lower(trim({c})) AS f, count(DISTINCT {c}) AS variants, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY 1)"
            for c in ("status", "priority", "customer")
        ]
        + [
            f"SELECT '{c}', 'high_cardinality', CASE WHEN count(DISTINCT {c}) > 100 THEN count({c}) ELSE 0 END FROM raw"
            for c in ("status", "priority", "customer")
        ]
    )
    + ") SELECT column_name, issue, n, round(n::DOUBLE / (SELECT count(*) FROM raw), 6) AS share FROM i WHERE n > 0"
)


@query("quality_issues", ISSUES_SQL)
def quality_issues(spark, sf):
    rules = P.ProfileRules(date_columns=["ordered_on"], categories=["status", "priority", "customer"])
    return _rounded_share(P.quality_issues(dirty_orders(spark, sf), rules), "share")
