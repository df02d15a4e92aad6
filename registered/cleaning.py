"""D1 to D12."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.operators import clean as D
from proofline.operators.profile import flag_sensitive, null_profile, sensitive_columns
from registered.base import (
    DIRTY_CUSTOMERS_SQL,
    DIRTY_ORDERS_SQL,
    DOCS_LABELS_SQL,
    NUMBER_SQL,
    date_sql,
    dirty_customers,
    dirty_orders,
    documents_with_labels,
    query,
    rounded,
    table,
    union_all,
)


@query("renamed_columns", "SELECT p_partkey AS part, p_name AS name, p_brand AS brand, p_type, p_size, p_retailprice AS price FROM part")
def renamed_columns(spark, sf):
    names = {"p_partkey": "part", "p_name": "name", "p_brand": "brand", "p_retailprice": "price"}
    return D.rename(table(spark, sf, "part"), names)


@query(
    "unmasked_nulls",
    f"WITH {DIRTY_ORDERS_SQL} SELECT order_id, CASE WHEN trim(priority) <> '?' THEN priority END AS priority FROM raw",
)
def unmasked_nulls(spark, sf):
    return D.unmask_nulls(dirty_orders(spark, sf), ["priority"]).select("order_id", "priority")


@query(
    "coerced_types",
    f"WITH {DIRTY_CUSTOMERS_SQL} SELECT customer_id, CASE WHEN regexp_matches(nation, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(trim(nation) AS INT) END AS nation, segment FROM raw",
)
def coerced_types(spark, sf):
    return D.coerce(dirty_customers(spark, sf), {"nation": "int"})


@query(
    "coerced_numbers",
    f"WITH {DIRTY_ORDERS_SQL} SELECT order_id, CASE WHEN regexp_matches(customer, {NUMBER_SQL}) THEN TRY_CAST(trim(customer) AS DOUBLE) END AS customer FROM raw",
)
def coerced_numbers(spark, sf):
    return D.coerce(dirty_orders(spark, sf), {"customer": "double"}).select("order_id", "customer")


@query("normalized_dates", f"WITH {DIRTY_ORDERS_SQL} SELECT order_id, {date_sql('ordered_on')} AS ordered_on FROM raw")
def normalized_dates(spark, sf):
    return D.normalize_dates(dirty_orders(spark, sf), "ordered_on").select("order_id", "ordered_on")


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "normal", "4-NOT SPECIFIED": "normal", "?": "unknown"}


@query(
    "canonical_values",
    f"WITH {DIRTY_ORDERS_SQL} SELECT order_id, CASE priority "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITIES.items())
    + " ELSE priority END AS priority FROM raw",
)
def canonical_values(spark, sf):
    return D.canonicalize(dirty_orders(spark, sf).select("order_id", "priority"), "priority", PRIORITIES)


@query(
    "canonical_values_from_table",
    "SELECT l_orderkey, l_linenumber, coalesce(p_brand, CAST(l_partkey AS VARCHAR)) AS part FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def canonical_values_from_table(spark, sf):
    mapping = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("value"), F.col("p_brand").alias("canonical")
    )
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return D.canonicalize(items, "part", mapping)


@query("folded_case", f"WITH {DIRTY_CUSTOMERS_SQL} SELECT customer_id, nation, lower(trim(segment)) AS segment FROM raw")
def folded_case(spark, sf):
    return D.fold_case(dirty_customers(spark, sf), ["segment"])


@query(
    "imputed",
    f"""WITH {DOCS_LABELS_SQL}, e AS (SELECT doc_id, CAST(quality AS DOUBLE) AS quality, CASE WHEN quality IS NOT NULL THEN n_chars END AS size, CASE WHEN toxic IS NULL THEN NULL ELSE source END AS source, toxic FROM d),
    m AS (SELECT source, count(*) AS n FROM e WHERE source IS NOT NULL GROUP BY source ORDER BY n DESC, source LIMIT 1)
    SELECT doc_id, round(coalesce(quality, (SELECT avg(quality) FROM e)), 6) AS quality,
      coalesce(size, CAST(trunc((SELECT quantile_cont(size, 0.5) FROM e)) AS BIGINT)) AS size,
      coalesce(source, (SELECT source FROM m)) AS source, coalesce(toxic, -1) AS toxic FROM e""",
)
def imputed(spark, sf):
    joined = documents_with_labels(spark, sf)
    labelled = F.col("quality").isNotNull()
    df = joined.select(
        "doc_id",
        F.col("quality").cast("double"),
        F.when(labelled, F.col("n_chars")).alias("size"),
        F.when(labelled, F.col("source")).alias("source"),
        "toxic",
    )
    fills = {"quality": "mean", "size": "median", "source": "mode", "toxic": ("constant", -1)}
    return D.impute(df, fills).withColumn("quality", rounded("quality"))


@query("complete_rows", f"WITH {DOCS_LABELS_SQL} SELECT doc_id, lang, quality, toxic FROM d WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def complete_rows(spark, sf):
    return D.drop_missing(documents_with_labels(spark, sf).select("doc_id", "lang", "quality", "toxic"), ["quality", "toxic"])


STEPS = [
    D.Step("priority", "masked null to NULL", "a question mark stands for a missing value", lambda c: X.unmasked(c)),
    D.Step("status", "fold case", "one spelling per status", lambda c: X.folded(c, "upper")),
    D.Step("priority", "fill", "orders without a priority are low", lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("5-LOW"))),
    D.Step("ordered_on", "text to date", "two date formats", lambda c: X.parsed_date(c)),
    D.Step("customer", "text to bigint", "customer keys are numbers", lambda c: X.typed(c, "bigint")),
]
LOG_SQL = (
    f"WITH {DIRTY_ORDERS_SQL}, s AS (SELECT *, CASE WHEN trim(priority) <> '?' THEN priority END AS p1, upper(trim(status)) AS s1, {date_sql('ordered_on')} AS d1, "
    "CASE WHEN regexp_matches(customer, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(customer AS BIGINT) END AS c1 FROM raw), "
    "t AS (SELECT *, coalesce(nullif(p1, ''), '5-LOW') AS p2 FROM s) "
    + union_all(
        [
            f"SELECT {i} AS seq, '{STEPS[i].column}' AS column_name, '{STEPS[i].what}' AS what, '{STEPS[i].why}' AS why, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {changed}) AS n_changed, count(*) FILTER (WHERE {b} IS NOT NULL AND {a} IS NULL) AS n_nulled, "
            f"count(*) FILTER (WHERE {b} IS NULL AND {a} IS NOT NULL) AS n_filled FROM t"
            for i, b, a, changed in [
                (0, "priority", "p1", "priority IS DISTINCT FROM p1"),
                (1, "status", "s1", "status IS DISTINCT FROM s1"),
                (2, "p1", "p2", "p1 IS DISTINCT FROM p2"),
                (3, "ordered_on", "d1", "ordered_on IS NOT NULL AND d1 IS NULL"),
                (4, "customer", "c1", "customer IS NOT NULL AND c1 IS NULL"),
            ]
        ]
    )
)


@query("change_log", LOG_SQL)
def change_log(spark, sf):
    return D.change_log(dirty_orders(spark, sf), STEPS)


@query(
    "cleaned_rows",
    f"WITH {DIRTY_ORDERS_SQL} SELECT order_id, CASE WHEN regexp_matches(customer, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(customer AS BIGINT) END AS customer, "
    f"upper(trim(status)) AS status, coalesce(nullif(CASE WHEN trim(priority) <> '?' THEN priority END, ''), '5-LOW') AS priority, {date_sql('ordered_on')} AS ordered_on FROM raw",
)
def cleaned_rows(spark, sf):
    return D.apply_steps(dirty_orders(spark, sf), STEPS)


@query(
    "mistake_log",
    f"""WITH {DIRTY_CUSTOMERS_SQL} SELECT customer_id, 'nation' AS column_name, 'int' AS wanted_type, nation AS raw_value FROM raw
    WHERE trim(nation) NOT IN ('?', '') AND NOT regexp_matches(nation, '^\\s*[+-]?\\d+\\s*$')
    UNION ALL SELECT customer_id, 'segment', 'date', segment FROM raw""",
)
def mistake_log(spark, sf):
    return D.mistake_log(dirty_customers(spark, sf), "customer_id", {"nation": "int", "segment": "date"})


@query(
    "carried_flags",
    union_all(
        [
            f"SELECT '{c}' AS column_name, {s} AS sensitive, count({e}) AS n_filled FROM customer"
            for c, s, e in [
                ("c_custkey", "false", "c_custkey"),
                ("half_balance", "true", "c_acctbal / 2"),
                ("c_nationkey", "false", "c_nationkey"),
                ("c_name", "true", "c_name"),
            ]
        ]
    ),
)
def carried_flags(spark, sf):
    src = flag_sensitive(table(spark, sf, "customer"), ["c_acctbal", "c_name"])
    dst = src.select("c_custkey", (F.col("c_acctbal") / 2).alias("half_balance"), "c_nationkey", F.upper("c_name").alias("c_name"))
    carried = D.carry_flags(src, dst, {"half_balance": ["c_acctbal"]})
    filled = null_profile(carried).select("column_name", (F.col("n_rows") - F.col("n_null")).alias("n_filled"))
    return sensitive_columns(carried, names=()).join(F.broadcast(filled), "column_name").select(
        "column_name", "sensitive", "n_filled"
    )


def _side(c: str, source: str) -> str:
    return f"count(*) FILTER (WHERE {c} IS NULL OR trim({c}) IN ('', '?'))" if source == "raw" else f"count(*) FILTER (WHERE {c} IS NULL)"


_PAIRS = {
    "order_id": ("order_id", "CAST(o_orderkey AS VARCHAR)", "string", "bigint"),
    "status": ("status", "o_orderstatus", "string", "string"),
    "priority": ("priority", "o_orderpriority", "string", "string"),
    "ordered_on": ("ordered_on", "o_orderdate", "string", "timestamp_ntz"),
}
COMPARED_SQL = f"WITH {DIRTY_ORDERS_SQL}, a AS (SELECT count(*) AS rows_a, {', '.join(f'{_side(c, 'raw')} AS m_{c}' for c in [*_PAIRS, 'customer'])} FROM raw), " + (
    "b AS (SELECT count(*) AS rows_b, count(*) FILTER (WHERE o_totalprice IS NULL) AS m_total, "
    + ", ".join(f"count(*) FILTER (WHERE {e} IS NULL) AS n_{c}" for c, (_, e, _, _) in _PAIRS.items())
    + " FROM orders) "
) + union_all(
    [
        f"SELECT '{c}' AS column_name, rows_a, m_{c} AS missing_a, '{ta}' AS type_a, rows_b, n_{c} AS missing_b, '{tb}' AS type_b, "
        f"rows_a = rows_b AS same_rows, m_{c} = n_{c} AS same_missing, {str(ta == tb).lower()} AS same_type FROM a, b"
        for c, (_, _, ta, tb) in _PAIRS.items()
    ]
    + [
        "SELECT 'customer', rows_a, m_customer, 'string', NULL, NULL, NULL, false, false, false FROM a",
        "SELECT 'total', NULL, NULL, NULL, rows_b, m_total, 'double', false, false, false FROM b",
    ]
)


@query("compared_tables", COMPARED_SQL)
def compared_tables(spark, sf):
    truth = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("ordered_on"),
        F.col("o_totalprice").alias("total"),
    )
    return D.compare_tables(dirty_orders(spark, sf), truth)
