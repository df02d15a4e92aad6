"""Registry, table access, and the dirt that queries and SQL put into clean tables alike."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits)


def union_all(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Text columns with masked nulls, two date formats, mixed casing, mixed types and blanks.
# One text serves both dialects; only the date formatting differs.
ORDER_DIRT = {
    "order_id": "CAST(o_orderkey AS {text})",
    "customer": "CASE WHEN o_orderkey % 25 = 0 THEN concat('C', CAST(o_custkey AS {text})) ELSE CAST(o_custkey AS {text}) END",
    "status": "CASE WHEN o_orderkey % 7 = 0 THEN lower(o_orderstatus) WHEN o_orderkey % 13 = 0 THEN concat(' ', o_orderstatus) ELSE o_orderstatus END",
    "priority": "CASE WHEN o_orderkey % 20 = 0 THEN '?' WHEN o_orderkey % 30 = 1 THEN '' WHEN o_orderkey % 50 = 3 THEN NULL ELSE o_orderpriority END",
    "ordered_on": "CASE WHEN o_orderkey % 3 = 0 THEN {slashed} WHEN o_orderkey % 40 = 1 THEN 'soon' ELSE {dashed} END",
}
SPARK_WORDS = {
    "text": "STRING",
    "slashed": "date_format(o_orderdate, 'yyyy/MM/dd')",
    "dashed": "date_format(o_orderdate, 'yyyy-MM-dd')",
}
DUCK_WORDS = {
    "text": "VARCHAR",
    "slashed": "strftime(o_orderdate, '%Y/%m/%d')",
    "dashed": "strftime(o_orderdate, '%Y-%m-%d')",
}
ORDER_COLUMNS = list(ORDER_DIRT)
CUSTOMER_DIRT = {
    "customer_id": "c_custkey",
    "nation": "CASE WHEN c_custkey % 10 = 0 THEN 'n/a' WHEN c_custkey % 15 = 1 THEN '' WHEN c_custkey % 20 = 2 THEN '?' ELSE CAST(c_nationkey AS {text}) END",
    "segment": "CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) WHEN c_custkey % 4 = 1 THEN concat(c_mktsegment, ' ') ELSE c_mktsegment END",
}


def _fields(dirt: dict[str, str], words: dict[str, str]) -> list[str]:
    return [f"{e.format(**words)} AS {name}" for name, e in dirt.items()]


def dirty_orders(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*_fields(ORDER_DIRT, SPARK_WORDS), *more)


def dirty_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(*_fields(CUSTOMER_DIRT, SPARK_WORDS))


DIRTY_ORDERS_SQL = f"raw AS (SELECT {', '.join(_fields(ORDER_DIRT, DUCK_WORDS))} FROM orders)"
DIRTY_CUSTOMERS_SQL = f"raw AS (SELECT {', '.join(_fields(CUSTOMER_DIRT, DUCK_WORDS))} FROM customer)"

NUMBER_SQL = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def date_sql(c: str) -> str:
    """The parsed date of a text column, NULL where neither format fits."""
    return (
        f"coalesce(CASE WHEN regexp_matches({c}, '^\\s*\\d{{4}}-\\d{{2}}-\\d{{2}}\\s*$') THEN CAST(try_strptime(trim({c}), '%Y-%m-%d') AS DATE) END, "
        f"CASE WHEN regexp_matches({c}, '^\\s*\\d{{4}}/\\d{{2}}/\\d{{2}}\\s*$') THEN CAST(try_strptime(trim({c}), '%Y/%m/%d') AS DATE) END)"
    )


def class_sql(c: str, masked: bool = True) -> str:
    """The class of a text value, as the profile counts it."""
    mask = f"WHEN trim({c}) = '?' THEN 'masked' " if masked else ""
    return (
        f"CASE WHEN {c} IS NULL THEN 'null' WHEN trim({c}) = '' THEN 'empty' {mask}"
        f"WHEN regexp_matches({c}, {NUMBER_SQL}) THEN 'numeric' "
        f"WHEN {date_sql(c)} IS NOT NULL THEN 'date' ELSE 'string' END"
    )


def count_class(c: str, kind: str, masked: bool = True) -> str:
    return f"count(*) FILTER (WHERE {class_sql(c, masked)} = '{kind}')"


WORDS_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


def documents_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    return table(spark, sf, "documents").join(labels, "doc_id", "left")


DOCS_LABELS_SQL = (
    "d AS (SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)"
)
