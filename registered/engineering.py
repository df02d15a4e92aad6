"""E1 to E15."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators import features as E
from proofline.operators.clean import rename
from proofline.operators.evaluate import auc_table
from proofline.operators.profile import ProfileRules, column_profile, flag_sensitive
from proofline.session import materialize
from registered.base import DIRTY_ORDERS_SQL, ORDER_COLUMNS, dirty_orders, query, rounded, table, union_all


def _parts(c: str, name: str, hour: bool) -> str:
    parts = {
        "year": f"year({c})",
        "quarter": f"quarter({c})",
        "month": f"month({c})",
        "day": f"day({c})",
        "weekday": f"isodow({c}) - 1",
        "week": f"week({c})",
    }
    if hour:
        parts["hour"] = f"hour({c})"
    return ", ".join(f"CAST({e} AS INT) AS feat_{name}_{p}" for p, e in parts.items())


@query("date_features_of_events", f"SELECT event_id, {_parts('ts', 'ts', True)} FROM events")
def date_features_of_events(spark, sf):
    return E.features_only(E.date_features(table(spark, sf, "events").select("event_id", "ts"), "ts"), ["event_id"])


@query("date_features_of_orders", f"SELECT o_orderkey, {_parts('o_orderdate', 'day', False)} FROM orders")
def date_features_of_orders(spark, sf):
    days = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return E.features_only(E.date_features(days, "day"), ["o_orderkey"])


@query(
    "text_features",
    r"""SELECT doc_id, CAST(length(text) AS INT) AS feat_text_chars, CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS feat_text_words,
    CAST(len(regexp_extract_all(text, '\d')) AS INT) AS feat_text_digits, CAST(len(regexp_extract_all(text, '\p{Lu}')) AS INT) AS feat_text_capitals,
    CAST(len(regexp_extract_all(text, '\p{P}')) AS INT) AS feat_text_punctuation FROM documents""",
)
def text_features(spark, sf):
    return E.features_only(E.text_features(table(spark, sf, "documents"), "text"), ["doc_id"])


@query(
    "group_aggregates",
    """WITH a AS (SELECT l_orderkey, round(sum(l_quantity), 4) AS feat_order_pieces, count(*) AS feat_order_lines, max(l_extendedprice) AS feat_order_top_price FROM lineitem GROUP BY l_orderkey)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, feat_order_pieces, feat_order_lines, feat_order_top_price FROM lineitem l JOIN a ON l.l_orderkey = a.l_orderkey""",
)
def group_aggregates(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    aggs = {
        "order_pieces": F.round(F.sum("l_quantity"), 4),
        "order_lines": F.count("*"),
        "order_top_price": F.max("l_extendedprice"),
    }
    return E.features_only(E.group_aggregates(items, ["l_orderkey"], aggs), ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "row_aggregates",
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b, CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity END AS c FROM lineitem),
    g AS (SELECT *, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS k, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS s FROM f)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN k > 0 THEN round(s, 6) END AS feat_rates_sum, CASE WHEN k > 0 THEN round(s / k, 6) END AS feat_rates_mean,
      least(a, b, c) AS feat_rates_min, greatest(a, b, c) AS feat_rates_max, 3 - k AS feat_rates_missing FROM g""",
)
def row_aggregates(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_discount", F.lit(0.0)).alias("a"),
        F.nullif("l_tax", F.lit(0.0)).alias("b"),
        F.when(F.col("l_quantity") <= 40, F.col("l_quantity")).alias("c"),
    )
    made = E.row_aggregates(items, ["a", "b", "c"], "rates")
    made = made.withColumns({c: rounded(c) for c in ("feat_rates_sum", "feat_rates_mean")})
    return E.features_only(made, ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "derived_ratio",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(l_tax / nullif(l_discount, 0), 6) AS feat_tax_to_discount FROM lineitem",
)
def derived_ratio(spark, sf):
    made = E.ratio(table(spark, sf, "lineitem"), "l_tax", "l_discount", "tax_to_discount")
    made = made.withColumn("feat_tax_to_discount", rounded("feat_tax_to_discount"))
    return E.features_only(made, ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "interactions",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_discount, 6) AS feat_l_quantity_x_l_discount,
    concat_ws('_', l_returnflag, l_linestatus) AS feat_l_returnflag_x_l_linestatus FROM lineitem""",
)
def interactions(spark, sf):
    made = E.interactions(table(spark, sf, "lineitem"), [("l_quantity", "l_discount"), ("l_returnflag", "l_linestatus")])
    made = made.withColumn("feat_l_quantity_x_l_discount", rounded("feat_l_quantity_x_l_discount"))
    return E.features_only(made, ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "one_hot",
    "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderstatus = '{v}' AS INT) AS feat_o_orderstatus_{v}" for v in "FOP") + " FROM orders",
)
def one_hot(spark, sf):
    return E.features_only(E.one_hot(table(spark, sf, "orders"), "o_orderstatus"), ["o_orderkey"])


@query(
    "one_hot_of_many_levels",
    "WITH i AS (SELECT o_custkey AS level, dense_rank() OVER (ORDER BY o_custkey) - 1 AS position FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 2 = 0)) "
    "SELECT o_orderkey, level, position, (SELECT count(*) FROM i) AS size, 1.0::DOUBLE AS value FROM orders JOIN i ON level = o_custkey "
    "UNION ALL SELECT o_orderkey, NULL, NULL, (SELECT count(*) FROM i), NULL FROM orders WHERE o_custkey NOT IN (SELECT level FROM i)",
)
def one_hot_of_many_levels(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    train = orders.where("o_orderkey % 2 = 0")
    vectors = E.one_hot_sparse(orders, "o_custkey", train).select("o_orderkey", F.to_json(F.struct("feat_o_custkey_onehot")).alias("v"))
    said = F.from_json("v", "feat_o_custkey_onehot struct<size: long, indices: array<long>, values: array<double>>")["feat_o_custkey_onehot"]
    vectors = vectors.select("o_orderkey", said.alias("v")).select("o_orderkey", F.get("v.indices", 0).alias("position"), "v.size", F.get("v.values", 0).alias("value"))
    # the long form tells the level of each place
    ones = E.one_hot_long(orders, ["o_orderkey"], "o_custkey", train)
    return vectors.join(ones, ["o_orderkey", "position"], "left").select("o_orderkey", "level", "position", "size", "value")


@query(
    "label_codes",
    "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS feat_p_brand_code FROM part",
)
def label_codes(spark, sf):
    return E.features_only(E.label_encode(table(spark, sf, "part"), "p_brand"), ["p_partkey"])


@query(
    "label_codes_of_many_values",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS feat_o_custkey_code FROM orders",
)
def label_codes_of_many_values(spark, sf):
    return E.features_only(E.label_encode(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey"), ["o_orderkey"])


@query(
    "standard_scaling",
    """WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM orders)
    SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS feat_o_totalprice_standard FROM orders, s""",
)
def standard_scaling(spark, sf):
    made = E.scale(table(spark, sf, "orders"), ["o_totalprice"])
    return made.select("o_orderkey", rounded("feat_o_totalprice_standard").alias("feat_o_totalprice_standard"))


@query(
    "minmax_scaling",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_custkey) AS clo, max(o_custkey) AS chi FROM orders)
    SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS feat_o_totalprice_minmax,
      round((o_custkey - clo)::DOUBLE / (chi - clo), 6) AS feat_o_custkey_minmax FROM orders, s""",
)
def minmax_scaling(spark, sf):
    made = E.scale(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"], "minmax")
    names = ["feat_o_totalprice_minmax", "feat_o_custkey_minmax"]
    return made.select("o_orderkey", *[rounded(n).alias(n) for n in names])


@query(
    "features_only",
    "SELECT CAST(year(o_orderdate) AS INT) AS feat_year, CAST(o_orderstatus = 'F' AS INT) AS feat_filled, count(*) AS feat_n FROM orders GROUP BY ALL",
)
def features_only(spark, sf):
    orders = table(spark, sf, "orders")
    made = orders.withColumns({"feat_year": F.year("o_orderdate"), "feat_filled": (F.col("o_orderstatus") == "F").cast("int")})
    picked = E.features_only(made)
    return picked.groupBy(*picked.columns).agg(F.count("*").alias("feat_n"))


def order_line_specs() -> list[E.FeatureSpec]:
    """Features of order lines joined to their orders, one or more per batch."""
    spec = E.FeatureSpec
    return [
        spec("net_scaled", "scaling", ("feat_net",), "min-max", "net price between 0 and 1", "NULL without spread",
             E.Scaled("feat_net", "minmax")),
        spec("tax_to_discount", "ratio", ("l_tax", "l_discount"), "ratio", "tax per discount", "NULL for a zero discount",
             lambda df: E.ratio_of("l_tax", "l_discount")),
        spec("net", "ratio", ("l_extendedprice", "l_discount"), "product", "price after discount", "none",
             lambda df: F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)),
        spec("share_of_order", "ratio", ("l_quantity", "feat_pieces"), "ratio", "share of the order's pieces", "NULL for an empty order",
             lambda df: E.ratio_of("l_quantity", "feat_pieces")),
        spec("pieces", "aggregate", ("l_orderkey", "l_quantity"), "sum per order", "pieces in the order", "none",
             E.Grouped(("l_orderkey",), {"pieces": "sum(l_quantity)"})),
        spec("ordered_year", "date-time", ("o_orderdate",), "year", "year of the order", "none",
             lambda df: F.year("o_orderdate")),
        spec("priority_length", "text", ("o_orderpriority",), "length", "length of the priority", "none",
             lambda df: F.length("o_orderpriority")),
        spec("returned", "encoding", ("l_returnflag",), "0/1", "line was returned", "0",
             lambda df: F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).cast("int")),
    ]


def order_lines(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


BUILT_SQL = """p AS (SELECT l_orderkey AS k, sum(l_quantity) AS pieces FROM lineitem GROUP BY 1),
f AS (SELECT l_orderkey, l_linenumber, l_partkey, pieces AS feat_pieces, CAST(year(o_orderdate) AS INT) AS feat_ordered_year, CAST(length(o_orderpriority) AS INT) AS feat_priority_length,
  l_tax / nullif(l_discount, 0) AS feat_tax_to_discount, round(l_extendedprice * (1 - l_discount), 4) AS feat_net, l_quantity / pieces AS feat_share_of_order,
  CAST(l_returnflag = 'R' AS INT) AS feat_returned FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN p ON k = l_orderkey),
g AS (SELECT f.*, (feat_net - (SELECT min(feat_net) FROM f)) / ((SELECT max(feat_net) FROM f) - (SELECT min(feat_net) FROM f)) AS feat_net_scaled FROM f)"""


@query(
    "built_features",
    f"WITH {BUILT_SQL} SELECT l_orderkey, l_linenumber, l_partkey, feat_pieces, feat_ordered_year, feat_priority_length, round(feat_tax_to_discount, 6) AS feat_tax_to_discount, "
    "feat_net, round(feat_share_of_order, 6) AS feat_share_of_order, feat_returned, round(feat_net_scaled, 6) AS feat_net_scaled FROM g",
)
def built_features(spark, sf):
    made = E.build_features(materialize(order_lines(spark, sf)), order_line_specs())
    names = ["feat_tax_to_discount", "feat_share_of_order", "feat_net_scaled"]
    return E.features_only(made.withColumns({n: rounded(n) for n in names}), ["l_orderkey", "l_linenumber", "l_partkey"])


DICTIONARY_SQL = union_all(
        [
            f"SELECT 'feat_{s.name}' AS name, '{s.description.replace(chr(39), chr(39) * 2)}' AS description, '{','.join(s.sources)}' AS source_columns, '{s.method}' AS method, "
            f"round(CAST(min(feat_{s.name}) AS DOUBLE), 6) AS min_value, round(CAST(max(feat_{s.name}) AS DOUBLE), 6) AS max_value, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text, count(*) - count(feat_{s.name}) AS n_missing, "
            f"count(*) AS n_rows, '{s.missing}' AS missing_handling FROM g"
            for s in order_line_specs()
        ]
    )


@query("data_dictionary", f"WITH {BUILT_SQL} {DICTIONARY_SQL}")
def data_dictionary(spark, sf):
    made = E.build_features(materialize(order_lines(spark, sf)), order_line_specs())
    found = E.data_dictionary(made, order_line_specs())
    return found.withColumns({c: rounded(c) for c in ("min_value", "max_value")})


def auc_sql(source: str, score: str, label: str) -> str:
    """AUC with ties as half, as a scalar subquery."""
    return (
        f"(SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
        f"FROM (SELECT {score} AS v, CAST(sum({label}) AS DOUBLE) AS pos, CAST(sum(1 - {label}) AS DOUBLE) AS neg FROM {source} WHERE {score} IS NOT NULL GROUP BY 1)))"
    )


@query(
    "challenge_stats",
    "WITH s AS (SELECT l_tax, l_discount, l_tax / nullif(l_discount, 0) AS r, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem) "
    + union_all(
        [
            f"SELECT 'feat_tax_to_discount' AS feature, '{c}' AS source, round(corr(r, {c}), 6) AS correlation, count(*) FILTER (WHERE l_discount = 0) AS n_zero_denominators, "
            f"round({auc_sql('s', 'r', 'y')}, 9) AS auc_feature, round({auc_sql('s', c, 'y')}, 9) AS auc_source FROM s"
            for c in ("l_tax", "l_discount")
        ]
    ),
)
def challenge_stats(spark, sf):
    items = E.ratio(table(spark, sf, "lineitem"), "l_tax", "l_discount", "tax_to_discount").withColumn(
        "returned", (F.col("l_returnflag") == "R").cast("int")
    )
    found = E.challenge_stats(items, "feat_tax_to_discount", ["l_tax", "l_discount"], "l_discount", "returned")
    return found.select(
        "feature",
        "source",
        rounded("correlation").alias("correlation"),
        "n_zero_denominators",
        rounded("auc_feature", 9).alias("auc_feature"),
        rounded("auc_source", 9).alias("auc_source"),
    )


OUTCOME = (
    "CASE WHEN role = 'system' THEN 'caveat' WHEN length(text) > 1200 THEN 'rejected' WHEN length(text) < 40 THEN 'open' "
    "WHEN role = 'assistant' AND length(text) > 400 THEN 'resolved' ELSE 'none' END"
)


@query(
    "confidence",
    f"""WITH r AS (SELECT conv_id AS proposal, {OUTCOME} AS outcome FROM conversations),
    c AS (SELECT proposal, count(*) AS n_reviews, CASE WHEN bool_or(outcome = 'open') THEN NULL WHEN bool_or(outcome = 'rejected') THEN 35 WHEN bool_or(outcome = 'caveat') THEN 67
      WHEN bool_or(outcome = 'resolved') THEN 82 ELSE 95 END AS score FROM r GROUP BY proposal)
    SELECT *, CASE WHEN score > 67 THEN 'high' WHEN score = 67 THEN 'medium' WHEN score < 67 THEN 'low' END AS band FROM c""",
)
def confidence(spark, sf):
    reviews = table(spark, sf, "conversations").selectExpr("conv_id AS proposal", f"{OUTCOME} AS outcome")
    return E.confidence(reviews)


def _planned(c: str, name: str, type_: str, batch: str, method: str, few: bool | None = None) -> str:
    chosen = f"CASE WHEN count(DISTINCT {c}) <= 50 THEN 'one-hot' ELSE 'label codes' END" if few is not None else f"'{method}'"
    return (
        f"SELECT '{name}' AS column_name, '{type_}' AS data_type, '{batch}' AS batch, {chosen} AS method FROM orders "
        f"HAVING count(DISTINCT {c}) > 1"
    )


@query(
    "planned_features",
    union_all(
        [
            _planned("o_orderkey", "o_orderkey", "bigint", "scaling", "standard scaling"),
            _planned("o_totalprice", "o_totalprice", "double", "scaling", "standard scaling"),
            _planned("o_orderdate", "o_orderdate", "timestamp_ntz", "date-time", "calendar parts"),
            _planned("o_orderstatus", "status", "string", "encoding", "", True),
            _planned("o_orderpriority", "o_orderpriority", "string", "encoding", "", True),
            _planned("CAST(o_orderkey AS VARCHAR)", "reference", "string", "encoding", "", True),
        ]
    ),
)
def planned_features(spark, sf):
    orders = rename(table(spark, sf, "orders"), {"o_orderstatus": "status"}).withColumn(
        "reference", F.col("o_orderkey").cast("string")
    )
    flagged = flag_sensitive(orders, ["o_custkey"])
    return E.plan_features(column_profile(flagged)).drop("n_distinct")


@query(
    "planned_features_of_raw_text",
    f"WITH {DIRTY_ORDERS_SQL} "
    + union_all(
        [
            f"SELECT '{c}' AS column_name, 'string' AS data_type, 'encoding' AS batch, CASE WHEN count(DISTINCT {c}) <= 50 THEN 'one-hot' ELSE 'label codes' END AS method FROM raw"
            for c in ORDER_COLUMNS
        ]
    ),
)
def planned_features_of_raw_text(spark, sf):
    profile = column_profile(dirty_orders(spark, sf), ProfileRules(categories=["status"]))
    return E.plan_features(profile).drop("n_distinct")


@query(
    "auc_per_column",
    "WITH s AS (SELECT l_tax, l_discount, l_quantity, l_extendedprice, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem) "
    + union_all(
        [
            f"SELECT '{c}' AS score_name, CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg, round({auc_sql('s', c, 'y')}, 9) AS auc FROM s"
            for c in ("l_tax", "l_discount", "l_quantity", "l_extendedprice")
        ]
    ),
)
def auc_per_column(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    found = auc_table(items, ["l_tax", "l_discount", "l_quantity", "l_extendedprice"], "returned")
    return found.withColumn("auc", rounded("auc", 9))
