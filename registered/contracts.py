"""C1 to C16."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators import contract as C
from proofline.sources.raw_csv import read_raw_csv
from registered.base import (
    CUSTOMER_DIRT,
    DIRTY_CUSTOMERS_SQL,
    DIRTY_ORDERS_SQL,
    DOCS_LABELS_SQL,
    WORDS_SQL,
    count_class,
    dirty_customers,
    dirty_orders,
    documents_with_labels,
    query,
    rounded,
    table,
    union_all,
)
from registered.handoffs import written_lines
from registered.profiling import FORMAT_SQL

# a hand-off whose header repeats a name: orders with the key of their customer
HANDOFF_HEADER = ["order_id", "customer", "status", "customer", "segment"]
HANDOFF_SQL = f"""{DIRTY_ORDERS_SQL.replace('raw AS (SELECT ', 'o AS (SELECT o_custkey, ')},
{DIRTY_CUSTOMERS_SQL.replace('raw AS', 'cu AS')},
h AS (SELECT order_id AS c0, customer AS c1, status AS c2, CAST(customer_id AS VARCHAR) AS c3, segment AS c4 FROM o JOIN cu ON o_custkey = customer_id)"""


def handoff_rows(spark, sf):
    orders = dirty_orders(spark, sf, "o_custkey")
    joined = orders.join(dirty_customers(spark, sf), F.col("o_custkey") == F.col("customer_id"))
    return joined.select("order_id", "customer", "status", F.col("customer_id").cast("string"), "segment").toDF(
        *[f"c{i}" for i in range(5)]
    )


@query(
    "duplicate_columns",
    f"WITH {HANDOFF_SQL} SELECT 'customer' AS column_name, CAST(2 AS BIGINT) AS n_columns, '1,3' AS positions, count(c1) + count(c3) AS n_filled FROM h",
)
def duplicate_columns(spark, sf):
    # the header is that of a file, in which names may repeat
    line = "concat_ws(',', " + ", ".join(f"coalesce(CAST(c{i} AS STRING), '')" for i in range(len(HANDOFF_HEADER))) + ") AS line"
    path = written_lines(handoff_rows(spark, sf).selectExpr(line), ",".join(HANDOFF_HEADER), "repeated-names")
    rows, header = read_raw_csv(spark, path)
    found = C.check_duplicate_columns(spark, header)
    filled = rows.agg(F.sum(F.expr("CAST(c1 IS NOT NULL AS BIGINT) + CAST(c3 IS NOT NULL AS BIGINT)"))).scalar()
    return found.select("column_name", "n_columns", "positions", filled.alias("n_filled"))


def _kinds(c: str, source: str) -> str:
    numeric, date = count_class(c, "numeric", False), count_class(c, "date", False)
    text = f"{count_class(c, 'string', False)} + {count_class(c, 'empty', False)}"
    return (
        f"SELECT '{c}' AS column_name, {numeric} AS n_numeric, {date} AS n_date, {text} AS n_string, "
        f"concat_ws(' + ', CASE WHEN {numeric} > 0 THEN 'numeric' END, CASE WHEN {date} > 0 THEN 'date' END, "
        f"CASE WHEN {text} > 0 THEN 'string' END) AS kinds FROM {source}"
    )


@query(
    "mixed_types",
    f"WITH {DIRTY_CUSTOMERS_SQL}, t AS (SELECT CAST(customer_id AS VARCHAR) AS customer_id, nation, segment FROM raw), k AS ("
    + union_all([_kinds(c, "t") for c in CUSTOMER_DIRT])
    + ") SELECT * FROM k WHERE kinds LIKE '%+%'",
)
def mixed_types(spark, sf):
    df = dirty_customers(spark, sf)
    return C.check_mixed_types(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))


PRIORITY_PATTERN = r"^[1-5]-[A-Z ]+$"


@query(
    "formats",
    f"WITH {DIRTY_ORDERS_SQL} SELECT 'priority' AS column_name, '{PRIORITY_PATTERN}' AS pattern, "
    f"count(*) FILTER (WHERE NOT regexp_matches(priority, '{PRIORITY_PATTERN}')) AS n FROM raw",
)
def formats(spark, sf):
    rules = {"priority": PRIORITY_PATTERN, "order_id": r"^\d+$"}
    return C.check_formats(dirty_orders(spark, sf), rules)


@query(
    "mixed_date_formats",
    f"WITH {DIRTY_ORDERS_SQL}, f AS (SELECT {FORMAT_SQL} AS format FROM raw) "
    "SELECT 'ordered_on' AS column_name, concat_ws(' + ', CASE WHEN bool_or(format = 'yyyy-MM-dd') THEN 'yyyy-MM-dd' END, "
    "CASE WHEN bool_or(format = 'yyyy/MM/dd') THEN 'yyyy/MM/dd' END, CASE WHEN bool_or(format = 'other') THEN 'other' END) AS formats, "
    "count(*) FILTER (WHERE format <> 'missing') AS n FROM f",
)
def mixed_date_formats(spark, sf):
    return C.check_date_formats(dirty_orders(spark, sf), ["ordered_on"])


@query(
    "size_bounds",
    """SELECT 'rows' AS measure, count(*) AS value, 1000 AS low, 50000 AS high, count(*) BETWEEN 1000 AND 50000 AS ok FROM lineitem
    UNION ALL SELECT 'columns', 11, NULL, 20, true""",
)
def size_bounds(spark, sf):
    return C.check_size(table(spark, sf, "lineitem"), rows=(1000, 50_000), columns=(None, 20))


@query(
    "missing_limit",
    f"WITH {DOCS_LABELS_SQL}, m AS ("
    + union_all(
        [
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n FROM d"
            for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
        ]
    )
    + ") SELECT column_name, n_missing, round(n_missing::DOUBLE / n, 6) AS missing_share FROM m WHERE n_missing::DOUBLE / n > 0.25",
)
def missing_limit(spark, sf):
    found = C.check_missing(documents_with_labels(spark, sf), 0.25)
    return found.withColumn("missing_share", rounded("missing_share"))


@query(
    "casing",
    f"""WITH {DIRTY_CUSTOMERS_SQL}, s AS (SELECT lower(trim(segment)) AS f, count(DISTINCT segment) AS v, count(*) AS n FROM raw GROUP BY 1)
    SELECT 'segment' AS column_name, count(*) AS n_values, CAST(sum(v) AS BIGINT) AS n_spellings, CAST(sum(n) AS BIGINT) AS n_rows FROM s WHERE v > 1""",
)
def casing(spark, sf):
    return C.check_casing(dirty_customers(spark, sf), ["segment"])


def _is_mixed(columns: list[str]) -> str:
    def total(kind: str) -> str:
        return " + ".join(count_class(c, kind, False) for c in columns)

    return f"({total('numeric')}) > 0 AND ({total('string')}) + ({total('empty')}) > 0"


@query(
    "verdict",
    f"WITH {HANDOFF_SQL} SELECT 'block' AS decision, concat('Handoff contract violations: Duplicate column names: [''customer'']', "
    f"CASE WHEN {_is_mixed(['c1', 'c3'])} THEN '; Column ''customer'' has mixed types (numeric + string)' ELSE '' END) AS reason FROM h",
)
def verdict(spark, sf):
    return C.gate(C.run_contract(handoff_rows(spark, sf), C.Contract(), HANDOFF_HEADER))


@query(
    "verdict_of_typed_table",
    "SELECT CASE WHEN count(*) > 0 THEN 'allow' END AS decision, 'All handoff contract checks passed.' AS reason FROM orders",
)
def verdict_of_typed_table(spark, sf):
    contract = C.Contract(rows=(1, None), max_missing=0.0, categories=["o_orderstatus"])
    return C.gate(C.run_contract(table(spark, sf, "orders"), contract))


@query(
    "full_contract",
    f"""WITH {DIRTY_ORDERS_SQL}, f AS (SELECT *, {FORMAT_SQL} AS format FROM raw), n AS (SELECT count(*) AS rows FROM raw)
    SELECT 'mixed_types' AS "check", 'customer' AS column_name, count(customer) AS n, 'block' AS severity FROM raw
    UNION ALL SELECT 'mixed_types', 'ordered_on', count(ordered_on), 'block' FROM raw
    UNION ALL SELECT 'formats', 'priority', count(*) FILTER (WHERE NOT regexp_matches(priority, '{PRIORITY_PATTERN}')), 'block' FROM raw
    UNION ALL SELECT 'formats', 'ordered_on', count(*) FILTER (WHERE format <> 'missing'), 'block' FROM f
    UNION ALL SELECT 'size', NULL, count(*), 'warn' FROM raw
    UNION ALL SELECT 'missing', 'priority', count(*) FILTER (WHERE priority IS NULL OR trim(priority) IN ('', '?')), 'block' FROM raw
    UNION ALL SELECT 'casing', 'status', CAST(sum(n) AS BIGINT), 'block' FROM (SELECT lower(trim(status)) AS f, count(DISTINCT status) AS v, count(*) AS n FROM raw GROUP BY 1) WHERE v > 1""",
)
def full_contract(spark, sf):
    contract = C.Contract(
        patterns={"priority": PRIORITY_PATTERN},
        date_columns=["ordered_on"],
        rows=(None, 10),
        max_missing=0.05,
        tokens=("?",),
        categories=["status"],
        warn=("size",),
    )
    return C.run_contract(dirty_orders(spark, sf), contract).select("check", "column_name", "n", "severity")


@query(
    "enforcement",
    f"""WITH {DIRTY_ORDERS_SQL}, b AS (SELECT count(*) FILTER (WHERE NOT regexp_matches(priority, '{PRIORITY_PATTERN}')) > 0 AS broken FROM raw)
    SELECT 'hard' AS mode, CASE WHEN broken THEN 'blocked' ELSE 'allow' END AS outcome FROM b
    UNION ALL SELECT 'soft', CASE WHEN broken THEN 'warn' ELSE 'allow' END FROM b
    UNION ALL SELECT 'default', 'allow' FROM b""",
)
def enforcement(spark, sf):
    rows = dirty_orders(spark, sf).select("order_id", "priority")
    patterns = {"priority": PRIORITY_PATTERN}
    contracts = {
        "hard": C.Contract(patterns=patterns),
        "soft": C.Contract(patterns=patterns, warn=("formats",)),
        "default": C.Contract(),
    }
    outcomes = []
    for mode, contract in contracts.items():
        try:
            outcome = C.enforce(C.gate(C.run_contract(rows, contract)))
        except C.ContractBlocked:
            outcome = "blocked"
        outcomes.append((mode, outcome))
    return spark.createDataFrame(outcomes, "mode string, outcome string")


ITEM_RULES = {
    "small_discount": "l_discount <= 0.09",
    "known_flag": "l_returnflag IN ('A', 'N', 'R')",
    "few_pieces": "l_quantity < 48",
    "taxed": "l_tax > 0",
}
BROKEN_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({r}) THEN '{n}' END" for n, r in ITEM_RULES.items()) + ")"


@query(
    "quarantined_rows",
    f"SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, {BROKEN_SQL} AS failed_rules FROM lineitem) WHERE failed_rules <> ''",
)
def quarantined_rows(spark, sf):
    _, bad = C.split_valid(table(spark, sf, "lineitem"), ITEM_RULES)
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "failed_rules")


@query(
    "passing_rows",
    f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {BROKEN_SQL} = ''",
)
def passing_rows(spark, sf):
    ok, _ = C.split_valid(table(spark, sf, "lineitem"), ITEM_RULES)
    return ok.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "unresolved_refs",
    f"""WITH w AS (SELECT DISTINCT concat('/', w) AS ref FROM (SELECT unnest({WORDS_SQL}) AS w FROM benchmark)),
    c AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS ref FROM pages)
    SELECT page_id, ref, count(*) AS n FROM c WHERE ref NOT IN (SELECT ref FROM w) GROUP BY page_id, ref""",
)
def unresolved_refs(spark, sf):
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    index = table(spark, sf, "benchmark").select(F.explode(words).alias("w")).select(F.concat(F.lit("/"), "w").alias("ref"))
    return C.unresolved_refs(table(spark, sf, "pages"), "page_id", "html", r'href="([^"]*)"', index, "ref")


@query(
    "json_keys",
    """WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 50 = 0 THEN substr(props, 1, 4) WHEN event_id % 70 = 1 THEN '[1]' ELSE props END AS props FROM events),
    s AS (SELECT event_id, event_type, CASE WHEN NOT json_valid(props) OR props = '[1]' THEN 'invalid'
      WHEN event_type NOT IN ('purchase', 'error', 'click', 'view') THEN 'unknown_type' WHEN event_type IN ('purchase', 'error') THEN 'missing_keys' END AS status FROM e)
    SELECT event_id, event_type, status, CASE WHEN status = 'missing_keys' THEN CASE event_type WHEN 'purchase' THEN 'amount' ELSE 'code,trace' END END AS missing
    FROM s WHERE status IS NOT NULL""",
)
def json_keys(spark, sf):
    damaged = (
        F.when(F.col("event_id") % 50 == 0, F.substring("props", 1, 4))
        .when(F.col("event_id") % 70 == 1, "[1]")
        .otherwise(F.col("props"))
    )
    required = {"purchase": ["k", "amount"], "error": ["k", "code", "trace"], "click": ["k"], "view": ["k"]}
    events = table(spark, sf, "events").withColumn("props", damaged)
    return C.check_json_keys(events, "event_id", "event_type", "props", required)


@query(
    "required_fields",
    f"""WITH {DOCS_LABELS_SQL}, m AS (SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END,
      CASE WHEN lang IS NULL THEN 'lang' END) AS missing FROM d) SELECT * FROM m WHERE missing <> ''""",
)
def required_fields(spark, sf):
    return C.check_required(documents_with_labels(spark, sf), ["quality", "toxic", "lang"], "doc_id")


# a copy that lacks the unlabelled documents, changes the toxic ones, repeats the poor
# ones and adds pages
ALTERED = """SELECT d.doc_id, CASE WHEN toxic = 1 THEN concat(text, '!') ELSE text END AS text, lang FROM {d} d JOIN {l} l ON d.doc_id = l.doc_id
UNION ALL SELECT page_id + 1000000000, html, 'en' FROM {p}
UNION ALL SELECT d.doc_id, text, lang FROM {d} d JOIN {l} l ON d.doc_id = l.doc_id WHERE quality = 0 AND toxic = 0"""


@query(
    "canonical_diff",
    f"""WITH a AS ({ALTERED.format(d='documents', l='labels', p='pages')}),
    f AS (SELECT doc_id, count(*) AS n_found, min(text || '|' || lang) AS lo, max(text || '|' || lang) AS hi FROM a GROUP BY doc_id),
    b AS (SELECT doc_id, count(*) AS n_bank, min(text || '|' || lang) AS lo, max(text || '|' || lang) AS hi FROM documents GROUP BY doc_id),
    j AS (SELECT coalesce(f.doc_id, b.doc_id) AS doc_id, CASE WHEN n_found IS NULL THEN 'missing' WHEN n_bank IS NULL THEN 'extra'
      WHEN f.lo <> b.lo OR f.hi <> b.hi THEN 'changed' WHEN n_found <> n_bank THEN 'repeated' END AS status,
      coalesce(n_found, 0) AS n_found, coalesce(n_bank, 0) AS n_bank FROM f FULL OUTER JOIN b ON f.doc_id = b.doc_id)
    SELECT * FROM j WHERE status IS NOT NULL""",
)
def canonical_diff(spark, sf):
    bank = table(spark, sf, "documents").select("doc_id", "text", "lang")
    altered = spark.sql(ALTERED, d=bank, l=table(spark, sf, "labels"), p=table(spark, sf, "pages"))
    return C.canonical_diff(altered, bank, "doc_id", ["text", "lang"])


@query(
    "missing_outputs",
    """SELECT concat('out-', doc_id) AS name, CASE WHEN page_id IS NULL THEN 'absent' ELSE 'empty' END AS status
    FROM documents LEFT JOIN pages ON doc_id = page_id WHERE page_id IS NULL OR page_id % 10 = 0""",
)
def missing_outputs(spark, sf):
    expected = table(spark, sf, "documents").select(F.concat(F.lit("out-"), "doc_id").alias("name"))
    size = F.when(F.col("page_id") % 10 == 0, 0).otherwise(F.length("html"))
    actual = table(spark, sf, "pages").select(F.concat(F.lit("out-"), "page_id").alias("name"), size.alias("length"))
    return C.missing_outputs(expected, actual)


SECTIONS = ["<h1>", "<nav>", "<table", "<br>", "</b>", "page=2"]


@query(
    "missing_sections",
    union_all([f"SELECT page_id, '{s}' AS section FROM pages WHERE NOT contains(html, '{s}')" for s in SECTIONS]),
)
def missing_sections(spark, sf):
    return C.missing_sections(table(spark, sf, "pages"), "page_id", "html", SECTIONS)


TERMS = ["License", "und", "that the", "privacy", "of the"]
JARGON_SQL = f"""WITH t AS (SELECT doc_id, {WORDS_SQL} AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM t),
g AS (SELECT doc_id, w AS term FROM w UNION ALL
  SELECT doc_id, concat(w, ' ', lead(w) OVER (PARTITION BY doc_id ORDER BY i)) FROM w)
SELECT doc_id, term, count(*) AS n FROM g WHERE term IN ({", ".join(f"'{t.lower()}'" for t in TERMS)}) GROUP BY doc_id, term"""


@query("jargon_hits", JARGON_SQL)
def jargon_hits(spark, sf):
    return C.jargon_hits(table(spark, sf, "documents"), "doc_id", "text", TERMS)


@query(
    "jargon_hits_of_term_table",
    f"""WITH b AS (SELECT DISTINCT unnest({WORDS_SQL}) AS term FROM benchmark),
    w AS (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents)
    SELECT doc_id, term, count(*) AS n FROM w WHERE term IN (SELECT term FROM b) GROUP BY doc_id, term""",
)
def jargon_hits_of_term_table(spark, sf):
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    terms = table(spark, sf, "benchmark").select(F.explode(words).alias("term"))
    return C.jargon_hits(table(spark, sf, "documents"), "doc_id", "text", terms)
