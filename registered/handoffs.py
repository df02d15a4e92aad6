"""Files on disk through the gate, records of preparation, and the cases that clean tables lack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.operators import features as E
from proofline.operators import profile as P
from proofline.operators.clean import Step, transformation_report
from proofline.operators.contract import Contract, as_violations, check_json_keys, gate, missing_outputs
from proofline.operators.profile import column_profile, date_formats, type_profile
from proofline.plans.handoff import check_handoff
from proofline.plans.preparation import Recipe, prepare
from proofline.session import scratch_path
from proofline.sources.raw_csv import read_raw_csv
from proofline.sources.sinks import list_outputs
from registered.base import DIRTY_ORDERS_SQL, dirty_orders, query, rounded, table, union_all


def written_lines(df: DataFrame, header: str, name: str) -> str:
    """Write the column ``line`` as text files that begin with a header each."""
    path = scratch_path(df.sparkSession, name)
    # the first row of each partition has position 0 in the lower bits
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    df.select(F.when(first, F.concat(F.lit(header + "\n"), "line")).otherwise(F.col("line"))).write.text(path)
    return path


RAGGED = {"long": "o_orderkey % 11 = 0", "short": "o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0"}
HEADER = "order_id,customer,status,customer"


def ragged_orders(spark, sf) -> str:
    """Orders as a file whose header repeats a name; some rows have a cell too many or too few."""
    line = f"""concat(o_orderkey, ',', CASE WHEN o_orderkey % 25 = 0 THEN 'C' ELSE '' END, o_custkey, ',', o_orderstatus,
      CASE WHEN {RAGGED['short']} THEN '' ELSE concat(',', o_custkey) END, CASE WHEN {RAGGED['long']} THEN ',surplus' ELSE '' END) AS line"""
    return written_lines(table(spark, sf, "orders").selectExpr(line), HEADER, "ragged-orders")


@query(
    "file_gate",
    f"""SELECT 'block' AS decision, concat('Handoff contract violations: Column ''segment'' is missing; Table has ', count(*) FILTER (WHERE {RAGGED['long']} OR {RAGGED['short']}),
    ' rows with too few or too many cells; Duplicate column names: [''customer'']; Column ''customer'' has mixed types (numeric + string)') AS reason FROM orders""",
)
def file_gate(spark, sf):
    return check_handoff(spark, ragged_orders(spark, sf), Contract(required={"order_id": "bigint", "segment": None}))


@query(
    "ragged_rows",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN {RAGGED['long']} THEN 5 ELSE 3 END AS n_cells
    FROM orders WHERE {RAGGED['long']} OR {RAGGED['short']}""",
)
def ragged_rows(spark, sf):
    rows, _ = read_raw_csv(spark, ragged_orders(spark, sf))
    kept = F.size(F.split("_malformed", ",")).alias("n_cells")
    return rows.where("_malformed IS NOT NULL").select(F.col("c0").alias("order_id"), kept)


@query(
    "names_of_a_file",
    f"""SELECT * FROM (VALUES (0, 'order_id', false, CAST(NULL AS VARCHAR), 1), (1, 'customer', false, NULL, 2), (2, 'sex', false, 'name', 1),
      (3, 'customer', false, NULL, 2), (4, 'X1', true, NULL, 1)) t(position, column_name, is_cryptic, flagged_by, n_columns)
    CROSS JOIN (SELECT count(*) AS n_rows FROM orders)""",
)
def names_of_a_file(spark, sf):
    line = "concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_custkey, o_totalprice) AS line"
    path = written_lines(table(spark, sf, "orders").selectExpr(line), "order_id,customer,sex,customer,X1", "named-orders")
    rows, header = read_raw_csv(spark, path)
    names = P.cryptic_names(spark, header)
    # the names of a raw scan may repeat, so each is looked at by its place
    flags = P.sensitive_columns(rows.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(header)])).select("position", "flagged_by")
    counted = names.groupBy("column_name").agg(F.count("*").cast("int").alias("n_columns"))
    # one row per column of the file
    found = names.join(F.broadcast(flags), "position").join(F.broadcast(counted), "column_name")
    return found.withColumn("n_rows", rows.agg(F.count("*")).scalar())


SPOKEN = {0: "d/M/yyyy", 1: "dd-MMM-yyyy"}


def spoken_dates(spark, sf) -> DataFrame:
    """Order dates in formats whose parts have no fixed width, or are words."""
    day = F.when(F.col("o_orderkey") % 40 == 2, "soon")
    for rest, fmt in SPOKEN.items():
        day = day.when(F.col("o_orderkey") % 3 == rest, F.date_format("o_orderdate", fmt))
    return table(spark, sf, "orders").select("o_orderkey", day.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))


SPOKEN_FORMATS = ("yyyy-MM-dd", *SPOKEN.values())
SPOKEN_SQL = "CASE WHEN o_orderkey % 40 = 2 THEN 'other' WHEN o_orderkey % 3 = 0 THEN 'd/M/yyyy' WHEN o_orderkey % 3 = 1 THEN 'dd-MMM-yyyy' ELSE 'yyyy-MM-dd' END"


@query("dates_in_words", f"SELECT {SPOKEN_SQL} AS format, count(*) AS n FROM orders GROUP BY 1")
def dates_in_words(spark, sf):
    return date_formats(spoken_dates(spark, sf), "day", SPOKEN_FORMATS)


@query(
    "parsed_dates_in_words",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 40 <> 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
)
def parsed_dates_in_words(spark, sf):
    from proofline.operators.clean import normalize_dates

    return normalize_dates(spoken_dates(spark, sf), "day", SPOKEN_FORMATS)


@query(
    "blank_kinds",
    """SELECT 'cell' AS column_name, 0 AS n_null, count(*) FILTER (WHERE o_orderkey % 9 = 0) AS n_empty, count(*) FILTER (WHERE o_orderkey % 9 > 2) AS n_numeric,
    count(*) FILTER (WHERE o_orderkey % 9 = 2) AS n_date, count(*) FILTER (WHERE o_orderkey % 9 = 1) AS n_string FROM orders""",
)
def blank_kinds(spark, sf):
    cell = (
        "CASE o_orderkey % 9 WHEN 0 THEN '\\t \\n' WHEN 1 THEN 'x\\t' WHEN 2 THEN '\\t2024-01-01' ELSE concat('\\r', o_orderkey, '\\t') END AS cell"
    )
    return type_profile(table(spark, sf, "orders").selectExpr(cell))


NAN_SQL = "n AS (SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price FROM orders)"


@query(
    "nan_is_missing",
    f"""WITH {NAN_SQL} SELECT o_orderkey, round(coalesce(price, 0) + o_custkey, 4) AS feat_pair_sum, CASE WHEN price IS NULL THEN 1 ELSE 0 END AS feat_pair_missing,
    round((price - (SELECT min(price) FROM n)) / ((SELECT max(price) FROM n) - (SELECT min(price) FROM n)), 6) AS feat_price_minmax FROM n""",
)
def nan_is_missing(spark, sf):
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), price.alias("price"))
    made = E.scale(E.row_aggregates(rows, ["price", "o_custkey"], "pair"), ["price"], "minmax")
    return made.select(
        "o_orderkey", rounded("feat_pair_sum", 4).alias("feat_pair_sum"), "feat_pair_missing", rounded("feat_price_minmax").alias("feat_price_minmax")
    )


@query(
    "histogram_with_nan",
    f"""WITH {NAN_SQL}, s AS (SELECT min(price) AS lo, max(price) AS hi FROM n)
    SELECT least(floor((price - lo) / ((hi - lo) / 8)) + 1, 8)::INT AS bin, count(*) AS n FROM n, s WHERE price IS NOT NULL GROUP BY 1""",
)
def histogram_with_nan(spark, sf):
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return P.histogram(table(spark, sf, "orders").select(price.alias("price")), ["price"], 8).select("bin", "n")


@query(
    "planned_at_the_limit",
    """SELECT 'fifty' AS column_name, CASE WHEN count(DISTINCT o_orderkey % 50) <= 50 THEN 'one-hot' ELSE 'label codes' END AS method, count(DISTINCT o_orderkey % 50) AS n_distinct FROM orders
    UNION ALL SELECT 'fifty_one', CASE WHEN count(DISTINCT o_orderkey % 51) <= 50 THEN 'one-hot' ELSE 'label codes' END, count(DISTINCT o_orderkey % 51) FROM orders
    UNION ALL SELECT 'two', 'standard scaling', count(DISTINCT o_orderkey % 2) FROM orders HAVING count(DISTINCT o_orderkey % 2) > 1""",
)
def planned_at_the_limit(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey % 2 AS two", "CAST(o_orderkey % 50 AS STRING) AS fifty", "CAST(o_orderkey % 51 AS STRING) AS fifty_one", "1 AS one"
    )
    return E.plan_features(column_profile(rows)).select("column_name", "method", "n_distinct")


def all_kinds_of_specs() -> list[E.FeatureSpec]:
    spec = E.FeatureSpec
    return [
        spec("calendar", "date-time", ("o_orderdate",), "calendar parts", "parts of the order date", "none", lambda df: E.date_features(df, "o_orderdate")),
        spec("priority", "text", ("o_orderpriority",), "text counts", "signs of the priority", "none", lambda df: E.text_features(df, "o_orderpriority")),
        spec("status", "encoding", ("o_orderstatus",), "one-hot", "status of the order", "0", lambda df: E.one_hot(df, "o_orderstatus")),
        spec("both", "encoding", ("o_orderstatus", "o_orderpriority"), "joined", "status and priority", "NULL if either is", lambda df: E.interactions(df, [("o_orderstatus", "o_orderpriority")])),
    ]


_DATED = {"year": "year(d)", "quarter": "quarter(d)", "month": "month(d)", "day": "day(d)", "weekday": "isodow(d) - 1", "week": "week(d)", "hour": "hour(d)"}
_COUNTED = {"chars": "length(p)", "words": "len(regexp_extract_all(p, '\\S+'))", "digits": "len(regexp_extract_all(p, '\\d'))", "capitals": "len(regexp_extract_all(p, '\\p{Lu}'))", "punctuation": "len(regexp_extract_all(p, '\\p{P}'))"}


def _entry(name: str, spec: E.FeatureSpec | None, e: str, text: bool = False) -> str:
    low, high = f"min({e})", f"max({e})"
    number = "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value" if text else f"CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value"
    words = f"{low} AS min_text, {high} AS max_text" if text else "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
    said = f"'{spec.description}' AS description, '{','.join(spec.sources)}' AS source_columns" if spec else f"'{E.UNDOCUMENTED}' AS description, CAST(NULL AS VARCHAR) AS source_columns"
    return f"SELECT 'feat_{name}' AS name, {said}, {number}, {words}, count(*) - count({e}) AS n_missing, count(*) AS n_rows FROM o"


_DATES, _TEXTS, _STATUS, _BOTH = all_kinds_of_specs()


@query(
    "dictionary_of_every_feature",
    "WITH o AS (SELECT o_orderdate AS d, o_orderpriority AS p, o_orderstatus AS s, o_custkey AS c FROM orders) "
    + union_all(
        [
            *[_entry(f"o_orderdate_{k}", _DATES, e) for k, e in _DATED.items()],
            *[_entry(f"o_orderpriority_{k}", _TEXTS, e) for k, e in _COUNTED.items()],
            *[_entry(f"o_orderstatus_{v}", _STATUS, f"CAST(s = '{v}' AS INT)") for v in "FOP"],
            _entry("o_orderstatus_x_o_orderpriority", _BOTH, "concat_ws('_', s, p)", text=True),
            _entry("by_hand", None, "c"),
        ]
    ),
)
def dictionary_of_every_feature(spark, sf):
    specs = all_kinds_of_specs()
    made = E.build_features(table(spark, sf, "orders"), specs).withColumn("feat_by_hand", F.col("o_custkey"))
    return E.data_dictionary(made, specs).drop("method", "missing_handling")


def order_recipe() -> Recipe:
    return Recipe(
        key="id",
        names={"order_id": "id", "customer": "client"},
        types={"client": "bigint", "ordered_on": "date"},
        steps=[Step("status", "upper case", "one spelling for each status", lambda c: F.upper(F.trim(c)))],
        fills={"priority": ("constant", "unknown"), "client": "mode"},
    )


_UNSURE = "customer LIKE 'C%'"


@query(
    "prepared_changes",
    f"""WITH {DIRTY_ORDERS_SQL}, n AS (SELECT count(*) AS n_rows FROM raw), f AS (
      SELECT 0 AS n_changed, 0 AS n_nulled, 0 AS n_filled, 'id' AS column_name, 'renamed from order_id' AS what
      UNION ALL SELECT 0, 0, 0, 'client', 'renamed from customer'
      UNION ALL SELECT 0, 0, 0, 'client', 'masked null to NULL'
      UNION ALL SELECT 0, 0, 0, 'ordered_on', 'masked null to NULL'
      UNION ALL SELECT count(*) FILTER (WHERE status <> upper(trim(status))), 0, 0, 'status', 'upper case' FROM raw
      UNION ALL SELECT count(*) FILTER (WHERE {_UNSURE}), count(*) FILTER (WHERE {_UNSURE}), 0, 'client', 'text to bigint' FROM raw
      UNION ALL SELECT count(*) FILTER (WHERE ordered_on = 'soon'), count(*) FILTER (WHERE ordered_on = 'soon'), 0, 'ordered_on', 'text to date' FROM raw
      UNION ALL SELECT count(*) FILTER (WHERE priority IS NULL), 0, count(*) FILTER (WHERE priority IS NULL), 'priority', 'missing values filled by a constant' FROM raw
      UNION ALL SELECT count(*) FILTER (WHERE {_UNSURE}), 0, count(*) FILTER (WHERE {_UNSURE}), 'client', 'missing values filled by the mode' FROM raw)
    SELECT column_name, what, n_rows, CAST(n_changed AS BIGINT) AS n_changed, CAST(n_nulled AS BIGINT) AS n_nulled, CAST(n_filled AS BIGINT) AS n_filled,
      CASE WHEN what = 'missing values filled by the mode' THEN 67 ELSE 95 END AS score FROM f, n""",
)
def prepared_changes(spark, sf):
    made = prepare(dirty_orders(spark, sf), order_recipe())
    changes = made.changes
    # reviews of the changes: a filled key is kept under a caveat
    doubtful = F.col("what") == "missing values filled by the mode"
    reviews = changes.select(
        F.concat_ws(": ", "column_name", "what").alias("proposal"), F.when(doubtful, "caveat").otherwise("none").alias("outcome")
    )
    report = transformation_report(changes, E.confidence(reviews))
    return report.select("column_name", "what", "n_rows", "n_changed", "n_nulled", "n_filled", "score")


@query(
    "prepared_reports",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT 'profile' AS report, 5 AS n_rows FROM raw HAVING count(*) > 0 UNION ALL SELECT 'changes', 9
    UNION ALL SELECT 'mistakes', count(*) FILTER (WHERE {_UNSURE}) + count(*) FILTER (WHERE ordered_on = 'soon') FROM raw
    UNION ALL SELECT 'table', count(*) FROM raw""",
)
def prepared_reports(spark, sf):
    folder = scratch_path(spark, "prepared")
    prepare(dirty_orders(spark, sf), order_recipe()).write(folder)
    parts = [spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("report"), F.count("*").alias("n_rows")) for name in ("profile", "changes", "mistakes", "table")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "outputs_on_disk",
    """SELECT * FROM (VALUES ('dictionary', 'absent'), ('empty', 'absent')) t(name, status) WHERE (SELECT count(*) FROM orders) > 0""",
)
def outputs_on_disk(spark, sf):
    folder = scratch_path(spark, "outputs")
    orders = table(spark, sf, "orders")
    orders.write.parquet(f"{folder}/table")
    orders.where("false").select("o_orderpriority").coalesce(1).write.text(f"{folder}/empty")
    expected = spark.createDataFrame([("table",), ("empty",), ("dictionary",)], "name string")
    return missing_outputs(expected, list_outputs(spark, folder, depth=2))


@query(
    "gate_of_json_keys",
    """WITH b AS (SELECT count(*) FILTER (WHERE event_type = 'signup') AS unknown, count(*) FILTER (WHERE event_type = 'error') AS lacking FROM events)
    SELECT 'block' AS decision, concat('Handoff contract violations: unknown_type (', unknown, '); missing_keys ''trace'' (', lacking, ')') AS reason FROM b""",
)
def gate_of_json_keys(spark, sf):
    required = {t: ["k"] for t in ("purchase", "click", "view")} | {"error": ["k", "trace"]}
    found = check_json_keys(table(spark, sf, "events"), "event_id", "event_type", "props", required)
    return gate(as_violations(found, "json_keys"))
