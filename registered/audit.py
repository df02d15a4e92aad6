"""G1 to G6."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators import audit as G
from proofline.operators.contract import Contract, run_contract
from registered.base import DIRTY_ORDERS_SQL, WORDS_SQL, dirty_orders, query, rounded, table
from registered.contracts import PRIORITY_PATTERN


@query(
    "audit_rows",
    f"""WITH {DIRTY_ORDERS_SQL}, c AS (
      SELECT 'duplicate_columns' AS "check", 0 AS n_violations
      UNION ALL SELECT 'structure', 0 UNION ALL SELECT 'row_shape', 0
      UNION ALL SELECT 'mixed_types', CAST(count(*) FILTER (WHERE customer LIKE 'C%') > 0 AS INT) + CAST(count(*) FILTER (WHERE ordered_on = 'soon') > 0 AS INT) FROM raw
      UNION ALL SELECT 'formats', CAST(count(*) FILTER (WHERE NOT regexp_matches(priority, '{PRIORITY_PATTERN}')) > 0 AS INT) FROM raw
      UNION ALL SELECT 'size', CAST(count(*) < 1 AS INT) FROM raw
      UNION ALL SELECT 'casing', CAST(count(DISTINCT status) > count(DISTINCT lower(trim(status))) AS INT) FROM raw)
    SELECT 'run-1' AS run_id, "check", CASE WHEN n_violations = 0 THEN 'pass' ELSE 'fail' END AS result, CAST(n_violations AS BIGINT) AS n_violations FROM c""",
)
def audit_rows(spark, sf):
    contract = Contract(patterns={"priority": PRIORITY_PATTERN}, rows=(1, None), categories=["status"])
    violations = run_contract(dirty_orders(spark, sf), contract)
    return G.audit_rows(violations, contract.active(), "run-1", F.current_timestamp()).drop("checked_at")


@query(
    "trace_back",
    """WITH w AS (SELECT user_id, event_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS previous,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INT) AS step FROM events)
    SELECT user_id, step, event_id, event_type, previous FROM w WHERE step <= 5""",
)
def trace_back(spark, sf):
    found = G.trace_back(table(spark, sf, "events"), "user_id", ["ts", "event_id"], 5, "event_type")
    return found.select("user_id", "step", "event_id", "event_type", "previous")


@query(
    "recurring_failures",
    """SELECT user_id, event_type, count(*) AS n_failures, count(DISTINCT CAST(ts AS DATE)) AS n_runs FROM events WHERE event_type = 'error'
    GROUP BY ALL ORDER BY n_failures DESC, user_id, event_type LIMIT 10""",
)
def recurring_failures(spark, sf):
    errors = table(spark, sf, "events").where(F.col("event_type") == "error").withColumn("day", F.to_date("ts"))
    return G.recurring(errors, ["user_id", "event_type"], "day", 10)


@query(
    "run_manifest",
    """SELECT event_type, props, count(*) AS n_runs, min(ts) AS first_at, max(ts) AS last_at, sha256(CAST(to_json(struct_pack(event_type := event_type, props := props)) AS VARCHAR)) AS fingerprint
    FROM events GROUP BY event_type, props""",
)
def run_manifest(spark, sf):
    return G.run_manifest(table(spark, sf, "events"), ["event_type", "props"], "ts")


@query(
    "scorecard",
    """WITH m AS (SELECT source, count(*) AS n, avg(quality) AS mean_quality, avg(toxic) AS mean_toxic FROM documents JOIN labels ON documents.doc_id = labels.doc_id GROUP BY source),
    o AS (SELECT *, round((mean_quality + mean_toxic) / 2, 9) AS overall FROM m)
    SELECT source, n, round(mean_quality, 9) AS mean_quality, round(mean_toxic, 9) AS mean_toxic, overall, row_number() OVER (ORDER BY overall DESC, source) AS position FROM o""",
)
def scorecard(spark, sf):
    scores = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    card = G.scorecard(scores, "source", ["quality", "toxic"])
    return card.withColumns({c: rounded(c, 9) for c in ("mean_quality", "mean_toxic")})


WANTED = "privacy license of data und la terms"


@query(
    "ranked_match",
    f"""WITH t AS (SELECT doc_id, unnest({WORDS_SQL}) AS w FROM documents),
    h AS (SELECT doc_id, w, count(*) AS tf FROM t WHERE w IN ({", ".join(f"'{w}'" for w in WANTED.split())}) GROUP BY doc_id, w),
    d AS (SELECT w, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM h GROUP BY w)
    SELECT doc_id, round(sum(tf * idf), 6) AS score, count(*) AS n_terms FROM h JOIN d ON h.w = d.w GROUP BY doc_id ORDER BY round(sum(tf * idf), 9) DESC, doc_id LIMIT 25""",
)
def ranked_match(spark, sf):
    found = G.ranked_match(table(spark, sf, "documents"), "doc_id", "text", WANTED, 25)
    return found.withColumn("score", rounded("score"))
