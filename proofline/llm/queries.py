"""The dealt operators as queries over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.llm import (
    bitplanes,
    cascade,
    collocations,
    covertree,
    decontaminate,
    licenses,
    maintext,
    packing,
    pii,
    quality,
    search,
    secrets,
    simhash,
    tables,
)
from proofline.session import scratch_path

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
    tables.ready(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_bit_planes")
def op1_bit_planes(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    bitplanes.write_ids(table(spark, sf, "documents"), path, end_id=0)
    read = bitplanes.read_ids(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op2_anchored_pii")
def op2_anchored_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return _digest(found, base, pii.BASE_KINDS)


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def _digest(found: DataFrame, base: Column, kinds: Sequence[str]) -> DataFrame:
    """Counts, checksum and list of spans as the results of the span queries have them."""
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(tables.spans_text(base), 256).alias("base_sha256"),
        tables.spans_text(F.col("spans")).alias("spans"),
    )


@query("op3_random_indexing")
def op3_random_indexing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        (quality.remainder("doc_id") == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_kept").cast("int").alias("predicted"),
    )


@query("op4_latent_leaks")
def op4_latent_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("key")


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_ENDS = " ".join(
    f"WHEN ('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}') THEN '{host}{path}'"
    for host, path, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
)
_BLOCKED = ", ".join(f"'{host}{path}'" for host, path, verdict in URL_RULES if verdict == "block")


@query(
    "op5_bloom_cascade",
    f"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), split AS (
        SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut
    ), parts AS (
        SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
    ), ruled AS (SELECT page_id, host, path, CASE {_ENDS} END AS rule FROM parts)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ({_BLOCKED}) THEN 'block' ELSE 'allow' END AS verdict FROM ruled
    """,
)
def op5_bloom_cascade(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return cascade.judge(table(spark, sf, "pages"), rules).drop("url")


@query("op6_sentence_rules")
def op6_sentence_rules(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.licenses(table(spark, sf, "documents"))


@query("op7_linked_secrets")
def op7_linked_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.secrets(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return _digest(found, base, list(secrets.BASE))


@query("op8_golay_simhash")
def op8_golay_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op9_best_fit")
def op9_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), end_id=2)


@query(
    "op10_cover_tree",
    """
    WITH RECURSIVE vectors AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    valid AS MATERIALIZED (
        SELECT vec_id, e FROM vectors WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
    ), links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.95
    ), reached(a, b) AS (SELECT vec_id, vec_id FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
    least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN counts USING (vec_id)
    """,
)
def op10_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    return covertree.similar_vectors(table(spark, sf, "embeddings"))


@query("op11_nearest_pages")
def op11_nearest_pages(spark: SparkSession, sf: str) -> DataFrame:
    return maintext.main_text(table(spark, sf, "pages"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = (
    f"list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), "
    "lambda t: t <> '')"
)


@query(
    "op12_hybrid_search",
    f"""
    WITH cut AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS ts FROM documents),
    docs AS (SELECT row_id, doc_id, ts, len(ts) AS n FROM cut WHERE len(ts) > 0),
    corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM docs),
    posts AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(ts) AS term FROM docs) GROUP BY ALL),
    weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM posts, corpus GROUP BY term
    ),
    asked AS (SELECT DISTINCT item_id, text FROM benchmark),
    items AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM asked) GROUP BY ALL),
    scored AS (
        SELECT item_id, row_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * corpus.docs) // words)))) AS BIGINT) AS score
        FROM items JOIN weights USING (term) JOIN posts USING (term) JOIN docs USING (row_id), corpus GROUP BY item_id, row_id
    ),
    ranked AS (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
        FROM scored JOIN docs USING (row_id) WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
)
def op12_hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query(
    "op13_suffix_subtrees",
    f"""
    WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
    pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
    cut AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces),
    starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM cut),
    grams AS (
        SELECT lang, 1 AS k, ws[i] AS phrase FROM starts
        UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1] FROM starts WHERE i + 1 <= len(ws)
        UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM starts WHERE i + 2 <= len(ws)
    ),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
    cands AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM counts WHERE k > 1 AND f >= 10),
    cuts AS (
        SELECT lang, phrase, a, 1 AS place, p[1] AS one, array_to_string(p[2:k], ' ') AS rest FROM cands
        UNION ALL SELECT lang, phrase, a, 2, p[1] || ' ' || p[2], p[3] FROM cands WHERE k = 3
    ),
    scored AS (
        SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, place, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = one JOIN counts y ON y.lang = c.lang AND y.phrase = rest
    ),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
    inside AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, p[1] || ' ' || p[2] AS phrase, a FROM cands WHERE k = 3 UNION ALL SELECT lang, p[2] || ' ' || p[3], a FROM cands WHERE k = 3
        ) GROUP BY ALL
    ),
    kept AS (SELECT s.* FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE longer IS NULL OR 100 * longer < 50 * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT ranked.lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
    """,
)
def op13_suffix_subtrees(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))
