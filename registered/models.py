"""F1 to F4."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators import evaluate as M
from proofline.operators import features as E
from proofline.plans.modelling import compare_feature_sets, published_row, rushed_set
from proofline.session import materialize
from registered.base import query, rounded, table, union_all
from registered.engineering import auc_sql


@query(
    "split_sides",
    """WITH b AS (SELECT o_orderkey, ('0x' || substr(md5(concat(o_orderkey, '-42')), 1, 8))::BIGINT % 100 AS b FROM orders)
    SELECT CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS side, o_orderkey FROM b""",
)
def split_sides(spark, sf):
    train, test = M.split(table(spark, sf, "orders"), "o_orderkey")
    return train.select(F.lit("train").alias("side"), "o_orderkey").unionByName(
        test.select(F.lit("test").alias("side"), "o_orderkey")
    )


def labelled_texts(spark, sf):
    """Labelled documents with plain and engineered features."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    made = E.text_features(docs, "text").select(
        "doc_id",
        "quality",
        "n_chars",
        "feat_text_words",
        "feat_text_digits",
        "feat_text_capitals",
        "feat_text_punctuation",
    )
    made = E.ratio(made, "feat_text_punctuation", "feat_text_words", "punctuation_per_word")
    return E.ratio(made, "feat_text_digits", "n_chars", "digit_share")


@query(
    "fitted_logit",
    """WITH t AS (SELECT documents.doc_id FROM documents JOIN labels ON documents.doc_id = labels.doc_id
      WHERE ('0x' || substr(md5(concat(documents.doc_id, '-42')), 1, 8))::BIGINT % 100 < 80)
    SELECT term, count(*) AS n, 0.0 AS gradient FROM t, (VALUES ('feat_text_words'), ('feat_text_digits'), ('feat_punctuation_per_word'), ('intercept')) v(term) GROUP BY term""",
)
def fitted_logit(spark, sf):
    cols = ["feat_text_words", "feat_text_digits", "feat_punctuation_per_word"]
    train, _ = M.split(labelled_texts(spark, sf).na.fill(0.0), "doc_id")
    # the text is read once, the fit then passes over three numbers a row
    scaled = E.scale(materialize(train.select(*cols, "quality")), cols)
    scaled = materialize(scaled.fillna(0.0))
    model = M.fit_logit(scaled, [f"feat_{c}_standard" for c in cols], "quality", reg=0.01)
    # at the best weights the residuals are balanced: their mean product with each feature
    # is what the penalty takes, and their mean is zero
    residual = F.col("score") - F.col("quality")
    parts = [
        F.struct(F.lit(c).alias("term"), (residual * F.col(f"feat_{c}_standard") + 0.01 * w).alias("slope"))
        for c, w in zip(cols, model.weights)
    ]
    parts.append(F.struct(F.lit("intercept").alias("term"), residual.alias("slope")))
    slopes = model.score(scaled).select(F.inline(F.array(*parts)))
    return slopes.groupBy("term").agg(F.count("*").alias("n"), (F.round(F.avg("slope"), 3) + 0.0).alias("gradient"))


# figures to stand beside the own ones: accuracy, F1, AUC
PUBLISHED = (0.9, 0.95, 0.8)


SETS = {
    "baseline": ["n_chars"],
    "engineered": ["n_chars", "feat_text_digits", "feat_punctuation_per_word", "feat_digit_share"],
    "rushed": ["n_chars", "feat_text_words", "feat_digit_share"],
}
NEWTON_STEPS, NEWTON_REG = 8, 1e-3


def _newton_sql(name: str, cols: list[str]) -> str:
    """The steps of Newton's method, one after another, from standardised features to scores of the test side."""
    size = len(cols) + 1
    spots = range(1, size)
    values = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(cols, 1))
    complete = " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) if name == "rushed" else ""
    means = ", ".join(f"avg(x{i}) FILTER (WHERE train) AS m{i}" for i in spots)
    spread = ", ".join(f"stddev_samp(x{i}) FILTER (WHERE train) AS d{i}" for i in spots)
    made = [
        f"{name}_raw AS MATERIALIZED (SELECT y, train, {values} FROM texts{complete})",
        f"{name}_mean AS MATERIALIZED (SELECT {means} FROM {name}_raw)",
        f"{name}_full AS MATERIALIZED (SELECT y, train, {', '.join(f'coalesce(x{i}, m{i}) AS x{i}' for i in spots)} FROM {name}_raw, {name}_mean)",
        f"{name}_stat AS MATERIALIZED (SELECT {means}, {spread} FROM {name}_full)",
        f"{name}_x AS MATERIALIZED (SELECT y, train, CAST(1 AS DOUBLE) AS x0, {', '.join(f'coalesce((x{i} - m{i}) / nullif(d{i}, 0), 0) AS x{i}' for i in spots)} FROM {name}_full, {name}_stat)",
        f"{name}_b0 AS MATERIALIZED (SELECT {', '.join(f'CAST(0 AS DOUBLE) AS b{i}' for i in range(size))})",
    ]
    z = " + ".join(f"b{i} * x{i}" for i in range(size))
    for step in range(1, NEWTON_STEPS + 1):
        before = f"{name}_b{step - 1}"
        sums = ", ".join(
            [f"avg((y - p) * x{i}) AS s{i}" for i in range(size)] + [f"avg(p * (1 - p) * x{i} * x{j}) AS t{i}_{j}" for i in range(size) for j in range(i, size)]
        )
        made.append(f"{name}_s{step} AS MATERIALIZED (SELECT {sums} FROM (SELECT *, 1 / (1 + exp(-({z}))) AS p FROM {name}_x, {before} WHERE train))")
        penalty = [0.0] + [NEWTON_REG] * len(cols)
        start = [f"s{i} - {penalty[i]} * b{i} AS g{i}" for i in range(size)]
        start += [f"t{min(i, j)}_{max(i, j)}{f' + {penalty[i]}' if i == j else ''} AS h{i}_{j}" for i in range(size) for j in range(size)]
        made.append(f"{name}_e{step}_0 AS MATERIALIZED (SELECT {', '.join(start)} FROM {name}_s{step}, {before})")
        for c in range(size - 1):
            rows = []
            for r in range(size):
                factor = f"(h{r}_{c} / h{c}_{c})"
                rows += [f"g{r} - {factor} * g{c} AS g{r}" if r > c else f"g{r}"]
                rows += [f"h{r}_{j} - {factor} * h{c}_{j} AS h{r}_{j}" if r > c else f"h{r}_{j}" for j in range(size)]
            made.append(f"{name}_e{step}_{c + 1} AS MATERIALIZED (SELECT {', '.join(rows)} FROM {name}_e{step}_{c})")
        source = f"{name}_e{step}_{size - 1}"
        # from the last unknown to the first
        for r in reversed(range(size)):
            rest = "".join(f" - h{r}_{j} * u{j}" for j in range(r + 1, size))
            source = f"(SELECT *, (g{r}{rest}) / h{r}_{r} AS u{r} FROM {source})"
        made.append(f"{name}_b{step} AS MATERIALIZED (SELECT {', '.join(f'b{i} + u{i} AS b{i}' for i in range(size))} FROM {source}, {before})")
    made.append(f"{name}_p AS MATERIALIZED (SELECT y, 1 / (1 + exp(-({z}))) AS score FROM {name}_x, {name}_b{NEWTON_STEPS} WHERE NOT train)")
    return ",\n".join(made)


def _set_metrics_sql(name: str) -> str:
    hit = "(score >= 0.5)"
    return (
        f"SELECT '{name}' AS feature_set, avg(CAST({hit} = (y = 1) AS INT)) AS accuracy, "
        f"2.0 * count(*) FILTER (WHERE {hit} AND y = 1) / (count(*) FILTER (WHERE {hit}) + count(*) FILTER (WHERE y = 1)) AS f1, "
        f"{auc_sql(f'{name}_p', 'score', 'y')} AS auc FROM {name}_p"
    )


COMPARISON_SQL = (
    """WITH counted AS (SELECT documents.doc_id, quality AS y, n_chars, len(regexp_extract_all(text, '\\S+')) AS feat_text_words, len(regexp_extract_all(text, '\\d')) AS feat_text_digits,
      len(regexp_extract_all(text, '\\p{P}')) AS punctuation FROM documents JOIN labels ON documents.doc_id = labels.doc_id),
    texts AS MATERIALIZED (SELECT *, punctuation / nullif(feat_text_words, 0) AS feat_punctuation_per_word, feat_text_digits / nullif(n_chars, 0) AS feat_digit_share,
      ('0x' || substr(md5(concat(doc_id, '-42')), 1, 8))::BIGINT % 100 < 80 AS train FROM counted),
    """
    + ",\n".join(_newton_sql(name, cols) for name, cols in SETS.items())
    + f", m AS (SELECT * FROM ({union_all([_set_metrics_sql(name) for name in SETS])} UNION ALL SELECT 'published', {PUBLISHED[0]}, {PUBLISHED[1]}, {PUBLISHED[2]})), "
    "b AS (SELECT * FROM m WHERE feature_set = 'baseline') SELECT m.feature_set, "
    + ", ".join(f"round(m.{c}, 6) AS {c}, round((m.{c} - b.{c}) * 100, 4) AS {c}_lift" for c in ("accuracy", "f1", "auc"))
    + " FROM m, b"
)


@query("feature_set_comparison", COMPARISON_SQL)
def feature_set_comparison(spark, sf):
    def newton(train, cols, label):
        return M.fit_newton(train, cols, label, NEWTON_STEPS, NEWTON_REG)

    texts = materialize(labelled_texts(spark, sf))
    rushed = rushed_set(texts, "doc_id", "quality", SETS["rushed"], fit=newton)
    sets = {name: cols for name, cols in SETS.items() if name != "rushed"}
    found = compare_feature_sets(texts, "doc_id", "quality", sets, [rushed, published_row(spark, *PUBLISHED)], newton)
    measures = ("accuracy", "f1", "auc")
    return found.select(
        "feature_set", *[rounded(c).alias(c) for c in measures], *[rounded(f"{c}_lift", 4).alias(f"{c}_lift") for c in measures]
    )


SCORED_SQL = """s AS (SELECT quality, CAST(n_chars AS DOUBLE) AS size, CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE) / n_chars AS density
FROM documents JOIN labels ON documents.doc_id = labels.doc_id)"""


def _metrics_sql(name: str, score: str, threshold: float) -> str:
    hit = f"({score} >= {threshold})"
    return (
        f"SELECT '{name}' AS feature_set, count(*) AS n, avg(CAST({hit} = (quality = 1) AS INT)) AS accuracy, "
        f"2.0 * count(*) FILTER (WHERE {hit} AND quality = 1) / (count(*) FILTER (WHERE {hit}) + count(*) FILTER (WHERE quality = 1)) AS f1, "
        f"{auc_sql('s', score, 'quality')} AS auc FROM s"
    )


def scored_texts(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    words = F.regexp_count("text", F.lit(r"\S+")).cast("double")
    return docs.select("quality", F.col("n_chars").cast("double").alias("size"), (words / F.col("n_chars")).alias("density"))


@query(
    "binary_metrics",
    f"WITH {SCORED_SQL} SELECT n, round(accuracy, 9) AS accuracy, round(f1, 9) AS f1, round(auc, 9) AS auc FROM ({_metrics_sql('x', 'size', 500)})",
)
def binary_metrics(spark, sf):
    found = M.binary_metrics(scored_texts(spark, sf), "quality", "size", 500)
    return found.withColumns({c: rounded(c, 9) for c in ("accuracy", "f1", "auc")})


@query(
    "model_lift",
    f"WITH {SCORED_SQL}, m AS ({union_all([_metrics_sql('baseline', 'size', 500), _metrics_sql('engineered', 'density', 0.16)])} UNION ALL SELECT 'published', NULL, {PUBLISHED[0]}, {PUBLISHED[1]}, {PUBLISHED[2]}), b AS (SELECT * FROM m WHERE feature_set = 'baseline') "
    "SELECT m.feature_set, "
    + ", ".join(f"round(m.{c}, 9) AS {c}, round((m.{c} - b.{c}) * 100, 6) AS {c}_lift" for c in ("accuracy", "f1", "auc"))
    + " FROM m, b",
)
def model_lift(spark, sf):
    # the texts are scored once
    scored = materialize(scored_texts(spark, sf)).withColumnsRenamed({"size": "baseline", "density": "engineered"})
    measured = M.metrics_table(scored, "quality", {"baseline": 500, "engineered": 0.16})
    measured = measured.withColumnRenamed("score_name", "feature_set")
    found = M.compare_models(measured.unionByName(published_row(spark, *PUBLISHED)))
    return found.withColumns(
        {c: rounded(c, 9) for c in ("accuracy", "f1", "auc")}
        | {f"{c}_lift": rounded(f"{c}_lift", 6) for c in ("accuracy", "f1", "auc")}
    )
