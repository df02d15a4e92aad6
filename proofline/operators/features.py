"""Feature engineering in six ordered batches, with a data dictionary."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.expressions import col, free_names
from proofline.functions.longform import rows_of
from proofline.functions.lookups import fits_broadcast, hot_keys, join_unique, lookup_join
from proofline.functions.ordered import row_numbers
from proofline.operators.evaluate import auc_table
from proofline.session import materialize

# Fixed value: the prefix of every engineered column.
PREFIX = "feat_"
# The order in which batches run.
BATCHES = ("date-time", "text", "aggregate", "ratio", "encoding", "scaling")
# Confidence for no objections, all resolved, caveats left, rejected.
SCORES = {"none": 95, "resolved": 82, "caveat": 67, "rejected": 35}


def feat(name: str) -> str:
    return PREFIX + name


def date_features(df: DataFrame, name: str) -> DataFrame:
    """Calendar parts; weekday 0 is Monday, weeks follow ISO."""
    c = col(name)
    parts = {
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "weekday": F.weekday(c),
        "week": F.weekofyear(c),
        "hour": F.hour(c),
    }
    if df.schema[name].dataType.typeName() == "date":
        del parts["hour"]
    return df.withColumns({feat(f"{name}_{p}"): e for p, e in parts.items()})


def text_features(df: DataFrame, name: str) -> DataFrame:
    """Characters, words, digits, capitals and punctuation of the whole text."""
    c = col(name)
    patterns = {"words": r"\S+", "digits": r"\d", "capitals": r"\p{Lu}", "punctuation": r"\p{P}"}
    made = {feat(f"{name}_chars"): F.length(c)}
    made.update({feat(f"{name}_{p}"): F.regexp_count(c, F.lit(r)) for p, r in patterns.items()})
    return df.withColumns(made)


def group_aggregates(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates per entity, joined back to its rows.

    Combined before the shuffle; rows of a hot entity are spread on the way back, where
    a window would sort them all in one task. The aggregates, which also tell the hot
    entities, are kept as a table, so ``df`` is read twice.
    """
    rows = "__rows_of_entity"
    made = materialize(df.groupBy(*keys).agg(F.count("*").alias(rows), *[a.alias(feat(n)) for n, a in aggs.items()]))
    hot = hot_keys(made, keys, n=rows)
    return join_unique(df, made.drop(rows), keys, hot=hot).select(*[col(c) for c in df.columns], *[feat(n) for n in aggs])


def row_aggregates(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Sum, mean, least, greatest and missing count over a family of columns."""
    values = [X.present(df, c) for c in cols]
    present = X.added([v.isNotNull().cast("int") for v in values])
    total = X.added([F.coalesce(v, F.lit(0)) for v in values])
    made = {
        "sum": F.when(present > 0, total),
        "mean": F.try_divide(total.cast("double"), present),
        "min": F.least(*values),
        "max": F.greatest(*values),
        "missing": F.lit(len(cols)) - present,
    }
    return df.withColumns({feat(f"{name}_{k}"): e for k, e in made.items()})


def ratio_of(num: str, den: str) -> Column:
    return F.try_divide(col(num), col(den))


def ratio(df: DataFrame, num: str, den: str, name: str) -> DataFrame:
    """E5: a derived ratio; a zero denominator gives a missing value."""
    return df.withColumn(feat(name), ratio_of(num, den))


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Products of numeric pairs, joined values of the rest."""
    made = {}
    for a, b in pairs:
        both = X.is_numeric(df, a) and X.is_numeric(df, b)
        absent = col(a).isNull() | col(b).isNull()
        joined = F.when(~absent, F.concat_ws("_", col(a), col(b)))
        made[feat(f"{a}_x_{b}")] = col(a) * col(b) if both else joined
    return df.withColumns(made)


# columns that one-hot encoding may add to a table; beyond them it adds one sparse vector
LEVEL_COLUMNS = 1000


def one_hot_levels(df: DataFrame, name: str) -> list | None:
    """The levels that ``one_hot`` makes columns of, in order: what a training table fits.

    None if there are more than ``LEVEL_COLUMNS``; no more than these come to the driver.
    """
    found = df.select(X.present(df, name).alias("v")).where(F.col("v").isNotNull()).distinct()
    levels = found.limit(LEVEL_COLUMNS + 1).collect()
    return None if len(levels) > LEVEL_COLUMNS else sorted(r["v"] for r in levels)


def one_hot(df: DataFrame, name: str, levels: Sequence | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """A 0/1 column per level; values outside the levels have 0 in all of them.

    ``levels`` or ``fit_on`` fix the levels, so that train and test side get the same
    columns; else they are those of ``df``. With more levels than a table can have columns
    the same zeros and ones are one sparse vector (``one_hot_sparse``). Levels that differ in case
    alone get names with a number behind them.
    """
    if levels is None:
        levels = one_hot_levels(df if fit_on is None else fit_on, name)
    if levels is None:
        return one_hot_sparse(df, name, fit_on)
    names: dict[str, object] = {}
    taken = {c.lower() for c in df.columns}
    for v in levels:
        wanted = made = feat(f"{name}_{v}")
        n = 1
        while made.lower() in taken:
            n += 1
            made = f"{wanted}_{n}"
        taken.add(made.lower())
        names[made] = v
    return df.withColumns({c: F.coalesce(col(name) == v, F.lit(False)).cast("int") for c, v in names.items()})


def level_index(df: DataFrame, name: str) -> DataFrame:
    """(level, position): the levels of a column, numbered from 0 in their order, as a table of any size."""
    levels = df.select(X.present(df, name).alias("level")).where(F.col("level").isNotNull()).distinct()
    return materialize(row_numbers(levels, ["level"], "position"))


def one_hot_long(df: DataFrame, keys: Sequence[str], name: str, fit_on: DataFrame | None = None) -> DataFrame:
    """E7 for any number of levels: the ones of the matrix, a row (keys, level) for each; no driver, no shuffle.

    With ``fit_on`` the rows also have the position of the level among those of that table, and
    values that are no level of it have no row, as they have no one in any column.
    """
    ones = df.select(*[col(k) for k in keys], X.present(df, name).alias("level")).where(F.col("level").isNotNull())
    return ones if fit_on is None else lookup_join(ones, level_index(fit_on, name), ["level"], "inner").select(*keys, "level", "position")


def one_hot_sparse(df: DataFrame, name: str, fit_on: DataFrame | None = None) -> DataFrame:
    """E7 as one sparse vector per row, ``feat_<name>_onehot``: its place in ``level_index`` is 1.

    Values that are no level, and missing ones, have a vector of zeros. The levels stay a table,
    which is broadcast if it is small and joined with hot values spread otherwise.
    """
    index = level_index(df if fit_on is None else fit_on, name)
    n_levels = index.count()
    place, vector = free_names(df, [f"{name}_position", feat(f"{name}_onehot")])
    index = index.select(F.col("level").alias(place + "_level"), F.col("position").cast("double").alias(place))
    keyed = df.withColumn(place + "_level", X.present(df, name))
    # a place beyond the levels is one that the encoder keeps apart, and its vector is empty
    found = lookup_join(keyed, index, [place + "_level"]).withColumn(place, F.coalesce(place, F.lit(float(max(n_levels, 1)))))
    encoder = OneHotEncoder(inputCols=[place], outputCols=[vector], handleInvalid="keep", dropLast=True)
    # the encoder learns nothing but the number of levels
    learnt = df.sparkSession.range(1).select(F.lit(float(max(n_levels, 1) - 1)).alias(place))
    return encoder.fit(learnt).transform(found).select(*[col(c) for c in df.columns], vector)


def label_encode(df: DataFrame, name: str) -> DataFrame:
    """Codes from 0 in the sorted order of the values; NULL stays NULL.

    A measured handful of levels is numbered in one window and broadcast; more of them
    are numbered range by range and joined with hot values spread.
    """
    code = feat(f"{name}_code")
    levels = materialize(df.select(col(name)).where(col(name).isNotNull()).distinct())
    if fits_broadcast(levels):
        number = (F.row_number().over(Window.orderBy(col(name))) - 1).cast("bigint")
        coded = df.join(F.broadcast(levels.select(col(name), number.alias(code))), [name], "left")
    else:
        coded = join_unique(df, row_numbers(levels, [col(name)], code), [name])
    return coded.select(*[col(c) for c in df.columns], code)


def scaled(df: DataFrame, cols: Sequence[str], method: str = "standard") -> dict[str, Column]:
    """Scaling expressions whose statistics are a one-row subquery over ``df``."""
    made = scaled_by(df, [(c, method) for c in cols])
    return {c: made[c, method] for c in cols}


SCALINGS = {"standard": (F.avg, F.stddev_samp), "minmax": (F.min, F.max)}


def scaled_by(df: DataFrame, wanted: Sequence[tuple[str, str]]) -> dict[tuple[str, str], Column]:
    """Expressions for (column, method); the statistics of all of them are one scan of ``df``."""
    named = [(f"s{i}_{j}", f, c) for i, (c, method) in enumerate(wanted) for j, f in enumerate(SCALINGS[method])]
    stats = df.agg(F.struct(*[f(X.present(df, c)).alias(name) for name, f, c in named])).scalar()
    made = {}
    for i, (c, method) in enumerate(wanted):
        base, other = stats[f"s{i}_0"], stats[f"s{i}_1"]
        width = other if method == "standard" else other - base
        made[c, method] = F.try_divide((X.present(df, c) - base).cast("double"), width)
    return made


def scale(
    df: DataFrame, cols: Sequence[str], method: str = "standard", fit_on: DataFrame | None = None
) -> DataFrame:
    """Standard or min-max scaling; no spread gives NULL. ``fit_on`` supplies statistics."""
    made = scaled(df if fit_on is None else fit_on, cols, method)
    return df.withColumns({feat(f"{c}_{method}"): e for c, e in made.items()})


def features_only(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The engineered columns, after the named keys."""
    return df.select(*[col(k) for k in keys], df.colRegex(f"`^{PREFIX}.*`"))


@dataclass(frozen=True)
class Grouped:
    """What a spec of aggregates per entity builds: columns named by ``aggs``.

    As the spec says what it needs instead of doing it, all specs of a batch with the same keys
    share one shuffle. An aggregate is a column or an SQL expression.
    """

    keys: tuple[str, ...]
    aggs: Mapping[str, Column | str]


@dataclass(frozen=True)
class Scaled:
    """What a spec of scaling builds: the spec's column from another one; a batch has one scan for all."""

    column: str
    method: str = "standard"


@dataclass(frozen=True)
class FeatureSpec:
    """One proposed feature. ``build`` gives its column, or the table with its columns, or says what to share."""

    name: str
    batch: str
    sources: tuple[str, ...]
    method: str
    description: str
    missing: str
    build: Callable[[DataFrame], Column | DataFrame] | Grouped | Scaled


def build_features(df: DataFrame, specs: Sequence[FeatureSpec]) -> DataFrame:
    """Run the batches in their fixed order; a batch sees the columns of earlier ones.

    Row-level features of a batch share one projection, aggregates with the same keys one
    shuffle, scaled columns one scan for their statistics. Every feature carries in its metadata
    the columns of ``df`` that it comes from, through features of features, and is sensitive if
    one of them is (D11). A spec must name sources that exist when its batch runs.
    """
    unknown = {s.batch for s in specs} - set(BATCHES)
    if unknown:
        raise ValueError(f"unknown batches: {sorted(unknown)}")
    lineage = Lineage(df)
    for batch in BATCHES:
        own = [s for s in specs if s.batch == batch]
        roots = {s.name: lineage.roots(s) for s in own}
        made: dict[str, list[str]] = {}
        for keys, some in _by_keys(own).items():
            aggs = {n: F.expr(a) if isinstance(a, str) else a for s in some for n, a in s.build.aggs.items()}
            df = group_aggregates(df, keys, aggs)
            made.update({s.name: [feat(n) for n in s.build.aggs] for s in some})
        columns: dict[str, Column] = {}
        for spec in own:
            if isinstance(spec.build, (Grouped, Scaled)):
                continue
            built = spec.build(df)
            if isinstance(built, DataFrame):
                made[spec.name] = [c for c in built.columns if c.startswith(PREFIX) and c not in df.columns]
                df = built
            else:
                columns[feat(spec.name)] = built
                made[spec.name] = [feat(spec.name)]
        scalings = {s.name: (s.build.column, s.build.method) for s in own if isinstance(s.build, Scaled)}
        if scalings:
            found = scaled_by(df, sorted(set(scalings.values())))
            columns.update({feat(name): found[what] for name, what in scalings.items()})
            made.update({name: [feat(name)] for name in scalings})
        if columns:
            df = df.withColumns(columns)
        for spec in own:
            lineage.add(spec, made[spec.name], roots[spec.name])
    return lineage.attached(df)


def _by_keys(specs: Sequence[FeatureSpec]) -> dict[tuple[str, ...], list[FeatureSpec]]:
    found: dict[tuple[str, ...], list[FeatureSpec]] = {}
    for s in specs:
        if isinstance(s.build, Grouped):
            found.setdefault(s.build.keys, []).append(s)
    return found


# keys of the column metadata: the spec of a feature, and the columns it comes from
SPEC, SOURCES = "feature_spec", "source_columns"


class Lineage:
    """Which columns of the first table each feature comes from, and which of them are sensitive.

    A graph of column names, closed as it grows: the roots of a feature are those of its
    sources, which are known when its batch runs. The names of a table are few; no row is read.
    """

    def __init__(self, df: DataFrame) -> None:
        self.metadata = {f.name: f.metadata for f in df.schema}
        # features that the table has already bring their sources along
        self.known = {f.name: tuple(f.metadata.get(SOURCES, (f.name,))) for f in df.schema}
        self.sensitive = {f.name: self._flagged(f) for f in df.schema if f.metadata.get("sensitive")}
        self.of_spec: dict[str, list[str]] = {}

    @staticmethod
    def _flagged(f) -> tuple[str, ...]:
        return tuple(f.metadata["from"].split(",")) if f.metadata.get("from") else (f.name,)

    def _columns(self, source: str) -> list[str]:
        if source in self.known:
            return [source]
        return self.of_spec.get(source, [])

    def roots(self, spec: FeatureSpec) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """(columns of the first table, sensitive ones) that the spec's sources come from."""
        lacking = [s for s in spec.sources if not self._columns(s)]
        if lacking:
            # a source that nobody knows could be a sensitive one
            raise ValueError(f"feature {spec.name!r}: unknown sources {lacking}")
        columns = [c for s in spec.sources for c in self._columns(s)]
        roots = sorted({r for c in columns for r in self.known[c]})
        return tuple(roots), tuple(sorted({r for c in columns for r in self.sensitive.get(c, ())}))

    def add(self, spec: FeatureSpec, names: Sequence[str], roots: tuple[tuple[str, ...], tuple[str, ...]]) -> None:
        self.of_spec[spec.name] = list(names)
        for name in names:
            self.known[name] = roots[0]
            self.metadata[name] = {SPEC: spec.name, SOURCES: list(roots[0])}
            if roots[1]:
                self.sensitive[name] = roots[1]
                self.metadata[name] |= {"sensitive": True, "from": ",".join(roots[1])}

    def attached(self, df: DataFrame) -> DataFrame:
        """``df`` with the metadata of all columns, that of the first table's too."""
        kept = [col(f.name).alias(f.name, metadata={**f.metadata, **self.metadata.get(f.name, {})}) for f in df.schema]
        return df.select(*kept)


def feature_lineage(df: DataFrame) -> DataFrame:
    """A row (feature, spec, source, sensitive) for each column that a feature comes from."""
    rows = []
    for f in df.schema:
        flagged = (f.metadata.get("from") or "").split(",")
        for source in f.metadata.get(SOURCES, ()) if f.name.startswith(PREFIX) else ():
            rows.append((f.name, f.metadata.get(SPEC), source, source in flagged))
    return df.sparkSession.createDataFrame(rows, "feature string, spec string, source string, sensitive boolean")


# Fixed value: what the dictionary says of a feature that no spec describes.
UNDOCUMENTED = "undocumented"


def data_dictionary(df: DataFrame, specs: Sequence[FeatureSpec]) -> DataFrame:
    """One row per feature column with its origin, value range and missing values.

    All columns that a spec made are described by it. Numbers have a range in min_value
    and max_value, other features in min_text and max_text, as text. A feature column that
    no spec knows is listed as undocumented.
    """
    by_name = {s.name: s for s in specs}
    features = [f for f in df.schema if f.name.startswith(PREFIX)]
    aggs = [F.count("*").alias("n_rows")]
    entries = []
    for i, f in enumerate(features):
        spec = by_name.get(f.metadata.get(SPEC, f.name.removeprefix(PREFIX)))
        value, numeric = X.present(df, f.name), X.is_numeric(df, f.name)
        low, high = F.min(value), F.max(value)
        aggs += [
            (low.cast("double") if numeric else F.lit(None).cast("double")).alias(f"lo{i}"),
            (high.cast("double") if numeric else F.lit(None).cast("double")).alias(f"hi{i}"),
            (F.lit(None).cast("string") if numeric else low.cast("string")).alias(f"first{i}"),
            (F.lit(None).cast("string") if numeric else high.cast("string")).alias(f"last{i}"),
            F.count_if(value.isNull()).alias(f"null{i}"),
        ]
        entries.append(
            {
                "name": F.lit(f.name),
                "description": F.lit(spec.description if spec else UNDOCUMENTED),
                "source_columns": F.lit(",".join(spec.sources) if spec else None).cast("string"),
                "method": F.lit(spec.method if spec else None).cast("string"),
                "min_value": F.col(f"lo{i}"),
                "max_value": F.col(f"hi{i}"),
                "min_text": F.col(f"first{i}"),
                "max_text": F.col(f"last{i}"),
                "n_missing": F.col(f"null{i}"),
                "n_rows": F.col("n_rows"),
                "missing_handling": F.lit(spec.missing if spec else None).cast("string"),
            }
        )
    if not entries:
        return df.sparkSession.createDataFrame([], DICTIONARY)
    return rows_of(df.agg(*aggs), entries)


DICTIONARY = (
    "name string, description string, source_columns string, method string, min_value double, max_value double, "
    "min_text string, max_text string, n_missing long, n_rows long, missing_handling string"
)


def challenge_stats(df: DataFrame, feature: str, sources: Sequence[str], den: str, label: str) -> DataFrame:
    """Facts to challenge a feature with, one row per source column.

    Redundancy is its correlation with the source, risk the zero denominators, strength
    the AUC of feature and source against the label.
    """
    stats = df.agg(
        F.count_if(col(den) == 0).alias("n_zero"),
        *[F.corr(col(feature).cast("double"), col(s).cast("double")).alias(f"r{i}") for i, s in enumerate(sources)],
    )
    facts = rows_of(
        stats,
        [
            {"source": F.lit(s), "correlation": F.col(f"r{i}"), "n_zero_denominators": F.col("n_zero")}
            for i, s in enumerate(sources)
        ],
    )
    # one row per score column
    areas = materialize(auc_table(df, [feature, *sources], label).select("score_name", "auc"))
    own = areas.where(F.col("score_name") == feature).select("auc").scalar()
    of_source = areas.select(F.col("score_name").alias("source"), F.col("auc").alias("auc_source"))
    return facts.join(F.broadcast(of_source), "source", "left").select(
        F.lit(feature).alias("feature"),
        "source",
        "correlation",
        "n_zero_denominators",
        own.alias("auc_feature"),
        "auc_source",
    )


def confidence(reviews: DataFrame) -> DataFrame:
    """Score per proposal from its reviews (proposal, outcome).

    Outcomes: ``none``, ``resolved``, ``caveat``, ``rejected``. The gravest one decides;
    any other outcome, such as an objection still open, leaves the score NULL.
    """
    outcome = F.col("outcome")
    known = F.coalesce(outcome.isin(*SCORES), F.lit(False))
    score = F.when(F.col("n_unknown") > 0, None)
    for name in ("rejected", "caveat", "resolved", "none"):
        score = score.when(F.col(name) > 0, SCORES[name])
    band = (
        F.when(F.col("score") > SCORES["caveat"], "high")
        .when(F.col("score") == SCORES["caveat"], "medium")
        .when(F.col("score") < SCORES["caveat"], "low")
    )
    return (
        reviews.groupBy("proposal")
        .agg(
            F.count("*").alias("n_reviews"),
            F.count_if(~known).alias("n_unknown"),
            *[F.count_if(outcome == name).alias(name) for name in SCORES],
        )
        .select("proposal", "n_reviews", score.cast("int").alias("score"))
        .withColumn("band", band)
    )


def plan_features(profile: DataFrame, max_levels: int = 50, long_text: int = 100) -> DataFrame:
    """Batch and method per column from the profile; sensitive columns are left out.

    ``profile`` comes from ``column_profile``.
    """
    type_ = F.col("data_type")
    text = type_ == "string"
    numeric = type_.rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    long_ = text & (F.col("mean_length") > long_text)
    few = F.col("n_distinct") <= max_levels
    batch = (
        F.when(type_.rlike("^(date|timestamp.*)$"), BATCHES[0])
        .when(long_, BATCHES[1])
        .when(text, BATCHES[4])
        .when(numeric, BATCHES[5])
    )
    method = (
        F.when(F.col("batch") == BATCHES[0], "calendar parts")
        .when(F.col("batch") == BATCHES[1], "text counts")
        .when((F.col("batch") == BATCHES[4]) & few, "one-hot")
        .when(F.col("batch") == BATCHES[4], "label codes")
        .otherwise("standard scaling")
    )
    return (
        profile.where(~F.col("sensitive") & (F.col("n_distinct") > 1))
        .withColumn("batch", batch)
        .where(F.col("batch").isNotNull())
        .select("column_name", "data_type", "n_distinct", "batch", method.alias("method"))
    )
