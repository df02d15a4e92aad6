"""Cleaning, with a record of every change."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.expressions import DATE_FORMATS, MALFORMED, MASK_TOKENS, col
from proofline.functions.longform import rows_of
from proofline.functions.lookups import lookup_join
from proofline.functions.ordered import exact_quantiles
from proofline.operators.profile import null_profile
from proofline.session import materialize


def rename(df: DataFrame, mapping: Mapping[str, str], header: Sequence[str] | None = None) -> DataFrame:
    """New names from a mapping; with ``header``, names of the cells of a raw scan by position."""
    if header is not None:
        df = df.drop(MALFORMED)
    names = [mapping.get(n, n) for n in (header or df.columns)]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"names would repeat: {repeated}")
    return df.toDF(*names)


def unmask_nulls(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = MASK_TOKENS) -> DataFrame:
    """Tokens that stand for null become NULL."""
    return df.withColumns({c: X.unmasked(col(c), tokens) for c in cols})


def coerce(df: DataFrame, types: Mapping[str, str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """D3: text columns to types; what does not fit becomes NULL (see ``mistake_log``)."""
    return df.withColumns({c: X.typed(col(c), t, formats) for c, t in types.items()})


def normalize_dates(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """One date column from text in several formats."""
    return df.withColumn(name, X.parsed_date(col(name), formats))


def canonicalize(df: DataFrame, name: str, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """Map values to their canonical form; values outside the mapping stay.

    A mapping given as a table has the columns ``value`` and ``canonical``, of any size; a
    value with several canonical forms takes the least (see ``contradictory``).
    """
    if isinstance(mapping, Mapping):
        mapping = df.sparkSession.createDataFrame(
            list(mapping.items()), "value string, canonical string"
        )
    lookup = mapping.groupBy(F.col("value").alias("__value")).agg(F.min("canonical").alias("__canonical"))
    joined = lookup_join(df.withColumn("__value", col(name)), materialize(lookup), ["__value"])
    return joined.withColumn(name, F.coalesce("__canonical", col(name))).select(*[col(c) for c in df.columns])


def contradictory(mapping: DataFrame) -> DataFrame:
    """Values that a mapping (value, canonical) gives several canonical forms, with the number of them."""
    forms = mapping.groupBy("value").agg(F.count_distinct("canonical").alias("n_forms"), F.min("canonical").alias("used"))
    return forms.where(F.col("n_forms") > 1)


def fold_case(df: DataFrame, cols: Sequence[str], style: str = "lower") -> DataFrame:
    """One casing and no outer blanks."""
    return df.withColumns({c: X.folded(col(c), style) for c in cols})


def is_missing(df: DataFrame, name: str) -> Column:
    return X.present(df, name).isNull()


def fill_values(df: DataFrame, strategies: Mapping[str, object]) -> dict[str, Column]:
    """Fill value per column, as one-row subqueries over ``df``.

    Strategies: ``mean``, ``median``, ``mode`` or ``("constant", value)``. The median is
    exact and the mode is the least of the most frequent values, as numbers or dates if they are.
    """
    fills: dict[str, Column] = {}
    by_kind: dict[str, list[str]] = {"mean": [], "median": [], "mode": []}
    for name, strategy in strategies.items():
        if isinstance(strategy, tuple):
            fills[name] = F.lit(strategy[1])
        else:
            by_kind[str(strategy)].append(name)
    if by_kind["mean"]:
        means = [F.avg(F.when(~is_missing(df, c), col(c))).alias(f"v{i}") for i, c in enumerate(by_kind["mean"])]
        row = df.agg(F.struct(*means)).scalar()
        fills.update({c: row[f"v{i}"] for i, c in enumerate(by_kind["mean"])})
    if by_kind["median"]:
        found = exact_quantiles(df, by_kind["median"], [0.5])
        fills.update(_per_column(found, by_kind["median"]))
    if by_kind["mode"]:
        fills.update(_modes(df, by_kind["mode"]))
    return {c: fills[c].cast(X.dtype(df, c)) for c in strategies}


def _modes(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """The least of the most frequent values of each column, all from one scan and one shuffle.

    Every cell becomes a row with a field of its own type for each column, of which only its
    own is filled: such rows can be counted together, and ordered by all fields they are in the
    order of the type of the one that is there.
    """
    fields = [f"v{i}" for i in range(len(cols))]
    cells = []
    for i, c in enumerate(cols):
        values = [X.present(df, c) if f == fields[i] else F.lit(None).cast(X.dtype(df, cols[j])) for j, f in enumerate(fields)]
        cells.append(F.struct(F.lit(i).alias("i"), *[v.alias(f) for v, f in zip(values, fields)]))
    rows = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(" OR ".join(f"{f} IS NOT NULL" for f in fields))
    counts = rows.groupBy("i", *fields).agg(F.count("*").alias("n"))
    best = counts.groupBy("i").agg(F.min_by(F.struct(*fields), F.struct((-F.col("n")).alias("n"), *fields)).alias("best"))
    row = best.agg(F.struct(*[F.max(F.when(F.col("i") == i, F.col(f"best.{f}"))).alias(f) for i, f in enumerate(fields)])).scalar()
    return {c: row[f] for c, f in zip(cols, fields)}


def _per_column(found: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    picked = [F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(f"v{i}") for i, c in enumerate(cols)]
    row = found.agg(F.struct(*picked)).scalar()
    return {c: row[f"v{i}"] for i, c in enumerate(cols)}


def impute(df: DataFrame, strategies: Mapping[str, object], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill missing values; ``fit_on`` takes the fill values from another table."""
    fills = fill_values(df if fit_on is None else fit_on, strategies)
    return df.withColumns({c: F.when(is_missing(df, c), v).otherwise(col(c)) for c, v in fills.items()})


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Only the rows in which all named columns hold a value."""
    return df.na.drop(subset=list(cols or df.columns))


@dataclass(frozen=True)
class Step:
    """One change to one column: what is done, why, and how."""

    column: str
    what: str
    why: str
    change: Callable[[Column], Column]


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Run the steps in order. Column metadata is kept, as expressions would drop it."""
    for step in steps:
        kept = df.schema[step.column].metadata
        df = df.withColumn(step.column, step.change(col(step.column)))
        if kept:
            df = df.withMetadata(step.column, kept)
    return df


def change_log(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """What each step did and why, with its impact in rows.

    Every version of a changed column stands beside the one before it in one
    projection, so before and after are compared without a join. Where a step changes
    the type, only lost values count as changed.
    """
    used = sorted({s.column for s in steps})
    staged = df.select(*[col(c).alias(f"raw_{i}") for i, c in enumerate(used)])
    latest = {c: f"raw_{i}" for i, c in enumerate(used)}
    pairs = []
    for i, step in enumerate(steps):
        before = latest[step.column]
        staged = staged.withColumn(f"v{i}", step.change(F.col(before)))
        latest[step.column] = f"v{i}"
        pairs.append((before, f"v{i}"))
    types = {f.name: f.dataType for f in staged.schema}
    aggs = [F.count("*").alias("n_rows")]
    for i, (b, a) in enumerate(pairs):
        before, after = F.col(b), F.col(a)
        lost = before.isNotNull() & after.isNull()
        changed = ~before.eqNullSafe(after) if types[b] == types[a] else lost
        aggs += [
            F.count_if(changed).alias(f"changed_{i}"),
            F.count_if(lost).alias(f"nulled_{i}"),
            F.count_if(before.isNull() & after.isNotNull()).alias(f"filled_{i}"),
        ]
    entries = [
        {
            "seq": F.lit(i),
            "column_name": F.lit(s.column),
            "what": F.lit(s.what),
            "why": F.lit(s.why),
            "n_rows": F.col("n_rows"),
            "n_changed": F.col(f"changed_{i}"),
            "n_nulled": F.col(f"nulled_{i}"),
            "n_filled": F.col(f"filled_{i}"),
        }
        for i, s in enumerate(steps)
    ]
    return rows_of(staged.agg(*aggs), entries)


# Why a fill or a rename is made, in the words of the log.
FILLED_WHY = "a model or a sum needs a value in every row"
RENAMED_WHY = "the name should say what the column holds"
FILLED_BY = {"mean": "the mean", "median": "the median", "mode": "the mode"}


def rename_log(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """D9 for renames: one entry per renamed column, in the form of ``change_log``."""
    return rows_of(
        df.agg(F.count("*").alias("n_rows")),
        [_log_entry(new, f"renamed from {old}", RENAMED_WHY, F.lit(0)) for old, new in mapping.items() if old != new],
    )


def fill_log(df: DataFrame, strategies: Mapping[str, object]) -> DataFrame:
    """D9 for imputation: one entry per filled column of ``df``, the table before it is filled."""
    aggs = [F.count_if(is_missing(df, c)).alias(f"filled_{i}") for i, c in enumerate(strategies)]
    return rows_of(
        df.agg(F.count("*").alias("n_rows"), *aggs),
        [
            _log_entry(c, f"missing values filled by {FILLED_BY.get(str(s), 'a constant')}", FILLED_WHY, F.col(f"filled_{i}"))
            for i, (c, s) in enumerate(strategies.items())
        ],
    )


def drop_log(before: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """D9 for dropped rows: how many rows of ``before`` lack a value in one of the columns."""
    cols = list(cols or before.columns)
    gone = F.exists(F.array(*[col(c).isNull() for c in cols]), lambda x: x)
    return rows_of(
        before.agg(F.count("*").alias("n_rows"), F.count_if(gone).alias("gone")),
        [_log_entry(",".join(cols), "rows with missing values dropped", "only whole rows can be used", F.lit(0)) | {"n_changed": F.col("gone")}],
    )


def _log_entry(column: str, what: str, why: str, filled: Column) -> dict[str, Column]:
    return {
        "seq": F.lit(0),
        "column_name": F.lit(column),
        "what": F.lit(what),
        "why": F.lit(why),
        "n_rows": F.col("n_rows"),
        "n_changed": filled.cast("bigint"),
        "n_nulled": F.lit(0).cast("bigint"),
        "n_filled": filled.cast("bigint"),
    }


def transformation_report(changes: DataFrame, confidences: DataFrame) -> DataFrame:
    """The change log with the confidence in each change (E13); its proposals are ``column: what``."""
    named = changes.withColumn("proposal", F.concat_ws(": ", "column_name", "what"))
    return named.join(confidences.select("proposal", "score", "band"), "proposal", "left").drop("proposal")


def mistake_log(
    df: DataFrame,
    key: str,
    types: Mapping[str, str],
    tokens: Sequence[str] = MASK_TOKENS,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Values that no rule could type, for people to look at.

    Masked nulls are resolved, hence not listed.
    """
    cells = []
    for name, type_name in types.items():
        raw = X.unmasked(col(name), tokens)
        open_ = raw.isNotNull() & (X.trimmed(raw) != "") & X.typed(raw, type_name, formats).isNull()
        cells.append(
            F.when(
                open_,
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.lit(type_name).alias("wanted_type"),
                    col(name).cast("string").alias("raw_value"),
                ),
            )
        )
    return df.select(col(key), F.inline(F.array_compact(F.array(*cells))))


def carry_flags(src: DataFrame, dst: DataFrame, lineage: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Attach the sensitivity of source columns to the columns made from them.

    Columns that keep their name need no lineage entry.
    """
    sensitive = {f.name for f in src.schema if f.metadata.get("sensitive")}
    lineage = lineage or {}
    for f in dst.schema:
        origin = lineage.get(f.name, [f.name])
        marked = [c for c in origin if c in sensitive]
        if marked:
            dst = dst.withMetadata(f.name, {**f.metadata, "sensitive": True, "from": ",".join(marked)})
    return dst


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, missing values and type per column of two tables side by side."""

    def facts(df: DataFrame, side: str) -> DataFrame:
        types = {f.name: f.dataType.simpleString() for f in df.schema}
        pairs = F.create_map(*[F.lit(p) for item in types.items() for p in item])
        missing = F.col("n_null") + F.col("n_empty") + F.col("n_masked")
        return null_profile(df).select(
            "column_name",
            F.col("n_rows").alias(f"rows_{side}"),
            missing.alias(f"missing_{side}"),
            pairs[F.col("column_name")].alias(f"type_{side}"),
        )

    both = facts(a, "a").join(facts(b, "b"), "column_name", "full_outer")
    for what in ("rows", "missing", "type"):
        both = both.withColumn(f"same_{what}", F.col(f"{what}_a").eqNullSafe(F.col(f"{what}_b")))
    return both
