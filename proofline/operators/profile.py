"""Profiling. Every per-column count comes from one scan and one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.expressions import DATE_FORMATS, MASK_TOKENS, col
from proofline.functions.longform import long_values, names_of, numeric_columns, rows_of, value_counts
from proofline.functions.ordered import exact_quantiles, sketched_quantiles, top_per_group

QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}

# names that mark a column as a sensitive demographic
SENSITIVE_NAMES = ("sex", "gender", "education", "marriage", "marital_status", "age")


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def shape(df: DataFrame) -> DataFrame:
    """B1: number of rows and columns."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def column_counts(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    tokens: Sequence[str] = (),
    formats: Sequence[str] = DATE_FORMATS,
    shapes: bool = True,
    patterns: Mapping[str, str] | None = None,
    date_columns: Sequence[str] = (),
    typed: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """One row per column with every count that the profile and the contract need.

    position, column_name, n_rows, and the values per class: n_null, n_empty, n_masked,
    n_numeric, n_date, n_string; n_bad counts values off their column's pattern, n_fmt_j
    and n_fmt_other the date formats of ``date_columns``, n_untyped the values that do not fit
    the type that ``typed`` wants, n_malformed the rows with a value in ``malformed``. ``shapes=False`` leaves numbers
    and dates unrecognised, which saves their patterns.

    All of it is one scan: cells become rows that are counted before the shuffle, so the
    shuffle holds one row per column and task, and the code does not grow with the table.
    """
    cols = list(df.columns if cols is None else cols)
    patterns = patterns or {}
    typed = typed or {}
    read_as_text = {*patterns, *date_columns, *typed}
    kinds, texts = [], []
    for c in cols:
        kinds.append(X.typed_class(df, c).cast("int"))
        is_text = X.is_string(df, c) or c in read_as_text
        texts.append(col(c).cast("string") if is_text else F.lit(None).cast("string"))
    ragged = col(malformed).isNotNull() if malformed else F.lit(False)
    cells = df.select(
        F.array(*kinds).alias("kinds"), ragged.alias("ragged"), F.posexplode(F.array(*texts)).alias("position", "text")
    )
    position, text = F.col("position"), F.col("text")
    kind = X.text_class(text, tokens, formats, shapes)
    if not all(X.is_string(df, c) for c in cols):
        kind = F.coalesce(F.get("kinds", position), kind)
    at = {c: i for i, c in enumerate(cols)}
    off = F.lit(False)
    for c, p in patterns.items():
        off = F.when(position == at[c], ~text.rlike(p)).otherwise(off)
    untyped = F.lit(False)
    for c, t in typed.items():
        holds = F.coalesce(X.trimmed(text), F.lit("")) == ""
        untyped = F.when(position == at[c], ~holds & X.typed(text, t, formats).isNull()).otherwise(untyped)
    fmt = F.lit(None).cast("string")
    if date_columns:
        fmt = F.when(position.isin(*[at[c] for c in date_columns]), X.matched_format(text, formats))
    codes = {"null": X.NULL, "empty": X.EMPTY, "masked": X.MASKED, "numeric": X.NUMERIC, "date": X.DATE, "string": X.STRING}
    counts = (
        cells.select("position", "ragged", kind.alias("kind"), off.alias("off"), untyped.alias("untyped"), fmt.alias("fmt"))
        .groupBy("position")
        .agg(
            F.count("*").alias("n_rows"),
            *[F.count_if(F.col("kind") == code).alias(f"n_{name}") for name, code in codes.items()],
            F.count_if("off").alias("n_bad"),
            F.count_if("untyped").alias("n_untyped"),
            F.count_if("ragged").alias("n_malformed"),
            *[F.count_if(F.col("fmt") == f).alias(f"n_fmt_{j}") for j, f in enumerate(formats)],
            F.count_if(F.col("fmt") == "other").alias("n_fmt_other"),
        )
    )
    return names_of(df, cols).join(F.broadcast(counts), "position", "left").fillna(0)


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """B2: count, mean, deviation, range and quartiles per numeric column.

    Exact quartiles cost one shuffle of the distinct values; ``exact=False`` takes them
    from sketches of fixed size.
    """
    cols = list(cols or numeric_columns(df))
    v = F.col("value")
    parts = {"n": F.count(v), "mean": F.avg(v), "stddev": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
    cells = long_values(df, cols, "double").where(~F.isnan(v))
    found = cells.groupBy("column_name").agg(*[part.alias(name) for name, part in parts.items()])
    if exact:
        wide = exact_quantiles(df, cols, list(QUANTILES.values())).groupBy("column_name").agg(
            *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(q) for q, p in QUANTILES.items()]
        )
    else:
        wide = sketched_quantiles(cells, list(QUANTILES.values()))
        wide = wide.select("column_name", *[F.get("quantiles", F.lit(j)).alias(q) for j, q in enumerate(QUANTILES)])
    # both sides hold one row per column
    found = found.join(F.broadcast(wide), "column_name", "left")
    summary = names_of(df, cols).join(F.broadcast(found), "column_name", "left").fillna(0, ["n"])
    return summary.select("column_name", "n", "mean", "stddev", "min", *QUANTILES, "max")


def null_profile(
    df: DataFrame, tokens: Sequence[str] = MASK_TOKENS, cols: Sequence[str] | None = None
) -> DataFrame:
    """Null, empty and masked counts per column, and the share of all three."""
    missing = F.col("n_null") + F.col("n_empty") + F.col("n_masked")
    return column_counts(df, cols, tokens, shapes=False).select(
        "column_name",
        "n_rows",
        "n_null",
        "n_empty",
        "n_masked",
        share(missing, F.col("n_rows")).alias("missing_share"),
    )


def masked_nulls(df: DataFrame, tokens: Sequence[str] = MASK_TOKENS) -> DataFrame:
    """Text columns in which a token stands for null, with a count per token."""
    cols = [c for c in df.columns if X.is_string(df, c)]
    found = (
        long_values(df, cols)
        .select("column_name", X.trimmed(F.col("value")).alias("token"))
        .where(F.col("token").isin(*tokens))
        .groupBy("column_name", "token")
        .agg(F.count("*").alias("n"))
    )
    return found.withColumn("share", share(F.col("n"), df.agg(F.count("*")).scalar()))


def type_profile(
    df: DataFrame, cols: Sequence[str] | None = None, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """How many values of each column look like numbers, dates, text or nothing."""
    return column_counts(df, cols, formats=formats).select(
        "column_name", "n_null", "n_empty", "n_numeric", "n_date", "n_string"
    )


def histogram(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins between the least and greatest value of each column."""
    spans = df.agg(
        F.struct(
            *[F.min(X.present(df, c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
            *[F.max(X.present(df, c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
        )
    ).scalar()
    cells = []
    for i, c in enumerate(cols):
        v, lo, hi = X.present(df, c).cast("double"), spans[f"lo{i}"], spans[f"hi{i}"]
        # the greatest value belongs to the last bin, a single-valued column has one bin
        bin_ = F.when(lo == hi, F.lit(1)).otherwise(F.least(F.width_bucket(v, lo, hi, F.lit(bins)), F.lit(bins)))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.when(v.isNotNull(), bin_).cast("int").alias("bin"),
                lo.alias("lo"),
                hi.alias("hi"),
            )
        )
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("bin").isNotNull())
        .groupBy("column_name", "bin", "lo", "hi")
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return counts.select(
        "column_name",
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("lower"),
        (F.col("lo") + width * F.col("bin")).alias("upper"),
        "n",
    )


def top_values(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values per column, ties in value order."""
    return top_per_group(value_counts(df, cols), ["column_name"], [F.desc("n"), F.asc("value")], k)


def cardinality(
    df: DataFrame, cols: Sequence[str], exact: bool = True, high: int = 100
) -> DataFrame:
    """Distinct values per column, flagged above ``high``."""
    if exact:
        found = value_counts(df, cols).groupBy("column_name").agg(F.count("*").alias("n_distinct"))
        found = names_of(df, cols).join(F.broadcast(found), "column_name", "left")
        found = found.select("column_name", "n_distinct").fillna(0, ["n_distinct"])
    else:
        counts = df.agg(
            *[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(cols)]
        )
        found = rows_of(
            counts,
            [{"column_name": F.lit(c), "n_distinct": F.col(f"d{i}")} for i, c in enumerate(cols)],
        )
    return found.withColumn("is_high", F.col("n_distinct") > high)


def date_formats(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Number of values in each date format, with ``missing`` and ``other``."""
    return df.groupBy(X.matched_format(col(name), formats).alias("format")).agg(
        F.count("*").alias("n")
    )


def spelling_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, folded, n_variants, n): spellings per folded value."""
    return (
        value_counts(df, cols)
        .groupBy("column_name", X.folded(F.col("value")).alias("folded"))
        .agg(F.count("*").alias("n_variants"), F.sum("n").alias("n"))
    )


def case_variants(df: DataFrame, name: str) -> DataFrame:
    """Values that differ only in case or outer blanks, one row per spelling.

    Spellings stay rows, as one folded value may have any number of them.
    """
    spelled = value_counts(df, [name]).select(
        X.folded(F.col("value")).alias("folded"), F.col("value").alias("variant"), "n"
    )
    groups = spelled.groupBy("folded").agg(F.count("*").alias("n_variants"))
    return spelled.join(groups.where(F.col("n_variants") > 1), "folded").select(
        "folded", "variant", "n", "n_variants"
    )


def cryptic_names(
    spark: SparkSession, header: Sequence[str], pattern: str = r"^[A-Za-z]_?\d+$"
) -> DataFrame:
    """Column names, flagged where they say nothing (``X1``, ``X2``, ...)."""
    names = spark.createDataFrame(
        [(i, n) for i, n in enumerate(header)], "position int, column_name string"
    )
    return names.withColumn("is_cryptic", F.col("column_name").rlike(pattern))


def flag_sensitive(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Mark columns as sensitive in their metadata."""
    for name in declared:
        df = df.withMetadata(name, {**df.schema[name].metadata, "sensitive": True})
    return df


def sensitive_columns(
    df: DataFrame, declared: Sequence[str] = (), names: Sequence[str] = SENSITIVE_NAMES
) -> DataFrame:
    """Which columns are sensitive, and whether metadata, the caller or the name says so."""
    wanted = {n.lower() for n in names}
    rows = []
    for position, f in enumerate(df.schema):
        if f.metadata.get("sensitive"):
            source = "metadata"
        elif f.name in declared:
            source = "declared"
        elif f.name.lower() in wanted:
            source = "name"
        else:
            source = None
        rows.append((position, f.name, source is not None, source))
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, sensitive boolean, flagged_by string"
    )


@dataclass(frozen=True)
class ProfileRules:
    """What counts as an issue in ``quality_issues``."""

    tokens: Sequence[str] = MASK_TOKENS
    formats: Sequence[str] = DATE_FORMATS
    date_columns: Sequence[str] = ()
    categories: Sequence[str] = ()
    high_cardinality: int = 100


def quality_issues(df: DataFrame, rules: ProfileRules = ProfileRules()) -> DataFrame:
    """One row per column and kind of issue, with the number and share of its rows.

    Two scans whatever the number of columns: one for all cell counts, one for the
    values of the categories.
    """
    counts = column_counts(
        df, df.columns, rules.tokens, rules.formats, date_columns=rules.date_columns
    )
    kinds = [F.col(f"n_{k}") for k in ("numeric", "date", "string")]
    seen = [F.col(f"n_fmt_{j}") for j in range(len(rules.formats))]
    issues = {
        "null": F.col("n_null"),
        "empty": F.col("n_empty"),
        "masked_null": F.col("n_masked"),
        # values outside the column's main class, and dates outside its main format
        "mixed_types": X.added(kinds) - F.greatest(*kinds),
        "mixed_date_formats": X.added(seen) - F.array_max(F.array(*seen)),
    }
    found = rows_of(
        counts,
        [
            {
                "column_name": F.col("column_name"),
                "issue": F.lit(issue),
                "n": n.cast("bigint"),
                "share": share(n, F.col("n_rows")),
            }
            for issue, n in issues.items()
        ],
    )
    if rules.categories:
        spelled = spelling_counts(df, rules.categories).groupBy("column_name").agg(
            F.sum("n_variants").alias("n_distinct"),
            F.sum(F.when(F.col("n_variants") > 1, F.col("n")).otherwise(0)).alias("n_mixed"),
            F.sum("n").alias("n_values"),
        )
        total = df.agg(F.count("*")).scalar()
        of_categories = spelled.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("column_name"),
                        F.lit("high_cardinality").alias("issue"),
                        F.when(F.col("n_distinct") > rules.high_cardinality, F.col("n_values"))
                        .otherwise(0)
                        .alias("n"),
                    ),
                    F.struct(F.col("column_name"), F.lit("mixed_casing").alias("issue"), F.col("n_mixed").alias("n")),
                )
            )
        ).withColumn("share", share(F.col("n"), total))
        found = found.unionByName(of_categories)
    return found.where(F.col("n") > 0)


def column_profile(df: DataFrame, rules: ProfileRules = ProfileRules()) -> DataFrame:
    """One row per column for planning: type, nulls, distinct values, length, sensitivity."""
    cols = df.columns
    nulls = null_profile(df, rules.tokens)
    cells = F.array(
        *[
            F.struct(
                (F.length(col(c)) if X.is_string(df, c) else F.lit(None)).cast("int").alias("length"),
                F.when(X.present(df, c).isNotNull(), F.xxhash64(col(c))).alias("hash"),
            )
            for c in cols
        ]
    )
    # equal values shrink to one row before the shuffle, so that distinct values are counted exactly
    found = (
        df.select(F.posexplode(cells).alias("position", "cell"))
        .groupBy("position", "cell.hash")
        .agg(F.count("*").alias("n"), F.max("cell.length").alias("length"))
        .groupBy("position")
        .agg(
            F.try_divide(F.sum(F.col("n") * F.col("length")), F.sum(F.when(F.col("length").isNotNull(), F.col("n")))).alias("mean_length"),
            F.count("hash").alias("n_distinct"),
        )
    )
    types = F.create_map(*[F.lit(p) for f in df.schema for p in (f.name, f.dataType.simpleString())])
    flags = sensitive_columns(df).select("column_name", "sensitive")
    # all of them hold one row per column
    return (
        names_of(df, cols)
        .withColumn("data_type", F.try_element_at(types, F.col("column_name")))
        .join(F.broadcast(found), "position", "left")
        .join(F.broadcast(nulls), "column_name")
        .join(F.broadcast(flags), "column_name")
        .fillna(0, ["n_distinct"])
        .drop("position")
    )
