"""Contract checks and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.functions.expressions import DATE_FORMATS, MALFORMED, col
from proofline.functions.longform import rows_of
from proofline.functions.lookups import fits_broadcast, join_unique, lookup_join
from proofline.operators.profile import column_counts, null_profile, share, spelling_counts
from proofline.session import materialize

# The wording of the verdict that users of the contract rely on.
BLOCK_PREFIX = "Handoff contract violations: "
DUPLICATE_MESSAGE = "Duplicate column names: "
MIXED_MESSAGE = "Column '{}' has mixed types ({})"
PASSED_REASON = "All handoff contract checks passed."
JOINED_BY = "; "

CHECKS = ("structure", "row_shape", "duplicate_columns", "mixed_types", "formats", "size", "missing", "casing")


@dataclass(frozen=True)
class Contract:
    """The rules of a hand-off. Row shapes, duplicate names and mixed types are always checked.

    A column that a rule names and the table lacks is a violation of its structure. Rules of
    a name hold for every column of that name.
    """

    case_sensitive: bool = True
    patterns: Mapping[str, str] = field(default_factory=dict)
    date_columns: Sequence[str] = ()
    formats: Sequence[str] = DATE_FORMATS
    rows: tuple[int | None, int | None] = (None, None)
    columns: tuple[int | None, int | None] = (None, None)
    max_missing: float | None = None
    tokens: Sequence[str] = ()
    categories: Sequence[str] = ()
    warn: Sequence[str] = ()
    # columns that must be there, with the type that their values must have (None: any)
    required: Mapping[str, str | None] = field(default_factory=dict)

    def named(self) -> list[str]:
        """The columns that some rule names."""
        return list(dict.fromkeys([*self.required, *self.patterns, *self.date_columns, *self.categories]))

    def active(self) -> list[str]:
        on = {
            "structure": bool(self.named()),
            "formats": bool(self.patterns or self.date_columns),
            "size": any(b is not None for b in (*self.rows, *self.columns)),
            "missing": self.max_missing is not None,
            "casing": bool(self.categories),
        }
        return [c for c in CHECKS if on.get(c, True)]


class ContractBlocked(Exception):
    """Raised by ``enforce`` so that nothing downstream runs."""


def check_duplicate_columns(
    spark: SparkSession, header: Sequence[str], case_sensitive: bool = True
) -> DataFrame:
    """Names that occur more than once, with their positions."""
    names = spark.createDataFrame(
        [(i, n, n if case_sensitive else n.lower()) for i, n in enumerate(header)],
        "position int, column_name string, name_key string",
    )
    return (
        names.groupBy("name_key")
        .agg(
            F.min_by("column_name", "position").alias("column_name"),
            F.count("*").alias("n_columns"),
            F.min("position").alias("first_position"),
            F.array_join(F.sort_array(F.collect_list("position")).cast("array<string>"), ",").alias(
                "positions"
            ),
        )
        .where(F.col("n_columns") > 1)
        .drop("name_key")
    )


def _pooled(counts: DataFrame, header: Sequence[str]) -> DataFrame:
    """Counts per name in header order; columns that share a name are added up."""
    names = F.array(*[F.lit(n) for n in header])
    sums = [F.sum(c).alias(c) for c in counts.columns if c.startswith("n_") and c != "n_rows"]
    return (
        counts.withColumn("column_name", F.get(names, F.col("position")))
        .groupBy("column_name")
        .agg(
            F.min("position").alias("position"),
            F.max("n_rows").alias("n_rows"),
            F.sum("n_rows").alias("n_cells"),
            *sums,
        )
    )


def _listed(parts: Mapping[str, Column]) -> Column:
    """The names whose count is above zero, joined by a plus sign."""
    return F.array_join(F.array_compact(F.array(*[F.when(n > 0, F.lit(k)) for k, n in parts.items()])), " + ")


def _kind_counts() -> dict[str, Column]:
    """Values per class; a quoted empty cell is text."""
    return {
        "numeric": F.col("n_numeric"),
        "date": F.col("n_date"),
        "string": F.col("n_string") + F.col("n_empty"),
    }


def check_mixed_types(
    df: DataFrame, header: Sequence[str] | None = None, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Columns that hold values of more than one class; columns of one name are pooled."""
    kinds = _kind_counts()
    return (
        _pooled(column_counts(df, formats=formats), list(header or df.columns))
        .select("column_name", *[n.alias(f"n_{k}") for k, n in kinds.items()], _listed(kinds).alias("kinds"))
        .where(F.col("kinds").contains("+"))
    )


def check_formats(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Values that do not fit their column's pattern."""
    counts = df.agg(
        *[F.count_if(~col(c).rlike(p)).alias(f"bad{i}") for i, (c, p) in enumerate(rules.items())]
    )
    entries = [
        {"column_name": F.lit(c), "pattern": F.lit(p), "n": F.col(f"bad{i}")}
        for i, (c, p) in enumerate(rules.items())
    ]
    return rows_of(counts, entries).where(F.col("n") > 0)


def _format_counts(formats: Sequence[str]) -> dict[str, Column]:
    return {**{f: F.col(f"n_fmt_{j}") for j, f in enumerate(formats)}, "other": F.col("n_fmt_other")}


def _several(text: Column) -> Column:
    """More than one date format, or none that is known."""
    return text.contains(" + ") | (text == "other")


def check_date_formats(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """C3 for dates: columns written in more than one format, or in none of them."""
    seen = _format_counts(formats)
    counts = column_counts(df, columns, formats=formats, shapes=False, date_columns=columns)
    return counts.select(
        "column_name", _listed(seen).alias("formats"), X.added(list(seen.values())).alias("n")
    ).where(_several(F.col("formats")))


def check_size(
    df: DataFrame,
    rows: tuple[int | None, int | None] = (None, None),
    columns: tuple[int | None, int | None] = (None, None),
) -> DataFrame:
    """C4: number of rows and columns against their bounds."""
    counts = df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))
    entries = [
        {
            "measure": F.lit(m),
            "value": F.col(m),
            "low": F.lit(lo).cast("bigint"),
            "high": F.lit(hi).cast("bigint"),
            "ok": _within(F.col(m), (lo, hi)),
        }
        for m, (lo, hi) in {"rows": rows, "columns": columns}.items()
    ]
    return rows_of(counts, entries)


def _within(c: Column, bounds: tuple[int | None, int | None]) -> Column:
    lo, hi = bounds
    low = F.lit(True) if lo is None else c >= lo
    high = F.lit(True) if hi is None else c <= hi
    return low & high


def check_missing(df: DataFrame, max_share: float, tokens: Sequence[str] = ()) -> DataFrame:
    """Columns whose missing share is above the limit."""
    missing = F.col("n_null") + F.col("n_empty") + F.col("n_masked")
    return (
        null_profile(df, tokens)
        .where(F.col("missing_share") > max_share)
        .select("column_name", missing.alias("n_missing"), "missing_share")
    )


def check_casing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Category columns in which one value is written in several ways."""
    return (
        spelling_counts(df, cols)
        .where(F.col("n_variants") > 1)
        .groupBy("column_name")
        .agg(
            F.count("*").alias("n_values"),
            F.sum("n_variants").alias("n_spellings"),
            F.sum("n").alias("n_rows"),
        )
    )


def run_contract(df: DataFrame, contract: Contract = Contract(), header: Sequence[str] | None = None) -> DataFrame:
    """All checks of a contract as one table of violations.

    One scan serves every rule but casing, which needs a shuffle of the distinct
    category values.
    """
    cells = [c for c in df.columns if c != MALFORMED]
    header = list(header or cells)
    # rules of a name look at all of its columns
    at: dict[str, list[str]] = {}
    for name, c in zip(header, cells):
        at.setdefault(name, []).append(c)
    counts = column_counts(
        df,
        cells,
        contract.tokens,
        contract.formats,
        patterns={c: p for n, p in contract.patterns.items() for c in at.get(n, [])},
        date_columns=[c for n in contract.date_columns for c in at.get(n, [])],
        typed={c: t for n, t in contract.required.items() if t for c in at.get(n, [])},
        malformed=MALFORMED if MALFORMED in df.columns else None,
    )
    per_name = _pooled(counts, header)
    column = F.concat(F.lit("Column '"), F.col("column_name"), F.lit("'"))

    def entry(check: str, n: Column, bad: Column, message: Column, of_table: bool = False) -> dict[str, Column]:
        return {
            "seq": F.lit(CHECKS.index(check)),
            "check": F.lit(check),
            "column_name": F.lit(None).cast("string") if of_table else F.col("column_name"),
            "n": n.cast("bigint"),
            "severity": F.lit("warn" if check in contract.warn else "block"),
            "message": F.when(bad, message),
        }

    kinds = _kind_counts()
    kinds_text = _listed(kinds)
    before, after = MIXED_MESSAGE.split("{}", 1)
    opened, closed = after.split("{}")
    mixed = F.concat(F.lit(before), F.col("column_name"), F.lit(opened), kinds_text, F.lit(closed))
    entries = [entry("mixed_types", X.added(list(kinds.values())), kinds_text.contains("+"), mixed)]
    wanted = {n: t for n, t in contract.required.items() if t}
    if wanted:
        types = F.create_map(*[F.lit(part) for item in wanted.items() for part in item])
        off = F.concat(column, F.lit(" has "), F.col("n_untyped"), F.lit(" values that are no "), F.try_element_at(types, F.col("column_name")))
        entries.append(entry("structure", F.col("n_untyped"), F.col("n_untyped") > 0, off))
    if MALFORMED in df.columns:
        ragged = F.concat(F.lit("Table has "), F.col("n_malformed"), F.lit(" rows with too few or too many cells"))
        shown = (F.col("position") == 0) & (F.col("n_malformed") > 0)
        entries.append(entry("row_shape", F.col("n_malformed"), shown, ragged, of_table=True))
    if contract.patterns:
        pairs = F.create_map(*[F.lit(part) for item in contract.patterns.items() for part in item])
        pattern = F.try_element_at(pairs, F.col("column_name"))
        off = F.concat(column, F.lit(" has "), F.col("n_bad"), F.lit(" values that do not match "), pattern)
        entries.append(entry("formats", F.col("n_bad"), F.col("n_bad") > 0, off))
    if contract.date_columns:
        seen = _format_counts(contract.formats)
        text = _listed(seen)
        several = F.concat(column, F.lit(" has dates in the formats "), text)
        entries.append(entry("formats", X.added(list(seen.values())), _several(text), several))
    if contract.max_missing is not None:
        n = F.col("n_null") + F.col("n_empty") + F.col("n_masked")
        too_many = share(n, F.col("n_cells")) > contract.max_missing
        entries.append(entry("missing", n, too_many, F.concat(column, F.lit(" has "), n, F.lit(" missing values"))))
    # the size is told once, with the first column
    for measure, value, bounds in (
        ("rows", F.col("n_rows"), contract.rows),
        ("columns", F.lit(len(header)).cast("bigint"), contract.columns),
    ):
        outside = (F.col("position") == 0) & ~_within(value, bounds)
        message = F.concat(F.lit("Table has "), value, F.lit(f" {measure}"))
        entries.append(entry("size", value, outside, message, of_table=True))
    found = rows_of(per_name, entries)

    lacking = [n for n in contract.named() if n not in at]
    if lacking:
        rows = [
            (CHECKS.index("structure"), "structure", n, 0, "warn" if "structure" in contract.warn else "block", f"Column '{n}' is missing")
            for n in lacking
        ]
        found = found.unionByName(
            df.sparkSession.createDataFrame(rows, "seq int, check string, column_name string, n bigint, severity string, message string")
        )
    repeated = check_duplicate_columns(df.sparkSession, header, contract.case_sensitive)
    # one row per repeated name, in the order of the header
    listed = F.array_sort(F.collect_list(F.struct("first_position", "column_name")))
    repeated = repeated.agg(F.count("*").alias("n"), F.transform(listed, lambda r: r["column_name"]).alias("names"))
    told = F.concat(F.lit(DUPLICATE_MESSAGE), X.quoted_list(F.col("names")))
    found = found.unionByName(
        repeated.select(*[c.alias(name) for name, c in entry("duplicate_columns", F.col("n"), F.col("n") > 0, told, of_table=True).items()])
    )
    categories = [c for n in contract.categories for c in at.get(n, [])]
    if categories:
        names = F.create_map(*[F.lit(part) for n in contract.categories for c in at.get(n, []) for part in (c, n)])
        casing = check_casing(df, categories).withColumn("column_name", F.element_at(names, F.col("column_name")))
        casing = casing.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows")).select(
            *[
                c.alias(name)
                for name, c in entry(
                    "casing", F.col("n_rows"), F.lit(True), F.concat(column, F.lit(" has inconsistent casing"))
                ).items()
            ]
        )
        found = found.unionByName(casing)
    return found.where(F.col("message").isNotNull())


def gate(violations: DataFrame) -> DataFrame:
    """One row with the decision and one reason that joins all messages."""
    messages = F.expr(f"listagg(message, '{JOINED_BY}') within group (order by seq, column_name)")
    totals = violations.agg(
        F.count_if(F.col("severity") == "block").alias("blocking"),
        F.count("*").alias("found"),
        messages.alias("messages"),
    )
    return totals.select(
        F.when(F.col("blocking") > 0, "block")
        .when(F.col("found") > 0, "warn")
        .otherwise("allow")
        .alias("decision"),
        F.when(F.col("found") > 0, F.concat(F.lit(BLOCK_PREFIX), F.col("messages")))
        .otherwise(PASSED_REASON)
        .alias("reason"),
    )


def enforce(verdict: DataFrame) -> str:
    """Raise on ``block``, else return the decision. The verdict is one row."""
    row = verdict.first()
    if row["decision"] == "block":
        raise ContractBlocked(row["reason"])
    return row["decision"]


def failed_rules(rules: Mapping[str, Column | str]) -> Column:
    """Names of the rules that a row breaks, joined by commas; a NULL outcome breaks a rule."""
    broken = []
    for name, rule in rules.items():
        holds = F.expr(rule) if isinstance(rule, str) else rule
        broken.append(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)))
    return F.array_join(F.array_compact(F.array(*broken)), ",")


def split_valid(df: DataFrame, rules: Mapping[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and rows that do not with the rules they break."""
    marked = df.withColumn("failed_rules", failed_rules(rules))
    ok = marked.where(F.col("failed_rules") == "").drop("failed_rules")
    return ok, marked.where(F.col("failed_rules") != "")


def unresolved_refs(
    docs: DataFrame, key: str, text: str, pattern: str, index: DataFrame, ref: str
) -> DataFrame:
    """Citations in the text that no artifact of the index answers.

    A small index is broadcast, after it was kept as a table and measured. For a large one the citations, counted per document,
    are kept as a table before the join, so the texts are read once and a much cited
    artifact is spread as a hot key.
    """
    cited = docs.select(
        col(key), F.explode(F.regexp_extract_all(col(text), F.lit(pattern), F.lit(1))).alias("ref")
    )
    known = materialize(index.select(col(ref).alias("ref")).where(F.col("ref").isNotNull()).distinct())
    small = fits_broadcast(known)
    if small:
        cited = cited.join(F.broadcast(known), "ref", "left_anti")
    cited = cited.groupBy(key, "ref").agg(F.count("*").alias("n"))
    if not small:
        found = join_unique(materialize(cited), known.withColumn("_known", F.lit(True)), ["ref"])
        cited = found.where(F.col("_known").isNull())
    return cited.select(key, "ref", "n")


def check_json_keys(
    df: DataFrame, key: str, type_col: str, json_col: str, required: Mapping[str, Sequence[str]]
) -> DataFrame:
    """C11: rows whose JSON is not a valid object, lacks a required top-level key, or has a type that no rule knows."""
    rules = df.sparkSession.createDataFrame(
        [(t, list(keys)) for t, keys in required.items()], "__type string, wanted array<string>"
    )
    staged = lookup_join(df.withColumn("__type", col(type_col)), rules, ["__type"]).select(
        col(key), col(type_col), F.json_object_keys(col(json_col)).alias("found"), "wanted"
    )
    missing = F.array_join(F.array_except(F.col("wanted"), F.col("found")), ",")
    status = (
        F.when(F.col("found").isNull(), "invalid")
        .when(F.col("wanted").isNull(), "unknown_type")
        .when(missing != "", "missing_keys")
    )
    return staged.select(
        key, type_col, status.alias("status"), F.when(status == "missing_keys", missing).alias("missing")
    ).where(F.col("status").isNotNull())


def check_required(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Records that lack a required field, with the names of the fields."""
    absent = F.array_compact(F.array(*[F.when(col(c).isNull(), F.lit(c)) for c in cols]))
    return df.select(col(key), F.array_join(absent, ",").alias("missing")).where(
        F.col("missing") != ""
    )


def canonical_diff(df: DataFrame, bank: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Records that are changed, missing, extra or repeated against a canonical bank.

    Both sides shrink to one row per key before the join, so copies never meet as pairs.
    """

    def digests(side: DataFrame, suffix: str) -> DataFrame:
        # to_json keeps NULL apart from an empty string and shows where a field ends
        record = F.to_json(F.struct(*[col(c).alias(c) for c in cols]), {"ignoreNullFields": "false"})
        digest = F.sha2(record, 256)
        return (
            side.select(col(key), digest.alias("digest"))
            .groupBy(key)
            .agg(
                F.count("*").alias(f"n_{suffix}"),
                F.min("digest").alias(f"min_{suffix}"),
                F.max("digest").alias(f"max_{suffix}"),
            )
        )

    both = digests(df, "found").join(digests(bank, "bank"), key, "full_outer")
    same = F.col("min_found").eqNullSafe(F.col("min_bank")) & F.col("max_found").eqNullSafe(
        F.col("max_bank")
    )
    status = (
        F.when(F.col("n_found").isNull(), "missing")
        .when(F.col("n_bank").isNull(), "extra")
        .when(~same, "changed")
        .when(F.col("n_found") != F.col("n_bank"), "repeated")
    )
    return both.select(
        key,
        status.alias("status"),
        F.coalesce("n_found", F.lit(0)).alias("n_found"),
        F.coalesce("n_bank", F.lit(0)).alias("n_bank"),
    ).where(F.col("status").isNotNull())


def missing_outputs(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """C14: expected outputs (name) that are absent or empty among (name, length)."""
    sizes = actual.groupBy("name").agg(F.max("length").alias("length"))
    status = F.when(F.col("length").isNull(), "absent").when(F.col("length") == 0, "empty")
    return (
        expected.select("name")
        .distinct()
        .join(sizes, "name", "left")
        .select("name", status.alias("status"))
        .where(F.col("status").isNotNull())
    )


def missing_sections(docs: DataFrame, key: str, text: str, required: Sequence[str]) -> DataFrame:
    """One row per document and required heading that its text lacks."""
    absent = F.array(*[F.when(~F.coalesce(col(text), F.lit("")).contains(s), F.lit(s)) for s in required])
    return docs.select(col(key), F.explode(F.array_compact(absent)).alias("section"))


def jargon_hits(docs: DataFrame, key: str, text: str, terms: DataFrame | Sequence[str]) -> DataFrame:
    """Listed terms used in each text, with counts. Terms may be phrases.

    Listed words are picked before any row is exploded. A list given as a table with a
    ``term`` column is broadcast if it is small, else joined to the counted words.
    """
    words = F.col("words")
    staged = docs.select(col(key), X.tokens_of(col(text)).alias("words"))
    if isinstance(terms, DataFrame):
        term = X.tokens_of(F.col("term"))
        known = terms.select(F.array_join(term, " ").alias("term"), term[0].alias("first"), F.size(term).alias("n"))
        known = materialize(known.where(F.col("n") > 0).distinct())
        # phrase lengths by first word: only phrases that can be listed are built
        begins = materialize(known.groupBy("first").agg(F.collect_set("n").alias("lengths")))
        spelled = staged.select(key, "words", F.posexplode("words").alias("at", "first")).where(F.col("first") != "")
        starts = lookup_join(spelled.select(key, "first", F.slice("words", F.col("at") + 1, F.lit(_longest(known))).alias("rest")), begins, ["first"], "inner")
        fits = F.filter("lengths", lambda n: n <= F.size("rest"))
        grams = F.transform(fits, lambda n: F.array_join(F.slice("rest", F.lit(1), n), " "))
        used = starts.select(key, F.explode(grams).alias("term"))
        small = fits_broadcast(known)
        if small:
            used = used.join(F.broadcast(known.select("term")), "term", "left_semi")
        hits = used.groupBy(key, "term").agg(F.count("*").alias("n"))
        if not small:
            hits = join_unique(materialize(hits), known.select("term"), ["term"], "inner")
    else:
        listed = sorted({tuple(X.words_of(t)) for t in terms} - {()})
        grams = [
            _listed_grams(words, [t for t in listed if len(t) == n]) for n in sorted({len(t) for t in listed})
        ]
        used = staged.select(key, F.explode(F.flatten(F.array(*grams))).alias("term"))
        hits = used.groupBy(key, "term").agg(F.count("*").alias("n"))
    return hits.select(key, "term", "n")


def _listed_grams(words: Column, listed: Sequence[tuple[str, ...]]) -> Column:
    """The listed phrases of one length, joined up only where their first word stands."""
    n = len(listed[0])
    if n == 1:
        return F.filter(words, lambda w: w.isin(*[t[0] for t in listed]))
    phrases = [" ".join(t) for t in listed]
    begins = sorted({t[0] for t in listed})
    joined = F.transform(
        words, lambda w, i: F.when(w.isin(*begins), F.array_join(F.slice(words, i + 1, F.lit(n)), " "))
    )
    return F.filter(joined, lambda g: g.isin(*phrases))


def _longest(known: DataFrame) -> int:
    """Words of the longest listed phrase."""
    return known.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]


# the shapes of the other checks: check name, column that says what is wrong, columns that say where
VIOLATION_SHAPES = {
    "unresolved_refs": ("'unresolved reference'", "ref"),
    "json_keys": ("status", "missing"),
    "required": ("'missing fields'", "missing"),
    "canonical_diff": ("status", None),
    "missing_outputs": ("status", "name"),
    "outputs": ("concat_ws(': ', status, detail)", "name"),
    "missing_sections": ("'missing section'", "section"),
}


def as_violations(found: DataFrame, check: str, severity: str = "block", what: str | None = None, where: str | None = None) -> DataFrame:
    """The result of any check of C10 to C15 in the form that ``gate`` reads, a row for each kind of fault.

    ``what`` and ``where`` are the expressions that say what is wrong and in which name or
    field; those of the checks here are known.
    """
    known_what, known_where = VIOLATION_SHAPES.get(check, (None, None))
    what, where = what or known_what, where or known_where
    if what is None:
        raise ValueError(f"say what {check!r} finds")
    named = found.select(F.expr(what).cast("string").alias("what"), (F.expr(where) if where else F.lit(None)).cast("string").alias("column_name"))
    counted = named.groupBy("what", "column_name").agg(F.count("*").alias("n"))
    place = F.when(F.col("column_name").isNotNull(), F.concat(F.lit(" '"), "column_name", F.lit("'"))).otherwise("")
    return counted.select(
        F.lit(len(CHECKS)).alias("seq"),
        F.lit(check).alias("check"),
        "column_name",
        "n",
        F.lit(severity).alias("severity"),
        F.concat("what", place, F.lit(" ("), "n", F.lit(")")).alias("message"),
    )
