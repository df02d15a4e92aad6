"""Secrets in texts, and weak candidates that complementary parts confirm.

Some parts of a credential can be told on their own: an assignment to a key word, an access
identifier, a long hexadecimal string. Others are weak: a user name, a random-looking
token or an address mean nothing alone. Weak parts are reported only if an interval join
finds what completes them in the same document within the scope:

- ``weak_id``: a client or user name near a secret of any kind,
- ``weak_secret``: a random-looking token near an identifier of any kind,
- ``weak_endpoint``: an address near both an identifier and a secret.

Everything is DataFrame expressions. Texts are scanned in place; only weak parts of
documents that hold complementary ones are shuffled, without their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.expressions import free_names
from proofline.llm import tables

# code points between the starts of two parts of one credential
SCOPE = 200

# kinds that have an exact definition: pattern, group whose length counts, least length
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # of the maximal runs only those of the least length are looked for, which finds the same
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
WEAK = {
    "weak_id": (r"""(?i:\b(client_?id|access_?id|user_?name|user|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]+)""", 2, 3),
    "weak_secret": (r"[A-Za-z0-9+/_-]{20,}", 0, 20),
    "weak_endpoint": (r"\b[a-z][a-z0-9+.-]*://[A-Za-z0-9._:-]+", 0, 8),
}
KINDS = [*BASE, *WEAK]
_SPANS = "array<struct<start: int, rank: int, kind: string, end: int>>"
# code points of the blocks that a text is cut into before parts of it are taken
BLOCK = 1024


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``values`` combined along the array: place i holds the values 0 to i taken together.

    Each round reaches twice as far back as the one before, so the work is n log n; an array
    that grows by one item a step would be copied in every step.
    """
    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    reaches = F.transform(F.sequence(F.lit(0), rounds), lambda k: F.pow(F.lit(2), k).cast("int"))

    def longer(state: Column, reach: Column) -> Column:
        return F.transform(state, lambda v, i: F.when(i >= reach, combine(v, F.get(state, i - reach))).otherwise(v))

    return F.aggregate(reaches, values, longer)


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """The leftmost matches that do not overlap, as spans; those that are too short are dropped.

    A text is the gaps between the matches and the matches in turn, so the lengths of both
    give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def counted(match: Column) -> Column:
        value = F.regexp_extract(match, pattern, group) if group else match
        # a weak secret is told by its looks
        return F.when(_random_looking(value), F.length(value)).otherwise(0) if kind == "weak_secret" else F.length(value)

    def placed(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda p: p["gap"] + F.coalesce(p["size"], F.lit(0))), lambda a, b: a + b)
        spans = F.zip_with(
            parts,
            ends,
            lambda p, end: F.struct(
                (end - p["size"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), p["counted"].alias("counted")
            ),
        )
        # the last gap has no match behind it
        long_enough = F.filter(spans, lambda s: F.coalesce(s["counted"] >= least, F.lit(False)))
        return F.transform(long_enough, lambda s: s.dropFields("counted"))

    parts = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(found, F.length).alias("size"), F.transform(found, counted).alias("counted"))
    none = F.array().cast(_SPANS)
    return F.when(F.size(found) > 0, _let(parts, placed).cast(_SPANS)).otherwise(none)


def _random_looking(value: Column) -> Column:
    """Whether a token mixes digits with letters of either case."""
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def _clear_of(weak: Column, base: Column) -> Column:
    """The spans of ``weak`` that share no place with one of ``base``.

    Both are sorted together, base spans by their start and weak ones by their end, so the
    base spans before a weak one are those that start ahead of its end; it is clear if
    none of them reaches beyond its start.
    """
    # what ends at a start comes before it
    ends = F.transform(weak, lambda w: F.struct(w["end"].alias("at"), F.lit(0).alias("side"), F.lit(0).alias("reach"), w.alias("span")))
    starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("side"), b["end"].alias("reach"), b.alias("span")))

    def swept(events: Column) -> Column:
        reach = _running(F.transform(events, lambda e: e["reach"]), F.greatest)
        with_reach = F.zip_with(events, reach, lambda e, r: F.struct(e["side"].alias("side"), e["span"].alias("span"), r.alias("reach")))
        clear = F.filter(with_reach, lambda e: (e["side"] == 0) & (e["reach"] <= e["span"]["start"]))
        return F.transform(clear, lambda e: e["span"])

    clear = _let(F.sort_array(F.concat(ends, starts)), swept)
    return F.when((F.size(weak) > 0) & (F.size(base) > 0), clear).otherwise(weak)


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """The rows of ``left`` with a row of ``right`` in the same document within the scope.

    An interval join: positions fall into buckets of the scope's width, a row of ``left``
    looks into its own bucket and the two beside it, and a semi join keeps it once.
    """
    buckets = F.floor(F.col("start") / scope)
    looking = left.withColumn("bucket", F.explode(F.array(buckets - 1, buckets, buckets + 1)))
    there = right.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.floor(F.col("start") / scope).alias("_bucket"))
    hit = (
        (looking["row"] == there["_row"])
        & (looking["bucket"] == there["_bucket"])
        & (F.abs(looking["start"] - there["_start"]) <= scope)
    )
    return looking.join(there, hit, "left_semi").drop("bucket").distinct()


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, key, the spans of each row (start, rank, kind, end) by start and kind, and ``row``.

    Positions are code points and ``end`` is exclusive. A null text is an empty one and has
    an empty list; null and repeated doc_ids give a row for each row; an empty table gives
    none. Other columns are not looked at. ``key`` is a hash of the text, and ``row`` numbers
    the rows of the result in no particular order.
    """
    named = tables.texts(docs)
    text = F.col("text")
    base = F.concat(*[_spans(text, kind, *rule) for kind, rule in BASE.items()])
    weak = F.concat(*[_spans(text, kind, *rule) for kind, rule in WEAK.items()])
    scanned = named.select("doc_id", F.xxhash64("text").alias("key"), base.alias("base"), weak.alias("weak"))
    # what a stronger span covers already is no candidate
    fresh = _clear_of(F.col("weak"), F.col("base")).alias("weak")
    scanned = tables.stored(scanned.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "base", fresh), "secrets")
    parts = scanned.where(F.size("weak") > 0).select("row", F.inline(F.concat("base", "weak")))
    identifiers = parts.where(F.col("kind").isin("access", "weak_id"))
    keys = parts.where(F.col("kind").isin("assign", "hex", "weak_secret"))
    linked = (
        _near(parts.where(F.col("kind") == "weak_id"), keys, scope)
        .unionByName(_near(parts.where(F.col("kind") == "weak_secret"), identifiers, scope))
        .unionByName(_near(_near(parts.where(F.col("kind") == "weak_endpoint"), identifiers, scope), keys, scope))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("linked"))
    )
    spans = F.when(F.col("linked").isNull(), F.col("base")).otherwise(F.concat("base", "linked"))
    return scanned.join(linked, "row", "left").select("row", "doc_id", "key", F.array_sort(spans).alias("spans"))


def redacted(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with ``[kind]`` in place of every span of its texts; spans that overlap become one.

    All rows and columns are kept, and a text without spans stays as it is.
    """
    found = secrets(docs, scope).where(F.size("spans") > 0)
    # rows that share doc_id and text have the same spans
    found = found.groupBy("doc_id", "key").agg(F.first("spans").alias("spans"))
    doc_id, key, spans = free_names(docs, ["found_doc_id", "found_key", "found_spans"])
    found = found.toDF(doc_id, key, spans)
    hashed = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc_id)) & (hashed == F.col(key))
    text = docs["text"].cast("string")

    # a part of a text is taken from its blocks, as finding a place in a text takes time with the place
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def made_of(blocks: Column) -> Column:
        def part(begin: Column, end: Column) -> Column:
            first, last = F.floor(begin / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
            own = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.when(end > begin, F.substr(own, begin % BLOCK + 1, end - begin)).otherwise("")

        reach = _running(F.transform(spans, lambda s: s["end"]), F.greatest)

        def pieces(reach: Column) -> Column:
            def piece(span: Column, i: Column) -> Column:
                before = F.coalesce(F.get(reach, i - 1), F.lit(0))
                fresh = F.concat(part(before, span["start"]), F.lit("["), span["kind"], F.lit("]"))
                return F.when(span["start"] >= before, fresh).otherwise("")

            rest = part(F.element_at(reach, -1), F.length(text))
            return F.concat(F.array_join(F.transform(F.col(spans), piece), ""), rest)

        return _let(reach, pieces)

    made = _let(blocks, made_of)
    joined = docs.join(found, same, "left")
    return joined.withColumn("text", F.when(F.col(spans).isNotNull(), made).otherwise(text)).select(*docs.columns)
