"""Collocations: phrases that occur often for how often their parts do, by suffix subtrees.

Words are counted first, in each language. Every place in a piece of text then starts a suffix
of up to three words. Suffixes are grouped by their first two words, and by a part of the
third as well where both of these are so frequent that one group might not hold them, so that a
group's rows keep to a budget. In each group the suffixes are sorted by their prefix, which
is the suffix tree cut at depth three, walked from left to right: the count of a phrase is the
total of the leaves below it. Groups do not need each other; phrases of a split prefix have
a partial count from each and are summed.

Copies of a suffix are counted before they are shuffled, and words that are too rare to be in a
candidate cut a piece, as no phrase across them can be one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.functions.lookups import lookup_join
from proofline.functions.ordered import top_per_group
from proofline.llm import tables

# places of words that a group may hold: the budget of a subtree
GROUP_PLACES = 2_000_000
# words whose pairs are split over groups, at most, and the parts of a third word they are split by
SPLIT_WORDS, SPLIT_PARTS = 500, 8
# different suffixes that a task counts before it hands them on
HELD = 400_000
# bits of the filter of frequent words; when it is full it only saves less
FILTER_BITS = 1 << 24
ROWS = 50_000

_UPPER, _STOPS = bytes(range(65, 91)), b".,;:!?\x0b\x0c\r"
SIGNS = bytes.maketrans(_UPPER + _STOPS, _UPPER.lower() + b"\n" * len(_STOPS))


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece, A-Z lower-cased."""
    for piece in text.translate(SIGNS).split(b"\n"):
        # only blanks and tabs are left of what split() splits at
        words = piece.split()
        if words:
            yield words


class _Counts:
    """Counts by language while they are gathered, handed on before they grow large."""

    def __init__(self, most: int) -> None:
        self.by: dict[str, Counter] = {}
        self.most = most

    def of(self, lang: str) -> Counter:
        return self.by.setdefault(lang, Counter())

    def full(self) -> bool:
        return sum(map(len, self.by.values())) > self.most

    def chunks(self) -> Iterator[tuple[str, list[bytes], list[int]]]:
        for lang, counts in self.by.items():
            phrases, n = list(counts), list(counts.values())
            for i in range(0, len(n), ROWS):
                yield lang, phrases[i : i + ROWS], n[i : i + ROWS]
        self.by = {}


def _counted(held: _Counts) -> Iterator[pa.RecordBatch]:
    for lang, phrases, n in held.chunks():
        row = [pa.array([lang] * len(n)), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
        yield pa.RecordBatch.from_arrays(row, ["lang", "phrase", "n"])


def _words(most: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts(most)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                # single words need no pieces: where these end, words end as well
                held.of(lang).update(text.translate(SIGNS).split())
                if held.full():
                    yield from _counted(held)
        yield from _counted(held)

    return scan


class _Frequent:
    """May a word be frequent? Hashes as Spark's xxhash64 makes them of (language, word)."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.known = bits, {}

    def of(self, lang: str):
        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        known = self.known.setdefault(lang, {})
        bits, last = self.bits, len(self.bits) * 64 - 1

        def may(word: bytes) -> bool:
            found = known.get(word)
            if found is None:
                if len(known) > HELD:
                    known.clear()
                slot = xxhash.xxh64_intdigest(word, seed) & last
                found = known[word] = bool((int(bits[slot >> 6]) >> (slot & 63)) & 1)
            return found

        return may


def _runs(words: list[bytes], may) -> Iterator[list[bytes]]:
    """The parts of a piece between words that are too rare."""
    kept = list(map(may, words))
    if all(kept):
        yield words
        return
    start = 0
    for i, keep in enumerate([*kept, False]):
        if not keep:
            if i - start > 1:
                yield words[start:i]
            start = i + 1


def _suffixes(shared, most: int):
    """(lang, pair, third, n, part): counted suffixes; third is empty at the end of a run, part -1 where a pair is whole."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, heavy = shared.value
        pairs = {lang: {b" ".join((x, y)) for x in words for y in words} for lang, words in heavy.items()}
        held, frequent = _Counts(most), _Frequent(bits)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                may, counts = frequent.of(lang), held.of(lang)
                runs = (run for words in pieces_of(text) for run in _runs(words, may) if len(run) > 1)
                counts.update(chain.from_iterable(map(b" ".join, zip(run, run[1:], [*run[2:], b""])) for run in runs))
                if held.full():
                    yield from _parted(held, pairs)
        yield from _parted(held, pairs)

    return scan


def _parted(held: _Counts, pairs: dict[str, set[bytes]]) -> Iterator[pa.RecordBatch]:
    for lang, phrases, n in held.chunks():
        pair, _, third = zip(*(p.rpartition(b" ") for p in phrases))
        split = pairs.get(lang, ())
        part = [zlib.crc32(t) % SPLIT_PARTS if p in split else -1 for p, t in zip(pair, third)] if split else [-1] * len(n)
        texts = [pa.array(x, pa.binary()).cast(pa.string()) for x in (pair, third)]
        row = [pa.array([lang] * len(n)), *texts, pa.array(n, pa.int64()), pa.array(part, pa.int32())]
        yield pa.RecordBatch.from_arrays(row, ["lang", "pair", "third", "n", "part"])


def _subtrees(least: int):
    """Phrases of two and three words in sorted suffixes: those of at least ``least``, and all pairs that are split.

    ``place`` is a hash of language and pair, by which the rows are sorted; pairs that share it
    are told apart by their words.
    """

    def nodes(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        place, n, part = (rows.column(c).to_numpy() for c in ("place", "n", "part"))
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        many = np.diff(np.append(starts, len(n)))
        live = np.flatnonzero(np.repeat(np.add.reduceat(n, starts) >= least, many) | (part >= 0))
        if not len(live):
            return
        own = rows.take(pa.array(live))
        leaves = own.group_by(["lang", "pair", "third"]).aggregate([("n", "sum"), ("part", "max")])
        pairs = leaves.group_by(["lang", "pair"]).aggregate([("n_sum", "sum"), ("part_max", "max")])
        pairs = pairs.filter((pc.field("n_sum_sum") >= least) | (pc.field("part_max_max") >= 0))
        leaves = leaves.filter((pc.field("n_sum") >= least) & (pc.field("third") != ""))
        phrases = pc.binary_join_element_wise(leaves.column("pair"), leaves.column("third"), " ")
        for words, found, phrase, count in ((2, pairs, pairs.column("pair"), "n_sum_sum"), (3, leaves, phrases, "n_sum")):
            table = pa.table([found.column("lang"), phrase, found.column(count), pa.array(np.full(len(found), words, np.int32))], ["lang", "phrase", "n", "words"])
            yield from table.combine_chunks().to_batches()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            place = now.column("place").to_numpy()
            # the last subtree may go on in the next batch
            cut = int(np.searchsorted(place, place[-1])) if len(place) else 0
            if cut:
                yield from nodes(now.slice(0, cut))
            rest = _summed(now.slice(cut))
        if rest is not None and len(rest):
            yield from nodes(rest)

    return scan


def _summed(rows: pa.Table) -> pa.Table:
    """Copies of a suffix as one row."""
    if len(rows) < ROWS:
        return rows
    keys = ["place", "lang", "pair", "third", "part"]
    summed = rows.group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])
    return summed.select(rows.column_names).cast(rows.schema)


def counted_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all words, and (lang, phrase, n, words) of longer phrases with at least ``least``."""
    spark = docs.sparkSession
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    named = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    counted = named.mapInArrow(_words(HELD), "lang string, phrase string, n long")
    words = tables.stored(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    # the filter has FILTER_BITS bits, whatever the number of words
    slot = F.xxhash64("lang", "phrase").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long"))
    marked = words.where(F.col("n") >= least).select(slot.alias("slot"))
    marked = marked.selectExpr("CAST(shiftright(slot, 6) AS INT) AS at", "shiftleft(1L, CAST(slot & 63 AS INT)) AS bit")
    filled = marked.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[filled.column("at").to_numpy()] = filled.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    places = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = max(1, -(-places // GROUP_PLACES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # no more than SPLIT_WORDS words can have more than this share of all places
    heavy: dict[str, list[bytes]] = {}
    for row in words.where(F.col("n") > max(GROUP_PLACES // 8, -(-places // SPLIT_WORDS))).collect():
        heavy.setdefault(row["lang"], []).append(row["phrase"].encode())
    shared = spark.sparkContext.broadcast((bits, heavy))
    rows = named.mapInArrow(_suffixes(shared, HELD), "lang string, pair string, third string, n long, part int")
    with tables.batch_rows(spark, ROWS):
        grouped = rows.repartition(groups, "lang", "pair", "part").withColumn("place", F.xxhash64("lang", "pair")).sortWithinPartitions("place")
        nodes = tables.stored(grouped.mapInArrow(_subtrees(least), "lang string, phrase string, n long, words int"), "nodes")
    return words, nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.first("words").alias("words")).where(F.col("n") >= least)


def collocations(docs: DataFrame, least: int = 10, first: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two or three words of each language.

    Texts are cut at ``.,;:!?`` and line ends into pieces, those at blanks and tabs into words,
    with A-Z lower-cased. A phrase that occurs a >= ``least`` times within pieces scores
    floor(10^6 a a / (l r)) for a cut into parts that occur l and r times; its lowest cut counts,
    the first of equal ones. A phrase inside a longer candidate that has at least half its count is
    left out. n is the number of words of the language. The ``first`` best of each language stay,
    by score, count and phrase.

    A null text has no words, a null language is ``und``; repeated rows count each, an empty
    table gives an empty one, and other columns are not read.
    """
    words, counted = counted_phrases(docs, least)
    nodes = tables.stored(counted, "phrases")
    known = words.where(F.col("n") >= least).unionByName(nodes.where("words = 2").drop("words"))
    known = tables.stored(known, "parts")
    parts = F.split("phrase", " ")
    cut = F.explode(F.expr("sequence(1, words - 1)"))
    cuts = nodes.select("lang", "phrase", F.col("n").alias("a"), parts.alias("parts"), "words", cut.alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("parts", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = lookup_join(cuts, known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side], "inner")
        cuts = tables.stored(cuts, "cuts")
    # in decimals, as products may pass 64 bits
    a, left, right = (f"CAST({c} AS decimal(16,0))" for c in ("a", "l", "r"))
    scored = cuts.withColumn("score", F.expr(f"CAST((CAST(1000000 AS decimal(7,0)) * {a} * {a}) div ({left} * {right}) AS long)"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest)
    # pairs of words inside a phrase of three: the highest count of one that holds them
    threes = nodes.where("words = 3").select("lang", "n", F.split("phrase", " ").alias("p"))
    inside = F.explode(F.array(F.array_join(F.slice("p", 1, 2), " "), F.array_join(F.slice("p", 2, 2), " ")))
    inside = threes.select("lang", "n", inside.alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    scored = scored.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 2 * longer < a")
    best = scored.select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    best = top_per_group(best, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], first)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
