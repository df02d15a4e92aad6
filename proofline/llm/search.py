"""Ranked lexical search: short lists summed term by term, long lists skipped document by document.

Documents are indexed in segments of a few thousand: for every term of the searches a list of
documents with its count in each. Every search runs on every segment. Its short lists are
summed into accumulators first (term at a time). The accumulators then count as one more list
whose blocks have a highest value, beside the long lists, and the search goes through the
documents block by block: a block whose highest possible score does not reach the k-th best
score so far is skipped in all lists at once. Only what cannot be among the best is skipped,
so the result is exact. A task carries the best of each search from segment to segment.

All weights are integers, as the score is defined in 64-bit arithmetic.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.functions.ordered import top_per_group
from proofline.llm import tables

# bytes of search texts that go through the documents together; their terms are what is broadcast
BLOCK_BYTES = 4 << 20
# documents and postings after which a segment ends
SEGMENT_DOCS, SEGMENT_POSTINGS = 4096, 1 << 19
# postings of a search's short lists, as a share of the documents of a segment
SHORT_SHARE = 0.5
# documents in a block
BLOCK_DOCS = 64

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
TERM_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256))

SEGMENT = "docs long, words long, ids binary, unnamed binary, lengths binary, terms binary, ends binary, at binary, counts binary"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII; only A-Z are lower-cased."""
    return text.translate(TERM_SIGNS).split()


class _Segment:
    """Postings of some documents while they are gathered."""

    def __init__(self, vocabulary: dict[bytes, int], most: int) -> None:
        self.vocabulary, self.most = vocabulary, most
        self.clear()

    def clear(self) -> None:
        self.docs = self.words = self.postings = 0
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: list[int] = []
        self.at: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = terms_of(text)
        if not words:
            return
        self.docs += 1
        self.words += len(words)
        found = Counter(filter(None.__ne__, map(self.vocabulary.get, words)))
        if found:
            self.terms += found.keys()
            self.counts += found.values()
            self.at += [len(self.ids)] * len(found)
            self.ids.append(doc_id)
            self.lengths.append(len(words))

    def full(self) -> bool:
        return self.docs >= self.most or len(self.terms) >= SEGMENT_POSTINGS

    def taken(self) -> pa.RecordBatch:
        """One row; documents are numbered by their length, so that blocks hold like ones."""
        lengths = np.array(self.lengths, np.int64)
        order = np.argsort(lengths, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        terms, at, counts = (np.array(x, np.int64) for x in (self.terms, self.at, self.counts))
        at = place[at] if len(at) else at
        by = np.lexsort((at, terms))
        terms, at, counts = terms[by], at[by], counts[by]
        names, sizes = np.unique(terms, return_counts=True)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)[order]
        unnamed = np.array([i is None for i in self.ids], bool)[order]
        packed = [
            ids.astype("<i8"), unnamed.astype("u1"), lengths[order].astype("<i8"), names.astype("<i4"),
            np.cumsum(sizes).astype("<i8"), at.astype("<i4"), counts.astype("<i4"),
        ]
        row = [pa.array([self.docs], pa.int64()), pa.array([self.words], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)]
        self.clear()
        return pa.RecordBatch.from_arrays(row, ["docs", "words", "ids", "unnamed", "lengths", "terms", "ends", "at", "counts"])


def _indexer(vocabulary, most: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment(vocabulary.value, most)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                segment.add(doc_id, text)
                if segment.full():
                    yield segment.taken()
        if segment.docs:
            yield segment.taken()

    return scan


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df): documents of a segment that hold each term."""
    for batch in batches:
        for terms, ends in zip(batch.column("terms").to_pylist(), batch.column("ends").to_pylist()):
            df = np.diff(np.frombuffer(ends, "<i8"), prepend=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, "<i4")), pa.array(df)], ["term", "df"])


@dataclass
class Search:
    """The terms of one search with the weight of each, repeats included."""

    key: int
    terms: np.ndarray
    weights: np.ndarray


class _Best:
    """The k best documents of one search so far, best first."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, np.uint8)
        self.doc = np.zeros(0, np.int64)

    def least(self) -> int:
        """The score that a document must reach; ties count, as the lesser doc_id goes first."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, unnamed: np.ndarray, doc: np.ndarray) -> None:
        score, unnamed, doc = (np.concatenate(x) for x in ((self.score, score), (self.unnamed, unnamed), (self.doc, doc)))
        order = np.lexsort((doc, unnamed, -score))[: self.k]
        self.score, self.unnamed, self.doc = score[order], unnamed[order], doc[order]


class _Lists:
    """The posting lists of a segment with what each posting adds per unit of weight."""

    def __init__(self, row: dict[str, bytes], docs: int, words: int, size: int, share: float) -> None:
        self.size, self.share = size, share
        self.ids, self.lengths = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
        self.unnamed = np.frombuffer(row["unnamed"], "u1")
        self.names, self.ends = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["ends"], "<i8")
        self.at = np.frombuffer(row["at"], "<i4").astype(np.int64)
        count = np.frombuffer(row["counts"], "<i4").astype(np.int64)
        # in Python's integers: 25 * n * N may pass 64 bits
        norm = np.array([75 + 25 * n * docs // words for n in self.lengths.tolist()], np.int64)
        self.adds = (1_000_000_000 * count) // (1000 * count + 12 * norm[self.at])
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.blocks = -(-len(self.ids) // self.size)
        # where each list enters a new block, and the highest value it has there
        block = self.at // self.size
        new = np.ones(len(block), bool)
        new[1:] = block[1:] != block[:-1]
        new[self.starts] = True
        self.enters = np.flatnonzero(new)
        self.highest = np.maximum.reduceat(self.adds, self.enters)
        self.in_block = block[self.enters]
        self.first_enter = np.searchsorted(self.enters, self.starts)
        self.last_enter = np.searchsorted(self.enters, self.ends)

    def run(self, search: Search, best: _Best) -> None:
        place = np.searchsorted(self.names, search.terms)
        place[place == len(self.names)] = 0
        here = (self.names[place] == search.terms) & (search.weights > 0)
        lists, weights = place[here], search.weights[here]
        if not len(lists):
            return
        sizes = self.ends[lists] - self.starts[lists]
        order = np.argsort(sizes, kind="stable")
        lists, weights, sizes = lists[order], weights[order], sizes[order]
        short = int(np.searchsorted(np.cumsum(sizes), self.share * len(self.ids), side="right"))
        # term at a time: the short lists become one list of accumulators
        sums = np.zeros(self.blocks * self.size, np.int64)
        for j, w in zip(lists[:short].tolist(), weights[:short].tolist()):
            own = slice(self.starts[j], self.ends[j])
            sums[self.at[own]] += w * self.adds[own]
        bound = sums.reshape(self.blocks, self.size).max(axis=1)
        long = list(zip(lists[short:].tolist(), weights[short:].tolist()))
        for j, w in long:
            own = slice(self.first_enter[j], self.last_enter[j])
            bound[self.in_block[own]] += w * self.highest[own]
        # document at a time, highest bounds first: what remains below the k-th best is skipped
        by = np.argsort(-bound, kind="stable")
        chunk, done = 1, 0
        while done < len(by):
            least = best.least()
            blocks = np.sort(by[done : done + chunk][bound[by[done : done + chunk]] >= least])
            if not len(blocks):
                return
            self._score(blocks, sums, long, best, least)
            done, chunk = done + chunk, chunk * 2

    def _score(self, blocks: np.ndarray, sums: np.ndarray, long: list, best: _Best, least: int) -> None:
        slot = np.full(self.blocks, -1, np.int64)
        slot[blocks] = np.arange(len(blocks))
        score = sums.reshape(self.blocks, self.size)[blocks].reshape(-1)
        for j, w in long:
            enters = np.arange(self.first_enter[j], self.last_enter[j])
            enters = enters[slot[self.in_block[enters]] >= 0]
            if not len(enters):
                continue
            start = self.enters[enters]
            end = np.where(enters + 1 < self.last_enter[j], self.enters[np.minimum(enters + 1, len(self.enters) - 1)], self.ends[j])
            many = end - start
            own = np.repeat(start - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            at = self.at[own]
            score[slot[at // self.size] * self.size + at % self.size] += w * self.adds[own]
        good = np.flatnonzero(score >= least)
        if len(good):
            doc = blocks[good // self.size] * self.size + good % self.size
            best.add(score[good], self.unnamed[doc], self.ids[doc])


def _searcher(shared, docs: int, words: int, k: int, size: int, share: float):
    names = ("ids", "unnamed", "lengths", "terms", "ends", "at", "counts")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = shared.value
        found = [_Best(k) for _ in searches]
        for batch in batches:
            for row in batch.to_pylist():
                if not row["terms"]:
                    continue
                lists = _Lists({c: row[c] for c in names}, docs, words, size, share)
                for search, best in zip(searches, found):
                    lists.run(search, best)
        many = [len(b.score) for b in found]
        if sum(many):
            key = np.repeat(np.array([s.key for s in searches], np.int64), many)
            doc = pa.array(np.concatenate([b.doc for b in found]), mask=np.concatenate([b.unnamed for b in found]) > 0)
            yield pa.RecordBatch.from_arrays([pa.array(key), doc, pa.array(np.concatenate([b.score for b in found]))], ["key", "doc_id", "score"])

    return scan


def weight(docs: int, df: int) -> int:
    """How much a term that ``df`` of ``docs`` documents hold counts."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _block(spark: SparkSession, named: DataFrame, texts: dict[int, bytes], k: int) -> DataFrame:
    """(key, doc_id, score): the best of each task for one block of searches."""
    sc = spark.sparkContext
    words = {key: Counter(terms_of(text)) for key, text in texts.items()}
    vocabulary = {t: i for i, t in enumerate(sorted({t for found in words.values() for t in found}))}
    shared = sc.broadcast(vocabulary)
    binary = named.select("doc_id", F.col("text").cast("binary").alias("text"))
    segments = tables.stored(binary.mapInArrow(_indexer(shared, SEGMENT_DOCS), SEGMENT), "segments")
    with tables.batch_rows(spark, 1):
        docs, total = segments.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
        held = segments.select("terms", "ends").mapInArrow(_held, "term int, df long")
        # one row for each term of the block
        df = {r["term"]: r["df"] for r in held.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        searches = []
        for key, found in words.items():
            terms = sorted(vocabulary[t] for t in found)
            many = {vocabulary[t]: n for t, n in found.items()}
            weights = [many[t] * weight(docs, df[t]) if t in df else 0 for t in terms]
            searches.append(Search(key, np.array(terms, np.int32), np.array(weights, np.int64)))
        run = segments.mapInArrow(_searcher(sc.broadcast(searches), docs, total, k, BLOCK_DOCS, SHORT_SHARE), "key long, doc_id long, score long")
        return tables.stored(run, "found")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of ``docs`` for each item.

    Terms are runs of ASCII letters, digits and signs beyond ASCII, A-Z lower-cased. With N
    documents that have terms and L terms in all, a term in df documents weighs
    floor(1000 ln((2N + 2) / (2df + 1))), and adds weight * (10^9 tf div (1000 tf + 12 m)) where m
    is 75 + 25 n N div L for a document of n terms. Terms that an item repeats count as often.

    Documents without a score above 0 are not in the result; equal scores go by doc_id, null
    ones last. Rows that share a doc_id are documents of their own. Null texts have no terms;
    items without terms, or with terms that no document has, have no rows. Items that repeat
    both item_id and text count once; those that share an item_id alone are ranked each on
    its own. Empty tables give an empty result, and other columns are not read.
    """
    spark = docs.sparkSession
    named = tables.texts(docs)
    asked = items.select(items["item_id"].cast("long").alias("item_id"), F.coalesce(items["text"].cast("string"), F.lit("")).alias("text")).distinct()
    asked = tables.stored(asked.withColumn("key", F.monotonically_increasing_id()), "searches")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == number)
        texts = {r["key"]: r["text"].encode() for r in own.select("key", "text").collect()}
        part = _block(spark, named, texts, k)
        found = part if found is None else found.unionByName(part)
    best = top_per_group(found, ["key"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)
    return best.join(asked.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
