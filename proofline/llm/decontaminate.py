"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items become sequences of word hashes. Words are weighted by their
inverse document frequency over the whole corpus, and a randomised SVD of the TF-IDF
matrix of the benchmark's passages, computed by tasks over its rows and then over its
words, gives the latent space. (The space is fitted to the passages that are searched for: the
leading directions of a corpus are its common words and do not tell one passage from
another. Each block of passages has a space of its own with as many dimensions as passages, so
nothing of a passage is lost however many there are.) Long items are cut into passages of a
window's size. Windows of every document are projected and compared with the items by cosine;
what comes near is aligned by the longest common subsequence of words, which sees through
changed, left-out and added words, and weaker alignments count only if the item's answer is
there.

A window is projected only if the most that each of its words can bring to any item adds
up to the cosine, a bound that cannot lose a candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.expressions import free_names
from proofline.llm import tables

BUCKETS = 1 << 16
# dimensions of a latent space, and more that the random projection takes
RANK, MORE = 256, 16
# words of a window; windows begin every half of that
WINDOWS = (16, 32)
COSINE = 0.35
# windows that are projected together
WINDOWS_AT_ONCE = 4096
# items with fewer words are looked for as exact word sequences, so many in one pass over the documents
LEAST_WORDS = 5
SHORT_AT_ONCE = 100_000
# the share of an item's words that a document has in order: enough alone, or with the answer
STRONG, WEAK, ANSWER = 0.75, 0.5, 0.8
# without a column of answers, the last of an item's words stand for its answer
ANSWER_WORDS = 6
# passages that share one latent space: as many as it has dimensions, so that it has all of each
ITEM_BLOCK = RANK
# blocks that one pass over the documents looks for
BLOCKS_AT_ONCE = 4
# items with more words are looked for by passages of that many words, one every so many
WHOLE, PASSAGE, PASSAGE_STEP = 64, 32, 16
BATCH = 1000
WORD = r"[\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    """A 31-bit hash of each lower-cased word of a text, in order."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w).bitwiseAND(0x7FFFFFFF).cast("int"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array(column.value_lengths().fill_null(0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)


def _bucket(words: np.ndarray) -> np.ndarray:
    return words.astype(np.int64) & (BUCKETS - 1)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents have each bucket; the last entry counts the documents."""
    counts = np.zeros(BUCKETS + 1, np.int64)
    for batch in batches:
        words, ends = _lists(batch.column("words"))
        document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        once = np.unique(document * BUCKETS + _bucket(words))
        counts[:BUCKETS] += np.bincount(once & (BUCKETS - 1), minlength=BUCKETS)
        counts[BUCKETS] += len(ends)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["bucket", "n"])


def inverse_frequencies(words: DataFrame) -> np.ndarray:
    """The weight of every bucket from all documents of ``words`` (a column of hashes)."""
    found = words.select("words").mapInArrow(_document_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS + 1)
    if found.num_rows:
        counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return np.log((1 + counts[BUCKETS]) / (1 + counts[:BUCKETS])) + 1e-3


def _random_rows(buckets: np.ndarray, size: int) -> np.ndarray:
    """A row of normal numbers for each bucket, the same in every task."""
    return np.stack([np.random.default_rng(int(b)).standard_normal(size) for b in buckets])


def _weighted(words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of an item and their TF-IDF values, of length one; a repeated word counts once."""
    buckets = np.unique(_bucket(words))
    values = weights[buckets]
    return buckets, values / max(1e-12, math.sqrt(float(values @ values)))


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Add up the square matrices of all tasks, each given as rows (row, values)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, values in zip(batch.column("row").to_pylist(), batch.column("values").to_pylist()):
                held[row] = held.get(row, 0.0) + np.frombuffer(values, "<f8")
        yield _rows(np.array(list(held), np.int32), list(held.values()))

    made = parts.repartition("row").mapInArrow(add, "row int, values binary").toArrow()
    total = np.zeros((size, size))
    for row, values in zip(made.column("row").to_pylist(), made.column("values").to_pylist()):
        total[row] += np.frombuffer(values, "<f8")
    return total


def _rows(numbers: np.ndarray, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array([v.astype("<f8").tobytes() for v in values], pa.binary())], ["row", "values"]
    )


def latent_space(items: DataFrame, weights: np.ndarray, count: int, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """A randomised SVD of the TF-IDF matrix of ``items`` (words); returns buckets and their directions.

    With A the matrix and G random, Y = A G is made orthonormal by the Cholesky factor of
    Y'Y, which tasks sum up; B = Q'A is kept by columns, one row for each bucket that occurs,
    and the eigenvectors of BB' turn its rows into the right singular vectors. Nothing of
    the size of A is held in one place; the result has at most ``BUCKETS`` rows.
    """
    spark = items.sparkSession
    size = min(rank + MORE, max(1, count))
    shared = spark.sparkContext.broadcast(weights)

    def projected(words: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        buckets, values = _weighted(np.array(words, np.int64), shared.value)
        return buckets, values, values @ _random_rows(buckets, size)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = np.stack([projected(words)[2] for words in batch.column("words").to_pylist()])
            total += y.T @ y
        yield _rows(np.arange(size), total)

    gram = _summed(items.select("words").mapInArrow(squares, "row int, values binary"), size)
    # directions that the passages do not have are left out
    scales, basis = np.linalg.eigh(gram)
    real = scales > max(scales.max(), 1e-300) * 1e-12
    whiten = basis[:, real] / np.sqrt(scales[real])

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for words in batch.column("words").to_pylist():
                buckets, values, y = projected(words)
                q = y @ whiten
                for bucket, value in zip(buckets.tolist(), values.tolist()):
                    held[bucket] = held.get(bucket, 0.0) + value * q
        yield _rows(np.array(list(held), np.int32), list(held.values()))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, values in zip(batch.column("row").to_pylist(), batch.column("values").to_pylist()):
                held[row] = held.get(row, 0.0) + np.frombuffer(values, "<f8")
        yield _rows(np.array(list(held), np.int32), list(held.values()))

    by_bucket = items.select("words").mapInArrow(columns, "row int, values binary").repartition("row").mapInArrow(added, "row int, values binary")
    made = by_bucket.toArrow()
    buckets = made.column("row").to_numpy()
    rows = np.stack([np.frombuffer(v, "<f8") for v in made.column("values").to_pylist()])
    scales, basis = np.linalg.eigh(rows.T @ rows)
    top = np.argsort(-scales)[:rank]
    top = top[scales[top] > max(scales.max(), 1e-300) * 1e-12]
    return buckets, rows @ basis[:, top] / np.sqrt(scales[top])


def common_length(a: list[int], b: list[int]) -> int:
    """The length of the longest common subsequence, a bit for each word of ``a``."""
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        met = row & places.get(word, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def passages(words: Column) -> Column:
    """The whole of a short item; overlapping passages of a long one, the last up to its end."""
    last = F.size(words) - PASSAGE
    many = F.transform(
        F.sequence(F.lit(0), F.ceil(F.greatest(last, F.lit(0)) / PASSAGE_STEP).cast("int")),
        lambda k: F.slice(words, F.least(k * PASSAGE_STEP, last) + 1, PASSAGE),
    )
    return F.when(F.size(words) <= WHOLE, F.array(words)).otherwise(many)


def _windows(words: np.ndarray, squares: np.ndarray) -> list[tuple]:
    """Buckets of a document's words and, for each size of window, starts, ends, words that are the first of their bucket, and lengths."""
    buckets = _bucket(words)
    order = np.argsort(buckets, kind="stable")
    again = np.flatnonzero(buckets[order[1:]] == buckets[order[:-1]])
    before = np.full(len(words), -1)
    before[order[again + 1]] = order[again]
    made = []
    for size in WINDOWS:
        starts = np.arange(0, max(1, len(words) - size // 2), size // 2)
        ends = np.minimum(starts + size, len(words))
        at = starts[:, None] + np.arange(size)
        inside = at < len(words)
        at[~inside] = 0
        here = np.where(inside & (before[at] < starts[:, None]), buckets[at], -1)
        made.append((starts, ends, here, np.sqrt(np.where(here >= 0, squares[here], 0.0).sum(axis=1))))
    return [buckets, made]


class _Search:
    """The passages of one block, ready to be looked for."""

    def __init__(self, owners, words, weights, buckets, directions):
        self.owners = owners
        self.weights = weights.astype(np.float32)
        self.row = np.full(BUCKETS, -1, np.int32)
        self.row[buckets] = np.arange(len(buckets))
        self.directions = directions.astype(np.float32)
        latent = []
        for w in words:
            at, values = _weighted(np.array(w, np.int64), weights)
            latent.append(values @ directions[self.row[at]])
        latent = np.stack(latent)
        self.latent = (latent / np.maximum(1e-12, np.linalg.norm(latent, axis=1, keepdims=True))).astype(np.float32)
        # what a word of each bucket brings to a window's product with an item at most
        best = np.full(len(buckets), -np.inf, np.float32)
        for at in range(0, len(self.latent), 1024):
            best = np.maximum(best, (self.directions @ self.latent[at : at + 1024].T).max(axis=1))
        # what each word brings: to every item if they are few, else to every direction
        self.brings = self.directions * self.weights[buckets, None]
        self.few = len(self.latent) <= self.latent.shape[1]
        if self.few:
            self.brings = self.brings @ self.latent.T
        self.most = np.zeros(BUCKETS)
        self.most[buckets] = np.maximum(best, 0) * self.weights[buckets]

    def candidates(self, windows: list, cosine: float) -> list[tuple[int, int, int, float]]:
        """(item, first word, last word, cosine) of the windows of one document that come near a passage.

        A word counts once in a window.
        """
        buckets, sized = windows
        found = []
        for starts, ends, here, lengths in sized:
            most = np.where(here >= 0, self.most[here], 0.0).sum(axis=1)
            # no passage can be nearer than the words bring at most
            able = np.flatnonzero(most >= cosine * lengths * (1 - 1e-5))
            for part in np.array_split(able, len(able) // WINDOWS_AT_ONCE + 1):
                if len(part):
                    found += self._near(buckets, starts[part], ends[part], lengths[part], cosine)
        return [(self.owners[passage], *place) for passage, *place in found]

    def _near(self, buckets: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, cosine: float):
        sizes = ends - starts
        window = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        here = buckets[at]
        known = self.row[here] >= 0
        # each bucket once in a window
        once = np.unique(window[known] * BUCKETS + here[known])
        window, here = once // BUCKETS, once & (BUCKETS - 1)
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])) if len(once) else once
        if not len(first):
            return []
        points = np.add.reduceat(self.brings[self.row[here]], first, axis=0)
        number = window[first]
        near = (points if self.few else points @ self.latent.T) / np.maximum(1e-12, lengths[number, None])
        which, items = np.nonzero(near >= cosine)
        number = number[which]
        return list(zip(items.tolist(), starts[number].tolist(), ends[number].tolist(), near[which, items].tolist()))


class _Items:
    """The items of several blocks and the searches for their passages."""

    def __init__(self, ids, words, answers, weights, blocks):
        self.ids = ids
        self.words = [list(w) for w in words]
        self.answers = answers
        self.squares = weights.astype(np.float64) ** 2
        self.searches = [_Search(*block[:2], weights, *block[2:]) for block in blocks]

    def matches(self, words: np.ndarray, cosine: float) -> dict[int, tuple[float, float, float]]:
        """For each item that is aligned with the document: cosine, share of its words, share of its answer."""
        best: dict[int, tuple[float, float, float]] = {}
        if not len(words):
            return best
        windows = _windows(words, self.squares)
        places: dict[tuple[int, int, int], float] = {}
        for search in self.searches:
            for *place, near in search.candidates(windows, cosine):
                places[tuple(place)] = max(places.get(tuple(place), 0.0), near)
        for (item, start, end), near in places.items():
            own = self.words[item]
            region = words[max(0, start - len(own)) : end + len(own)].tolist()
            share = common_length(own, region) / len(own)
            answer = common_length(self.answers[item], region) / len(self.answers[item])
            if share >= STRONG or share >= WEAK and answer >= ANSWER:
                best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (share, answer, near))
        return best


class _ShortItems:
    """Items of fewer than ``LEAST_WORDS`` words, found where all their words follow each other.

    So few words say little on their own: where the item has an answer, it must be near.
    """

    def __init__(self, ids, words, answers):
        self.ids = ids
        self.answers = [list(a) for a in answers]
        self.by_size: dict[int, tuple[np.ndarray, dict[tuple, list[int]]]] = {}
        for size in sorted({len(w) for w in words}):
            items: dict[tuple, list[int]] = {}
            for item, own in enumerate(words):
                if len(own) == size:
                    items.setdefault(tuple(own), []).append(item)
            self.by_size[size] = self._keys(np.array(list(items), np.uint64)), items

    @staticmethod
    def _keys(grams: np.ndarray) -> np.ndarray:
        """A number for each row of words; rows that share it are told apart by their words."""
        keys = np.zeros(len(grams), np.uint64)
        for column in grams.T:
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + column
        return keys

    def matches(self, words: np.ndarray, cosine: float) -> dict[int, tuple[float, float, float]]:
        """As ``_Items.matches``: a sequence that is there whole has a cosine and share of one."""
        best: dict[int, tuple[float, float, float]] = {}
        for size, (keys, items) in self.by_size.items():
            if len(words) < size:
                continue
            grams = np.lib.stride_tricks.sliding_window_view(words, size).astype(np.uint64)
            for at in np.flatnonzero(np.isin(self._keys(grams), keys)).tolist():
                for item in items.get(tuple(words[at : at + size].tolist()), ()):
                    answer = self.answers[item]
                    if best.get(item, (0.0, 0.0))[1] == 1.0:
                        continue
                    region = words[max(0, at - WINDOWS[-1]) : at + size + WINDOWS[-1] + len(answer)].tolist()
                    share = common_length(answer, region) / len(answer) if answer else 1.0
                    if share >= ANSWER:
                        best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (1.0, share, 1.0))
        return best


def _searcher(shared, cosine: float, kind: type = _Items):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = kind(*shared.value)
        for batch in batches:
            flat, ends = _lists(batch.column("words"))
            starts = np.concatenate([[0], ends[:-1]])
            found = [
                (i, *items.ids[item], near, share, answer)
                for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist()))
                for item, (share, answer, near) in items.matches(flat[a:b], cosine).items()
            ]
            if found:
                rows, numbers, names, near, share, answer = zip(*found)
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(c) for c in ("row", "doc_id", "key")), *(pa.array(x, pa.int64()) for x in (numbers, names)), *(pa.array(x, pa.float64()) for x in (near, share, answer))],
                    ["row", "doc_id", "key", "item", "item_id", "cosine", "word_share", "answer_share"],
                )

    return scan


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, rank: int = RANK) -> DataFrame:
    """The items found in each document: doc_id, key, item_id, cosine, word_share, answer_share.

    ``benchmark`` has item_id, text and perhaps answer. A document has an item if at least
    ``STRONG`` of the item's words are there in order near a window that is close in the
    latent space, or ``WEAK`` of them and ``ANSWER`` of the answer's words. ``key`` is a
    hash of the text, to name rows without a doc_id. An item with fewer than ``LEAST_WORDS``
    words is found where all of them follow each other and, if the item has an answer, ``ANSWER`` of its
    words are in order within ``WINDOWS[-1]`` words. Items without words or an id are left out. Null and empty texts match nothing; repeated rows
    give the same row each; empty tables give none. Other columns are not looked at.

    The word hashes of the documents are kept as a table, as the weights of all documents
    are needed before the first is searched. Benchmarks are searched in blocks of about
    ``rank`` passages (``ITEM_BLOCK`` at most), each in a space that has all its passages.
    """
    spark = docs.sparkSession
    text = F.coalesce(benchmark["text"].cast("string"), F.lit(""))
    answer = benchmark["answer"].cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), word_hashes(text).alias("words"), word_hashes(F.coalesce(answer, F.lit(""))).alias("answer")
    )
    items = items.where(F.col("item_id").isNotNull() & (F.size("words") > 0))
    items = tables.stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    short, items = (items.where(F.size("words") < LEAST_WORDS), items.where(F.size("words") >= LEAST_WORDS))
    with tables.batch_rows(spark, BATCH):
        named = tables.texts(docs)
        words = named.select("doc_id", F.xxhash64("text").alias("key"), word_hashes(F.col("text")).alias("words"))
        words = tables.stored(words.withColumn("row", F.monotonically_increasing_id()), "words")
        names = "row long, doc_id long, key long, item long, item_id long"
        schema = f"{names}, cosine double, word_share double, answer_share double"
        cut = tables.stored(items.select("item", F.posexplode(passages(F.col("words"))).alias("at", "words")), "passages")
        count, few = cut.count(), short.count()
        if not count + few:
            return spark.createDataFrame([], schema).drop("row", "item")
        found = None
        passes = math.ceil(few / SHORT_AT_ONCE)
        for number in range(passes):
            # a hash deals about SHORT_AT_ONCE items of a few words to each pass
            mine = short.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).toPandas()
            if len(mine):
                ids = list(zip(mine["item"].tolist(), mine["item_id"].tolist()))
                shared = spark.sparkContext.broadcast((ids, [list(w) for w in mine["words"]], [list(a) for a in mine["answer"]]))
                part = tables.stored(words.mapInArrow(_searcher(shared, cosine, _ShortItems), schema), "leaks")
                found = part if found is None else found.unionByName(part)
        weights = inverse_frequencies(words) if count else None
        blocks = math.ceil(count / min(rank, ITEM_BLOCK))
        cut = tables.stored(cut.withColumn("block", F.pmod(F.xxhash64("item", "at"), F.lit(max(1, blocks))).cast("int")), "passages")
        for first in range(0, blocks, BLOCKS_AT_ONCE):
            some = cut.where(F.col("block").between(first, first + BLOCKS_AT_ONCE - 1))
            mine = items.join(some.select("item").distinct(), "item", "left_semi").toPandas()
            if not len(mine):
                continue
            answers = [list(a) if len(a) else list(w[-ANSWER_WORDS:]) for a, w in zip(mine["answer"], mine["words"])]
            number = {item: i for i, item in enumerate(mine["item"].tolist())}
            ready = []
            for block, own in some.toPandas().groupby("block"):
                space = latent_space(cut.where(F.col("block") == int(block)), weights, len(own), len(own))
                ready.append(([number[i] for i in own["item"].tolist()], own["words"].tolist(), *space))
            ids = list(zip(mine["item"].tolist(), mine["item_id"].tolist()))
            shared = spark.sparkContext.broadcast((ids, mine["words"].tolist(), answers, weights, ready))
            part = tables.stored(words.mapInArrow(_searcher(shared, cosine), schema), "leaks")
            found = part if found is None else found.unionByName(part)
    # an item may be found by passages of several passes
    best = F.max(F.struct("word_share", "answer_share", "cosine")).alias("best")
    once = found.groupBy("row", "doc_id", "key", "item", "item_id").agg(best)
    return once.select("doc_id", "key", "item_id", "best.cosine", "best.word_share", "best.answer_share")


def without_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, rank: int = RANK) -> DataFrame:
    """``docs`` without the rows in which an item of ``benchmark`` is found; all columns are kept."""
    doc_id, key = free_names(docs, ["found_doc_id", "found_key"])
    found = contaminated(docs, benchmark, cosine, rank).select("doc_id", "key").distinct().toDF(doc_id, key)
    hashed = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc_id)) & (hashed == F.col(key))
    return docs.join(found, same, "left_anti")
