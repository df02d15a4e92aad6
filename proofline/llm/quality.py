"""A quality classifier on random-indexing word vectors.

Words are counted by a hash into a fixed number of rows. Every row has a sparse random index
vector, and its word vector sums the index vectors of the words that stand near its words
anywhere in the corpus: whole numbers, added up exactly over all documents. A document pools
the vectors of its words, and a network of two layers, fitted on a bounded sample of labelled
documents, turns the pool into a probability whose temperature is set on labels that
the fit has not seen. What tasks hold and exchange is bounded by the parameters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.llm import tables

ROWS = 1 << 14
SIZE = 64
NONZERO = 2
NEAR = 2
# the most labelled documents that the network is fitted on
MAX_LABELLED = 20_000
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.3
# words of a document whose vectors are looked up at once, few enough for a processor's cache
CHUNK = 1 << 12
# words whose neighbours are summed at once
CONTEXT_CHUNK = 1 << 18
# labelled rows that the driver works on at once, and word vectors that a task sends at once
ROW_CHUNK = 1 << 10
# the farthest words that are bound as pairs, and the pools of a document
PAIRS = 2
POOLS = 3 + PAIRS
# every sign that is no letter counts as part of a word of its own
WORD = r"\p{L}+|[^\s\p{L}]+"


def word_rows(text: Column) -> Column:
    """The row of each word of a text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.pmod(F.xxhash64(w), F.lit(ROWS)).cast("int"))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For every row the places and signs of its index vector, the same everywhere."""
    draw = np.random.default_rng(0)
    places = draw.random((ROWS, SIZE)).argsort(axis=1)[:, :NONZERO]
    return places, draw.choice([-1, 1], (ROWS, NONZERO))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and where each list ends; nulls are empty."""
    sizes = np.array(column.value_lengths().fill_null(0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the index vectors of neighbours for each row; the last place counts the words."""
    places, signs = index_vectors()
    total = np.zeros((ROWS, SIZE + 1), np.int64)
    flat = total.reshape(-1)
    for batch in batches:
        words, ends = _lists(batch.column("words"))
        document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        total[:, SIZE] += np.bincount(words, minlength=ROWS)
        # a batch may hold very long texts
        for begin in range(0, len(words), CONTEXT_CHUNK):
            for away in range(1, NEAR + 1):
                end = min(begin + CONTEXT_CHUNK, len(words) - away)
                if end <= begin:
                    continue
                inside = document[begin + away : end + away] == document[begin:end]
                left, right = words[begin:end][inside], words[begin + away : end + away][inside]
                for a, b in ((left, right), (right, left)):
                    # added in place, one number of an index vector at a time: a worker holds no second copy of the sums
                    for i in range(NONZERO):
                        np.add.at(flat, a * (SIZE + 1) + places[b, i], signs[b, i])
    some = np.flatnonzero(total[:, SIZE])
    for at in range(0, len(some), ROW_CHUNK):
        part = some[at : at + ROW_CHUNK]
        yield _packed(part, total[part])


def _packed(rows: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.astype(np.int32)), pa.array([v.astype("<i8").tobytes() for v in vectors], pa.binary())], ["key", "vector"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, vector in zip(batch.column("key").to_pylist(), batch.column("vector").to_pylist()):
            values = np.frombuffer(vector, "<i8")
            held[key] = held[key] + values if key in held else values
    if held:
        yield _packed(np.array(list(held)), np.stack(list(held.values())))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors of all rows (ROWS x SIZE), each of length one, from all texts of ``docs``."""
    found = tables.texts(docs).select(word_rows(F.col("text")).alias("words")).mapInArrow(_contexts, "key int, vector binary")
    # at most ROWS vectors are left, which is small whatever the corpus
    made = found.repartition("key").mapInArrow(_added, "key int, vector binary").toArrow()
    total = np.zeros((ROWS, SIZE))
    if made.num_rows:
        sums = np.stack([np.frombuffer(v, "<i8") for v in made.column("vector").to_pylist()])
        total[made.column("key").to_numpy()] = sums[:, :SIZE]
    length = np.sqrt((total**2).sum(axis=1, keepdims=True))
    return (total / np.maximum(length, 1.0)).astype(np.float32)


def pooled(words: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The word vectors of each document in ``POOLS`` pools of SIZE numbers, and nothing else.

    The pools are the means of the vectors, of their squares and of the vectors of word
    pairs, and the energy of the sum. A pair is bound by the product of its two vectors, for words that follow each
    other and for those with one between, so words that come again show as squares. The energy is the square
    of the sum over the number of words: it grows with words that point one way, and stays where
    they differ. An empty document has zeros.
    """
    rows, ends = _lists(words)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    sums = np.zeros((POOLS - 1, len(ends), SIZE))
    for i, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
        for at in range(start, end, CHUNK):
            until = min(at + CHUNK, end)
            # a pair may reach into the next words, and ends where its document does
            found = vectors[rows[at : min(until + PAIRS, end)]]
            own = found[: until - at]
            sums[0, i] += own.sum(axis=0)
            for away in range(PAIRS + 1):
                other = found[away : away + len(own)]
                sums[1 + away, i] += np.einsum("ij,ij->j", own[: len(other)], other)
    sizes = np.maximum(ends - starts, 1)[:, None]
    return np.concatenate([*(sums / sizes), np.log1p(sums[0] ** 2 / sizes)], axis=1)


@dataclass(frozen=True)
class Network:
    """Two layers; ``constant`` is the score of all documents where nothing could be learnt."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        hidden = np.tanh(_with_one((inputs - self.mean) / self.scale) @ self.first)
        return _with_one(hidden) @ self.second

    def scores(self, inputs: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(inputs), self.constant)
        return _sigmoid(self.logits(inputs) / self.temperature)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0.0, logits) - labels * logits))


def fit_network(inputs: np.ndarray, labels: np.ndarray, calibration: np.ndarray) -> Network:
    """Fit on the rows that are not for ``calibration``, then set the temperature on those that are."""
    if len(labels) < 20 or labels.min() == labels.max() or calibration.all():
        blank = np.zeros(0)
        share = float(labels.mean()) if len(labels) else 0.5
        return Network(blank, blank, blank, blank, constant=share)
    own = np.flatnonzero(~calibration)
    kept = labels[own].astype(float)
    # the inputs are the driver's largest table: rows are worked on in parts, without a second copy
    parts = np.array_split(own, math.ceil(len(own) / ROW_CHUNK))
    mean = sum(inputs[part].sum(axis=0, dtype=np.float64) for part in parts) / len(own)
    scale = np.maximum(np.sqrt(sum(((inputs[part] - mean) ** 2).sum(axis=0) for part in parts) / len(own)), 1e-6)
    draw = np.random.default_rng(1)
    weights = [
        draw.normal(0, 1 / math.sqrt(inputs.shape[1]), (inputs.shape[1] + 1, HIDDEN)),
        draw.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN + 1),
    ]
    # Adam with its usual constants
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(own))
        rate = 0.003 * 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS))
        for at in range(0, len(own), 256):
            rows = order[at : at + 256]
            x = _with_one((inputs[own[rows]] - mean) / scale)
            hidden = np.tanh(x @ weights[0])
            ones = _with_one(hidden)
            error = (_sigmoid(ones @ weights[1]) - kept[rows]) / len(rows)
            back = np.outer(error, weights[1][:-1]) * (1 - hidden**2)
            step += 1
            for i, slope in enumerate((x.T @ back, ones.T @ error)):
                slope = slope + 1e-4 * weights[i]
                m, v = moments[i]
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                weights[i] = weights[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, *weights)
    if calibration.any():
        others = np.flatnonzero(calibration)
        logits = np.concatenate([network.logits(inputs[part]) for part in np.array_split(others, math.ceil(len(others) / ROW_CHUNK))])
        held = labels[others]
        choices = np.exp(np.linspace(math.log(0.25), math.log(8), 101))
        best = min(choices, key=lambda t: _loss(logits / t, held))
        network = Network(mean, scale, *weights, temperature=float(best))
    return network


@dataclass(frozen=True)
class Classifier:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier:
    """Learn word vectors from all of ``docs`` and the network from labelled ones.

    ``labels`` has doc_id and quality (0 or 1). Documents whose crc32(doc_id as text)
    mod 5 is 0 are held out: their labels are not used. Of the others at most
    ``max_labelled``, chosen by a hash, are; a fifth of them sets the temperature. Null or
    contradictory labels are left out. With fewer than 20 labels or labels of one kind only
    every score is the share of label 1 (0.5 without labels).
    """
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    known = (
        known.where(F.col("quality").isin(0, 1) & (remainder("doc_id") != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where(F.col("quality") == F.col("_most"))
        .drop("_most")
    )
    chosen = tables.stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "labelled")
    # at most max_labelled rows
    rows = tables.texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", word_rows(F.col("text")).alias("words"))
    shared = spark.sparkContext.broadcast(vectors)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pool = pooled(batch.column("words"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([p.astype("<f4").tobytes() for p in pool], pa.binary())],
                ["doc_id", "quality", "pool"],
            )

    made = rows.mapInArrow(scan, "doc_id long, quality int, pool binary").dropDuplicates(["doc_id"]).toArrow()
    order = np.argsort(made.column("doc_id").to_numpy())
    inputs = np.zeros((len(order), POOLS * SIZE), np.float32)
    for place, row in enumerate(order):
        inputs[place] = np.frombuffer(made.column("pool")[int(row)].as_buffer(), "<f4")
    ids, quality = made.column("doc_id").to_numpy()[order], made.column("quality").to_numpy()[order]
    del made
    network = fit_network(inputs, quality, ids // 7 % 5 == 0)
    return Classifier(vectors, network)


def remainder(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5


def score(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the columns quality_score (0 to 1) and quality_kept, in place of any of these names.

    Nothing but the text is looked at. A null text is an empty one, which has a score like
    any other; each row is scored on its own, and the table is not shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.arrow_udf("double")
    def scored(words: pa.Array) -> pa.Array:
        made = shared.value
        return pa.array(made.network.scores(pooled(words, made.vectors)))

    words = word_rows(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.withColumn("quality_score", scored(words)).withColumn("quality_kept", F.col("quality_score") >= threshold)
