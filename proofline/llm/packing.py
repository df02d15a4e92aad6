"""Vector best-fit packing of token pieces into sequences.

A piece asks for a vector of capacities: its tokens, one document place, and its attention
cost, the square of its tokens. All pieces of one length ask for the same vector, so the
plan is made on the histogram of lengths: pieces are taken from the longest down, each
goes to the open sequence with the best score that can hold it under every constraint, and
sequences with equal residuals are handled together. The plan looks at no more than one
row per length and has a size that the lengths bound, however many pieces there are. Pieces
then find their place by their rank among those of the same length; nothing is grouped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.llm import tables
from proofline.llm.tokens import VOCABULARY, word_tokenizer

MAX_TOKENS = 1024
ID_BYTES = 4
# plans of more rows than this are joined without a broadcast
BROADCAST_PLAN = 200_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
_PIECE_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("task", pa.int32()),
        ("nth", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Limits:
    """What a sequence can hold. Attention cost sums the squared lengths of its pieces.

    ``None`` leaves a constraint at a value that the tokens imply. ``weights`` belong to
    tokens, documents and attention cost, each taken as a share of its limit. ``score`` is
    ``norm`` (least weighted norm of what stays free) or ``dot`` (greatest weighted dot
    product of the piece with what is free).
    """

    tokens: int = MAX_TOKENS
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"

    def vector(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        if self.tokens < 1 or documents < 1 or attention < self.tokens**2:
            raise ValueError("a sequence must be able to hold one piece of its full length")
        return np.array([self.tokens, documents, attention], np.int64)


def plan(counts: dict[int, int], limits: Limits = Limits()) -> tuple[list[tuple[int, ...]], int]:
    """Place ``counts[length]`` pieces of every length; returns slots and the number of sequences.

    A slot (length, first, last, sequence, each, offset) says: the pieces of this length
    with ranks first .. last - 1 go to the sequences from ``sequence`` on, ``each`` to a
    sequence, the first of them at token ``offset``.
    """
    if limits.score not in ("norm", "dot"):
        raise ValueError(f"unknown score {limits.score!r}")
    capacity = limits.vector()
    weights = np.array(limits.weights)
    free = np.empty((0, 3), np.int64)
    many = np.empty(0, np.int64)
    first = np.empty(0, np.int64)
    slots: list[tuple[int, ...]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = int(counts[length]), 0
        asks = np.array([length, 1, length * length], np.int64)
        kept = (free[:, 0] > 0) & (free[:, 1] > 0)
        free, many, first = free[kept], many[kept], first[kept]
        while left:
            fits = np.flatnonzero((free >= asks).all(axis=1))
            if len(fits):
                shares = free[fits] / capacity
                if limits.score == "norm":
                    best = fits[np.argmin((((shares - asks / capacity) * weights) ** 2).sum(axis=1))]
                else:
                    best = fits[np.argmax((shares * (asks / capacity) * weights).sum(axis=1))]
            else:
                # as many new sequences as the rest can need
                free = np.vstack([free, capacity])
                many, first = np.append(many, left), np.append(first, sequences)
                best = len(many) - 1
            # after a piece the same sequence is the best fit again, until it is full
            each = int((free[best] // asks).min()) if limits.score == "norm" else 1
            each = min(each, left)
            used = min(int(many[best]), left // each)
            slots.append((length, rank, rank + used * each, int(first[best]), each, int(capacity[0] - free[best][0])))
            if not len(fits):
                sequences = int(first[best]) + used
                many[best] = used
            if used < many[best]:
                free = np.vstack([free, free[best]])
                many, first = np.append(many, many[best] - used), np.append(first, first[best] + used)
                many[best] = used
            free[best] -= each * asks
            left, rank = left - used * each, rank + used * each
    return slots, sequences


def _cutter(vocabulary: str, end_id: int, size: int):
    end = int(end_id).to_bytes(ID_BYTES, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(vocabulary).encode
        seen: dict[int, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for task, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("task", "doc_id", "text"))):
                ids = encode(text) + end
                n = len(ids) // ID_BYTES
                at, number = 0, 0
                length = n % size or size
                while at < n:
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    crc = zlib.crc32(ids[at * ID_BYTES : (at + length) * ID_BYTES])
                    rows.append((doc_id, number, at, length, crc, task, nth))
                    at, number, length = at + length, number + 1, size
            columns = zip(*rows) if rows else [[]] * len(_PIECE_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE_ARROW)], schema=_PIECE_ARROW)

    return cut


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = 2, limits: Limits = Limits()) -> DataFrame:
    """Pack the documents (doc_id, text) into few sequences; one row per piece.

    A document is its token ids and ``end_id``. One that is longer than a sequence is cut
    into full pieces, the first of which may be shorter; others stay whole. Returns
    doc_id, piece, start (ids of the document before it), length, ids_crc32, sequence_id
    and offset, without gaps from 0. A null text is an empty one and still has its end id;
    null and repeated doc_ids are packed like others, each row on its own. An empty table
    packs into nothing. Other columns are not looked at.

    Texts are encoded once, in place; the pieces, without their ids, are kept as a table.
    """
    spark = docs.sparkSession
    named = tables.texts(docs).withColumn("task", F.spark_partition_id())
    pieces = tables.stored(named.mapInArrow(_cutter(vocabulary, end_id, limits.tokens), _PIECE), "pieces")
    # one row for each length and encoding task
    per_task = tables.stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = plan(counts, limits)
    placed = spark.createDataFrame(
        slots, "length long, first long, last long, first_sequence long, each long, first_offset long"
    )
    if len(slots) <= BROADCAST_PLAN:
        placed = F.broadcast(placed)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        pieces.join(
            per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")),
            ["length", "task"],
        )
        .withColumn("rank", F.col("earlier") + F.col("nth"))
    )
    within = F.col("rank") - F.col("first")
    return (
        ranked.join(placed, "length")
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("first_offset") + within % F.col("each") * F.col("length")).alias("offset"),
        )
    )
