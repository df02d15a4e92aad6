"""Token ids as shuffled planes.

The file format is a Parquet table of segments. A segment holds whole documents in
ascending order: their ids, their token counts and their token ids, cut into blocks of a
fixed number of ids. Each block is transposed into planes (all lowest bytes, all second
bytes, ... or bit by bit), and each plane is compressed with zstandard on its own, so that
the high planes, nearly all zero, take no room. A second table, the chunk index, tells
for every block which ids it holds, where it is, how large its planes are and their
checksum; a reader that wants ids 10,000,000 to 10,100,000 filters it and opens only the
segments named there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proofline.llm import tables
from proofline.llm.tokens import VOCABULARY, word_tokenizer

BLOCK_IDS = 1 << 16
# a segment is closed at the first document that brings it to this many ids
SEGMENT_IDS = 1 << 20
LEVEL = 3
ID_BYTES = 4

_SEGMENT = (
    "shard int, segment int, first_id long, n_ids long, doc_ids array<long>, n_tokens array<long>, "
    "blocks array<struct<n_ids: int, ids_crc32: long, plane_bytes: array<int>, planes: array<binary>>>"
)
_BLOCK = pa.struct(
    [("n_ids", pa.int32()), ("ids_crc32", pa.int64()), ("plane_bytes", pa.list_(pa.int32())), ("planes", pa.list_(pa.binary()))]
)
_SEGMENT_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("blocks", pa.list_(_BLOCK)),
    ]
)


def to_planes(ids: bytes, planes: str) -> list[bytes]:
    """Transpose little-endian 32-bit ids into 4 byte planes or 32 bit planes, lowest first."""
    rows = np.frombuffer(ids, np.uint8).reshape(-1, ID_BYTES)
    if planes == "byte":
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(ID_BYTES)]
    if planes != "bit":
        raise ValueError(f"planes are 'byte' or 'bit', not {planes!r}")
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(8 * ID_BYTES)]


def from_planes(planes: list[bytes], n_ids: int) -> bytes:
    """The inverse of ``to_planes``."""
    if len(planes) == ID_BYTES:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).tobytes()
    bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n_ids, bitorder="little") for p in planes]
    return np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little").tobytes()


def _blocks(ids: bytes, block_ids: int, planes: str, level: int) -> list[dict]:
    pack = zstandard.ZstdCompressor(level=level)
    made = []
    for at in range(0, len(ids), block_ids * ID_BYTES):
        block = ids[at : at + block_ids * ID_BYTES]
        packed = [pack.compress(p) for p in to_planes(block, planes)]
        made.append(
            {
                "n_ids": len(block) // ID_BYTES,
                "ids_crc32": zlib.crc32(block),
                "plane_bytes": [len(p) for p in packed],
                "planes": packed,
            }
        )
    return made


def _writer(vocabulary: str, end_id: int, block_ids: int, segment_ids: int, planes: str, level: int):
    end = int(end_id).to_bytes(ID_BYTES, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(vocabulary).encode
        shard, segment, first, size = None, 0, 0, 0
        doc_ids: list[int | None] = []
        parts: list[bytes] = []

        def row() -> pa.RecordBatch:
            made = {
                "shard": shard,
                "segment": segment,
                "first_id": first,
                "n_ids": size,
                "doc_ids": doc_ids,
                "n_tokens": [len(p) // ID_BYTES for p in parts],
                "blocks": _blocks(b"".join(parts), block_ids, planes, level),
            }
            return pa.RecordBatch.from_pylist([made], schema=_SEGMENT_ARROW)

        for batch in batches:
            for shard, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "text"))):
                ids = encode(text) + end
                doc_ids.append(doc_id)
                parts.append(ids)
                size += len(ids) // ID_BYTES
                if size >= segment_ids:
                    yield row()
                    segment, first, size, doc_ids, parts = segment + 1, first + size, 0, [], []
        if parts:
            yield row()

    return write


def write_ids(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = 0,
    planes: str = "byte",
    block_ids: int = BLOCK_IDS,
    segment_ids: int = SEGMENT_IDS,
    level: int = LEVEL,
) -> None:
    """Write the token ids of ``docs`` (doc_id, text) under ``path``, ascending by doc_id.

    ``end_id`` closes every document. A null text is an empty one: it has the end id
    only. A null doc_id sorts first; rows that share a doc_id keep the order in which they
    are read, and all of them are written. Other columns are not looked at. An empty table
    gives an empty one. Documents are dealt out by ranges of doc_id and position, so
    repeated doc_ids spread as well; a task holds one segment (about ``segment_ids`` ids, or
    one longer document) at a time.
    """
    spark = docs.sparkSession
    order = [F.asc_nulls_first("doc_id"), F.col("_at")]
    dealt = (
        tables.texts(docs)
        .withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )
    segments = dealt.mapInArrow(_writer(vocabulary, end_id, block_ids, segment_ids, planes, level), _SEGMENT)
    # the planes are compressed already
    segments.write.option("compression", "uncompressed").parquet(f"{path}/segments")
    chunk_index(spark, path).write.parquet(f"{path}/index")


def _shard_starts(segments: DataFrame) -> DataFrame:
    """The first id of each shard: one row for each writing task, whatever the table holds."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.groupBy("shard").agg(F.sum("n_ids").alias("_size"))
    return sizes.select("shard", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shard_start"))


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """A row for each block: the ids it holds (first_id, n_ids), its place, plane sizes and checksum."""
    segments = spark.read.schema(_SEGMENT).parquet(f"{path}/segments")
    placed = segments.join(F.broadcast(_shard_starts(segments)), "shard")
    # planes are not read here; as all blocks of a segment but the last are full,
    # a block begins at its number times the size of the first
    block = placed.select(
        "shard",
        "segment",
        (F.col("_shard_start") + F.col("first_id")).alias("_start"),
        F.col("blocks.n_ids").alias("_n"),
        F.posexplode(F.arrays_zip(F.col("blocks.n_ids").alias("n_ids"), F.col("blocks.ids_crc32").alias("ids_crc32"), F.col("blocks.plane_bytes").alias("plane_bytes"))).alias("block", "b"),
    )
    return block.select(
        (F.col("_start") + F.col("block").cast("long") * F.col("_n")[0]).alias("first_id"),
        F.col("b.n_ids").cast("long").alias("n_ids"),
        "shard",
        "segment",
        "block",
        "b.ids_crc32",
        "b.plane_bytes",
    )


_DOCUMENT = "shard int, doc_id long, first_id long, n_tokens long, ids binary"
_DOCUMENT_ARROW = pa.schema(
    [("shard", pa.int32()), ("doc_id", pa.int64()), ("first_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


def _unpack(blocks: list[dict]) -> bytes:
    unpack = zstandard.ZstdDecompressor()
    made = []
    for b in blocks:
        ids = from_planes([unpack.decompress(p) for p in b["planes"]], b["n_ids"])
        if zlib.crc32(ids) != b["ids_crc32"]:
            raise ValueError("a block does not match its checksum")
        made.append(ids)
    return b"".join(made)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            (row,) = batch.slice(i, 1).to_pylist()
            ids = memoryview(_unpack(row["blocks"]))
            counts = np.array(row["n_tokens"], np.int64)
            ends = np.cumsum(counts)
            cuts = (np.concatenate([[0], ends]) * ID_BYTES).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(counts), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first_id"] + ends - counts),
                    pa.array(counts),
                    pa.array([bytes(ids[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                schema=_DOCUMENT_ARROW,
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written table: doc_id, start (ids of all documents before), n_tokens, ids.

    ``ids`` is binary: little-endian unsigned 32-bit integers. Segments are decoded where
    they are read; nothing is shuffled but one total per shard.
    """
    segments = spark.read.schema(_SEGMENT).parquet(f"{path}/segments")
    starts = F.broadcast(_shard_starts(segments))
    return (
        segments.select("shard", "first_id", "doc_ids", "n_tokens", F.col("blocks"))
        .mapInArrow(_read, _DOCUMENT)
        .join(starts, "shard")
        .select("doc_id", (F.col("_shard_start") + F.col("first_id")).alias("start"), "n_tokens", "ids")
    )
