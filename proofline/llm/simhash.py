"""SimHash near duplicates, searched by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each a word of the binary Golay code of
length 23 with leading zeros. Every word of that code lies within three bits of exactly one
codeword. Two fingerprints that differ in at most three bits have two segments that
differ in at most one bit each (three bits cannot spoil two segments more than that). A
segment therefore has as keys the codewords of itself and of all words one bit away: six
at most, and the codeword of one fingerprint's segment is always among the keys of the
other's. Fingerprints that share the keys of two segments are compared, and only pairs
within the allowed bits are linked.

Copies of a fingerprint are reduced to one before the search. A bucket of keys is never
expanded into pairs of rows: its links are reduced to a spanning forest where they are
found, and a bucket above ``BUCKET_ROWS`` is dealt out as blocks whose pairs are compared
in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.functions.lookups import lookup_join
from proofline.llm import tables
from proofline.llm.components import components, forest

# fixed values: the generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101
WORD_BITS, INFO_BITS, CHECK_BITS = 23, 12, 11

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
# where the segments of a fingerprint begin, and how many bits they have
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SEGMENT_PAIRS = ((0, 1), (0, 2), (1, 2))
# home rows of a bucket (one third of a key each fingerprint) from which on it is dealt out
BUCKET_ROWS = 4096
# pairs that a task compares at once
PAIRS = 1 << 19
KEY_BATCH = 20_000
# fingerprints whose keys a task makes at once: each has about 85
KEY_ROWS = 1000


def _remainders() -> np.ndarray:
    """The remainder by the generator of every single bit of a word."""
    made = []
    for bit in range(WORD_BITS):
        word = 1 << bit
        for high in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
            if word >> high & 1:
                word ^= GENERATOR << (high - CHECK_BITS)
        made.append(word)
    return np.array(made, np.int64)


def _xor_table(parts: np.ndarray) -> np.ndarray:
    made = np.zeros(1, np.int64)
    for part in parts:
        made = np.concatenate([made, made ^ part])
    return made


def _errors() -> np.ndarray:
    """The least error that explains each of the 2,048 remainders."""
    made = np.zeros(1 << CHECK_BITS, np.int64)
    bits = [1 << b for b in range(WORD_BITS)]
    rest = _remainders()
    for i in range(WORD_BITS):
        made[rest[i]] = bits[i]
        for j in range(i):
            made[rest[i] ^ rest[j]] = bits[i] | bits[j]
            for k in range(j):
                made[rest[i] ^ rest[j] ^ rest[k]] = bits[i] | bits[j] | bits[k]
    return made


_LOW = _xor_table(_remainders()[:INFO_BITS])
_HIGH = _xor_table(_remainders()[INFO_BITS:])
_ERRORS = _errors()


def decode(words: np.ndarray) -> np.ndarray:
    """The number (0 .. 4095) of the codeword nearest to each 23-bit word."""
    rest = _LOW[words & ((1 << INFO_BITS) - 1)] ^ _HIGH[words >> INFO_BITS]
    return (words ^ _ERRORS[rest]) >> CHECK_BITS


def segment_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word the different codewords of itself and of the words one bit away.

    Returns a matrix whose first column is the word's own codeword, and which of its
    entries are the first of their kind.
    """
    if not bits:
        return decode(words)[:, None], np.ones((len(words), 1), bool)
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    near = decode(words[:, None] ^ flips)
    order = np.argsort(near[:, 1:], axis=1)
    ranked = np.take_along_axis(near[:, 1:], order, axis=1)
    new = np.concatenate([np.ones((len(words), 1), bool), ranked[:, 1:] != ranked[:, :-1]], axis=1)
    new &= ranked != near[:, :1]
    width = int(new.sum(axis=1).max(initial=0))
    place = np.argsort(~new, axis=1, kind="stable")[:, :width]
    keys = np.concatenate([near[:, :1], np.take_along_axis(ranked, place, axis=1)], axis=1)
    valid = np.concatenate([np.ones((len(words), 1), bool), np.take_along_axis(new, place, axis=1)], axis=1)
    return keys, valid


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it; 0 for a text without words."""
    split = text.encode("utf-8").lower().split()
    if not split:
        return 0
    line = b" ".join(split)
    if len(split) <= words:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    bounds = zip(starts[: len(split) - words + 1].tolist(), ends[words - 1 :].tolist())
    hashes = np.array([digest(line[a:b], seed) for a, b in bounds], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprinter(words: int, seed: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, words, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(made.view(np.int64))], ["doc_id", "key", "fingerprint"]
            )

    return scan


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, key (a hash of the text) and the fingerprint (the 64 bits as a long) of every row."""
    named = tables.texts(docs).withColumn("key", F.xxhash64("text"))
    return named.mapInArrow(_fingerprinter(words, seed), "doc_id long, key long, fingerprint long")


def keys_of(prints: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of fingerprints (unsigned): key, number of the fingerprint, is it its own codewords' key."""
    made = [
        segment_keys(((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64), 0 if own else bits)
        for at, bits in SEGMENTS
    ]
    parts = []
    for number, (i, j) in enumerate(SEGMENT_PAIRS):
        (left, left_valid), (right, right_valid) = made[i], made[j]
        keys = (number << (2 * INFO_BITS)) | (left[:, :, None] << INFO_BITS) | right[:, None, :]
        valid = left_valid[:, :, None] & right_valid[:, None, :]
        home = np.zeros_like(valid)
        home[:, 0, 0] = True
        row = np.broadcast_to(np.arange(len(prints))[:, None, None], valid.shape)
        parts.append((keys[valid], row[valid], home[valid]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _keyed(own: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            for at in range(0, len(many), KEY_ROWS):
                prints = many[at : at + KEY_ROWS]
                keys, rows, home = keys_of(prints.view(np.uint64), own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int32)), pa.array(prints[rows]), pa.array(home)], ["key", "fingerprint", "home"]
                )

    return scan


def _within(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size in turn."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _bucket_links(group: np.ndarray, prints: np.ndarray, home: np.ndarray, max_bits: int):
    """Links between the home rows and all rows of each group; rows are ordered by group."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(group)]]))
    number = np.repeat(np.arange(len(first)), sizes)
    rows = np.flatnonzero(home & (sizes[number] > 1))
    many = sizes[number[rows]]
    done = 0
    while done < len(rows):
        # as many home rows as make up the pairs of one go; at least one, whose bucket is in memory anyway
        upto = max(done + 1, done + int(np.searchsorted(np.cumsum(many[done : done + PAIRS]), PAIRS, "right")))
        here, count = rows[done:upto], many[done:upto]
        left = np.repeat(prints[here], count)
        right = prints[np.repeat(first[number[here]], count) + _within(count)]
        near = (np.bitwise_count(left ^ right) <= max_bits) & (left != right)
        if near.any():
            yield forest(left[near].view(np.int64), right[near].view(np.int64))
        done = upto


def _linker(max_bits: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        rest = None

        def keep(links) -> None:
            found.extend(links)
            if len(found) > 64:
                # what is known so far fits into one link for each fingerprint
                found[:] = [forest(*map(np.concatenate, zip(*found)))]

        for batch in batches:
            now = [
                batch.column("bucket").to_numpy(zero_copy_only=False),
                batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64),
                batch.column("home").to_numpy(zero_copy_only=False),
            ]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            keep(_bucket_links(*[x[:cut] for x in now], max_bits))
            rest = [x[cut:] for x in now]
        if rest is not None:
            keep(_bucket_links(*rest, max_bits))
        if found:
            a, b = forest(*map(np.concatenate, zip(*found)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return scan


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect what the pairs of ``prints`` within ``max_bits`` connect.

    ``prints`` has different fingerprints as longs. ``max_bits`` is at most 3, the number
    that the keys are made for.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find up to {MAX_BITS} bits, not {max_bits}")
    spark = prints.sparkSession
    with tables.batch_rows(spark, KEY_BATCH):
        schema = "key int, fingerprint long, home boolean"
        homes = prints.mapInArrow(_keyed(True), schema).groupBy("key").agg(F.count("*").alias("n"))
        large = homes.where(F.col("n") > BUCKET_ROWS).select("key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("blocks"))
        large = tables.stored(large, "buckets")
        keyed = prints.mapInArrow(_keyed(False), schema).join(large, "key", "left")
        blocks = F.coalesce("blocks", F.lit(1))
        block = F.pmod(F.xxhash64("fingerprint"), blocks).cast("long")
        other = F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")))
        dealt = keyed.select("key", "fingerprint", "home", block.alias("block"), other.alias("other")).select(
            # the key and the pair of blocks
            (
                F.shiftleft(F.col("key").cast("long"), 32)
                + F.shiftleft(F.least("block", "other"), 16)
                + F.greatest("block", "other")
            ).alias("bucket"),
            "fingerprint",
            "home",
        )
        found = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_linker(max_bits), "a long, b long")
        return tables.stored(found, "links")


def _classes(docs: DataFrame, words: int, max_bits: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and of each fingerprint its root and the root's component_id."""
    prints = tables.stored(fingerprints(docs, words, seed), "fingerprints")
    single = tables.stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    rooted = components(links(single.select("fingerprint"), max_bits))
    named = single.join(rooted, F.col("fingerprint") == F.col("vertex"), "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("root")
    )
    named = tables.stored(named, "roots")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints, named.join(ids, "root").select("fingerprint", "root", "component_id")


def groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """(key, root): the hash of every text and a fingerprint that names its group.

    Groups are those of ``near_duplicates``, without rows: copies of a text are one.
    """
    prints, classes = _classes(docs, words, max_bits, seed)
    texts = tables.stored(prints.select("key", "fingerprint").distinct(), "texts")
    return lookup_join(texts, tables.stored(classes.select("fingerprint", "root"), "roots"), ["fingerprint"], "inner").select("key", "root")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits;
    component_id is the least doc_id that can be reached. Texts without words (null, empty
    or blank) have fingerprint zero and are linked like any other. Null doc_ids are never
    a component_id unless all of a component are null; repeated rows give a row each; an
    empty table gives none. Other columns are not looked at.
    """
    prints, classes = _classes(docs, words, max_bits, seed)
    return prints.join(classes.drop("root"), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
