"""Near duplicates by SimHash, decided by shingles of five words; a prefix filter finds the rest exactly.

The groups of ``simhash.py``, fingerprints within three bits of each other, come first. In a
group all shingles decide: links connect what its similar texts connect. Similar texts
whose fingerprints are further apart are left to a prefix filter, which passes over what is
connected already, so no pair is lost and no fingerprint alone removes a text.

The shingles of every text are put in one order, rarest first by a sketch of their counts.
Two texts that reach the similarity have a shingle in common among the first of each: 20 % of
a text's shingles and one more at a similarity of 0.8. Any order is right, as long as it is
the same for all; a good one makes few texts meet. Copies of a text are reduced to one first.

Texts with such a shingle in common are a bucket. Near copies share many, so a text would
meet the same others again and again; therefore the buckets are gathered into cells. The largest
bucket of a text is its home. All texts of a bucket go into the cell of the home that most of
them have, so all pairs of a bucket meet in one cell, and most texts of a group of near copies
go into one cell only. In a cell all shingles decide, exactly; links that connect what the similar
pairs connect are all that leaves it, so a group of near copies gives fewer links than it has
texts, however many of its pairs are similar.

A group of fingerprints that is too large for a task is cut into blocks that share one of its
texts. What they leave apart goes on to the prefix filter. A cell that is too large for a task is cut into blocks. Each is compared on its own first. Of what
is not connected then, texts outside the cell's largest component go to all blocks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.functions.expressions import free_names
from proofline.functions.lookups import fits_broadcast, lookup_join
from proofline.llm import simhash, tables
from proofline.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SEED = 42
# counts of the sketch that orders the shingles, and the pieces that it is summed in
COUNTS, CHUNKS = 1 << 22, 64
# texts with one shingle in common up to which those without a possible partner are taken out at once
FEW = 16
# shingles that the texts in a block may have
BLOCK_SHINGLES = 200_000
# sketches that a task sums before their sums are summed
SKETCHES = 256
# rows of numbers that one Arrow batch hands to a Python worker
NUMBER_ROWS = 50_000
# for sums of floating-point numbers: a filter may let through a little more
SLACK = 1e-6


def _hashes(text: str, words: int) -> np.ndarray:
    """A hash of each shingle of a text; a shorter text is one shingle."""
    split = text.encode("utf-8").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    line = b" ".join(split)
    if len(split) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    bounds = zip(starts[: len(split) - words + 1].tolist(), ends[words - 1 :].tolist())
    return np.array([digest(line[a:b], SEED) for a, b in bounds], np.uint64)


def _keys(text) -> tuple:
    """128 bits that name a text."""
    return F.xxhash64(text).alias("key"), F.xxhash64(F.lit(SEED), text).alias("key2")


def _shingles(text: str) -> np.ndarray:
    """The different shingles of a text, sorted."""
    return np.unique(_hashes(text, SHINGLE_WORDS))


def _places(shingles: np.ndarray) -> np.ndarray:
    """Where the sketch counts each shingle."""
    return (shingles & np.uint64(COUNTS - 1)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sketch of one task's texts, in chunks."""
    counts = np.zeros(COUNTS, np.uint32)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            np.add.at(counts, _places(_shingles(text)), 1)
    yield _chunks({i: part for i, part in enumerate(np.split(counts, CHUNKS)) if part.any()})


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            held[chunk] = held.get(chunk, 0) + np.frombuffer(zlib.decompress(counts), "<u4")
    yield _chunks(held)


def _chunks(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    packed = [zlib.compress(np.minimum(c, 2**32 - 1).astype("<u4").tobytes(), 1) for c in held.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "counts"])


def frequencies(named: DataFrame) -> np.ndarray:
    """How often shingles occur in the texts, about: those that share a place are counted together."""
    schema = "chunk int, counts binary"
    # in two levels, so that no task sums the sketches of all others
    made = named.select("text").mapInArrow(_counted, schema).withColumn("part", F.floor(F.spark_partition_id() / SKETCHES))
    made = made.repartition("chunk", "part").select("chunk", "counts").mapInArrow(_summed, schema)
    made = made.repartition("chunk").mapInArrow(_summed, schema).toArrow()
    counts = np.zeros((CHUNKS, COUNTS // CHUNKS), np.uint32)
    for chunk, packed in zip(made.column("chunk").to_pylist(), made.column("counts").to_pylist()):
        counts[chunk] = np.frombuffer(zlib.decompress(packed), "<u4")
    return counts.reshape(-1)


def prefix(shingles: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in the common order, of which similar texts share one."""
    need = math.ceil(similarity * len(shingles) - SLACK)
    order = np.lexsort((shingles, counts[_places(shingles)]))
    return shingles[order[: max(0, len(shingles) - max(need, 1) + 1)]]


def _prefixed(shared, similarity: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(t) for t in batch.column("text").to_pylist()]
            firsts = [prefix(s, shared.value, similarity).astype("<u8").tobytes() for s in sets]
            columns = [*(batch.column(c) for c in ("doc_id", "key", "key2")), pa.array([len(s) for s in sets], pa.int32()), pa.array(firsts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "key2", "size", "firsts"])

    return scan


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each prefix, with its place."""
    # a text has very many: some texts at a time, however many a batch has
    for batch in (b.slice(at, tables.BATCH_ROWS) for b in batches for at in range(0, b.num_rows, tables.BATCH_ROWS)):
        firsts = [np.frombuffer(f, "<i8") for f in batch.column("firsts").to_pylist()]
        many = np.array([len(f) for f in firsts], np.int64)
        if many.sum():
            node, size = (np.repeat(batch.column(c).to_numpy(), many) for c in ("node", "size"))
            at = np.concatenate([np.arange(m, dtype=np.int32) for m in many])
            columns = [pa.array(np.concatenate(firsts)), pa.array(node), pa.array(size), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "node", "size", "at"])


def _possible(size, at, other_size, other_at, similarity: float) -> np.ndarray:
    """Can texts of these sizes with a first common shingle at these places be similar?"""
    fit = np.minimum(size, other_size) >= similarity * np.maximum(size, other_size) - SLACK
    rest = 1 + np.minimum(size - 1 - at, other_size - 1 - other_at)
    return fit & (rest >= similarity / (1 + similarity) * (size + other_size) - SLACK)


def _paired(similarity: float, few: int):
    """The rows of small buckets that a row not connected to them could be similar to; a bucket's rows follow each other."""

    def kept(rows: pa.Table) -> pa.RecordBatch:
        shingle, size, at, root = (rows.column(c).to_numpy() for c in ("shingle", "size", "at", "root"))
        keep = np.zeros(len(shingle), bool)
        for step in range(1, few):
            same = (shingle[step:] == shingle[:-step]) & (root[step:] != root[:-step])
            same &= _possible(size[step:], at[step:], size[:-step], at[:-step], similarity)
            keep[step:] |= same
            keep[:-step] |= same
        return rows.select(["shingle", "node", "n"]).filter(pa.array(keep)).combine_chunks()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            shingle = now.column("shingle").to_numpy()
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(shingle, shingle[-1])) if len(shingle) else 0
            yield from kept(now.slice(0, cut)).to_batches()
            rest = now.slice(cut)
        if rest is not None:
            yield from kept(rest).to_batches()

    return scan


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [_shingles(t).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], ["node", "shingles"])


def similar(common, size, other, similarity: float):
    """Have sets of these sizes with so much in common at least this Jaccard similarity?"""
    return common >= similarity * (size + other - common)


def similar_pairs(sets: list[np.ndarray], similarity: float, root: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sorted sets that connect all pairs with at least this Jaccard similarity.

    ``root`` names what is connected already; no link connects anything twice.
    """
    if len(sets) < 2:
        return []
    root = np.arange(len(sets)) if root is None else np.unique(root, return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
    # of each shingle that several have, who has it: one run of ``having`` for each
    shared = (np.bincount(shingle) > 1)[shingle]
    owner, shingle = owner[shared], shingle[shared]
    by = np.argsort(shingle, kind="stable")
    having = owner[by]
    start = np.searchsorted(shingle[by], shingle, side="left")
    many = np.searchsorted(shingle[by], shingle, side="right") - start
    bounds = np.searchsorted(owner, np.arange(len(sets) + 1))
    found = []
    for i in range(len(sets) - 1):
        if (root[i + 1 :] == root[i]).all():
            continue
        own = slice(bounds[i], bounds[i + 1])
        if own.start == own.stop:
            continue
        ends = np.cumsum(many[own])
        places = np.arange(ends[-1]) + np.repeat(start[own] - ends + many[own], many[own])
        common = np.bincount(having[places], minlength=len(sets))
        common[: i + 1] = 0
        hits = np.flatnonzero((common > 0) & (root != root[i]) & similar(common, sizes[i], sizes, similarity))
        if len(hits):
            others, first = np.unique(root[hits], return_index=True)
            found += [(i, j) for j in hits[first].tolist()]
            root[np.isin(root, others)] = root[i]
    return found


def _compared(similarity: float):
    """Links of each cell's block; rows of one block follow each other."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        here = None

        def links() -> pa.RecordBatch:
            sets = [np.frombuffer(x[1], "<u8") for x in held]
            found = similar_pairs(sets, similarity, np.array([x[2] for x in held], np.int64))
            ends = [pa.array([held[pair[side]][0] for pair in found], pa.int64()) for side in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, ["a", "b"])

        for batch in batches:
            for *place, node, shingles, root in zip(*(batch.column(c).to_pylist() for c in ("cell", "block", "node", "shingles", "root"))):
                if place != here:
                    if len(held) > 1:
                        yield links()
                    held, here = [], place
                held.append((node, shingles, root))
        if len(held) > 1:
            yield links()

    return scan


def _within(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) among the texts of each cell's block; members: cell, block, node, root."""
    dealt = members.join(sets, "node").repartition("cell", "block").sortWithinPartitions("cell", "block", "node")
    return tables.stored(dealt.select("cell", "block", "node", "shingles", "root").mapInArrow(_compared(similarity), "a long, b long"), "links")


def _sets(nodes: DataFrame, single: DataFrame, named: DataFrame) -> DataFrame:
    """(node, shingles) of these nodes: one text of each, and only these, is read again."""
    wanted = tables.stored(single.join(nodes, "node").select("node", "first.doc_id", "first.key", "first.key2"), "wanted").alias("w")
    here = named.select("doc_id", "text", *_keys(F.col("text"))).alias("h")
    same = F.col("h.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("h.key") == F.col("w.key")) & (F.col("h.key2") == F.col("w.key2"))
    # a few names spare the texts a shuffle
    met = here.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, same).select("w.node", "h.text").mapInArrow(_shingled, "node long, shingles binary")
    # rows that repeat a doc_id with its text come more than once
    return tables.stored(met.dropDuplicates(["node"]), "shingles")


def _cut(cells: DataFrame, single: DataFrame) -> DataFrame:
    """(cell, blocks) of the cells that are too large for a task."""
    sized = cells.join(single.select("node", "size"), "node").groupBy("cell").agg(F.sum(F.col("size") + 1).alias("size"))
    cut = sized.where(F.col("size") > BLOCK_SHINGLES).select("cell", F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    return tables.stored(cut, "cut")


def _dealt(cells: DataFrame, cut: DataFrame) -> DataFrame:
    """``cells`` with the block of each node and the number of its cell's blocks."""
    dealt = lookup_join(cells, cut, ["cell"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def _groups(single: DataFrame, named: DataFrame) -> DataFrame:
    """(cell, node, anchor): the texts of each SimHash group of several; all of a group know one of them."""
    groups = single.join(simhash.groups(named), "key").select(F.col("root").alias("cell"), "node")
    groups = tables.stored(groups, "groups")
    several = groups.groupBy("cell").agg(F.count("*").alias("n"), F.min("node").alias("anchor")).where("n > 1")
    found = lookup_join(groups, tables.stored(several.drop("n"), "several"), ["cell"], "inner")
    return tables.stored(found.select("cell", "node", "anchor"), "groups")


def _near(groups: DataFrame, single: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between similar texts of a SimHash group."""
    dealt = _dealt(groups, _cut(groups, single))
    # one text of a group goes to all its blocks, so that near copies of it are connected across them
    blocks = F.when(F.col("node") == F.col("anchor"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    members = dealt.select("cell", F.explode(blocks).alias("block"), "node", F.col("node").alias("root"))
    return _within(members, sets, similarity)


def _cells(single: DataFrame, similarity: float, rooted: DataFrame | None = None) -> DataFrame:
    """(cell, node): every two texts that can be similar by a first shingle in common are in one cell together.

    Pairs that ``rooted`` (node, root) names as connected already need not be.
    """
    posted = single.select("node", "size", "firsts").mapInArrow(_postings, "shingle long, node long, size int, at int")
    shared = tables.stored(posted.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    all_met = tables.stored(lookup_join(posted, shared, ["shingle"], "inner").select("shingle", "node", "size", "at", "n"), "shared")
    if rooted is not None:
        all_met = lookup_join(all_met, rooted, ["node"])
    root = F.col("node") if rooted is None else F.coalesce("root", "node")
    all_met = all_met.select("shingle", "node", "size", "at", "n", root.alias("root"))
    small = all_met.where(F.col("n") <= FEW).repartition("shingle").sortWithinPartitions("shingle")
    small = small.mapInArrow(_paired(similarity, FEW), "shingle long, node long, n long")
    large = tables.stored(all_met.where(F.col("n") > FEW).select("shingle", "node", "n", "root"), "large")
    apart = large.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    large = lookup_join(large, tables.stored(apart.select("shingle"), "apart"), ["shingle"], "inner").select("shingle", "node", "n")
    met = tables.stored(large.unionByName(small), "met")
    home = met.groupBy("node").agg(F.max(F.struct("n", "shingle"))["shingle"].alias("home"))
    placed = tables.stored(met.join(home, "node").select("shingle", "node", "home"), "placed")
    counted = placed.groupBy("shingle", "home").agg(F.count("*").alias("n"))
    most = counted.groupBy("shingle").agg(F.max(F.struct("n", "home"))["home"].alias("cell"))
    found = lookup_join(placed.select("shingle", "node"), tables.stored(most, "most"), ["shingle"], "inner")
    return tables.stored(found.select("cell", "node").distinct(), "cells")


def _links(single: DataFrame, named: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect what the pairs of similar texts connect."""
    groups = _groups(single, named)
    sets = _sets(groups.select("node").distinct(), single, named)
    near = _near(groups, single, sets, similarity)
    rooted = components(near).select(F.col("vertex").alias("node"), F.col("component").alias("root"))
    rooted = tables.stored(rooted, "roots")
    with tables.batch_rows(single.sparkSession, NUMBER_ROWS):
        cells = _cells(single, similarity, rooted)
    others = cells.select("node").distinct().join(sets.select("node"), "node", "left_anti")
    sets = sets.unionByName(_sets(others, single, named))
    cut = _cut(cells, single)
    dealt = lookup_join(_dealt(cells, cut), rooted, ["node"]).withColumn("root", F.coalesce("root", "node"))
    dealt = tables.stored(dealt, "dealt")
    links = near.unionByName(_within(dealt.select("cell", "block", "node", "root"), sets, similarity))
    if cut.isEmpty():
        return links
    # between the blocks of a cell: what is outside its largest component meets everything
    rooted = components(links)
    many = dealt.drop("root").where("blocks > 1").join(rooted, F.col("node") == F.col("vertex"), "left")
    many = tables.stored(many.select("cell", "node", "block", "blocks", F.coalesce("component", "node").alias("root")), "many")
    counted = many.groupBy("cell", "root").agg(F.count("*").alias("n"))
    largest = counted.groupBy("cell").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    apart = lookup_join(many, tables.stored(largest.where("roots > 1").drop("roots"), "largest"), ["cell"], "inner")
    blocks = F.when(F.col("root") == F.col("main"), F.array("block")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    apart = apart.select("cell", F.explode(blocks).alias("block"), "node", "root")
    return links.unionByName(_within(apart, sets, similarity))


def without_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near copies, that with the least doc_id.

    A group is what links connect: texts whose shingles of five words (lower-cased, with
    repeated ones once; a shorter text is one shingle) have a Jaccard similarity of at least
    ``similarity``. SimHash finds such texts first, the prefix filter the others. Texts without words, null ones among them, are copies of each other.
    Null doc_ids come last; among rows that share a doc_id the one with the least hash of its
    text stays, and of rows that share that too, any one. All columns are kept; an empty
    table gives an empty one.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    # all texts without words are one
    plain = F.when(F.trim(F.regexp_replace(text, r"[\t-\r]", " ")) == "", F.lit("")).otherwise(text)
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), plain.alias("text"))
    keys = _keys(F.col("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(named))
    schema = "doc_id long, key long, key2 long, size int, firsts binary"
    rows = tables.stored(named.select("doc_id", *keys, "text").mapInArrow(_prefixed(shared, similarity), schema), "prefixes")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "key2")
    single = rows.groupBy("key", "key2").agg(F.min(order).alias("first"), F.any_value("size").alias("size"), F.any_value("firsts").alias("firsts"))
    single = tables.stored(single.withColumn("node", F.monotonically_increasing_id()), "texts")
    rooted = components(_links(single, named, similarity))
    root = F.coalesce("component", "node").alias("root")
    kept = single.join(rooted, F.col("node") == F.col("vertex"), "left").groupBy(root).agg(F.min("first").alias("first"))
    kept = kept.select("first.doc_id", "first.key", "first.key2")
    many = rows.groupBy("doc_id", "key", "key2").agg(F.count("*").alias("n"))
    both = kept["doc_id"].eqNullSafe(many["doc_id"]) & (kept["key"] == many["key"]) & (kept["key2"] == many["key2"])
    stay = kept.join(many, both).select(*(kept[c].alias(f"kept_{c}") for c in ("doc_id", "key", "key2")), many["n"].alias("kept_n"))
    stay = tables.stored(stay, "kept")
    # names that no column of the table has
    names = free_names(docs, stay.columns)
    stay = stay.toDF(*names)
    doc_id, key, key2, n = (F.col(c) for c in names)
    text_key, text_key2 = _keys(plain)
    mine = docs["doc_id"].cast("long").eqNullSafe(doc_id) & (text_key == key) & (text_key2 == key2)
    once = docs.join(stay.where(n == 1), mine, "left_semi")
    # those that stay although their doc_id and text are not theirs alone: as a rule none
    repeated = docs.join(stay.where(n > 1), mine, "inner").dropDuplicates(names[:3])
    return once.unionByName(repeated.drop(*names))
