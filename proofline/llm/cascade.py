"""URL filters as cascades of Bloom filters.

Listed keys go into a first Bloom filter. Of all keys that occur in the corpus, those that
pass although they are not listed go into a second one, listed keys that pass the second
into a third, and so on, until none is left. For every key of the corpus the first level
that it does not pass tells exactly whether it is listed; no table is joined to judge
the URLs. The first level is made so strict that about as many keys pass wrongly as are
listed, so a cascade takes some bits for each listed key and its size follows the list,
not the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import tables

# the most that the filters of one pass over the URLs may take; longer lists take more passes
MAX_BYTES = 64 << 20
LATER_RATE = 0.5
BATCH = 10_000


@dataclass(frozen=True)
class Bloom:
    bits: np.ndarray
    hashes: int
    seed: int

    @staticmethod
    def shape(keys: int, rate: float) -> tuple[int, int]:
        """The number of bits, a multiple of 64, and of hashes."""
        size = max(1, math.ceil(-keys * math.log(rate) / math.log(2) ** 2 / 64)) * 64
        return size, max(1, round(size / max(1, keys) * math.log(2)))

    @staticmethod
    def places(key: str, size: int, hashes: int, seed: int) -> list[int]:
        mixed = xxhash.xxh3_128_intdigest(key.encode("utf-8"), seed)
        low, step = mixed & (2**64 - 1), (mixed >> 64) | 1
        return [(low + i * step) % size for i in range(hashes)]

    def __contains__(self, key: str) -> bool:
        bits = self.bits
        return all(bits[p >> 6] >> np.uint64(p & 63) & np.uint64(1) for p in self.places(key, len(bits) * 64, self.hashes, self.seed))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1


def _bloom(keys: DataFrame, count: int, rate: float, seed: int) -> Bloom:
    """Set the bits where the keys are; a task sends each word of the filter once at most."""
    size, hashes = Bloom.shape(count, rate)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, int] = {}
        for batch in batches:
            for key in batch.column("key").to_pylist():
                for p in Bloom.places(key, size, hashes, seed):
                    words[p >> 6] = words.get(p >> 6, 0) | 1 << (p & 63)
        at = np.fromiter(words.keys(), np.int64, len(words))
        value = np.fromiter(words.values(), np.uint64, len(words))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value.view(np.int64))], ["at", "word"])

    words = keys.select("key").mapInArrow(scan, "at long, word long").groupBy("at").agg(F.expr("bit_or(word)").alias("word"))
    bits = np.zeros(size // 64, np.uint64)
    made = words.toArrow()
    bits[made.column("at").to_numpy()] = made.column("word").to_numpy().view(np.uint64)
    return Bloom(bits, hashes, seed)


def _passing(keys: DataFrame, level: Bloom) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("key")
            yield batch.filter(pa.array([k in level for k in column.to_pylist()], pa.bool_()))

    return keys.select("key").mapInArrow(scan, "key string")


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade that tells the keys of ``listed`` from all other keys of ``universe``.

    Both have a string column ``key`` without nulls; keys may repeat, and the universe is
    never shuffled as a whole: only the few that pass a level wrongly are.
    """
    inside = tables.stored(listed.select("key").distinct(), "listed")
    count = inside.count()
    if not count:
        return Cascade(())
    others = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(LATER_RATE, count / max(1, others))
    levels = [_bloom(inside, count, rate, seed=0)]
    wrong = _passing(universe, levels[0]).distinct().join(inside, "key", "left_anti")
    while True:
        wrong = tables.stored(wrong, "passing")
        count = wrong.count()
        if not count:
            return Cascade(tuple(levels))
        levels.append(_bloom(wrong, count, LATER_RATE, seed=len(levels)))
        inside, wrong = wrong, _passing(inside, levels[-1])


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both are empty for null and where ``://`` is missing."""
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    stop = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    return rest[:cut].encode("utf-8").lower().decode("utf-8"), rest[cut:stop]


def candidates(host: str, path: str, labels: set[int], lengths: list[int]) -> list[str]:
    """The keys that a rule for this URL can have, longest first and longer hosts first among equals.

    Only hosts with as many labels, and paths as long, as some rule has are looked at.
    """
    parts = host.split(".")
    hosts = [".".join(parts[i:]) for i in range(len(parts)) if len(parts) - i in labels]
    keys = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return [key for _, _, key in sorted(keys, reverse=True)]


def _order(key: str) -> tuple[int, int]:
    """Longer keys first, then longer hosts; a path is empty or begins with a slash."""
    return len(key), len(key.partition("/")[0])


def _keys_of(labels: set[int], lengths: list[int], part: Callable[[str], bool]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # most URLs of a batch share their hosts
            seen: dict[str, None] = {}
            for url in batch.column("url").to_pylist():
                seen.update(dict.fromkeys(candidates(*split_url(url), labels, lengths)))
            yield pa.RecordBatch.from_arrays([pa.array([k for k in seen if part(k)], pa.string())], ["key"])

    return scan


def _judge(lists: dict[str, Cascade], labels: set[int], lengths: list[int], part: Callable[[str], bool]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, rules, verdicts = [], [], [], []
            for url, rule, verdict in zip(*(batch.column(c).to_pylist() for c in ("url", "rule", "verdict"))):
                host, path = split_url(url)
                keys = [k for k in candidates(host, path, labels, lengths) if part(k)]
                for key in keys:
                    fits = next((v for v, c in lists.items() if key in c), None)
                    if fits:
                        # an earlier pass may have found a longer one
                        if rule is None or _order(key) > _order(rule):
                            rule, verdict = key, fits
                        break
                hosts.append(host)
                paths.append(path)
                rules.append(rule)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), *(pa.array(x, pa.string()) for x in (hosts, paths, rules, verdicts))],
                ["page_id", "url", "host", "path", "rule", "verdict"],
            )

    return scan


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits its host and
    all its subdomains where the path begins with the rule's; the longest rule (host and
    path) decides, of equally long ones the one with the longer host; a rule that is
    both allowed and blocked blocks. URLs that no rule fits get ``otherwise`` and a null
    rule, as do null URLs and those without ``://``, which also have an empty host and
    path. Null ids and repeated rows give a row each; empty tables of pages or rules work.
    Rules with a null host, path or verdict are left out. Other columns are not looked at.

    The filters of one pass take at most about ``max_bytes``; a longer list is dealt into
    parts by a hash of its keys, and the URLs pass the parts one after another.
    """
    spark = pages.sparkSession
    known = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.concat("host", "path").alias("key"), "verdict", F.size(F.split("host", "\\.")).alias("n"), F.length("path").alias("m")
    )
    known = tables.stored(known, "rules")
    count, sizes, spans = known.agg(F.count("*"), F.collect_set("n"), F.collect_set("m")).first()
    labels, lengths = set(sizes), sorted(spans)
    urls = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"))
    with tables.batch_rows(spark, BATCH):
        reached = urls.select("url").mapInArrow(_keys_of(labels, lengths, lambda key: True), "key string")
        others = reached.agg(F.approx_count_distinct("key")).first()[0] if count else 0
        # bits of the first level and about four for the others, for each listed key
        wanted = count * (1.45 * max(1.0, math.log2(max(1, others) / max(1, count))) + 4) / 8
        parts = max(1, math.ceil(wanted / max_bytes))
        judged = urls.withColumns({c: F.lit(None).cast("string") for c in ("host", "path", "rule", "verdict")})
        for number in range(parts):
            mine = _part(number, parts)
            some = known.where(_part_of(F.col("key"), parts) == number)
            universe = urls.select("url").mapInArrow(_keys_of(labels, lengths, mine), "key string")
            lists = {v: build(some.where(F.col("verdict") == v), universe) for v in ("block", "allow")}
            judged = judged.mapInArrow(
                _judge(lists, labels, lengths, mine), "page_id long, url string, host string, path string, rule string, verdict string"
            )
            if parts > 1:
                judged = tables.stored(judged, "judged")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(otherwise)))


def _part_of(key, parts: int):
    return F.pmod(F.crc32(key), F.lit(parts))


def _part(number: int, parts: int) -> Callable[[str], bool]:
    import zlib

    return lambda key: parts == 1 or zlib.crc32(key.encode("utf-8")) % parts == number
