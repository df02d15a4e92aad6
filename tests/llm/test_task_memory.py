"""What a task holds at once is bounded, however many rows a batch has."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from proofline.llm import neardups, quality, simhash

DRAW = np.random.default_rng(5)


def _most(task, batch):
    """Most MB of numpy's and Python's that the task holds beside its input, and the rows of its largest batch."""
    rows = 0
    tracemalloc.start()
    try:
        for made in task(iter([batch])):
            rows = max(rows, made.num_rows)
        return tracemalloc.get_traced_memory()[1] / 1e6, rows
    finally:
        tracemalloc.stop()


def _words():
    lists = [DRAW.integers(0, quality.ROWS, 330, dtype=np.int32) for _ in range(500)]
    return pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["words"])


def _prints():
    return pa.RecordBatch.from_arrays([pa.array(DRAW.integers(-(2**63), 2**63 - 1, 20_000))], ["fingerprint"])


def _bucketed():
    buckets = np.sort(DRAW.integers(0, 10, 5000))
    columns = [buckets, DRAW.integers(0, 1 << 40, 5000), np.ones(5000, bool)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "fingerprint", "home"])


def _firsts():
    firsts = [DRAW.integers(0, 1 << 62, 60).tobytes() for _ in range(20_000)]
    columns = [pa.array(np.arange(20_000)), pa.array(np.full(20_000, 300, np.int32)), pa.array(firsts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["node", "size", "firsts"])


@pytest.mark.parametrize(
    "task, batch, most_mb, most_rows",
    [
        # the sums themselves take 9 MB
        (quality._contexts, _words, 40, 2000),
        (simhash._keyed(False), _prints, 16, 200_000),
        (simhash._linker(3), _bucketed, 40, 5000),
        (neardups._postings, _firsts, 16, 100_000),
    ],
    ids=["contexts", "keyed", "linker", "postings"],
)
def test_task_holds_little(task, batch, most_mb, most_rows):
    held, rows = _most(task, batch())
    assert held < most_mb and rows <= most_rows


def test_contexts_are_sums_of_index_vectors():
    lists = [DRAW.integers(0, 40, n).tolist() for n in (0, 1, 2, 3, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["words"])
    places, signs = quality.index_vectors()
    want = np.zeros((quality.ROWS, quality.SIZE + 1), np.int64)
    for words in lists:
        for i, word in enumerate(words):
            want[word, quality.SIZE] += 1
            for j in range(max(0, i - quality.NEAR), min(len(words), i + quality.NEAR + 1)):
                if j != i:
                    np.add.at(want[word], places[words[j]], signs[words[j]])
    made = pa.Table.from_batches(list(quality._contexts(iter([batch]))))
    found = np.zeros_like(want)
    found[made.column("key").to_numpy()] = [np.frombuffer(v, "<i8") for v in made.column("vector").to_pylist()]
    assert np.array_equal(found, want)


def test_keys_do_not_depend_on_slices(monkeypatch):
    batch = _prints().slice(0, 300)
    whole = sorted(r for b in simhash._keyed(False)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns)))
    monkeypatch.setattr(simhash, "KEY_ROWS", 7)
    assert sorted(r for b in simhash._keyed(False)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))) == whole
