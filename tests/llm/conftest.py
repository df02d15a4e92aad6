from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with more columns whose names may clash."""

    def make(rows, extra="shard string, piece int, score double, kind string", n=4):
        full = [(i, t, None, None, None, "x", None, None) for i, t in rows]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
        width = len(schema.split(","))
        return spark.createDataFrame([r[:5] + (None,) * (width - 5) for r in full], schema).repartition(n)

    return make
