"""The gate on a stream gives the rows and verdicts of the batch checks."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from proofline.operators.contract import split_valid
from proofline.streaming.gate_stream import gate_stream
from registered.streams import EVENT_RULES


def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("ok", "bad", "log", "checkpoint")}


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_totals_equal_batch_totals(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    source = str(tmp_path / "in")
    events.repartition(4).write.parquet(source)
    out = folders(tmp_path)
    gate_stream(stream_of(spark, source, events.schema), EVENT_RULES, **out).awaitTermination()
    ok, bad = split_valid(events, EVENT_RULES)
    assert spark.read.parquet(out["ok"]).count() == ok.count()
    assert spark.read.parquet(out["bad"]).count() == bad.count()
    log = spark.read.json(out["log"])
    assert log.count() == 4
    assert log.agg(F.sum("n_rows")).first()[0] == events.count()
    assert {r["decision"] for r in log.collect()} == {"block"}

    # later files are checked by a restarted query, earlier ones are not read again
    events.limit(10).coalesce(1).write.mode("append").parquet(source)
    gate_stream(stream_of(spark, source, events.schema), EVENT_RULES, **out).awaitTermination()
    log = spark.read.json(out["log"])
    assert log.agg(F.sum("n_rows")).first()[0] == events.count() + 10


def test_hard_block_stops_before_rows_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0)], "k int, value double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = folders(tmp_path)
    run = gate_stream(
        stream_of(spark, str(tmp_path / "in"), df.schema), {"positive": "value > 0"}, **out, hard_block=True
    )
    with pytest.raises(StreamingQueryException):
        run.awaitTermination()
    assert spark.read.parquet(out["bad"]).count() == 1
    assert spark.read.json(out["log"]).first()["decision"] == "block"
    assert not (tmp_path / "ok").exists()
