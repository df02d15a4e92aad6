"""C17: events replayed as a stream of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators.contract import Contract
from proofline.session import scratch_path
from proofline.streaming.gate_stream import gate_stream
from registered.base import query, table

EVENT_RULES = {
    "positive_value": "value > 10",
    "known_type": "event_type IN ('click', 'view', 'signup', 'purchase')",
}
RULES_SQL = " AND ".join(f"({r})" for r in EVENT_RULES.values())


@query(
    "gated_stream",
    f"""SELECT CASE WHEN {RULES_SQL} THEN 'ok' ELSE 'bad' END AS side, event_type, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY ALL""",
)
def gated_stream(spark, sf):
    folders = {name: scratch_path(spark, f"stream-{name}") for name in ("in", "ok", "bad", "log", "state")}
    events = table(spark, sf, "events")
    # the same events as files that arrive in several batches
    events.withColumn("kind", F.col("event_type")).write.partitionBy("kind").parquet(folders["in"])
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 2)
        .option("recursiveFileLookup", "true")
        .parquet(folders["in"])
    )
    run = gate_stream(
        stream, EVENT_RULES, folders["ok"], folders["bad"], folders["log"], folders["state"], Contract()
    )
    run.awaitTermination()
    sides = [
        spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(folders[name]).select(
            F.lit(name).alias("side"), "event_type", "event_id"
        )
        for name in ("ok", "bad")
    ]
    return sides[0].unionByName(sides[1]).groupBy("side", "event_type").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id")
    )
