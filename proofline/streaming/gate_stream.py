"""The contract on every micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from proofline.functions.longform import rows_of
from proofline.operators.contract import (
    CHECKS,
    Contract,
    ContractBlocked,
    failed_rules,
    gate,
    run_contract,
)


def rule_violations(marked: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """One violation per row rule that some row breaks, from one aggregate."""
    names = list(rules)
    broken = F.split("failed_rules", ",")
    counts = marked.agg(*[F.count_if(F.array_contains(broken, r)).alias(f"r{i}") for i, r in enumerate(names)])
    entries = [
        {
            "seq": F.lit(len(CHECKS) + i),
            "check": F.lit("row_rule"),
            "column_name": F.lit(r),
            "n": F.col(f"r{i}"),
            "severity": F.lit("block"),
            "message": F.concat(F.lit(f"Rule '{r}' is broken by "), F.col(f"r{i}"), F.lit(" rows")),
        }
        for i, r in enumerate(names)
    ]
    return rows_of(counts, entries).where(F.col("n") > 0)


def gate_stream(
    stream: DataFrame,
    rules: Mapping[str, Column | str],
    ok: str,
    bad: str,
    log: str,
    checkpoint: str,
    contract: Contract | None = None,
    hard_block: bool = False,
) -> StreamingQuery:
    """C17: good rows to ``ok``, the rest to ``bad``, one verdict per batch to ``log``.

    Each batch writes its own folder and overwrites it on a retry, so a restarted query
    leaves no row twice. With ``hard_block`` a blocked batch passes no row and stops the
    query once its quarantine and verdict are written.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("failed_rules", failed_rules(rules)).persist()
        try:
            violations = rule_violations(marked, rules)
            if contract is not None:
                violations = violations.unionByName(run_contract(marked.drop("failed_rules"), contract))
            verdict = gate(violations).first()
            folder = f"batch_id={batch_id}"
            broken = F.col("failed_rules") != ""
            marked.where(broken).write.mode("overwrite").parquet(f"{bad}/{folder}")
            record = marked.agg(
                F.count("*").alias("n_rows"), F.count_if(broken).alias("n_bad")
            ).select(
                F.current_timestamp().alias("checked_at"),
                "n_rows",
                "n_bad",
                F.lit(verdict["decision"]).alias("decision"),
                F.lit(verdict["reason"]).alias("reason"),
            )
            record.write.mode("overwrite").json(f"{log}/{folder}")
            if hard_block and verdict["decision"] == "block":
                raise ContractBlocked(verdict["reason"])
            marked.where(~broken).drop("failed_rules").write.mode("overwrite").parquet(f"{ok}/{folder}")
        finally:
            marked.unpersist()

    return (
        stream.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
