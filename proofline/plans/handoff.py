"""Gate a raw hand-off file.

    python -m proofline.plans.handoff FILE.csv

prints the verdict as JSON; the exit code is 0 to proceed, 2 for a block and 1 for a warning.
Whatever goes wrong on the way to a verdict blocks as well.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession

from proofline.operators.contract import Contract, gate, run_contract
from proofline.session import build_session
from proofline.sources.raw_csv import read_raw_csv

EXIT_CODES = {"allow": 0, "warn": 1, "block": 2}


def check_handoff(
    spark: SparkSession, path: str, contract: Contract = Contract(), multi_line: bool = False
) -> DataFrame:
    """The verdict on a delimited file: one row (decision, reason)."""
    rows, header = read_raw_csv(spark, path, multi_line=multi_line)
    return gate(run_contract(rows, contract, header))


def main(argv: list[str]) -> int:
    try:
        verdict = check_handoff(build_session(), argv[0]).first().asDict()
    except Exception as cause:  # a gate that cannot look must not open
        text = str(cause).strip() or type(cause).__name__
        verdict = {"decision": "block", "reason": f"The hand-off could not be checked: {text.splitlines()[0]}"}
    print(json.dumps(verdict, indent=2))
    return EXIT_CODES[verdict["decision"]]


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
