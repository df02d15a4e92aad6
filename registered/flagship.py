"""Raw order lines through the gate, cleaning and features to a data dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.operators.clean import unmask_nulls
from proofline.operators.contract import Contract, enforce, gate, run_contract
from proofline.operators.features import build_features, data_dictionary
from proofline.session import materialize
from registered.base import query
from registered.engineering import BUILT_SQL, DICTIONARY_SQL, order_line_specs, order_lines

# every twentieth order has a masked priority, which cleaning turns into a missing value
FLAGSHIP_SQL = f"WITH {BUILT_SQL} {DICTIONARY_SQL}".replace(
    "length(o_orderpriority)", "length(CASE WHEN l_orderkey % 20 <> 0 THEN o_orderpriority END)"
)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    # the join is done once; the gate and every batch read its result
    raw = materialize(
        order_lines(spark, sf).withColumn(
            "o_orderpriority", F.when(F.col("l_orderkey") % 20 == 0, "?").otherwise(F.col("o_orderpriority"))
        )
    )
    enforce(gate(run_contract(raw, Contract(rows=(1, None)))))
    clean = unmask_nulls(raw, ["o_orderpriority"])
    specs = order_line_specs()
    found = data_dictionary(build_features(clean, specs), specs)
    return found.withColumns({c: F.round(c, 6) for c in ("min_value", "max_value")})


@query("flagship", FLAGSHIP_SQL)
def flagship_query(spark: SparkSession, sf: str) -> DataFrame:
    return flagship(spark, sf)
