"""The deliverables of one run: features, transformation report and data dictionary, published together or not at all."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.operators.clean import transformation_report
from proofline.operators.contract import as_violations
from proofline.operators.features import DICTIONARY, UNDOCUMENTED, FeatureSpec, build_features, confidence, data_dictionary, features_only
from proofline.plans.preparation import Prepared
from proofline.session import materialize
from proofline.sources.listing import OutputSpec
from proofline.sources.publishing import publish
from proofline.sources.sinks import handoff_metadata

REPORT = "seq int, column_name string, what string, why string, n_rows long, n_changed long, n_nulled long, n_filled long, score int, band string"
HANDOFF = "position int, column_name string, data_type string, nullable boolean, sensitive boolean, metadata string"
# what a run must leave behind; the columns of the features are those of its specs
EXPECTED = {
    "features": OutputSpec(),
    "transformation_report": OutputSpec(REPORT),
    "data_dictionary": OutputSpec(DICTIONARY),
    "handoff": OutputSpec(HANDOFF),
}


def proposals(changes: DataFrame) -> DataFrame:
    """The changes as proposals that reviews name: proposal, what."""
    return changes.select(F.concat_ws(": ", "column_name", "what").alias("proposal"), "what")


def deliver(
    prepared: Prepared,
    specs: Sequence[FeatureSpec],
    keys: Sequence[str],
    folder: str,
    run_id: str,
    reviews: Callable[[DataFrame], DataFrame] | None = None,
    at: datetime | None = None,
) -> str:
    """Build, write, gate and publish everything that one run owes; returns the decision.

    ``reviews`` turns the proposals (``proposals``) into reviews (proposal, outcome); without it
    no change has a confidence. The flags of sensitive columns arrive with the features, in
    their metadata and in the hand-off. A feature that no spec describes blocks, as does any
    output that is not there or not as it must be.
    """
    spark = prepared.table.sparkSession
    made = materialize(build_features(materialize(prepared.table), specs))
    features = features_only(made, keys)
    changes = materialize(prepared.changes)
    asked = proposals(changes)
    reviewed = asked.select("proposal", F.lit(None).cast("string").alias("outcome")).where("false") if reviews is None else reviews(asked)
    dictionary = materialize(data_dictionary(made, specs))
    report = transformation_report(changes, confidence(reviewed))
    outputs = {
        "features": features,
        "transformation_report": report.select([c.split(" ")[0] for c in REPORT.split(", ")]),
        "data_dictionary": dictionary,
        "handoff": handoff_metadata(features),
    }
    nameless = as_violations(dictionary.where(F.col("description") == UNDOCUMENTED), "dictionary", what="'undocumented feature'", where="name")
    return publish(spark, folder, run_id, outputs, EXPECTED, nameless, at)
