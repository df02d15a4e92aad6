"""Profile a raw table, clean it, and keep the four records of what was done."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions import expressions as X
from proofline.operators.clean import (
    Step,
    apply_steps,
    change_log,
    fill_log,
    impute,
    mistake_log,
    rename,
    rename_log,
)
from proofline.operators.profile import (
    ProfileRules,
    column_profile,
    flag_sensitive,
    quality_issues,
    sensitive_columns,
)
from proofline.sources.sinks import handoff_metadata, write_handoff, write_reports, write_table


@dataclass(frozen=True)
class Recipe:
    """How a raw text table becomes a typed one."""

    key: str
    names: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    steps: Sequence[Step] = ()
    fills: Mapping[str, object] = field(default_factory=dict)
    rules: ProfileRules = ProfileRules()
    sensitive: Sequence[str] = ()


@dataclass(frozen=True)
class Prepared:
    table: DataFrame
    profile: DataFrame
    issues: DataFrame
    changes: DataFrame
    mistakes: DataFrame
    handoff: DataFrame

    def write(self, folder: str) -> None:
        write_table(self.table, f"{folder}/table", mode="overwrite")
        write_handoff(self.table, f"{folder}/handoff")
        reports = {"profile": self.profile, "issues": self.issues}
        write_reports({**reports, "changes": self.changes, "mistakes": self.mistakes}, folder)


def all_steps(recipe: Recipe) -> list[Step]:
    """Unmask every typed column, then the recipe's own steps, then the types."""
    tokens, formats = recipe.rules.tokens, recipe.rules.formats
    unmask = [
        Step(c, "masked null to NULL", "a token stands for a missing value", lambda v: X.unmasked(v, tokens))
        for c in recipe.types
    ]
    casts = [
        Step(c, f"text to {t}", "the column holds values of this type", lambda v, t=t: X.typed(v, t, formats))
        for c, t in recipe.types.items()
    ]
    return [*unmask, *recipe.steps, *casts]


def _changes(
    named: DataFrame, marked: DataFrame, typed: DataFrame, steps: Sequence[Step], recipe: Recipe, header: Sequence[str] | None
) -> DataFrame:
    """Renames, steps and fills in the order in which they were made."""
    parts = []
    renamed = {old: new for old, new in recipe.names.items() if new in named.columns and (header is None or old in header)}
    if renamed:
        parts.append(rename_log(named, renamed))
    if steps:
        parts.append(change_log(marked, steps))
    if recipe.fills:
        parts.append(fill_log(typed, recipe.fills))
    if not parts:
        return change_log(marked, [Step(recipe.key, "none", "nothing was to be changed", lambda c: c)])
    # a few rows for each part
    order = [p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)]
    log = reduce(DataFrame.unionByName, order)
    place = F.row_number().over(Window.orderBy("__part", "seq", "column_name", "what")) - 1
    return log.withColumn("seq", place).drop("__part")


def prepare(raw: DataFrame, recipe: Recipe, header: Sequence[str] | None = None) -> Prepared:
    """From a raw table to a typed one with profile, change log, mistake log and hand-off.

    Nothing runs before an output is used, but for the median of ``fills``.
    """
    named = rename(raw, recipe.names, header)
    flagged = sensitive_columns(named, recipe.sensitive).where("sensitive")
    # one row per column of the table
    marked = flag_sensitive(named, [r["column_name"] for r in flagged.collect()])
    steps = all_steps(recipe)
    typed = apply_steps(marked, steps)
    table = impute(typed, recipe.fills) if recipe.fills else typed
    for f in marked.schema:
        if f.metadata:
            table = table.withMetadata(f.name, f.metadata)
    return Prepared(
        table=table,
        profile=column_profile(marked, recipe.rules),
        issues=quality_issues(marked, recipe.rules),
        changes=_changes(named, marked, typed, steps, recipe, header),
        mistakes=mistake_log(marked, recipe.key, recipe.types, recipe.rules.tokens, recipe.rules.formats),
        handoff=handoff_metadata(table),
    )
