"""Ordered cleanup rules over metadata rows.

Every rule sees the row as the rules before it left it. The columns the rules
touch travel as one struct; each rule binds that struct to a lambda variable
and returns the next one, so the plan grows linearly with the number of rules
and stays one narrow projection: no shuffle, no lineage to cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.errors import SpecError

RULE_TYPES = ("alias", "drop", "clear_label", "set_label", "set_units")
LABEL, UNITS, KEEP = "bdchm_label", "var_units", "__keep"
# Column that a rule type writes; an alias writes the column it tests.
WRITES = {"clear_label": LABEL, "set_label": LABEL, "set_units": UNITS}


@dataclass(frozen=True)
class CleanupRule:
    rule_type: str
    match_field: str
    pattern: str
    is_regex: bool = False
    when_label: str = ""
    when_units: str = ""
    except_labels: str = ""
    target_value: str = ""

    @property
    def target(self) -> str:
        return WRITES.get(self.rule_type, self.match_field)


def parse_rules(rows: Iterable[dict]) -> list[CleanupRule]:
    """Rules from dictionaries, in order; missing cells read as empty."""
    rules = []
    for row in rows:
        row = {k: "" if v is None else str(v) for k, v in row.items()}
        missing = {"rule_type", "match_field", "pattern"} - set(row)
        if missing:
            raise SpecError(f"cleanup rules lack required columns: {sorted(missing)}")
        if row["rule_type"] not in RULE_TYPES:
            raise SpecError(f"invalid rule_type {row['rule_type']!r}")
        rule = CleanupRule(
            row["rule_type"],
            row["match_field"],
            row["pattern"],
            row.get("is_regex", "") == "1",
            row.get("when_label", ""),
            row.get("when_units", ""),
            row.get("except_labels", ""),
            row.get("target_value", ""),
        )
        if rule.is_regex:
            try:
                re.compile(rule.pattern)
            except re.error as e:
                raise SpecError(
                    f"invalid regex in cleanup rule (rule_type={rule.rule_type!r}, "
                    f"match_field={rule.match_field!r}, pattern={rule.pattern!r}): {e}"
                ) from e
        rules.append(rule)
    return rules


def rule_matches(rule: CleanupRule, cell: Column, label: Column | None, units: Column | None) -> Column:
    """The rule's test; never null."""
    text = F.coalesce(cell, F.lit(""))
    match = text.rlike(f"(?i){rule.pattern}") if rule.is_regex else text == F.lit(rule.pattern)
    for listed, column in ((rule.when_label, label), (rule.when_units, units)):
        if listed and column is not None:
            match = match & F.coalesce(column, F.lit("")).isin(listed.split(";"))
    excluded = [x for x in rule.except_labels.split(";") if x]
    if excluded and label is not None:
        match = match & ~F.coalesce(label, F.lit("")).isin(excluded)
    return match


def _step(rule: CleanupRule, columns: list[str], state: Column) -> Column:
    def cell(name: str) -> Column | None:
        return state.getField(name) if name in columns else None

    match = rule_matches(rule, cell(rule.match_field), cell(LABEL), cell(UNITS))
    fields = []
    for name in [*columns, KEEP]:
        value = state.getField(name)
        if name == KEEP and rule.rule_type == "drop":
            value = value & ~match
        elif name == rule.target and rule.rule_type != "drop":
            value = F.when(match, F.lit(rule.target_value if rule.rule_type != "clear_label" else "")).otherwise(value)
        fields.append(value.alias(name))
    return F.struct(*fields)


def _bound(state: Column, rule: CleanupRule, columns: list[str]) -> Column:
    """The state after one rule, with the state before it evaluated once."""
    return F.element_at(F.transform(F.array(state), lambda s: _step(rule, columns, s)), 1)


def apply_rules(df: DataFrame, rules: list[CleanupRule]) -> DataFrame:
    """Apply the rules in order; a rule on an absent column is skipped."""
    active = [
        r for r in rules
        if r.match_field in df.columns and (r.rule_type == "drop" or r.target in df.columns)
    ]
    if not active:
        return df
    touched = {LABEL, UNITS} | {r.match_field for r in active}
    columns = [c for c in df.columns if c in touched]
    start = F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns], F.lit(True).alias(KEEP))
    state = start
    for rule in active:
        state = _bound(state, rule, columns)
    # A dropped row leaves an empty list, so the state is computed only once.
    kept = F.filter(F.array(state), lambda s: s.getField(KEEP)) if any(r.rule_type == "drop" for r in active) else F.array(state)
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    ruled = df.select(*others, F.inline(kept))
    return ruled.select(*[F.col(f"`{c}`") for c in df.columns])
