"""Metadata rows rendered as mapping-spec text.

Each entity has a renderer (a text column) and a completeness test. The text
is built from native expressions; the fixed lines are the spec format itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.errors import SpecError
from slotweave.functions.text import nonblank
from slotweave.operators.flags import as_flag
from slotweave.operators.joins import dealt_out

PARTICIPANT_NAMESPACE = "https://w3id.org/bdchm/Participant"
VISIT_NAMESPACE = "https://w3id.org/bdchm/Visit"


class Row:
    """Cells of a metadata row; an absent column counts as missing."""

    def __init__(self, df: DataFrame):
        self._columns = set(df.columns)

    def cell(self, name: str) -> Column:
        return F.col(f"`{name}`").cast("string") if name in self._columns else F.lit(None).cast("string")

    def has(self, name: str) -> Column:
        """Not null, not blank."""
        return nonblank(self.cell(name))

    def text(self, name: str) -> Column:
        """The cell; a missing one is written as 0, as the spec files have it."""
        return F.when(self.has(name), self.cell(name)).otherwise(F.lit("0"))

    def quoted(self, name: str) -> Column:
        """The cell inside single quotes."""
        return F.replace(self.text(name), F.lit("'"), F.lit("''"))

    def flag(self, name: str) -> Column:
        return as_flag(self.cell(name)) == 1


@dataclass(frozen=True)
class Entity:
    render: Callable[[Row], Column]
    is_good: Callable[[Row], Column]


def _lines(indent: int, *lines: Column | str) -> Column:
    """Lines at one indent, each ended by a newline."""
    pad = " " * indent
    return F.concat(*[F.concat(F.lit(pad), F.lit(x) if isinstance(x, str) else x, F.lit("\n")) for x in lines])


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _when(condition: Column, text: Column) -> Column:
    return F.when(condition, text).otherwise(F.lit(""))


def render_measurement(row: Row) -> Column:
    """A measurement block: visit, age, and one of four ways to the unit."""
    participant = row.text("participantidphv")
    visit = (
        F.when(
            row.flag("has_visit"),
            _cat(_lines(8, "associated_visit:"), _lines(10, _cat("value: ", row.text("associatedvisit")))),
        )
        .when(
            row.flag("has_visit_expr"),
            _cat(
                _lines(8, "associated_visit:"),
                _lines(10, _cat(
                    f"expr: 'uuid5(\"{VISIT_NAMESPACE}\", str({{", participant, "}) + \":\" + ",
                    row.text("associatedvisit_expr"), ")'",
                )),
            ),
        )
        .otherwise(F.lit(""))
    )
    age = _when(
        row.flag("has_age"),
        _cat(_lines(8, "age_at_observation:"), _lines(10, _cat("expr: '{", row.text("ageinyearsphv"), "} * 365'"))),
    )
    unit = _cat(_lines(18, "unit:"), _lines(20, _cat("value: '", row.text("bdchm_unit"), "'")))
    typed_unit = _cat(unit, _lines(20, "range: string"))
    copy = _lines(20, _cat("populated_from: ", row.text("phv")))
    convert = _cat(
        copy,
        _lines(20, "unit_conversion:"),
        _lines(22, _cat("source_unit: '", row.text("source_unit"), "'"), _cat("target_unit: '", row.text("target_unit"), "'")),
    )
    rule = _lines(20, _cat("expr: '{", row.text("phv"), "} ", row.text("conversion_rule"), "'"))
    custom = _lines(20, _cat("expr: '", row.text("unit_casestmt_custom"), "'"))
    quantity = (
        F.when(row.flag("unit_match"), _cat(copy, unit))
        .when(row.flag("unit_convert"), _cat(convert, typed_unit))
        .when(row.flag("unit_expr"), _cat(rule, typed_unit))
        .when(row.flag("unit_casestmt"), _cat(custom, typed_unit))
        .otherwise(F.lit(""))
    )
    return _cat(
        _lines(0, "- class_derivations:"),
        _lines(4, "MeasurementObservation:"),
        _lines(6, _cat("populated_from: ", row.text("pht")), "slot_derivations:"),
        _lines(8, "associated_participant:"),
        _lines(10, _cat("populated_from: ", participant)),
        visit,
        age,
        _lines(8, "observation_type:"),
        _lines(10, _cat("value: ", row.text("onto_id"))),
        _lines(8, "value_quantity:"),
        _lines(10, "object_derivations:", "- class_derivations:"),
        _lines(14, "Quantity:"),
        _lines(16, _cat("populated_from: ", row.text("pht")), "slot_derivations:"),
        _lines(18, "value_decimal:"),
        quantity,
    )


def value_mapping_lines(cell: Column, indent: int) -> Column:
    """``code=value;code=value`` as mapping lines; entries without ``=`` are skipped."""
    pairs = F.filter(F.split(cell, ";"), lambda p: p.contains("="))

    def line(pair: Column) -> Column:
        code = F.substring_index(pair, "=", 1)
        value = F.substring(pair, F.instr(pair, "=") + 1, F.length(pair))
        return _cat(" " * indent + "'", F.replace(code, F.lit("'"), F.lit("''")), "': ", value, "\n")

    return F.array_join(F.transform(pairs, line), "")


def render_condition(row: Row) -> Column:
    """A condition block: derived ids, mapped status, provenance, relationship."""

    def name_of(namespace: str, tail: Column) -> Column:
        return _cat(f"expr: 'uuid5(\"{namespace}\", str({{", row.text("participantidphv"), "}) + \":", tail, "\")'")

    def constant(slot: str, text: Column) -> Column:
        return _cat(_lines(8, f"{slot}:"), _lines(10, _cat("value: '", text, "'"), "range: string"))

    relationship = F.when(row.has("relationship_to_participant"), row.quoted("relationship_to_participant"))
    return _cat(
        _lines(0, "- class_derivations:"),
        _lines(4, "Condition:"),
        _lines(6, _cat("populated_from: ", row.text("pht")), "slot_derivations:"),
        _lines(8, "associated_participant:"),
        _lines(10, name_of(PARTICIPANT_NAMESPACE, F.upper(row.text("cohort")))),
        _lines(8, "associated_visit:"),
        _lines(10, name_of(VISIT_NAMESPACE, row.text("associatedvisit"))),
        constant("condition_concept", row.quoted("onto_id")),
        _lines(8, "condition_status:"),
        _lines(10, _cat("populated_from: ", row.text("phv"))),
        _when(
            row.has("value_mappings"),
            _cat(_lines(10, "value_mappings:"), value_mapping_lines(row.text("value_mappings"), 12)),
        ),
        constant("condition_provenance", row.quoted("condition_provenance")),
        constant("relationship_to_participant", F.coalesce(relationship, F.lit("ONESELF"))),
        _when(row.has("associated_evidence"), constant("associated_evidence", row.quoted("associated_evidence"))),
    )


# What a condition row needs.
CONDITION_REQUIRED = (
    "pht", "participantidphv", "onto_id", "phv", "associatedvisit", "value_mappings", "condition_provenance",
)

_ENTITIES: dict[str, Entity] = {}


def register_entity(name: str, render: Callable[[Row], Column], is_good: Callable[[Row], Column]) -> None:
    """Make an entity known to :func:`render_specs`."""
    _ENTITIES[name] = Entity(render, is_good)


register_entity("MeasurementObservation", render_measurement, lambda row: row.flag("row_good"))
register_entity(
    "Condition", render_condition, lambda row: reduce(and_, [row.has(c) for c in CONDITION_REQUIRED])
)


def render_specs(df: DataFrame, entity: str, cohort: str | None = None) -> DataFrame:
    """(cohort, quality, varname, phv, text) for the rows of one entity (and cohort).

    ``varname`` keeps only the last part of a path. A text is many times as large as its row, so the rows are dealt
    out before: a task's texts then don't grow with the rows that it reads.
    """
    if entity not in _ENTITIES:
        raise SpecError(f"no registered entity {entity!r}; known: {sorted(_ENTITIES)}")
    known = _ENTITIES[entity]
    row = Row(df)
    rows = df.filter(F.col("bdchm_entity") == entity)
    if cohort is not None:
        rows = rows.filter(F.col("cohort") == cohort)
    rows = dealt_out(rows.filter(F.col("bdchm_varname").isNotNull()))
    return rows.select(
        F.col("cohort"),
        F.when(known.is_good(row), "good").otherwise("bad").alias("quality"),
        F.regexp_replace("bdchm_varname", "^.*/", "").alias("varname"),
        row.cell("phv").alias("phv"),
        known.render(row).alias("text"),
    )
