"""Metadata authoring over files: prepare, correct, render."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from slotweave.errors import SourceError
from slotweave.operators.metadata import DEFAULT_ENTITY, apply_overrides, prepare_metadata
from slotweave.operators.render import render_specs
from slotweave.operators.rules import CleanupRule, parse_rules
from slotweave.sinks.spec_files import DEFAULT_LAYOUT, write_spec_files
from slotweave.sinks.writers import write_quoted_csv
from slotweave.sources.delimited import KNOWN_SHEETS, discover, pick_sheet, read_metadata


def read_rules(spark: SparkSession, path: str) -> list[CleanupRule]:
    """Cleanup rules of a delimited file, in file order."""
    return parse_rules(r.asDict() for r in read_metadata(spark, path).collect())


def read_export(spark: SparkSession, path: str, known: Sequence[str] = KNOWN_SHEETS) -> DataFrame:
    """A metadata export: one delimited file, or a directory with one file per sheet."""
    try:
        sheets = {p.rsplit("/", 1)[-1].rsplit(".", 1)[0]: p for p in discover(spark, path)}
    except SourceError:
        sheets = {}
    return read_metadata(spark, sheets[pick_sheet(list(sheets), known)] if sheets else path)


def prepare_metadata_files(
    spark: SparkSession,
    exports: Sequence[str],
    definitions: str,
    contextual: str,
    conversions: str,
    equivalencies: str,
    ucum: str,
    output: str,
    rules: str | None = None,
    conversion_overrides: str | None = None,
    equivalency_overrides: str | None = None,
    default_overrides: bool = True,
    known_sheets: Sequence[str] = KNOWN_SHEETS,
    entity: str | None = DEFAULT_ENTITY,
) -> str | None:
    """Write the curated table as fully quoted CSV; None when there is no export."""

    def read(path: str) -> DataFrame:
        return read_metadata(spark, path)

    curated = prepare_metadata(
        [read_export(spark, p, known_sheets) for p in exports],
        read(definitions),
        read(contextual),
        read(conversions),
        read(equivalencies),
        read(ucum),
        read_rules(spark, rules) if rules else None,
        read(conversion_overrides) if conversion_overrides else None,
        read(equivalency_overrides) if equivalency_overrides else None,
        default_overrides,
        entity,
    )
    if curated is None:
        return None
    write_quoted_csv(curated, output)
    return output


def apply_override_files(spark: SparkSession, curated: str, fixes: str, output: str) -> str:
    """Apply a fixes table to a curated table and write the result."""
    write_quoted_csv(apply_overrides(read_metadata(spark, curated), read_metadata(spark, fixes)), output)
    return output


def generate_spec_files(
    spark: SparkSession, curated: str, output: str, entity: str, cohort: str | None = None, layout: str = DEFAULT_LAYOUT
) -> str:
    """Render the rows of an entity (and cohort) as spec files."""
    write_spec_files(render_specs(read_metadata(spark, curated), entity, cohort), output, layout)
    return output
