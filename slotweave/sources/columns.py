"""Which table holds a column: the inverse of the catalogue."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.functions.local import local_frame
from slotweave.plans.spec import ClassDerivation, SlotDerivation, SpecSet
from slotweave.sources.catalog import Catalog
from slotweave.sources.files import table_columns

ACCESSION = r"(phv\d{8})"


def column_catalogue(catalog: Catalog) -> DataFrame:
    """(table, column) of every table in the catalogue."""
    rows = [(t, c) for t in catalog for c in catalog[t].columns]
    return local_frame(catalog.spark, rows, "`table` string, `column` string")


def column_catalogue_of_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(table, column) of delimited and Parquet tables, read from headers and footers in one job.

    No table is opened on the driver. A table is named after its file; a column without a name is left out.
    """
    found = table_columns(spark, list(paths))
    return found.where(F.trim("column") != "").select("table", "column")


def tables_of_references(texts: DataFrame, catalogue: DataFrame, column: str = "value") -> DataFrame:
    """(column, table) of every accession mentioned in a text; the last table by name stands."""
    found = F.regexp_extract_all(F.col(f"`{column}`"), F.lit(ACCESSION), 1)
    mentioned = texts.select(F.explode(found).alias("column")).distinct()
    return mentioned.join(catalogue, "column").groupBy("column").agg(F.max("table").alias("table"))


def _first_accession(slots: tuple[SlotDerivation, ...]) -> str | None:
    import re

    for slot in slots:
        if slot.populated_from is not None and str(slot.populated_from).startswith("phv"):
            return str(slot.populated_from)
        if slot.expr is not None:
            match = re.search(ACCESSION, str(slot.expr))
            if match:
                return match[1]
    return None


def resolve_placeholder(specs: SpecSet, tables: dict[str, str], placeholder: str) -> SpecSet:
    """Replace a placeholder table name by the table of the block's first accession.

    A nested block without an accession of its own takes its parent's table.
    """

    def fix(block: ClassDerivation, parent: str | None) -> ClassDerivation:
        table = block.populated_from
        if table == placeholder:
            table = tables.get(_first_accession(block.slots) or "", parent or placeholder)
            parent = table if table != placeholder else parent
        slots = tuple(
            dataclasses.replace(s, objects=tuple(fix(o, parent) for o in s.objects)) if s.objects else s
            for s in block.slots
        )
        return dataclasses.replace(block, populated_from=table, slots=slots)

    return SpecSet(tuple(fix(b, None) for b in specs.classes), specs.enums)
