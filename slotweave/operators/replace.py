"""Cell replacement by (table, column, old value)."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.operators.joins import lookup_join

RULE_COLUMNS = ("filename", "column_name", "original_value", "replacement_value")


def latest_rules(rules: DataFrame, table: str | None = None) -> DataFrame:
    """One rule per (table, column, old value), or of one table per (column, old value): the last one wins.

    The order is the ``ordinal`` column, or else the row order of the frame.
    """
    if "ordinal" not in rules.columns:
        rules = rules.withColumn("ordinal", F.monotonically_increasing_id())
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in RULE_COLUMNS]
    named = rules.select(*text, "ordinal")
    if table is not None:
        named = named.filter(F.col("filename") == table)
    keys = ("filename", "column_name", "original_value") if table is None else ("column_name", "original_value")
    return named.groupBy(*keys).agg(F.max_by("replacement_value", "ordinal").alias("replacement_value"))


def ruled_columns(rules: DataFrame) -> dict[str, set[str]]:
    """The columns that have rules, per table; one job for all tables."""
    found: dict[str, set[str]] = {}
    for table, column in rules.select("filename", "column_name").distinct().collect():
        found.setdefault(table, set()).add(column)
    return found


def rule_key(table, column: str, value):
    """What a rule is found by: the parts with their lengths before them, so that none runs into the next."""
    return F.concat_ws(":", F.length(table), table, F.lit(len(column)), F.lit(column), value)


def replace_cells(df: DataFrame, rules: DataFrame, table: str, columns: Collection[str] | None = None) -> DataFrame:
    """Replace exact cell values; everything else stays as it is.

    Each cell is looked up once, so a replacement is never replaced again. All columns with a rule,
    of all tables, are looked up in the same table of rules, which Spark broadcasts once if it is small.
    ``columns`` (see ``ruled_columns``) spares the job that finds those of this table.
    """
    if columns is None:
        columns = ruled_columns(rules.filter(F.col("filename") == table)).get(table, ())
    wanted = [c for c in df.columns if c in set(columns)]
    if not wanted:
        return df
    latest = latest_rules(rules)
    name = F.col("column_name")
    key = F.concat_ws(":", F.length("filename"), "filename", F.length(name), name, "original_value")
    dictionary = latest.select(key.alias("__key"), F.col("replacement_value").alias("__new"))
    for column in wanted:
        cell = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
        joined = lookup_join(df.withColumn("__key", rule_key(F.lit(table), column, cell)), dictionary, ["__key"])
        replaced = F.coalesce("__new", F.col(f"`{column}`").cast("string")).alias(column)
        df = joined.select(*[replaced if c == column else F.col(f"`{c}`") for c in df.columns])
    return df
