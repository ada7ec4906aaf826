"""Quality flags of a metadata row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.functions.text import exam_mention, nonblank, nonblank_trimmed


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def as_flag(c: Column) -> Column:
    """An integer cell, 0 where it is missing or no number."""
    return F.coalesce(c.cast("string").try_cast("double").try_cast("int"), F.lit(0))


def normalize_numeric_flags(df: DataFrame, columns: tuple[str, ...] = ("equivalent_units", "both_valid_ucums")) -> DataFrame:
    for c in columns:
        if c in df.columns:
            df = df.withColumn(c, as_flag(_c(c)))
    return df


def quality_flags(df: DataFrame, has_pht: Column | None = None) -> DataFrame:
    """Add the flags; an input column that is absent counts as blank.

    ``has_pht`` overrides the test on ``participantidphv``: right after the
    table join a blank value still counts as a match.
    """
    have = set(df.columns)

    def blank_safe(test, name: str) -> Column:
        return test(name) if name in have else F.lit(False)

    def one(name: str) -> Column:
        return as_flag(_c(name)) == 1 if name in have else F.lit(False)

    same_unit = F.lit(False)
    equivalent = F.lit(False)
    if {"var_units", "bdchm_unit"} <= have:
        same_unit = (_c("var_units") == _c("bdchm_unit")) & (_c("var_units") != "")
        equivalent = one("equivalent_units")
    valid = one("both_valid_ucums")
    match = F.coalesce(same_unit, F.lit(False)) | equivalent
    if has_pht is None:
        has_pht = blank_safe(nonblank_trimmed, "participantidphv")

    flags = {
        "has_pht": _flag(has_pht),
        "has_onto": _flag(blank_safe(nonblank, "onto_id")),
        "unit_match": _flag(match),
        "unit_convert": _flag(~match & valid),
        "unit_expr": _flag(~match & ~valid & blank_safe(nonblank, "conversion_rule")),
        "unit_casestmt": _flag(blank_safe(nonblank, "unit_casestmt_custom")),
        "has_visit": _flag(blank_safe(nonblank_trimmed, "associatedvisit")),
        "var_desc_exam": exam_mention("var_desc") if "var_desc" in have else F.lit(""),
        "has_age": _flag(blank_safe(nonblank_trimmed, "ageinyearsphv")),
    }
    df = df.withColumns(flags)
    if "associatedvisit_expr" in have:
        # A direct visit makes the visit expression moot.
        expr = F.when((F.col("has_visit") == 1) & nonblank_trimmed("associatedvisit_expr"), F.lit(""))
        df = df.withColumn("associatedvisit_expr", expr.otherwise(_c("associatedvisit_expr")))
        visit_expr = nonblank_trimmed("associatedvisit_expr")
    else:
        visit_expr = F.lit(False)
    unit_ok = (F.col("unit_match") + F.col("unit_convert") + F.col("unit_expr") + F.col("unit_casestmt")) > 0
    return df.withColumns({
        "has_visit_expr": _flag(visit_expr),
        "row_good": _flag((F.col("has_pht") == 1) & (F.col("has_onto") == 1) & unit_ok),
    })
