"""Metadata authoring: raw variable rows joined with reference tables.

All inputs are DataFrames of strings. Reference tables are small lists kept by
curators; the joins leave it to Spark's size check whether to broadcast them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.errors import SpecError
from slotweave.functions.local import local_frame
from slotweave.functions.text import label_key, nonblank, preferred
from slotweave.operators import clean
from slotweave.operators.flags import normalize_numeric_flags, quality_flags
from slotweave.operators.joins import lookup_join
from slotweave.operators.reshape import require_unique, union_distinct
from slotweave.operators.rules import CleanupRule, apply_rules

OVERRIDE_KEY = ("bdchm_label", "var_units", "bdchm_unit")
DEFAULT_ENTITY = "MeasurementObservation"

# Label-keyed overrides that always apply.
CONVERSION_OVERRIDES = (
    ("hdl", "mmol/L", "mg/dL", "* 38.67"),
    ("total cholesterol in blood", "mmol/L", "mg/dL", "* 38.67"),
    ("factor viii", "%", "[IU]/mL", "* 0.01"),
)
EQUIVALENCY_OVERRIDES = (
    ("mean corpuscular hemoglobin concentration", "%", "g/dL"),
    ("sodium in blood", "meq/L", "mmol/L"),
)

# Columns of the curated table, in order.
OUTPUT_COLUMNS = (
    "row_good", "cohort", "bdchm_entity", "bdchm_label", "bdchm_varname", "has_onto", "onto_id", "bdchm_unit",
    "phv", "var_desc", "var_units", "has_pht", "pht", "participantidphv", "has_visit", "associatedvisit",
    "has_visit_expr", "associatedvisit_expr", "xassociatedvisit", "var_desc_exam", "has_age", "ageinyearsphv",
    "contextvars_notes", "unit_match", "unit_convert", "unit_expr", "conversion_rule", "unit_casestmt",
    "unit_casestmt_custom", "source_unit", "target_unit", "equivalent_units", "both_valid_ucums",
)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _require(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise SpecError(f"{what} lacks required columns: {missing}")


# --- reference tables ------------------------------------------------------


def definitions(df: DataFrame) -> DataFrame:
    """Harmonized variable definitions with a preferred ontology id and the label key."""
    df = clean.clean_strings(df)
    sources = [c for c in ("obacurie", "omop") if c in df.columns]
    df = df.withColumn("onto_id", preferred(*sources) if sources else F.lit(""))
    return clean.drop_null_columns(df.drop("omop", "obacurie")).withColumn("merge_bdchm_label", label_key("bdchm_varlabel"))


def contextual_variables(df: DataFrame) -> DataFrame:
    """Visit and participant variables per table."""
    df = clean.drop_null_columns(clean.clean_strings(df)).filter(nonblank("pht"))
    if "associatedvisit" in df.columns:
        df = df.withColumn("associatedvisit", F.upper("associatedvisit"))
    return df.drop("datatablename").withColumnRenamed("notes", "contextvars_notes").distinct()


def unit_conversions(conversions: DataFrame, ucum: DataFrame) -> DataFrame:
    """Unconditional conversion rules, with the validity of both unit codes."""
    known = ucum.filter(F.col("ucum_code").isNotNull()).select("ucum_code").distinct()
    rules = conversions.filter(~nonblank("conversion_condition")).drop("conversion_formula", "conversion_condition")
    rules = rules.withColumnsRenamed({"this_unit": "source_unit", "that_unit": "target_unit"})
    for unit in ("source_unit", "target_unit"):
        flagged = known.select(_c("ucum_code").alias(unit), F.lit(1).alias(f"{unit}_valid"))
        rules = lookup_join(rules, flagged, [unit])
        rules = rules.withColumn(f"{unit}_valid", F.coalesce(f"{unit}_valid", F.lit(0)))
    both = F.col("source_unit_valid") * F.col("target_unit_valid")
    return rules.withColumn("both_valid_ucums", both).distinct()


def unit_equivalencies(df: DataFrame) -> DataFrame:
    """Unit pairs that are always equivalent."""
    always = df.filter(F.col("equivalency_always") == "1").filter(
        F.col("this_unit").isNotNull() & F.col("that_unit").isNotNull()
    )
    return always.select("this_unit", "that_unit").distinct().withColumn("equivalent_units", F.lit(1))


def label_overrides(df: DataFrame, with_rule: bool) -> DataFrame:
    """Label-keyed unit overrides; their keys must be unique."""
    what = "conversion overrides" if with_rule else "equivalency overrides"
    columns = [*OVERRIDE_KEY, "conversion_rule"] if with_rule else list(OVERRIDE_KEY)
    _require(df, columns, what)
    df = clean.blank_nulls(df.select(*columns))
    require_unique(df, OVERRIDE_KEY, what)
    return df


def default_conversion_overrides(spark) -> DataFrame:
    return local_frame(
        spark, CONVERSION_OVERRIDES, "bdchm_label string, var_units string, bdchm_unit string, conversion_rule string"
    )


def default_equivalency_overrides(spark) -> DataFrame:
    return local_frame(spark, EQUIVALENCY_OVERRIDES, "bdchm_label string, var_units string, bdchm_unit string")


# --- raw rows --------------------------------------------------------------


def combine_raw(frames: Sequence[DataFrame]) -> DataFrame:
    """Clean, rename and union raw exports of any dialect."""
    return union_distinct([
        clean.normalize_columns(clean.drop_null_columns(clean.clean_strings(f))) for f in frames
    ])


# --- merge -----------------------------------------------------------------


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    """Left join in which the left column keeps its name on a collision."""
    clashes = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c not in on}
    return lookup_join(left, right.withColumnsRenamed(clashes), on)


def merge_reference(
    rows: DataFrame,
    defs: DataFrame,
    conversions: DataFrame,
    equivalencies: DataFrame,
    contextual: DataFrame,
    conversion_overrides: DataFrame | None = None,
    equivalency_overrides: DataFrame | None = None,
    entity: str | None = DEFAULT_ENTITY,
) -> DataFrame:
    """Join the rows with every reference table and compute the flags."""
    df = left_lookup(rows, defs, ["merge_bdchm_label"], "_defs")

    units = {"__from": F.coalesce("var_units", F.lit("")), "__to": F.coalesce("bdchm_unit", F.lit(""))}
    df = df.withColumns(units)
    keep = ("source_unit", "target_unit", "conversion_rule", "source_unit_valid", "target_unit_valid", "both_valid_ucums")
    conv = conversions.select(
        _c("source_unit").alias("__from"),
        _c("target_unit").alias("__to"),
        *[_c(c) for c in keep if c in conversions.columns],
    ).distinct()
    df = left_lookup(df, conv, ["__from", "__to"], "_conv")
    equiv = equivalencies.withColumnsRenamed({"this_unit": "__from", "that_unit": "__to"})
    df = left_lookup(df, equiv, ["__from", "__to"], "_equiv").drop("__from", "__to")

    if conversion_overrides is not None:
        df = override_conversions(df, conversion_overrides)
    if equivalency_overrides is not None:
        df = override_equivalencies(df, equivalency_overrides)

    df = left_lookup(df, contextual, ["pht"], "_ctx")
    has_pht = _c("participantidphv").isNotNull() if "participantidphv" in df.columns else F.lit(False)
    if "drop_table" in df.columns:
        df = df.filter(~F.col("drop_table").eqNullSafe(F.lit("1"))).drop("drop_table")
    if entity is not None and "bdchm_entity" in df.columns:
        df = df.filter(F.col("bdchm_entity") == entity)
    df = normalize_numeric_flags(quality_flags(df, has_pht))
    return df.select(*[c for c in OUTPUT_COLUMNS if c in df.columns]).distinct()


def override_conversions(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """The conversion rule of a listed (label, unit, target unit) replaces the general one."""
    ours = overrides.select(*OVERRIDE_KEY, _c("conversion_rule").alias("__rule"))
    joined = lookup_join(df, ours, OVERRIDE_KEY)
    general = [_c("conversion_rule")] if "conversion_rule" in df.columns else []
    columns = [c for c in df.columns if c != "conversion_rule"]
    return joined.select(*columns, F.coalesce("__rule", *general, F.lit("")).alias("conversion_rule"))


def override_equivalencies(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """A listed (label, unit, target unit) counts as equivalent."""
    ours = overrides.select(*OVERRIDE_KEY).distinct().withColumn("__listed", F.lit(1))
    joined = lookup_join(df, ours, OVERRIDE_KEY)
    general = [_c("equivalent_units")] if "equivalent_units" in df.columns else []
    columns = [c for c in df.columns if c != "equivalent_units"]
    return joined.select(*columns, F.coalesce("__listed", *general, F.lit(0)).alias("equivalent_units"))


def prepare_metadata(
    raw: Sequence[DataFrame],
    defs: DataFrame,
    contextual: DataFrame,
    conversions: DataFrame,
    equivalencies: DataFrame,
    ucum: DataFrame,
    rules: list[CleanupRule] | None = None,
    conversion_overrides: DataFrame | None = None,
    equivalency_overrides: DataFrame | None = None,
    default_overrides: bool = True,
    entity: str | None = DEFAULT_ENTITY,
) -> DataFrame | None:
    """Raw exports to the curated table; None when no export is given.

    With ``default_overrides`` the fixed override lists stand in for a table
    that is not given.
    """
    frames = [f for f in raw if f.columns]
    if not frames:
        return None
    spark = frames[0].sparkSession
    if default_overrides:
        if conversion_overrides is None:
            conversion_overrides = default_conversion_overrides(spark)
        if equivalency_overrides is None:
            equivalency_overrides = default_equivalency_overrides(spark)
    rows = clean.standardize(combine_raw(frames))
    if rules:
        rows = apply_rules(rows, rules)
    return merge_reference(
        clean.finalize(rows),
        definitions(defs),
        unit_conversions(conversions, ucum),
        unit_equivalencies(equivalencies),
        contextual_variables(contextual),
        None if conversion_overrides is None else label_overrides(conversion_overrides, True),
        None if equivalency_overrides is None else label_overrides(equivalency_overrides, False),
        entity,
    )


# --- curator overrides -----------------------------------------------------

# Column of the fixes table -> column it overrides.
FIX_COLUMNS = {
    "var_units_fixed": "var_units",
    "participantidphv": "participantidphv",
    "associatedvisit": "associatedvisit",
    "associatedvisit_expr": "associatedvisit_expr",
    "ageinyearsphv": "ageinyearsphv",
    "conversion_rule": "conversion_rule",
    "unit_expr_custom": "conversion_rule",
    "unit_casestmt_custom": "unit_casestmt_custom",
}
FIX_KEY = ("phv", "bdchm_label")


def check_fixes(fixes: DataFrame) -> DataFrame:
    """The fixes with blanks for nulls; duplicate keys and alias conflicts raise."""
    _require(fixes, FIX_KEY, "fixes")
    fixes = clean.blank_nulls(fixes)
    require_unique(fixes, FIX_KEY, "fixes")
    if {"conversion_rule", "unit_expr_custom"} <= set(fixes.columns):
        both = fixes.filter(nonblank("conversion_rule") & nonblank("unit_expr_custom")).select(*FIX_KEY)
        sample = both.limit(10).collect()
        if sample:
            raise SpecError(f"fixes set both conversion_rule and unit_expr_custom for {[tuple(r) for r in sample]}")
    return fixes


def apply_overrides(df: DataFrame, fixes: DataFrame) -> DataFrame:
    """Per-(phv, label) overrides in one join: values replaced, bad mappings removed, flags redone."""
    fixes = check_fixes(fixes)
    wanted = [c for c in (*FIX_COLUMNS, "bad_map") if c in fixes.columns]
    ours = fixes.select(*FIX_KEY, *[_c(c).alias(f"__fix_{c}") for c in wanted])
    joined = lookup_join(clean.blank_nulls(df), ours, FIX_KEY)
    if "bad_map" in wanted:
        joined = joined.filter(~F.col("__fix_bad_map").eqNullSafe(F.lit("1")))
    candidates: dict[str, list[str]] = {}
    for fix, target in FIX_COLUMNS.items():
        if fix in wanted:
            candidates.setdefault(target, []).append(f"__fix_{fix}")
    values = []
    for c in [*df.columns, *[t for t in candidates if t not in df.columns]]:
        old = _c(c) if c in df.columns else F.lit("")
        fixed = [F.when(nonblank(f), _c(f)) for f in reversed(candidates.get(c, []))]
        values.append(F.coalesce(*fixed, old).alias(c) if fixed else old.alias(c))
    return quality_flags(normalize_numeric_flags(joined.select(*values)))
