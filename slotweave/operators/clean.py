"""Column-name and cell cleaning for metadata tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.errors import SpecError
from slotweave.functions.text import (
    accession,
    backfill,
    clean_whitespace,
    corrected,
    na_to_null,
    nonblank,
)
from slotweave.functions.units import normalize_units
from slotweave.operators.joins import dealt_out

# Export column name -> working column name.
COLUMN_ALIASES = {
    "data_table.study_id": "study_id",
    "data_table.dataset_id": "data_table_id",
    "data_table.variable.id": "var_id",
    "data_table.variable.description": "var_desc",
    "data_table.variable.units": "var_units",
    "data_table.variable.calculated_type": "var_type",
    "data_table.variable.comment": "var_comment",
    "data_table.name": "data_table_name",
    "data_table.description": "data_table_descr",
    "data_table.study_name": "cohort_long",
    "var_report.study_id": "study_id",
    "var_report.dataset_id": "data_table_id",
    "var_report.variable.id": "var_id",
    "var_report.variable.description": "var_desc",
    "var_report.variable.units": "var_units",
    "var_report.variable.calculated_type": "var_type",
    "var_report.variable.comment": "var_comment",
    "var_report.name": "data_table_name",
    "var_report.description": "data_table_descr",
    "var_report.study_name": "cohort_long",
    "source_variable_name": "var_name",
    "source_variable_description": "var_desc",
    "note": "curator_note",
    "notes": "curator_note",
    "topmed_harmonized_variable": "topmed_varname",
    "bdchm_label_(corrected)": "bdchm_label_corrected",
    "first[data_table.study_id]": "first_study_id",
    "first[data_table.dataset_id]": "first_dataset_id",
    "first[data_table.variable.id]": "first_variable_id",
    "vlookupresults": "vlookup_results",
}
# Working column, the accession column that fills it.
ACCESSION_BACKFILL = {
    "study_id": "dbgap_study_accession",
    "var_id": "variable_accession",
    "data_table_id": "dataset_accession",
}
# Id column, the short name its accession takes.
ACCESSION_NAMES = {"var_id": "phv", "study_id": "phs", "data_table_id": "pht"}
LOWER_CASED = ("cohort", "var_units", "var_desc", "transform_comment", "bdchm_label")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_strings(df: DataFrame) -> DataFrame:
    """White space cleaned in every string column."""
    text = set(string_columns(df))
    return df.select(*[clean_whitespace(c).alias(c) if c in text else _c(c) for c in df.columns])


def null_tokens(df: DataFrame) -> DataFrame:
    """Missing-value tokens to null in every string column."""
    text = set(string_columns(df))
    return df.select(*[na_to_null(c).alias(c) if c in text else _c(c) for c in df.columns])


def blank_nulls(df: DataFrame) -> DataFrame:
    """Null to the empty string in every string column."""
    text = string_columns(df)
    return df.na.fill("", subset=text) if text else df


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Columns that hold at least one value; one aggregate pass finds them."""
    if not df.columns:
        return df
    seen = df.agg(*[F.max(_c(c).isNotNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[_c(c) for i, c in enumerate(df.columns) if seen[i]])


def column_aliases() -> dict[str, str]:
    return dict(COLUMN_ALIASES)


def normalized_name(name: str) -> str:
    folded = name.lower().strip()
    return column_aliases().get(folded, folded.replace(".", "_").replace(" ", "_"))


def rename_columns(df: DataFrame) -> DataFrame:
    """Working column names; columns that meet in one name are coalesced in order."""
    sources: dict[str, list[int]] = {}
    for i, name in enumerate(df.columns):
        sources.setdefault(normalized_name(name), []).append(i)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[
        (F.coalesce(*[F.col(f"c{i}") for i in where]) if len(where) > 1 else F.col(f"c{where[0]}")).alias(new)
        for new, where in sources.items()
    ])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Names, the implied cohort, accession backfill, corrected labels."""
    df = rename_columns(df)
    if "variable_accession" in df.columns and "cohort" not in df.columns:
        df = df.withColumn("cohort", F.lit("fhs"))
    for target, source in ACCESSION_BACKFILL.items():
        if source in df.columns:
            df = df.withColumn(target, backfill(target, source) if target in df.columns else _c(source))
    if {"bdchm_label", "bdchm_label_corrected"} <= set(df.columns):
        df = df.withColumn("bdchm_label", corrected("bdchm_label", "bdchm_label_corrected"))
    return df


def split_accessions(df: DataFrame) -> DataFrame:
    """Version-free accessions in place of the id columns and all that share their prefix."""
    for source, short in ACCESSION_NAMES.items():
        if source in df.columns:
            df = df.withColumn(short, accession(source))
            df = df.select(*[_c(c) for c in df.columns if not c.startswith(source)])
    return df


def is_categorical(df: DataFrame) -> Column | None:
    """True for rows with an enum value or a non-blank example; None without such columns."""
    tests = [_c(c).isNotNull() for c in df.columns if c.startswith("enum_")]
    tests += [nonblank(c) for c in df.columns if c.startswith("example_")]
    return reduce(or_, tests) if tests else None


def standardize(df: DataFrame) -> DataFrame:
    """Accessions, case, units and the categorical type of raw metadata rows."""
    df = split_accessions(df.drop("bdchm_variable"))
    if "phv" not in df.columns:
        raise SpecError("metadata rows have no variable id column")
    df = df.filter(nonblank("phv"))
    df = df.select(*[F.lower(_c(c)).alias(c) if c in LOWER_CASED else _c(c) for c in df.columns])
    if "var_units" in df.columns:
        df = normalize_units(df, "var_units")
    categorical = is_categorical(df)
    if categorical is not None and "var_type" in df.columns:
        df = df.withColumn("var_type", F.when(categorical, F.lit("categorical")).otherwise(_c("var_type")))
    return df


def finalize(df: DataFrame) -> DataFrame:
    """Distinct rows with both keys present, and the label join key.

    The rows, often made wide by a join before, are dealt out whole: map tasks then hold no table of them.
    """
    df = df.filter(nonblank("phv"))
    if "bdchm_label" in df.columns:
        df = df.filter(nonblank("bdchm_label"))
    df = dealt_out(df).distinct()
    if "bdchm_label" in df.columns:
        df = df.withColumn("merge_bdchm_label", F.replace(_c("bdchm_label"), F.lit(" "), F.lit("")))
    return df


def collapse_flags(
    df: DataFrame, prefix: str = "race_", target: str = "race", several: str = "more than one race"
) -> DataFrame:
    """One category column from 0/1 flag columns, which are dropped."""
    flags = [c for c in df.columns if c.startswith(prefix)]
    if not flags:
        return df.withColumn(target, F.lit(""))
    set_ = [F.coalesce(_c(c) == 1, F.lit(False)) for c in flags]
    count = reduce(lambda a, b: a + b, [s.cast("int") for s in set_])
    only = F.coalesce(*[F.when(s, F.lit(c)) for s, c in zip(set_, flags)])
    category = F.when(count == 1, only).when(count > 1, F.lit(several)).otherwise(F.lit(""))
    return df.withColumn(target, category).drop(*flags)
