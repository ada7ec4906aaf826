"""One wide table of annotated conditions per study."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.functions.text import source_text
from slotweave.operators.clean import blank_nulls
from slotweave.operators.joins import dictionary_join, lookup_join
from slotweave.operators.reshape import join_distinct_text, pivot_mean, pivot_unique

# What identifies an annotated condition, what is collapsed, what is kept.
GROUP = ("id", "timepoint", "condition_name", "has_condition", "UUID")
COLLAPSED = (
    "hpo_result_curie", "hpo_result_label", "hpo_result_match_type", "mondo_result_curie", "mondo_result_label",
    "mondo_result_match_type", "annotation_source", "annotation_method", "ontology",
)
KEPT = (
    "id", "timepoint", "condition_name", "hpo_result_curie", "hpo_result_label", "mondo_result_curie",
    "mondo_result_label",
)
SOURCE_TEXT = "conditionMeasureSourceText"
# Dictionary variables that name no condition.
KEY_VARIABLES = ("id", "timepoint")


def condition_texts(dictionary: DataFrame, is_condition: Column | None = None) -> DataFrame:
    """The dictionary with the source text of each condition; other variables have none."""
    if is_condition is None:
        is_condition = ~F.coalesce(F.col("variable"), F.lit("")).isin(*KEY_VARIABLES)
    return dictionary.withColumn(SOURCE_TEXT, F.when(is_condition, source_text("description")))


def condition_table(
    annotations: DataFrame,
    dictionary: DataFrame,
    ages: DataFrame,
    measures: DataFrame,
    timepoints: Sequence | None = None,
    is_condition: Column | None = None,
) -> DataFrame:
    """Annotations collapsed per condition, with source text, ages and measures per time point.

    ``timepoints`` saves the pass that looks for them; a row of another time point is an error.
    """
    collapsed = join_distinct_text(annotations, GROUP, COLLAPSED).select(*KEPT)
    texts = condition_texts(dictionary, is_condition)
    described = dictionary_join(collapsed, texts, "condition_name", "variable", [SOURCE_TEXT])
    by_age = pivot_unique(ages, "id", "timepoint", "age_at_visit", "age_at_timepoint_{}", timepoints)
    by_measure = pivot_mean(measures, "id", "timepoint", values=timepoints)
    aged = lookup_join(described, by_age, ["id"])
    wide = lookup_join(aged, by_measure, ["id"])
    return blank_nulls(wide.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns]))
