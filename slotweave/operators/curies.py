"""CURIE inventory and remapping in text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.functions.text import CURIE_PATTERN, curies
from slotweave.operators.joins import lookup_join

# A cut is two control characters; the first one is escaped where a text has it.
CUT, ESCAPE, ESCAPED = "\u0001\u0002", "\u0001", "\u0001\u0003"


def curie_inventory(df: DataFrame, column: str) -> DataFrame:
    """Distinct CURIEs of a text column with the number of mentions."""
    found = df.select(F.explode(curies(column)).alias("curie"))
    return found.groupBy("curie").agg(F.count(F.lit(1)).alias("n"))


def curie_audit(df: DataFrame, column: str, file: str) -> DataFrame:
    """Files that still hold CURIEs, with how many rows and mentions."""
    mentions = F.size(curies(column))
    return (
        df.select(F.col(f"`{file}`").alias(file), mentions.alias("m"))
        .filter(F.col("m") > 0)
        .groupBy(file)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("m").alias("n_mentions"))
    )


def _tokens(column: Column) -> Column:
    """The text cut before and after every CURIE."""
    guarded = F.replace(column, F.lit(ESCAPE), F.lit(ESCAPED))
    return F.split(F.regexp_replace(guarded, CURIE_PATTERN, f"{CUT}$1{CUT}"), CUT)


def _joined(tokens: Column) -> Column:
    """The text of its tokens."""
    return F.replace(F.array_join(tokens, ""), F.lit(ESCAPED), F.lit(ESCAPE))


def remap_curies(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace every listed CURIE of a text column in one pass.

    ``mapping`` has columns ``old`` and ``new`` and may be of any size: only the CURIEs of
    the distinct texts are joined to it; each text then gets its part of the map.
    """
    mapping = mapping.select("old", "new").filter(F.col("old").isNotNull()).groupBy("old").agg(F.max("new").alias("new"))
    text = F.col(f"`{column}`")
    has = F.coalesce(text.rlike(CURIE_PATTERN), F.lit(False))
    keyed = df.filter(has).withColumn("__key", F.sha2(text, 256))
    found = keyed.select("__key", F.explode(F.array_distinct(curies(column))).alias("old"))
    known = lookup_join(found.distinct(), mapping, ["old"]).filter(F.col("new").isNotNull())
    ours = known.groupBy("__key").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("__map"))
    joined = lookup_join(keyed, ours, ["__key"])
    remapped = _joined(F.transform(_tokens(text), lambda t: F.coalesce(F.try_element_at("__map", t), t)))
    changed = joined.withColumn(column, F.when(F.col("__map").isNull(), text).otherwise(remapped)).select(*df.columns)
    return df.filter(~has).union(changed)  # texts without a CURIE stay where they are
