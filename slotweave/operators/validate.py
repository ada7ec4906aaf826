"""Rows checked against a class of a schema."""

from __future__ import annotations

import logging
from collections.abc import Collection
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.errors import DataError
from slotweave.functions.local import local_frame
from slotweave.functions.text import nonblank
from slotweave.functions.values import number
from slotweave.operators.joins import duplicate_keys
from slotweave.plans.schema import SCALAR_TYPES, TargetSchema, TargetSlot

logger = logging.getLogger(__name__)

VIOLATION = "`table` string, slot string, rule string, value string"
VIOLATION_COUNT = "`table` string, slot string, rule string, n bigint"


def _misfit(column: Column, dtype: T.DataType, slot: TargetSlot, schema: TargetSchema) -> tuple[str, Column] | None:
    """The rule a present cell can break, and the test for breaking it."""
    if slot.range in schema.enums:
        return "enum", ~column.cast("string").isin(*schema.enums[slot.range])
    if slot.range == "integer":
        if isinstance(dtype, T.IntegralType):
            return None
        value = number(column)
        return "type", value.isNull() | (value != F.floor(value))
    if slot.range in ("float", "double", "decimal"):
        return None if isinstance(dtype, T.NumericType) else ("type", number(column).isNull())
    if slot.range in ("date", "datetime", "boolean"):
        return "type", column.try_cast(SCALAR_TYPES[slot.range]).isNull()
    return None


def violations(
    df: DataFrame, table: str, schema: TargetSchema, cls: str | None = None, proved: Collection[str] = ()
) -> DataFrame:
    """Every broken rule as (table, slot, rule, value).

    Row rules come from one scan; a duplicate key is one row per value, found for
    all keys together by counting partial sums of their values. Columns `proved` to be
    unique are not counted again.
    """
    slots = schema.classes[cls or table]
    types = {f.name: f.dataType for f in df.schema.fields}
    spark = df.sparkSession
    shape = [(table, c, "unknown column", None) for c in types if c not in slots]
    shape += [(table, s.name, "missing column", None) for s in slots.values() if s.required and s.name not in types]
    parts = [local_frame(spark, shape, VIOLATION)] if shape else []
    checks = []
    for slot in slots.values():
        if slot.name not in types:
            continue
        column = F.col(f"`{slot.name}`")
        text = column.cast("string")
        if slot.required or slot.identifier:
            checks.append(_check(~nonblank(text), slot.name, "required", text))
        misfit = _misfit(column, types[slot.name], slot, schema)
        if misfit is not None:
            rule, test = misfit
            checks.append(_check(nonblank(text) & test, slot.name, rule, text))
    if checks:
        # Clean rows, the most of them, are passed over by one plain condition.
        broken = reduce(or_, [test for test, _ in checks])
        listed = F.array_compact(F.array(*[F.when(test, entry) for test, entry in checks]))
        found = df.filter(broken).select(F.explode(listed).alias("v"))
        parts.append(found.select(F.lit(table).alias("table"), "v.slot", "v.rule", "v.value"))
    unique = [s.name for s in slots.values() if s.identifier] + list(schema.unique_keys.get(cls or table, ()))
    keys = [(key,) if isinstance(key, str) else tuple(key) for key in unique]
    keys = [key for key in keys if set(key) <= set(types) and not set(key) & set(proved)]
    if keys:
        # The cells of all keys come from one scan.
        cells = {key: [F.col(f"`{n}`") for n in key] for key in keys}
        entries = [
            F.when(
                reduce(and_, [c.isNotNull() for c in cs]),
                F.struct(F.lit(", ".join(key)).alias("slot"), F.array(*[c.cast("string") for c in cs]).alias("cells")),
            )
            for key, cs in cells.items()
        ]
        found = df.select(F.explode(F.array_compact(F.array(*entries))).alias("k")).select("k.slot", "k.cells")
        parts.append(
            duplicate_keys(found, ["slot", "cells"]).select(
                F.lit(table).alias("table"), "slot", F.lit("duplicate").alias("rule"), F.array_join("cells", ", ").alias("value")
            )
        )
    if not parts:
        return local_frame(spark, [], VIOLATION)
    return reduce(DataFrame.unionAll, parts)


def _check(broken: Column, slot: str, rule: str, value: Column) -> tuple[Column, Column]:
    entry = F.struct(F.lit(slot).alias("slot"), F.lit(rule).alias("rule"), value.alias("value"))
    return F.coalesce(broken, F.lit(False)), entry


def violation_counts(found: DataFrame) -> DataFrame:
    """Violations counted per table, slot and rule."""
    return found.groupBy("table", "slot", "rule").agg(F.count(F.lit(1)).alias("n"))


def verdicts(counts: DataFrame, tables: list[str]) -> DataFrame:
    """One verdict per table from the violation counts: how many, and whether it passes."""
    all_tables = local_frame(counts.sparkSession, [(t,) for t in tables], "`table` string")
    counted = counts.groupBy("table").agg(F.sum("n").alias("n"))
    joined = all_tables.join(counted, "table", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return joined.select("table", F.col("n").alias("n_violations"), (F.col("n") == 0).alias("passed"))


def summary(verdict: DataFrame) -> DataFrame:
    """How many tables there are, how many fail, and which."""
    failing = F.when(~F.col("passed"), F.col("table"))
    return verdict.agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.count_if(~F.col("passed")).alias("n_failing"),
        F.array_join(F.array_sort(F.collect_set(failing)), ", ").alias("failing"),
    )


def gate(verdict: DataFrame, strict: bool) -> bool:
    """True when every table passes; a failure raises in strict mode and warns otherwise."""
    result = summary(verdict).first()
    if result.n_failing == 0:
        return True
    message = f"{result.n_failing} of {result.n_tables} tables fail validation: {result.failing}"
    if strict:
        raise DataError(message)
    logger.warning(message)
    return False
