"""Typed views of text cells, value maps, and range coercion."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: what a text cell must look like to count as a number.
NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"


# Codes up to which a mapping is a literal of the plan.
LITERAL_CODES = 100


def number(c: Column) -> Column:
    """The text cell as a double, null when it is not written as a number (as `5d`, `Infinity` and `nan` are not)."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def number_text(c: Column, dtype: T.DataType) -> Column:
    """The cell as text; a whole double is written without a fraction."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = c.try_cast("bigint")
        return F.when(whole.cast("double") == c, whole.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Value of ``key`` in a short driver-side mapping, null when it is not listed.

    The literal map folds into one constant of the plan, which is searched from its start;
    mappings of more than LITERAL_CODES are joined (see ``plans.derive``).
    """
    if not mapping:
        return F.lit(None).cast("string")
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(entries, key)


def coerce(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast a value to the type of its slot; what does not fit becomes null."""
    if source == target:
        return c
    if isinstance(source, T.NullType):
        return c.cast(target)
    if isinstance(target, T.StringType):
        return number_text(c, source)
    if isinstance(target, (T.LongType, T.IntegerType)) and not isinstance(source, T.IntegralType):
        value = number(c) if isinstance(source, T.StringType) else c.try_cast("double")
        return value.try_cast(target)
    if isinstance(target, (T.DoubleType, T.FloatType)) and isinstance(source, T.StringType):
        return number(c).try_cast(target)
    return c.try_cast(target)
