"""Grouped text, pivots, unions and versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.errors import DataError
from slotweave.functions.local import local_frame
from slotweave.operators.joins import duplicate_keys


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def join_distinct_text(df: DataFrame, keys: Sequence[str], columns: Sequence[str], separator: str = ", ") -> DataFrame:
    """Per key, the sorted distinct non-null texts of each column in one string.

    Null keys form their own group. Values are reduced to sets before the
    shuffle, so a hot key moves its distinct values only.
    """
    joined = [
        F.array_join(F.array_sort(F.collect_set(_c(c).cast("string"))), separator).alias(c) for c in columns
    ]
    return df.groupBy(*[_c(k) for k in keys]).agg(*joined)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise with a few examples when a key occurs more than once."""
    sample = duplicate_keys(df, keys).limit(10).collect()
    if sample:
        raise DataError(f"{what} has duplicate {tuple(keys)} keys: {[tuple(r[:-1]) for r in sample]}")


def pivot_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a column that is to become columns."""
    found = df.select(_c(column)).filter(_c(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in found)


def _stray(column: str, values: Sequence) -> Column:
    """The rows of a group whose value is not listed, counted in the group's own aggregate."""
    return F.count_if(_c(column).isNotNull() & ~_c(column).isin(list(values))).alias("__stray")


def _all_listed(grouped: DataFrame, column: str) -> DataFrame:
    """The groups; one with a row of an unlisted value ends the job, as its rows would be lost."""
    message = F.lit(f"a value of {column!r} is not among the listed ones")
    return grouped.filter(F.when(F.col("__stray") > 0, F.raise_error(message).cast("boolean")).otherwise(True)).drop("__stray")


def pivot_unique(
    df: DataFrame, index: str, column: str, value: str, name: str = "{}", values: Sequence | None = None
) -> DataFrame:
    """One column per value of ``column``; two rows for one cell are an error, and so is a value not listed."""
    values = pivot_values(df, column) if values is None else list(values)
    cells = []
    for i, v in enumerate(values):
        here = _c(column) == F.lit(v)
        cells += [F.max(F.when(here, _c(value))).alias(f"v{i}"), F.count_if(here).alias(f"n{i}")]
    grouped = _all_listed(df.groupBy(_c(index)).agg(_stray(column, values), *cells), column)
    message = F.concat(F.lit(f"duplicate {column} for {index} "), F.coalesce(_c(index).cast("string"), F.lit("null")))
    return grouped.select(
        _c(index),
        *[
            F.when(F.col(f"n{i}") > 1, F.raise_error(message)).otherwise(F.col(f"v{i}")).alias(name.format(v))
            for i, v in enumerate(values)
        ],
    )


def pivot_mean(
    df: DataFrame,
    index: str,
    column: str,
    measures: Sequence[str] | None = None,
    name: str = "{measure}_timepoint_{value}",
    values: Sequence | None = None,
) -> DataFrame:
    """Mean of every measure per value of ``column``, one row per index value.

    Written as conditional means over the wide rows, which needs one shuffle
    of partial sums and never multiplies the rows. An index value without any
    measurement gives no row. A value not among the listed ``values`` is an error.
    """
    measures = [c for c in df.columns if c not in (index, column)] if measures is None else list(measures)
    values = pivot_values(df, column) if values is None else list(values)
    names = sorted((name.format(measure=m, value=v), m, v) for m in measures for v in values)
    means = [F.avg(F.when(_c(column) == F.lit(v), _c(m))).alias(n) for n, m, v in names]
    grouped = _all_listed(df.groupBy(_c(index)).agg(_stray(column, values), *means), column)
    return grouped.filter(reduce(or_, [_c(n).isNotNull() for n, _, _ in names], F.lit(False)))


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns null, each row once."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).distinct()


def distinct_spellings(df: DataFrame, name: str, order: Column | str) -> DataFrame:
    """Names unique without regard to case; the last spelling stands.

    The exact spellings are reduced first, which a hash aggregate does in the
    map tasks when the order is a number; few rows are left for the rest.
    """
    order = _c(order) if isinstance(order, str) else order
    spellings = df.groupBy(_c(name).alias("__name")).agg(F.max(order).alias("__last"))
    last = F.max_by("__name", "__last")
    return spellings.groupBy(F.lower("__name").alias("__folded")).agg(last.alias(name)).select(name)


def header_names(columns: Sequence[str], spark, start: int = 1) -> DataFrame:
    """Header cells from the ``start``-th column on, distinct and sorted."""
    rows = [(i, c) for i, c in enumerate(columns, 1) if i >= start]
    named = local_frame(spark, rows, "pos int, conditions string")
    return distinct_spellings(named, "conditions", "pos").orderBy("conditions")


def version_key(version: Column | str) -> Column:
    """A version text as its numbers, which order as versions do."""
    version = F.col(version) if isinstance(version, str) else version
    return F.transform(F.regexp_extract_all(version, F.lit(r"(\d+)"), 1), lambda x: x.cast("bigint"))


def latest_version(df: DataFrame, version: str, by: Sequence[str] = ()) -> DataFrame:
    """The highest version (per group)."""
    latest = F.max_by(_c(version), F.struct(version_key(_c(version)), _c(version))).alias(version)
    return df.groupBy(*[_c(b) for b in by]).agg(latest)
