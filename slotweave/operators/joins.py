"""Left joins with a reference table, safe for large tables and hot keys.

No job runs while a join is planned. Spark broadcasts a right side whose size it
knows to be small, also when it learns that only at run time. Otherwise both sides
are shuffled by a sort-merge join, whose large partitions adaptive execution splits
on the left. It can do so where both sides are shuffled for the join itself, so the
key of a right side that was grouped by it is made anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _keyed_anew(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The same rows; the planner no longer takes them for partitioned by the key."""
    key = lambda c: F.least(F.col(f"`{c}`"), F.col(f"`{c}`")).alias(c)
    return df.select(*[key(c) if c in on else F.col(f"`{c}`") for c in df.columns])


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left`` with the columns of the matching ``right`` rows; keys share their names."""
    return left.join(_keyed_anew(right, on), list(on), "left")


def dictionary_join(
    df: DataFrame, dictionary: DataFrame, key: str, dictionary_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join with a dictionary whose key has another name; its key is dropped."""
    ours = dictionary.select(F.col(f"`{dictionary_key}`").alias(key), *[F.col(f"`{c}`") for c in columns])
    joined = lookup_join(df, ours, [key])
    return joined.select(*[F.col(f"`{c}`") for c in [*df.columns, *columns]])


def one_row_per_key(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key, the least by all its columns; rows without a key are dropped."""
    keys = [F.col(f"`{k}`") for k in on]
    rest = [c for c in df.columns if c not in on]
    keyed = df.filter(reduce(and_, [k.isNotNull() for k in keys]))
    if not rest:
        return keyed.distinct()
    least = F.min(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]))
    grouped = keyed.groupBy(*keys).agg(least.alias("__row"))
    return grouped.select(*keys, *[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(rest)])


def duplicate_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.groupBy(*[F.col(f"`{k}`") for k in on])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def dealt_out(df: DataFrame, *by: str) -> DataFrame:
    """The same rows in as many partitions as shuffles have, by the given columns, or else all plain ones.

    For rows that become wide in the same stage: adaptive execution, which knows them as narrow only, does not put
    these partitions together.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = (T.StringType, T.NumericType, T.BooleanType, T.DatetimeType)
    keys = by or [f.name for f in df.schema.fields if isinstance(f.dataType, plain)]
    return df.repartition(n, *[F.col(f"`{c}`") for c in keys])
