"""Driver-side helpers: rows as a table whose size the optimizer knows, jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AT_ONCE = 8
A = TypeVar("A")
B = TypeVar("B")

ARROW_TYPES = {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32()}


def local_frame(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A few rows as a local relation: no tasks to read it, exact size for join planning."""
    schema = T.StructType.fromDDL(ddl)
    rows = list(rows)
    columns = [pa.array([r[i] for r in rows], type=ARROW_TYPES[type(f.dataType)]) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def side_by_side(spark: SparkSession, fn: Callable[[A], B], items: Sequence[A]) -> list[B]:
    """fn of every item in order, a few at a time, so that their jobs share the cluster; the first error is raised."""
    if len(items) < 2:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(min(AT_ONCE, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fn), items))
