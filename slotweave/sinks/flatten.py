"""Nested records to flat columns."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(struct: T.StructType, parents: tuple[str, ...], separator: str) -> Iterator[Column]:
    for f in struct.fields:
        path = (*parents, f.name)
        column = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, path, separator)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            yield F.to_json(column).alias(separator.join(path))
        else:
            yield column.alias(separator.join(path))


def flatten(df: DataFrame, separator: str = "__") -> DataFrame:
    """Struct fields as ``a__b`` columns; arrays and maps as JSON text."""
    return df.select(*_leaves(df.schema, (), separator))
