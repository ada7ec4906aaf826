"""Record writers: TSV, JSON Lines, wrapped JSON, YAML, quoted CSV.

Every writer leaves a directory of part files written by many tasks. Where a
format needs a frame around all records, the parts in name order are the
document; tabular parts each carry the header.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.errors import SpecError
from slotweave.functions.local import local_frame
from slotweave.sinks.flatten import flatten


def write_tsv(df: DataFrame, path: str, key: str = "") -> None:
    """Flattened records, tab separated, with a header; null is an empty cell."""
    flatten(df).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="")


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per record."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def write_jsonl(df: DataFrame, path: str, key: str = "") -> None:
    json_lines(df).write.mode("overwrite").text(path)


def write_wrapped_json(df: DataFrame, path: str, key: str) -> None:
    """``{"<key>": [...]}`` spread over the parts of ``path`` in name order.

    The frame must give the same rows on every read (a stored table does): a
    first pass finds the first row, which goes without a leading comma.
    """
    numbered = json_lines(df).withColumn("id", F.monotonically_increasing_id())
    first = numbered.agg(F.min("id").alias("id")).first().id
    comma = F.when(F.col("id") == F.lit(first), F.lit("")).otherwise(F.lit(","))
    body = numbered.select(F.concat(comma, "value").alias("value"))
    spark = df.sparkSession
    head = local_frame(spark, [(f'{{"{key}": [',)], "value string")
    tail = local_frame(spark, [("]}",)], "value string")
    head.unionAll(body).unionAll(tail).write.mode("overwrite").text(path)


def _scalar_yaml(c: Column) -> Column:
    """A JSON scalar, which YAML reads too; exponents need their sign."""
    text = F.to_json(F.array(c))
    text = F.substring(text, F.lit(2), F.length(text) - 2)
    return F.when(text.startswith('"'), text).otherwise(F.regexp_replace(text, r"([0-9])E([0-9])", "$1E+$2"))


def _yaml_block(c: Column, dtype: T.StructType, indent: int) -> Column:
    lines = [_yaml_field(c.getField(f.name), f, indent) for f in dtype.fields]
    return F.concat_ws("\n", *lines)


def _yaml_field(c: Column, field: T.StructField, indent: int) -> Column:
    head = F.lit(f"{' ' * indent}{field.name}:")
    dtype = field.dataType
    if isinstance(dtype, T.StructType):
        nested = F.concat(head, F.lit("\n"), _yaml_block(c, dtype, indent + 2))
        return F.when(c.isNull(), F.concat(head, F.lit(" null"))).otherwise(nested)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        item_indent = indent + 2

        def item(x: Column) -> Column:
            block = _yaml_block(x, dtype.elementType, item_indent)
            return F.concat(F.lit(f"{' ' * indent}- "), F.substring(block, F.lit(item_indent + 1), F.length(block)))

        items = F.array_join(F.transform(c, item), "\n")
        return (
            F.when(c.isNull(), F.concat(head, F.lit(" null")))
            .when(F.size(c) == 0, F.concat(head, F.lit(" []")))
            .otherwise(F.concat(head, F.lit("\n"), items))
        )
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.concat(head, F.lit(" "), F.coalesce(F.to_json(c), F.lit("null")))
    return F.concat(head, F.lit(" "), _scalar_yaml(c))


def yaml_documents(df: DataFrame) -> DataFrame:
    """One YAML document per record, in block style."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.concat(F.lit("---\n"), _yaml_block(record, df.schema, 0)).alias("value"))


def write_yaml(df: DataFrame, path: str, key: str = "") -> None:
    yaml_documents(df).write.mode("overwrite").text(path)


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """Every cell quoted, with a header."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).na.fill("")
    text.write.mode("overwrite").csv(path, header=True, quoteAll=True, emptyValue="", escape='"')


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table without its problem columns; absent ones are ignored."""
    return df.drop(*columns)


Writer = Callable[[DataFrame, str, str], None]
FORMATS: dict[str, Writer] = {
    "tsv": write_tsv,
    "jsonl": write_jsonl,
    "json": write_wrapped_json,
    "yaml": write_yaml,
}


#: Formats whose writer reads the records once.
ONE_PASS = frozenset({"tsv", "jsonl", "yaml"})


def output_name(entity: str, fmt: str, prefix: str = "", postfix: str = "") -> str:
    """``prefix-entity-postfix.fmt`` without the empty parts."""
    return "-".join(x for x in (prefix, entity, postfix) if x) + f".{fmt}"


def write_entity(
    df: DataFrame, directory: str, entity: str, formats: Sequence[str] = ("yaml",), prefix: str = "", postfix: str = ""
) -> list[str]:
    """One stored table in several formats; the first format is the primary one."""
    unknown = [f for f in formats if f not in FORMATS]
    if unknown:
        raise SpecError(f"unknown output formats {unknown}; known: {sorted(FORMATS)}")
    paths = []
    for fmt in formats:
        path = f"{directory}/{output_name(entity, fmt, prefix, postfix)}"
        FORMATS[fmt](df, path, f"{entity.lower()}s")
        paths.append(path)
    return paths
