"""Column profiles, and the source schema inferred from them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.functions.local import local_frame, side_by_side
from slotweave.plans.schema import TargetSchema, TargetSlot
from slotweave.sources.catalog import Catalog

# What a text cell must look like to count as a type.
INTEGER = r"^[-+]?[0-9]+$"
FLOAT = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MEASUREMENT = r"^[-+]?[0-9]+(\.[0-9]+)? [A-Za-z%/\[\]{}]+$"

COLUMNS_AT_ONCE = 100  # groups of one aggregate, which Spark keeps in memory up to 128
SLICE_VALUES = 10_000
PROFILE = (
    "position int, column string, n_rows bigint, n_present bigint, n_distinct bigint, "
    "min_length int, max_length int, example string, type string"
)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _scalar_columns(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]


def _kind(dtype: T.DataType) -> str:
    """What is known of a column's cells without looking at them."""
    if isinstance(dtype, T.StringType):
        return "text"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.NumericType):
        return "float"
    return "date" if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "string"


def profile_columns(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per scalar column: counts, lengths, an example, and the inferred type.

    The cells of up to COLUMNS_AT_ONCE columns become rows (position, value) of one grouped
    aggregate, so a plan does not grow with the columns. ``exact`` counts the
    distinct values exactly, in a second pass; otherwise the count is an
    estimate of about two percent.
    """
    fields = _scalar_columns(df)
    listed = local_frame(
        df.sparkSession, [(i, f.name, _kind(f.dataType)) for i, f in enumerate(fields)], "position int, column string, kind string"
    )
    value = F.col("value")
    tests = {
        "integer": value.rlike(INTEGER),
        "float": value.rlike(FLOAT),
        "date": value.rlike(DATE) & value.try_cast("date").isNotNull(),
        "measurement": value.rlike(MEASUREMENT),
    }
    parts = []
    for at in range(0, len(fields), COLUMNS_AT_ONCE):
        part = list(enumerate(fields))[at : at + COLUMNS_AT_ONCE]
        cells = F.array(*[F.struct(F.lit(i).alias("position"), _c(f.name).cast("string").alias("value")) for i, f in part])
        parts.append(
            df.select(F.explode(cells).alias("c"))
            .select("c.position", "c.value")
            .groupBy("position")
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count(value).alias("n_present"),
                F.hll_sketch_estimate(F.hll_sketch_agg(value)).alias("n_distinct"),
                F.min(F.length(value)).cast("int").alias("min_length"),
                F.max(F.length(value)).cast("int").alias("max_length"),
                F.max(value).alias("example"),
                *[F.count_if(test).alias(name) for name, test in tests.items()],
            )
        )
    if not parts:
        return local_frame(df.sparkSession, [], PROFILE)
    typed = F.when(F.coalesce("n_present", F.lit(0)) == 0, "string").when(F.col("kind") != "text", F.col("kind"))
    for name in tests:
        typed = typed.when(F.col(name) == F.col("n_present"), name)
    number = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    profile = listed.join(reduce(DataFrame.unionAll, parts), "position", "left").select(
        "position", "column", number("n_rows"), number("n_present"), number("n_distinct"), "min_length", "max_length", "example",
        typed.otherwise("string").alias("type"),
    )
    if not exact:
        return profile
    counted = exact_distinct(df, [f.name for f in fields])
    return (
        profile.drop("n_distinct")
        .join(counted, "column", "left")
        .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0).cast("bigint")))
        .select(*profile.columns)
    )


def exact_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_distinct): values are reduced to distinct ones before the shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(cells).alias("c")).select("c.*").filter(F.col("value").isNotNull()).distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


@dataclass(frozen=True)
class Slice:
    """What a slice of a column's values shows: whether one occurs twice, and how many there are."""

    repeated: bool
    values: int
    whole: bool  # the slice holds all values


def sliced(df: DataFrame, columns: list[str], n_rows: int, slice_values: int = SLICE_VALUES) -> dict[str, Slice]:
    """A slice of each column's values, drawn by their hash, so that all cells of a value are in it or none.

    It has about `slice_values` values of a column whose values are all different. Only cells of the slice
    are moved, reduced to distinct values first. A value that occurs twice in it disproves a key for
    certain, and a column has at least the values its slice has.
    """
    parts = max(1, n_rows // slice_values)

    def cell(i: int, name: str) -> Column:
        value = _c(name).cast("string")
        inside = value.isNotNull() & (F.pmod(F.xxhash64(value), F.lit(parts)) == 0)
        return F.when(inside, F.struct(F.lit(i).alias("position"), value.alias("value")))

    cells = F.array_compact(F.array(*[cell(i, c) for i, c in enumerate(columns)]))
    counted = df.select(F.explode(cells).alias("c")).groupBy("c.position", "c.value").agg(F.count(F.lit(1)).alias("n"))
    told = counted.groupBy("position").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("values")).collect()
    found = {columns[r.position]: Slice(r.most > 1, r["values"], parts == 1) for r in told}
    return {c: found.get(c, Slice(False, 0, parts == 1)) for c in columns}


def surviving_counts(
    df: DataFrame, n_rows: int, keys: set[str], enums: set[str], max_values: int, slice_values: int = SLICE_VALUES
) -> dict[str, int]:
    """Exact distinct counts of the columns that may still be keys (`keys`) or enums (`enums`) after a slice of values.

    Columns that the slice disproves are left out, so only the values of survivors are all moved.
    """
    seen = sliced(df, sorted(keys | enums), n_rows, slice_values) if keys | enums else {}
    left = {c for c in keys if not seen[c].repeated} | {c for c in enums if seen[c].values <= max_values}
    counts = {c: seen[c].values for c in left if seen[c].whole}
    open_ = sorted(left - set(counts))
    return counts | ({r.column: r.n_distinct for r in exact_distinct(df, open_).collect()} if open_ else {})


def key_columns(df: DataFrame, slice_values: int = SLICE_VALUES) -> DataFrame:
    """(position, column, role) of the columns in which every row has its own value; the first is the identifier."""
    fields = [f.name for f in _scalar_columns(df)]
    present = [F.count(_c(f)).alias(f"c{i}") for i, f in enumerate(fields)]
    n_rows, *found = df.agg(F.count(F.lit(1)), *present).first()
    complete = {f for f, n in zip(fields, found) if n == n_rows > 0}
    counts = surviving_counts(df, n_rows, complete, set(), 0, slice_values)
    keys = [(i, f) for i, f in enumerate(fields) if counts.get(f) == n_rows > 0]
    rows = [(i, f, "unique_key" if k else "identifier") for k, (i, f) in enumerate(keys)]
    return local_frame(df.sparkSession, rows, "position int, column string, role string")


def distinct_ratio(profile: DataFrame) -> DataFrame:
    """The profile with the share of distinct values among all rows."""
    return profile.withColumn("ratio", F.try_divide("n_distinct", "n_rows"))


def unique_columns(profile: DataFrame) -> DataFrame:
    """Columns in which every row has its own value; the first is the identifier.

    Needs exact distinct counts.
    """
    full = (F.col("n_rows") > 0) & (F.col("n_present") == F.col("n_rows")) & (F.col("n_distinct") == F.col("n_rows"))
    # The profile has one row per column, so the keys fit in one row.
    keys = profile.filter(full).agg(F.array_sort(F.collect_list(F.struct("position", "column"))).alias("keys"))
    ranked = keys.select(F.posexplode("keys").alias("rank", "k"))
    role = F.when(F.col("rank") == 0, "identifier").otherwise("unique_key")
    return ranked.select("k.position", "k.column", role.alias("role"))


@dataclass(frozen=True)
class InferenceOptions:
    """``max_enum_size`` 0 switches enums off; the threshold bounds distinct/rows below."""

    enum_threshold: float = 1.0
    max_enum_size: int = 0

    def is_enum(self, kind: str, n_distinct: int, n_rows: int) -> bool:
        if kind != "string" or not 0 < n_distinct <= self.max_enum_size:
            return False
        return self.enum_threshold >= 1.0 or n_distinct / n_rows < self.enum_threshold


def infer_table(df: DataFrame, options: InferenceOptions = InferenceOptions()) -> tuple[dict, dict, tuple]:
    """Slots, enums and unique keys of one table.

    Columns without a missing cell may be keys, and text columns enums if these are
    asked for. Most are disproved by an exact slice of their values; those left are counted
    exactly, so no estimate decides.
    """
    profile = profile_columns(df).orderBy("position").collect()  # one row per column
    possible_key = {
        r.column for r in profile
        if r.n_rows and r.n_present == r.n_rows
    }
    possible_enum = {
        r.column for r in profile
        if r.type == "string" and r.n_present and options.max_enum_size
    }
    n_rows = max((r.n_rows for r in profile), default=0)
    exact = surviving_counts(df, n_rows, possible_key, possible_enum, options.max_enum_size)
    listed = [
        r.column
        for r in profile
        if r.column in possible_enum and options.is_enum(r.type, exact.get(r.column, 0), r.n_rows)
    ]
    values = {}
    if listed:  # each set holds at most max_enum_size values
        sets = df.agg(*[F.collect_set(_c(c)).alias(f"s{i}") for i, c in enumerate(listed)]).first()
        values = {c: tuple(sorted(sets[i])) for i, c in enumerate(listed)}
    enums = {f"{c}_enum": vs for c, vs in values.items()}
    slots: dict[str, TargetSlot] = {}
    keys: list[str] = []
    for r in profile:
        if r.column in possible_key and exact.get(r.column) == r.n_rows:
            keys.append(r.column)
        kind = f"{r.column}_enum" if r.column in values else r.type
        slots[r.column] = TargetSlot(r.column, kind, identifier=keys == [r.column])
    return slots, enums, tuple(keys[1:])


def infer_schema(catalog: Catalog, options: InferenceOptions = InferenceOptions()) -> TargetSchema:
    """The source schema: one class per table.

    An enum is named after its column; tables that share a column name share
    the enum, which then holds the values of all of them.
    """
    classes, enums, unique = {}, {}, {}
    inferred = side_by_side(catalog.spark, lambda t: infer_table(catalog[t], options), list(catalog))
    for table, (slots, found, keys) in zip(catalog, inferred):
        classes[table] = slots
        for name, values in found.items():
            enums[name] = tuple(sorted({*enums.get(name, ()), *values}))
        if keys:
            unique[table] = keys
    return TargetSchema(classes, enums, unique)


def schema_yaml(name: str, schema: TargetSchema) -> str:
    """The schema as YAML text."""
    classes = {}
    for table, slots in schema.classes.items():
        attributes = {}
        for s in slots.values():
            body: dict = {"range": s.range or "string"}
            if s.identifier:
                body["identifier"] = True
            if s.required:
                body["required"] = True
            attributes[s.name] = body
        classes[table] = {"attributes": attributes}
        if table in schema.unique_keys:
            classes[table]["unique_keys"] = {
                f"{k}_key": {"unique_key_slots": [k]} for k in schema.unique_keys[table]
            }
    enums = {e: {"permissible_values": {v: {"description": v} for v in vs}} for e, vs in schema.enums.items()}
    return yaml.safe_dump({"name": name, "enums": enums, "classes": classes}, sort_keys=False, allow_unicode=True)
