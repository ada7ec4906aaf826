"""Class derivations compiled to one DataFrame plan per entity.

All blocks of an entity that read one table share one scan: each block becomes
a struct of typed slots, the structs of a table form an array, and ``explode``
turns the array into records. Cross-table references become left joins that
keep exactly one right row per key, so every source row yields exactly one
record per block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.errors import DataError, SourceError, SpecError
from slotweave.functions.local import local_frame
from slotweave.functions.units import convert
from slotweave.functions.values import LITERAL_CODES, coerce, lookup
from slotweave.operators.joins import duplicate_keys, lookup_join, one_row_per_key
from slotweave.plans.expression import (
    ExpressionCompiler,
    RowError,
    SlotFunction,
    Value,
    as_number,
    as_text,
    literal,
    unify,
)
from slotweave.plans.schema import NUMERIC_RANGES, SCALAR_TYPES, TargetSchema
from slotweave.plans.spec import ClassDerivation, SlotDerivation, SpecSet
from slotweave.sources.catalog import Catalog

ERRORS = "_errors"
ERROR_TYPE = "array<struct<slot:string,message:string>>"
DROPPED = "rows beyond the first of their join key are left out"
ERROR_SUMMARY = "entity string, `table` string, slot string, message string, n bigint"


# --- compiled blocks -------------------------------------------------------


@dataclass(frozen=True)
class Scalar:
    value: Value
    range: str | None = None


@dataclass(frozen=True)
class Record:
    cls: str
    slots: Mapping[str, Scalar | Record | Items]


@dataclass(frozen=True)
class Items:
    records: tuple[Record, ...]


Node = Scalar | Record | Items


@dataclass(frozen=True)
class Coded:
    """A slot whose code is looked up in the entity's dictionary."""

    name: str  # of the column that will hold the value
    mapping: int  # number of its mapping in the dictionary
    code: Column

    @property
    def key(self) -> str:
        return f"{self.name}_key"


class Dictionary:
    """The large code mappings of an entity as one table of (key, value).

    A key is a mapping's number and the code, so that one table serves all coded slots: it is
    broadcast (or shuffled) once, and every slot probes it.
    """

    def __init__(self) -> None:
        self.mappings: dict[tuple[tuple[str, str], ...], int] = {}
        self.slots = 0

    def coded(self, mapping: Mapping[str, str], code: Column) -> Coded:
        number = self.mappings.setdefault(tuple(sorted(mapping.items())), len(self.mappings))
        self.slots += 1
        return Coded(f"__code{self.slots}", number, code)

    def frame(self, spark) -> DataFrame:
        rows = [(_code_key(n, k), v) for entries, n in self.mappings.items() for k, v in entries]
        return local_frame(spark, rows, "key string, value string")

    @staticmethod
    def joined(df: DataFrame, dictionary: DataFrame, coded: list[Coded]) -> DataFrame:
        """The rows with the value of every coded slot, null for an unlisted code."""
        df = df.select("*", *[F.concat(F.lit(_code_key(c.mapping, "")), c.code).alias(c.key) for c in coded])
        for c in coded:
            df = df.join(dictionary.select(F.col("key").alias(c.key), F.col("value").alias(c.name)), c.key, "left").drop(c.key)
        return df


def _code_key(mapping: int, code: str) -> str:
    return f"{mapping}:{code}"


@dataclass
class Block:
    """One compiled class derivation."""

    table: str
    record: Record
    errors: list[tuple[str, RowError]]
    joined: dict[tuple[str, str], set[str]]  # (table, key) -> columns
    coded: list[Coded]


def _joined_name(table: str, key: str, column: str) -> str:
    return f"{table}@{key}@{column}"


class _BlockCompiler:
    def __init__(self, block: ClassDerivation, mapper: Mapper, dictionary: Dictionary):
        self.block = block
        self.mapper = mapper
        self.dictionary = dictionary
        self.coded: list[Coded] = []
        self.catalog = mapper.catalog
        self.source = mapper.types(block.populated_from)
        self.joins: dict[str, str] = dict(block.joins)
        self.joined: dict[tuple[str, str], set[str]] = {}
        self.errors: list[tuple[str, RowError]] = []
        self.expressions = ExpressionCompiler(self.resolve, mapper.functions)

    def compile(self) -> Block:
        for table, key in self.joins.items():
            if key not in self.source or key not in self.catalog[table].columns:
                raise SpecError(f"join key {key!r} is missing in {self.block.populated_from!r} or {table!r}")
        record = self._class(self.block, "")
        return Block(self.block.populated_from, record, self.errors, self.joined, self.coded)

    def resolve(self, name: str) -> Value:
        table, _, column = name.partition(".")
        if column and table in self.joins:
            types = self.mapper.types(table)
            if column not in types:
                raise SpecError(f"table {table!r} has no column {column!r}")
            key = self.joins[table]
            self.joined.setdefault((table, key), set()).add(column)
            return self.mapper.cell(_joined_name(table, key, column), types[column], self.mapper.words(table, column))
        if column and table == self.block.populated_from and column in self.source:
            name = column
        if name not in self.source:
            raise SpecError(f"table {self.block.populated_from!r} has no column {name!r}")
        return self.mapper.cell(name, self.source[name], self.mapper.words(self.block.populated_from, name))

    def _class(self, block: ClassDerivation, path: str) -> Record:
        if block.populated_from != self.block.populated_from and block.populated_from not in self.joins:
            raise SpecError(
                f"nested {block.name!r} reads {block.populated_from!r}, which {self.block.name!r} does not join"
            )
        self.joins.update(block.joins)
        slots = {s.name: self._slot(s, block, f"{path}{s.name}") for s in block.slots}
        return Record(block.name, slots)

    def _slot(self, slot: SlotDerivation, block: ClassDerivation, path: str) -> Node:
        target = self.mapper.target.slot(block.name, slot.name)
        if slot.objects:
            records = tuple(
                self._class(o, f"{path}[{i}]." if len(slot.objects) > 1 else f"{path}.")
                for i, o in enumerate(slot.objects)
            )
            many = len(records) > 1 or bool(target and target.multivalued)
            return Items(records) if many else records[0]
        value = self._scalar(slot, block, target)
        self.errors.extend((path, e) for e in value.errors)
        return Scalar(value, slot.range)

    def _scalar(self, slot: SlotDerivation, block: ClassDerivation, target) -> Value:
        if slot.expr is not None:
            declared = SCALAR_TYPES.get(slot.range or (target.range if target else None) or "")
            value = self.expressions.compile(str(slot.expr), declared)
        elif slot.has_value:
            value = literal(slot.value)
        elif slot.populated_from is not None:
            value = self._column(str(slot.populated_from), block)
        elif slot.name in self.source:
            value = self.resolve(slot.name)
        else:
            value = literal(None)
        if slot.value_mappings is not None:
            value = Value(self._looked_up(slot.value_mappings, as_text(value)), T.StringType(), errors=value.errors)
        elif slot.unit_conversion is not None:
            unit = slot.unit_conversion
            parsed = as_number(value)
            errors = value.errors if unit.none_if_non_numeric else parsed.errors
            column = convert(parsed.column, unit.source_unit, unit.target_unit)
            value = Value(column, T.DoubleType(), errors=errors)
        elif target is not None and target.range in self.mapper.specs.enums:
            enum = self.mapper.specs.enums[target.range]
            key = as_text(value)
            mapped = self._looked_up(enum.sources, key)
            value = Value(F.coalesce(mapped, key) if enum.mirror_source else mapped, T.StringType(), errors=value.errors)
        return value

    def _looked_up(self, mapping: Mapping[str, str], code: Column) -> Column:
        """A code's value: from a literal map if it is short, else from the entity's dictionary."""
        if len(mapping) <= LITERAL_CODES:
            return lookup(mapping, code)
        self.coded.append(self.dictionary.coded(mapping, code))
        return F.col(self.coded[-1].name)

    def _column(self, name: str, block: ClassDerivation) -> Value:
        if block.populated_from != self.block.populated_from and "." not in name:
            name = f"{block.populated_from}.{name}"
        return self.resolve(name)


# --- shapes: one record type for all blocks --------------------------------


@dataclass
class Shape:
    """The merged type of one slot over all blocks."""

    types: list[T.DataType] = field(default_factory=list)
    declared: T.DataType | None = None
    fields: dict[str, Shape] | None = None
    many: bool = False

    def dtype(self) -> T.DataType:
        if self.fields is not None:
            record = T.StructType([T.StructField(n, s.dtype()) for n, s in self.fields.items()])
            return T.ArrayType(record) if self.many else record
        return self.declared if self.declared is not None else unify(self.types)


class Mapper:
    """Derives entities from a catalogue of tables."""

    def __init__(
        self,
        catalog: Catalog,
        specs: SpecSet,
        target: TargetSchema | None = None,
        strict: bool = False,
        functions: Mapping[str, SlotFunction] | None = None,
        source: TargetSchema | None = None,
    ):
        """``source`` is the schema inferred from the tables; without it no text column is known to hold no numbers."""
        self.catalog = catalog
        self.source = source or TargetSchema({})
        self.specs = specs
        self.target = target or TargetSchema({})
        self.strict = strict
        self.functions: dict[str, SlotFunction] = dict(functions or {})
        self._types: dict[str, dict[str, T.DataType]] = {}
        self._cells: dict[tuple[str, T.DataType, bool], Value] = {}

    def over(self, catalog: Catalog) -> Mapper:
        """The same specs over other tables."""
        return Mapper(catalog, self.specs, self.target, self.strict, self.functions, self.source)

    def types(self, table: str) -> dict[str, T.DataType]:
        """Column types of a table."""
        if table not in self._types:
            self._types[table] = {f.name: f.dataType for f in self.catalog[table].schema.fields}
        return self._types[table]

    def words(self, table: str, column: str) -> bool:
        """Whether the source schema says that a column holds other text than numbers."""
        slot = self.source.slot(table, column)
        return slot is not None and slot.range not in NUMERIC_RANGES

    def cell(self, name: str, dtype: T.DataType, words: bool = False) -> Value:
        """A source cell, built once however many slots read it."""
        key = (name, dtype, words)
        if key not in self._cells:
            self._cells[key] = Value(F.col(f"`{name}`"), dtype, raw=isinstance(dtype, T.StringType), words=words)
        return self._cells[key]

    def register_function(self, name: str, fn: SlotFunction) -> None:
        """Make ``fn`` (columns to column) callable in slot expressions."""
        self.functions[name] = fn

    def derive(self, entity: str) -> Derivation:
        """The records of one entity over all its blocks."""
        blocks: list[Block] = []
        refused: list[tuple[str, str, str, str]] = []
        dictionary = Dictionary()
        for derivation in self.specs.blocks(entity):
            try:
                blocks.append(_BlockCompiler(derivation, self, dictionary).compile())
            except (SpecError, SourceError) as e:
                if self.strict:
                    raise
                refused.append((entity, derivation.populated_from, "", str(e)))
        if not blocks and not refused:
            raise SpecError(f"no class derivation for {entity!r}; known: {self.specs.entities()}")
        shape = self._shape(entity, [b.record for b in blocks], ())
        tracked = any(b.errors for b in blocks) and not self.strict
        by_table: dict[str, list[Block]] = {}
        for b in blocks:
            by_table.setdefault(b.table, []).append(b)
        codes = dictionary.frame(self.catalog.spark) if dictionary.mappings else None
        staged = {t: self._fan_out(t, bs, shape, tracked, codes) for t, bs in by_table.items()}
        kinds = {t: list(dict.fromkeys((slot, e.message) for b in bs for slot, e in b.errors)) for t, bs in by_table.items()}
        joined = sorted({where for b in blocks for where in b.joined})
        dropped = [self._dropped(entity, *where) for where in joined if not self.strict and not self._unique(*where)]
        return Derivation(entity, self.catalog.spark, staged, shape.dtype(), tracked, refused, kinds if tracked else {}, dropped)

    def _shape(self, cls: str, records: list[Record], above: tuple[str, ...]) -> Shape:
        names: list[str] = list(self.target.classes.get(cls, {}))
        for r in records:
            names.extend(n for n in r.slots if n not in names)
        fields: dict[str, Shape] = {}
        for name in names:
            nodes = [r.slots[name] for r in records if name in r.slots]
            slot = self.target.slot(cls, name)
            nested = [r for n in nodes for r in (n.records if isinstance(n, Items) else (n,)) if isinstance(r, Record)]
            if nested:
                inner = self._shape(nested[0].cls, nested, (*above, cls))
                inner.many = any(isinstance(n, Items) for n in nodes) or bool(slot and slot.multivalued)
                fields[name] = inner
            elif slot is not None and slot.range in self.target.classes and not nodes:
                if slot.range in (*above, cls):
                    continue  # an underived slot that would nest the class in itself
                inner = self._shape(slot.range, [], (*above, cls))
                inner.many = slot.multivalued
                fields[name] = inner
            else:
                types = [n.value.dtype for n in nodes if isinstance(n, Scalar)]
                ranges = [SCALAR_TYPES[n.range] for n in nodes if isinstance(n, Scalar) and n.range in SCALAR_TYPES]
                declared = self.target.scalar_type(slot) if slot else (unify(ranges) if ranges else None)
                fields[name] = Shape(types, declared)
        return Shape(fields=fields)

    def _fan_out(self, table: str, blocks: list[Block], shape: Shape, tracked: bool, codes: DataFrame | None) -> DataFrame:
        base = self._base(table, blocks)
        coded = [c for b in blocks for c in b.coded]
        if coded:
            base = Dictionary.joined(base, codes, coded)
        structs = [self._block_struct(b, shape, tracked) for b in blocks]
        # explode, unlike inline, is part of whole-stage code generation.
        # The array is a projection of its own, where what the blocks have in
        # common (a parsed cell, a mapped code) is computed once per row.
        if len(structs) == 1:
            return base.select(structs[0].alias("__r")).select("__r.*")
        return base.select(F.array(*structs).alias("__all")).select(F.explode("__all").alias("__r")).select("__r.*")

    def _base(self, table: str, blocks: list[Block]) -> DataFrame:
        base = self.catalog[table]
        wanted: dict[tuple[str, str], set[str]] = {}
        for b in blocks:
            for where, columns in b.joined.items():
                wanted.setdefault(where, set()).update(columns)
        for (other, key), columns in sorted(wanted.items()):
            right = self.catalog[other].select(
                F.col(f"`{key}`"),
                *[F.col(f"`{c}`").alias(_joined_name(other, key, c)) for c in sorted(columns)],
            )
            right = right.filter(F.col(f"`{key}`").isNotNull())
            single = right
            if not self._unique(other, key):
                if self.strict:
                    self._require_unique(other, key)
                single = one_row_per_key(right, [key])
            base = lookup_join(base, single, [key])
        return base

    def _unique(self, table: str, key: str) -> bool:
        return key in self.catalog.unique_keys.get(table, ())

    def _dropped(self, entity: str, table: str, key: str) -> DataFrame:
        """How many rows of a join table its key leaves out, as an error; no row if none."""
        counted = self.catalog[table].groupBy(F.col(f"`{key}`").alias("key")).agg((F.count(F.lit(1)) - 1).alias("more"))
        total = counted.filter("key IS NOT NULL").agg(F.sum("more").alias("n")).filter("n > 0")
        return total.select(
            F.lit(entity).alias("entity"), F.lit(table).alias("table"), F.lit(key).alias("slot"), F.lit(DROPPED).alias("message"), "n"
        )

    def _require_unique(self, table: str, key: str) -> None:
        keyed = self.catalog[table].filter(F.col(f"`{key}`").isNotNull())
        sample = duplicate_keys(keyed, [key]).limit(5).collect()
        if sample:
            raise DataError(f"join key {key!r} of {table!r} is not unique: {[r[0] for r in sample]}")

    def _block_struct(self, block: Block, shape: Shape, tracked: bool) -> Column:
        columns = [self._render(block.record.slots.get(n), s).alias(n) for n, s in shape.fields.items()]
        if self.strict and block.errors:
            record = F.struct(*columns)
            failed = _any([e.condition for _, e in block.errors])
            text = F.concat_ws("; ", *[
                F.when(e.condition, F.lit(f"{block.table}.{slot}: {e.message}")) for slot, e in block.errors
            ])
            return F.when(failed, F.raise_error(text).cast(shape.dtype())).otherwise(record)
        if tracked:
            columns.append(_error_array(block).alias(ERRORS))
        return F.struct(*columns)

    def _render(self, node: Node | None, shape: Shape) -> Column:
        dtype = shape.dtype()
        if node is None:
            return F.lit(None).cast(dtype)
        if isinstance(node, Scalar):
            return coerce(node.value.column, node.value.dtype, dtype)
        records = node.records if isinstance(node, Items) else (node,)
        structs = [
            F.struct(*[self._render(r.slots.get(n), s).alias(n) for n, s in shape.fields.items()]) for r in records
        ]
        return F.array(*structs) if shape.many else structs[0]


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def _error_array(block: Block) -> Column:
    """The row's errors, null for a clean row."""
    if not block.errors:
        return F.lit(None).cast(ERROR_TYPE)
    found = [
        F.when(e.condition, F.struct(F.lit(slot).alias("slot"), F.lit(e.message).alias("message")))
        for slot, e in block.errors
    ]
    return F.when(_any([e.condition for _, e in block.errors]), F.array_distinct(F.array_compact(F.array(*found)))).cast(ERROR_TYPE)


@dataclass(frozen=True)
class Derivation:
    """The derived records of an entity and its error channel."""

    entity: str
    spark: object
    staged: Mapping[str, DataFrame]  # table -> records, with an error column when tracked
    dtype: T.StructType
    tracked: bool
    refused: list[tuple[str, str, str, str]]
    kinds: Mapping[str, list[tuple[str, str]]] = field(default_factory=dict)  # per table (slot, message) that can occur
    dropped: list[DataFrame] = field(default_factory=list)  # counts of rows that joins leave out

    def observed(self) -> tuple[Derivation, Callable[[], DataFrame]]:
        """The same derivation, counting its errors in the pass that first reads it whole; and the counts after it."""
        seen: dict[str, Observation] = {}
        staged = dict(self.staged)
        for table, kinds in self.kinds.items():
            if kinds:
                entry = lambda slot, message: F.struct(F.lit(slot).alias("slot"), F.lit(message).alias("message"))
                counts = [F.count_if(F.array_contains(ERRORS, entry(*k))).alias(f"n{i}") for i, k in enumerate(kinds)]
                seen[table] = Observation(f"{self.entity}/{table}")
                staged[table] = staged[table].observe(seen[table], *counts)

        def told() -> DataFrame:
            rows = [
                (self.entity, table, *kind, n)
                for table, o in seen.items()
                for i, kind in enumerate(self.kinds[table])
                if (n := o.get[f"n{i}"])
            ]
            rows += [(*r, None) for r in self.refused]
            return reduce(DataFrame.unionAll, [local_frame(self.spark, rows, ERROR_SUMMARY), *self.dropped])

        return self.reading(staged), told

    def reading(self, staged: Mapping[str, DataFrame]) -> Derivation:
        """The same derivation over stored copies of its staged frames."""
        return replace(self, staged=staged)

    @property
    def fanned(self) -> DataFrame:
        """Records of every table, failed rows and the error column included."""
        frames = list(self.staged.values())
        if not frames:
            return self.spark.createDataFrame([], self.dtype)
        return reduce(DataFrame.unionAll, frames)

    @property
    def records(self) -> DataFrame:
        """Records whose row had no error."""
        if not self.tracked:
            return self.fanned
        return self.fanned.filter(F.col(ERRORS).isNull()).drop(ERRORS)

    @property
    def failed(self) -> DataFrame:
        """Records whose row had an error, with the errors."""
        if not self.tracked:
            return self.fanned.withColumn(ERRORS, F.lit(None).cast(ERROR_TYPE)).filter(F.lit(False))
        return self.fanned.filter(F.col(ERRORS).isNotNull())

    @property
    def nonempty_records(self) -> DataFrame:
        """Records with at least one slot set."""
        return drop_empty(self.records)

    @property
    def errors(self) -> DataFrame:
        """Row errors counted per table and slot, and rows left out by joins; ``n`` is null for a refused block."""
        refused = local_frame(self.spark, [(*r, None) for r in self.refused], ERROR_SUMMARY)
        if not self.tracked:
            return reduce(DataFrame.unionAll, [refused, *self.dropped])
        counted = [
            df.filter(F.col(ERRORS).isNotNull())
            .select(F.explode(ERRORS).alias("e"))
            .groupBy(F.col("e.slot").alias("slot"), F.col("e.message").alias("message"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(self.entity).alias("entity"), F.lit(table).alias("table"), "slot", "message", "n")
            for table, df in self.staged.items()
        ]
        return reduce(DataFrame.unionAll, [*counted, *([refused] if self.refused else []), *self.dropped])

    def require_clean(self) -> None:
        """Raise when any row failed or any block was refused."""
        sample = self.errors.limit(10).collect()
        if sample:
            raise DataError(f"{self.entity}: " + "; ".join(f"{r.table}.{r.slot}: {r.message}" for r in sample))


def drop_empty(df: DataFrame) -> DataFrame:
    """Rows with at least one column that is not null."""
    return df.filter(_any([F.col(f"`{c}`").isNotNull() for c in df.columns]))
