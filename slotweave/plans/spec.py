"""Mapping specs: YAML text to dataclasses.

A spec is a list of blocks (or one block as a mapping). Each block holds
``class_derivations`` and, optionally, ``enum_derivations``. Specs are small
configuration text and live on the driver; they end up as Spark columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import SparkSession

from slotweave.errors import SpecError
from slotweave.plans.schema import LOADER


@dataclass(frozen=True)
class UnitConversion:
    source_unit: str
    target_unit: str
    none_if_non_numeric: bool = False


@dataclass(frozen=True)
class SlotDerivation:
    name: str
    populated_from: str | None = None
    expr: str | None = None
    value: Any = None
    has_value: bool = False
    value_mappings: Mapping[str, str] | None = None
    unit_conversion: UnitConversion | None = None
    objects: tuple[ClassDerivation, ...] = ()
    range: str | None = None


@dataclass(frozen=True)
class ClassDerivation:
    name: str
    populated_from: str
    slots: tuple[SlotDerivation, ...]
    joins: Mapping[str, str] = field(default_factory=dict)  # table -> key column


@dataclass(frozen=True)
class EnumDerivation:
    name: str
    sources: Mapping[str, str]  # source value -> target value
    mirror_source: bool = False


@dataclass(frozen=True)
class SpecSet:
    """Everything found in a set of spec files, in file order."""

    classes: tuple[ClassDerivation, ...]
    enums: Mapping[str, EnumDerivation] = field(default_factory=dict)

    def entities(self) -> list[str]:
        """Sorted unique class names."""
        return sorted({c.name for c in self.classes})

    def blocks(self, entity: str) -> list[ClassDerivation]:
        return [c for c in self.classes if c.name == entity]

    def first_block(self, entity: str) -> ClassDerivation:
        """The first block of an entity in file order."""
        found = self.blocks(entity)
        if not found:
            raise SpecError(f"no class derivation for {entity!r}; known: {self.entities()}")
        return found[0]

    def tables(self) -> set[str]:
        """Every table a spec reads, joined ones included."""
        found: set[str] = set()
        for block in self.classes:
            found.add(block.populated_from)
            found.update(block.joins)
        return found


def _named(items: Any, what: str) -> list[tuple[str, dict]]:
    """The dict form, the list form and the ``name:`` form as (name, body) pairs."""
    if not items:
        return []
    if isinstance(items, Mapping):
        return [(str(k), v or {}) for k, v in items.items()]
    pairs: list[tuple[str, dict]] = []
    for item in items:
        if not isinstance(item, Mapping):
            continue
        if "name" in item:
            pairs.append((str(item["name"]), dict(item)))
        else:
            pairs.extend((str(k), v or {}) for k, v in item.items())
    for name, body in pairs:
        if not isinstance(body, Mapping):
            raise SpecError(f"{what} {name!r} must be a mapping")
    return pairs


def _unit_conversion(body: Mapping) -> UnitConversion:
    missing = {"source_unit", "target_unit"} - set(body)
    if missing:
        raise SpecError(f"unit_conversion lacks {sorted(missing)}")
    return UnitConversion(
        str(body["source_unit"]), str(body["target_unit"]), bool(body.get("none_if_non_numeric", False))
    )


def _slot(name: str, body: Mapping, parent_table: str) -> SlotDerivation:
    mappings = body.get("value_mappings")
    conversion = body.get("unit_conversion")
    objects = []
    for item in body.get("object_derivations") or []:
        for cls_name, cls_body in _named(item.get("class_derivations"), "class derivation"):
            objects.append(_class(cls_name, cls_body, parent_table))
    return SlotDerivation(
        name=name,
        populated_from=body.get("populated_from"),
        expr=body.get("expr"),
        value=body.get("value"),
        has_value="value" in body,
        value_mappings=None if mappings is None else {str(k): str(v) for k, v in mappings.items()},
        unit_conversion=None if conversion is None else _unit_conversion(conversion),
        objects=tuple(objects),
        range=body.get("range"),
    )


def _class(name: str, body: Mapping, parent_table: str | None = None) -> ClassDerivation:
    table = body.get("populated_from") or parent_table
    if not table:
        raise SpecError(f"class derivation {name!r} has no populated_from")
    joins = {}
    for other, how in (body.get("joins") or {}).items():
        if not (how or {}).get("join_on"):
            raise SpecError(f"join of {name!r} with {other!r} has no join_on")
        joins[str(other)] = str(how["join_on"])
    slots = tuple(_slot(n, b, str(table)) for n, b in _named(body.get("slot_derivations"), "slot"))
    return ClassDerivation(name, str(table), slots, joins)


def _enum(name: str, body: Mapping) -> EnumDerivation:
    sources: dict[str, str] = {}
    for target, how in (body.get("permissible_value_derivations") or {}).items():
        how = how or {}
        listed = how.get("sources") or [how.get("populated_from", target)]
        sources.update({str(s): str(target) for s in listed})
    return EnumDerivation(name, sources, bool(body.get("mirror_source", False)))


def parse_specs(texts: Iterable[str]) -> SpecSet:
    """Merge spec texts; a text may hold several YAML documents."""
    classes: list[ClassDerivation] = []
    enums: dict[str, EnumDerivation] = {}
    for text in texts:
        for doc in yaml.load_all(text, LOADER):
            for block in doc if isinstance(doc, list) else [doc]:
                if not isinstance(block, Mapping):
                    continue
                classes.extend(_class(n, b) for n, b in _named(block.get("class_derivations"), "class derivation"))
                for n, b in _named(block.get("enum_derivations"), "enum derivation"):
                    enums[n] = _enum(n, b)
    return SpecSet(tuple(classes), enums)


def read_spec_texts(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(path, text) of every ``.yaml``/``.yml`` below ``path``, in path order.

    A missing directory gives an empty list.
    """
    from pyspark.errors import AnalysisException

    try:
        files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{yaml,yml}")
        rows = files.selectExpr("_metadata.file_path AS path", "value").orderBy("path").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    return [(r.path, r.value) for r in rows]


def load_specs(spark: SparkSession, path: str) -> SpecSet:
    """All specs below a directory (or one file), merged in path order."""
    return parse_specs(text for _, text in read_spec_texts(spark, path))


def list_entities(spark: SparkSession, *paths: str) -> list[str]:
    """Sorted unique class names of the specs; a missing path counts as empty."""
    names: set[str] = set()
    for path in paths:
        names.update(load_specs(spark, path).entities())
    return sorted(names)
