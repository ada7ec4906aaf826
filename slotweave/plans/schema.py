"""Target schema: classes, slots and enums read from YAML."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

import yaml
from pyspark.sql import types as T

from slotweave.errors import SpecError

# Scalar range name -> Spark type.
SCALAR_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "uri": T.StringType(),
    "uriorcurie": T.StringType(),
    "curie": T.StringType(),
    "measurement": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "decimal": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "time": T.StringType(),
    "boolean": T.BooleanType(),
}


NUMERIC_RANGES = frozenset(r for r, t in SCALAR_TYPES.items() if isinstance(t, T.NumericType))
# The C parser where the library has it: specs with large maps are long.
LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)


@dataclass(frozen=True)
class TargetSlot:
    name: str
    range: str | None = None
    required: bool = False
    identifier: bool = False
    multivalued: bool = False


@dataclass(frozen=True)
class TargetSchema:
    classes: Mapping[str, Mapping[str, TargetSlot]]
    enums: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    unique_keys: Mapping[str, tuple[str | tuple[str, ...], ...]] = field(default_factory=dict)

    def slot(self, cls: str, name: str) -> TargetSlot | None:
        return self.classes.get(cls, {}).get(name)

    def scalar_type(self, slot: TargetSlot | None) -> T.DataType | None:
        """Declared type of a slot; None when nothing is declared."""
        if slot is None:
            return None
        if slot.range is None:
            # Undeclared numbers keep their precision; all other text is a string.
            return T.DoubleType() if slot.name.endswith("_decimal") else T.StringType()
        if slot.range in self.enums:
            return T.StringType()
        if slot.range in SCALAR_TYPES:
            return SCALAR_TYPES[slot.range]
        if slot.range in self.classes:
            return None
        raise SpecError(f"slot {slot.name!r} has unknown range {slot.range!r}")


def _scalar(name: str | None, declared: Mapping) -> str | None:
    """A declared type as the type it is made from; other ranges stay."""
    seen: set = set()
    while name in declared and name not in SCALAR_TYPES and name not in seen:
        seen.add(name)
        name = (declared[name] or {}).get("typeof") or "string"
    return name


def _slots(body: Mapping, shared: Mapping, default: str | None = None) -> dict[str, TargetSlot]:
    merged: dict[str, Mapping] = {name: shared.get(name) or {} for name in body.get("slots") or []}
    merged.update({name: b or {} for name, b in (body.get("attributes") or {}).items()})
    for name, usage in (body.get("slot_usage") or {}).items():
        merged[name] = {**merged.get(name, {}), **(usage or {})}
    return {
        str(name): TargetSlot(
            str(name),
            b.get("range") or (None if str(name).endswith("_decimal") else default),
            bool(b.get("required", False)),
            bool(b.get("identifier", False)),
            bool(b.get("multivalued", False)),
        )
        for name, b in merged.items()
    }


def parse_schema(text: str) -> TargetSchema:
    doc = yaml.load(text, LOADER) or {}
    shared, default = doc.get("slots") or {}, doc.get("default_range")
    classes, keys = {}, {}
    for name, body in (doc.get("classes") or {}).items():
        body = body or {}
        slots: dict[str, TargetSlot] = {}
        parent = body.get("is_a")
        seen = {name}
        while parent and parent not in seen:
            seen.add(parent)
            above = doc["classes"].get(parent) or {}
            for mixin in reversed([above, *[doc["classes"].get(m) or {} for m in above.get("mixins") or []]]):
                slots = {**_slots(mixin, shared, default), **slots}
            parent = above.get("is_a")
        for mixin in body.get("mixins") or []:
            slots = {**slots, **_slots(doc["classes"].get(mixin) or {}, shared, default)}
        classes[str(name)] = {**slots, **_slots(body, shared, default)}
        uniques = [
            found[0] if len(found) == 1 else tuple(found)
            for k in (body.get("unique_keys") or {}).values()
            if (found := [str(c) for c in k.get("unique_key_slots") or []])
        ]
        if uniques:
            keys[str(name)] = tuple(uniques)
    declared = doc.get("types") or {}
    classes = {
        c: {n: replace(slot, range=_scalar(slot.range, declared)) for n, slot in slots.items()} for c, slots in classes.items()
    }
    enums = {
        str(name): tuple(str(v) for v in ((body or {}).get("permissible_values") or {}))
        for name, body in (doc.get("enums") or {}).items()
    }
    return TargetSchema(classes, enums, keys)


def load_schema(spark, path: str) -> TargetSchema:
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise SpecError(f"empty target schema {path}")
    return parse_schema(row.value)
