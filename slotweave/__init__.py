"""Tabular harmonization on Spark."""

from slotweave.errors import DataError, SlotweaveError, SourceError, SpecError
from slotweave.plans.authoring import apply_override_files, generate_spec_files, prepare_metadata_files
from slotweave.plans.derive import Derivation, Mapper
from slotweave.plans.pipeline import Options, Run, run_pipeline
from slotweave.plans.schema import TargetSchema, load_schema, parse_schema
from slotweave.plans.spec import SpecSet, list_entities, load_specs, parse_specs
from slotweave.sources.catalog import Catalog

__all__ = [
    "Catalog",
    "DataError",
    "Derivation",
    "Mapper",
    "Options",
    "Run",
    "SlotweaveError",
    "SourceError",
    "SpecError",
    "SpecSet",
    "TargetSchema",
    "apply_override_files",
    "generate_spec_files",
    "list_entities",
    "load_schema",
    "load_specs",
    "parse_schema",
    "parse_specs",
    "prepare_metadata_files",
    "run_pipeline",
]
