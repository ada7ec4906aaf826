"""The whole run: prepare, infer, validate, derive, write."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotweave.errors import SourceError, SpecError
from slotweave.functions.local import local_frame, side_by_side
from slotweave.operators.profile import InferenceOptions, infer_schema, schema_yaml
from slotweave.operators.validate import VIOLATION_COUNT, gate, verdicts, violation_counts, violations
from slotweave.plans.derive import ERROR_SUMMARY, Mapper
from slotweave.plans.schema import TargetSchema, load_schema
from slotweave.plans.spec import SpecSet, load_specs
from slotweave.sinks.writers import ONE_PASS, write_entity
from slotweave.sources.archive import BEYOND, FILE, archive_catalog, ragged_rows
from slotweave.sources.catalog import Catalog
from slotweave.sources.delimited import discover


RECORDS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class Options:
    formats: Sequence[str] = ("yaml",)
    prefix: str = ""
    postfix: str = ""
    strict: bool = False
    strict_validation: bool = False
    inference: InferenceOptions = InferenceOptions()
    schema_name: str = "SourceSchema"
    layout: str = "markers"  # of archives, see sources.files
    archive_pattern: str = "*.txt.gz"


@dataclass
class Run:
    """What a run left behind."""

    source_schema: TargetSchema
    validated: bool
    violations: DataFrame  # counted per table, slot and rule
    verdicts: DataFrame
    errors: DataFrame  # counted per entity, table and slot
    outputs: dict[str, list[str]] = field(default_factory=dict)


def store_tables(catalog: Catalog, directory: str) -> tuple[Catalog, list[str]]:
    """Every table written once as Parquet and read back; also the tables with rows longer than their header.

    Compressed text is decompressed and split once, by one task per file;
    later scans read columns in parallel and survive a lost executor. A large
    archive is cut into several files. Long rows are counted by the same pass.
    """

    def store(name: str) -> bool:
        table, seen = catalog[name], None
        if BEYOND in table.columns:
            seen = Observation(f"stored {name}")
            table = table.observe(seen, F.count(F.col(BEYOND)).alias("n"))
        cut = table.write.mode("overwrite").option("maxRecordsPerFile", RECORDS_PER_FILE)
        cut.parquet(f"{directory}/{name}.parquet")
        return seen is not None and seen.get["n"] > 0

    names = list(catalog)
    ragged = [n for n, long in zip(names, side_by_side(catalog.spark, store, names)) if long]
    return Catalog.parquet(catalog.spark, directory, names, unique_keys=catalog.unique_keys), ragged


def ragged_errors(catalog: Catalog, names: Sequence[str]) -> list[DataFrame]:
    """Rows longer than their header in the named tables, as an error per file."""
    message = F.concat(F.lit("rows with cells beyond the header in "), F.col("file")).alias("message")
    told = ragged_rows({n: catalog[n] for n in names})
    return [r.select(F.lit("").alias("entity"), "table", F.lit("").alias("slot"), message, "n") for r in told]


def stored(df: DataFrame, path: str, ddl: str) -> DataFrame:
    """A summary written as JSON Lines and read back, so it is computed once."""
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(ddl).json(path)


def validate_tables(catalog: Catalog, schema: TargetSchema, path: str, proved: Mapping[str, Collection[str]] = {}) -> DataFrame:
    """Violations of all tables, counted and stored; columns `proved` to be unique are not counted again."""
    found = reduce(DataFrame.unionAll, [violations(catalog[t], t, schema, proved=proved.get(t, ())) for t in catalog])
    return stored(violation_counts(found), path, VIOLATION_COUNT)


def map_entities(
    mapper: Mapper, directory: str, options: Options, found: Sequence[DataFrame] = ()
) -> tuple[dict[str, list[str]], DataFrame]:
    """Derive and write every entity of the specs; returns outputs and the error summary, with errors found before.

    Entities run side by side. Errors are counted by the pass that writes the records. Where several
    formats, or a format that takes two passes, need records that cost a derivation, these are stored once
    and read from there.
    """
    spark = mapper.catalog.spark

    def write(entity: str) -> tuple[list[str], DataFrame]:
        derivation, errors = mapper.derive(entity).observed()
        if not set(options.formats) <= ONE_PASS or len(options.formats) > 1:
            copies = {}
            for table, staged in derivation.staged.items():
                path = f"{directory}/_staged/{entity}/{table}"
                staged.write.mode("overwrite").parquet(path)
                copies[table] = spark.read.parquet(path)
            derivation = derivation.reading(copies)
        paths = write_entity(derivation.records, directory, entity, options.formats, options.prefix, options.postfix)
        return paths, errors()

    entities = mapper.specs.entities()
    written = side_by_side(spark, write, entities)
    summaries = [local_frame(spark, [], ERROR_SUMMARY), *found, *(errors for _, errors in written)]
    outputs = {entity: paths for entity, (paths, _) in zip(entities, written)}
    return outputs, stored(reduce(DataFrame.unionAll, summaries), f"{directory}/_errors", ERROR_SUMMARY)


def run_pipeline(
    spark: SparkSession,
    spec_dir: str,
    target_schema: str,
    output_dir: str,
    raw_dir: str | None = None,
    tables: Catalog | None = None,
    options: Options = Options(),
    input_dir: str | None = None,
    input_files: Sequence[str] = (),
    replacements: DataFrame | None = None,
) -> Run:
    """Raw archives, delimited files or ready tables, and specs, to written entities.

    Give one of: a directory of archives; a directory (or a list) of delimited files, in which
    ``replacements`` (file name, column, old and new value) are made; a catalogue of tables. Of all
    of these the tables that the specs mention are read.
    """
    given = (raw_dir is not None) + (tables is not None) + (input_dir is not None or bool(input_files))
    if given != 1:
        raise SpecError("give either raw_dir, tables, or input_dir or input_files")
    if replacements is not None and not (input_dir or input_files):
        raise SpecError("replacements are made in delimited files only")
    specs: SpecSet = load_specs(spark, spec_dir)
    ragged: list[str] = []
    if tables is None:
        if raw_dir is not None:
            tables = archive_catalog(spark, raw_dir, spec_dir, options.layout, options.archive_pattern)
        else:
            paths = discover(spark, input_dir or "", input_files)
            tables = Catalog.delimited(spark, paths, replacements=replacements).only(specs.tables())
        tables, ragged = store_tables(tables, f"{output_dir}/prepared")
    else:
        tables = tables.only(specs.tables())
    if not len(tables):
        raise SourceError("no table to read: neither the files nor the catalogue hold one the specs mention")
    # The file a row came from is ours, not the study's.
    study = Catalog.of(spark, {t: tables[t].drop(FILE, BEYOND) for t in tables})
    schema = infer_schema(study, options.inference)
    text = schema_yaml(options.schema_name, schema)
    local_frame(spark, [(text,)], "value string").write.mode("overwrite").text(
        f"{output_dir}/{options.schema_name}.yaml"
    )
    # Columns just counted as unique need no second count, and no de-duplication in joins.
    keys = {t: {s.name for s in schema.classes[t].values() if s.identifier} | set(schema.unique_keys.get(t, ())) for t in study}
    found = validate_tables(study, schema, f"{output_dir}/validation", keys)
    verdict = verdicts(found, list(study))
    validated = gate(verdict, options.strict_validation)
    tables = tables.knowing(keys)
    mapper = Mapper(tables, specs, load_schema(spark, target_schema), options.strict, source=schema)
    outputs, errors = map_entities(mapper, f"{output_dir}/mapped-data", options, ragged_errors(tables, ragged))
    return Run(schema, validated, found, verdict, errors, outputs)
