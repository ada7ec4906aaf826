"""Raw study archives: compressed text tables with comment lines.

A table's lines are comments (``#``), one header line of accessions (``##``),
one repeated line of column names, data rows, blank lines, and rows marked
``Intentionally Blank``. Compressed files are not splittable, so a file is one
task; all filters run on the line before it is split.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.errors import SourceError
from slotweave.functions.local import local_frame
from slotweave.functions.text import table_id
from slotweave.sources.files import SUBJECT, file_headers, headed_text

# Marks of the format.
PLACEHOLDER = "Intentionally Blank"
ACCESSION = r"(phv\d{8})\..*"

FILE = "_source_file"
BEYOND = "_beyond_header"


def header_columns(line: str) -> list[str]:
    """Column names of an accession line: the subject id, then version-free accessions."""
    cells = line.lstrip("#").split("\t")
    names = [SUBJECT, *[re.sub(ACCESSION, r"\1", c).strip() for c in cells[1:] if c]]
    return names


def blank_header_columns(line: str) -> list[str]:
    """Column names of a header that follows a blank line."""
    return [re.sub(r"(phv[0-9]{8})\.\S*", r"\1", c) for c in re.sub("^##", SUBJECT, line).split("\t")]


NAMES = {"markers": header_columns, "blank": blank_header_columns}
NO_HEADER = {"markers": "no accession header in", "blank": "no header after a blank line in"}


def is_data_line(line: Column) -> Column:
    """Not a comment, not blank, not the repeated names line, not a placeholder row."""
    return (
        ~line.startswith("#")
        & (F.trim(F.regexp_replace(line, r"\s", " ")) != "")
        & ~F.ltrim(line).startswith(SUBJECT)
        & ~line.contains(PLACEHOLDER)
    )


def split_lines(lines: DataFrame, column: str, names: list[str], beyond: str | None = None) -> DataFrame:
    """The cells of a line by position; a missing or empty cell is null.

    ``beyond`` names a column for the cells after the last name, joined by tabs; it is
    null where these are missing or blank. Other columns are kept behind the cells. The line
    is split in a step of its own, so it is split once however many columns there are.
    """
    others = [F.col(f"`{c}`") for c in lines.columns if c != column]
    cells = lines.select(F.split(F.col(f"`{column}`"), "\t", -1).alias("__cells"), *others)
    picked = [F.nullif(F.get("__cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    if beyond:
        more = F.array_join(F.slice("__cells", len(names) + 1, F.greatest(F.size("__cells") - len(names), F.lit(0))), "\t")
        picked.append(F.when(more.rlike(r"\S"), more).alias(beyond))
    return cells.select(*picked, *others)


def read_archive(
    spark: SparkSession, paths: list[str], layout: str = "markers", headers: Mapping[str, str] | None = None
) -> DataFrame:
    """The data rows of archives of one table, by either layout of their header (see ``files.headed``).

    Files with one header share a scan; files with different headers are
    united by column name. ``_source_file`` tells the files apart; ``_beyond_header`` holds
    what a row has beyond its header. ``headers`` spares the job that finds them.
    """
    if headers is None:
        headers = file_headers(spark, paths, layout)
    missing = sorted(set(paths) - set(headers))
    if missing:
        raise SourceError(f"{NO_HEADER[layout]} {missing}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(paths):
        by_header.setdefault(tuple(NAMES[layout](headers[path])), []).append(path)
    frames = []
    for names, files in by_header.items():
        if layout == "markers":  # rows are told by themselves
            lines = spark.read.text(files).filter(is_data_line(F.col("value")))
            lines = lines.select("value", _file_name(F.col("_metadata.file_path")))
        else:  # rows are told by their place
            lines = headed_text(spark, files, layout, rows=True).select(F.col("line").alias("value"), _file_name(F.col("path")))
        frames.append(split_lines(lines, "value", list(names), BEYOND))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1).alias(FILE)


def read_after_blank_line(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Archives without markers: the header is the line after the first blank line.

    Lines up to the blank one are dropped, and so is a repeated names line
    right after the header.
    """
    return read_archive(spark, paths, "blank")


def ragged_rows(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Per table that tells: (table, file, n), how many rows of each file hold cells beyond its header."""
    return [
        df.filter(F.col(BEYOND).isNotNull())
        .groupBy(F.lit(name).alias("table"), F.col(FILE).alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
        for name, df in tables.items()
        if BEYOND in df.columns
    ]


def referenced_tables(texts: DataFrame, column: str = "value") -> DataFrame:
    """Distinct ``pht`` accessions mentioned in a text column."""
    found = F.regexp_extract_all(F.col(f"`{column}`"), F.lit(r"(pht[0-9]+)"), 1)
    return texts.select(F.explode(found).alias("table_id")).distinct()


def prune_files(files: DataFrame, references: DataFrame, path: str = "path") -> DataFrame:
    """The files whose table is referenced; all named files when nothing is."""
    named = files.withColumn("table_id", table_id(path)).filter(F.col("table_id") != "")
    if references.isEmpty():
        return named
    return named.join(references, "table_id", "left_semi")


def archive_tables(
    spark: SparkSession, directory: str, spec_dir: str | None = None, pattern: str = "*.txt.gz"
) -> dict[str, list[str]]:
    """Archive files per table id, limited to the tables the specs mention."""
    from pyspark.errors import AnalysisException

    files = spark.read.format("binaryFile").load(directory, pathGlobFilter=pattern).select("path")
    references = local_frame(spark, [], "table_id string")
    if spec_dir is not None:
        try:
            texts = spark.read.text(spec_dir, recursiveFileLookup=True, pathGlobFilter="*.{yaml,yml}")
            references = referenced_tables(texts)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    tables: dict[str, list[str]] = {}
    for r in prune_files(files, references).orderBy("path").collect():
        tables.setdefault(r.table_id, []).append(r.path)
    return tables


def archive_catalog(
    spark: SparkSession, directory: str, spec_dir: str | None = None, layout: str = "markers", pattern: str = "*.txt.gz"
):
    """A catalogue of the archives of a directory, one table per accession; one job finds all headers."""
    from slotweave.sources.catalog import Catalog

    tables = archive_tables(spark, directory, spec_dir, pattern)
    headers = file_headers(spark, [p for paths in tables.values() for p in paths], layout)
    return Catalog(spark, {t: (lambda ps=ps: read_archive(spark, ps, layout, headers)) for t, ps in tables.items()})


def archive_columns(spark: SparkSession, files: Mapping[str, list[str]], layout: str = "markers") -> DataFrame:
    """(table, column) of the tables' files, read from their headers alone and named on the executors."""
    placed = local_frame(spark, [(t, p) for t, ps in files.items() for p in ps], "`table` string, path string")
    found = headed_text(spark, [p for ps in files.values() for p in ps], layout).join(placed, "path")
    cut = r"(phv\d{8})\..*" if layout == "markers" else r"(phv[0-9]{8})\.\S*"
    cells = F.split(F.regexp_replace("line", "^#+", "" if layout == "markers" else SUBJECT), "\t", -1)
    named = F.transform(cells, lambda c: F.trim(F.regexp_replace(c, cut, "$1")))
    if layout == "markers":
        named = F.concat(F.array(F.lit(SUBJECT)), F.filter(F.slice(named, 2, F.greatest(F.size(named) - 1, F.lit(0))), lambda c: c != ""))
    return found.select("table", F.explode(named).alias("column")).distinct()
