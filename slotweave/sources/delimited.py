"""Delimited text tables, read as text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.errors import SourceError
from slotweave.operators import clean
from slotweave.operators.metadata import combine_raw
from slotweave.sources.files import separator_of

# Sheets looked for in a metadata export, in order.
KNOWN_SHEETS = ("right_join_full", "Export_BDCHM_noFHS-noCOPDGene_p")

RECORD = "__record"


def _separators(record: Column, separator: str) -> Column:
    """Separators of a record outside its quoted cells."""
    sep = re.escape(separator)
    bare = F.regexp_replace(record, f'(^|{sep})"(?:[^"]|"")*"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit("")))


def detect_separator(spark: SparkSession, path: str) -> str:
    """Tab or comma, whichever the header line holds more often; tab on a tie."""
    first = spark.read.text(path).head(1)
    return separator_of(first[0].value if first else "")


def read_table(
    spark: SparkSession, path: str, separator: str | None = None, na_tokens: bool = False, breaks: bool = False
) -> DataFrame:
    """A delimited file with a header; every column is text, a blank cell is null.

    ``na_tokens`` also nulls the missing-value words a metadata reader knows. ``breaks``
    allows line breaks inside quoted cells; such a file can't be split among tasks. A row
    with a cell beyond the header's ends the job.
    """
    try:
        separator = separator or detect_separator(spark, path)
        read = spark.read.options(sep=separator, header=True, inferSchema=False, multiLine=breaks, escape='"')
        names = read.csv(path).columns
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, RECORD])
        told = read.options(enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
        df = told.schema(schema).csv(path) if names else read.csv(path)
    except AnalysisException as e:
        raise SourceError(f"cannot read {path}: {e}") from e
    if names:
        # The reader marks rows with fewer or more cells than the header; the former are allowed.
        long = _separators(F.col(RECORD), separator) >= len(names)
        told = F.concat(F.lit(f"{path}: a row has more cells than the header: "), F.coalesce(F.col(f"`{names[0]}`"), F.lit("")))
        df = df.filter(F.when(F.col(RECORD).isNotNull() & long, F.raise_error(told).cast("boolean")).otherwise(True)).drop(RECORD)
    return clean.null_tokens(df) if na_tokens else df


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A metadata table: text columns with the missing-value words nulled; cells may hold line breaks."""
    return read_table(spark, path, na_tokens=True, breaks=True)


def discover(spark: SparkSession, directory: str, files: Sequence[str] = ()) -> list[str]:
    """The table files to read: an explicit list, or every ``.csv``/``.tsv`` below a directory."""
    if files:
        return list(files)
    try:
        listing = spark.read.format("binaryFile").load(
            directory, pathGlobFilter="*.[ct]sv", recursiveFileLookup=True
        )
        return [r.path for r in listing.select("path").orderBy("path").collect()]
    except AnalysisException as e:
        raise SourceError(f"cannot list {directory}: {e}") from e


def pick_sheet(sheets: Sequence[str], known: Sequence[str] = KNOWN_SHEETS) -> str:
    """The first known sheet that is present, else the first sheet."""
    if not sheets:
        raise SourceError("a metadata export holds no sheet")
    return next((k for k in known if k in sheets), sheets[0])


def load_exports(
    exports: Sequence[dict[str, DataFrame]], known: Sequence[str] = KNOWN_SHEETS
) -> DataFrame | None:
    """Metadata exports, each a mapping of sheet name to rows, cleaned and combined."""
    frames = [e[pick_sheet(list(e), known)] for e in exports]
    return combine_raw(frames) if frames else None
