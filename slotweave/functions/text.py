"""Column helpers for text cells.

Blank and null are the same thing in metadata tables, so every presence test
goes through :func:`nonblank`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that a metadata reader treats as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CURIE_PATTERN = r"\b([A-Z][A-Za-z0-9]*:[A-Za-z0-9]+)\b"


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    """The text, with null read as the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def nonblank(c: Column | str) -> Column:
    """True when the cell holds something; never null."""
    return text_or_empty(c) != F.lit("")


def nonblank_trimmed(c: Column | str) -> Column:
    """True when the cell holds something besides white space; never null."""
    return F.trim(text_or_empty(c)) != F.lit("")


def clean_whitespace(c: Column | str) -> Column:
    """Newlines to spaces, runs of white space to one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def na_to_null(c: Column | str) -> Column:
    """Null out the tokens a metadata reader takes for missing."""
    c = _col(c)
    return F.when(~c.isin(*NA_TOKENS), c)


def accession(c: Column | str) -> Column:
    """``phv00098579.v1.p1`` -> ``phv00098579``."""
    return F.substring_index(_col(c), ".", 1)


def squeeze(c: Column | str) -> Column:
    """Drop every space: the form label join keys take."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def label_key(c: Column | str) -> Column:
    """Lower-cased, space-free join key of a label."""
    return squeeze(F.lower(_col(c)))


def preferred(*candidates: Column | str) -> Column:
    """First candidate that is not blank, else the empty string."""
    return F.coalesce(*[F.when(nonblank(c), _col(c)) for c in candidates], F.lit(""))


def backfill(target: Column | str, source: Column | str) -> Column:
    """The target, or the source where the target is null."""
    return F.coalesce(_col(target), _col(source))


def corrected(value: Column | str, correction: Column | str) -> Column:
    """The correction wherever it is not blank."""
    return F.when(nonblank(correction), _col(correction)).otherwise(_col(value))


def exam_mention(c: Column | str) -> Column:
    """First ``exam <number>`` in the text, null when there is none."""
    found = F.regexp_extract(_col(c), r"(?i)(exam\s+\d+)", 1)
    return F.nullif(found, F.lit(""))


def source_text(c: Column | str, suffix: str = " - Yes") -> Column:
    """Text before the first parenthesis, trimmed, with a fixed suffix."""
    return F.concat(F.trim(F.substring_index(_col(c), "(", 1)), F.lit(suffix))


def curies(c: Column | str) -> Column:
    """All CURIEs of a text, as an array."""
    return F.regexp_extract_all(_col(c), F.lit(CURIE_PATTERN), 1)


def table_id(path: Column | str) -> Column:
    """First ``pht`` accession of a path's last part; empty when there is none."""
    name = F.substring_index(_col(path), "/", -1)
    return F.regexp_extract(name, r"(pht[0-9]+)", 1)


def class_name_of_file(path: str) -> str:
    """File stem, ``-`` to ``_``, lower case."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    stem = re.sub(r"\.(csv|tsv|txt|parquet|json)(\.gz)?$", "", name, flags=re.IGNORECASE)
    return stem.replace("-", "_").lower()
