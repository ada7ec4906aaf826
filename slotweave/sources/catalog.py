"""Tables by name, opened on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from slotweave.errors import SourceError
from slotweave.functions.text import class_name_of_file


class Catalog(Mapping[str, DataFrame]):
    """A lazy mapping from table name to DataFrame.

    ``unique_keys`` names columns known to be unique per table (primary keys);
    joins on them need no de-duplication.
    """

    def __init__(
        self,
        spark: SparkSession,
        openers: Mapping[str, Callable[[], DataFrame]],
        unique_keys: Mapping[str, Iterable[str]] | None = None,
    ):
        self.spark = spark
        self._openers = dict(openers)
        self._open: dict[str, DataFrame] = {}
        self.unique_keys = {t: frozenset(ks) for t, ks in (unique_keys or {}).items()}

    @classmethod
    def of(cls, spark: SparkSession, frames: Mapping[str, DataFrame], **kw) -> Catalog:
        return cls(spark, {name: (lambda df=df: df) for name, df in frames.items()}, **kw)

    @classmethod
    def parquet(cls, spark: SparkSession, directory: str, tables: Iterable[str], **kw) -> Catalog:
        """Tables stored as ``<directory>/<table>.parquet``."""
        return cls(
            spark,
            {t: (lambda t=t: spark.read.parquet(f"{directory}/{t}.parquet")) for t in tables},
            **kw,
        )

    @classmethod
    def delimited(cls, spark: SparkSession, paths: Iterable[str], replacements: DataFrame | None = None, **kw) -> Catalog:
        """One all-text table per delimited file, named after the file; one job finds all headers.

        ``replacements`` are made by file name, column and old value (see ``operators.replace``).
        """
        from slotweave.operators.replace import replace_cells, ruled_columns
        from slotweave.sources.delimited import read_table
        from slotweave.sources.files import file_headers, separator_of

        named: dict[str, str] = {}
        for path in paths:
            name = class_name_of_file(path)
            if name in named:
                raise SourceError(f"two files give table {name!r}: {path}")
            named[name] = path
        headers = file_headers(spark, list(named.values()), "first")
        ruled = {} if replacements is None else ruled_columns(replacements)

        def opened(path: str) -> DataFrame:
            df = read_table(spark, path, separator_of(headers.get(path, "")))
            file = path.rsplit("/", 1)[-1]
            return replace_cells(df, replacements, file, ruled[file]) if file in ruled else df

        return cls(spark, {n: (lambda p=p: opened(p)) for n, p in named.items()}, **kw)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            if name not in self._openers:
                raise SourceError(f"no table {name!r}; known: {sorted(self._openers)}")
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __contains__(self, name: object) -> bool:
        return name in self._openers

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def only(self, names: Iterable[str]) -> Catalog:
        """The tables among ``names``; an empty set keeps every table."""
        wanted = set(names)
        kept = {n: o for n, o in self._openers.items() if not wanted or n in wanted}
        return Catalog(self.spark, kept, self.unique_keys)

    def knowing(self, unique_keys: Mapping[str, Iterable[str]]) -> Catalog:
        """The same tables with more unique columns known."""
        keys = {t: self.unique_keys.get(t, frozenset()) | set(unique_keys.get(t, ())) for t in self}
        return Catalog(self.spark, self._openers, keys)

    def extended(self, frames: Mapping[str, DataFrame]) -> Catalog:
        """The same tables plus some given as DataFrames."""
        openers = {**self._openers, **{n: (lambda df=df: df) for n, df in frames.items()}}
        return Catalog(self.spark, openers, self.unique_keys)

    def create_views(self) -> None:
        """Register every table as a temp view."""
        for name in self:
            self[name].createOrReplaceTempView(name)
