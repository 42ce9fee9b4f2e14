"""Source tables named in a job parameter, and rows and views made from literals and SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceTable:
    """A table of a database, known to queries by its alias (the table name)."""

    database: str
    table: str

    @property
    def alias(self) -> str:
        return self.table

    @property
    def short_name(self) -> str:
        return f"{self.database}.{self.table}"

    def full_name(self, catalog: str | None = None) -> str:
        return self.short_name if catalog is None else f"{catalog}.{self.short_name}"


def parse_source_list(text: str | None, strict: bool = True) -> list[SourceTable]:
    """``"db1.t1, db2.t2"`` as source tables, split on the first dot of each item.

    Blank text is an empty list. An item without a dot raises, or is dropped when ``strict`` is off.
    """
    items = [item.strip() for item in (text or "").split(",")]
    tables = []
    for item in filter(None, items):
        database, dot, table = item.partition(".")
        if dot and database.strip() and table.strip():
            tables.append(SourceTable(database.strip(), table.strip()))
        elif strict:
            raise ValueError(f"source {item!r} is not of the form database.table")
    return tables


class SourceBinding:
    """Aliases of a job's source tables."""

    def __init__(self, tables: Iterable[SourceTable], catalog: str | None = None):
        self.catalog = catalog
        self._by_alias: dict[str, SourceTable] = {}
        for table in tables:
            self._by_alias.setdefault(table.alias, table)

    def name(self, alias: str) -> str:
        """Full table name behind an alias."""
        if alias not in self._by_alias:
            raise ValueError(f"no source table {alias!r}; available: {list(self._by_alias)}")
        return self._by_alias[alias].full_name(self.catalog)

    def read(self, spark: SparkSession, alias: str) -> DataFrame:
        return spark.table(self.name(alias))


def literal_row(spark: SparkSession, **values) -> DataFrame:
    """One row of literals."""
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])


def run_views(
    spark: SparkSession,
    views: Iterable[tuple[str, str]],
    final: str,
    args: Mapping[str, object] | None = None,
    keep: bool = True,
) -> DataFrame:
    """Register SQL texts as temporary views in order and return the final query.

    ``args`` binds named parameters (``:fecha_corte``, ``IDENTIFIER(:tabla)``) in every text, so dates and table
    names are never pasted into SQL. Nothing runs here. With ``keep=False`` the views are dropped again once the
    final query has been resolved.
    """
    args = dict(args or {})
    names = []
    for name, text in views:
        spark.sql(text, args).createOrReplaceTempView(name)
        names.append(name)
    result = spark.sql(final, args)
    if not keep:
        for name in names:
            spark.catalog.dropTempView(name)
    return result


def read_query_texts(spark: SparkSession, folder: str, pattern: str = "*.sql") -> DataFrame:
    """A corpus from files: one row per file, ``query_id`` its path and ``sql_text`` its whole content."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("query_id"), F.col("value").alias("sql_text"))
