"""Dated snapshot tables: replacing the days of one run, once or any number of times, gives the same table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saldoflow.operators.audit import PARTITION_COLUMNS

FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro")
COMMITS = ("paths", "catalog")
# Below a table's location; readers of the path pass over names with an underscore.
VERSIONS = "_versions"


def _guarded(df: DataFrame, date_column: str, days: Sequence[dt.date], parts: Sequence[str]) -> DataFrame:
    """The frame, failing on a row that would land in another day than one of ``days``: nobody asked to replace that."""
    day = F.col(date_column)
    outside = F.concat(F.lit("row dated outside the replaced days: "), F.coalesce(day.cast("string"), F.lit("NULL")))
    fits = day.isin(*days)
    if len(parts) == 3:
        for name, part in zip(parts, (F.year(day), F.month(day), F.dayofmonth(day)), strict=True):
            fits = fits & F.col(name).cast("int").eqNullSafe(part)
    checked = F.when(fits, day).otherwise(F.raise_error(outside).cast("date"))
    return df.withColumn(date_column, checked)


def _partition_columns(spark: SparkSession, table: str) -> tuple[str, ...]:
    return tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)


def day_partitions(
    spark: SparkSession, table: str, date_column: str, partition_columns: Sequence[str]
) -> tuple[str, ...] | None:
    """The partition columns of a table, if a partition is exactly one day; None if not.

    Either the date column alone, or year, month and day as ``partition_columns`` names them in that order. In any
    other table an overwrite of partitions would reach days that are not replaced.
    """
    kinds = {c.name: c.dataType for c in spark.catalog.listColumns(table)}
    parts = _partition_columns(spark, table)
    whole_numbers = ("int", "bigint", "smallint", "tinyint")
    if parts == (date_column,) and kinds[date_column] == "date":
        return parts
    if len(parts) == 3 and set(parts) == set(partition_columns) and all(kinds[c] in whole_numbers for c in parts):
        return tuple(partition_columns)
    return None


def _described(spark: SparkSession, table: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == what).take(1)
    return rows[0]["data_type"] if rows else ""


def _provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Provider").lower()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that get rows. ``insertInto`` reads this from the session alone."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, int) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clauses(columns: Sequence[str], partitions: Iterable[tuple], suffix: str = "", between: str = ", ") -> str:
    """``PARTITION (...)`` for each tuple of partition values."""
    named = (", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(columns, p, strict=True)) for p in partitions)
    return between.join(f"PARTITION ({values}){suffix}" for values in named)


def _day_values(days: Iterable[dt.date], columns: Sequence[str]) -> list[tuple]:
    """The partition values of days in a table whose partitions are days."""
    return [(d,) if len(columns) == 1 else (d.year, d.month, d.day) for d in days]


def _path(spark: SparkSession, location: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, location: str) -> None:
    path, files = _path(spark, location)
    files.delete(path, True)


def _catalog_partitions(spark: SparkSession, table: str, spec: dict[str, str] | None = None):
    """The partitions of a table, or that of one spec, as the catalog describes them: a Scala sequence."""
    state, jvm = spark._jsparkSession.sessionState(), spark._jvm
    wanted = jvm.scala.Option.empty() if spec is None else jvm.scala.Option.apply(jvm.PythonUtils.toScalaMap(spec))
    return state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(table), wanted)


def _folders(spark: SparkSession, table: str, columns: Sequence[str], partitions: Iterable[tuple]) -> dict[tuple, str]:
    """Where the files of those partitions lie that the table has."""
    none = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.DEFAULT_PARTITION_NAME()
    folders = {}
    for values in partitions:
        spec = {c: none if v is None else str(v) for c, v in zip(columns, values, strict=True)}
        found = _catalog_partitions(spark, table, spec)
        if found.size():
            folders[values] = found.apply(0).location().toString()
    return folders


def _add_at(spark: SparkSession, table: str, columns: Sequence[str], partitions: Sequence[tuple], folder: str) -> None:
    """Add partitions that the table does not have; some catalogs move existing ones even with IF NOT EXISTS."""
    if partitions:
        clauses = _clauses(columns, partitions, f" LOCATION {_literal(folder)}", " ")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")


def _drop_partitions(spark: SparkSession, table: str, columns: Sequence[str], partitions: Sequence[tuple]) -> None:
    """Drop partitions that got no rows, in one statement, and then their files.

    Tables with a location of their own keep the files of a dropped partition, where readers of the path would find them.
    """
    if not partitions:
        return
    folders = _folders(spark, table, columns, partitions)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_clauses(columns, partitions)}")
    for folder in folders.values():
        _delete(spark, folder)
    spark.catalog.refreshTable(table)


def _set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    """Records properties of a file table in the catalog; the writer itself only takes them as options of its format."""
    if properties:
        quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        listed = ", ".join(f"{quoted(name)} = {quoted(value)}" for name, value in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def create_snapshot_table(
    df: DataFrame,
    table: str,
    location: str | None,
    partition_columns: Sequence[str] = PARTITION_COLUMNS,
    table_format: str = "parquet",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Create a partitioned table at ``location`` from ``df``; fails if the table exists."""
    if location is None:
        raise ValueError(f"a location is needed to create {table}")
    if table_format in FILE_FORMATS:
        writer = df.write.format(table_format).partitionBy(*partition_columns).option("path", location)
        for name, value in (properties or {}).items():
            writer = writer.option(name, value)
        writer.saveAsTable(table, mode="errorifexists")
        _set_properties(df.sparkSession, table, properties or {})
        return
    creator = df.writeTo(table).using(table_format).tableProperty("location", location)
    for name, value in (properties or {}).items():
        creator = creator.tableProperty(name, value)
    creator.partitionedBy(*[F.col(c) for c in partition_columns]).create()


def _kept(spark: SparkSession, table: str, date_column: str, days: Sequence[dt.date]) -> DataFrame:
    """The rows of a table that are not of the days; rows without a date stay."""
    of_days = F.col(date_column).cast("date").isin(*days)
    return spark.table(table).filter(~F.coalesce(of_days, F.lit(False)))


def _within(table_rows: DataFrame, columns: Sequence[str], partitions: Sequence[tuple]) -> DataFrame:
    """Only some partitions; the values are literals, so the scan lists no other folder."""
    kinds = {c: table_rows.schema[c].dataType for c in columns}
    # fields that are both null are equal inside a struct
    listed = [F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(columns, p, strict=True)]) for p in partitions]
    return table_rows.filter(F.struct(*columns).isin(*listed)) if listed else table_rows.limit(0)


def _distinct_partitions(rows: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """Partition values, of which the catalog holds a list as well."""
    return [tuple(row) for row in rows.select(*columns).distinct().collect()]


def _root(location: str) -> str:
    return location.split(f"/{VERSIONS}/")[0].rstrip("/")


@contextmanager
def _version_of(spark: SparkSession, table: str) -> Iterator[tuple[str, str]]:
    """An empty table like ``table`` at a new folder below its location, as (name, folder)."""
    run = uuid.uuid4().hex[:12]
    name = f"{table[:-1]}__{run}`" if table.endswith("`") else f"{table}__{run}"
    folder = f"{_root(_described(spark, table, 'Location'))}/{VERSIONS}/{run}"
    spark.sql(f"CREATE TABLE {name} LIKE {table} LOCATION {_literal(folder)}")
    try:
        yield name, folder
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # a table with a location leaves its files


def _replace_whole(spark: SparkSession, rows: DataFrame, table: str, days: Sequence[dt.date], date_column: str) -> int:
    """An unpartitioned table: all other rows and the new ones in a new folder, to which one statement moves the table."""
    seen, old = Observation(), _described(spark, table, "Location")
    with _version_of(spark, table) as (version, folder):
        content = _kept(spark, table, date_column, days).unionByName(rows)
        counted = content.observe(seen, F.count_if(F.col(date_column).cast("date").isin(*days)).alias("filas"))
        counted.write.insertInto(version)
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(folder)}")
    spark.catalog.refreshTable(table)
    path, files = _path(spark, old)
    if old.rstrip("/") == _root(old):
        for status in files.listStatus(path):  # the folder of versions lies in here
            if status.isFile() and status.getPath().getName()[0] not in "_.":
                files.delete(status.getPath(), False)
    else:
        files.delete(path, True)
    return seen.get["filas"]


def _replace_partitions(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    days: Sequence[dt.date],
    date_column: str,
    parts: Sequence[str],
    touched: Sequence[tuple],
    daily: bool,
    commit: str,
) -> int:
    """Write the touched partitions anew: their rows of other days and the new rows."""
    seen = Observation()
    content = rows if daily else _within(_kept(spark, table, date_column, days), parts, touched).unionByName(rows)
    counted = content.hint("rebalance", *parts).observe(
        seen,
        F.count_if(F.col(date_column).cast("date").isin(*days)).alias("filas"),
        F.collect_set(F.struct(*parts)).alias("particiones"),
    )
    if commit == "paths":
        with _dynamic_overwrite(spark):
            counted.write.insertInto(table, overwrite=True)
        _drop_partitions(spark, table, parts, sorted(set(touched) - set(map(tuple, seen.get["particiones"])), key=str))
        return seen.get["filas"]

    with _version_of(spark, table) as (version, folder):
        counted.write.insertInto(version)
        written = set(map(tuple, seen.get["particiones"]))
        reached = sorted(written | set(touched), key=str)
        emptied = [p for p in reached if p not in written]
        before = _folders(spark, table, parts, reached)
        if reached:
            nothing = f"{folder}/_nothing"
            path, files = _path(spark, nothing)
            files.mkdirs(path)
            # partitions without files: new ones to be moved, and those that the emptied ones move to
            _add_at(spark, table, parts, [p for p in reached if p not in before], nothing)
            _add_at(spark, version, parts, emptied, nothing)
            _move(spark, table, _catalog_partitions(spark, version))
        if emptied:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_clauses(parts, emptied)}")
        for old in before.values():
            _delete(spark, old)
    spark.catalog.refreshTable(table)
    return seen.get["filas"]


def _move(spark: SparkSession, table: str, moved) -> None:
    """Point partitions of a table to other folders by one call to the catalog."""
    state = spark._jsparkSession.sessionState()
    state.catalog().alterPartitions(state.sqlParser().parseTableIdentifier(table), moved)


def replace_snapshots(
    df: DataFrame,
    table: str,
    days: Sequence[dt.date],
    date_column: str = "fecha_corte",
    location: str | None = None,
    partition_columns: Sequence[str] = PARTITION_COLUMNS,
    table_format: str = "parquet",
    properties: Mapping[str, str] | None = None,
    commit: str = "paths",
) -> int:
    """Make ``df`` the content of ``days`` in ``table`` and return its row count.

    A missing table is created. Otherwise a table format with row-level commits gets one conditional overwrite.
    A file table of any layout keeps all other days:

    - partitions that are single days are written anew;
    - of other partitions, those that hold a row of the days or get one are written anew with their rows of other
      days. The new rows are staged first, so that ``df`` is evaluated once and tells which partitions it reaches;
    - a table without partitions is written anew as a whole, which reads all of it.

    ``commit`` says how partitions change. ``"paths"`` keeps their folders at the table's location, for readers of the
    path: a dynamic partition overwrite stages its files and swaps folders when the job commits, so a run that fails
    before that leaves every old day readable. It does not touch partitions that end up without rows; those are dropped in
    a second step: a run that dies between the steps has the new days in place and the rows of emptied days still
    there, until it is run again. ``"catalog"`` writes to a new folder below ``_versions`` and moves all partitions,
    emptied ones too, by one call to the catalog: a run that dies before it leaves all old days, after it all new ones, at
    worst with files that no partition names. Readers of the path do not see that. A table without partitions is
    always moved by one statement. Replaced files are deleted after the commit in every case.

    The overwrite mode is a setting of the session while the write runs; give jobs that write at the same time
    sessions of their own. Two runs that replace days of the same partitions must not overlap.

    The rebalance hint gathers a partition's rows into few files and splits one too large for one task. Rows are
    counted in the writing stage, whose tasks count once each even when earlier stages are run again.
    """
    if commit not in COMMITS:
        raise ValueError(f"commit must be one of {COMMITS}, not {commit!r}")
    spark = df.sparkSession
    seen = Observation()
    exists = spark.catalog.tableExists(table)
    if not exists or _provider(spark, table) not in FILE_FORMATS:
        rows = _guarded(df, date_column, days, partition_columns).hint("rebalance", *partition_columns)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("filas"))
        if exists:
            condition: Column = F.col(date_column).isin(*days)
            rows.writeTo(table).overwrite(condition)
        else:
            create_snapshot_table(rows, table, location, partition_columns, table_format, properties)
        return seen.get["filas"]

    layout = _partition_columns(spark, table)
    daily = day_partitions(spark, table, date_column, partition_columns)
    rows = _guarded(df, date_column, days, daily or ()).select(*spark.table(table).columns)
    if not layout:
        return _replace_whole(spark, rows, table, days, date_column)
    if daily:
        touched = _day_values(sorted(set(days)), daily)
        return _replace_partitions(spark, rows, table, days, date_column, daily, touched, True, commit)

    with _version_of(spark, table) as (staged, folder):
        rows.hint("rebalance", *layout).write.insertInto(staged)
        new = spark.table(staged)
        old = spark.table(table).filter(F.col(date_column).cast("date").isin(*days))
        touched = sorted({*_distinct_partitions(new, layout), *_distinct_partitions(old, layout)}, key=str)
        written = _replace_partitions(spark, new, table, days, date_column, layout, touched, False, commit)
        _delete(spark, folder)
    return written
