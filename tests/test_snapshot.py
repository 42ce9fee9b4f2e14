import datetime as dt
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldoflow.operators.audit import PARTITION_COLUMNS, add_audit_columns
from saldoflow.sinks import snapshot
from saldoflow.sinks.snapshot import create_snapshot_table, replace_snapshots

D = dt.date
DAYS = [D(2025, 11, d) for d in (5, 6, 7)]


def stamped(spark, rows):
    df = spark.createDataFrame(rows, "fecha_corte date, valor int")
    return add_audit_columns(df, F.expr("TIMESTAMP '2025-11-08 03:00:00 UTC'"))


@pytest.fixture
def target(spark, tmp_path):
    name = f"snap_{uuid.uuid4().hex[:8]}"
    rows = replace_snapshots(stamped(spark, [(d, 1) for d in DAYS for _ in range(2)]), name, DAYS, location=str(tmp_path / name))
    assert rows == 6
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(spark, table):
    rows = spark.table(table).groupBy("fecha_corte", "valor").count().collect()
    return {(r["fecha_corte"].day, r["valor"]): r["count"] for r in rows}


def test_table_is_partitioned_by_day_at_the_location(spark, target):
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
    assert "anio_particion=2025/mes_particion=11/dia_particion=7" in parts and len(parts) == 3


def test_one_day_is_replaced_and_others_stay(spark, target):
    assert replace_snapshots(stamped(spark, [(DAYS[1], 9)]), target, [DAYS[1]]) == 1
    assert content(spark, target) == {(5, 1): 2, (6, 9): 1, (7, 1): 2}


def test_running_twice_changes_nothing(spark, target):
    for _ in range(2):
        replace_snapshots(stamped(spark, [(DAYS[1], 9), (DAYS[2], 8)]), target, DAYS[1:])
    assert content(spark, target) == {(5, 1): 2, (6, 9): 1, (7, 8): 1}


def test_empty_input_clears_only_its_day(spark, target):
    assert replace_snapshots(stamped(spark, []), target, [DAYS[0], D(2030, 1, 1)]) == 0
    assert content(spark, target) == {(6, 1): 2, (7, 1): 2}


def test_a_new_day_is_added(spark, target):
    replace_snapshots(stamped(spark, [(D(2025, 11, 10), 4)]), target, [D(2025, 11, 10)])
    assert content(spark, target)[(10, 4)] == 1


def test_rows_of_other_days_fail_and_leave_the_table_alone(spark, target):
    with pytest.raises(PySparkException, match="outside the replaced days"):
        replace_snapshots(stamped(spark, [(DAYS[0], 5), (DAYS[1], 5)]), target, [DAYS[0]])
    assert content(spark, target) == {(5, 1): 2, (6, 1): 2, (7, 1): 2}


def test_a_failing_run_leaves_the_old_day(spark, target):
    broken = stamped(spark, [(DAYS[0], 5)]).withColumn("valor", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(PySparkException, match="boom"):
        replace_snapshots(broken, target, [DAYS[0]])
    assert content(spark, target)[(5, 1)] == 2


def test_a_day_can_be_rebuilt_from_the_table_itself(spark, target):
    doubled = spark.table(target).filter(F.col("fecha_corte") == DAYS[0]).withColumn("valor", F.col("valor") * 2)
    replace_snapshots(doubled, target, [DAYS[0]])
    assert content(spark, target)[(5, 2)] == 2


def test_the_session_setting_is_put_back(spark, target):
    replace_snapshots(stamped(spark, [(DAYS[0], 5)]), target, [DAYS[0]])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_missing_table_needs_a_location(spark):
    with pytest.raises(ValueError, match="location"):
        replace_snapshots(stamped(spark, [(DAYS[0], 1)]), "no_such_table", [DAYS[0]])


def test_an_existing_table_is_not_created_again(spark, target, tmp_path):
    with pytest.raises(PySparkException):
        create_snapshot_table(stamped(spark, [(DAYS[0], 1)]), target, str(tmp_path / "other"))


def plain_table(spark, tmp_path, *parts):
    name = f"snap_{uuid.uuid4().hex[:8]}"
    rows = stamped(spark, [(d, 1) for d in DAYS])
    writer = rows.write.format("parquet").option("path", str(tmp_path / name))
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
    return name


LAYOUTS = [(), ("anio_particion", "mes_particion"), ("valor",), ("fecha_corte", "valor"), ("fecha_corte",), PARTITION_COLUMNS]
MONTHS = [D(2025, 10, 30), D(2025, 11, 5), D(2025, 11, 6), D(2025, 12, 1)]


def stored_files(spark, name, where="true"):
    """Name, size and time of every file that the table reads for some rows."""
    shown = "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    return {tuple(r) for r in spark.table(name).filter(where).select(*shown).distinct().collect()}


@pytest.mark.parametrize("commit", ["paths", "catalog"])
@pytest.mark.parametrize("parts", LAYOUTS)
def test_any_layout_keeps_all_other_days(spark, tmp_path, parts, commit):
    name = f"snap_{uuid.uuid4().hex[:8]}"
    rows = stamped(spark, [(d, v) for d in MONTHS for v in (1, 2)] + [(None, 3)])
    writer = rows.write.format("parquet").option("path", str(tmp_path / name))
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)

    def by_date():
        found = spark.table(name).groupBy("fecha_corte", "valor").count().collect()
        return {(r["fecha_corte"], r["valor"]): r["count"] for r in found}

    others = {(MONTHS[0], 1): 1, (MONTHS[0], 2): 1, (MONTHS[3], 1): 1, (MONTHS[3], 2): 1, (None, 3): 1}
    new = stamped(spark, [(MONTHS[1], 9), (MONTHS[1], 1), (MONTHS[1], 1)])
    far = "month(fecha_corte) <> 11"
    before = stored_files(spark, name, far)
    for _ in range(2):  # a second run changes nothing
        assert replace_snapshots(new, name, MONTHS[1:3], commit=commit) == 3
        assert by_date() == {**others, (MONTHS[1], 9): 1, (MONTHS[1], 1): 2}
        if parts and parts != ("valor",):
            assert stored_files(spark, name, far) == before
    assert replace_snapshots(stamped(spark, []), name, [MONTHS[1], D(2030, 1, 1)], commit=commit) == 0
    assert by_date() == others
    # what is left on disk is what the table reads
    spark.catalog.refreshTable(name)
    on_disk = {f.name: pq.read_metadata(f).num_rows for f in (tmp_path / name).rglob("part-*.parquet")}
    assert {r[0].rsplit("/", 1)[1] for r in stored_files(spark, name)} == {f for f, count in on_disk.items() if count}
    if commit == "paths" and parts:
        assert spark.read.parquet(str(tmp_path / name)).count() == len(others)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")] == []
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("parts", LAYOUTS)
def test_rows_of_other_days_fail_in_any_layout(spark, tmp_path, parts):
    name = plain_table(spark, tmp_path, *parts)
    for commit in ("paths", "catalog"):
        with pytest.raises(PySparkException, match="outside the replaced days"):
            replace_snapshots(stamped(spark, [(DAYS[0], 5), (DAYS[1], 5)]), name, [DAYS[0]], commit=commit)
        assert content(spark, name) == {(5, 1): 1, (6, 1): 1, (7, 1): 1}


@pytest.mark.parametrize("parts", [(), ("anio_particion", "mes_particion"), PARTITION_COLUMNS])
def test_a_run_killed_before_the_commit_leaves_all_old_days_and_after_it_all_new_ones(spark, tmp_path, parts, monkeypatch):
    name = plain_table(spark, tmp_path, *parts)
    old, new = {(5, 1): 1, (6, 1): 1, (7, 1): 1}, {(5, 8): 1, (7, 1): 1}

    class Killed(Exception):
        pass

    def replace():
        replace_snapshots(stamped(spark, [(DAYS[0], 8)]), name, DAYS[:2], commit="catalog")

    real_sql, real_move = type(spark).sql, snapshot._move

    def killed(*args, **kwargs):
        raise Killed

    def dies_at_the_move(self, text, *args, **kwargs):
        return killed() if "SET LOCATION" in text else real_sql(self, text, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(snapshot, "_move", killed)
        m.setattr(type(spark), "sql", dies_at_the_move)
        with pytest.raises(Killed):
            replace()
    assert content(spark, name) == old

    with monkeypatch.context() as m:
        m.setattr(snapshot, "_delete", killed)
        if parts:

            def dies_after_the_move(*args):
                real_move(*args)
                raise Killed

            m.setattr(snapshot, "_move", dies_after_the_move)
        else:
            m.setattr(snapshot, "_path", killed)
        with pytest.raises(Killed):
            replace()
    spark.catalog.refreshTable(name)
    assert content(spark, name) == new
    replace()
    assert content(spark, name) == new


def test_only_touched_partitions_are_read(spark, tmp_path):
    name = f"snap_{uuid.uuid4().hex[:8]}"
    rows = stamped(spark, [(d, 1) for d in MONTHS])
    rows.write.partitionBy("anio_particion", "mes_particion").option("path", str(tmp_path / name)).saveAsTable(name)
    kept = snapshot._within(snapshot._kept(spark, name, "fecha_corte", MONTHS[1:2]), ("anio_particion", "mes_particion"), [(2025, 11)])
    assert [r["fecha_corte"] for r in kept.collect()] == [MONTHS[2]]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(kept.inputFiles()) >= 1


def test_an_unknown_commit_is_refused(spark, target):
    with pytest.raises(ValueError, match="commit"):
        replace_snapshots(stamped(spark, [(DAYS[0], 1)]), target, [DAYS[0]], commit="later")


def test_a_table_partitioned_by_the_date(spark, tmp_path):
    name = plain_table(spark, tmp_path, "fecha_corte")
    assert replace_snapshots(stamped(spark, [(DAYS[1], 9)]), name, DAYS[1:]) == 1
    assert content(spark, name) == {(5, 1): 1, (6, 9): 1}
    assert replace_snapshots(stamped(spark, []), name, [DAYS[0]]) == 0
    assert content(spark, name) == {(6, 9): 1}
    assert spark.read.parquet(str(tmp_path / name)).count() == 1


def test_partition_values_that_disagree_with_the_date_fail(spark, target):
    moved = stamped(spark, [(DAYS[1], 9)]).withColumn("dia_particion", F.lit(7))
    with pytest.raises(PySparkException, match="outside the replaced days"):
        replace_snapshots(moved, target, [DAYS[1]])
    assert content(spark, target) == {(5, 1): 2, (6, 1): 2, (7, 1): 2}
