"""Audit and partition columns of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.functions.dates import report_clock

PARTITION_COLUMNS = ("anio_particion", "mes_particion", "dia_particion")


def partition_parts(day: Column) -> dict[str, Column]:
    """Year, month and day of a date as the three partition columns."""
    return dict(zip(PARTITION_COLUMNS, (F.year(day).cast("int"), F.month(day).cast("int"), F.dayofmonth(day).cast("int"))))


def add_audit_columns(df: DataFrame, now: Column, cut: Column | None = None) -> DataFrame:
    """Add run time (reporting-zone wall clock, whole seconds), cut date and partition columns.

    Without ``cut`` the frame's own ``fecha_corte`` is used.
    """
    day = F.col("fecha_corte") if cut is None else cut
    stamped = df.withColumns(
        {
            "fecha_proceso": F.date_trunc("second", report_clock(now)).cast("timestamp_ntz"),
            "fecha_corte": day.cast("date"),
        }
    )
    return stamped.withColumns(partition_parts(F.col("fecha_corte")))
