"""Ledger snapshot and control totals.

A ledger has ``uc, sub, cuenta, fecha, saldo, tipo_corte``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.functions.dates import clip_to_dates

# The reported unit, the snapshot type and the account taken out of the total.
UNIT = "08"
SNAPSHOT_TYPE = "S"
CONTROL_ACCOUNT = "2117"


def _typed(ledger: DataFrame, snapshot_type: str) -> DataFrame:
    return ledger.filter(F.col("tipo_corte") == snapshot_type).select(
        F.col("uc").cast("string").alias("uc"),
        F.col("sub").cast("string").alias("sub"),
        F.col("cuenta").cast("string").alias("cuenta"),
        F.col("fecha").cast("date").alias("fecha"),
        F.col("saldo").cast("decimal(38,0)").alias("saldo"),
    )


def ledger_snapshot(
    ledger: DataFrame, cuts: DataFrame, unit: str = UNIT, snapshot_type: str = SNAPSHOT_TYPE
) -> DataFrame:
    """Typed ledger rows of the unit that are dated on a cut."""
    days = cuts.select(F.col("fecha_corte").alias("fecha")).distinct()
    clipped = clip_to_dates(ledger, "fecha", days, "fecha")
    return _typed(clipped, snapshot_type).filter(F.col("uc") == unit).join(days, "fecha", "left_semi")


def control_totals(
    ledger: DataFrame,
    buckets: DataFrame,
    unit: str = UNIT,
    snapshot_type: str = SNAPSHOT_TYPE,
    account: str = CONTROL_ACCOUNT,
) -> DataFrame:
    """Ledger total and control-account total per cut and bucket.

    Both sums come from one pass, summed per date before any join, so the only rows shuffled are one per
    (task, date) and a date that holds most of the ledger costs nothing extra. Units without a
    control-account row on the date are dropped.
    """
    on_cut = buckets.filter(F.col("fecha") == F.col("fecha_corte")).select("fecha_corte", "fecha", "columna")
    clipped = clip_to_dates(ledger, "fecha", on_cut, "fecha")
    in_account = F.col("cuenta") == account
    per_date = (
        _typed(clipped, snapshot_type)
        .filter(F.col("uc") == unit)
        .groupBy("uc", "fecha")
        .agg(
            F.sum("saldo").alias("valor_contable"),
            F.sum(F.when(in_account, F.col("saldo"))).alias("valor_2117"),
            F.count(F.when(in_account, 1)).alias("filas_cuenta"),
        )
        .filter(F.col("filas_cuenta") > 0)
    )
    return per_date.join(on_cut, "fecha").select(
        "fecha_corte", "uc", "fecha", "columna", "valor_contable", "valor_2117"
    )
