"""Reconciliation of segment balances with the ledger, and proration of the difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the segment that is reported without its share of the difference.
EXEMPT_SEGMENTS = ("065",)
UNIT_KEYS = ("fecha_corte", "uc", "columna")


def reconciliation(
    units: DataFrame, control: DataFrame, keys: Sequence[str] = UNIT_KEYS, carry: Sequence[str] = ()
) -> DataFrame:
    """Unit totals against absolute ledger totals, per bucket; units without a ledger balance are dropped.

    ``carry`` names further columns of ``units`` to keep.
    """
    contable, account = F.abs("valor_contable"), F.abs("valor_2117")
    return (
        control.filter(F.col("valor_contable") != 0)
        .join(units.withColumnRenamed("valor", "valor_formato"), list(keys))
        .select(
            *keys,
            "fecha",
            contable.alias("valor_contable"),
            account.alias("valor_2117"),
            "valor_formato",
            ((F.col("valor_formato") + account) - contable).alias("valor_diferencia"),
            *carry,
        )
    )


def _divide(numerator: Column, denominator: Column, on_zero: str) -> Column:
    return F.try_divide(numerator, denominator) if on_zero == "null" else numerator / denominator


def with_proration(
    rows: DataFrame,
    value: str = "valor",
    total: str = "valor_formato",
    difference: str = "valor_diferencia",
    on_zero: str = "error",
) -> DataFrame:
    """Add each row's percentage of ``total``, its share of ``difference`` and the adjusted value.

    Computed in double precision. A zero total raises unless ``on_zero="null"``.
    """
    if on_zero not in ("error", "null"):
        raise ValueError(f"on_zero must be 'error' or 'null', not {on_zero!r}")
    amount, whole, gap = (F.col(c).cast("double") for c in (value, total, difference))
    return (
        rows.withColumn("porcentaje_prorateo", _divide(amount * 100, whole, on_zero))
        .withColumn("valor_prorateo", gap * F.col("porcentaje_prorateo") / 100)
        .withColumn("valor_sfc", amount + F.col("valor_prorateo"))
    )


def prorate(
    detail: DataFrame,
    control: DataFrame,
    keys: Sequence[str] = UNIT_KEYS,
    value: str = "valor",
    total: str = "valor_formato",
    difference: str = "valor_diferencia",
    on_zero: str = "error",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Spread the control row's ``difference`` over the detail rows with the same keys.

    ``carry`` names further control columns to keep. ``control`` has one row per key, so a key that holds
    much of the detail is split by adaptive skew-join handling without repeating rows.
    """
    joined = detail.join(control.select(*keys, total, difference, *carry), list(keys))
    return with_proration(joined, value, total, difference, on_zero)


def adjusted_residual(contable: str = "valor_contable", total: str = "valor_formato", value: str = "valor") -> Column:
    """Ledger balance not covered by the segments, plus the segment's own balance."""
    return (F.col(contable) - F.col(total)) + F.col(value)


def reported_value(
    value: str = "valor", adjusted: str = "valor_sfc", segment: str = "sub", exempt=EXEMPT_SEGMENTS
) -> Column:
    """The adjusted value, or the plain one for exempt segments."""
    return F.when(F.col(segment).isin(*exempt), F.col(value).cast("double")).otherwise(F.col(adjusted))
