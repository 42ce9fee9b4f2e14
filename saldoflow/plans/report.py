"""The reconciled segment report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.operators.calendar import CUT_BUCKET, CutCalendar
from saldoflow.operators.ledger import SNAPSHOT_TYPE, UNIT, control_totals, ledger_snapshot
from saldoflow.operators.reconcile import (
    EXEMPT_SEGMENTS,
    UNIT_KEYS,
    adjusted_residual,
    reconciliation,
    reported_value,
    with_proration,
)
from saldoflow.operators.segments import (
    SEGMENT_CODES,
    balance_days,
    balance_levels,
    segment_long,
    segments_with_unit_total,
    to_long,
)


@dataclass(frozen=True)
class CalendarReport:
    """Inputs of one report run; every step is a lazy DataFrame.

    Only the backward half of the calendar can carry balances, so the report never builds the bands. The
    bucket table (at most nine rows per cut) is read by every step, so it is persisted until ``release``.
    """

    calendar: DataFrame
    ledger: DataFrame
    books: Mapping[str, DataFrame]
    cuts: DataFrame
    unit: str = UNIT
    snapshot_type: str = SNAPSHOT_TYPE
    on_zero: str = "error"

    @cached_property
    def cut_calendar(self) -> CutCalendar:
        return CutCalendar(self.calendar, self.cuts)

    @cached_property
    def buckets(self) -> DataFrame:
        return self.cut_calendar.backward_buckets().persist()

    def release(self) -> None:
        if "buckets" in self.__dict__:
            self.__dict__.pop("buckets").unpersist()
        self.cut_calendar.release()

    def snapshot(self) -> DataFrame:
        return ledger_snapshot(self.ledger, self.cut_calendar.cut_dates(), self.unit, self.snapshot_type)

    def control(self) -> DataFrame:
        return control_totals(self.ledger, self.buckets, self.unit, self.snapshot_type)

    def balances(self) -> DataFrame:
        return segment_long(self.books, self.buckets, self.unit)

    def _totals_wide(self) -> DataFrame:
        """One row per cut and bucket: every segment over all books, and their sum."""
        return segments_with_unit_total(self.books, balance_days(self.buckets), self.unit)

    def segments(self) -> DataFrame:
        return to_long(self._totals_wide().drop("valor"), UNIT_KEYS).select(*UNIT_KEYS[:2], "sub", "columna", "valor")

    def units(self) -> DataFrame:
        return self._totals_wide().select(*UNIT_KEYS, "valor")

    def levels(self) -> DataFrame:
        """Books, segments and units of one aggregation."""
        return balance_levels(self.books, self.buckets, self.unit)

    def _reconciled_wide(self) -> DataFrame:
        """Reconciled units with their segment columns.

        Ledger rows exist for the cut date only, whose bucket is the cut bucket or a later one, and
        balances stop at the cut bucket; no other bucket can survive the join, so no other date is read.
        """
        days = balance_days(self.buckets).filter(F.col("columna") == CUT_BUCKET)
        units = segments_with_unit_total(self.books, days, self.unit)
        return reconciliation(units, self.control(), carry=SEGMENT_CODES)

    def reconciled(self) -> DataFrame:
        return self._reconciled_wide().drop(*SEGMENT_CODES)

    def prorated(self) -> DataFrame:
        control_columns = ["valor_contable", "valor_formato", "valor_diferencia"]
        rows = to_long(self._reconciled_wide(), [*UNIT_KEYS, *control_columns])
        return with_proration(rows, on_zero=self.on_zero).withColumn(
            "valor_ajustado", F.when(F.col("sub").isin(*EXEMPT_SEGMENTS), adjusted_residual())
        )

    def report(self) -> DataFrame:
        """``fecha_corte, uc, sub, columna, valor`` for all cuts, unsorted."""
        return self.prorated().select("fecha_corte", "uc", "sub", "columna", reported_value().alias("valor"))


def final_report(
    calendar: DataFrame, ledger: DataFrame, books: Mapping[str, DataFrame], cuts: DataFrame, **options
) -> DataFrame:
    """The report for all cuts, ordered by cut, segment and bucket."""
    return CalendarReport(calendar, ledger, books, cuts, **options).report().orderBy(
        "fecha_corte", F.col("sub").asc_nulls_last(), F.col("columna").asc_nulls_last()
    )
