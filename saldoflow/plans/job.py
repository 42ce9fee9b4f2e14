"""The batch job: resolve the cut, build the report, stamp it and replace its day in the target table."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from saldoflow.functions.dates import cut_table, report_clock, resolved_cut
from saldoflow.operators.audit import add_audit_columns
from saldoflow.plans.report import CalendarReport
from saldoflow.sinks.snapshot import replace_snapshots
from saldoflow.sources.binding import SourceBinding, literal_row

log = logging.getLogger(__name__)


def target_location(bucket: str, folder: str, table: str, scheme: str = "s3") -> str:
    """``scheme://bucket/folder/table``."""
    return f"{scheme}://{bucket}/{folder.strip('/')}/{table}"


@dataclass(frozen=True)
class ReportJob:
    """Which source aliases feed the report and where it goes."""

    sources: SourceBinding
    calendar: str
    ledger: str
    books: Mapping[str, str]
    target: str
    location: str | None = None
    table_format: str = "parquet"
    properties: Mapping[str, str] = field(default_factory=dict)
    on_zero: str = "error"
    commit: str = "paths"

    def resolve(self, spark: SparkSession, requests: Sequence[str | None], now: Column) -> list[dt.date]:
        """Cut dates of the requests, each once, in order."""
        asked = literal_row(spark, solicitudes=None).select(
            F.explode(F.array(*[F.lit(r).cast("string") for r in requests])).alias("solicitud")
        )
        rows = asked.select(resolved_cut(F.col("solicitud"), report_clock(now)).alias("corte")).distinct()
        return sorted(row["corte"] for row in rows.collect())

    def run(self, spark: SparkSession, requests: Sequence[str | None] = (None,), now: Column | None = None) -> int:
        """Replace the days of the requested cuts and return the rows written.

        All cuts are one Spark job. ``now`` defaults to the current timestamp.
        """
        started = time.monotonic()
        clock = F.current_timestamp() if now is None else now
        days = self.resolve(spark, requests, clock)
        report = CalendarReport(
            self.sources.read(spark, self.calendar),
            self.sources.read(spark, self.ledger),
            {name: self.sources.read(spark, alias) for name, alias in self.books.items()},
            cut_table(spark, *days),
            on_zero=self.on_zero,
        )
        try:
            stamped = add_audit_columns(report.report(), clock)
            rows = replace_snapshots(
                stamped,
                self.target,
                days,
                location=self.location,
                table_format=self.table_format,
                properties=self.properties,
                commit=self.commit,
            )
        finally:
            report.release()
        log.info("%s: %d rows for %d cuts in %.1f s", self.target, rows, len(days), time.monotonic() - started)
        return rows
