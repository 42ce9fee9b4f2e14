"""Dated-balance reporting and query-corpus analysis as plain Spark DataFrame jobs."""

from saldoflow.plans.report import CalendarReport, final_report

__all__ = ["CalendarReport", "final_report"]
