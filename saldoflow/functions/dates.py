"""Date columns: keys, weekday names, index-friendly date filters, cut-date resolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weekday names as the calendar tables spell them, Monday first.
WEEKDAY_NAMES = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")
SATURDAY = "sábado"
THURSDAY = "jueves"
FRIDAY = "viernes"

# Requests that mean "today".
TODAY_REQUESTS = ("", "1900-01-01", "19000101")
REPORT_ZONE = "America/Bogota"


def date_key(day: Column) -> Column:
    """The YYYYMMDD integer of a date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekday_name(day: Column) -> Column:
    """Lower-case Spanish weekday name, independent of the JVM locale."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.weekday(day) + 1)


def _column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def clip_to_dates(df: DataFrame, name: str, days: DataFrame, day: str) -> DataFrame:
    """Keep only rows of ``df`` whose ``name`` is one of the dates of ``days``.

    A pre-filter for a later join on the date. One flag for each date between the first and the last one is
    looked up by position, which costs the same for any number of dates; as a run-time filter on the bare column it prunes
    partitions to the wanted days, however far apart they lie and also if the column is text. The bounds are given as
    well, because row groups can be skipped by them; text has no order that is known to agree with the date.
    """
    kind = _column_type(df, name)
    first = days.agg(F.min(day)).scalar()
    last = days.agg(F.max(day)).scalar()
    wanted = days.agg(
        F.expr(f"transform(sequence(min(`{day}`), max(`{day}`)), d -> array_contains(collect_set(`{day}`), d))")
    ).scalar()
    column = F.col(name)
    exact = df.filter(F.coalesce(F.get(wanted, F.datediff(column.cast("date"), first)), F.lit(False)))
    if isinstance(kind, T.DateType):
        return exact.filter((column >= first) & (column <= last))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        to = kind.simpleString()
        return exact.filter((column >= first.cast(to)) & (column < F.date_add(last, 1).cast(to)))
    return exact


def cut_table(spark: SparkSession, *cuts: dt.date | str) -> DataFrame:
    """A ``fecha_corte`` table from literal dates (ISO text or ``datetime.date``)."""
    days = sorted({dt.date.fromisoformat(c) if isinstance(c, str) else c for c in cuts})
    return spark.createDataFrame([(d,) for d in days], "fecha_corte date")


def report_clock(instant: Column) -> Column:
    """Wall time of the reporting zone at an instant, as a timestamp without zone, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(REPORT_ZONE), instant.cast("timestamp_ntz"))


def resolved_cut(request: Column, now_local: Column, on_invalid: str = "error") -> Column:
    """The cut date a text request stands for.

    NULL, blank and the two 1900 placeholders mean the current day of ``now_local``; text with a hyphen
    is read as year-month-day, exactly eight digits as YYYYMMDD; any other text is invalid. ``on_invalid``
    is ``"error"`` or ``"null"``.
    """
    if on_invalid not in ("error", "null"):
        raise ValueError(f"on_invalid must be 'error' or 'null', not {on_invalid!r}")
    text = F.trim(request)
    iso = F.when(text.contains("-"), text).when(
        text.rlike("^[0-9]{8}$"), F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    )
    parsed = F.try_to_date(iso, "yyyy-M-d")
    if on_invalid == "error":
        bad = F.concat(F.lit("not a cut date: "), text)
        parsed = F.when(parsed.isNull(), F.raise_error(bad).cast("date")).otherwise(parsed)
    return F.when(is_today_request(request), F.to_date(now_local)).otherwise(parsed)


def is_today_request(request: Column) -> Column:
    """True where a request asks for the current day."""
    return request.isNull() | F.trim(request).isin(*TODAY_REQUESTS)


def resolve_cut_dates(requests: DataFrame, request: str, now: Column, on_invalid: str = "error") -> DataFrame:
    """Add the cut date, its two spellings, and the run-day columns to a table of requests."""
    local = report_clock(now)
    cut = resolved_cut(F.col(request), local, on_invalid)
    return (
        requests.withColumn("cut", cut)
        .withColumns(
            {
                "fecha_corte": F.date_format("cut", "yyyyMMdd"),
                "fecha_corte_iso": F.date_format("cut", "yyyy-MM-dd"),
                "fecha_calculada": is_today_request(F.col(request)),
                "hoy": F.date_format(local, "yyyy-MM-dd"),
                "dia_anterior": F.date_format(F.date_sub(F.to_date(local), 1), "yyyyMMdd"),
            }
        )
        .drop("cut")
    )
