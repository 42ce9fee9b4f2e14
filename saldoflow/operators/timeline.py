"""Exact row positions of dates in a calendar, without a single-task sort.

Every "n rows before / after the cut" question becomes arithmetic on positions followed by an equi-join,
so one job serves any number of cut dates and calendars with missing days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from saldoflow.functions.dates import SATURDAY

CALENDAR_COLUMNS = ("id_dh_fecha", "fec_fecha_iso", "flg_dia_habil", "nom_dia_semana")
BUSINESS_DAY = f"flg_dia_habil = 1 AND nom_dia_semana <> '{SATURDAY}'"


def dated_events(calendar: DataFrame, cuts: DataFrame, probe_offsets: tuple[int, ...] = ()) -> DataFrame:
    """One row per calendar date, cut date and probe date.

    ``probe_offsets`` adds the dates that lie that many days after a calendar row, so that a count can be
    looked up on dates the calendar may lack. Both inputs are read once.
    """
    day = "CAST(fec_fecha_iso AS DATE)"
    row = f"{day}, CAST(flg_dia_habil AS INT), nom_dia_semana, 1, IF({BUSINESS_DAY}, 1, 0), 0"
    probes = [f"date_add({day}, {k}), CAST(NULL AS INT), CAST(NULL AS STRING), 0, 0, 0" for k in probe_offsets]
    names = "(fecha, flg_dia_habil, nom_dia_semana, en_calendario, habil, es_corte)"
    days = calendar.selectExpr(f"stack({1 + len(probes)}, {', '.join([row, *probes])}) AS {names}")
    asked = cuts.selectExpr("CAST(fecha_corte AS DATE)", "CAST(NULL AS INT)", "CAST(NULL AS STRING)", "0", "0", "1")
    flags = {c: "max" for c in ("flg_dia_habil", "nom_dia_semana", "en_calendario", "habil", "es_corte")}
    per_date = days.union(asked).filter("fecha IS NOT NULL").groupBy("fecha").agg(flags)
    return per_date.selectExpr("fecha", *[f"`max({c})` AS {c}" for c in flags])


def timeline(events: DataFrame) -> DataFrame:
    """Dated events with running counts.

    ``position`` counts calendar rows up to and including the date, ``business_position`` those of them
    that are business days. Counting runs per month, and only one total per month is summed across months:
    the unpartitioned window sees at most twelve rows per year of calendar.
    """
    by_month = events.selectExpr("*", "trunc(fecha, 'month') AS mes")
    earlier_months = "OVER (ORDER BY mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = (
        by_month.groupBy("mes")
        .agg({"en_calendario": "sum", "habil": "sum"})
        .selectExpr(
            "mes",
            f"coalesce(sum(`sum(en_calendario)`) {earlier_months}, 0) AS filas_previas",
            f"coalesce(sum(`sum(habil)`) {earlier_months}, 0) AS habiles_previas",
        )
    )
    within_month = "OVER (PARTITION BY mes ORDER BY fecha ROWS UNBOUNDED PRECEDING)"
    counted = by_month.selectExpr(
        "*", f"sum(en_calendario) {within_month} AS filas_mes", f"sum(habil) {within_month} AS habiles_mes"
    )
    return counted.join(carried, "mes").selectExpr(
        "fecha",
        "flg_dia_habil",
        "nom_dia_semana",
        "en_calendario",
        "habil",
        "es_corte",
        "filas_previas + filas_mes AS position",
        "habiles_previas + habiles_mes AS business_position",
    )


def calendar_rows(line: DataFrame) -> DataFrame:
    """The numbered calendar rows of a timeline."""
    return line.filter("en_calendario = 1").select(
        "position", "fecha", "flg_dia_habil", "nom_dia_semana", "habil", "business_position"
    )


def cut_positions(line: DataFrame) -> DataFrame:
    """Per cut: calendar rows strictly before it, up to it, and business days up to it."""
    return line.filter("es_corte = 1").selectExpr(
        "fecha AS fecha_corte",
        "position - en_calendario AS antes",
        "position AS hasta",
        "business_position AS habiles_hasta",
    )


def pick_positions(ranges: DataFrame, line: DataFrame) -> DataFrame:
    """Calendar rows for inclusive position ranges.

    ``ranges`` has ``fecha_corte, tramo, desde, hasta`` and any further columns; empty ranges
    (``hasta < desde``) give nothing and positions outside the calendar simply find no row.
    """
    wanted = ranges.filter("hasta >= desde").selectExpr("*", "explode(sequence(desde, hasta)) AS position")
    return wanted.drop("hasta").join(calendar_rows(line), "position")
