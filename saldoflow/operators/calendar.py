"""Business-day buckets around any number of cut dates.

A calendar has ``id_dh_fecha, fec_fecha_iso, flg_dia_habil, nom_dia_semana``, one row per date; cuts are a
table with ``fecha_corte``. Results are keyed by ``fecha_corte``. The window before a cut is its four latest
calendar rows; rows are counted, so missing dates do not shift anything. Windows are partitioned by cut and
hold at most eight rows each.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame

from saldoflow.functions.dates import FRIDAY, SATURDAY, THURSDAY
from saldoflow.operators.timeline import calendar_rows, cut_positions, dated_events, pick_positions, timeline

# Fixed values of the bucket layout.
LOOKBACK_ROWS = 4
PRIOR_BUCKET = 1
CUT_BUCKET = 5
GAP_BUCKET = 8
# (first label, rows, bucket); the bucket of the first band grows with the row.
FORWARD_BANDS = (
    (2, 6, None),
    (8, 8, 16),
    (16, 15, 17),
    (31, 60, 19),
    (91, 275, 20),
)
FIRST_BAND_SHIFT = 8

BAND_OFFSETS = tuple(first - 2 for first, _, _ in FORWARD_BANDS)

PRIOR, LOOKBACK, CUT_DAY, GAP = "previo", "ventana", "corte", "brecha"
# Position ranges relative to ``antes``, the number of calendar rows before the cut.
_BACKWARD_RANGES = {
    PRIOR: f"'{PRIOR}', antes - {2 * LOOKBACK_ROWS - 1}, antes - {LOOKBACK_ROWS}",
    LOOKBACK: f"'{LOOKBACK}', antes - {LOOKBACK_ROWS - 1}, antes",
    CUT_DAY: f"'{CUT_DAY}', antes + 1, hasta",
}
_BY_PART = "OVER (PARTITION BY fecha_corte, tramo ORDER BY fecha)"
_SO_FAR = "OVER (PARTITION BY fecha_corte, tramo ORDER BY fecha ROWS UNBOUNDED PRECEDING)"

# A day without a weekday name follows its flag where days are numbered; among the earlier days, whose rule is
# three-valued like the one below, it is kept only if its flag is 0.
_OFF = f"(flg_dia_habil = 0 OR (nom_dia_semana <=> '{SATURDAY}'))"
_OFF_EARLIER = f"(flg_dia_habil = 0 OR nom_dia_semana = '{SATURDAY}')"
# A holiday Thursday before a working Friday. Three-valued on purpose: the last row has no next day, so a holiday
# Thursday there is neither kept nor left out by the rule, and a filter drops it.
_BRIDGE = f"""(nom_dia_semana = '{THURSDAY}' AND flg_dia_habil = 0
               AND next_weekday = '{FRIDAY}' AND next_flag = 1)"""
_KEPT_PRIOR = f"({_OFF_EARLIER} AND NOT {_BRIDGE})"

# A working day takes its number among the flagged days; a day off takes the number after the working days so far.
_LOOKBACK_BUCKET = f"""
    CASE WHEN NOT {_OFF} THEN flagged_so_far
         WHEN nom_dia_semana = '{THURSDAY}' THEN {CUT_BUCKET}
         ELSE working_so_far + 1 END"""
_BACKWARD_BUCKET = f"""
    CASE tramo WHEN '{PRIOR}' THEN {PRIOR_BUCKET}
               WHEN '{CUT_DAY}' THEN IF(flg_dia_habil = 1, {CUT_BUCKET}, {GAP_BUCKET})
               ELSE {_LOOKBACK_BUCKET} END"""


def _backward_rows(line: DataFrame, *parts: str) -> DataFrame:
    """Calendar rows of the requested parts before (and at) each cut."""
    wanted = ", ".join(_BACKWARD_RANGES[p] for p in parts)
    ranges = cut_positions(line).selectExpr("fecha_corte", f"stack({len(parts)}, {wanted}) AS (tramo, desde, hasta)")
    return pick_positions(ranges, line).select("fecha_corte", "tramo", "fecha", "flg_dia_habil", "nom_dia_semana")


def _with_counts(rows: DataFrame) -> DataFrame:
    """Day number and running counts of flagged and of working days; one window, one sort."""
    return rows.selectExpr(
        "*",
        f"count_if(flg_dia_habil = 1) {_SO_FAR} AS flagged_so_far",
        f"count_if(NOT {_OFF}) {_SO_FAR} AS working_so_far",
        f"count(*) {_SO_FAR} AS day_number",
    )


def _with_next_day(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "*", f"lead(flg_dia_habil) {_BY_PART} AS next_flag", f"lead(nom_dia_semana) {_BY_PART} AS next_weekday"
    )


def _bucket_rows(rows: DataFrame, label: str, bucket: str) -> DataFrame:
    return rows.selectExpr("fecha_corte", f"{label} AS proyeccion", "fecha", f"CAST({bucket} AS BIGINT) AS columna")


def _next_rows(line: DataFrame) -> DataFrame:
    """Per cut with a later business day: that day's position and date."""
    business = calendar_rows(line).filter("habil = 1")
    return (
        cut_positions(line)
        .selectExpr("fecha_corte", "hasta", "habiles_hasta + 1 AS business_position")
        .join(business, "business_position")
        .selectExpr("fecha_corte", "hasta", "position AS siguiente", "fecha AS siguiente_habil")
    )


def _gap_ranges(following: DataFrame) -> DataFrame:
    return following.selectExpr(
        "fecha_corte", f"'{GAP}' AS tramo", "hasta + 1 AS desde", "siguiente AS hasta", "CAST(NULL AS INT) AS etiqueta"
    )


def _band_ranges(following: DataFrame, line: DataFrame) -> DataFrame:
    """Position range of every forward band.

    A band starts at the first calendar row after N + (first label - 2) days and counts rows from there.
    """
    bands = ", ".join(
        f"'banda {i}', {label}, {rows}, date_add(siguiente_habil, {label - 2})"
        for i, (label, rows, _) in enumerate(FORWARD_BANDS, start=1)
    )
    probes = following.selectExpr(
        "fecha_corte", f"stack({len(FORWARD_BANDS)}, {bands}) AS (tramo, etiqueta, filas, fecha)"
    )
    return probes.join(line.select("fecha", "position"), "fecha").selectExpr(
        "fecha_corte", "tramo", "position + 1 AS desde", "position + filas AS hasta", "etiqueta"
    )


def _forward(line: DataFrame, gap: bool, bands: bool) -> DataFrame:
    following = _next_rows(line)
    wanted = ([_gap_ranges(following)] if gap else []) + ([_band_ranges(following, line)] if bands else [])
    rows = pick_positions(reduce(DataFrame.union, wanted), line)

    row_in_band = "position - desde"
    buckets = " ".join(
        f"WHEN 'banda {i}' THEN " + (str(fixed) if fixed is not None else f"{row_in_band} + {1 + FIRST_BAND_SHIFT}")
        for i, (_, _, fixed) in enumerate(FORWARD_BANDS, start=1)
    )
    label = f"""
        CASE WHEN tramo <> '{GAP}' THEN CAST(etiqueta + {row_in_band} AS STRING)
             WHEN habil = 1 THEN '1' ELSE nom_dia_semana END"""
    return _bucket_rows(rows, label, f"CASE tramo {buckets} ELSE {GAP_BUCKET} END")


class CutCalendar:
    """A calendar seen from a table of cuts.

    The numbered timeline (one row per date) is persisted, because every result joins it with itself and the
    calendar and cuts may come from large tables; ``release`` lets it go.
    """

    def __init__(self, calendar: DataFrame, cuts: DataFrame):
        self.calendar = calendar
        self.cuts = cuts

    @cached_property
    def _events(self) -> DataFrame:
        return dated_events(self.calendar, self.cuts, BAND_OFFSETS).persist()

    @cached_property
    def _line(self) -> DataFrame:
        return timeline(self._events).persist()

    def release(self) -> None:
        for name in ("_line", "_events"):
            if name in self.__dict__:
                self.__dict__.pop(name).unpersist()

    def cut_dates(self) -> DataFrame:
        """The cuts, each once, from the persisted timeline."""
        return self._events.filter("es_corte = 1").selectExpr("fecha AS fecha_corte")

    def lookback_window(self) -> DataFrame:
        """The four latest calendar rows before each cut, with the first and last date of the window."""
        return _backward_rows(self._line, LOOKBACK).selectExpr(
            "fecha_corte",
            "fecha",
            "flg_dia_habil",
            "min(fecha) OVER (PARTITION BY fecha_corte) AS fecha_inicio",
            "max(fecha) OVER (PARTITION BY fecha_corte) AS fecha_final",
        )

    def business_day_numbers(self) -> DataFrame:
        """Numbering of the lookback window: flagged days among themselves, and all days.

        A Saturday whose flag is 1 uses up a number although it does not count as working.
        """
        return _with_counts(_backward_rows(self._line, LOOKBACK)).selectExpr(
            "fecha_corte",
            "fecha",
            f"IF({_OFF}, 0, 1) AS working",
            "IF(flg_dia_habil = 1, flagged_so_far, NULL) AS business_number",
            "day_number",
        )

    def prior_lookback_holidays(self) -> DataFrame:
        """Non-working days among the four rows before the lookback window: bucket 1."""
        rows = _with_next_day(_backward_rows(self._line, PRIOR)).filter(_KEPT_PRIOR)
        return _bucket_rows(rows, "nom_dia_semana", str(PRIOR_BUCKET))

    def backward_buckets(self) -> DataFrame:
        """Buckets of the days up to the cut: prior days off, the lookback window and the cut day itself."""
        rows = _with_next_day(_with_counts(_backward_rows(self._line, PRIOR, LOOKBACK, CUT_DAY)))
        kept = rows.filter(f"CASE WHEN tramo = '{PRIOR}' THEN {_KEPT_PRIOR} ELSE true END")
        return _bucket_rows(kept, "nom_dia_semana", _BACKWARD_BUCKET)

    def next_business_day(self) -> DataFrame:
        """First business day after each cut; cuts without one are absent."""
        return _next_rows(self._line).select("fecha_corte", "siguiente_habil")

    def gap_days(self) -> DataFrame:
        """Days after the cut up to and including the next business day: bucket 8."""
        return _forward(self._line, gap=True, bands=False)

    def forward_bands(self) -> DataFrame:
        """Day-count bands after the next business day, labelled 2 to 365."""
        return _forward(self._line, gap=False, bands=True)

    def bucket_calendar(self) -> DataFrame:
        """Every bucket of every cut: ``fecha_corte, proyeccion, fecha, columna``."""
        return self.backward_buckets().unionByName(_forward(self._line, gap=True, bands=True))
