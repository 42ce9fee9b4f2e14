"""Segment balances: wide books to one row per segment and bucket.

A book has ``fecha`` and the eight measures. Each book is scanned once: the eight segment expressions are
summed per date in that scan, the per-date rows meet the calendar, and only the summed row per bucket is
turned from wide to long. A date belongs to up to nine cuts, so joining first would multiply raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.functions.dates import clip_to_dates
from saldoflow.operators.ledger import UNIT

# Segment code, measure, measure subtracted from it.
SEGMENTS = (
    ("035", "minoristas", None),
    ("040", "pymes_y_pnm", None),
    ("045", "entidades_financieras_vigiladas", "fics_abiertos_spp"),
    ("050", "fics_abiertos_spp", None),
    ("055", "sector_gobierno_no_financiero", None),
    ("060", "mayoristas_extranjeros", None),
    ("065", "mayoristas_sector_real_y_png", None),
    ("070", "depositos_judiciales", None),
)
SEGMENT_CODES = tuple(code for code, _, _ in SEGMENTS)
# Last bucket with balances and the weekend labels left out of it.
LAST_BALANCE_BUCKET = 5
WEEKEND_LABELS = ("Sábado", "Sabado", "Domingo", "sabado", "sábado", "domingo")


def _measures(segments) -> list[str]:
    """The measures the segments use, each once."""
    return list(dict.fromkeys(m for _, *pair in segments for m in pair if m is not None))


def _segment(code: str, measure: str, minus: str | None) -> str:
    """A segment from summed measures: sum(coalesce(m, 0)) is coalesce(sum(m), 0) for a group with rows."""
    value = f"coalesce(`{measure}`, 0)" + (f" - coalesce(`{minus}`, 0)" if minus else "")
    return f"{value} AS `{code}`"


def balance_days(buckets: DataFrame) -> DataFrame:
    """The bucket rows that take balances; a NULL label is left out as well."""
    return buckets.filter(f"columna <= {LAST_BALANCE_BUCKET} AND proyeccion NOT IN {WEEKEND_LABELS}")


def _sums(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    summed = rows.groupBy(*keys).agg({c: "sum" for c in columns})
    return summed.selectExpr(*keys, *[f"`sum({c})` AS `{c}`" for c in columns])


def balances_by_date(
    books: Mapping[str, DataFrame], days: DataFrame, segments=SEGMENTS, by_book: bool = True
) -> DataFrame:
    """Sum of every segment expression per (book and) date, one column per segment code."""
    measures = _measures(segments)
    parts = [
        clip_to_dates(book, "fecha", days, "fecha").selectExpr(
            f"'{name}' AS libro", "CAST(fecha AS DATE) AS fecha", *measures
        )
        for name, book in books.items()
    ]
    keys = ["libro", "fecha"] if by_book else ["fecha"]
    summed = _sums(reduce(DataFrame.unionByName, parts), keys, measures)
    return summed.selectExpr(*keys, *[_segment(*segment) for segment in segments])


def _per_bucket(by_date: DataFrame, days: DataFrame, keys: Sequence[str], segments) -> DataFrame:
    """Per-date sums gathered into buckets, one column per segment code."""
    dated = by_date.join(days.select("fecha_corte", "fecha", "columna"), "fecha")
    return _sums(dated, keys, [code for code, _, _ in segments])


def to_long(wide: DataFrame, keys: Sequence[str], segments=SEGMENTS) -> DataFrame:
    """One row per segment code."""
    return wide.unpivot(list(keys), [code for code, _, _ in segments], "sub", "valor")


def segment_long(
    books: Mapping[str, DataFrame], buckets: DataFrame, unit: str = UNIT, segments=SEGMENTS
) -> DataFrame:
    """Balances per cut, book, segment and bucket."""
    days = balance_days(buckets)
    keys = ["fecha_corte", "libro", "columna"]
    wide = _per_bucket(balances_by_date(books, days, segments), days, keys, segments)
    return to_long(wide, keys, segments).select(
        "fecha_corte", "libro", F.lit(unit).alias("uc"), "sub", "columna", "valor"
    )


def segments_with_unit_total(
    books: Mapping[str, DataFrame], days: DataFrame, unit: str = UNIT, segments=SEGMENTS
) -> DataFrame:
    """All books together, one column per segment code, with their sum as ``valor`` in the same row.

    The row still holds every segment, so the unit total needs no second aggregation and no join back.
    """
    keys = ["fecha_corte", "columna"]
    wide = _per_bucket(balances_by_date(books, days, segments, by_book=False), days, keys, segments)
    total = " + ".join(f"`{code}`" for code, _, _ in segments)
    return wide.selectExpr("*", f"{total} AS valor").withColumn("uc", F.lit(unit))


# Levels of ``balance_levels``.
BOOK, SEGMENT, UNIT_LEVEL = "libro", "segmento", "unidad"


def balance_levels(
    books: Mapping[str, DataFrame], buckets: DataFrame, unit: str = UNIT, segments=SEGMENTS
) -> DataFrame:
    """Balances of every level in one aggregation: ``nivel, fecha_corte, libro, uc, sub, columna, valor``.

    Per book and segment, per segment over all books (``libro`` NULL), and per unit (``sub`` NULL as well). The
    per-date sums are grouped once by two grouping sets; the unit total is added up inside the wide row.
    """
    codes = [code for code, _, _ in segments]
    days = balance_days(buckets).select("fecha_corte", "fecha", "columna")
    dated = balances_by_date(books, days, segments).join(days, "fecha")
    levels = dated.groupingSets(
        [["fecha_corte", "libro", "columna"], ["fecha_corte", "columna"]], "fecha_corte", "libro", "columna"
    ).agg(F.grouping("libro").alias("todos"), *[F.sum(f"`{c}`").alias(c) for c in codes])
    entries = ", ".join(f"named_struct('sub', '{c}', 'valor', `{c}`)" for c in codes)
    total = f"named_struct('sub', CAST(NULL AS STRING), 'valor', {' + '.join(f'`{c}`' for c in codes)})"
    rows = levels.selectExpr(
        "fecha_corte", "libro", "columna", "todos",
        f"explode(slice(array({entries}, {total}), 1, {len(codes)} + todos)) AS saldo",
    )
    level = f"CASE WHEN todos = 0 THEN '{BOOK}' WHEN saldo.sub IS NULL THEN '{UNIT_LEVEL}' ELSE '{SEGMENT}' END AS nivel"
    return rows.selectExpr(level, "fecha_corte", "libro", f"'{unit}' AS uc", "saldo.sub", "columna", "saldo.valor")


def segment_totals(balances: DataFrame) -> DataFrame:
    """Segment balances summed across books."""
    return balances.groupBy("fecha_corte", "uc", "sub", "columna").agg(F.sum("valor").alias("valor"))


def unit_totals(balances: DataFrame) -> DataFrame:
    """Unit balance per bucket, summed across segments and books."""
    return balances.groupBy("fecha_corte", "uc", "columna").agg(F.sum("valor").alias("valor"))
