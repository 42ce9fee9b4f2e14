import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldoflow.functions.dates import date_key, report_clock, resolve_cut_dates, weekday_name
from saldoflow.operators.audit import add_audit_columns

NOW = "TIMESTAMP '2025-11-08 03:00:00 UTC'"  # 22:00 of the day before in the reporting zone


def resolved(spark, *requests, **options):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(requests)], "n int, solicitud string")
    rows = resolve_cut_dates(df, "solicitud", F.expr(NOW), **options).orderBy("n").collect()
    return [(r["fecha_corte"], r["fecha_corte_iso"], r["fecha_calculada"]) for r in rows]


def test_requests_for_today(spark):
    today = ("20251107", "2025-11-07", True)
    assert resolved(spark, None, "", "   ", "1900-01-01", "19000101", " 19000101 ") == [today] * 6


def test_given_dates(spark):
    given = ("20250228", "2025-02-28", False)
    assert resolved(spark, "2025-02-28", "20250228", " 2025-02-28 ", "2025-2-28") == [given] * 4


def test_run_day_columns(spark):
    df = spark.createDataFrame([("",)], "solicitud string")
    row = resolve_cut_dates(df, "solicitud", F.expr(NOW)).first()
    assert (row["hoy"], row["dia_anterior"]) == ("2025-11-07", "20251106")


@pytest.mark.parametrize("bad", ["2025-02-30", "20251399", "ayer", "2025", "2025022899", "20251107xyz", "2025-11-07x"])
def test_impossible_dates(spark, bad):
    with pytest.raises(PySparkException, match="not a cut date"):
        resolved(spark, bad)
    assert resolved(spark, bad, on_invalid="null") == [(None, None, False)]


def test_unknown_handling_is_refused(spark):
    with pytest.raises(ValueError):
        resolved(spark, "", on_invalid="skip")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Bogota"])
def test_clock_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = spark.range(1).select(report_clock(F.expr(NOW)).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert text == "2025-11-07 22:00:00"


def test_keys_and_names(spark):
    df = spark.createDataFrame([(dt.date(2025, 11, 5),), (dt.date(2025, 11, 8),)], "d date")
    rows = df.select(date_key(F.col("d")).alias("k"), weekday_name(F.col("d")).alias("n")).collect()
    assert [tuple(r) for r in rows] == [(20251105, "miércoles"), (20251108, "sábado")]


def test_audit_columns(spark):
    df = add_audit_columns(spark.range(1), F.expr(NOW), F.lit(dt.date(2025, 3, 9)))
    assert df.columns == ["id", "fecha_proceso", "fecha_corte", "anio_particion", "mes_particion", "dia_particion"]
    row = df.first()
    assert tuple(row)[1:] == (dt.datetime(2025, 11, 7, 22), dt.date(2025, 3, 9), 2025, 3, 9)
