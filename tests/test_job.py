import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldoflow.operators.segments import SEGMENTS
from saldoflow.plans.job import ReportJob
from saldoflow.sources.binding import SourceBinding, parse_source_list
from tests.brute import as_frame, make_calendar

D = dt.date
CUT = D(2025, 11, 7)


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    spark.sql("CREATE DATABASE IF NOT EXISTS stg")
    as_frame(spark, make_calendar(D(2025, 9, 1), D(2026, 12, 31), {D(2025, 11, 3)})).write.saveAsTable("stg.dim_tiempo")
    days = [D(2025, 11, 5), D(2025, 11, 6), CUT]
    spark.createDataFrame(
        [("08", "035", cuenta, day, Decimal(-100), "S") for day in days for cuenta in ("2105", "2117")],
        "uc string, sub string, cuenta string, fecha date, saldo decimal(18,2), tipo_corte string",
    ).write.saveAsTable("stg.saldos")
    measures = [m for _, m, _ in SEGMENTS]
    book = spark.createDataFrame(
        [(day, *[Decimal(10)] * 8) for day in days], "fecha date, " + ", ".join(f"{m} decimal(18,2)" for m in measures)
    )
    book.write.saveAsTable("stg.trad")
    book.write.saveAsTable("stg.pib")
    yield ReportJob(
        sources=SourceBinding(parse_source_list("stg.dim_tiempo,stg.saldos,stg.trad,stg.pib")),
        calendar="dim_tiempo",
        ledger="saldos",
        books={"TRAD": "trad", "PIB": "pib"},
        target="stg.tabla_resultado",
        location=str(tmp_path_factory.mktemp("target") / "tabla_resultado"),
    )
    spark.sql("DROP DATABASE stg CASCADE")


def test_daily_run_rerun_and_backfill(spark, job):
    now = F.expr("TIMESTAMP '2025-11-08 03:00:00 UTC'")
    assert job.run(spark, [None], now) == 8  # today in the reporting zone is the cut
    assert job.run(spark, ["20251107"], now) == 8
    assert job.run(spark, ["2025-11-05", "20251106", "2025-11-09"], now) == 16  # the Sunday has no rows
    table = spark.table("stg.tabla_resultado")
    counts = {r["fecha_corte"]: r["count"] for r in table.groupBy("fecha_corte").count().collect()}
    assert counts == {D(2025, 11, 5): 8, D(2025, 11, 6): 8, CUT: 8}
    row = table.filter("sub = '035' AND dia_particion = 7").first()
    # format 140 (the 045 segment nets to zero), ledger 200, control 100: difference 40, a seventh of it
    assert row["valor"] == pytest.approx(20 + 40 * 20 / 140)
    assert row["fecha_proceso"] == dt.datetime(2025, 11, 7, 22)
    assert not spark.catalog.isCached("stg.dim_tiempo")


def test_wrong_alias_names_the_available_ones(spark, job):
    broken = ReportJob(job.sources, "calendario", job.ledger, job.books, job.target, job.location)
    with pytest.raises(ValueError, match="dim_tiempo"):
        broken.run(spark, ["2025-11-07"])
