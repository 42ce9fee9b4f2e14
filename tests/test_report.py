import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldoflow.functions.dates import cut_table
from saldoflow.operators.calendar import CutCalendar
from saldoflow.operators.ledger import control_totals, ledger_snapshot
from saldoflow.operators.reconcile import prorate, reconciliation, reported_value
from saldoflow.operators.segments import SEGMENTS, WEEKEND_LABELS, segment_long, segment_totals, unit_totals
from saldoflow.plans.report import CalendarReport, final_report
from tests.brute import as_frame, make_calendar

D = dt.date
MEASURES = [m for _, m, _ in SEGMENTS]
BOOK_SCHEMA = "fecha date, " + ", ".join(f"{m} decimal(18,2)" for m in MEASURES)
LEDGER_SCHEMA = "uc string, sub string, cuenta string, fecha date, saldo decimal(18,2), tipo_corte string"
CUT = D(2025, 11, 7)
HOLIDAYS = {D(2025, 11, 3), D(2025, 12, 25), D(2026, 1, 1)}


def book(spark, rows):
    """Rows of (date, {measure: value})."""
    return spark.createDataFrame(
        [(day, *[None if v.get(m) is None else Decimal(str(v[m])) for m in MEASURES]) for day, v in rows], BOOK_SCHEMA
    )


def ledger(spark, rows):
    return spark.createDataFrame(
        [(uc, "035", cuenta, day, None if saldo is None else Decimal(str(saldo)), tipo) for uc, cuenta, day, saldo, tipo in rows],
        LEDGER_SCHEMA,
    )


@pytest.fixture(scope="module")
def calendar(spark):
    return as_frame(spark, make_calendar(D(2025, 9, 1), D(2026, 12, 31), HOLIDAYS))


def report(calendar, accounts, trad, pib, *cuts, **options):
    spark = calendar.sparkSession
    return CalendarReport(calendar, accounts, {"TRAD": trad, "PIB": pib}, cut_table(spark, *cuts), **options)


def values(df):
    return {(r["fecha_corte"], r["sub"]): r["valor"] for r in df.collect()}


@pytest.fixture(scope="module")
def simple(spark, calendar):
    """Segments 200 + 200 + 600, ledger 950 of which 30 in the control account: difference 80."""
    trad = book(spark, [(CUT, {"minoristas": 150, "mayoristas_sector_real_y_png": 200}), (CUT, {"minoristas": 50})])
    pib = book(spark, [(CUT, {"depositos_judiciales": 600})])
    accounts = ledger(spark, [("08", "2105", CUT, -920, "S"), ("08", "2117", CUT, -30, "S")])
    return calendar, accounts, trad, pib


def test_proration_adds_the_excess_and_spares_the_exempt_segment(simple):
    found = values(report(*simple, CUT).report())
    assert len(found) == 8
    assert found[CUT, "035"] == pytest.approx(216)
    assert found[CUT, "065"] == pytest.approx(200)
    assert found[CUT, "070"] == pytest.approx(648)
    assert found[CUT, "040"] == 0


def test_intermediate_columns(simple):
    rows = {r["sub"]: r for r in report(*simple, CUT).prorated().collect()}
    assert rows["035"]["valor_diferencia"] == 80
    assert rows["035"]["porcentaje_prorateo"] == pytest.approx(20)
    assert rows["035"]["valor_prorateo"] == pytest.approx(16)
    assert rows["065"]["valor_ajustado"] == 950 - 1000 + 200
    assert rows["035"]["valor_ajustado"] is None


def test_shares_add_up(simple):
    sums = (
        report(*simple, CUT)
        .prorated()
        .agg(F.sum("porcentaje_prorateo").alias("pct"), F.sum("valor_sfc").alias("sfc"))
        .first()
    )
    assert sums["pct"] == pytest.approx(100)
    assert sums["sfc"] == pytest.approx(1000 + 80)


def test_report_from_general_operators_equals_the_one_pass_report(simple):
    run = report(*simple, CUT, D(2025, 11, 6))
    control = run.control()
    reconciled = reconciliation(run.units(), control)
    general = prorate(run.segments(), reconciled).withColumn("valor", reported_value())
    assert values(general) == values(run.report())


def test_final_report_is_ordered(simple):
    calendar, accounts, trad, pib = simple
    rows = final_report(calendar, accounts, {"TRAD": trad, "PIB": pib}, cut_table(calendar.sparkSession, CUT)).collect()
    assert [r["sub"] for r in rows] == [code for code, _, _ in SEGMENTS]
    assert {r["columna"] for r in rows} == {5}


@pytest.mark.parametrize("cut", [D(2025, 11, 9), D(2025, 11, 3), D(2025, 11, 8)])
def test_cuts_off_work_and_saturdays_report_nothing(spark, calendar, cut):
    accounts = ledger(spark, [("08", "2117", cut, -30, "S")])
    some = book(spark, [(cut, {"minoristas": 10})])
    assert report(calendar, accounts, some, some, cut).report().count() == 0


def test_holiday_thursday_is_added_to_the_cut_day(spark, calendar):
    cut, thursday = D(2026, 1, 2), D(2026, 1, 1)
    accounts = ledger(spark, [("08", "2117", cut, -40, "S")])
    trad = book(spark, [(cut, {"minoristas": 10}), (thursday, {"minoristas": 30})])
    rows = report(calendar, accounts, trad, book(spark, []), cut).prorated().filter("sub = '035'").collect()
    assert [r["valor"] for r in rows] == [40]


def test_units_without_the_control_account_are_dropped(spark, calendar):
    accounts = ledger(spark, [("08", "2105", CUT, -30, "S"), ("08", "2117", D(2025, 11, 6), -5, "S")])
    trad = book(spark, [(CUT, {"minoristas": 10})])
    assert report(calendar, accounts, trad, trad, CUT).control().count() == 0
    assert report(calendar, accounts, trad, trad, CUT).report().count() == 0


def test_control_account_rows_without_amount_keep_the_unit(spark, calendar):
    accounts = ledger(spark, [("08", "2105", CUT, -30, "S"), ("08", "2117", CUT, None, "S")])
    row = report(calendar, accounts, book(spark, []), book(spark, []), CUT).control().first()
    assert (row["valor_contable"], row["valor_2117"]) == (-30, None)


def test_zero_ledger_balance_is_dropped(spark, calendar):
    accounts = ledger(spark, [("08", "2105", CUT, 30, "S"), ("08", "2117", CUT, -30, "S")])
    trad = book(spark, [(CUT, {"minoristas": 10})])
    assert report(calendar, accounts, trad, trad, CUT).reconciled().count() == 0


def test_zero_unit_total_raises_or_gives_null(spark, calendar):
    accounts = ledger(spark, [("08", "2117", CUT, -30, "S")])
    trad = book(spark, [(CUT, {"minoristas": 10, "depositos_judiciales": -10})])
    nothing = book(spark, [])
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        report(calendar, accounts, trad, nothing, CUT).report().collect()
    found = values(report(calendar, accounts, trad, nothing, CUT, on_zero="null").report())
    assert found[CUT, "035"] is None and found[CUT, "065"] == 0
    with pytest.raises(ValueError):
        report(calendar, accounts, trad, nothing, CUT, on_zero="maybe").report()


def test_ledger_snapshot_types_and_filters(spark):
    accounts = ledger(
        spark,
        [
            ("08", "2105", CUT, "2.50", "S"),
            ("08", "2105", CUT, "-2.50", "S"),
            ("08", "2105", CUT, "1.00", "D"),
            ("09", "2105", CUT, "1.00", "S"),
            ("08", "2105", D(2025, 11, 6), "1.00", "S"),
        ],
    )
    found = ledger_snapshot(accounts, cut_table(spark, CUT))
    assert dict(found.dtypes)["saldo"] == "decimal(38,0)"
    assert sorted(r["saldo"] for r in found.collect()) == [-3, 3]


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_date_columns_of_any_type(spark, calendar, kind):
    text = "CASE WHEN fecha = DATE '2025-11-07' THEN '2025-11-07 23:59:59' ELSE CAST(fecha AS STRING) END"
    typed = f"CAST({text} AS {kind})" if kind != "date" else "fecha"
    accounts = ledger(spark, [("08", "2117", CUT, -30, "S"), ("08", "2117", D(2025, 11, 8), -7, "S")])
    trad = book(spark, [(CUT, {"minoristas": 10}), (D(2025, 11, 8), {"minoristas": 99})])
    accounts = accounts.withColumn("fecha", F.expr(typed))
    trad = trad.withColumn("fecha", F.expr(typed))
    found = report(calendar, accounts, trad, book(spark, []), CUT).prorated().filter("sub = '035'").collect()
    assert [r["valor"] for r in found] == [10]


def test_one_scan_equals_one_query_per_segment(spark, calendar):
    days = [D(2025, 10, 30) + dt.timedelta(days=k) for k in range(12)]
    trad = book(
        spark,
        [(day, {m: (i * 7 + k * 3) % 50 if (i + k) % 3 else None for k, m in enumerate(MEASURES)}) for i, day in enumerate(days * 3)],
    )
    pib = book(spark, [(day, {MEASURES[i % 8]: i}) for i, day in enumerate(days)])
    buckets = CutCalendar(calendar, cut_table(spark, CUT, D(2025, 11, 5))).backward_buckets()
    buckets.createOrReplaceTempView("t_buckets")
    trad.createOrReplaceTempView("t_trad")
    pib.createOrReplaceTempView("t_pib")
    branches = " UNION ALL ".join(
        f"""SELECT fecha_corte, '{name}' AS libro, '08' AS uc, '{code}' AS sub, columna,
                   SUM(COALESCE({m}, 0){f' - COALESCE({minus}, 0)' if minus else ''}) AS valor
            FROM t_{name.lower()} a JOIN t_buckets b ON CAST(a.fecha AS DATE) = b.fecha
            WHERE columna <= 5 AND proyeccion NOT IN {WEEKEND_LABELS} GROUP BY fecha_corte, columna"""
        for name in ("TRAD", "PIB")
        for code, m, minus in SEGMENTS
    )
    found = segment_long({"TRAD": trad, "PIB": pib}, buckets)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, spark.sql(branches).collect()))
    total = unit_totals(found).agg(F.sum("valor")).first()[0]
    assert total == segment_totals(found).agg(F.sum("valor")).first()[0]


def test_null_labels_take_no_balances(spark):
    days = spark.createDataFrame(
        [(CUT, None, CUT, 5), (CUT, "lunes", D(2025, 11, 3), 1)],
        "fecha_corte date, proyeccion string, fecha date, columna bigint",
    )
    trad = book(spark, [(CUT, {"minoristas": 1}), (D(2025, 11, 3), {"minoristas": 2})])
    found = segment_long({"TRAD": trad}, days).filter("sub = '035'").collect()
    assert [(r["columna"], r["valor"]) for r in found] == [(1, 2)]


def test_many_cuts_equal_each_single_cut(spark, calendar):
    days = [D(2025, 10, 20) + dt.timedelta(days=k) for k in range(25)]
    accounts = ledger(spark, [("08", "2117" if k % 2 else "2105", d, -(100 + i), "S") for i, d in enumerate(days) for k in (0, 1)])
    trad = book(spark, [(d, {MEASURES[i % 8]: 10 + i, "minoristas": 5}) for i, d in enumerate(days)])
    together = values(report(calendar, accounts, trad, trad, *days).report())
    apart = {}
    for day in days[9:16]:
        apart.update(values(report(calendar, accounts, trad, trad, day).report()))
    assert apart == {k: v for k, v in together.items() if k[0] in days[9:16]}
    assert len({cut for cut, _ in apart}) >= 4


def test_control_totals_of_a_cut_ignore_other_dates_of_its_calendar(spark, calendar):
    accounts = ledger(spark, [("08", "2117", CUT, -30, "S"), ("08", "2117", D(2025, 11, 6), -70, "S")])
    buckets = CutCalendar(calendar, cut_table(spark, CUT)).backward_buckets()
    assert [(r["fecha"], r["valor_contable"]) for r in control_totals(accounts, buckets).collect()] == [(CUT, -30)]
