"""What the plans must look like at scale."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from saldoflow.functions.dates import cut_table
from saldoflow.operators.segments import SEGMENTS, balance_days, segment_totals, unit_totals
from saldoflow.plans.report import CalendarReport
from tests.brute import as_frame, make_calendar
from tests.conftest import SF_DIR

D = dt.date
CUT = D(2025, 11, 7)
DAYS = [D(2025, 10, 1) + dt.timedelta(days=k) for k in range(60)]
RUNS_WHEN_BUILT = {"snapshot_replace", "snapshot_unpartitioned", "snapshot_by_month", "snapshot_one_commit"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - RUNS_WHEN_BUILT))
def test_no_pairwise_joins_and_no_stray_python(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Ledger and books as parquet tables partitioned by day."""
    root = tmp_path_factory.mktemp("stored")
    measures = ", ".join(f"{m} decimal(18,2)" for _, m, _ in SEGMENTS)
    book = spark.createDataFrame([(d, *[Decimal(10)] * 8) for d in DAYS], f"fecha date, {measures}")
    accounts = spark.createDataFrame(
        [("08", "035", "2117", d, Decimal(-100), "S") for d in DAYS],
        "uc string, sub string, cuenta string, fecha date, saldo decimal(18,2), tipo_corte string",
    )
    for name, df in {"trad": book, "pib": book, "saldos": accounts}.items():
        df.repartition("fecha").write.partitionBy("fecha").parquet(str(root / name))
    return {name: spark.read.parquet(str(root / name)) for name in ("trad", "pib", "saldos")}


@pytest.fixture
def report(spark, stored):
    calendar = as_frame(spark, make_calendar(D(2025, 9, 1), D(2026, 12, 31), {D(2025, 11, 3)}))
    books = {"TRAD": stored["trad"], "PIB": stored["pib"]}
    return CalendarReport(calendar, stored["saldos"], books, cut_table(spark, CUT))


def files_read(spark, df):
    """Files read per scan of the last execution."""
    df.write.format("noop").mode("overwrite").save()
    store = spark._jsparkSession.sharedState().statusStore()
    last = store.executionsList().last()
    values = store.executionMetrics(last.executionId())
    metrics = last.metrics()
    found = {}
    for i in range(metrics.size()):
        metric = metrics.apply(i)
        if metric.name() == "number of files read":
            value = values.get(metric.accumulatorId())
            if value.isDefined():
                found[metric.accumulatorId()] = int(value.get().replace(",", ""))
    return sorted(found.values())


def test_each_source_is_scanned_once(report):
    text = plan(report.report())
    for name in ("trad", "pib", "saldos"):
        assert text.count(f"/{name}]") == 1, name


def test_a_single_cut_reads_only_its_day(spark, report):
    assert files_read(spark, report.report()) == [1, 1, 1]


def test_balances_read_only_the_days_of_the_calendar(spark, report):
    # Friday 7 November: balances of Monday 3 (off) to Friday 7, one file a day and book; 1 and 2 are a weekend
    assert files_read(spark, report.balances()) == [5, 5]


def test_raw_rows_are_summed_before_they_are_shuffled_or_joined(report):
    text = plan(report.report())
    lines = [line for line in text.split("\n") if "FileScan parquet" in line or "Exchange" in line or "partial_sum" in line]
    for i, line in enumerate(lines):
        if "/trad]" in line or "/saldos]" in line:
            above = next(x for x in reversed(lines[:i]) if "FileScan" not in x)
            assert "partial_sum" in above


def far_apart(spark, stored, cuts):
    calendar = as_frame(spark, make_calendar(D(2024, 9, 1), D(2026, 12, 31), {D(2025, 11, 3)}))
    return CalendarReport(calendar, stored["saldos"], {"TRAD": stored["trad"], "PIB": stored["pib"]}, cut_table(spark, *cuts))


def test_cuts_far_apart_read_only_their_days(spark, stored):
    cuts = D(2025, 10, 3), D(2025, 11, 28)
    report = far_apart(spark, stored, cuts)
    assert files_read(spark, report.report()) == [2, 2, 2]
    days = {r["fecha"] for r in balance_days(report.buckets).collect()}
    assert len(days) < 12 < (max(days) - min(days)).days
    held = len(days & set(DAYS))
    assert files_read(spark, report.balances()) == [held, held]


def test_text_dates_prune_partitions_as_well(spark, stored, tmp_path):
    texts = {}
    for name, df in stored.items():
        path = str(tmp_path / name)
        df.withColumn("fecha", F.date_format("fecha", "yyyy-MM-dd")).repartition("fecha").write.partitionBy("fecha").parquet(path)
        schema = df.drop("fecha").schema.add("fecha", "string")
        texts[name] = spark.read.schema(schema).parquet(path)
    cuts = D(2025, 10, 3), D(2025, 11, 28)
    report = far_apart(spark, texts, cuts)
    assert files_read(spark, report.report()) == [2, 2, 2]
    assert sorted(report.report().collect()) == sorted(far_apart(spark, stored, cuts).report().collect())


@pytest.mark.parametrize("step", ["segments", "units", "levels"])
def test_totals_take_one_shuffle_after_the_sums_per_date(report, step):
    report.buckets.count()
    text = plan(getattr(report, step)())
    assert len(re.findall(r"Exchange hashpartitioning\(fecha_corte#\d+, (?:libro#\d+, )?columna#", text)) == 1
    assert text.count("/trad]") == 1 and text.count("/pib]") == 1


def test_levels_are_books_segments_and_units(report):
    keys = ["fecha_corte", "uc", "sub", "columna", "valor"]
    levels = report.levels().persist()
    of = lambda name, *columns: sorted(levels.filter(F.col("nivel") == name).select(*columns).collect())
    assert of("libro", "libro", *keys) == sorted(report.balances().select("libro", *keys).collect())
    assert of("segmento", *keys) == sorted(segment_totals(report.balances()).select(*keys).collect())
    assert of("segmento", *keys) == sorted(report.segments().select(*keys).collect())
    unit = ["fecha_corte", "uc", "columna", "valor"]
    assert of("unidad", *unit) == sorted(unit_totals(report.balances()).select(*unit).collect())
    assert of("unidad", *unit) == sorted(report.units().select(*unit).collect())
