"""The registered queries: each takes (spark, sf_dir) and reads the provided tables whole."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.checks import shapes, statement_forms
from saldoflow.functions.dates import cut_table
from saldoflow.functions.dates import resolve_cut_dates as resolve
from saldoflow.operators import corpus, joins
from saldoflow.operators.audit import add_audit_columns
from saldoflow.operators.calendar import CutCalendar
from saldoflow.plans.job import ReportJob, target_location
from saldoflow.plans.report import CalendarReport
from saldoflow.session import shared_folder
from saldoflow.sinks.snapshot import replace_snapshots
from saldoflow.sources import binding

QUERIES = {}


def registered(build):
    QUERIES[build.__name__] = build
    return build


def calendar_for(spark: SparkSession, sf_dir: str) -> CutCalendar:
    """The derived calendar seen from every date of the ledger."""
    tables = shapes.Tables(spark, sf_dir)
    return CutCalendar(shapes.calendar(tables), shapes.cuts(tables))


def report_for(spark: SparkSession, sf_dir: str, cuts: DataFrame | None = None) -> CalendarReport:
    """The report over the provided tables; without ``cuts``, for every date of the ledger."""
    tables = shapes.Tables(spark, sf_dir)
    return CalendarReport(
        shapes.calendar(tables),
        shapes.ledger(tables),
        shapes.books(tables),
        shapes.cuts(tables) if cuts is None else cuts,
        on_zero="null",  # the smallest tables have cuts without any balance
    )


def money(name: str):
    return F.col(name).cast("decimal(38,2)").alias(name)


def rounded(name: str):
    return F.round(name, 4).alias(name)


@registered
def dim_calendar(spark, sf_dir):
    return shapes.calendar(shapes.Tables(spark, sf_dir))


@registered
def lookback_window(spark, sf_dir):
    return calendar_for(spark, sf_dir).lookback_window()


@registered
def business_day_numbers(spark, sf_dir):
    return calendar_for(spark, sf_dir).business_day_numbers()


@registered
def prior_lookback_holidays(spark, sf_dir):
    return calendar_for(spark, sf_dir).prior_lookback_holidays()


@registered
def backward_buckets(spark, sf_dir):
    return calendar_for(spark, sf_dir).backward_buckets()


@registered
def next_business_day(spark, sf_dir):
    return calendar_for(spark, sf_dir).next_business_day()


@registered
def gap_days(spark, sf_dir):
    return calendar_for(spark, sf_dir).gap_days()


@registered
def forward_bands(spark, sf_dir):
    return calendar_for(spark, sf_dir).forward_bands()


@registered
def bucket_calendar_multi_cut(spark, sf_dir):
    return calendar_for(spark, sf_dir).bucket_calendar()


@registered
def ledger_snapshot(spark, sf_dir):
    return report_for(spark, sf_dir).snapshot()


@registered
def control_totals(spark, sf_dir):
    return report_for(spark, sf_dir).control()


@registered
def segment_long(spark, sf_dir):
    return report_for(spark, sf_dir).balances().withColumn("valor", money("valor"))


@registered
def segment_totals(spark, sf_dir):
    return report_for(spark, sf_dir).segments().withColumn("valor", money("valor"))


@registered
def unit_totals(spark, sf_dir):
    return report_for(spark, sf_dir).units().withColumn("valor", money("valor"))


@registered
def balance_levels(spark, sf_dir):
    return report_for(spark, sf_dir).levels().withColumn("valor", money("valor"))


@registered
def reconciliation(spark, sf_dir):
    return report_for(spark, sf_dir).reconciled().withColumns(
        {c: money(c) for c in ("valor_contable", "valor_2117", "valor_formato", "valor_diferencia")}
    )


@registered
def proration(spark, sf_dir):
    return report_for(spark, sf_dir).prorated().select(
        "fecha_corte",
        "uc",
        "sub",
        "columna",
        money("valor"),
        rounded("porcentaje_prorateo"),
        rounded("valor_prorateo"),
        rounded("valor_sfc"),
        money("valor_ajustado"),
    )


@registered
def final_report_multi_cut(spark, sf_dir):
    return report_for(spark, sf_dir).report().select("fecha_corte", "uc", "sub", "columna", rounded("valor"))


# The cut of the single-cut report: a working Friday after a holiday Thursday.
CUT = "1997-05-02"
# The run clock of the registered queries: still the previous day in the reporting zone.
CLOCK = "TIMESTAMP '2001-11-08 03:00:00 UTC'"


@registered
def final_report(spark, sf_dir):
    """One cut, ordered: the form a daily run uses."""
    report = report_for(spark, sf_dir, cut_table(spark, CUT)).report()
    return report.select("uc", "sub", "columna", rounded("valor")).orderBy(
        F.col("sub").asc_nulls_last(), F.col("columna").asc_nulls_last()
    )


@registered
def bucket_calendar(spark, sf_dir):
    """One cut: every bucket from the prior days off to the 365-day label."""
    calendar = CutCalendar(shapes.calendar(shapes.Tables(spark, sf_dir)), cut_table(spark, CUT))
    return calendar.bucket_calendar().drop("fecha_corte")


@registered
def audit_columns(spark, sf_dir):
    report = report_for(spark, sf_dir).report().select("fecha_corte", "uc", "sub", "columna", rounded("valor"))
    return add_audit_columns(report, F.expr(CLOCK))


@registered
def resolve_cut_dates(spark, sf_dir):
    return resolve(shapes.requests(shapes.Tables(spark, sf_dir)), "solicitud", F.expr(CLOCK))


@registered
def audited_totals(spark, sf_dir):
    tables = shapes.Tables(spark, sf_dir)
    return joins.audited_totals(
        shapes.entities(tables), shapes.audits(tables), "id", "nombre", "monto", "id_auditado", "auditoria"
    ).withColumn("total", money("total"))


@registered
def literal_row(spark, sf_dir):
    """A row of literals put in front of the ledger's totals per date."""
    header = binding.literal_row(
        spark, id=0, descripcion="cabecera", fecha_corte=dt.date.fromisoformat(CUT), saldo=None, filas=None
    )
    per_date = (
        shapes.ledger(shapes.Tables(spark, sf_dir))
        .groupBy(F.col("fecha").cast("date").alias("fecha_corte"))
        .agg(F.sum("saldo").cast("decimal(38,2)").alias("saldo"), F.count(F.lit(1)).alias("filas"))
    )
    return header.unionByName(per_date.withColumns({"id": F.lit(1), "descripcion": F.lit("total del día")}))


@registered
def sql_views(spark, sf_dir):
    """SQL texts as views in order, with table and date bound as parameters."""
    return binding.run_views(
        spark,
        [
            ("vw_pedidos", "SELECT * FROM IDENTIFIER(:pedidos) WHERE CAST(o_orderdate AS DATE) >= :desde"),
            (
                "vw_por_prioridad",
                """SELECT o_orderpriority AS prioridad, COUNT(DISTINCT o_custkey) AS clientes,
                          CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS monto
                   FROM vw_pedidos GROUP BY o_orderpriority""",
            ),
        ],
        "SELECT prioridad, clientes, monto FROM vw_por_prioridad",
        args={"pedidos": f"parquet.`{sf_dir}/orders.parquet`", "desde": dt.date(1995, 1, 10)},
        keep=False,
    )


@registered
def snapshot_replace(spark, sf_dir):
    """Write the ledger as month-end snapshots, then replace those of 1997 with quarter ends only.

    The other months of 1997 end up empty; all other years keep their first version.
    """
    ledger = shapes.ledger(shapes.Tables(spark, sf_dir)).withColumn("fecha_corte", F.last_day("fecha"))

    def snapshot(rows: DataFrame, version: int) -> DataFrame:
        sums = rows.groupBy("fecha_corte", "uc").agg(F.sum("saldo").cast("decimal(38,2)").alias("saldo"))
        return add_audit_columns(sums.withColumn("version", F.lit(version)), F.expr(CLOCK))

    cuts = [row["fecha_corte"] for row in ledger.select("fecha_corte").distinct().collect()]
    replaced = [cut for cut in cuts if cut.year == 1997]
    quarter_ends = ledger.filter("year(fecha_corte) = 1997 AND month(fecha_corte) % 3 = 0")
    run = uuid.uuid4().hex[:12]
    table, location = f"saldos_{run}", f"{shared_folder(spark)}/saldos_{run}"
    replace_snapshots(snapshot(ledger, 1), table, cuts, location=location)
    replace_snapshots(snapshot(quarter_ends, 2), table, replaced)
    return spark.table(table)


def third_days_replaced(spark: SparkSession, sf_dir: str, parts: tuple[str, ...], commit: str) -> DataFrame:
    """Daily sums in a table of some layout; every third day of 1997 is replaced, and in odd months emptied by that."""
    ledger = shapes.ledger(shapes.Tables(spark, sf_dir)).withColumn("fecha_corte", F.col("fecha").cast("date"))

    def snapshot(rows: DataFrame, version: int) -> DataFrame:
        sums = rows.groupBy("fecha_corte", "uc").agg(F.sum("saldo").cast("decimal(38,2)").alias("saldo"))
        return add_audit_columns(sums.withColumn("version", F.lit(version)), F.expr(CLOCK))

    days = [dt.date(1997, 1, 1) + dt.timedelta(days=k) for k in range(365)]
    replaced = [day for day in days if day.day % 3 == 0]
    again = ledger.filter("year(fecha_corte) = 1997 AND day(fecha_corte) % 3 = 0 AND month(fecha_corte) % 2 = 0")
    table = f"saldos_{uuid.uuid4().hex[:12]}"
    writer = snapshot(ledger, 1).write.format("parquet").option("path", f"{shared_folder(spark)}/{table}")
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)
    replace_snapshots(snapshot(again, 2), table, replaced, commit=commit)
    return spark.table(table)


@registered
def snapshot_unpartitioned(spark, sf_dir):
    return third_days_replaced(spark, sf_dir, (), "catalog")


@registered
def snapshot_by_month(spark, sf_dir):
    return third_days_replaced(spark, sf_dir, ("anio_particion", "mes_particion"), "paths")


@registered
def snapshot_one_commit(spark, sf_dir):
    """Months again; all partitions of the run are moved by one call to the catalog."""
    return third_days_replaced(spark, sf_dir, ("anio_particion", "mes_particion"), "catalog")


@registered
def report_job(spark, sf_dir):
    """The batch job for every ledger date of January 1997, and once more for some of them.

    Sources are named in a job parameter and bound by alias; the second run asks for its days in the other spelling.
    """
    tables, run = shapes.Tables(spark, sf_dir), uuid.uuid4().hex[:12]
    frames = {"tiempo": shapes.calendar(tables), "saldos": shapes.ledger(tables), **shapes.books(tables)}
    for name, frame in frames.items():
        frame.createOrReplaceGlobalTempView(f"{name}_{run}")
    days = shapes.cuts(tables).filter("fecha_corte BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'").collect()
    asked = sorted(row["fecha_corte"] for row in days)
    scheme, _, path = f"{'' if '://' in shared_folder(spark) else 'file://'}{shared_folder(spark)}".partition("://")
    bucket, _, folder = path.partition("/")
    table = f"resultado_{run}"
    job = ReportJob(
        sources=binding.SourceBinding(binding.parse_source_list(", ".join(f"global_temp.{name}_{run}" for name in frames))),
        calendar=f"tiempo_{run}",
        ledger=f"saldos_{run}",
        books={"TRAD": f"TRAD_{run}", "PIB": f"PIB_{run}"},
        target=table,
        location=target_location(bucket, folder, table, scheme),
        on_zero="null",
    )
    job.run(spark, [day.isoformat() for day in asked], F.expr(CLOCK))
    job.run(spark, [f"{day:%Y%m%d}" for day in asked[-3:]], F.expr(CLOCK))
    for name in frames:
        spark.catalog.dropGlobalTempView(f"{name}_{run}")
    return spark.table(table).withColumn("valor", F.round("valor", 4))


def corpus_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.corpus(shapes.Tables(spark, sf_dir))


@registered
def corpus_clean(spark, sf_dir):
    return corpus.clean_queries(corpus_for(spark, sf_dir))


@registered
def corpus_sources(spark, sf_dir):
    return corpus.source_references(corpus_for(spark, sf_dir))


@registered
def corpus_classified(spark, sf_dir):
    classified = corpus.classify_sources(corpus.source_references(corpus_for(spark, sf_dir)), shapes.CORPUS_FORMATS)
    return classified.select("query_id", "posicion", "nombre_completo", "formato", "catalogo_destino")


@registered
def corpus_source_list(spark, sf_dir):
    return corpus.source_list(corpus_for(spark, sf_dir))


@registered
def corpus_date_literals(spark, sf_dir):
    return corpus.query_dates(corpus_for(spark, sf_dir))


@registered
def corpus_dominant_date(spark, sf_dir):
    return corpus.dominant_dates(corpus_for(spark, sf_dir))


@registered
def corpus_parameterised(spark, sf_dir):
    return corpus.parameterise(corpus_for(spark, sf_dir))


@registered
def corpus_ctes(spark, sf_dir):
    return corpus.query_ctes(corpus_for(spark, sf_dir))


@registered
def corpus_lineage(spark, sf_dir):
    return corpus.lineage(corpus_for(spark, sf_dir))


@registered
def corpus_params(spark, sf_dir):
    return corpus.cte_parameters(corpus_for(spark, sf_dir))


def statements_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statement_forms.statements(shapes.Tables(spark, sf_dir))


@registered
def corpus_statement_ctes(spark, sf_dir):
    return corpus.query_ctes(statements_for(spark, sf_dir))


@registered
def corpus_statement_sources(spark, sf_dir):
    return corpus.source_references(statements_for(spark, sf_dir))


@registered
def corpus_statement_source_list(spark, sf_dir):
    return corpus.source_list(statements_for(spark, sf_dir))


@registered
def corpus_statement_edges(spark, sf_dir):
    return corpus.cte_edges(statements_for(spark, sf_dir))


@registered
def corpus_statement_lineage(spark, sf_dir):
    return corpus.resolved_lineage(statements_for(spark, sf_dir))


@registered
def table_properties(spark, sf_dir):
    """The properties that a snapshot table was created with, as the catalog gives them back."""
    ledger = shapes.ledger(shapes.Tables(spark, sf_dir)).withColumn("fecha_corte", F.last_day("fecha"))
    days = [row["fecha_corte"] for row in ledger.select("fecha_corte").distinct().collect()]  # one row a month
    sums = ledger.groupBy("fecha_corte", "uc").agg(F.sum("saldo").cast("decimal(38,2)").alias("saldo"))
    table = f"propiedades_{uuid.uuid4().hex[:12]}"
    named = {"origen": "orders d'ayer", "meses": str(len(days))}
    replace_snapshots(add_audit_columns(sums, F.expr(CLOCK)), table, days, location=f"{shared_folder(spark)}/{table}", properties=named)
    return spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key").isin(*named)).select("key", "value")


# Query texts in one file.
TEXTS_IN_FILE = 500


@registered
def sql_files(spark, sf_dir):
    """The query texts written to files, read back as whole files, saved, and scanned by a catalog-qualified name."""
    run = uuid.uuid4().hex[:12]
    folder, table = f"{shared_folder(spark)}/textos_{run}", f"textos_{run}"
    texts = corpus_for(spark, sf_dir).withColumn("lote", F.expr(f"query_id DIV {TEXTS_IN_FILE}"))
    in_files = texts.repartition("lote").sortWithinPartitions("lote", "query_id").select("lote", "sql_text")
    in_files.write.partitionBy("lote").text(folder)
    read = binding.read_query_texts(spark, folder, "*.txt")
    lote = F.regexp_extract("query_id", r"/lote=(\d+)/", 1).cast("long")
    sizes = read.groupBy(lote.alias("lote")).agg(F.sum(F.char_length("sql_text")).alias("caracteres"))
    sizes.write.format("parquet").option("path", f"{folder}_tabla").saveAsTable(table)
    sources = binding.SourceBinding(binding.parse_source_list(f"{spark.catalog.currentDatabase()}.{table}"), catalog="spark_catalog")
    return sources.read(spark, table)
