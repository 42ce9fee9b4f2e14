"""The provided tables re-read as calendar, ledger, books, requests and query texts.

Every shape is derived by Spark from whole provided tables; the SQL twins repeat the same expressions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.functions.dates import WEEKDAY_NAMES, date_key, weekday_name
from saldoflow.operators.segments import SEGMENTS

# Holidays of the derived calendar, month-day.
HOLIDAYS = ("01-01", "05-01", "07-20", "08-07", "12-08", "12-25")
DAYS_BEFORE, DAYS_AFTER = 15, 400
TASKS_A_CORE = 4
MEASURES = tuple(measure for _, measure, _ in SEGMENTS)


class Tables:
    """The provided parquet tables of one scale directory, opened once each."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._read("lineitem")


def calendar(tables: Tables) -> DataFrame:
    """One row per date from 15 days before the first order to 400 days after the last.

    Sundays and holidays are off; Saturdays work in odd years only.
    """
    span = tables.orders.selectExpr(
        "CAST(min(o_orderdate) AS DATE) AS first", "CAST(max(o_orderdate) AS DATE) AS last"
    )
    dates = span.selectExpr(
        f"explode(sequence(date_sub(first, {DAYS_BEFORE}), date_add(last, {DAYS_AFTER}))) AS fec_fecha_iso"
    )
    day = F.col("fec_fecha_iso")
    return dates.select(
        date_key(day).alias("id_dh_fecha"),
        day,
        F.expr(
            f"""CASE WHEN weekday(fec_fecha_iso) = 6 OR date_format(fec_fecha_iso, 'MM-dd') IN {HOLIDAYS}
                       OR (weekday(fec_fecha_iso) = 5 AND year(fec_fecha_iso) % 2 = 0) THEN 0 ELSE 1 END"""
        ).alias("flg_dia_habil"),
        weekday_name(day).alias("nom_dia_semana"),
    )


CALENDAR_SQL = f"""
cal AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id_dh_fecha, d AS fec_fecha_iso,
         CASE WHEN isodow(d) = 7 OR strftime(d, '%m-%d') IN {HOLIDAYS}
                OR (isodow(d) = 6 AND year(d) % 2 = 0) THEN 0 ELSE 1 END AS flg_dia_habil,
         ({list(WEEKDAY_NAMES)})[isodow(d)] AS nom_dia_semana
  FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE) - {DAYS_BEFORE},
                                           CAST(max(o_orderdate) AS DATE) + {DAYS_AFTER},
                                           INTERVAL 1 DAY)) AS DATE) AS d FROM orders) s
)"""


def ledger(tables: Tables) -> DataFrame:
    """Orders as signed account balances."""
    return tables.orders.selectExpr(
        "IF(o_orderpriority = '1-URGENT', '09', '08') AS uc",
        "lpad(CAST(o_custkey % 8 * 5 + 35 AS STRING), 3, '0') AS sub",
        "IF(o_orderstatus = 'P', '2117', '2105') AS cuenta",
        "o_orderdate AS fecha",
        "CAST(-o_totalprice AS DECIMAL(18,2)) AS saldo",
        "IF(o_orderpriority = '5-LOW', 'D', 'S') AS tipo_corte",
    )


LEDGER_SQL = """
ledger AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN '09' ELSE '08' END AS uc,
         lpad(CAST(o_custkey % 8 * 5 + 35 AS VARCHAR), 3, '0') AS sub,
         CASE WHEN o_orderstatus = 'P' THEN '2117' ELSE '2105' END AS cuenta,
         o_orderdate AS fecha,
         CAST(-o_totalprice AS DECIMAL(18,2)) AS saldo,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'D' ELSE 'S' END AS tipo_corte
  FROM orders
)"""


def books(tables: Tables) -> dict[str, DataFrame]:
    """Line items as two books: returned lines are PIB, the others TRAD; the part picks the measure."""
    measures = [
        f"CASE WHEN l_partkey % 8 = {i} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS {m}"
        for i, m in enumerate(MEASURES)
    ]
    conditions = {"TRAD": "l_returnflag <> 'R'", "PIB": "l_returnflag = 'R'"}
    return {
        name: tables.lineitem.filter(condition).selectExpr("l_shipdate AS fecha", *measures)
        for name, condition in conditions.items()
    }


def _book_sql(name: str, condition: str) -> str:
    measures = ",\n         ".join(
        f"CASE WHEN l_partkey % 8 = {i} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS {m}"
        for i, m in enumerate(MEASURES)
    )
    return f"""
{name} AS (
  SELECT l_shipdate AS fecha,
         {measures}
  FROM lineitem WHERE {condition}
)"""


BOOKS_SQL = _book_sql("trad", "l_returnflag <> 'R'") + "," + _book_sql("pib", "l_returnflag = 'R'")


def cuts(tables: Tables) -> DataFrame:
    """Every date on which the ledger has a row."""
    return tables.orders.selectExpr("CAST(o_orderdate AS DATE) AS fecha_corte").distinct()


CUTS_SQL = """
cuts AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha_corte FROM orders)"""


def requests(tables: Tables) -> DataFrame:
    """Cut-date requests in every accepted spelling, one per order."""
    return tables.orders.selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderpriority = '1-URGENT' THEN date_format(o_orderdate, 'yyyy-MM-dd')
                WHEN o_orderpriority = '2-HIGH' THEN date_format(o_orderdate, 'yyyyMMdd')
                WHEN o_orderpriority = '3-MEDIUM' THEN '  ' || date_format(o_orderdate, 'yyyy-MM-dd') || ' '
                WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '1900-01-01'
                WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN '19000101'
                WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' END AS solicitud""",
    )


REQUESTS_SQL = """
requests AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y%m%d')
              WHEN o_orderpriority = '3-MEDIUM' THEN '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '1900-01-01'
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN '19000101'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' END AS solicitud
  FROM orders
)"""


# One query text per order. The expressions are common to both dialects; only the date spelling differs.
_CORPUS_PARTS = """
  SELECT o_orderkey AS query_id, o_orderstatus AS s, o_custkey % 7 AS grupo, iso, compacta, iso_previa, compacta_previa,
         chr(39) AS q, chr(10) AS nl, o_orderpriority AS p
  FROM fechas"""
_CORPUS_TEXT = """
  SELECT query_id, s, grupo, iso, compacta, iso_previa, q, p,
         CASE WHEN s = 'O' THEN '' ELSE '-- consulta ' || query_id || ' de 20240229' || nl END
         || 'WITH base AS (' || nl || '  SELECT t.id,  t.saldo, ' || q || p || q || ' AS prioridad' || nl
         || '  FROM ventas.pedidos_' || lower(s) || ' t' || nl
         || '  WHERE t.fecha = DATE ' || q || iso || q || ' AND t.clave <= ' || compacta || nl || ')'
         || CASE WHEN s = 'O' THEN '' ELSE
              ', clientes AS (SELECT c.id, (c.saldo + 1) AS saldo' || nl || 'FROM crm.cliente_' || grupo
              || ' c /* carga' || nl || compacta_previa || ' */ JOIN maestro.region r ON r.id = c.region'
              || ' WHERE c.alta >= ' || q || iso_previa || q || ' AND nota <> ' || q || 'cierre (parcial ' || iso || q
              || ')' END
         || CASE WHEN s = 'P' THEN
              ', ajuste AS ( SELECT id FROM lake.ventas.pedidos_p, legado.saldo_' || compacta
              || ' WHERE clave IN (' || compacta_previa || ', 20251399, ' || compacta_previa || ', '
              || q || compacta_previa || q || ') )' ELSE '' END
         || nl || 'SELECT b.id, extract(year FROM b.alta) AS anio FROM base b LEFT JOIN externo.tipo_' || grupo
         || ' x ON x.id = b.id' AS sql_text
  FROM partes"""


def corpus(tables: Tables) -> DataFrame:
    """A table of SQL texts with one to three CTEs, comments, literals and both date spellings.

    Orders are a small table for the work their texts make, so they are dealt over all cores first, however few files or row groups they come in.
    """
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    orders = tables.orders.select(*columns)
    return orders.sparkSession.sql(
        f"""
        WITH fechas AS (
          SELECT *, date_format(o_orderdate, 'yyyy-MM-dd') AS iso, date_format(o_orderdate, 'yyyyMMdd') AS compacta,
                 date_format(date_sub(o_orderdate, 30), 'yyyy-MM-dd') AS iso_previa,
                 date_format(date_sub(o_orderdate, 30), 'yyyyMMdd') AS compacta_previa
          FROM {{orders}}),
        partes AS ({_CORPUS_PARTS}),
        textos AS ({_CORPUS_TEXT})
        SELECT query_id, sql_text FROM textos""",
        orders=orders.repartition(TASKS_A_CORE * orders.sparkSession.sparkContext.defaultParallelism, *columns),
    )


CORPUS_SQL = f"""
fechas AS (
  SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m%d') AS compacta,
         strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d') AS iso_previa,
         strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m%d') AS compacta_previa
  FROM orders),
partes AS ({_CORPUS_PARTS}),
textos AS ({_CORPUS_TEXT})"""

# Table formats of the derived corpus; sources not listed are unknown.
CORPUS_FORMATS = {
    "ventas.pedidos_o": "iceberg",
    "ventas.pedidos_f": "iceberg",
    "crm.cliente_0": "parquet",
    "crm.cliente_3": "parquet",
    "maestro.region": "delta",
}


def entities(tables: Tables) -> DataFrame:
    """Orders after January 1995 as entities with a name and an amount."""
    return tables.orders.filter("o_orderdate > DATE '1995-01-31'").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS nombre", "CAST(o_totalprice AS DECIMAL(18,2)) AS monto"
    )


def audits(tables: Tables) -> DataFrame:
    """Line items as audits of orders."""
    return tables.lineitem.selectExpr("l_orderkey AS id_auditado", "l_suppkey AS auditoria")
