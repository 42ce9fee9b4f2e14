"""SQL twins of the registered queries, in the plain per-cut form (DuckDB dialect).

They are written from the report's definition, not from the Spark plans: windows over every earlier or later
calendar row of a cut, one grouped query per segment and book, one scan per total.
"""

from __future__ import annotations

from saldoflow.checks import shapes
from saldoflow.checks.statement_forms import FORMS_SQL
from saldoflow.operators.segments import SEGMENTS, WEEKEND_LABELS

ORACLE: dict[str, str] = {}


def _with(*parts: str, final: str) -> str:
    return "WITH " + ("RECURSIVE " if FORMS_SQL in parts else "") + ",".join(parts) + "\n" + final


KEY = "CAST(strftime(fecha_corte, '%Y%m%d') AS INTEGER)"

# k counts calendar rows back from the cut: 1 to 4 are the window, 5 to 8 the rows before it.
BACKWARD_SQL = f"""
numerada AS (SELECT *, row_number() OVER (ORDER BY fec_fecha_iso) AS rn FROM cal),
previa AS (SELECT fecha_corte, rn AS ultima FROM cuts ASOF JOIN numerada ON fecha_corte > fec_fecha_iso),
earlier AS (
  SELECT fecha_corte, fec_fecha_iso AS fecha, nom_dia_semana AS label, flg_dia_habil AS flag,
         flg_dia_habil = 1 AND nom_dia_semana IS DISTINCT FROM 'sábado' AS working, ultima - rn + 1 AS k
  FROM previa CROSS JOIN range(8) atras(n) JOIN numerada ON rn = ultima - n
),
near AS MATERIALIZED (SELECT * FROM earlier),
numbered AS (
  SELECT a.fecha_corte, a.fecha, a.label, a.flag, a.working, a.k,
         count(*) AS day_number, count(*) FILTER (b.flag = 1) AS flagged, count(*) FILTER (b.working) AS worked
  FROM near a JOIN near b ON a.fecha_corte = b.fecha_corte AND b.k BETWEEN a.k AND 4
  WHERE a.k <= 4
  GROUP BY ALL
),
prior AS (
  SELECT a.fecha_corte, a.label AS proyeccion, a.fecha, CAST(1 AS BIGINT) AS columna
  FROM near a LEFT JOIN near b ON a.fecha_corte = b.fecha_corte AND b.k = a.k - 1 AND b.k >= 5
  WHERE a.k >= 5 AND NOT a.working
    AND NOT (a.label = 'jueves' AND (b.k IS NULL OR (b.label = 'viernes' AND b.flag = 1)))
),
atras AS (
  SELECT * FROM prior
  UNION ALL
  SELECT fecha_corte, label, fecha, CASE WHEN working THEN flagged WHEN label = 'jueves' THEN 5 ELSE worked + 1 END
  FROM numbered
  UNION ALL
  SELECT fecha_corte, nom_dia_semana, fec_fecha_iso, CASE flg_dia_habil WHEN 1 THEN 5 ELSE 8 END
  FROM cuts JOIN cal ON id_dh_fecha = {KEY}
)"""

NEXT_SQL = f"""
siguiente AS (
  SELECT fecha_corte, min(fec_fecha_iso) AS siguiente_habil
  FROM cuts JOIN cal ON id_dh_fecha > {KEY} AND flg_dia_habil = 1 AND nom_dia_semana <> 'sábado'
  GROUP BY fecha_corte
)"""

GAP_SQL = f"""
b4 AS (
  SELECT fecha_corte,
         CASE WHEN flg_dia_habil = 1 AND nom_dia_semana <> 'sábado' THEN '1' ELSE nom_dia_semana END AS proyeccion,
         fec_fecha_iso AS fecha, CAST(8 AS BIGINT) AS columna
  FROM siguiente JOIN cal ON fec_fecha_iso <= siguiente_habil AND id_dh_fecha > {KEY}
)"""


def _band(name: str, shift: int, rows: int, label_shift: int, bucket: str) -> str:
    return f"""
{name} AS (
  SELECT fecha_corte, CAST(n + {label_shift} AS VARCHAR) AS proyeccion, fec_fecha_iso AS fecha,
         CAST({bucket} AS BIGINT) AS columna
  FROM (SELECT fecha_corte, fec_fecha_iso,
               row_number() OVER (PARTITION BY fecha_corte ORDER BY fec_fecha_iso) AS n
        FROM siguiente JOIN cal ON fec_fecha_iso > siguiente_habil + {shift}) x
  WHERE n <= {rows}
)"""


BANDS_SQL = (
    _band("b5", 0, 6, 1, "n + 8")
    + ","
    + _band("b6", 6, 8, 7, "16")
    + ","
    + _band("b7", 14, 15, 15, "17")
    + ","
    + _band("b8", 29, 60, 30, "19")
    + ","
    + _band("b9", 89, 275, 90, "20")
    + """,
bandas AS (SELECT * FROM b5 UNION ALL SELECT * FROM b6 UNION ALL SELECT * FROM b7
           UNION ALL SELECT * FROM b8 UNION ALL SELECT * FROM b9)"""
)

CALENDAR = (shapes.CALENDAR_SQL, shapes.CUTS_SQL)

ORACLE["dim_calendar"] = _with(shapes.CALENDAR_SQL, final="SELECT * FROM cal")
ORACLE["lookback_window"] = _with(
    *CALENDAR,
    BACKWARD_SQL,
    final="""SELECT n.fecha_corte, n.fecha, n.flag AS flg_dia_habil, span.fecha_inicio, span.fecha_final
             FROM numbered n
             JOIN (SELECT fecha_corte, min(fecha) AS fecha_inicio, max(fecha) AS fecha_final
                   FROM numbered GROUP BY fecha_corte) span ON span.fecha_corte = n.fecha_corte""",
)
ORACLE["business_day_numbers"] = _with(
    *CALENDAR,
    BACKWARD_SQL,
    final="""SELECT fecha_corte, fecha, CAST(working AS INTEGER) AS working,
                    CASE WHEN flag = 1 THEN flagged END AS business_number, day_number
             FROM numbered""",
)
ORACLE["prior_lookback_holidays"] = _with(*CALENDAR, BACKWARD_SQL, final="SELECT * FROM prior")
ORACLE["backward_buckets"] = _with(*CALENDAR, BACKWARD_SQL, final="SELECT * FROM atras")
ORACLE["next_business_day"] = _with(*CALENDAR, NEXT_SQL, final="SELECT * FROM siguiente")
ORACLE["gap_days"] = _with(*CALENDAR, NEXT_SQL, GAP_SQL, final="SELECT * FROM b4")
ORACLE["forward_bands"] = _with(*CALENDAR, NEXT_SQL, BANDS_SQL, final="SELECT * FROM bandas")
ORACLE["bucket_calendar_multi_cut"] = _with(
    *CALENDAR,
    BACKWARD_SQL,
    NEXT_SQL,
    GAP_SQL,
    BANDS_SQL,
    final="SELECT * FROM atras UNION ALL SELECT * FROM b4 UNION ALL SELECT * FROM bandas",
)

SNAPSHOT_SQL = """
saldos AS (
  SELECT CAST(uc AS VARCHAR) AS uc, CAST(sub AS VARCHAR) AS sub, CAST(cuenta AS VARCHAR) AS cuenta,
         CAST(fecha AS DATE) AS fecha, CAST(saldo AS DECIMAL(38,0)) AS saldo
  FROM ledger
  WHERE CAST(fecha AS DATE) IN (SELECT fecha_corte FROM cuts) AND tipo_corte = 'S'
),
saldos_08 AS (SELECT * FROM saldos WHERE uc = '08')"""

CONTROL_SQL = """
control AS (
  SELECT a.fecha_corte, s.uc, s.fecha, a.columna,
         CAST(sum(s.saldo) AS DECIMAL(38,0)) AS valor_contable,
         CAST(sum(s.saldo) FILTER (s.cuenta = '2117') AS DECIMAL(38,0)) AS valor_2117
  FROM saldos_08 s JOIN atras a ON a.fecha = s.fecha AND a.fecha_corte = s.fecha
  GROUP BY a.fecha_corte, s.uc, s.fecha, a.columna
  HAVING bool_or(s.cuenta = '2117')
)"""


def _segment_branch(book: str, code: str, measure: str, minus: str | None) -> str:
    value = f"coalesce({measure}, 0)" + (f" - coalesce({minus}, 0)" if minus else "")
    return f"""
  SELECT fecha_corte, '{book}' AS libro, '08' AS uc, '{code}' AS sub, columna, sum({value}) AS valor
  FROM {book.lower()} t1 JOIN atras t2 ON CAST(t1.fecha AS DATE) = t2.fecha
  WHERE t2.columna <= 5 AND t2.proyeccion NOT IN {WEEKEND_LABELS}
  GROUP BY fecha_corte, columna"""


SEGMENTS_SQL = (
    "\nsegmentos AS ("
    + "\n  UNION ALL".join(_segment_branch(book, *segment) for book in ("TRAD", "PIB") for segment in SEGMENTS)
    + "\n)"
)

TOTALS_SQL = """
formato AS (
  SELECT fecha_corte, uc, columna, sum(valor) AS valor
  FROM (SELECT fecha_corte, libro, uc, columna, sum(valor) AS valor FROM segmentos
        GROUP BY fecha_corte, libro, uc, columna) x
  GROUP BY fecha_corte, uc, columna
),
por_segmento AS (
  SELECT fecha_corte, uc, sub, columna, sum(valor) AS valor FROM segmentos GROUP BY fecha_corte, uc, sub, columna
)"""

RECONCILED_SQL = """
conciliado AS (
  SELECT c.fecha_corte, c.uc, c.columna, c.fecha,
         CAST(abs(c.valor_contable) AS DECIMAL(38,2)) AS valor_contable,
         CAST(abs(c.valor_2117) AS DECIMAL(38,2)) AS valor_2117,
         CAST(f.valor AS DECIMAL(38,2)) AS valor_formato,
         CAST((f.valor + abs(CAST(c.valor_2117 AS DECIMAL(38,2))))
              - abs(CAST(c.valor_contable AS DECIMAL(38,2))) AS DECIMAL(38,2)) AS valor_diferencia
  FROM formato f
  JOIN control c ON f.fecha_corte = c.fecha_corte AND f.uc = c.uc AND f.columna = c.columna
  WHERE c.valor_contable <> 0
)"""

PRORATED_SQL = """
prorrateo AS (
  SELECT s.fecha_corte, s.uc, s.sub, s.columna, CAST(s.valor AS DECIMAL(38,2)) AS valor,
         CAST(s.valor AS DOUBLE) * 100 / nullif(CAST(r.valor_formato AS DOUBLE), 0) AS pct,
         CAST(r.valor_diferencia AS DOUBLE)
           * (CAST(s.valor AS DOUBLE) * 100 / nullif(CAST(r.valor_formato AS DOUBLE), 0)) / 100 AS parte,
         CASE WHEN s.sub = '065'
              THEN CAST((r.valor_contable - r.valor_formato) + s.valor AS DECIMAL(38,2)) END AS valor_ajustado
  FROM por_segmento s
  JOIN conciliado r ON s.fecha_corte = r.fecha_corte AND s.uc = r.uc AND s.columna = r.columna
)"""

REPORT = (
    *CALENDAR,
    shapes.LEDGER_SQL,
    shapes.BOOKS_SQL,
    BACKWARD_SQL,
    SNAPSHOT_SQL,
    CONTROL_SQL,
    SEGMENTS_SQL,
    TOTALS_SQL,
    RECONCILED_SQL,
    PRORATED_SQL,
)
FINAL_VALUE = "round(CASE WHEN sub = '065' THEN CAST(valor AS DOUBLE) ELSE CAST(valor AS DOUBLE) + parte END, 4)"

ORACLE["ledger_snapshot"] = _with(
    shapes.CUTS_SQL, shapes.LEDGER_SQL, SNAPSHOT_SQL, final="SELECT uc, sub, cuenta, fecha, saldo FROM saldos_08"
)
ORACLE["control_totals"] = _with(*REPORT, final="SELECT * FROM control")
ORACLE["segment_long"] = _with(
    *REPORT, final="SELECT * REPLACE (CAST(valor AS DECIMAL(38,2)) AS valor) FROM segmentos"
)
ORACLE["segment_totals"] = _with(
    *REPORT, final="SELECT * REPLACE (CAST(valor AS DECIMAL(38,2)) AS valor) FROM por_segmento"
)
ORACLE["unit_totals"] = _with(*REPORT, final="SELECT * REPLACE (CAST(valor AS DECIMAL(38,2)) AS valor) FROM formato")
ORACLE["balance_levels"] = _with(
    *REPORT,
    final="""SELECT nivel, fecha_corte, libro, uc, sub, columna, CAST(valor AS DECIMAL(38,2)) AS valor FROM (
               SELECT 'libro' AS nivel, fecha_corte, libro, uc, sub, columna, valor FROM segmentos
               UNION ALL SELECT 'segmento', fecha_corte, NULL, uc, sub, columna, valor FROM por_segmento
               UNION ALL SELECT 'unidad', fecha_corte, NULL, uc, NULL, columna, valor FROM formato) x""",
)
ORACLE["reconciliation"] = _with(*REPORT, final="SELECT * FROM conciliado")
ORACLE["proration"] = _with(
    *REPORT,
    final="""SELECT fecha_corte, uc, sub, columna, valor, round(pct, 4) AS porcentaje_prorateo,
                    CASE WHEN round(parte, 4) = 0 THEN 0.0 ELSE round(parte, 4) END AS valor_prorateo,
                    round(CAST(valor AS DOUBLE) + parte, 4) AS valor_sfc, valor_ajustado
             FROM prorrateo""",
)
ORACLE["final_report_multi_cut"] = _with(
    *REPORT, final=f"SELECT fecha_corte, uc, sub, columna, {FINAL_VALUE} AS valor FROM prorrateo"
)

# --- single cut, audit, requests, joins, sink -------------------------------------------------------------

CUT = "1997-05-02"
ONE_CUT_SQL = f"\ncuts AS (SELECT DATE '{CUT}' AS fecha_corte)"
ONE_CUT_REPORT = tuple(ONE_CUT_SQL if part is shapes.CUTS_SQL else part for part in REPORT)

ORACLE["final_report"] = _with(
    *ONE_CUT_REPORT, final=f"SELECT uc, sub, columna, {FINAL_VALUE} AS valor FROM prorrateo ORDER BY sub, columna"
)
ORACLE["bucket_calendar"] = _with(
    shapes.CALENDAR_SQL,
    ONE_CUT_SQL,
    BACKWARD_SQL,
    NEXT_SQL,
    GAP_SQL,
    BANDS_SQL,
    final="""SELECT proyeccion, fecha, columna
             FROM (SELECT * FROM atras UNION ALL SELECT * FROM b4 UNION ALL SELECT * FROM bandas) x""",
)
AUDIT = """TIMESTAMP '2001-11-07 22:00:00' AS fecha_proceso,
           CAST(year(fecha_corte) AS INTEGER) AS anio_particion,
           CAST(month(fecha_corte) AS INTEGER) AS mes_particion,
           CAST(day(fecha_corte) AS INTEGER) AS dia_particion"""
ORACLE["audit_columns"] = _with(
    *REPORT, final=f"SELECT fecha_corte, uc, sub, columna, {FINAL_VALUE} AS valor, {AUDIT} FROM prorrateo"
)
ORACLE["report_job"] = ORACLE["audit_columns"] + " WHERE fecha_corte BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'"
ORACLE["resolve_cut_dates"] = _with(
    shapes.REQUESTS_SQL,
    final="""SELECT o_orderkey, solicitud,
                    strftime(corte, '%Y%m%d') AS fecha_corte, strftime(corte, '%Y-%m-%d') AS fecha_corte_iso,
                    fecha_calculada, '2001-11-07' AS hoy, '20011106' AS dia_anterior
             FROM (SELECT o_orderkey, solicitud, hoy AS fecha_calculada,
                          CASE WHEN hoy THEN DATE '2001-11-07'
                               WHEN contains(solicitud, '-') THEN CAST(trim(solicitud) AS DATE)
                               ELSE CAST(strptime(substr(solicitud, 1, 8), '%Y%m%d') AS DATE) END AS corte
                   FROM (SELECT *, solicitud IS NULL OR trim(solicitud) IN ('', '1900-01-01', '19000101') AS hoy
                         FROM requests) r) x""",
)
ORACLE["audited_totals"] = """
WITH instituciones AS (
  SELECT o_orderkey AS id, o_orderstatus AS nombre, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1995-01-31' GROUP BY o_orderkey, o_orderstatus
),
resumen AS (
  SELECT i.id, i.nombre, i.total, count(DISTINCT l.l_suppkey) AS total_auditorias
  FROM instituciones i LEFT JOIN lineitem l ON l.l_orderkey = i.id
  GROUP BY i.id, i.nombre, i.total
)
SELECT r.id, r.nombre, CAST(r.total AS DECIMAL(38,2)) AS total, r.total_auditorias
FROM resumen r JOIN lineitem l ON r.id = l.l_orderkey"""
ORACLE["literal_row"] = _with(
    shapes.LEDGER_SQL,
    final=f"""SELECT 0 AS id, 'cabecera' AS descripcion, DATE '{CUT}' AS fecha_corte,
                     CAST(NULL AS DECIMAL(38,2)) AS saldo, CAST(NULL AS BIGINT) AS filas
              UNION ALL
              SELECT 1, 'total del día', CAST(fecha AS DATE), CAST(sum(saldo) AS DECIMAL(38,2)), count(*)
              FROM ledger GROUP BY CAST(fecha AS DATE)""",
)
ORACLE["sql_views"] = """
SELECT o_orderpriority AS prioridad, count(DISTINCT o_custkey) AS clientes,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS monto
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-10'
GROUP BY o_orderpriority"""
ORACLE["snapshot_replace"] = _with(
    shapes.LEDGER_SQL,
    final=f"""SELECT fecha_corte, uc, saldo, version, {AUDIT}
              FROM (SELECT CAST(last_day(fecha) AS DATE) AS fecha_corte, uc,
                           CAST(sum(saldo) AS DECIMAL(38,2)) AS saldo,
                           CASE WHEN year(min(fecha)) = 1997 THEN 2 ELSE 1 END AS version
                    FROM ledger WHERE year(fecha) <> 1997 OR month(fecha) IN (3, 6, 9, 12)
                    GROUP BY last_day(fecha), uc) x""",
)

THIRD_DAYS = _with(
    shapes.LEDGER_SQL,
    final=f"""SELECT fecha_corte, uc, CAST(sum(saldo) AS DECIMAL(38,2)) AS saldo,
                     CASE WHEN year(fecha_corte) = 1997 AND day(fecha_corte) % 3 = 0 THEN 2 ELSE 1 END AS version, {AUDIT}
              FROM (SELECT CAST(fecha AS DATE) AS fecha_corte, uc, saldo FROM ledger) x
              WHERE year(fecha_corte) <> 1997 OR day(fecha_corte) % 3 <> 0 OR month(fecha_corte) % 2 = 0
              GROUP BY fecha_corte, uc""",
)
for _layout in ("snapshot_unpartitioned", "snapshot_by_month", "snapshot_one_commit"):
    ORACLE[_layout] = THIRD_DAYS

# --- query corpus -------------------------------------------------------------------------------------------
# Cleaning and dates use the engine's own regular expressions; sources, CTE bodies and lineage are spelled out
# from the way the texts were put together, so they do not depend on any text extraction.

CLEAN_SQL = """
limpios AS (
  SELECT query_id, trim(regexp_replace(regexp_replace(regexp_replace(sql_text,
           '--[^\\n]*', '', 'g'), '(?s)/\\*.*?\\*/', '', 'g'), '\\s+', ' ', 'g')) AS sql_limpio
  FROM textos
)"""

DATES_SQL = """
tokens AS (
  SELECT query_id, unnest(t) AS token, generate_subscripts(t, 1) AS lugar
  FROM (SELECT query_id, regexp_extract_all(sql_limpio, '''[^'']*(?:''''[^'']*)*''|[\\p{L}\\p{N}_.$]+') AS t
        FROM limpios) x
),
literales AS (
  SELECT query_id, lugar, replace(token, chr(39), '') AS literal,
         CAST(coalesce(try_strptime(replace(token, chr(39), ''), '%Y-%m-%d'),
                       try_strptime(replace(token, chr(39), ''), '%Y%m%d')) AS DATE) AS fecha
  FROM tokens
  WHERE regexp_full_match(token, '''([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})''|[0-9]{8}')
),
numerados AS (
  SELECT query_id, literal, fecha, row_number() OVER (PARTITION BY query_id ORDER BY lugar) AS posicion
  FROM literales WHERE fecha IS NOT NULL
),
dominante AS (
  SELECT query_id, fecha AS fecha_dominante, count(*) AS veces, min(posicion) AS primera
  FROM numerados GROUP BY query_id, fecha
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, min(posicion)) = 1
)"""

SOURCES_SQL = """
fuentes AS (
  SELECT query_id, 1 AS posicion, 'base' AS cte, CAST(NULL AS VARCHAR) AS catalogo,
         'ventas' AS esquema, 'pedidos_' || lower(s) AS tabla FROM partes
  UNION ALL SELECT query_id, 2, 'clientes', NULL, 'crm', 'cliente_' || grupo FROM partes WHERE s <> 'O'
  UNION ALL SELECT query_id, 3, 'clientes', NULL, 'maestro', 'region' FROM partes WHERE s <> 'O'
  UNION ALL SELECT query_id, 4, 'ajuste', 'lake', 'ventas', 'pedidos_p' FROM partes WHERE s = 'P'
  UNION ALL SELECT query_id, 5, 'ajuste', NULL, 'legado', 'saldo_' || compacta FROM partes WHERE s = 'P'
  UNION ALL SELECT query_id, CASE s WHEN 'O' THEN 2 WHEN 'F' THEN 4 ELSE 6 END, NULL, NULL,
                   'externo', 'tipo_' || grupo FROM partes
)"""

BODIES_SQL = """
cuerpos AS (
  SELECT query_id, 1 AS posicion, 'base' AS nombre, false AS es_final,
         'SELECT t.id, t.saldo, ' || q || p || q || ' AS prioridad FROM ventas.pedidos_' || lower(s)
         || ' t WHERE t.fecha = DATE ' || q || iso || q || ' AND t.clave <= ' || compacta AS cuerpo
  FROM partes
  UNION ALL
  SELECT query_id, 2, 'clientes', false,
         'SELECT c.id, (c.saldo + 1) AS saldo FROM crm.cliente_' || grupo
         || ' c JOIN maestro.region r ON r.id = c.region WHERE c.alta >= ' || q || iso_previa || q
         || ' AND nota <> ' || q || 'cierre (parcial ' || iso || q
  FROM partes WHERE s <> 'O'
  UNION ALL
  SELECT query_id, 3, 'ajuste', false,
         'SELECT id FROM lake.ventas.pedidos_p, legado.saldo_' || compacta || ' WHERE clave IN (' || compacta_previa
         || ', 20251399, ' || compacta_previa || ', ' || q || compacta_previa || q || ')'
  FROM partes WHERE s = 'P'
  UNION ALL
  SELECT query_id, CASE s WHEN 'O' THEN 2 WHEN 'F' THEN 3 ELSE 4 END, NULL, true,
         'SELECT b.id, extract(year FROM b.alta) AS anio FROM base b LEFT JOIN externo.tipo_' || grupo
         || ' x ON x.id = b.id'
  FROM partes
)"""

CORPUS = (shapes.CORPUS_SQL, CLEAN_SQL, DATES_SQL)
FORMATS_SQL = "(VALUES " + ", ".join(f"('{n}', '{f}')" for n, f in shapes.CORPUS_FORMATS.items()) + ")"

ORACLE["corpus_clean"] = _with(shapes.CORPUS_SQL, CLEAN_SQL, final="SELECT * FROM limpios")
ORACLE["corpus_date_literals"] = _with(*CORPUS, final="SELECT query_id, posicion, literal, fecha FROM numerados")
ORACLE["corpus_dominant_date"] = _with(*CORPUS, final="SELECT * FROM dominante")
ORACLE["corpus_parameterised"] = _with(
    *CORPUS,
    """
sustituidos AS (
  SELECT query_id, fecha_dominante,
         regexp_replace(
           CASE WHEN has_iso
                THEN replace(replace(sql_limpio, chr(39) || iso || chr(39), '{fecha_corte_iso}'), iso, '{fecha_corte_iso}')
                ELSE sql_limpio END,
           '\\b' || compacta || '\\b', CASE WHEN has_compact THEN '{fecha_corte}' ELSE compacta END, 'g'
         ) AS sql_parametrizado
  FROM (SELECT l.query_id, l.sql_limpio, d.fecha_dominante,
               strftime(d.fecha_dominante, '%Y-%m-%d') AS iso, strftime(d.fecha_dominante, '%Y%m%d') AS compacta,
               bool_or(n.literal LIKE '%-%') AS has_iso, bool_or(n.literal NOT LIKE '%-%') AS has_compact
        FROM limpios l
        JOIN dominante d ON d.query_id = l.query_id
        JOIN numerados n ON n.query_id = l.query_id AND n.fecha = d.fecha_dominante
        GROUP BY ALL) x
)""",
    final="SELECT * FROM sustituidos",
)
ORACLE["corpus_sources"] = _with(
    shapes.CORPUS_SQL,
    SOURCES_SQL,
    final="""SELECT query_id, posicion, catalogo, esquema, tabla, esquema || '.' || tabla AS nombre_completo
             FROM fuentes""",
)
ORACLE["corpus_classified"] = _with(
    shapes.CORPUS_SQL,
    SOURCES_SQL,
    final=f"""SELECT query_id, posicion, esquema || '.' || tabla AS nombre_completo,
                     coalesce(f.col1, 'unknown') AS formato,
                     CASE WHEN f.col1 IS NULL THEN 'spark_catalog' ELSE 'glue_catalog' END AS catalogo_destino
              FROM fuentes LEFT JOIN {FORMATS_SQL} f ON f.col0 = esquema || '.' || tabla""",
)
ORACLE["corpus_source_list"] = _with(
    shapes.CORPUS_SQL,
    SOURCES_SQL,
    final="""SELECT query_id, string_agg(esquema || '.' || tabla, ',' ORDER BY posicion) AS fuentes
             FROM fuentes GROUP BY query_id""",
)
ORACLE["corpus_ctes"] = _with(shapes.CORPUS_SQL, BODIES_SQL, final="SELECT *, 0 AS profundidad, true AS valido FROM cuerpos")
ORACLE["corpus_lineage"] = _with(
    shapes.CORPUS_SQL,
    SOURCES_SQL,
    final="""SELECT query_id,
                    CASE cte WHEN 'base' THEN 1 WHEN 'clientes' THEN 2 WHEN 'ajuste' THEN 3
                             ELSE CASE s WHEN 'O' THEN 2 WHEN 'F' THEN 3 ELSE 4 END END AS cte_posicion,
                    cte AS nombre,
                    row_number() OVER (PARTITION BY query_id, cte ORDER BY posicion) AS posicion,
                    esquema || '.' || tabla AS nombre_completo
             FROM fuentes JOIN (SELECT query_id, s FROM partes) p USING (query_id)""",
)
ORACLE["corpus_params"] = _with(
    shapes.CORPUS_SQL,
    CLEAN_SQL,
    DATES_SQL,
    BODIES_SQL,
    final="""SELECT c.query_id, posicion, nombre,
                    contains(cuerpo, chr(39) || strftime(fecha_dominante, '%Y-%m-%d') || chr(39))
                      OR contains(cuerpo, '(parcial ' || strftime(fecha_dominante, '%Y-%m-%d')) AS usa_fecha_corte_iso,
                    regexp_matches(cuerpo, '\\b' || strftime(fecha_dominante, '%Y%m%d') || '\\b') AS usa_fecha_corte
             FROM cuerpos c JOIN dominante d ON d.query_id = c.query_id""",
)

ORACLE["corpus_statement_ctes"] = _with(
    FORMS_SQL,
    final="""SELECT query_id, posicion, nombre, es_final, replace(cuerpo, '{k}', k) AS cuerpo, profundidad, valido
             FROM pedidos JOIN partes USING (f)""",
)
ORACLE["corpus_statement_sources"] = _with(
    FORMS_SQL,
    final="""SELECT query_id, posicion, catalogo, esquema, replace(tabla, '{k}', k) AS tabla,
                    esquema || '.' || replace(tabla, '{k}', k) AS nombre_completo FROM pedidos JOIN tablas USING (f)""",
)
ORACLE["corpus_statement_source_list"] = _with(
    FORMS_SQL,
    final="""SELECT query_id, string_agg(esquema || '.' || replace(tabla, '{k}', k), ',' ORDER BY posicion) AS fuentes
             FROM pedidos JOIN tablas USING (f) GROUP BY query_id""",
)
ORACLE["corpus_statement_edges"] = _with(
    FORMS_SQL,
    final="""SELECT query_id, desde_posicion, d.nombre AS desde, hacia_posicion, h.nombre AS hacia
             FROM pedidos JOIN lecturas USING (f) JOIN partes d ON d.f = lecturas.f AND d.posicion = desde_posicion
                  JOIN partes h ON h.f = lecturas.f AND h.posicion = hacia_posicion""",
)
ORACLE["corpus_statement_lineage"] = _with(
    FORMS_SQL,
    final="""SELECT query_id, a.posicion AS cte_posicion, nombre, replace(nombre_completo, '{k}', k) AS nombre_completo
             FROM pedidos JOIN alcanzadas a USING (f) JOIN partes p ON p.f = a.f AND p.posicion = a.posicion""",
)

ORACLE["table_properties"] = """
SELECT 'origen' AS key, 'orders d''ayer' AS value
UNION ALL SELECT 'meses', CAST(count(DISTINCT last_day(o_orderdate)) AS VARCHAR) FROM orders"""
ORACLE["sql_files"] = _with(
    shapes.CORPUS_SQL,
    final="SELECT query_id // 500 AS lote, CAST(sum(length(sql_text) + 1) AS BIGINT) AS caracteres FROM textos GROUP BY 1",
)
