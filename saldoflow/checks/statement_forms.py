"""Forms of SQL statements with what each holds, written out by hand: parts, tables, and which part reads which.

Every order becomes one statement; ``{k}`` stands for its customer modulo 7.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.checks.shapes import Tables


@dataclass(frozen=True)
class Form:
    """``parts``: (name, brackets around it, body), the last one the final part. ``tables``: (catalog, schema, table) in order.
    ``written``: (part, full name) of the tables written in each part. ``reads``: (part, part read), counted from 1."""

    text: str
    parts: tuple
    tables: tuple
    written: tuple
    reads: tuple = ()
    valid: bool = True


def _plain(text: str, *tables: str) -> Form:
    """A statement without CTEs."""
    split = tuple(tuple(([None] + t.split("."))[-3:]) for t in tables)
    return Form(text, ((None, 0, text),), split, tuple((1, ".".join(t.split(".")[-2:])) for t in tables))


FORMS = (
    _plain("SELECT 1 FROM a.t{k} x, (SELECT 1) s, b.u", "a.t{k}", "b.u"),
    _plain("SELECT 1 FROM (a.t x JOIN b.u{k} y ON x.id = y.id), c.v", "a.t", "b.u{k}", "c.v"),
    _plain('SELECT 1 FROM a.t "x {k}", b.u', "a.t", "b.u"),
    _plain("SELECT 1 FROM a.t{k} AS x (c1,c2), b.u WHERE x.c1 IN (1, b.n)", "a.t{k}", "b.u"),
    _plain('SELECT 1 FROM "my db"."my t{k}", `o``d`.`t 2`', "my db.my t{k}", "o`d.t 2"),
    _plain("SELECT 1 FROM a . t{k} WHERE d = '{k}, no.no'", "a.t{k}"),
    _plain("MERGE INTO z.w{k} d USING a.t s ON d.id = s.id WHEN MATCHED THEN UPDATE SET d.x = s.x", "z.w{k}", "a.t"),
    _plain("INSERT INTO z.w (c, d) SELECT trim(both ' ' FROM q.g), n FROM cat.a.t{k} WHERE n IS NOT DISTINCT FROM q.y", "z.w", "cat.a.t{k}"),
    _plain("SELECT f.fn(a.x, b.y), q.z FROM r.s{k} LEFT JOIN LATERAL (SELECT 1 FROM m.n) l ON (q.a = q.b), p.o", "r.s{k}", "m.n", "p.o"),
    Form(
        "WITH `a` AS (SELECT 1 FROM s.t{k}) SELECT * FROM A",
        (("a", 0, "SELECT 1 FROM s.t{k}"), (None, 0, "SELECT * FROM A")),
        ((None, "s", "t{k}"),),
        ((1, "s.t{k}"),),
        ((2, 1),),
    ),
    Form(
        "INSERT INTO q.z WITH c AS (SELECT 2 FROM k.l{k}) SELECT * FROM c, c d",
        (("c", 0, "SELECT 2 FROM k.l{k}"), (None, 0, "INSERT INTO q.z SELECT * FROM c, c d")),
        ((None, "q", "z"), (None, "k", "l{k}")),
        ((1, "k.l{k}"), (2, "q.z")),
        ((2, 1),),
    ),
    Form(
        "WITH a AS (SELECT 1 FROM s.t{k}), b AS (WITH a AS (SELECT 1 FROM x.y) SELECT * FROM a JOIN q.w ON (a.x=1)) SELECT * FROM b, a",
        (
            ("a", 0, "SELECT 1 FROM s.t{k}"),
            ("b", 0, "WITH a AS (SELECT 1 FROM x.y) SELECT * FROM a JOIN q.w ON (a.x=1)"),
            ("a", 1, "SELECT 1 FROM x.y"),
            (None, 0, "SELECT * FROM b, a"),
        ),
        ((None, "s", "t{k}"), (None, "x", "y"), (None, "q", "w")),
        ((1, "s.t{k}"), (2, "x.y"), (2, "q.w"), (3, "x.y")),
        ((2, 3), (4, 2), (4, 1)),
    ),
    Form(
        "CREATE TABLE IF NOT EXISTS n.m{k} AS WITH a AS (SELECT ')' FROM s.t), b AS (SELECT 1 FROM a) SELECT * FROM b",
        (("a", 0, "SELECT ')' FROM s.t"), ("b", 0, "SELECT 1 FROM a"), (None, 0, "CREATE TABLE IF NOT EXISTS n.m{k} AS SELECT * FROM b")),
        ((None, "n", "m{k}"), (None, "s", "t")),
        ((1, "s.t"), (3, "n.m{k}")),
        ((2, 1), (3, 2)),
    ),
    Form(
        "SELECT * FROM (WITH d AS (SELECT 1 FROM e.f{k}) SELECT * FROM d) x JOIN d ON 1 = 1",
        (
            ("d", 1, "SELECT 1 FROM e.f{k}"),
            (None, 0, "SELECT * FROM (WITH d AS (SELECT 1 FROM e.f{k}) SELECT * FROM d) x JOIN d ON 1 = 1"),
        ),
        ((None, "e", "f{k}"),),
        ((1, "e.f{k}"), (2, "e.f{k}")),
        ((2, 1),),
    ),
    Form(
        "WITH RECURSIVE r (n) AS (SELECT 1 FROM g.h{k} UNION ALL SELECT n FROM r, g.i), \"S\" AS (SELECT 1 FROM r) SELECT 1 FROM s",
        (("r", 0, "SELECT 1 FROM g.h{k} UNION ALL SELECT n FROM r, g.i"), ("S", 0, "SELECT 1 FROM r"), (None, 0, "SELECT 1 FROM s")),
        ((None, "g", "h{k}"), (None, "g", "i")),
        ((1, "g.h{k}"), (1, "g.i")),
        ((1, 1), (2, 1), (3, 2)),
    ),
    Form(
        "WITH a AS (SELECT (1 FROM s.t{k}",
        ((None, 0, "WITH a AS (SELECT (1 FROM s.t{k}"),),
        ((None, "s", "t{k}"),),
        ((1, "s.t{k}"),),
        valid=False,
    ),
    Form(
        "WITH a AS (SELECT 1 FROM s.t{k}) SELECT 1) FROM a WHERE x = 'open",
        (("a", 0, "SELECT 1 FROM s.t{k}"), (None, 0, "SELECT 1) FROM a WHERE x = 'open")),
        ((None, "s", "t{k}"),),
        ((1, "s.t{k}"),),
        ((2, 1),),
        valid=False,
    ),
)


def statements(tables: Tables) -> DataFrame:
    """One statement for each order: ``query_id, sql_text``."""
    texts = F.array(*[F.lit(f.text) for f in FORMS])
    text = F.get(texts, F.pmod("o_orderkey", F.lit(len(FORMS))).cast("int"))
    filled = F.replace(text, F.lit("{k}"), (F.col("o_custkey") % 7).cast("string"))
    return tables.orders.select(F.col("o_orderkey").alias("query_id"), filled.alias("sql_text"))


def _value(x) -> str:
    if x is None:
        return "NULL"
    return str(x) if isinstance(x, (bool, int)) else "'" + x.replace("'", "''") + "'"


def _rows(name: str, columns: str, rows) -> str:
    lines = ",\n".join("  (" + ", ".join(_value(x) for x in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES\n{lines})"


_PARTS = [(i, n, *part[:1], n == len(f.parts), part[2], part[1], f.valid) for i, f in enumerate(FORMS) for n, part in enumerate(f.parts, 1)]
_TABLES = [(i, n, *t) for i, f in enumerate(FORMS) for n, t in enumerate(f.tables, 1)]

FORMS_SQL = ",\n".join(
    [
        f"pedidos AS (SELECT o_orderkey AS query_id, o_orderkey % {len(FORMS)} AS f, CAST(o_custkey % 7 AS VARCHAR) AS k FROM orders)",
        _rows("partes", "f, posicion, nombre, es_final, cuerpo, profundidad, valido", _PARTS),
        _rows("tablas", "f, posicion, catalogo, esquema, tabla", _TABLES),
        _rows("escritas", "f, posicion, nombre_completo", [(i, *w) for i, f in enumerate(FORMS) for w in f.written]),
        _rows("lecturas", "f, desde_posicion, hacia_posicion", [(i, *r) for i, f in enumerate(FORMS) for r in f.reads]),
        """alcanzadas AS (
  SELECT f, posicion, nombre_completo FROM escritas
  UNION SELECT l.f, l.desde_posicion, a.nombre_completo FROM lecturas l JOIN alcanzadas a ON a.f = l.f AND a.posicion = l.hacia_posicion)""",
    ]
)
