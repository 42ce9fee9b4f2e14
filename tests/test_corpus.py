import datetime as dt

import pytest
from pyspark.sql import functions as F

from saldoflow.operators import corpus as ops

D = dt.date


def texts(spark, *sql):
    return spark.createDataFrame([(i, s) for i, s in enumerate(sql, start=1)], "query_id int, sql_text string")


def sources(spark, sql):
    rows = ops.source_references(texts(spark, sql)).orderBy("posicion").collect()
    return [r["nombre_completo"] for r in rows]


def dates(spark, sql):
    rows = ops.query_dates(texts(spark, sql)).orderBy("posicion").collect()
    return [(r["literal"], r["fecha"]) for r in rows]


def ctes(spark, sql):
    rows = ops.query_ctes(texts(spark, sql)).orderBy("posicion").collect()
    return [(r["nombre"], r["cuerpo"]) for r in rows]


def test_cleaning(spark):
    sql = "SELECT a -- uno\n  /* dos\n lineas */ ,\t'x  y' FROM  t -- fin"
    assert ops.clean_queries(texts(spark, sql)).first()["sql_limpio"] == "SELECT a , 'x y' FROM t"


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("SELECT * FROM a.t JOIN b.u ON 1=1 LEFT JOIN a.t x ON 1=1", ["a.t", "b.u"]),
        ("SELECT * FROM a.t, b.u z , c.v AS w WHERE 1=1", ["a.t", "b.u", "c.v"]),
        ("with c as (select 1 from x.y) select * from c join c.d on 1=1", ["x.y", "c.d"]),
        ("SELECT * FROM cat.a.t JOIN a.t ON 1=1", ["a.t", "a.t"]),
        ("SELECT * FROM a.t JOIN b.t ON 1=1", ["a.t", "b.t"]),
        ("SELECT 'x FROM no.no' FROM a.t -- FROM no.nada", ["a.t"]),
        ("SELECT extract(day FROM q.f), trim(both ' ' FROM q.g) FROM a.t", ["a.t"]),
        ("SELECT 1 FROM a.t WHERE q.x IS DISTINCT FROM q.y", ["a.t"]),
        ('SELECT 1 FROM "a"."t" ORDER BY q.x, q.y', ["a.t"]),
        ("SELECT (SELECT max(x) FROM a.t), q.z FROM (SELECT 1 FROM b.u) s", ["a.t", "b.u"]),
        ("SELECT 1 FROM t", []),
        ('SELECT "x FROM no.no" FROM a.t', ["a.t"]),
        ("SELECT trim(upper('x') FROM q.g) FROM a.t", ["a.t"]),
        ("SELECT trim(" + "x" * 232 + " FROM q.g) FROM a.t", ["a.t"]),
        ("SELECT trim('" + "y(" * 9000 + "' FROM q.g) FROM a.t", ["a.t"]),
    ],
)
def test_sources(spark, sql, expected):
    assert sources(spark, sql) == expected


def test_catalog_is_kept_apart(spark):
    rows = ops.source_references(texts(spark, "SELECT * FROM cat.a.t JOIN a.t ON 1=1")).orderBy("posicion").collect()
    assert [(r["catalogo"], r["esquema"], r["tabla"]) for r in rows] == [("cat", "a", "t"), (None, "a", "t")]


def test_classification_from_mapping_and_table(spark):
    refs = ops.source_references(texts(spark, "SELECT * FROM a.t JOIN b.u ON 1=1"))
    expected = {("a.t", "iceberg", "glue_catalog"), ("b.u", "unknown", "spark_catalog")}

    def found(df):
        return {(r["nombre_completo"], r["formato"], r["catalogo_destino"]) for r in df.collect()}

    table = spark.createDataFrame([("a.t", "iceberg")], "nombre_completo string, formato string")
    assert found(ops.classify_sources(refs, {"a.t": "iceberg"})) == expected
    assert found(ops.classify_sources(refs, table)) == expected
    assert {f for _, f, _ in found(ops.classify_sources(refs, {}))} == {"unknown"}


def test_source_list(spark):
    df = ops.source_list(texts(spark, "SELECT * FROM b.u JOIN a.t ON 1=1", "SELECT 1"))
    assert {r["query_id"]: r["fuentes"] for r in df.collect()} == {1: "b.u,a.t", 2: ""}


def test_date_literals(spark):
    sql = """SELECT * FROM v.t_20250101 WHERE f = DATE '2025-11-07' AND k <= 20251107 AND k2 = '20251107'
             AND x = 'corte 2025-11-08' AND n = 20251399 AND m = 120251107 AND "20250102" = 1 AND y = -20251109
             AND e = '2025-02-30' AND d = 20251110.5 -- 20240101"""
    assert dates(spark, sql) == [
        ("2025-11-07", D(2025, 11, 7)),
        ("20251107", D(2025, 11, 7)),
        ("20251107", D(2025, 11, 7)),
        ("20251109", D(2025, 11, 9)),
    ]


def test_escaped_quotes_do_not_end_a_literal(spark):
    assert dates(spark, "SELECT 'it''s', 'a ''2025-11-07'' b', 20251108") == [("20251108", D(2025, 11, 8))]


def dominant(spark, *sql):
    rows = ops.dominant_dates(texts(spark, *sql)).collect()
    return {r["query_id"]: (r["fecha_dominante"], r["veces"], r["primera"]) for r in rows}


def test_dominant_date(spark):
    found = dominant(
        spark,
        "SELECT '2025-11-08', 20251107, '2025-11-07'",
        "SELECT 20251109, 20251108, '2025-11-08', '2025-11-09', 20250101",
        "SELECT 1",
    )
    assert found == {1: (D(2025, 11, 7), 2, 2), 2: (D(2025, 11, 9), 2, 1)}


def test_dominant_date_agrees_with_counting(spark):
    import collections
    import random

    rng = random.Random(5)
    sql, expected = [], {}
    for i in range(1, 60):
        picks = [D(2025, 1, rng.randint(1, 6)) for _ in range(rng.randint(1, 25))]
        sql.append("SELECT " + ", ".join(f"'{d}'" if rng.random() < 0.5 else d.strftime("%Y%m%d") for d in picks))
        best, times = collections.Counter(picks).most_common(1)[0]
        expected[i] = (best, times, picks.index(best) + 1)
    assert dominant(spark, *sql) == expected


def test_parameterised(spark):
    df = ops.parameterise(
        texts(
            spark,
            "SELECT DATE '2025-11-07', 20251107, '20251107', t_20251107, 120251107, '2025-11-08' FROM a.t",
            "SELECT 20251107 FROM x WHERE n = 'al 2025-11-07'",
            "SELECT 1",
        )
    )
    assert {r["query_id"]: r["sql_parametrizado"] for r in df.collect()} == {
        1: "SELECT DATE {fecha_corte_iso}, {fecha_corte}, '{fecha_corte}', t_20251107, 120251107, '2025-11-08' FROM a.t",
        2: "SELECT {fecha_corte} FROM x WHERE n = 'al 2025-11-07'",
        3: "SELECT 1",
    }


def test_ctes(spark):
    sql = """WITH RECURSIVE a AS (SELECT ')' AS x, (1 + (2)) AS y FROM s.t),
             "B" (c1, c2) AS NOT MATERIALIZED (SELECT "raro(" FROM a) SELECT * FROM a JOIN "B" ON (1 = 1)"""
    assert ctes(spark, sql) == [
        ("a", "SELECT ')' AS x, (1 + (2)) AS y FROM s.t"),
        ("B", 'SELECT "raro(" FROM a'),
        (None, 'SELECT * FROM a JOIN "B" ON (1 = 1)'),
    ]


def test_statement_without_ctes_and_broken_brackets(spark):
    assert ctes(spark, "SELECT 1 AS with_x") == [(None, "SELECT 1 AS with_x")]
    assert ctes(spark, "WITH a AS (SELECT 1), b AS (SELECT (2 SELECT 3") == [
        ("a", "SELECT 1"),
        (None, "b AS (SELECT (2 SELECT 3"),
    ]
    assert ops.query_ctes(texts(spark, None)).count() == 0


def test_parts_of_ctes_and_lists_of_any_length(spark):
    """More tables than one run of the fold holds, and deep brackets."""
    sql = "WITH a AS (SELECT 1 FROM " + ", ".join(f"s.t{i} x{i}" for i in range(700)) + ") SELECT " + "(" * 500 + "1" + ")" * 500 + " FROM a"
    assert ops.source_references(texts(spark, sql)).count() == 700
    assert [(r["desde"], r["hacia"]) for r in ops.cte_edges(texts(spark, sql)).collect()] == [(None, "a")]
    assert [r["valido"] for r in ops.query_ctes(texts(spark, sql, sql + ")")).orderBy("query_id").collect()] == [True, True, False, False]


def test_keywords_inside_names_and_literals(spark):
    sql = "SELECT t.from, fromage, 'a FROM x.y', from_x FROM a.from_t WHERE t.join = 1 AND into_x = (SELECT max(n) FROM b.u FOR UPDATE OF c.v)"
    assert sources(spark, sql) == ["a.from_t", "b.u"]
    assert sources(spark, 'SELECT 1 FROM"a"."t"JOIN`b`.`u`USING (id)') == ["a.t", "b.u"]
    assert sources(spark, "DELETE FROM a.t USING b.u, c.v x WHERE 1 = 1") == ["a.t", "b.u", "c.v"]
    assert sources(spark, "SELECT 1 FROM a.t LATERAL VIEW explode(x.y) e AS p, q.r") == ["a.t", "q.r"]
    assert sources(spark, "INSERT INTO a.t VALUES (1) ON DUPLICATE KEY UPDATE b.c = 1") == ["a.t"]


def test_lineage(spark):
    sql = "WITH a AS (SELECT 1 FROM s.t JOIN r.u ON 1=1), b AS (SELECT 1 FROM a) SELECT 1 FROM b, z.w"
    rows = ops.lineage(texts(spark, sql)).orderBy("cte_posicion", "posicion").collect()
    assert [(r["nombre"], r["nombre_completo"]) for r in rows] == [("a", "s.t"), ("a", "r.u"), (None, "z.w")]


def test_parts_are_those_of_the_whole_structure(spark):
    """CTEs are found without the tables; heads, brackets and valid texts are the same as with them, also in odd texts."""
    import random

    from saldoflow.functions import statements as st

    rng = random.Random(11)
    words = """WITH|WITH RECURSIVE|a AS (|b AS (|, c AS (|,|(|)|)|)|SELECT|FROM|JOIN|x.y|t|a.b.c|'it''s'|'|"q""w"|"|`k`|`|extract(|TRIM (|;|WHERE|AS|
AS (|d(e, f) AS MATERIALIZED (|UPDATE|INTO|LATERAL VIEW explode(|DISTINCT FROM|USING|a . with x as (|from(|ñandú|=|1.5e3|TABLE|with|fromage""".replace("\n", "").split("|")
    sql = ["".join(w + rng.choice(("", " ", " ")) for w in rng.choices(words, k=rng.randint(1, 40))) for _ in range(3000)]
    df = ops.clean_queries(texts(spark, *sql, "", None)).select("sql_limpio", st.pieces(F.col("sql_limpio")).alias("todo"), st.cte_pieces(F.col("sql_limpio")).alias("ctes"))
    rows = df.select(st.structure("todo").alias("a"), st.cte_structure("ctes").alias("b")).collect()
    kept = ("ini", "fin", "profundidad", "nombre")
    for a, b in rows:
        assert (a["ctes"] is None) == (b["ctes"] is None)  # of a null text
        assert [[c[k] for k in kept] for c in a["ctes"] or ()] == [[c[k] for k in kept] for c in b["ctes"] or ()]
        assert (a["cortes"], a["valido"]) == (b["cortes"], b["valido"])
    assert sum(bool(a["ctes"]) for a, _ in rows) > 50


@pytest.mark.parametrize("op", (ops.query_ctes, ops.cte_parameters), ids=lambda op: op.__name__)
def test_parts_alone_look_for_no_tables(spark, tmp_path, op):
    texts(spark, "WITH a AS (SELECT '2025-11-07') SELECT 1 FROM a").write.parquet(str(tmp_path / "q"))
    plan = op(spark.read.parquet(str(tmp_path / "q")))._jdf.queryExecution().optimizedPlan().toString()
    assert "cadena" not in plan and "niveles" not in plan


def test_spellings_of_the_date_are_made_once_for_a_row(spark):
    plan = ops.parameterise(texts(spark, "SELECT 20251107"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format(") <= 3


def test_texts_are_dealt_over_all_cores(spark, tmp_path):
    """Orders in one file of one row group make texts in many tasks."""
    from saldoflow.checks import shapes

    rows = [(i, i, "O", dt.datetime(2025, 1, 1 + i % 28), "5-LOW") for i in range(500)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    df = shapes.corpus(shapes.Tables(spark, str(tmp_path)))
    tasks = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= spark.sparkContext.defaultParallelism and df.count() == 500


def test_both_parameters_of_a_cte_are_found(spark):
    sql = "WITH a AS (SELECT 20251107, '2025-11-07'), b AS (SELECT 20251107) SELECT '2025-11-07', 20250101"
    rows = ops.cte_parameters(texts(spark, sql)).orderBy("posicion").collect()
    assert [(r["usa_fecha_corte_iso"], r["usa_fecha_corte"]) for r in rows] == [(True, True), (False, True), (True, False)]


def test_very_long_texts(spark):
    """Literals, comments and lists far beyond the depth a backtracking pattern survives."""
    many_quotes = "'" + "a''b" * 60_000 + "'"
    sql = f"SELECT {many_quotes}, '{'x' * 400_000}', 20251107 /* {'y ' * 200_000} */ FROM " + ", ".join(
        f"s.t{i}" for i in range(3_000)
    )
    assert dominant(spark, sql) == {1: (D(2025, 11, 7), 1, 1)}
    assert ops.source_references(texts(spark, sql)).agg(F.max("posicion")).first()[0] == 3_000
    assert len(ctes(spark, f"WITH a AS (SELECT {many_quotes}) SELECT 1")) == 2


ALL_OPS = (
    ops.clean_queries,
    ops.source_references,
    ops.source_list,
    ops.query_dates,
    ops.dominant_dates,
    ops.parameterise,
    ops.query_ctes,
    ops.lineage,
    ops.cte_edges,
    ops.resolved_lineage,
    ops.cte_parameters,
)


@pytest.mark.parametrize("op", ALL_OPS, ids=lambda op: op.__name__)
def test_texts_are_cleaned_once_and_never_shuffled(spark, tmp_path, op):
    texts(spark, "SELECT 1 FROM a.t WHERE f = '2025-11-07'").write.parquet(str(tmp_path / "q"))
    execution = op(spark.read.parquet(str(tmp_path / "q")))._jdf.queryExecution()
    assert "Exchange" not in execution.executedPlan().toString()
    assert execution.optimizedPlan().toString().count("regexp_replace(sql_text") == 1


@pytest.mark.parametrize("kept", ["20251107.5", '"t-20251107"', "esq.20251107", "a20251107", '"20251107"'])
def test_only_whole_tokens_become_markers(spark, kept):
    sql = f"SELECT {kept}, 'un \" y' FROM a.t WHERE k = 20251107 AND d = '20251107'"
    found = ops.parameterise(texts(spark, sql)).first().asDict()
    assert any(v == f"SELECT {kept}, 'un \" y' FROM a.t WHERE k = {{fecha_corte}} AND d = '{{fecha_corte}}'" for v in found.values())
