"""Questions over a table of query texts: sources, dates, CTEs, lineage.

Input: any frame with a key column and a text column. Every operator is a projection, explode or map-side
lookup of single rows, so a corpus of any size is read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.functions.statements import cte_pieces, cte_structure, meant, name_parts, pieces, structure
from saldoflow.functions.text import COMPACT_MARKER, ISO_MARKER, clean_sql, date_literals, dominant_date, parameterised

# What an unlisted source is taken for, and the catalog of listed ones.
UNKNOWN_FORMAT = "unknown"
LISTED_CATALOG, UNLISTED_CATALOG = "glue_catalog", "spark_catalog"


def clean_queries(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Texts without comments and with single blanks."""
    return corpus.select(key, clean_sql(F.col(text)).alias("sql_limpio"))


def _structured(cleaned: DataFrame, key: str, text: str) -> DataFrame:
    """The text, the ``forma`` of its statement and its table names (``nombres``), each found once for a row."""
    formed = cleaned.select(key, F.col(text).alias("texto"), pieces(F.col(text)).alias("piezas")).select(key, "texto", structure("piezas").alias("forma"))

    def named(ref: Column) -> Column:
        parts = ref["partes"]
        full = F.concat(F.element_at(parts, -2), F.lit("."), F.element_at(parts, -1))
        table = F.struct(
            F.try_element_at(parts, F.lit(-3)).alias("catalogo"),
            F.element_at(parts, -2).alias("esquema"),
            F.element_at(parts, -1).alias("tabla"),
            full.alias("nombre_completo"),
        )
        place = [ref[name].alias(name) for name in ("pos", "dueno", "niveles", "solo")]
        return F.struct(*place, F.when(ref["solo"].isNull(), table).alias("tabla"))

    def split(ref: Column) -> Column:
        place = [ref[name].alias(name) for name in ("pos", "dueno", "niveles", "solo")]
        return F.struct(*place, F.when(ref["solo"].isNull(), name_parts(ref["cadena"])).alias("partes"))

    return formed.select("*", F.transform(F.transform("forma.refs", split), named).alias("nombres"))


def _with_meaning(structured: DataFrame) -> DataFrame:
    """Adds to every name the CTE it means."""
    resolved = F.transform("nombres", lambda n: n.withField("hacia", meant(n, F.col("forma.ctes"))))
    return structured.withColumn("nombres", resolved)


def _tables(names: Column) -> Column:
    """Schema-qualified tables among found names, each once in order of first use."""
    return F.array_distinct(F.transform(F.filter(names, lambda n: n["tabla"].isNotNull()), lambda n: n["tabla"]))


def source_references(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Schema-qualified source tables per query, numbered by first use."""
    found = _structured(clean_queries(corpus, key, text), key, "sql_limpio")
    numbered = found.select(key, F.posexplode(_tables(F.col("nombres"))).alias("pos", "ref"))
    return numbered.select(key, (F.col("pos") + 1).alias("posicion"), "ref.*")


def classify_sources(references: DataFrame, formats: Mapping[str, str] | DataFrame) -> DataFrame:
    """Add table format and catalog by full name.

    ``formats`` is a mapping kept in the job's configuration, looked up inside the row, or a table
    (``nombre_completo, formato``, one row per name), joined as Spark sees fit.
    """
    if isinstance(formats, DataFrame):
        looked_up = references.join(formats, "nombre_completo", "left")
    elif formats:
        entries = F.create_map(*[F.lit(x) for pair in formats.items() for x in pair])
        looked_up = references.withColumn("formato", F.try_element_at(entries, F.col("nombre_completo")))
    else:
        looked_up = references.withColumn("formato", F.lit(None).cast("string"))
    return looked_up.withColumns(
        {
            "catalogo_destino": F.when(F.col("formato").isNull(), UNLISTED_CATALOG).otherwise(LISTED_CATALOG),
            "formato": F.coalesce("formato", F.lit(UNKNOWN_FORMAT)),
        }
    )


def source_list(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Comma-joined full names of the sources of each query."""
    names = F.transform(_tables(F.col("nombres")), lambda r: r["nombre_completo"])
    return _structured(clean_queries(corpus, key, text), key, "sql_limpio").select(key, F.array_join(names, ",").alias("fuentes"))


def _with_literals(corpus: DataFrame, key: str, text: str) -> DataFrame:
    return clean_queries(corpus, key, text).withColumn("literales", date_literals(F.col("sql_limpio")))


def query_dates(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Valid date literals per query, numbered in text order."""
    found = clean_queries(corpus, key, text).select(
        key, F.posexplode(date_literals(F.col("sql_limpio"))).alias("pos", "d")
    )
    return found.select(key, (F.col("pos") + 1).alias("posicion"), "d.*")


def dominant_dates(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """The most frequent date of each query with dates, over both spellings."""
    # Exploding zero or one value drops the NULLs; a filter would be pushed down with a copy of the extraction.
    found = F.array_compact(F.array(dominant_date("literales")))
    return (
        _with_literals(corpus, key, text)
        .select(key, F.inline(found))
        .withColumnRenamed("fecha", "fecha_dominante")
    )


def parameterise(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Texts with the dominant date replaced by markers; texts without dates stay as they are."""
    found = _with_literals(corpus, key, text).withColumn("fecha_dominante", dominant_date("literales")["fecha"])
    marked = parameterised(F.col("sql_limpio"), F.col("literales"), F.col("fecha_dominante"))
    return found.select(key, "fecha_dominante", F.coalesce(marked, "sql_limpio").alias("sql_parametrizado"))


def _parts(with_names: bool = True) -> Column:
    """CTEs in order of their bodies, then the statement without its WITH clauses, each with the names found in it if they are asked for.

    An expression over a structured frame; it goes into a generator as it is, because a filter inferred from a generated column would
    be pushed down with a copy of the whole extraction.
    """
    cuts, text = F.col("forma.cortes"), F.col("texto")
    ends = F.concat(F.transform(cuts, lambda c: c["ini"]), F.array(F.char_length(text)))

    def outside(end: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(cuts, i - 1)["fin"])
        return F.trim(F.substring(text, start + 1, end - start))

    # A text without a WITH clause is its own rest.
    rest = F.when(F.size(cuts) == 0, text).otherwise(F.trim(F.array_join(F.transform(ends, outside), " ")))
    in_cuts = lambda n: F.exists(cuts, lambda c: (n["pos"] >= c["ini"]) & (n["pos"] < c["fin"]))

    def names(standing) -> list[Column]:
        return [F.filter("nombres", standing).alias("nombres")] if with_names else []

    def body(cte: Column) -> Column:
        return F.struct(
            cte["ini"].alias("ini"),
            cte["fin"].alias("fin"),
            cte["nombre"].alias("nombre"),
            F.lit(False).alias("es_final"),
            F.trim(F.substring(text, cte["ini"] + 1, cte["fin"] - cte["ini"])).alias("cuerpo"),
            cte["profundidad"].alias("profundidad"),
            *names(lambda n: (n["pos"] >= cte["ini"]) & (n["pos"] < cte["fin"])),
        )

    final = F.struct(
        F.lit(-1).alias("ini"),
        F.char_length(text).alias("fin"),
        F.lit(None).cast("string").alias("nombre"),
        F.lit(True).alias("es_final"),
        rest.alias("cuerpo"),
        F.lit(0).alias("profundidad"),
        *names(lambda n: ~in_cuts(n)),
    )
    return F.concat(F.transform(F.array_sort("forma.ctes"), body), F.array(final))


def _query_parts(cleaned: DataFrame, key: str, text: str) -> DataFrame:
    cut = cleaned.select(key, F.col(text).alias("texto"), cte_pieces(F.col(text)).alias("piezas"))
    formed = cut.select(key, "texto", cte_structure("piezas").alias("forma"))
    rows = formed.select(key, F.col("forma.valido").alias("valido"), F.posexplode(_parts(with_names=False)).alias("pos", "parte"))
    return rows.select(key, (F.col("pos") + 1).alias("posicion"), "parte.nombre", "parte.es_final", "parte.cuerpo", "parte.profundidad", "valido")


def query_ctes(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Every CTE in order of its body, wherever it stands, and after them the statement left without its own WITH clauses (``es_final``).

    ``profundidad`` counts the brackets around a CTE. ``valido`` is false for texts whose brackets or quotes do not match; CTEs
    that never close are left in the final part.
    """
    return _query_parts(clean_queries(corpus, key, text), key, "sql_limpio")


def lineage(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Source tables written in each CTE, nested ones included, and in the final part."""
    rows = _structured(clean_queries(corpus, key, text), key, "sql_limpio").select(key, F.posexplode(_parts()).alias("pos", "parte"))
    found = rows.select(key, (F.col("pos") + 1).alias("cte_posicion"), "parte.nombre", F.posexplode(_tables(F.col("parte.nombres"))).alias("i", "ref"))
    return found.select(key, "cte_posicion", "nombre", (F.col("i") + 1).alias("posicion"), "ref.nombre_completo")


def cte_edges(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Which part reads which CTE: a name means the innermost CTE visible where it stands.

    ``desde`` is the innermost part the name stands in (null: the final part). A recursive CTE has an edge to itself.
    """
    found = _with_meaning(_structured(clean_queries(corpus, key, text), key, "sql_limpio"))
    parts = found.select(key, "nombres", _parts().alias("partes"))
    place = lambda ini: F.array_position(F.transform("partes", lambda p: p["ini"]), ini).cast("int")
    name = lambda at: F.element_at("partes", at)["nombre"]
    pairs = F.transform(
        F.filter("nombres", lambda n: n["hacia"].isNotNull()),
        lambda n: F.struct(place(n["dueno"]).alias("desde_posicion"), place(n["hacia"]).alias("hacia_posicion")),
    )
    named = F.transform(
        F.array_distinct(pairs),
        lambda e: F.struct(
            e["desde_posicion"].alias("desde_posicion"),
            name(e["desde_posicion"]).alias("desde"),
            e["hacia_posicion"].alias("hacia_posicion"),
            name(e["hacia_posicion"]).alias("hacia"),
        ),
    )
    return parts.select(key, F.inline(named))


def resolved_lineage(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Base tables of each CTE and of the final part, also those reached through the CTEs it reads.

    A CTE reads only CTEs that close before it does, so one fold in that order closes all edges inside the row.
    """
    found = _with_meaning(_structured(clean_queries(corpus, key, text), key, "sql_limpio"))
    parts = found.select(key, "nombres", _parts().alias("partes"))
    closing = F.concat(F.array_sort(F.filter("partes", lambda p: ~p["es_final"]), lambda a, b: a["fin"] - b["fin"]), F.filter("partes", lambda p: p["es_final"]))
    nothing = F.expr("CAST(array() AS array<struct<ini int, tablas array<string>>>)")

    def with_part(known: Column, part: Column) -> Column:
        direct = F.transform(F.filter(part["nombres"], lambda n: n["tabla"].isNotNull()), lambda n: n["tabla"]["nombre_completo"])
        reached = F.transform(part["nombres"], lambda n: n["hacia"])
        through = F.flatten(F.transform(F.filter(known, lambda k: F.array_contains(reached, k["ini"])), lambda k: k["tablas"]))
        tables = F.array_sort(F.array_distinct(F.concat(direct, through)))
        return F.concat(known, F.array(F.struct(part["ini"].alias("ini"), tables.alias("tablas"))))

    closed = parts.select(key, "partes", F.aggregate(closing, nothing, with_part).alias("tablas"))
    own = lambda part: F.element_at(F.filter("tablas", lambda t: t["ini"] == part["ini"]), 1)["tablas"]
    with_tables = F.transform("partes", lambda p: F.struct(p["nombre"].alias("nombre"), own(p).alias("tablas")))
    rows = closed.select(key, F.posexplode(with_tables).alias("pos", "parte"))
    return rows.select(key, (F.col("pos") + 1).alias("cte_posicion"), "parte.nombre", F.explode(F.array_compact("parte.tablas")).alias("nombre_completo"))


def cte_parameters(corpus: DataFrame, key: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Which of the two date markers each CTE of the parameterised text needs."""
    parts = _query_parts(parameterise(corpus, key, text), key, "sql_parametrizado")
    return parts.select(
        key,
        "posicion",
        "nombre",
        F.col("cuerpo").contains(ISO_MARKER).alias("usa_fecha_corte_iso"),
        F.col("cuerpo").contains(COMPACT_MARKER).alias("usa_fecha_corte"),
    )
