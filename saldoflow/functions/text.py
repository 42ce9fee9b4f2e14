"""Text extraction from SQL statements as column expressions.

Everything works inside one row, so the corpus jobs built on it never shuffle texts. Patterns use possessive
repeats: they scan literals of any length without backtracking or recursion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.
LINE_COMMENT = r"--[^\n]*+"
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
# The first class only lets letters, digits and signs fail early.
_BLANK = r"[\x09-\x20\x85-\u3000&&[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
# Runs of blanks that are not one space already.
BLANKS = rf"(?:(?! ){_BLANK}| (?={_BLANK})){_BLANK}*+"
STRING_LITERAL = r"'[^']*+(?:''[^']*+)*+'"
QUOTED_NAME = r'"[^"]*+(?:""[^"]*+)*+"'
_WORD = r"[\p{L}\p{N}_.$]"
# What is ahead is looked at first, so most places fail at one sign.
_DATE_CANDIDATE = rf"(?=['\"\d])(?:{STRING_LITERAL}|{QUOTED_NAME}|\d{{8}}(?<!{_WORD}\d{{8}})(?!{_WORD}))"
_DATE_SPELLING = rf"(?=['\d])(?:'\d{{4}}-\d{{2}}-\d{{2}}'|(?:\d{{4}}-\d{{2}}-\d{{2}}(?<!{_WORD}.{{10}})|\d{{8}}(?<!{_WORD}.{{8}}))(?!{_WORD}))"
_DATE_TOKEN = r"^(?:'(?:\d{4}-\d{2}-\d{2}|\d{8})'|\d{8})$"
# Markers put in the place of the dominant date.
ISO_MARKER = "{fecha_corte_iso}"
COMPACT_MARKER = "{fecha_corte}"


def clean_sql(sql: Column) -> Column:
    """The text without comments, with runs of blanks as one space. ``--`` inside a literal counts as a comment."""
    bare = F.regexp_replace(F.regexp_replace(sql, LINE_COMMENT, ""), BLOCK_COMMENT, "")
    return F.trim(F.regexp_replace(bare, BLANKS, " "))


def date_literals(clean: Column) -> Column:
    """Date literals in text order: ``array<struct<literal, fecha>>``.

    A literal is a whole string ``'YYYY-MM-DD'`` or ``'YYYYMMDD'`` or a bare eight-digit number; dates inside
    longer strings, quoted names or identifiers do not count, and neither do impossible dates.
    """
    tokens = F.filter(
        F.regexp_extract_all(clean, F.lit(_DATE_CANDIDATE), F.lit(0)), lambda t: t.rlike(_DATE_TOKEN)
    )

    def dated(token: Column) -> Column:
        text = F.replace(token, F.lit("'"), F.lit(""))
        digits = F.replace(text, F.lit("-"), F.lit(""))
        iso = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
        day = F.when(~iso.startswith("0000"), iso.try_cast("date"))
        return F.struct(text.alias("literal"), day.alias("fecha"))

    return F.filter(F.transform(tokens, dated), lambda d: d["fecha"].isNotNull())


def dominant_date(literals: str) -> Column:
    """Most frequent date of a ``date_literals`` column, ties to the first seen.

    ``struct<fecha, veces, primera>``; NULL without dates. Sorting the row's dates and counting runs keeps
    the work near-linear for texts with very many literals.
    """
    return F.expr(
        f"""
        IF(size({literals}) = 0, NULL, aggregate(
          array_sort(transform({literals}, (d, i) -> named_struct('fecha', d.fecha, 'pos', i + 1))),
          named_struct('run', named_struct('fecha', CAST(NULL AS DATE), 'veces', 0, 'primera', 0),
                       'best', named_struct('fecha', CAST(NULL AS DATE), 'veces', 0, 'primera', 0)),
          (acc, d) -> named_struct(
            'run', IF(acc.run.fecha <=> d.fecha,
                      named_struct('fecha', d.fecha, 'veces', acc.run.veces + 1, 'primera', acc.run.primera),
                      named_struct('fecha', d.fecha, 'veces', 1, 'primera', d.pos)),
            'best', IF(acc.run.veces > acc.best.veces
                       OR (acc.run.veces = acc.best.veces AND acc.run.primera < acc.best.primera),
                       acc.run, acc.best)),
          acc -> IF(acc.run.veces > acc.best.veces
                    OR (acc.run.veces = acc.best.veces AND acc.run.primera < acc.best.primera),
                    acc.run, acc.best)
        ))
        """
    )


def parameterised(clean: Column, literals: Column, date: Column) -> Column:
    """The text with the spellings of ``date`` that occur as literals replaced by markers.

    ISO spellings, quoted or bare, become ``ISO_MARKER``; the compact spelling becomes ``COMPACT_MARKER``. Only
    whole tokens are replaced, as ``date_literals`` takes them: longer numbers, names that contain the digits and quoted names stay.
    All dates are found by one fixed pattern and compared with the row's own, so no pattern is made for a row.
    """
    iso, compact = F.date_format(date, "yyyy-MM-dd"), F.date_format(date, "yyyyMMdd")
    # Spark evaluates what a step of ``transform`` names anew for each element, so the spellings are made once for a row and bound by a name.
    spelt = F.array(F.struct(iso.alias("iso"), F.concat(F.lit("'"), iso, F.lit("'")).alias("quoted"), compact.alias("compact")))

    def here(s: Column) -> Column:
        kinds = [F.when(F.exists(literals, lambda d: d["literal"] == s[kind]), s[name]).alias(name) for name, kind in (("iso", "iso"), ("quoted", "iso"), ("compact", "compact"))]
        return F.struct(*kinds)

    def woven(text: Column, pattern: str, change) -> Column:
        """The text with every hit of a pattern changed. A clean text holds no tabs and line feeds, so they can mark the hits."""

        def piece(part: Column, i: Column) -> Column:
            hit = F.substring_index(part, "\t", 1)
            return F.when(i == 0, part).otherwise(F.concat(change(hit), F.substring_index(part, "\t", -1)))

        return F.array_join(F.transform(F.split(F.regexp_replace(text, F.lit(pattern), F.lit("\n$0\t")), "\n", -1), piece), "")

    def written(s: Column) -> Column:
        def marker(hit: Column) -> Column:
            is_iso = (hit == s["iso"]) | (hit == s["quoted"])
            return F.when(is_iso, ISO_MARKER).when(hit == s["compact"], COMPACT_MARKER).otherwise(hit)

        # Only a text with a double quote can hold a quoted name; there literals, which may hold a quote too, are stepped over one by one.
        stepped = woven(
            clean,
            rf"{STRING_LITERAL}|{QUOTED_NAME}|{_DATE_SPELLING}",
            lambda hit: F.when(hit.startswith('"'), hit).otherwise(woven(hit, _DATE_SPELLING, marker)),
        )
        return F.when(clean.contains('"'), stepped).otherwise(woven(clean, _DATE_SPELLING, marker))

    # Without a date nothing changes.
    return F.when(date.isNull(), clean).otherwise(F.transform(F.transform(spelt, here), written)[0])
