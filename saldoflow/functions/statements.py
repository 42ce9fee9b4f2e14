"""The structure of a SQL statement: its CTEs with their nesting, and its tables with the scope they stand in.

A text becomes an array of pieces, each ending in one sign or word that matters: a bracket, a comma, the head of a CTE, or a keyword that
begins or ends a list of tables. Literals, quoted names and all other words lie inside the pieces. One fold over the pieces keeps the open
brackets as a stack; nothing is recursive, so depth and length are not limited, and the work stays inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from saldoflow.functions.text import QUOTED_NAME, STRING_LITERAL

# Found tables are gathered in runs of this length, so adding one does not copy all of them.
_RUN = 256

BACKQUOTED = r"`[^`]*+(?:``[^`]*+)*+`"
_LETTER = r"[\p{L}\p{N}_$.@#]"
_NAME = rf"(?:[\p{{L}}\p{{N}}_$@#]++|{QUOTED_NAME}|{BACKQUOTED})"
_COLUMNS = rf"(?: ?\((?:[^()'\"`]++|{QUOTED_NAME}|{BACKQUOTED})*+\))?"
_AS = r"(?: |(?<=[)\"`]))AS ?(?:(?:NOT )?MATERIALIZED ?)?\("
_WITH_HEAD = rf"WITH (?:RECURSIVE )?{_NAME}{_COLUMNS}{_AS}"
_NEXT_HEAD = rf", ?{_NAME}{_COLUMNS}{_AS}"
# Fixed words: what begins a list of tables, what names one target, what ends a list, calls with FROM inside.
_LISTS, _TARGETS = "FROM|JOIN", "INTO|UPDATE|TABLE|VIEW"
_ENDS = "WHERE|GROUP|ORDER|HAVING|LIMIT|UNION|EXCEPT|INTERSECT|MINUS|WINDOW|SET|WHEN|QUALIFY|FETCH|OFFSET|VALUES|RETURNING"
_CALLS = "EXTRACT|TRIM|SUBSTRING|OVERLAY"
_SKIPPED = "DISTINCT FROM|LATERAL VIEW(?: OUTER)?|KEY UPDATE"
_NO_TABLE = rf"(?!(?:SELECT|WITH|FROM|AS|ON|SET|{_ENDS})(?!{_LETTER}))"
_CHAIN = rf"{_NO_TABLE}{_NAME}(?: ?\. ?{_NAME})*+"
_BEFORE = r"(?:(?:LATERAL|ONLY|TABLE) )?"
_EXISTS = r"(?:IF (?:NOT )?EXISTS )?"
# A name before a bracket is a call, except for targets, where the bracket holds columns.
_SOURCE = rf"{_BEFORE}{_CHAIN}(?! ?\()"
_WORDS = (
    rf"(?:(?:{_SKIPPED}|SELECT|WITH|{_ENDS})(?!{_LETTER})|(?:{_CALLS}) ?\("
    rf"|(?:{_LISTS}|USING)(?!{_LETTER})(?: ?{_SOURCE})?|(?:{_TARGETS})(?!{_LETTER})(?: {_EXISTS}{_CHAIN})?)"
)
_WORD_HERE = rf"(?:(?:{_LISTS}|USING|{_TARGETS}|SELECT|WITH|{_ENDS}|{_SKIPPED})(?!{_LETTER})|(?:{_CALLS}) ?\()"
_GAP = rf"(?:[^()'\"`,;\p{{L}}\p{{N}}_$.@#]++|(?!{_WORD_HERE}){_LETTER}++|{STRING_LITERAL}|{QUOTED_NAME}|{BACKQUOTED})*+"
_PIECE = rf"(?i)({_GAP})({_WITH_HEAD}|{_NEXT_HEAD}|{_WORDS}|, ?(?:{_SOURCE})?|\( ?(?:{_SOURCE})?|[);'\"`]|\z)"
# For the CTEs alone only their heads, brackets and stray quotes end a piece. What else ``_PIECE`` finds is stepped over in the same order.
_OTHER = (
    rf"(?:(?:{_SKIPPED}|SELECT|{_ENDS})(?!{_LETTER})|(?!{_WITH_HEAD})WITH(?!{_LETTER})"
    rf"|(?:{_LISTS}|USING)(?!{_LETTER})(?: ?{_SOURCE})?|(?:{_TARGETS})(?!{_LETTER})(?: {_EXISTS}{_CHAIN})?"
    rf"|(?!{_NEXT_HEAD}), ?(?:{_SOURCE})?|;)"
)
_FIRST_LETTERS = "".join(sorted({word[0] for words in (_LISTS, _TARGETS, _ENDS, _CALLS, _SKIPPED, "USING|SELECT|WITH") for word in words.split("|")}))
_ITEM = rf"[^()'\"`,;\p{{L}}\p{{N}}_$.@#]++|(?!(?=[{_FIRST_LETTERS}]){_WORD_HERE}){_LETTER}++|{STRING_LITERAL}|{QUOTED_NAME}|{BACKQUOTED}"
_CTE_PIECE = rf"(?i)((?:{_ITEM}|{_OTHER})*+)({_WITH_HEAD}|{_NEXT_HEAD}|(?:{_CALLS}) ?\(|\( ?(?:{_SOURCE})?|[)'\"`]|\z)"
_HEAD_NAME = rf"(?i)^(?:WITH (?:RECURSIVE )?|, ?)({_NAME})"
_TABLE = rf"(?i)^(?:(?:{_LISTS}|USING|{_TARGETS})(?: {_EXISTS})?|[,(]) ?{_BEFORE}({_CHAIN})"


# Kinds of pieces, kinds of levels (P: plain) and modes of levels as numbers.
_CODES = {name: code for code, name in enumerate(("C", "W", "L", "U", "T", "S", "N", "X", "P", "(", ")", ",", "!", "-", "NONE", "TABLE", "BEHIND"))}


# The kinds of words; of all others that end a piece, those below stand alone, and the rest is N.
_KINDS = {word: kind for kind, words in (("L", _LISTS), ("S", "SELECT"), ("U", "USING"), ("T", _TARGETS), ("X", _CALLS), ("-", "DISTINCT|LATERAL|KEY"), ("N", _ENDS)) for word in words.split("|")}


def _kind(sign: Column) -> Column:
    """What a piece ends in, as a code: C and W heads of CTEs, L U T lists and targets, S N X words, or the sign itself."""
    first, word = F.left(sign, F.lit(1)), F.upper(F.substring_index(F.substring_index(sign, " ", 1), "(", 1))
    head = sign.endswith("(")
    code = lambda name: F.lit(_CODES[name])
    known = F.create_map(*[x for word, kind in _KINDS.items() for x in (F.lit(word), code(kind))])
    return (
        F.when(first == ",", F.when(head, code("C")).otherwise(code(",")))
        .when(first == "(", code("("))
        .when(first == ")", code(")"))
        .otherwise(
            F.coalesce(
                F.try_element_at(known, word),
                F.when(first == "", code("-"))
                .when(first == ";", code("N"))
                .when(first.isin("'", '"', "`"), code("!"))
                .when(word == "WITH", F.when(head, code("W")).otherwise(code("-")))
                .when(word.startswith("FROM") | word.startswith("JOIN"), code("L"))  # a quoted name may follow without a blank
                .when(word.startswith("USING"), code("U"))
                .otherwise(code("N")),
            )
        )
    )


def _bare(name: Column) -> Column:
    """A name without its quotes."""
    first = F.left(name, F.lit(1))
    inner = F.substring(name, F.lit(2), F.char_length(name) - 2)
    return F.when(first == '"', F.replace(inner, F.lit('""'), F.lit('"'))).when(first == "`", F.replace(inner, F.lit("``"), F.lit("`"))).otherwise(name)


def pieces(clean: Column) -> Column:
    """The pieces of a text: sign ``s`` and its kind ``k``, length ``n``, length before the sign ``g``, whether only blanks stand
    there (``b``), and whether the sign goes on with a table (``t``). A clean text holds no tabs and line feeds, so they can mark the cuts."""
    marked = F.split(F.regexp_replace(clean, F.lit(_PIECE), F.lit("$1\t$2\n")), "\n", -1)

    def cut(piece: Column) -> Column:
        sign = F.substring_index(piece, "\t", -1)
        return F.struct(piece.alias("p"), sign.alias("s"), F.greatest(F.char_length(piece) - 1, F.lit(0)).alias("n"), _kind(sign).alias("k"))

    def with_table(p: Column) -> Column:
        bare = F.when(p["k"].isin(_CODES[","], _CODES["("]), 1).when(p["k"] == _CODES["L"], 4).when(p["k"] == _CODES["U"], 5).when(p["k"] == _CODES["T"], F.char_length(F.substring_index(p["s"], " ", 1)))
        blank = p["p"].startswith("\t") | p["p"].startswith(" \t")
        return F.struct(p["s"], p["n"], (p["n"] - F.char_length(p["s"])).alias("g"), blank.alias("b"), p["k"], (F.char_length(F.rtrim(p["s"])) > bare).alias("t"))

    return F.transform(F.transform(marked, cut), with_table)


def name_parts(chain: Column) -> Column:
    """The names of a dotted chain, without their quotes."""
    return F.transform(F.regexp_extract_all(chain, F.lit(f"({_NAME})"), F.lit(1)), _bare)


_LEVEL = "struct<k int, m int, cabeza string, ini int, dueno int, r boolean>"
_CTE = "struct<ini int, fin int, cabeza string, profundidad int, nivel int, dueno int, r boolean>"
_REF = "struct<pos int, cabeza string, dueno int, niveles array<int>>"


def _empty(kind: str) -> str:
    return f"CAST(array() AS array<{kind}>)"


def _fold(pieces_column: str) -> str:
    """One pass over the pieces, with the open brackets as a stack.

    The state holds the level inside the innermost bracket (``a``), the levels around it (``pila``), whether a CTE has just closed (``tras``), and
    what was found (``f``). A level's mode ``m`` is TABLE where a table is expected, BEHIND behind one, NONE elsewhere. Names stay
    inside their signs until the end. Spark evaluates a step as it stands, so each kind of piece computes only what it changes.
    """
    at = "(s.pos + p.n)"
    empty = "size(s.pila) = 0"

    def level(k: str = "s.a.k", m: str = "s.a.m", head: str = "s.a.cabeza", start: str = "s.a.ini", owner: str = "s.a.dueno", rec: str = "s.a.r") -> str:
        return f"named_struct('k', {k}, 'm', {m}, 'cabeza', {head}, 'ini', {start}, 'dueno', {owner}, 'r', {rec})"

    def state(a: str = "s.a", pila: str = "s.pila", tras: str = "false", r: str = "s.r", f: str = "s.f") -> str:
        return f"named_struct('pos', {at}, 'a', {a}, 'pila', {pila}, 'tras', {tras}, 'r', {r}, 'f', {f})"

    def found(ctes: str = "s.f.ctes", refs: str = "s.f.refs", cola: str = "s.f.cola", cortes: str = "s.f.cortes", valido: str = "s.f.valido") -> str:
        return f"named_struct('ctes', {ctes}, 'refs', {refs}, 'cola', {cola}, 'cortes', {cortes}, 'valido', {valido})"

    ref = "named_struct('pos', s.pos + p.g, 'cabeza', p.s, 'dueno', s.a.dueno, 'niveles', concat(transform(s.pila, l -> l.ini), array(s.a.ini)))"
    taken = found(
        refs=f"IF(size(s.f.cola) >= {_RUN}, concat(s.f.refs, array(s.f.cola)), s.f.refs)",
        cola=f"concat(IF(size(s.f.cola) >= {_RUN}, {_empty(_REF)}, s.f.cola), array({ref}))",
    )
    # Where a list begins or goes on, its next table stands in the sign or is expected behind it.
    listed = f"IF(p.t, {state(level(m=repr('BEHIND')), f=taken)}, {state(level(m=repr('TABLE')))})"
    nothing = f"IF(s.a.m = 'NONE', {state()}, {state(level(m=repr('NONE')))})"
    around = "element_at(s.pila, -1)"
    cte = f"""named_struct('ini', s.a.ini, 'fin', {at} - 1, 'cabeza', s.a.cabeza, 'profundidad', size(s.pila) - 1, 'nivel', {around}.ini,
                           'dueno', {around}.dueno, 'r', s.a.r)"""
    # A clause grows to the end of each CTE, and over the comma before the next head.
    grown = lambda to: f"concat(slice(s.f.cortes, 1, size(s.f.cortes) - 1), array(named_struct('ini', element_at(s.f.cortes, -1).ini, 'fin', {to})))"
    shorter = "slice(s.pila, 1, size(s.pila) - 1)"
    closed_cte = found(ctes=f"concat(s.f.ctes, array({cte}))", cortes=f"IF(size(s.pila) = 1, {grown(at)}, s.f.cortes)")
    closing = f"""CASE WHEN {empty} THEN {state(f=found(valido="false"))} WHEN s.a.k = 'C' THEN {state(around, shorter, "true", "s.a.r", closed_cte)}
                       ELSE {state(around, shorter)} END"""
    # A bracket that stands directly where a table is expected opens a subquery or a bracketed join; what was expected is then behind it.
    pushed = lambda outer: f"concat(s.pila, array({outer}))"
    plain = lambda k, m: level(k, m, "CAST(NULL AS STRING)", at, "s.a.dueno", "false")
    behind = pushed(level(m="'BEHIND'"))
    opening = f"""CASE WHEN s.a.m <> 'TABLE' THEN {state(plain("'P'", "'NONE'"), pushed("s.a"))}
                       WHEN NOT p.b THEN {state(plain("'P'", "'NONE'"), behind)}
                       WHEN p.t THEN {state(plain("'P'", "'BEHIND'"), behind, f=taken)}
                       ELSE {state(plain("'P'", "'TABLE'"), behind)} END"""
    # A list of CTEs is recursive as a whole; the flag of its first head goes on to the next ones.
    body = lambda rec: level("'C'", "'NONE'", "p.s", at, at, rec)
    recursive = "(upper(left(p.s, 15)) = 'WITH RECURSIVE ')"
    first_cut = found(cortes="concat(s.f.cortes, array(named_struct('ini', s.pos + p.g, 'fin', s.pos + p.g)))")
    step = f"""CASE
        WHEN p.k = ',' THEN IF(s.a.m = 'BEHIND', {listed}, {state()})
        WHEN p.k = ')' THEN {closing}
        WHEN p.k = '(' THEN {opening}
        WHEN p.k = 'N' THEN {nothing}
        WHEN p.k = 'S' THEN IF(s.a.k = 'X', {state(level("'P'", "'NONE'"))}, {nothing})
        WHEN p.k = 'L' THEN IF(s.a.k = 'X', {state()}, {listed})
        WHEN p.k = 'X' THEN {state(plain("'X'", "'NONE'"), pushed(level(m="IF(s.a.m = 'TABLE', 'BEHIND', s.a.m)")))}
        WHEN p.k = 'W' THEN {state(body(recursive), pushed("s.a"), r=recursive, f=f"IF({empty}, {first_cut}, s.f)")}
        WHEN p.k = 'C' THEN IF(s.tras AND p.b, {state(body("s.r"), pushed("s.a"), f=f"IF({empty}, {found(cortes=grown('s.pos + p.g + 1'))}, s.f)")},
                                               {state(plain("'P'", "'NONE'"), pushed("s.a"))})
        WHEN p.k = 'U' THEN {state(level(m="'BEHIND'"), f=f"IF(p.t, {taken}, s.f)")}
        WHEN p.k = 'T' THEN {state(level(m="'NONE'"), f=f"IF(p.t, {taken}, s.f)")}
        WHEN p.k = '!' THEN {state(f=found(valido="false"))}
        ELSE {state()} END"""
    nothing_found = f"""named_struct('ctes', {_empty(_CTE)}, 'refs', {_empty(f'array<{_REF}>')}, 'cola', {_empty(_REF)},
                                     'cortes', {_empty('struct<ini int, fin int>')}, 'valido', true)"""
    start = f"""named_struct('pos', 0, 'a', {level("'P'", "'NONE'", "CAST(NULL AS STRING)", "0", "-1", "false")}, 'pila', {_empty(_LEVEL)},
                             'tras', false, 'r', false, 'f', {nothing_found})"""
    last = "named_struct('ctes', s.f.ctes, 'refs', concat(flatten(s.f.refs), s.f.cola), 'cortes', s.f.cortes, 'valido', s.f.valido AND size(s.pila) = 0)"
    fold = f"aggregate({pieces_column}, {start}, (s, p) -> {step}, s -> {last})"
    for name, code in _CODES.items():  # numbers are compared faster than letters
        fold = fold.replace(f"'{name}'", str(code))
    return fold


def structure(pieces_column: str) -> Column:
    """``struct<ctes, refs, cortes, valido>`` of a column of ``pieces``; offsets count characters from 0.

    ``ctes`` in the order in which they close: body from ``ini`` to ``fin``, brackets around it (``profundidad``), and the CTE
    it stands in (``dueno``, -1: the statement). ``refs``: every table name (``cadena``; ``solo`` if it has no schema), the CTE it stands in and the
    brackets open there. ``cortes``: the WITH clauses outside all brackets. ``valido`` is false if brackets or quotes do not match.
    """

    def cte(c: Column) -> Column:
        kept = [c[name].alias(name) for name in ("ini", "fin", "profundidad", "nivel", "dueno", "r")]
        return F.struct(*kept, _bare(F.regexp_extract(c["cabeza"], _HEAD_NAME, 1)).alias("nombre"))

    def chain(ref: Column) -> Column:
        return F.struct(ref["pos"].alias("pos"), ref["dueno"].alias("dueno"), ref["niveles"].alias("niveles"), F.regexp_extract(ref["cabeza"], _TABLE, 1).alias("cadena"))

    def single(ref: Column) -> Column:
        # No name without a schema holds a dot outside quotes.
        alone = F.when(~ref["cadena"].contains(".") | ref["cadena"].rlike(rf"^{_NAME}$"), _bare(ref["cadena"]))
        return F.struct(ref["pos"].alias("pos"), ref["dueno"].alias("dueno"), ref["niveles"].alias("niveles"), ref["cadena"].alias("cadena"), alone.alias("solo"))

    found = F.expr(_fold(pieces_column))
    named = lambda s: F.struct(F.transform(s["ctes"], cte).alias("ctes"), F.transform(F.transform(s["refs"], chain), single).alias("refs"), s["cortes"].alias("cortes"), s["valido"].alias("valido"))
    return F.transform(F.array(found), named)[0]


def cte_pieces(clean: Column) -> Column:
    """Like ``pieces``, cut only where a CTE or a bracket begins or ends, and at stray quotes; ``k`` is W, C, a bracket, ! or -."""
    marked = F.split(F.regexp_replace(clean, F.lit(_CTE_PIECE), F.lit("$1\t$2\n")), "\n", -1)

    def cut(piece: Column) -> Column:
        blank = piece.startswith("\t") | piece.startswith(" \t")
        return F.struct(F.substring_index(piece, "\t", -1).alias("s"), F.greatest(F.char_length(piece) - 1, F.lit(0)).alias("n"), blank.alias("b"))

    def with_kind(p: Column) -> Column:
        first = F.left(p["s"], F.lit(1))
        code = lambda name: F.lit(_CODES[name])
        kind = F.when(first == ")", code(")")).when(first == "(", code("(")).when(first == ",", code("C")).when(first == "", code("-")).when(first.isin("W", "w"), code("W"))
        return F.struct(p["s"], p["n"], p["b"], kind.when(first.isin("'", '"', "`"), code("!")).otherwise(code("(")).alias("k"))  # else a call

    return F.transform(F.transform(marked, cut), with_kind)


def cte_structure(pieces_column: str) -> Column:
    """``struct<ctes, cortes, valido>`` of a column of ``cte_pieces``: what ``structure`` says of them; of a CTE its name, place and depth.

    A level of the stack is the start of a CTE's body with its head, or null for another bracket.
    """
    at, start, empty = "(s.pos + p.n)", "(s.pos + p.n - char_length(p.s))", "size(s.pila) = 0"

    def state(pila: str = "s.pila", tras: str = "false", ctes: str = "s.ctes", cortes: str = "s.cortes", valido: str = "s.valido") -> str:
        return f"named_struct('pos', {at}, 'pila', {pila}, 'tras', {tras}, 'ctes', {ctes}, 'cortes', {cortes}, 'valido', {valido})"

    grown = lambda to: f"concat(slice(s.cortes, 1, size(s.cortes) - 1), array(named_struct('ini', element_at(s.cortes, -1).ini, 'fin', {to})))"
    level = "struct<ini int, cabeza string>"
    pushed = lambda what: f"concat(s.pila, array({what}))"
    shorter, inner = "slice(s.pila, 1, size(s.pila) - 1)", "element_at(s.pila, -1)"
    plain, body = pushed(f"CAST(NULL AS {level})"), pushed(f"named_struct('ini', {at}, 'cabeza', p.s)")
    cte = f"named_struct('ini', {inner}.ini, 'fin', {at} - 1, 'cabeza', {inner}.cabeza, 'profundidad', size(s.pila) - 1)"
    closed = state(shorter, "true", f"concat(s.ctes, array({cte}))", f"IF(size(s.pila) = 1, {grown(at)}, s.cortes)")
    step = f"""CASE
        WHEN p.k = '(' THEN {state(plain)}
        WHEN p.k = ')' THEN CASE WHEN {empty} THEN {state(valido="false")} WHEN {inner} IS NULL THEN {state(shorter)} ELSE {closed} END
        WHEN p.k = 'W' THEN {state(body, cortes=f"IF({empty}, concat(s.cortes, array(named_struct('ini', {start}, 'fin', {start}))), s.cortes)")}
        WHEN p.k = 'C' THEN IF(s.tras AND p.b, {state(body, cortes=f"IF({empty}, {grown(start + ' + 1')}, s.cortes)")}, {state(plain)})
        WHEN p.k = '!' THEN {state(valido="false")}
        ELSE {state()} END"""
    nothing = f"""named_struct('pos', 0, 'pila', {_empty(level)}, 'tras', false, 'ctes', {_empty('struct<ini int, fin int, cabeza string, profundidad int>')},
                               'cortes', {_empty('struct<ini int, fin int>')}, 'valido', true)"""
    fold = f"aggregate({pieces_column}, {nothing}, (s, p) -> {step}, s -> named_struct('ctes', s.ctes, 'cortes', s.cortes, 'valido', s.valido AND size(s.pila) = 0))"
    for name in "()WC!":
        fold = fold.replace(f"p.k = '{name}'", f"p.k = {_CODES[name]}")

    def named(c: Column) -> Column:
        return F.struct(c["ini"].alias("ini"), c["fin"].alias("fin"), c["profundidad"].alias("profundidad"), _bare(F.regexp_extract(c["cabeza"], _HEAD_NAME, 1)).alias("nombre"))

    kept = lambda s: F.struct(F.transform(s["ctes"], named).alias("ctes"), s["cortes"].alias("cortes"), s["valido"].alias("valido"))
    return F.transform(F.array(F.expr(fold)), kept)[0]


def meant(ref: Column, ctes: Column) -> Column:
    """The CTE (its ``ini``) that a name without a schema means: the innermost one visible there, which is the last that closed before it in
    an open bracket, or a recursive one that is still open; null for none."""
    same = lambda c: F.lower(c["nombre"]) == F.lower(ref["solo"])
    still_open = F.filter(ctes, lambda c: c["r"] & same(c) & (c["fin"] > ref["pos"]) & F.array_contains(ref["niveles"], c["ini"]))
    closed = F.filter(ctes, lambda c: same(c) & (c["fin"] <= ref["pos"]) & F.array_contains(ref["niveles"], c["nivel"]))
    return F.when(ref["solo"].isNotNull(), F.coalesce(F.get(still_open, F.lit(0))["ini"], F.try_element_at(closed, F.lit(-1))["ini"]))
