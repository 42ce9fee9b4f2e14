"""Personal data in whole texts: high-recall candidates, judged by boosted trees that run as SQL expressions.

For each kind a base pattern with a check gives the spans that always count. A wider pattern for each kind proposes
further, possibly overlapping spans: e-mail addresses with a spelt-out at or dot, IPv6 addresses, card numbers with other
separators, telephone numbers without a plus. Candidates are judged by gradient-boosted trees over their format and context: kind, number of
digits, separators, shape, the signs on either side and a key word before.

The trees learn from the texts themselves: spans that pass their check are positive and matches that fail it negative; wider
candidates are labelled by weak rules of their kind (see ``_shape_of`` and ``_likely``), glued ones are negative. All
features have few values, so Spark sums the candidates of all rows to a table of at most a few thousand groups, and the driver
boosts on that. Each kind has a threshold, the least score at which the precision on its wider candidates, by those
labels, is ``PRECISION`` at least; a kind without a likely one accepts none. Trees become CASE expressions: no Python runs on rows.

Offsets count code points, ends are exclusive. A null or empty text has no spans. Null ids, repeated rows and
extra columns are kept; every row gives one row. The work for a text grows with its length and, by blocks, with
k * ``BLOCK`` for k matches.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
BLOCK = 256
ROUNDS, RATE, SMOOTHING = 30, 0.3, 1.0
CONTEXT = 24

# The base patterns. Possessive repeats and the condition on the sign before keep the matches of
# the plain forms and take linear time: inside a run of signs that may start a match, a later start cannot do better,
# and only the end of the last match (\G) may lie within a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDER = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:@|[\[({]\s?at\s?[\])}]|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|[\[({]\s?dot\s?[\])}]|\sdot\s)\s?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}",
    "card": r"[0-9]{4}[./_ -][0-9]{4}[./_ -][0-9]{4}[./_ -][0-9]{1,7}",
    "phone": r"(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3}[\x20./-][0-9]{4}",
}
GUARD = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KEY_WORDS = r"(?i)\b(?:e-?mail|mail|contact|ip|ipv6|host|address|addr|card|visa|credit|account|phone|tel|telephone|mobile|cell|call|fax)\b"
OCTET = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"


def _places(text: str, pattern: str) -> Column:
    """Array of ``(s, e, hit, before, after)`` for all leftmost matches: text between matches and matches add up to places."""
    literal = F.lit(pattern)
    pieces, hits = F.split(F.col(text), pattern, -1), F.regexp_extract_all(F.col(text), literal, F.lit(0))
    items = F.zip_with(
        F.slice(pieces, 1, F.size(hits)),
        F.zip_with(hits, F.slice(pieces, 2, F.size(hits)), lambda h, p: F.struct(h.alias("hit"), F.substring(p, 1, 1).alias("after"))),
        lambda p, h: F.struct(
            F.char_length(p).cast("long").alias("gap"),
            F.char_length(h["hit"]).cast("long").alias("len"),
            h["hit"].alias("hit"),
            F.substring(p, -CONTEXT, CONTEXT).alias("before"),
            h["after"].alias("after"),
        ),
    )
    return items


def _summed(items: Column) -> Column:
    """Gives each item its place; in blocks, so that appending does not copy the whole array each time."""
    none = "CAST(array() AS array<struct<s:bigint,e:bigint,hit:string,before:string,after:string>>)"
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)),
    )
    sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda a, x: a + x["gap"] + x["len"]))
    starts = F.aggregate(
        sizes,
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<bigint>)").alias("all")),
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")),
    )["all"]
    place = lambda a, x: F.struct(
        (a["at"] + x["gap"] + x["len"]).alias("at"),
        F.concat(
            a["all"],
            F.array(F.struct((a["at"] + x["gap"]).alias("s"), (a["at"] + x["gap"] + x["len"]).alias("e"), x["hit"].alias("hit"), x["before"].alias("before"), x["after"].alias("after"))),
        ).alias("all"),
    )
    placed = F.zip_with(blocks, starts, lambda block, at: F.aggregate(block, F.struct(at.alias("at"), F.expr(none).alias("all")), place)["all"])
    return F.when(F.size(items) > 0, F.flatten(placed)).otherwise(F.expr(none))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    digits = F.split(F.reverse(_digits(c)), "")
    each = F.transform(F.filter(digits, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda part: part.rlike(OCTET))
    if kind == "card":
        n = F.char_length(_digits(hit))
        return F.when(n.between(13, 19), _luhn(hit)).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _class(sign: Column) -> Column:
    """0 nothing, 1 letter or digit, 2 white space, 3 other."""
    return F.when(sign == "", 0).when(sign.rlike(r"[\p{L}\p{N}]"), 1).when(sign.rlike(r"\s"), 2).otherwise(3)


def _check(kind: str, passed: bool = True):
    return lambda x: _passes(kind, x["hit"]) if passed else ~_passes(kind, x["hit"])


FEATURES = ("kind", "shape", "digits", "length", "marks", "left", "right", "word")


def _shape_of(kind: str, hit: Column) -> Column:
    """3: has the form of its kind; 2: has it, but so have other things; 1: has not; 0: runs over the end of a sentence."""
    if kind == "email":
        plain = hit.rlike(r"^[^\s\[\](){}]+@[^\s\[\](){}]+$")
        domain = hit.rlike(r"(?i)[^a-z](?:com|org|net|edu|gov|mil|int|info|biz|name|io|co|ai|app|dev|eu|us|uk|de|fr|es|it|pt|nl|se|at|ch|be|dk|no|fi|pl|cz|ru|ua|tr|jp|cn|kr|in|au|nz|ca|br|mx|ar|example|test)$")
        bracket, spelled = hit.rlike(r"(?i)[\[({]\s?at\s?[\])}]"), hit.rlike(r"(?i)@|[\[({\s]dot[\])}\s]")
        broken = hit.rlike(r"\.\s|\s\.|[\r\n]")
        named = bracket & hit.rlike(r"[^A-Za-z][A-Za-z]{2,24}$")
        return F.when(plain, 3).when(broken, 0).when(named | domain & spelled, 3).when(domain, 2).otherwise(1)
    if kind == "ip":
        full = hit.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
        short = hit.rlike(r"^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*$") & (F.size(F.split(hit, ":+")) <= 7)
        four = hit.rlike(r"^[0-9]+\.") & _passes("ip", hit)
        return F.when(full | short | four, 3).otherwise(1)
    if kind == "card":
        return F.when(~_passes("card", hit), 1).when(hit.rlike("^[2-6]"), 3).otherwise(2)
    # A number may repeat one separator; the first may be a blank after brackets.
    alike = hit.rlike(r"^[0-9]+([\x20./-])[0-9]+\1[0-9]+$")
    return F.when(hit.startswith("+") | hit.startswith("("), 3).when(alike, 2).otherwise(1)


def _likely(row: tuple) -> bool:
    """The weak label of a wider candidate with these features."""
    of = dict(zip(FEATURES, row, strict=True))
    told = of["shape"] == 3 or of["shape"] == 2 and of["word"] == 1 and KINDS[of["kind"]] in ("email", "phone")
    return told and of["left"] != 1 and of["right"] != 1


def _features(kind: int, x: Column) -> list[Column]:
    hit = x["hit"]
    n = F.char_length(_digits(hit))
    return [
        F.lit(kind).alias("kind"),
        _shape_of(KINDS[kind], hit).alias("shape"),
        F.least(n, F.lit(20)).alias("digits"),
        F.least((F.char_length(hit) / 8).cast("int"), F.lit(5)).alias("length"),
        F.least(F.char_length(F.regexp_replace(hit, r"[\p{L}\p{N}]", "")), F.lit(6)).alias("marks"),
        _class(F.substring(x["before"], -1, 1)).alias("left"),
        _class(x["after"]).alias("right"),
        x["before"].rlike(KEY_WORDS).cast("int").alias("word"),
    ]


def _shape(kind: int):
    return lambda x: F.struct(*_features(kind, x))


def candidates(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``base_<kind>``: spans that count; ``failed``: features of the base matches that do not; ``wide``: wider spans with features."""
    names = docs.columns
    found = docs.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = found.withColumn("__digit", F.col("__t").rlike("[0-9]"))
    guards = {k: F.instr("__t", GUARD[k]) > 0 if GUARD[k] else F.lit(True) for k in KINDS}
    for k in KINDS:
        needed = guards[k] if k == "email" else guards[k] & F.col("__digit")
        found = found.withColumn(f"__b_{k}", F.when(needed, _places("__t", BASE[k])))
        needed = F.col("__t").rlike(r"(?i)@|\Wat\W") if k == "email" else (F.instr("__t", ":") > 0) if k == "ip" else F.col("__digit")
        found = found.withColumn(f"__w_{k}", F.when(needed, _places("__t", WIDER[k])))
    for k in KINDS:
        for side in "bw":
            c = F.col(f"__{side}_{k}")
            none = F.expr("CAST(array() AS array<struct<s:bigint,e:bigint,hit:string,before:string,after:string>>)")
            found = found.withColumn(f"__p{side}_{k}", F.when(c.isNotNull() & (F.size(c) > 0), _summed(c)).otherwise(none))
    span = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    good = {k: F.filter(f"__pb_{k}", _check(k)) for k in KINDS}
    for k in KINDS:
        found = found.withColumn(f"__good_{k}", good[k])
    judged = lambda i: (lambda x: F.struct(span(x).alias("span"), _shape(i)(x).alias("f")))
    passed = F.concat(*[F.transform(f"__good_{k}", _shape(i)) for i, k in enumerate(KINDS)])
    failed = F.concat(*[F.transform(F.filter(f"__pb_{k}", _check(k, False)), _shape(i)) for i, k in enumerate(KINDS)])
    overlaps = lambda w: F.exists(F.concat(*[F.transform(f"__good_{k}", span) for k in KINDS]), lambda b: (b["s"] < w["e"]) & (w["s"] < b["e"]))
    wide = F.concat(*[F.transform(F.filter(f"__pw_{k}", lambda x: ~overlaps(x)), judged(i)) for i, k in enumerate(KINDS)])
    return found.select(
        *[F.col(f"`{n}`") for n in names],
        *[F.transform(f"__good_{k}", span).alias(f"base_{k}") for k in KINDS],
        passed.alias("passed"),
        failed.alias("failed"),
        wide.alias("wide"),
    )


# --- boosted trees over a table of groups ---


def _logit(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return math.log(p / (1 - p))


def _split(rows: list[tuple], grad: list[float], hess: list[float], own: list[int]):
    """The best (gain, feature, value): go left where feature <= value."""
    total_g, total_h = sum(grad[i] for i in own), sum(hess[i] for i in own)
    best = (1e-6, None, None)
    for f in range(len(FEATURES)):
        g, h = defaultdict(float), defaultdict(float)
        for i in own:
            g[rows[i][f]] += grad[i]
            h[rows[i][f]] += hess[i]
        left_g = left_h = 0.0
        for value in sorted(g)[:-1]:
            left_g += g[value]
            left_h += h[value]
            gain = left_g**2 / (left_h + SMOOTHING) + (total_g - left_g) ** 2 / (total_h - left_h + SMOOTHING) - total_g**2 / (total_h + SMOOTHING)
            if gain > best[0]:
                best = (gain, f, value)
    return best


def boost(rows: list[tuple], positive: list[float], count: list[float]) -> tuple[float, list]:
    """Start value and trees of depth two; a tree is (feature, value, left, right) down to leaf values."""
    start = _logit(sum(positive) / max(sum(count), 1))
    score, trees = [start] * len(rows), []

    def grow(own: list[int], depth: int):
        gain, f, value = _split(rows, grad, hess, own) if depth else (0, None, None)
        if f is None:
            leaf = RATE * sum(grad[i] for i in own) / (sum(hess[i] for i in own) + SMOOTHING)
            for i in own:
                score[i] += leaf
            return leaf
        return f, value, grow([i for i in own if rows[i][f] <= value], depth - 1), grow([i for i in own if rows[i][f] > value], depth - 1)

    for _ in range(ROUNDS if rows else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grad = [positive[i] - count[i] * p[i] for i in range(len(rows))]
        hess = [count[i] * p[i] * (1 - p[i]) for i in range(len(rows))]
        trees.append(grow(list(range(len(rows))), 2))
    return start, trees


def _value(tree, row: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _tree_column(tree, f: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(f[FEATURES[tree[0]]] <= tree[1], _tree_column(tree[2], f)).otherwise(_tree_column(tree[3], f))


class Judge:
    """Boosted trees and, for each kind, the score from which a wider candidate counts."""

    def __init__(self, start: float, trees: list, thresholds: list[float]):
        self.start, self.trees, self.thresholds = start, trees, thresholds

    @classmethod
    def fit(cls, found: DataFrame) -> Judge:
        """From the output of :func:`candidates`; the driver gets one row for each group of equal features."""
        names = [F.col(f"x.{n}").alias(n) for n in FEATURES]
        sides = [("passed", "passed"), ("failed", "failed"), ("wide", "wide.f")]
        of = lambda side: (lambda x: F.struct(F.lit(side).alias("side"), x.alias("x")))
        every = F.concat(*[F.transform(c, of(side)) for side, c in sides])
        table = found.select(F.explode(every).alias("e")).select("e.side", "e.x").groupBy("side", *names).agg(F.count("*").alias("n")).collect()
        table = sorted((r["side"], tuple(r[n] for n in FEATURES), float(r["n"])) for r in table)
        rows, count = [r for _, r, _ in table], [n for _, _, n in table]
        positive = [n * (side == "passed" or side == "wide" and _likely(r)) for side, r, n in table]
        start, trees = boost(rows, positive, count)
        scored = [(start + sum(_value(t, r) for t in trees), r[0], p, n) for (side, r, n), p in zip(table, positive, strict=True) if side == "wide"]
        return cls(start, trees, [cls._threshold([(score, p, n) for score, k, p, n in scored if k == kind]) for kind in range(len(KINDS))])

    @staticmethod
    def _threshold(scored: list[tuple[float, float, float]]) -> float:
        """Groups of one score count together: all of them are accepted, or none."""
        by_score = defaultdict(lambda: [0.0, 0.0])
        for score, p, n in scored:
            by_score[score][0] += p
            by_score[score][1] += n
        threshold, good, seen = math.inf, 0.0, 0.0
        for score in sorted(by_score, reverse=True):
            good, seen = good + by_score[score][0], seen + by_score[score][1]
            if good >= PRECISION * seen:
                threshold = score
        return threshold - 1e-9  # sums may round otherwise

    def accepts(self, f: Column) -> Column:
        if not self.trees or all(map(math.isinf, self.thresholds)):
            return F.lit(False)
        total = F.lit(float(self.start))
        for t in self.trees:
            total = total + _tree_column(t, f)
        least = F.lit(None).cast("double")
        for kind, threshold in enumerate(self.thresholds):
            if not math.isinf(threshold):
                least = F.when(f["kind"] == kind, float(threshold)).otherwise(least)
        return F.coalesce(total >= least, F.lit(False))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def _all_of(i: int, kind: str, judge: Judge) -> Column:
    own = F.filter("wide", lambda w: (w["f"]["kind"] == i) & judge.accepts(w["f"]))
    return F.array_sort(F.concat(f"base_{kind}", F.transform(own, lambda w: w["span"])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` for every row."""
    scratch = Scratch(docs.sparkSession, "pii")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = scratch.save(candidates(rows, "text").drop("text"))
    judge = Judge.fit(found)
    every = F.concat(*[_listed(k, _all_of(i, k, judge)) for i, k in enumerate(KINDS)])
    base = F.concat(*[_listed(k, F.col(f"base_{k}")) for k in KINDS])
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    added = F.size(F.filter("wide", lambda w: judge.accepts(w["f"]))).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"), added)


def _marked(kind: str):
    return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{kind.upper()}]").alias("mark"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a null text stays null. ``length_col``, if named, gets the new
    number of characters of changed texts. All other columns stay as they are, whatever their names: they travel in one struct."""
    names = docs.columns
    scratch = Scratch(docs.sparkSession, "pii")
    own = F.struct(*[F.col(f"`{n}`") for n in names])
    found = candidates(docs.select(own.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")), "text")
    judge = Judge.fit(scratch.save(found.select("passed", "failed", "wide")))
    marked = F.concat(
        *[F.transform(_all_of(i, k, judge), _marked(k)) for i, k in enumerate(KINDS)]
    )
    found = found.withColumn("__spans", F.array_sort(marked))
    text = F.col("text")
    # Spans in order of their starts; one that begins inside another adds nothing of its own but its end.
    step = lambda a, x: F.struct(
        F.greatest(a["at"], x["e"]).alias("at"),
        F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(F.substring(text, (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int")), x["mark"]))).otherwise(a["out"]).alias("out"),
    )
    done = F.aggregate("__spans", F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<string>)").alias("out")), step)
    found = found.withColumn("__done", F.when(F.size("__spans") > 0, done))
    clean = F.when(F.col("__done").isNull(), text).otherwise(
        F.concat(F.array_join("__done.out", ""), F.substring(text, (F.col("__done.at") + 1).cast("int"), F.char_length(text)))
    )
    found = found.select("row", text.alias("before"), clean.alias("after"))
    kept = {n: F.col("row").getField(n) for n in names}
    kept[text_col] = F.col("after")
    if length_col is not None:
        new = F.char_length("after").cast(docs.schema[length_col].dataType)
        kept[length_col] = F.when(F.col("before").eqNullSafe(F.col("after")), kept[length_col]).otherwise(new)
    return found.select(*[kept[n].alias(n) for n in names])
