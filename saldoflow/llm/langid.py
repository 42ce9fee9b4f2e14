"""Language of whole texts: first the family, then the language within it, by linear support vector machines.

A text becomes hashed frequencies of byte n-grams inside words (A-Z lower-cased, other ASCII signs as blanks). A linear
model needs no feature vector at prediction: the weight of each n-gram is looked up and summed, which takes one pass
over the bytes. Family machines are trained one against the rest, and within a family there is a machine for each pair of
languages. A pair gives one vote; of the languages with most votes that with the largest sum of margins is chosen. Margins become
probabilities by a logistic fit on the training rows, and those of pairs are coupled to one for each language; the score is the
product of the probabilities of the chosen family and of the chosen language in it.

The machines are fitted on a sample of about ``SAMPLE`` labelled texts per language (never more than twice that), chosen by a hash of the
text, copies counting once; every row is predicted from its whole text. Languages are those of the training rows. Families of known codes
are given by ``FAMILIES``; any other language is a family of its own.

A null text, or one without a letter, is ``und`` with score 0. Without any training row every text is ``und``. An empty
table gives no rows. Repeated rows and null ids are kept. Extra columns are ignored by ``predict`` and kept by ``only_identified``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldoflow.llm.words import SLICE_BYTES, buffers

UNDETERMINED = "und"
SAMPLE = 300
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
GRAMS = (1, 2, 3)
STEPS = 150
PENALTY = 1e-4

# Language codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he"),
    "turkic": ("tr", "az", "kk"),
    "indic": ("hi", "bn", "mr", "ur", "pa"),
    "sinitic": ("zh", "yue"),
}

_BLANK = np.array([0x20], dtype=np.uint8)
_SIGN = np.zeros(256, dtype=np.uint64)  # 0: not part of a word
_SIGN[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SIGN[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_SIGN[0x80:] = np.arange(0x80, 0x100)


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def _slices(texts: pa.Array, size: int = SLICE_BYTES >> 1) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Yields (first text, bytes, offsets, head) for slices of texts, each with a blank before it.

    A text longer than a slice comes in parts; a part repeats the last ``head`` bytes before it as context.
    """
    data, offsets = buffers(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, min(int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1, len(texts)))
        a, b = int(offsets[first]), int(offsets[last])
        if b - a > size:
            for start in range(a, b, size):
                head = min(max(GRAMS) - 1, start - a) if start > a else 0
                part = data[start - head : min(b, start + size)]
                part = part if head else np.concatenate([_BLANK, part])
                yield first, part, np.array([0, len(part)]), head
        else:
            local = offsets[first : last + 1] - a
            yield first, np.insert(data[a:b], local[:-1], _BLANK[0]), local + np.arange(len(local)), 0
        first = last


def _grams(data: np.ndarray, offsets: np.ndarray, head: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yields (bucket, owner) of the n-grams of each n: letters, of which the first may be the blank before a word."""
    signs = _SIGN[data]
    letter = signs > 0
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    code, inside = signs.copy(), np.ones(len(data), dtype=bool)
    for n in range(1, max(GRAMS) + 1):
        if n > 1:
            code[1:] = code[:-1] * np.uint64(257) + signs[1:]
            inside[1:] = inside[:-1] & letter[1:]
            inside[0] = False
        if n in GRAMS:
            at = np.flatnonzero(inside & letter if n == 1 else inside)
            at = at[at >= head]
            spread = (code[at] * np.uint64(8) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield (spread >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), owner[at]


@dataclass
class Machines:
    """Weights of all machines side by side: column k belongs to ``names[k]``; families come first, then the pairs of each family (or its only language)."""

    names: list[str]
    families: list[str]
    members: dict[str, list[str]]
    weights: np.ndarray  # BUCKETS x machines
    bias: np.ndarray
    slope: np.ndarray
    shift: np.ndarray


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            total = np.zeros(BUCKETS, dtype=np.float64)
            for _, data, offsets, head in _slices(batch.column(1).slice(i, 1)):
                for bucket, _ in _grams(data, offsets, head):
                    total += np.bincount(bucket, minlength=BUCKETS)
            if total.sum():
                row = (total / total.sum()).astype(np.float32)
                yield pa.record_batch([batch.column(0).slice(i, 1), pa.array([row.tobytes()], pa.binary())], names=["lang", "features"])


def _prepared(x: np.ndarray) -> np.ndarray:
    return x * np.float32(64.0)


def _machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by adaptive gradient steps; both classes weigh the same."""
    d = x.shape[1]
    y = y.astype(np.float32)
    w, b = np.zeros(d, dtype=np.float32), 0.0
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    mw, mb, vw, vb = np.zeros(d), 0.0, np.zeros(d), 0.0
    for step in range(1, STEPS + 1):
        slack = np.maximum(0, 1 - y * (x @ w + np.float32(b))) * weight
        gw, gb = -2 * (x.T @ (slack * y)) + PENALTY * w, -2 * float((slack * y).sum())
        mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
        vw, vb = 0.99 * vw + 0.01 * gw * gw, 0.99 * vb + 0.01 * gb * gb
        fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
        rate = 0.1 / (1 + 0.02 * step)
        w = (w - rate * (mw / fix1) / (np.sqrt(vw / fix2) + 1e-8)).astype(np.float32)
        b = b - rate * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return w.astype(np.float64), b


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn a margin into a probability, by Newton steps with smoothed targets."""
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    a, c = 2.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()]) + np.array([1e-3 * (a - 2.0), 0])
        s = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = a - np.clip(step[0], -5, 5), c - np.clip(step[1], -5, 5)
    return max(a, 1e-3), c


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", sample: int = SAMPLE) -> Machines | None:
    """Fits all machines; the driver gets the features of the sample only."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    limits = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, sample / n))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    # A text counts once however often it is copied, and no language has more than twice the sample.
    drawn = rows.where(draw < limits[F.col("lang")]).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    drawn = drawn.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= 2 * sample)
    found = drawn.select("lang", "text").mapInArrow(_frequencies, "lang string, features binary").toArrow()
    if not len(found):
        return None
    langs = np.array(found["lang"].to_pylist())
    x = _prepared(np.frombuffer(b"".join(found["features"].to_pylist()), dtype=np.float32).reshape(len(langs), BUCKETS))
    order = np.lexsort((x.sum(axis=1), x[:, 0], langs))  # whatever order the tasks ended in
    langs, x = langs[order], x[order]
    families = np.array([family_of(g) for g in langs])
    names, ws, bs, slopes, shifts = [], [], [], [], []

    def add(name: str, rows: np.ndarray, positive: np.ndarray) -> None:
        y = np.where(positive, 1.0, -1.0)
        if positive.all():
            w, b, a, c = np.zeros(BUCKETS), 1.0, 1.0, 6.0
        else:
            w, b = _machine(rows, y)
            a, c = _logistic(rows @ w + b, y)
        names.append(name)
        ws.append(w)
        bs.append(b)
        slopes.append(a)
        shifts.append(c)

    kinds = sorted(set(families.tolist()))
    for family in kinds:
        add(family, x, families == family)
    members = {}
    for family in kinds:
        own = families == family
        members[family] = sorted(set(langs[own].tolist()))
        if len(members[family]) == 1:
            add(members[family][0], x[own], langs[own] == members[family][0])
        for a, b in combinations(members[family], 2):
            pair = own & ((langs == a) | (langs == b))
            add(f"{a}/{b}", x[pair], langs[pair] == a)
    weights = np.stack(ws, axis=1) * 64.0
    return Machines(names, kinds, members, weights, np.array(bs), np.array(slopes), np.array(shifts))


def _margins(texts: pa.Array, machines: Machines) -> tuple[np.ndarray, np.ndarray]:
    """The margin of every machine for every text, and the number of n-grams (0: no letter)."""
    columns = np.ascontiguousarray(machines.weights.T)
    sums, counts = np.zeros((len(texts), len(columns))), np.zeros(len(texts))
    for first, data, offsets, head in _slices(texts):
        n = len(offsets) - 1
        for bucket, owner in _grams(data, offsets, head):
            if not len(bucket):
                continue
            counts[first : first + n] += np.bincount(owner, minlength=n)
            for machine, column in enumerate(columns):  # one machine at a time: a number for each n-gram is held
                sums[first : first + n, machine] += np.bincount(owner, weights=column[bucket], minlength=n)
    return sums / np.maximum(counts, 1)[:, None] + machines.bias, counts


def _of_pairs(margins: np.ndarray, p: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The language chosen among k by the votes of all pairs, and its probability."""
    if k == 1:
        return np.zeros(len(margins), dtype=int), p[:, 0]
    votes, sums, against = (np.zeros((len(margins), k)) for _ in range(3))
    for column, (a, b) in enumerate(combinations(range(k), 2)):
        margin, q = margins[:, column], np.clip(p[:, column], 1e-12, 1 - 1e-12)
        votes[:, a] += margin >= 0
        votes[:, b] += margin < 0
        sums[:, a] += margin
        sums[:, b] -= margin
        against[:, a] += 1 / q
        against[:, b] += 1 / (1 - q)
    best = np.where(votes == votes.max(axis=1, keepdims=True), sums, -np.inf).argmax(axis=1)
    return best, 1 / (against[np.arange(len(best)), best] - (k - 2))


def _choose(margins: np.ndarray, machines: Machines) -> tuple[list[str], np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(margins * machines.slope + machines.shift, -30, 30)))
    f = len(machines.families)
    family = margins[:, :f].argmax(axis=1)
    names, scores = [""] * len(margins), np.zeros(len(margins))
    column = f
    for i, name in enumerate(machines.families):
        langs = machines.members[name]
        own = np.flatnonzero(family == i)
        width = max(1, len(langs) * (len(langs) - 1) // 2)
        best, chance = _of_pairs(margins[own, column : column + width], p[own, column : column + width], len(langs))
        for row, j, q in zip(own, best, chance, strict=True):
            names[row] = langs[j]
            scores[row] = p[row, i] * q
        column += width
    return names, scores


def _predictor(machines: Machines | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [UNDETERMINED] * len(batch), np.zeros(len(batch))
            if machines is not None and len(batch):
                margins, counts = _margins(batch.column(1), machines)
                found, chosen = _choose(margins, machines)
                letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & (counts > 0)
                names = [n if ok else UNDETERMINED for n, ok in zip(found, letters, strict=True)]
                scores = np.where(letters, chosen, 0.0)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, machines: Machines | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(_predictor(machines), "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: every fourth by checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def only_identified(docs: DataFrame, machines: Machines | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language, predicted with at least ``least_score``; columns stay as they are.

    Only texts with a letter go to Python, and only scores come back; the rows themselves stay where they are.
    """
    if machines is None:
        return docs.where("false")

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        margins, counts = _margins(texts, machines)
        return pa.array(np.where(counts > 0, _choose(margins, machines)[1], -1.0)) if len(texts) else pa.array([], pa.float64())

    text = F.col(f"`{text_col}`").cast("string")
    return docs.where(text.rlike(r"\p{L}")).where(score(text) >= least_score)
