"""Quality of whole documents from their lines: a linear-chain conditional random field calls every line good or bad.

A line is described by shares of kinds of characters, the lengths of line and words, and whether its characters stood in an earlier line
of the document; each of these falls into one of a few bins. The field weighs the bins of the line itself, of the line before and of the line
after it, and the step from one label to the next. Forward and backward passes give each line its probability of being good; their mean,
weighted by the lengths of the lines, is the document's share of good text, and a logistic fit turns that share into the probability of label 1.

Labels are given for documents, not lines. Every line of a good document is good. Of a bad one the lines are sorted by a classifier of
single lines first (at least one, the worst, is bad), and the field is fitted on these labels.

The field is fitted on at most ``SAMPLE`` documents of each label, chosen by a hash of their id, of at most ``SAMPLE_LINES`` lines each; every
document is scored from its whole text. Where a document has several labels the lowest counts; where one label or none is known, the score is the share of
label 1, smoothed. A null or empty text is one empty line. Null ids and repeated rows are scored like others; an empty table gives no rows. Only id and
text are read from the documents; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.words import SLICE_BYTES, buffers

SAMPLE = 1000
SAMPLE_LINES = 400
STEPS = 100
PENALTY = 1e-3

# Kinds of bytes that are counted in each line.
_KINDS = ("upper", "lower", "wide", "digit", "blank", "end", "comma", "bracket", "other")
_KIND = np.full(256, _KINDS.index("other"), dtype=np.int64)
_KIND[ord("A") : ord("Z") + 1] = _KINDS.index("upper")
_KIND[ord("a") : ord("z") + 1] = _KINDS.index("lower")
_KIND[0x80:] = _KINDS.index("wide")
_KIND[ord("0") : ord("9") + 1] = _KINDS.index("digit")
_KIND[[0x20, *range(0x09, 0x0E)]] = _KINDS.index("blank")
for _sign, _kind in ((".!?", "end"), (",;:", "comma"), ("()[]{}<>", "bracket")):
    _KIND[[ord(c) for c in _sign]] = _KINDS.index(_kind)
_LETTER = np.isin(_KIND, [_KINDS.index(k) for k in ("upper", "lower", "wide")])
_NAMES = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_NAMES ^= _NAMES >> np.uint64(29)
_NAMES *= np.uint64(0xBF58476D1CE4E5B9)

# Bins: shares of a line, its length in bytes, the mean length of its words.
_SHARES = np.array([1e-9, 0.003, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.6])
_LENGTHS = np.array([1, 8, 20, 40, 80, 160, 320, 640, 1280])
_WORD_LENGTHS = np.array([1e-9, 2, 3, 4, 5, 6, 7, 9, 12])
BINS = 10
FEATURES = len(_KINDS) + 5
# The last bin of a neighbour's feature stands for no neighbour.
_ABSENT = BINS
_WIDTH = FEATURES * (BINS + 1)


@dataclass
class _Lines:
    """Counts of the lines of several texts, one after the other."""

    counts: np.ndarray  # lines x kinds
    words: np.ndarray
    capital: np.ndarray
    names: np.ndarray
    per_text: np.ndarray


def _count(texts: pa.Array) -> _Lines:
    """Counts every line of whole texts; a text is read in slices, and a line may go on from one slice to the next."""
    data, offsets = buffers(texts)
    breaks = [data[s : s + SLICE_BYTES] == 0x0A for s in range(0, len(data), SLICE_BYTES)]
    ends = np.concatenate([np.flatnonzero(b) + i * SLICE_BYTES for i, b in enumerate(breaks)]) if breaks else np.zeros(0, dtype=np.int64)
    per_text = np.searchsorted(ends, offsets[1:]) - np.searchsorted(ends, offsets[:-1]) + 1
    firsts = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    total = int(per_text.sum())
    # Where lines start, in order: at the start of each text and behind each line break.
    starts = np.empty(total, dtype=np.int64)
    inner = np.ones(total, dtype=bool)
    inner[firsts] = False
    starts[firsts], starts[inner] = offsets[:-1], ends + 1
    lines = _Lines(np.zeros((total, len(_KINDS))), np.zeros(total), np.zeros(total), np.zeros(total, dtype=np.uint64), per_text)
    for start in range(0, len(data), SLICE_BYTES):
        part = data[start : start + SLICE_BYTES]
        before = data[start - 1] if start else np.uint8(0x0A)
        a = max(int(np.searchsorted(starts, start, side="right")) - 1, 0)
        b = int(np.searchsorted(starts, start + len(part)))
        # Of lines that start at the same byte only the last has any: the others are empty.
        marks = np.zeros(len(part) + 1, dtype=np.int64)
        np.add.at(marks, np.maximum(starts[a + 1 : b] - start, 0), 1)
        line = a + np.cumsum(marks[:-1])
        kind = np.where(part == 0x0A, -1, _KIND[part])
        real = kind >= 0
        cells = np.bincount((line[real] - a) * len(_KINDS) + kind[real], minlength=(b - a) * len(_KINDS))
        lines.counts[a:b] += cells.reshape(b - a, len(_KINDS))
        letter = _LETTER[part]
        opens = letter.copy()
        opens[1:] &= ~letter[:-1]
        opens[0] &= not _LETTER[before] or bool(starts[a] == start)
        opens |= letter & np.concatenate([[False], marks[1:-1] > 0])
        lines.words[a:b] += np.bincount(line[opens] - a, minlength=b - a)
        lines.capital[a:b] += np.bincount(line[opens & (kind == 0)] - a, minlength=b - a)
        np.add.at(lines.names, line[real], _NAMES[part[real]])
    return lines


def _bins(lines: _Lines) -> np.ndarray:
    """lines x FEATURES: the bin of each feature."""
    total = lines.counts.sum(axis=1)
    size = np.maximum(total, 1)[:, None]
    letters = lines.counts[:, 0] + lines.counts[:, 1] + lines.counts[:, 2]
    words = np.maximum(lines.words, 1)
    text = np.repeat(np.arange(len(lines.per_text)), lines.per_text)
    order = np.lexsort((np.arange(len(text)), lines.names, text))
    again = np.zeros(len(text), dtype=np.int64)
    same = (text[order][1:] == text[order][:-1]) & (lines.names[order][1:] == lines.names[order][:-1])
    again[order[1:][same]] = 1
    return np.column_stack(
        [
            *np.digitize(lines.counts / size, _SHARES).T,
            np.digitize(total, _LENGTHS),
            np.digitize(letters / words * (lines.words > 0), _WORD_LENGTHS),
            np.digitize(lines.capital / words, _SHARES),
            np.digitize(lines.counts[:, 5] / words, _SHARES),  # sentence ends a word
            again,
        ]
    ).astype(np.uint8)


def _cells(bins: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """lines x (3 FEATURES): which weight each feature of the line, the one before and the one after it takes."""
    none = np.full((1, bins.shape[1]), _ABSENT, dtype=np.uint8)
    before, after = np.vstack([none, bins[:-1]]), np.vstack([bins[1:], none])
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    before[first], after[first + per_text - 1] = _ABSENT, _ABSENT
    column = np.arange(bins.shape[1]) * (BINS + 1)
    return np.hstack([bins + column, before + column + _WIDTH, after + column + 2 * _WIDTH]).astype(np.int32)


@dataclass
class Field:
    """``weights`` speak for good; ``steps[i, j]`` belongs to label j after label i (0: bad, 1: good)."""

    weights: np.ndarray
    bias: float
    steps: np.ndarray
    start: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None


def _passes(odds: np.ndarray, per_text: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many documents side by side: P(good) of each line and the expected number of steps of each kind."""
    seen = np.stack([1 / (1 + np.exp(np.clip(odds, -30, 30))), 1 / (1 + np.exp(np.clip(-odds, -30, 30)))], axis=1)
    move = np.exp(field.steps)
    order = np.argsort(-per_text, kind="stable")
    first = (np.concatenate([[0], np.cumsum(per_text)[:-1]]))[order]
    longer = np.searchsorted(-per_text[order], -np.arange(1, per_text.max() + 1), side="right")  # documents with more than t lines
    ahead, back = np.empty_like(seen), np.ones_like(seen)
    for t, n in enumerate(longer):
        at = first[:n] + t
        now = (np.exp(field.start) if t == 0 else ahead[at - 1] @ move) * seen[at]
        ahead[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(len(longer) - 2, -1, -1):
        at = first[: longer[t + 1]] + t
        now = (seen[at + 1] * back[at + 1]) @ move.T
        back[at] = now / now.sum(axis=1, keepdims=True)
    both = ahead * back
    inner = np.ones(len(odds), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    pairs = ahead[at - 1][:, :, None] * move * (seen[at] * back[at])[:, None, :]
    pairs /= pairs.sum(axis=(1, 2), keepdims=True)
    return both[:, 1] / both.sum(axis=1), pairs.sum(axis=0)


def _ascend(gradients, shapes: list[tuple]) -> list[np.ndarray]:
    """Gradient steps with adaptive rates from zero."""
    values = [np.zeros(s) for s in shapes]
    means, squares = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for step in range(1, STEPS + 1):
        for i, g in enumerate(gradients(values)):
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            rate = 0.15 / (1 + 0.02 * step)
            values[i] = values[i] + rate * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-8)
    return values


def _single_lines(cells: np.ndarray, good: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """P(good) of each line by a logistic model of the line alone."""
    own = cells[:, :FEATURES]

    def gradients(values):
        w, b = values
        p = 1 / (1 + np.exp(-np.clip(w[own].sum(axis=1) + b[0], -30, 30)))
        miss = (good - p) * weight
        return [np.bincount(own.ravel(), np.repeat(miss, own.shape[1]), minlength=len(w)) - PENALTY * w, np.array([miss.sum()])]

    w, b = _ascend(gradients, [(_WIDTH,), (1,)])
    return 1 / (1 + np.exp(-np.clip(w[own].sum(axis=1) + b[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit with smoothed targets in which both labels weigh as they occur."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))

    def gradients(values):
        a, c = values
        miss = target - 1 / (1 + np.exp(-np.clip(a[0] * x + c[0], -30, 30)))
        return [np.array([(miss * x).mean()]) - 1e-3 * a, np.array([miss.mean()])]

    a, c = _ascend(gradients, [(1,), (1,)])
    return max(float(a[0]), 1e-3), float(c[0])


def _share(good: np.ndarray, sizes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Length-weighted mean of P(good) for each document, as log odds."""
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    weight = sizes + 1.0
    mean = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit(cells: np.ndarray, sizes: np.ndarray, per_text: np.ndarray, labels: np.ndarray) -> Field:
    """The field of documents with known labels; ``sizes`` are the lengths of their lines."""
    text = np.repeat(np.arange(len(labels)), per_text)
    good = labels[text].astype(float)
    # Both labels weigh the same, and so do documents of one label.
    of_text = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    weight = of_text[text] / per_text[text]
    single = _single_lines(cells, good, weight)
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    worst = single == np.minimum.reduceat(single, first)[text]
    good = np.where((good == 0) & (single > 0.5) & ~worst, 1.0, good)
    inner = np.ones(len(text), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    steps_seen = np.zeros((2, 2))
    np.add.at(steps_seen, (good[at - 1].astype(int), good[at].astype(int)), 1.0)
    scale = 1.0 / len(text)

    def gradients(values):
        w, b, steps, start = values
        p, expected = _passes(w[cells].sum(axis=1) + b[0], per_text, Field(w, b[0], steps, start))
        miss = (good - p) * scale
        began = np.array([-(good[first] - p[first]).sum(), (good[first] - p[first]).sum()]) * scale
        rate = PENALTY * 0.1
        return [
            np.bincount(cells.ravel(), np.repeat(miss, cells.shape[1]), minlength=len(w)) - rate * w,
            np.array([miss.sum()]),
            (steps_seen - expected) * scale - rate * steps,
            began - rate * start,
        ]

    w, b, steps, start = _ascend(gradients, [(3 * _WIDTH,), (1,), (2, 2), (2,)])
    field = Field(w, float(b[0]), steps, start)
    p, _ = _passes(w[cells].sum(axis=1) + field.bias, per_text, field)
    field.slope, field.shift = _logistic(_share(p, sizes, per_text), labels)
    return field


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: every third by checksum of the id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            lines = _count(batch.column(1).slice(i, 1))
            sizes = lines.counts.sum(axis=1).astype(np.int64)
            values = [pa.array([_bins(lines).tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary())]
            yield pa.record_batch([batch.column(0).slice(i, 1), *values], names=["label", "bins", "sizes"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Field:
    """Fits the field on labelled documents; the driver gets the bins of the sample only."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    known = known.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
    drawn = None
    for label in (0, 1):
        one = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        drawn = one if drawn is None else drawn.unionByName(one)
    # A line break more than there are lines: counted before texts leave the JVM.
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    few = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) < SAMPLE_LINES
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), few.alias("few")).where("few")
    # At most 2 * sample ids; ids repeated in the documents do not widen the sample.
    rows = texts.join(F.broadcast(drawn), "id").select("label", "text").limit(2 * sample)
    found = rows.mapInArrow(_described, "label int, bins binary, sizes binary").toArrow()
    labels_seen = np.array(found["label"].to_pylist(), dtype=np.int64)
    if not len(labels_seen) or labels_seen.min() == labels_seen.max():
        return Field(np.zeros(0), 0.0, np.zeros((2, 2)), np.zeros(2), constant=(labels_seen.sum() + 1) / (len(labels_seen) + 2))
    bins, sizes = found["bins"].to_pylist(), found["sizes"].to_pylist()
    order = sorted(range(len(bins)), key=lambda i: (labels_seen[i], bins[i], sizes[i]))  # whatever order the tasks ended in
    per_text = np.array([len(sizes[i]) // 8 for i in order])
    matrix = np.frombuffer(b"".join(bins[i] for i in order), dtype=np.uint8).reshape(-1, FEATURES)
    line_sizes = np.frombuffer(b"".join(sizes[i] for i in order), dtype=np.int64)
    return fit(_cells(matrix, per_text), line_sizes, per_text, labels_seen[order])


def _groups(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of texts of bounded bytes, at least one text each."""
    sizes = np.diff(buffers(texts)[1])
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > SLICE_BYTES:
            yield texts.slice(first, i - first)
            first, held = i, 0
        held += int(size)
    if len(texts) > first:
        yield texts.slice(first)


def _line_odds(texts: pa.Array, field: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) and the length of each line, and the number of lines of each text."""
    lines = _count(texts)
    bins = _bins(lines)
    last = np.cumsum(lines.per_text) - 1
    first = last - lines.per_text + 1
    weights = field.weights.reshape(3, FEATURES, BINS + 1)
    odds = np.full(len(bins), field.bias)
    for f in range(FEATURES):  # one feature at a time: a few numbers a line are held
        own, before, after = (w[f][bins[:, f]] for w in weights)
        before, after = np.roll(before, 1), np.roll(after, -1)
        before[first], after[last] = weights[1, f, _ABSENT], weights[2, f, _ABSENT]
        odds += own + before + after
    return _passes(odds, lines.per_text, field)[0], lines.counts.sum(axis=1), lines.per_text


def _scorer(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in _groups(batch.column(1)):
                if field.constant is None:
                    good, sizes, per_text = _line_odds(texts, field)
                    score = 1 / (1 + np.exp(-np.clip(field.slope * _share(good, sizes, per_text) + field.shift, -30, 30)))
                else:
                    score = np.full(len(texts), field.constant)
                yield pa.record_batch([batch.column(0).slice(done, len(texts)), pa.array(score)], names=["doc_id", "score"])
                done += len(texts)

    return run


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row: the probability of label 1."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_scorer(field), "doc_id long, score double")


def _line_scorer(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in _groups(batch.column(1)):
                good, sizes, per_text = _line_odds(texts, field) if field.constant is None else (None, None, None)
                if good is None:
                    lines = _count(texts)
                    good, sizes, per_text = np.full(len(lines.words), field.constant), lines.counts.sum(axis=1), lines.per_text
                owner = np.repeat(np.arange(len(texts)), per_text)
                first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
                number = np.arange(len(owner)) - first[owner]
                ids = batch.column(0).slice(done, len(texts)).take(pa.array(owner))
                values = [ids, pa.array(number), pa.array(sizes.astype(np.int64)), pa.array(good), pa.array(good >= 0.5)]
                yield pa.record_batch(values, names=["doc_id", "line", "n_bytes", "p_good", "good"])
                done += len(texts)

    return run


def label_lines(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line, n_bytes, p_good, good)`` for every line of every text, lines counted from 0."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_line_scorer(field), "doc_id long, line long, n_bytes long, p_good double, good boolean")
