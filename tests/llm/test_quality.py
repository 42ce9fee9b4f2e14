"""Line labels against all label sequences, counts against plain Python, and held-out accuracy."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from saldoflow.llm import quality as q
from tests.conftest import SF_DIR

DOCS = "doc_id long, text string, id string, label string, few string, score double"
TEXTS = ["ab Cd. x\n\nHello, World 12\n", "", None, "\n", "abc", "é(a) B\nab Cd. x\nab Cd. x", "x\n" * 9]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", 1.0) for i, t in rows], DOCS)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 21])
def test_counts_of_lines(monkeypatch, size):
    monkeypatch.setattr(q, "SLICE_BYTES", size)
    lines = q._count(pa.array(TEXTS, pa.string()))
    plain = [line.encode() for t in TEXTS for line in (t or "").split("\n")]
    assert lines.per_text.tolist() == [len((t or "").split("\n")) for t in TEXTS]
    assert lines.counts.tolist() == [np.bincount(q._KIND[list(b)] if b else [], minlength=len(q._KINDS)).tolist() for b in plain]
    words = [re.findall(rb"[A-Za-z\x80-\xff]+", b) for b in plain]
    assert lines.words.tolist() == [len(w) for w in words]
    assert lines.capital.tolist() == [sum(x[:1].isupper() for x in w) for w in words]
    again = q._bins(lines)[:, -1].tolist()
    firsts = [sorted((t or "").split("\n")[:i].count(line) > 0 for i, line in enumerate((t or "").split("\n"))) for t in TEXTS]
    assert sum(again) == sum(map(sum, firsts))


def test_marginals_like_all_sequences():
    rng = np.random.default_rng(5)
    per_text = np.array([1, 4, 2, 5])
    field = q.Field(np.zeros(1), 0.0, rng.normal(size=(2, 2)), rng.normal(size=2))
    odds = rng.normal(size=per_text.sum()) * 2
    got, pairs = q._passes(odds, per_text, field)
    expected, steps, at = [], np.zeros((2, 2)), 0
    for n in per_text:
        total, good, moved = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(field.start[labels[0]] + sum(odds[at + i] * y for i, y in enumerate(labels)) + sum(field.steps[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            total += weight
            good += weight * np.array(labels)
            for a, b in zip(labels, labels[1:], strict=False):
                moved[a, b] += weight
        expected += (good / total).tolist()
        steps += moved / total
        at += n
    assert np.allclose(got, expected) and np.allclose(pairs, steps)


def test_slices_agree_with_whole_weights():
    rng = np.random.default_rng(1)
    field = q.Field(rng.normal(size=3 * q._WIDTH), 0.3, rng.normal(size=(2, 2)), rng.normal(size=2))
    texts = pa.array(TEXTS, pa.string())
    lines = q._count(texts)
    odds = field.weights[q._cells(q._bins(lines), lines.per_text)].sum(axis=1) + field.bias
    assert np.allclose(q._line_odds(texts, field)[0], q._passes(odds, lines.per_text, field)[0])


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet")
    return q.train(docs.where(~q.held_out()), spark.read.parquet(f"{SF_DIR}/../sf0.01/labels.parquet"))


def test_held_out_documents(spark, field):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/../sf0.1/{n}.parquet") for n in ("documents", "labels"))
    rows = q.score(docs.where(q.held_out()), field).join(labels, "doc_id").select("score", "quality").collect()
    good, bad = (np.array([r.score for r in rows if r.quality == y]) for y in (1, 0))
    assert len(rows) > 1000
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows]) > 0.93


def test_bad_lines_are_found_among_good_ones(spark, field):
    rng = random.Random(3)
    words = "the of and thing over reason water people under house".split()
    prose = lambda: " ".join(rng.choices(words, k=30)).capitalize() + "."
    junk = lambda: " | ".join(rng.choices(words, k=30))
    rows = [(1, "\n".join([prose(), prose(), *(junk() for _ in range(4))])), (2, "\n".join(prose() for _ in range(6)))]
    got = {(r.doc_id, r.line): r for r in q.label_lines(documents(spark, rows), field).collect()}
    assert [got[1, i].good for i in range(2, 6)] == [False] * 4
    assert all(got[2, i].good for i in range(6))
    scores = {r.doc_id: r.score for r in q.score(documents(spark, rows), field).collect()}
    assert scores[1] < 0.5 <= scores[2]


def test_document_score_is_the_weighted_mean(spark, field):
    docs = documents(spark, [(i, t) for i, t in enumerate(TEXTS)])
    lines, scores = q.label_lines(docs, field).collect(), q.score(docs, field).collect()
    assert len(scores) == len(TEXTS)
    for row in scores:
        own = [r for r in lines if r.doc_id == row.doc_id]
        mean = sum(r.p_good * (r.n_bytes + 1) for r in own) / sum(r.n_bytes + 1 for r in own)
        odds = np.log(np.clip(mean, 1e-4, 1 - 1e-4) / (1 - np.clip(mean, 1e-4, 1 - 1e-4)))
        assert row.score == pytest.approx(1 / (1 + np.exp(-(field.slope * odds + field.shift))))


def test_odd_tables(spark, field):
    docs = documents(spark, [(None, "A text."), (1, None), (1, ""), (2, "x" * 3_000_000), (2, "long line " * 300_000), (3, "\n" * 200_000)])
    rows = q.score(docs, field).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert q.score(documents(spark, []), field).count() == 0
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    one = q.train(docs, labels)
    assert one.constant == pytest.approx(3 / 4)  # two rows of document 1
    assert {r.score for r in q.score(docs, one).collect()} == {3 / 4}
    assert {r.p_good for r in q.label_lines(docs, one).collect()} == {3 / 4}
    assert q.train(docs, labels.where("false")).constant == 0.5
    held = {r.doc_id: r.held for r in docs.select("doc_id", q.held_out().alias("held")).collect()}
    assert held == {None: False} | {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in (1, 2, 3)}
