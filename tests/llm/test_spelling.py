"""Spelling variants against all pairs of words compared one by one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from saldoflow.llm import spelling

DOCS = "doc_id long, text string, word string, n long, near string, edit string, id string, run string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "w", 3, "x", "y", "z", "r") for i, t in rows], DOCS)


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows) -> dict[str, tuple]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            at = h % len(word)
            counts[word[:at] + word[at + 1 :] if h % 31 == 0 else word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    found = {}
    for word in n:
        others = sorted((-n[o], o) for o in n if near(word, o))
        form = others[0][1] if others and -others[0][0] >= 10 * n[word] else None
        found[word] = [form, n[word], len(others), n[form] if form else None]
    for word, values in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        values.insert(1, root)
    return {w: tuple(v) for w, v in found.items()}


def variants(docs):
    rows = spelling.variants(spelling.vocabulary(spelling.planted(spelling.occurrences(docs)))).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def corpus(rng: random.Random):
    """Words with variants a letter away, some of them chains of forms, in hot and rare documents."""
    rows = [(None, "ghostly ghostly"), (7, None), (8, ""), (9, "Ghostly, GHOSTLY!" * 30), (9, "Éclairés éclairés éclairés Éclairés")]
    letters = "abcdeéÀzß"
    for k in range(60):
        base = "".join(rng.choices(letters, k=rng.randint(6, 12)))
        rows.append((100 + k, (base + " ") * rng.choice((2, 30, 400))))
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(base))
            word = rng.choice((base[:at] + base[at + 1 :], base[:at] + rng.choice(letters) + base[at + 1 :], base[:at] + rng.choice(letters) + base[at:]))
            rows.append((rng.randrange(1000), f"{word} " * rng.choice((1, 2, 3, 25))))
    return rows


def test_like_all_pairs(spark):
    rows = corpus(random.Random(11))
    expected = plain(rows)
    assert sum(v[0] is not None for v in expected.values()) > 20
    assert variants(documents(spark, rows)) == expected


def test_chains_of_forms_end_at_one_root(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb"]
    words = spark.createDataFrame([(w, 2 * 10**i) for i, w in enumerate(chain)], "word string, n long")
    got = {r.word: (r.form, r.root) for r in spelling.variants(words).collect()}
    assert got == {w: (chain[i + 1] if i < 3 else None, chain[3]) for i, w in enumerate(chain)}


def test_long_words_and_ties(spark):
    long = "ab" * 5000
    n = {long: 2, long[:-1]: 20, long[1:]: 20, "abcdefgh": 2, "abcdefgx": 20, "abcdefga": 20, "abcdefg": 20}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.form, r.n_near) for r in spelling.variants(words).collect()}
    assert got[long] == (long[:-1], 2)
    assert got["abcdefgh"] == ("abcdefg", 3)


def test_empty(spark):
    assert variants(documents(spark, [])) == {}
    assert variants(documents(spark, [(1, None), (2, "short words only")])) == {}


@pytest.mark.parametrize("bits", [1 << 28, 1 << 10])
def test_fuller_filters_lose_nothing(spark, bits, monkeypatch):
    monkeypatch.setattr(spelling, "MAX_BITS", bits)
    rng = random.Random(3)
    words = list({"".join(rng.choices("abcdé", k=rng.randint(7, 70))) for _ in range(3000)})
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    counts = Counter(min(len(w), spelling.LONGEST) for w in words)
    filters = spelling.LengthFilters.sized(counts).filled(table)
    assert len(filters.lanes) * 64 <= max(bits, 512 * len(counts))
    for _, points in spelling._by_length(pa.array(words)):
        length = points.shape[1]
        keys = spelling._key(spelling._sums(points)[:, -1], length)
        assert len(filters.passing(keys, length)) == len(keys)
    if bits > 1 << 20:
        strange = np.array([rng.getrandbits(64) for _ in range(20000)], dtype=np.uint64)
        assert len(filters.passing(strange, 30)) < 100
