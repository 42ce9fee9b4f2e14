"""The registered queries over the smallest tables, against SQL where there is a twin, and the pipeline against plain forms."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from saldoflow.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from tests.llm.test_operators import base_spans, documents, gram_set, words


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == ""


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_token_totals_are_those_of_the_documents_as_they_stand_after_all_changes(spark):
    import zlib

    import duckdb
    import pandas as pd
    import public_tokenizers
    from tokenizers import Tokenizer

    old, new = (Tokenizer.from_file(public_tokenizers.path(f"{n}.json")) for n in ("word_bpe_49k", "byte_bpe_50k"))
    new.encode_special_tokens = True
    size = lambda t, x: len(t.encode(x or "", add_special_tokens=False).ids)
    rows = []
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        share = zlib.crc32(str(r.doc_id).encode()) % 16
        rows.append((r.source, r.lang, share, size(old, r.text), size(old, f"{r.text} {r.text}") if r.text else 0, size(new, r.text)))
    written = pd.DataFrame(rows, columns=["source", "lang", "share", "first", "twice", "next"])  # noqa: F841
    want = duckdb.sql(
        """SELECT source, lang, CASE WHEN share IN (6, 7) THEN 'byte_bpe_50k' ELSE 'word_bpe_49k' END AS tokenizer, count(*) AS docs,
        sum(CASE WHEN share = 5 THEN twice WHEN share IN (6, 7) THEN "next" ELSE "first" END)::bigint AS tokens
        FROM written WHERE share <> 3 GROUP BY ALL"""
    ).fetchall()
    got = QUERIES["op10_token_counts"](spark, SF_DIR).select("source", "lang", "tokenizer", "docs", "tokens").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_pipeline_keeps_what_no_stage_drops(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [set(map(str.lower, r.text.split())) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    now, left = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_DIR).cache()
        assert now.columns == docs.columns
        left[name] = {r.doc_id: r for r in now.collect()}
    assert set(left["language"]) == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    sets = {i: gram_set(texts[i]) for i in left["language"]}
    kept = list(left["near_duplicates"])
    for n, i in enumerate(kept):
        for j in kept[:n]:
            common = len(sets[i] & sets[j])
            assert not common or 100 * common < 85 * (len(sets[i]) + len(sets[j]) - common)
    for i in set(left["near_duplicates"]) - set(left["decontamination"]):
        assert any(len(item & set(map(str.lower, texts[i].split()))) >= 0.5 * len(item) for item in items)
    for i, r in left["personal_data"].items():
        assert base_spans(r.text) == []
        assert r.n_chars == len(r.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left["personal_data"])


def test_run_gives_the_rows_of_the_stages(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0


def test_near_copies_from_eighty_per_cent_on_are_left_out(spark):
    rng = random.Random(4)
    rows, least = [], {}
    for k in range(30):
        base = words(rng, 120)
        copy = list(base)
        for place in (20, 50) if k % 3 else (20, 50, 80):  # 106 of 126 or 101 of 131 shingles stay
            copy[place] = "edit"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
        common, every = (len(f(gram_set(rows[-2][1]), gram_set(rows[-1][1]))) for f in (set.intersection, set.union))
        assert (80 * every <= 100 * common < 85 * every) == bool(k % 3)
        least[k] = {2 * k} if k % 3 else {2 * k, 2 * k + 1}
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, rows), SF_DIR)
    assert {r.doc_id for r in kept.collect()} == set().union(*least.values())
