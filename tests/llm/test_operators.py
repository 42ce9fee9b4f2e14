"""The text operators against plain forms in Python, on small tables with nulls, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from saldoflow.llm import decontaminate, html_text, langid, minhash, packing, passages, pii, token_counts, tokens, topk, warc
from saldoflow.llm.scratch import BitFilter
from saldoflow.llm.words import shingle_slices, word_slices
from tests.conftest import SF_DIR

SYLLABLES = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti", "vu", "ze"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, sid string, key string, place string, text_1 string"


def documents(spark, rows):
    """Rows of (doc_id, text) as a table with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, None, None, "a", "b", "c", "d") for i, t in rows], DOCS)


# --- words and tokens ---

ODD = ["", "  ", None, "Ab\tcD\n é  É", "x" * 50, "a b c d e f", "\x0b\x0c\r", "漢字 🙂 x", "ein wort"]


@pytest.mark.parametrize("size", [7, 1 << 21])
def test_words_are_runs_between_ascii_blanks(size):
    texts = pa.array(ODD)
    seen = {}
    for first, last, hashes, bounds, starts, ends in word_slices(texts, size):
        for i in range(first, last):
            raw = (ODD[i] or "").encode()
            own = slice(bounds[i - first], bounds[i - first + 1])
            found = [raw[a:b].decode() for a, b in zip(starts[own], ends[own], strict=True)]
            assert found == [w for w in re.split(r"[\x20\x09-\x0d]+", ODD[i] or "") if w]
            for w, h in zip(found, hashes[own].tolist(), strict=True):
                assert seen.setdefault("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w), h) == h
    assert len(set(seen.values())) == len(seen)


def test_short_texts_have_one_shingle():
    counts = [len(g) for _, g in shingle_slices(pa.array(["a b c d", "a b c d e", "a", "", None, "a b c d e f g"]))]
    assert counts == [1, 1, 1, 0, 0, 3]


def test_token_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.vocabulary_path())
    texts = [*ODD, "it's I'LL don't 12 3.5 !!!", "<|endoftext|> x <|ENDOFTEXT|>a<|startoftext|>", "é ́x ΑΣ Å ﬁ İ", "a\x1cb\x85c d", "'s's"]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    mine = tokens.WordTokenizer(tokens.vocabulary_path())
    assert [x.tolist() for x in mine.ids(pa.array(texts))] == want
    assert mine.counts(pa.array(texts)).tolist() == [len(x) for x in want]


def test_bit_filter_never_loses_a_key(spark):
    keys = np.random.default_rng(0).integers(-(1 << 63), (1 << 63) - 1, 5000)
    filt = BitFilter.of(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", len(keys))
    assert filt.passes(keys).all()
    assert filt.passes(keys + 1).mean() < 0.1


# --- 1: top k ---


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, norm double, shard string")


def best(rows, k):
    usable = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in usable:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("shard_rows,block", [(1 << 15, 1 << 10), (40, 2)])
def test_top_k_is_exact(spark, shard_rows, block):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1 + i % 3, 6).tolist()) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6), (1000, [1.0, 2.0]), (1001, [0.5, 0.5])]
    rows += [(1100, []), (1200, [0.0] * 6)]
    got = topk.top_k(vectors(spark, rows), __import__("pyspark").sql.functions.expr("vec_id % 100 = 0"), shard_rows=shard_rows, query_block=block)
    assert {tuple(r) for r in got.collect()} == best(rows, topk.K)


def test_top_k_of_nothing(spark):
    from pyspark.sql import functions as F

    assert topk.top_k(vectors(spark, []), F.expr("vec_id % 100 = 0")).collect() == []
    assert topk.top_k(vectors(spark, [(100, [1.0])]), F.expr("vec_id % 100 = 0")).collect() == []


# --- 2: personal data ---


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


PII_TEXTS = [
    None, "", "no data", "mail a.b@c.de, x@y.z_w@v.u and @ a@b", "🙂é 10.0.0.1 1.2.3.4.5.6.7.8 256.1.1.1 0010.1.1.255 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 12345678901234567890 5500000000000004", "tel +1 (132) 555-1352. +49 30 123456-78 +1 2 +123",
    "a@b.c" * 40, "1.1.1.1 " * 700, "漢字+1 (132) 555-1352🙂x@y.zz", "9" * 3000, "a" * 5000 + "@", "call 555-123-4567 or (020) 555 1234", "write bob at site dot org",
    "a@b.c@d.e 1.2.3.4@x.y", "4111\n1111 1111 1111 1111", "+1 (132) 555-1352+1 (132) 555-1352 --",
]


def test_personal_data_matches_plain_patterns(spark):
    rows = list(enumerate(PII_TEXTS)) + [(3, PII_TEXTS[3]), (None, "n@o.id")]
    got = pii.find(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append(t)
    for r in got:
        want = base_spans(by_id[r.doc_id][0])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in want) for x in pii.KINDS), r.doc_id
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), r.doc_id
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_redaction_replaces_spans_only(spark):
    rows = list(enumerate(PII_TEXTS))
    docs = documents(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    done = pii.redact(docs)
    assert done.columns == docs.columns
    for r in done.collect():
        text = PII_TEXTS[r.doc_id]
        if text is None:
            assert r.text is None
            continue
        out, at = [], 0
        for a, b, kind in sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in spans[r.doc_id].split(",") if s):
            if a >= at:
                out.append(text[at:a] + f"[{kind.upper()}]")
            at = max(at, b)
        assert r.text == "".join(out) + text[at:]


def test_boosted_trees_separate_what_features_tell():
    rows = [(k, w, d, 1, 1, left, 2, 0) for k in range(4) for w in (0, 1) for d in range(0, 20, 3) for left in (1, 2)]
    start, trees = pii.boost(rows, [5.0 * (r[5] == 2) for r in rows], [5.0] * len(rows))
    scores = [start + sum(pii._value(t, r) for t in trees) for r in rows]
    assert min(s for s, r in zip(scores, rows, strict=True) if r[5] == 2) > max(s for s, r in zip(scores, rows, strict=True) if r[5] == 1)
    assert pii.boost([], [], [])[1] == []


def test_personal_data_of_nothing(spark):
    assert pii.find(documents(spark, [])).collect() == []
    assert pii.redact(documents(spark, [])).collect() == []


def test_wider_spans_are_added_where_their_form_is_that_of_their_kind(spark):
    rng = random.Random(9)
    prose = [" ".join(words(rng, 8) + [rng.choice(["from at and. Of", "look at home. Then", "was at work.Later on"])] + words(rng, 8)) for _ in range(200)]
    known = [" ".join(words(rng, 8) + [f"{words(rng, 1)[0]}@{words(rng, 1)[0]}.com"] + words(rng, 3)) for _ in range(200)]
    other = ["at 10:20:30 or 12:34:56 we", "code 1234.5678.9012.3456 here", "room 12 555 1234 left", "look at www.site.com now"] * 10
    wide = {
        "write bob at site dot org": "bob at site dot org", "to ann [at] site [dot] net now": "ann [at] site [dot] net", "mail: tim at site.com": "tim at site.com",
        "on 2001:db8::ff00:42:8329 now": "2001:db8::ff00:42:8329", "paid 4111.1111.1111.1111 now": "4111.1111.1111.1111", "call 555-123-4567": "555-123-4567", "or (020) 555 1234": "(020) 555 1234",
    }
    texts = prose + known + other + list(wide) * 10
    got = {r.doc_id: r for r in pii.find(documents(spark, enumerate(texts))).collect()}
    assert {texts[i] for i, r in got.items() if r.n_added} == set(wide)
    for i, r in got.items():
        if r.n_added:
            _, a, b = r.spans.split(":")
            assert texts[i][int(a) : int(b)] == wide[texts[i]]


# --- 3: near duplicates ---


def gram_set(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", fold) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows, threshold=85):
    sets = [gram_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return {(rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))}


def copies(seed=3):
    """Documents in groups of near copies of varying closeness, copies of copies, shared passages and short texts."""
    rng = random.Random(seed)
    texts = []
    shared = words(rng, 60)
    for _ in range(30):
        base = words(rng, rng.randint(5, 160))
        texts.append(base)
        for _ in range(rng.choice([0, 1, 3, 12])):
            copy = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.random())
            texts.append(copy)
        texts.append(shared + words(rng, rng.randint(1, 40)))
    rows = [" ".join(t) for t in texts] + ["a b", "A  B", "", None, " ", "a b c d e f g", "a b c d e f", texts[0][0]]
    rows += [rows[0].upper().replace(" ", "\n")] * 3
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("small_blocks", [False, True])
def test_near_duplicates_are_the_components_of_all_links(spark, monkeypatch, small_blocks):
    if small_blocks:  # every way through the operator, on few rows
        monkeypatch.setattr(minhash, "SHORT_LIST", 2)
        monkeypatch.setattr(minhash, "BLOCK_SETS", 4)
    rows = copies()
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain_components(rows)
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_keep_one_leaves_columns_and_null_ids(spark):
    docs = documents(spark, [(5, "a b c d e f"), (2, "a b c d e f"), (9, "x y z"), (None, "a b c d e f"), (7, None)])
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 7, 9, None]
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    assert minhash.near_duplicates(documents(spark, [(1, None), (2, "")])).count() == 2


# --- 4: WARC ---


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "r", "d") for i, u, h in rows], "page_id long, url string, html string, refers_to string, digest string")


def test_archives_round_trip(spark, tmp_path):
    long = "<p>" + "é" * 300
    rows = [(3, "http://a/3", long), (1, "http://a/1", long), (2, None, "x"), (4, "http://a\r\nX: y/4", "x"), (5, "u", None), (6, "u", ""), (None, "u", "n" * 200), (7, "u", long), (7, "u", long)]
    archives = warc.write_archives(pages(spark, rows), f"file://{tmp_path}/w", archive_bytes=300)
    got = warc.read_archives(spark, archives, f"file://{tmp_path}/w", with_payload=True).collect()
    assert len(got) == len(rows) and all(r.reason is None for r in got)
    for r in got:
        html = next(h or "" for i, _, h in rows if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), hashlib.sha256(html.encode()).hexdigest())
        revisit = r.page_id in (3, 7)
        assert (r.record_type, r.refers_to) == (("revisit", 1) if revisit else ("response", None))
        assert r.payload == (b"" if revisit else html.encode())


def test_no_pages_no_archives(spark, tmp_path):
    archives = warc.write_archives(pages(spark, []), f"file://{tmp_path}/w")
    assert warc.read_archives(spark, archives, f"file://{tmp_path}/w").collect() == []


def record(i, payload=b"p" * 500):
    return warc.record_bytes("response", i, f"http://x/{i}", hashlib.sha256(payload).hexdigest(), len(payload), None, payload)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "length", "none"])
def test_salvage_loses_only_what_is_damaged(packed, damage):
    rng = random.Random(1)
    parts = [record(i, bytes(rng.randrange(256) for _ in range(700))) for i in range(20)]
    if damage == "length":
        parts[7] = parts[7].replace(b"Content-Length: 700", b"Content-Length: 70000")
    blobs = [warc._member(p) if packed else p for p in parts]
    lost = {7}
    if damage == "flip":
        at = len(blobs[7]) - 200  # in the payload
        blobs[7] = blobs[7][:at] + bytes([blobs[7][at] ^ 0xFF]) + blobs[7][at + 1 :]
    elif damage == "cut":
        blobs[7] = blobs[7][:300]
    elif damage == "insert":
        blobs[7] += bytes(rng.randrange(256) for _ in range(3000))
        lost = set()
    elif damage == "none":
        lost = set()
    data = b"".join(blobs)
    found = list(warc.salvage(io.BytesIO(data)))
    records = [x for x in found if isinstance(x, warc.Record)]
    assert [int(r.headers["x-page-id"]) for r in records] == [i for i in range(20) if i not in lost]
    gaps = [x for x in found if isinstance(x, warc.Gap)]
    assert len(gaps) == (damage != "none")
    if gaps:
        assert gaps[0].offset == len(b"".join(blobs[:7])) + (len(warc._member(parts[7]) if packed else parts[7]) if damage == "insert" else 0)
        assert gaps[0].offset + gaps[0].length == records[7 if lost else 8].offset


def test_salvage_of_a_file_that_breaks_off_or_holds_nothing():
    data = warc._member(record(1)) + warc._member(record(2))[:50]
    found = list(warc.salvage(io.BytesIO(data)))
    assert isinstance(found[0], warc.Record) and isinstance(found[1], warc.Gap) and len(found) == 2
    assert list(warc.salvage(io.BytesIO(b""))) == []
    assert [type(x) for x in warc.salvage(io.BytesIO(b"\x1f\x8b\x08 WARC/1 nothing" * 100))] == [warc.Gap]


# --- 5: packing ---


@pytest.mark.parametrize("group", [5, 8192])
def test_packing_places_every_id_once(spark, group):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = [" ".join(words(rng, n)) for n in (0, 1, 5, 40, 400, 900, 3000, 7, 7, 60)] + [None, "", "x"]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    plain = Tokenizer.from_file(tokens.vocabulary_path())
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    got = packing.pack(documents(spark, rows), group_pieces=group).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, all_ids in ids.items():
        times = 2 if i == 3 else 1
        assert sorted(pieces[i]) == sorted([(s, min(2048, len(all_ids) - s)) for s in range(0, len(all_ids), 2048)] * times)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(documents(spark, [])).collect() == []


def test_first_fit_takes_the_first_bin_with_room():
    rng = random.Random(4)
    lengths = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    bins, offsets = packing.first_fit(np.array(lengths), 100)
    room: list[int] = []
    for n, b, o in zip(lengths, bins.tolist(), offsets.tolist(), strict=True):
        want = next((i for i, r in enumerate(room) if r >= n), len(room))
        if want == len(room):
            room.append(100)
        assert (b, o) == (want, 100 - room[want])
        room[want] -= n


# --- 6: HTML ---

ARTICLE = "Long sentence of the article with many words in it, and more of them. " * 6


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        (f"<body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>{ARTICLE}<p>B <b>c</b><i>d</i></article><footer>f</footer>", f"T & U\n{ARTICLE.strip()}\nB cd"),
        (f"<div class='sidebar'>s {ARTICLE}</div><div id=main><p>{ARTICLE}</p><div class=ad>buy</div><p>end&nbsp;&lt;x&gt;</p></div><div class=comments><p>first!</p></div>", f"{ARTICLE.strip()}\nend <x>"),
        (f"<article><header><h1>T</h1></header><p>{ARTICLE}</p><form><input>x</form><script>var a='</p>'</script><aside>z</aside></article>", f"T\n{ARTICLE.strip()}"),
        (f"<p>{ARTICLE}<br>line two<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>", f"{ARTICLE.strip()}\nline two\none\ntwo\na\nb"),
        ("<article><p>a < b and c <d", "a < b and c"),
        ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
        ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"),
        ('<p>see <a href="/hidden/page">this page</a> of it', "see this page of it"),
        ('<p title="the hidden truth">a</p><p data-id="ad" class="notice">b</p><div data-x=\'class="ad"\'>c</div>', "a\nb\nc"),
        ("<div id=legal-history>a</div><p class='comment-on-law'>b</p><div class='main site-footer'>c</div><div hidden>d</div>", "a\nb"),
        ("<p>a &am<b>p;</b> b", "a &amp; b"),
    ],
)
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_pages_of_the_tables_lose_nothing(spark):
    got = html_text.extract(spark.read.parquet(f"{SF_DIR}/pages.parquet")).collect()
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    import html

    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|$)", raw[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", body)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_pages_without_telling_tags_and_classes_keep_their_text():
    import pyarrow.parquet as pq

    found = [x for x in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist() if x]
    bare = [re.sub(r'\sclass="[^"]*"', "", re.sub(r"<(/?)(?:article|main|nav|aside|footer|header|form)\b", r"<\1div", x)) for x in found]
    same = sum(html_text.main_text(a) == html_text.main_text(b) for a, b in zip(found, bare, strict=True))
    assert same >= 0.95 * len(found)


def test_densities_are_those_of_a_recursive_form():
    import math

    rng = random.Random(9)

    def tree(depth):
        children = [tree(depth - 1) if depth and rng.random() < 0.7 else rng.choice(["", "x" * rng.randint(1, 300)]) for _ in range(rng.randint(0, 4))]
        return rng.choice(["div", "span", "section", "a"] if depth < 3 else ["div", "section"]), children

    def written(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(written, node[1]))}</{node[0]}>"

    def counts(node, link=False):
        """Characters, link characters, tags below, link tags below."""
        if isinstance(node, str):
            return len(node), len(node) * link, 0, 0
        link = link or node[0] == "a"
        below = [(counts(c, link), c) for c in node[1]]
        chars, link_chars = (sum(x[k] for x, _ in below) for k in (0, 1))
        tags = sum(x[2] + (not isinstance(c, str)) for x, c in below)
        link_tags = tags if node[0] == "a" else sum(x[3] + (not isinstance(c, str) and c[0] == "a") for x, c in below)
        return chars, link_chars, tags, link_tags

    def density(node, body):
        if isinstance(node, str):
            return 0
        chars, link_chars, tags, link_tags = counts(node)
        if not chars:
            return 0
        links, whole = max(link_chars, 1), counts(body)
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + whole[1] / max(whole[0], 1) * chars + math.e)
        return chars / max(tags, 1) * math.log(max(chars / links * max(tags, 1) / max(link_tags, 1), 1)) / base

    for _ in range(60):
        body = ("div", [tree(4), tree(4), "end"])
        root = html_text.parse(written(body))
        nodes = html_text._ordered(root)
        html_text._measure(nodes)

        def check(node, own, link=False):
            assert node.tag == own[0]
            got = [c for c in node.children if not isinstance(c, str)]
            parts = [c for c in own[1] if not isinstance(c, str)]
            if not link and own[0] != "a":
                assert node.density == pytest.approx(density(own, body), rel=1e-9, abs=1e-9)
                assert node.total == pytest.approx(sum(density(c, body) for c in parts), rel=1e-9, abs=1e-9)
            for g, p in zip(got, parts, strict=True):
                check(g, p, link or own[0] == "a")

        check(root.children[0], body)


def test_every_page_gives_a_row(spark):
    got = html_text.extract(pages(spark, [(1, None, None), (None, "u", "<p>x"), (1, None, None)])).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), ("x", 1)]


# --- 7: decontamination ---


def test_benchmark_passages_are_found_over_edits(spark):
    rng = random.Random(6)
    items = [words(rng, n) for n in [8, 12, 20, 33, 47, 60, 64, 65, 150] * 4]
    rows, planted = [], set()
    for k in range(160):
        text = words(rng, rng.randint(0, 200))
        if k % 2:
            item = rng.randrange(len(items))
            part = list(items[item])
            for _ in range(rng.randint(0, int(0.15 * min(len(part), 64)))):
                place = rng.randrange(len(part))
                part[place : place + 1] = rng.choice([["other"], [], [part[place], "more"]])
            text += [w.upper() + "!!" for w in part] if k % 3 == 0 else part
            planted.add((k, item))
        rows.append((k, " ".join(text + words(rng, rng.randint(0, 50)))))
    rows += [(900, None), (901, ""), (None, " ".join(items[3]))]
    bench = spark.createDataFrame([(i, " ".join(t), "n") for i, t in enumerate(items)] + [(77, None, "n"), (78, "too short", "n")], "item_id long, text string, n string")
    docs = documents(spark, rows)
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert len(planted & got) >= 0.97 * len(planted)
    assert got <= planted
    clean = {r.doc_id for r in decontaminate.clean(docs, bench).collect()}
    assert clean == {i for i, _ in rows} - {d for d, _ in got}
    assert decontaminate.matches(docs, bench.where("item_id > 70")).collect() == []
    assert decontaminate.matches(documents(spark, []), bench).collect() == []


def test_passage_distance_is_the_least_over_all_runs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        item, text = rng.integers(0, 4, rng.integers(1, 8)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 12)).astype(np.uint64)

        def distance(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a):
                new = [i + 1]
                for j, y in enumerate(b):
                    new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
                row = new
            return row[-1]

        want = min(distance(item, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
        edits, start, stop = decontaminate.passage_distance(item, text)
        assert edits == want == distance(item, text[start:stop])


def test_short_items_and_scripts_without_blanks_are_found(spark):
    han = "".join(chr(0x4E00 + 37 * k) for k in range(30))
    items = [(1, "Who wrote it?"), (2, han), (3, han[:5]), (4, None), (5, "?!")]
    edited = han[:12] + chr(0x9000) + han[13:]
    rows = [(1, "so who WROTE it, then"), (2, "who wrote"), (3, "it who wrote"), (4, f"x。{edited}と"), (5, f"{han[1:6]} x"), (6, f"a{han[:5]}b"), (None, "who wrote it")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(documents(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == {(1, 1, 0), (4, 2, 1), (4, 3, 0), (6, 3, 0)}
    assert [(r.start, r.stop) for r in got if r.doc_id == 1] == [(1, 4)]
    # Edits gathered in one half do not hide a start beside a clean one.
    places = np.concatenate([np.arange(0, 19), np.arange(20, 31)])
    assert {0, 20} <= set(decontaminate.window_starts(places, 20, np.array([0, 60])).tolist())


# --- 8: language ---


def test_languages_of_rows_not_trained_on(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    machines = langid.train(docs.where(~langid.held_out()))
    predicted = langid.predict(docs, machines).join(docs.select("doc_id", "lang"), "doc_id").withColumn("h", langid.held_out()).collect()
    held = [r for r in predicted if r.h]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in predicted)
    odd = documents(spark, [(1, None), (2, ""), (3, "12 !? 34"), (4, "und der die das nicht"), (None, "le la les des une"), (4, "und der die das nicht")])
    got = langid.predict(odd, machines).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in got if r.lang_pred == "und") == [("1", "und"), ("2", "und"), ("3", "und")]
    assert len(got) == 6
    kept = langid.only_identified(odd, machines, 0.0)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "None"]
    assert {r.lang_pred for r in langid.predict(odd, langid.train(docs.where(F.lit(False)))).collect()} == {"und"}


def test_copies_of_a_text_count_once_in_the_sample(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text")
    copies = spark.range(20_000).selectExpr("'en' AS lang", "'the same text over and over' AS text")
    seen = []
    monkeypatch.setattr(langid, "_prepared", lambda x: seen.append(len(x)) or x * np.float32(64.0))
    langid.train(docs.unionByName(copies), sample=40)
    assert 0 < seen[0] <= 4 * 2 * 40


def test_kept_rows_have_their_columns_whatever_their_names(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    machines = langid.train(docs)
    odd = docs.selectExpr("doc_id", "text", "'x' AS __text", "true AS __letter", "1 AS `a.b`", "'s' AS score")
    kept = langid.only_identified(odd, machines, 0.01)
    assert kept.schema == odd.schema
    assert {r["__text"] for r in kept.collect()} == {"x"} and kept.count() > 150
    assert langid.only_identified(odd.where("false"), machines, 0.01).count() == 0
    plan = langid.only_identified(docs, machines, 0.01)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1


def test_long_texts_score_as_their_parts_together():
    machines = langid.Machines(["a", "b"], ["a"], {"a": ["b"]}, np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)), np.zeros(2), np.ones(2), np.zeros(2))
    text = " ".join(words(random.Random(1), 3000))
    whole, n = langid._margins(pa.array([text, "x y"]), machines)
    old = langid._slices.__defaults__
    try:
        langid._slices.__defaults__ = (1000,)
        parts, m = langid._margins(pa.array([text, "x y"]), machines)
    finally:
        langid._slices.__defaults__ = old
    assert (n == m).all() and np.allclose(whole, parts)


def test_languages_of_a_family_are_told_by_votes_of_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang IN ('en', 'de', 'nl', 'fr')")
    machines = langid.train(docs)
    langs = machines.members["germanic"]
    pairs = [f"{a}/{b}" for i, a in enumerate(langs) for b in langs[i + 1 :]]
    assert machines.names[len(machines.families) :] == [x for f in machines.families for x in (pairs if f == "germanic" else machines.members[f])]
    # c wins both of its pairs by little; a has the largest sum. A tie of votes goes to the largest sum.
    margins = np.array([[5.0, -0.1, -0.1], [1.0, -2.0, 3.0]])  # a/b, a/c, b/c
    best, chance = langid._of_pairs(margins, 1 / (1 + np.exp(-margins)), 3)
    assert best.tolist() == [2, 1] and ((0 < chance) & (chance < 1)).all()


# --- 9: repeated passages ---


def test_compact_windows_are_those_of_the_cartesian_tree():
    rng = np.random.default_rng(3)
    grams = rng.integers(1, 1 << 63, 700).astype(np.uint64)
    ends = np.repeat([300, 346, 700], [300, 46, 354])
    c, l, r = passages.compact_windows(grams, ends, np.uint64(5))  # noqa: E741
    value = (passages.mix(grams ^ np.uint64(5)) & ~passages._LOW) | np.arange(700, dtype=np.uint64)
    want = []
    for begin, end in ((0, 300), (300, 346), (346, 700)):
        for i in range(begin, end):
            a, b = i, i
            while a > begin and value[a - 1] > value[i]:
                a -= 1
            while b < end - 1 and value[b + 1] > value[i]:
                b += 1
            if b - a + 1 >= passages.WIDTH:
                want.append((i, a, b))
    assert list(zip(c.tolist(), l.tolist(), r.tolist(), strict=True)) == want


def test_passages_of_fifty_words_are_found(spark):
    rng = random.Random(8)
    rows, planted, group = [], set(), {}
    for k in range(40):
        passage = words(rng, rng.choice([50, 60, 120, 700]))
        for n in range(rng.choice([2, 2, 5])):
            copy = list(passage)
            if n % 2 and len(copy) > 100:
                copy[len(copy) // 2] = "edit"
            rows.append((len(rows) + 1000, " ".join(words(rng, rng.randint(0, 80)) + copy + words(rng, rng.randint(0, 80)))))
            planted.add((rows[-1][0], len(rows) - n + 999))
            group[rows[-1][0]] = k
        rows.append((len(rows) + 1000, " ".join(words(rng, 90) + passage[:30] + words(rng, 90))))  # too short
    line = words(rng, 12)
    rows += [(5000 + i, " ".join(words(rng, 60) + line + words(rng, 60))) for i in range(30)]
    rows += [(1, None), (2, ""), (3, "a b c"), (None, rows[0][1])]
    got = passages.repeated_passages(documents(spark, rows)).collect()
    text = dict(rows)
    pairs = {(r.doc_id, r.other_doc_id) for r in got}
    # Copies that share an edit may also meet each other.
    assert {(a, b) for a, b in planted if a != b} <= pairs and all(a > b and group[a] == group[b] for a, b in pairs)
    for r in got:
        own, other = text[r.doc_id].split()[r.start_word : r.stop_word], text[r.other_doc_id].split()[r.other_start_word : r.other_stop_word]
        x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (own, other))
        assert len(own) >= 50 and len(x & y) >= 0.8 * len(x | y)
    assert passages.repeated_passages(documents(spark, [])).collect() == []


def test_shortest_passages_with_an_edit_are_found(spark):
    rng = random.Random(21)
    rows = []
    for _ in range(400):
        passage = words(rng, 50)
        edited = list(passage)
        edited[rng.randint(10, 39)] = "edit"  # 41 of 51 shingles stay
        for part in (passage, edited):
            rows.append((len(rows), " ".join(words(rng, 60) + part + words(rng, 60))))
    pairs = {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(documents(spark, rows)).collect()}
    assert pairs <= {(k + 1, k) for k in range(0, 800, 2)}
    assert len(pairs) >= 0.93 * 400


def test_a_first_document_with_a_part_of_a_passage_hides_no_copies(spark):
    rng = random.Random(12)
    rows, planted = [], set()
    for k in range(150):
        passage = words(rng, 50)
        for part in (passage[:40], passage, passage, passage):
            rows.append((len(rows), " ".join(words(rng, 60) + part + words(rng, 60))))
        planted |= {(4 * k + 2, 4 * k + 1), (4 * k + 3, 4 * k + 1)}
    got = {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(documents(spark, rows)).collect()}
    assert planted <= got and all(a // 4 == b // 4 and b % 4 for a, b in got)


def test_unlinked_windows_meet_in_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK_WINDOWS", 2)
    test_a_first_document_with_a_part_of_a_passage_hides_no_copies(spark)


def test_a_task_holds_little_for_two_blocks_of_near_copies():
    rng = np.random.default_rng(2)
    n, size = 2 * minhash.BLOCK_SETS, minhash.BLOCK_SHINGLES // minhash.BLOCK_SETS
    most = rng.integers(0, 1 << 62, size)
    sets = [np.unique(np.concatenate([most[4:], rng.integers(0, 1 << 62, 4)])) for _ in range(n)]
    group = pd.DataFrame({"sid": [i.to_bytes(16, "big") for i in range(n)], "shingles": sets})
    tracemalloc.start()
    links = minhash._links_in_blocks(85)(group)
    most_held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(links) == n - 1 and most_held < 90e6


def test_a_worker_holds_little_for_long_batches():
    texts = pa.array(["word" * 3 + f" {i} and others of a text " * 40 for i in range(8000)])
    list(word_slices(texts.slice(0, 10)))
    tracemalloc.start()
    for _ in word_slices(texts):
        pass
    most, held = tracemalloc.get_traced_memory()[::-1]
    tracemalloc.stop()
    assert most < 40e6 and held < 20e6


def test_slices_of_any_size_have_the_same_words():
    rng = random.Random(3)
    texts = pa.array([None, "", *[" ".join(words(rng, rng.randint(1, 4000))) for _ in range(30)]])
    want, got = (np.concatenate([x[2] for x in word_slices(texts, size)]) for size in (1 << 21, 1 << 12))
    assert (want == got).all()


def test_windows_linked_over_others_hang_together():
    rng = np.random.default_rng(5)
    new = lambda n: rng.integers(-(1 << 31), 1 << 31, n).astype(np.int32)
    a = new(91)
    b = np.concatenate([a[:50], new(41)])  # 50 shingles of a
    c = np.concatenate([new(23), b[23:]])  # 68 of b, 27 of a
    place, low = np.full(3, 45, dtype=np.int32), np.zeros(3, dtype=np.int32)
    for order in ([a, b, c], [b, a, c], [c, a, b]):
        for open_ in ([True] * 3, [False, True, True]):
            links = passages._forest(np.array([1, 2, 3]), place, low, low + 90, low, np.array(open_), order)
            middle = next(i for i, x in enumerate(order, 1) if x is b)
            assert {x[:2] for x in links} == {(max(middle, k), min(middle, k)) for k in (1, 2, 3) if k != middle}


def test_only_windows_that_can_be_linked_are_compared(monkeypatch):
    """Windows that share much, but less than a passage, are told apart for many pairs at once; the links are those of comparing every pair."""
    rng = np.random.default_rng(8)
    new = lambda n, kinds=1 << 31: rng.integers(-kinds, kinds, n).astype(np.int32)
    shared = new(41)
    groups = [[np.concatenate([new(25), shared, new(25)]) for _ in range(30)]]
    for kinds in (1 << 31, 20):
        for n in (2, 3, 9, 30):
            first = new(91, kinds)
            edited = [np.where(rng.random(91) < share, new(91, kinds), first) for share in rng.choice([0.02, 0.08, 0.15, 0.5], n - 1)]
            groups.append([first, *[np.roll(x, k) for x, k in zip(edited, rng.integers(-30, 30, n - 1), strict=True)]])
    ids = np.concatenate([np.sort(rng.integers(0, max(2, len(x) - 1), len(x))) for x in groups])
    open_ = np.concatenate([rng.random(len(x)) < 0.8 for x in groups])
    bounds = np.cumsum([0, *[len(x) for x in groups]]).tolist()
    zero, place = np.zeros(len(ids), dtype=np.int32), np.full(len(ids), 45, dtype=np.int32)
    grams, compared = [x for y in groups for x in y], []
    columns = [zero.astype(np.int64), zero, zero, ids, place, zero, zero + 90, zero, open_, place, place]
    table = pa.table([*[pa.array(x) for x in columns], pa.array([x.tolist() for x in grams], pa.list_(pa.int32()))], names=[str(i) for i in range(12)])
    plain = passages.passages_in
    monkeypatch.setattr(passages, "passages_in", lambda a, b, order=None: compared.append((a, b)) or plain(a, b, order))
    got = {}
    for at_once in (1 << 18, 1):
        monkeypatch.setattr(passages, "MET_AT_ONCE", at_once)
        got[at_once] = passages._links_of_runs(table, bounds[:-1] + bounds[-1:]).to_pylist()
        of_first = [x for x in compared if any(x[0] is g or np.array_equal(x[0], g) for g in groups[0])]
        assert not of_first and len(compared) >= len(got[at_once])
        compared.clear()
    want = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        every = [[j for j in range(b - a) if ids[a + j] != ids[a + i]] for i in range(b - a)]
        want += passages._forest(ids[a:b], place[a:b], zero[a:b], zero[a:b] + 90, zero[a:b], open_[a:b], grams[a:b], place[a:b], place[a:b], every)
    assert len(want) > 10
    for links in got.values():
        assert [tuple(x.values()) for x in links] == [tuple(x) for x in want]


def test_a_link_to_the_first_document_hides_no_other_link(spark):
    rng = random.Random(17)
    rows, planted = [], set()
    for k in range(150):
        frame, passage = words(rng, 20), words(rng, 50)
        # The first two share 60 words, the last two 50, the first and the last 40.
        for part in (frame + passage[:40], frame + passage, passage):
            rows.append((len(rows), " ".join(words(rng, 60) + part + words(rng, 60))))
        planted |= {(3 * k + 1, 3 * k), (3 * k + 2, 3 * k + 1)}
    found = passages.repeated_passages(documents(spark, rows)).cache()
    assert {(r.doc_id, r.other_doc_id) for r in found.collect()} == planted
    assert {(r.doc_id, r.class_id) for r in passages.classes(found).collect()} == {(i, i - i % 3) for i in range(450)}


def test_text_of_a_repeated_line_is_compared_once(spark):
    rng = random.Random(41)
    tail = words(rng, 40)
    rows = [(i, " ".join(words(rng, 60) + ["la"] * (300 + 50 * i) + words(rng, 60))) for i in range(5)]
    # The end of the repeated word with a tail, also after fewer words, and a line of several words at other places of its period.
    rows += [(10 + i, " ".join(["la"] * n + tail + words(rng, 60))) for i, n in enumerate((500, 30, 200))]
    line = words(rng, 12)
    rows += [(20 + i, " ".join(words(rng, 20) + (line * 40)[5 * i :] + words(rng, 70))) for i in range(4)]
    found = passages.repeated_passages(documents(spark, rows)).cache()
    assert {(r.doc_id, r.class_id) for r in passages.classes(found).collect()} == {(i, 0) for i in (*range(5), 10, 11, 12)} | {(i, 20) for i in range(20, 24)}
    got, held = found.collect(), {k: t.split() for k, t in rows}
    assert len(got) <= 200
    for r in got:
        own, other = held[r.doc_id][r.start_word : r.stop_word], held[r.other_doc_id][r.other_start_word : r.other_stop_word]
        x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (own, other))
        assert len(own) >= 50 and len(x & y) >= 0.8 * len(x | y)
    for i, (k, n) in enumerate(((10, 500), (11, 30), (12, 200))):
        assert i == 0 or any(r.doc_id == k and r.other_doc_id in (10, 11) and r.stop_word >= n + 40 for r in got)


def test_windows_of_a_repeated_shingle_are_one():
    texts = pa.array([" ".join(["la"] * 900), " ".join(f"w{i}" for i in range(900))])
    (grams, ends), = [(x[2], x[4]) for x in passages._sequences(texts)]
    name, c, l, r = passages._named(grams, ends)  # noqa: E741
    _, text, first, last, low, high, reach = passages._chains(name, (c >= 896).astype(int), c, l, r)
    assert (text == 0).sum() <= 6 < (c < 896).sum() and (text == 1).sum() == (c >= 896).sum()
    for k in np.flatnonzero(text == 1):
        assert first[k] == last[k] and reach[k] == first[k] - low[k] and low[k] <= first[k] <= high[k]


def test_fewest_different_values_of_a_run():
    rng = np.random.default_rng(9)
    for n, kinds in ((30, 5), (46, 9), (91, 3), (200, 60), (91, 10**9)):
        grams = rng.integers(0, kinds, n).astype(np.int32)
        runs = [len(np.unique(grams[k : k + passages.WIDTH])) for k in range(n - passages.WIDTH + 1)]
        assert passages._fewest(grams) == min(runs, default=passages.WIDTH)


def test_an_interval_inside_a_longer_one_is_left_out_only_if_a_passage_covers_it(spark):
    spans = spark.createDataFrame([(9, 2, 0, 0, 60), (9, 3, 0, 40, 60), (9, 4, 0, 40, 60)], passages._MET)
    found = spark.createDataFrame([(9, 1, 30, 84, 30, 84, 1.0), (3, 1, 0, 54, 30, 84, 1.0), (2, 1, 0, 54, 30, 84, 1.0)], passages._PASSAGE)
    assert sorted(r.other for r in passages._not_covered(spans, found).collect()) == [2, 4]
    rng = random.Random(31)
    rows, planted = [], set()
    for k in range(60):
        frame, own, b = words(rng, 20), words(rng, 54), words(rng, 30)
        # The last document repeats 54 words of the first and, over the edge of them, 60 of the second.
        first, second, last = frame + own + words(rng, 150), b + own[:30] + words(rng, 120), words(rng, 5) + b + own + words(rng, 150)
        rows += [(10 * k + n, " ".join(t)) for n, t in enumerate((first, second, last))]
        planted |= {(10 * k + 2, 10 * k), (10 * k + 2, 10 * k + 1)}
    assert {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(documents(spark, rows)).collect()} == planted


# --- 10: token counts ---


def test_totals_follow_signed_batches(spark, tmp_path):
    rows = [(1, "a b c", "en", "s"), (2, "dog cat", "en", "s"), (3, None, None, None), (4, "x", "de", "s"), (4, "x", "de", "s")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, docs int")
    counts = token_counts.counted(docs)
    ledger = token_counts.Ledger(spark, f"file://{tmp_path}/ledger")
    read = lambda: {(r.source, r.lang, r.docs, r.tokens) for r in ledger.totals().collect()}
    assert read() == set()
    assert ledger.commit("one", token_counts.changes(counts, 1, "v"))
    first = {("s", "en", 2, 5), (None, None, 1, 0), ("s", "de", 2, 2)}
    assert read() == first
    assert not ledger.commit("one", token_counts.changes(counts, 1, "v")) and read() == first
    gone = counts.where("doc_id = 4")
    assert ledger.commit("two", token_counts.changes(gone, -1, "v"))
    assert read() == first - {("s", "de", 2, 2)}
    revised = spark.createDataFrame([(1, "a b c d e", "en", "t")], "doc_id long, text string, lang string, source string")
    ledger.compact()
    assert ledger.batches() == [] and not ledger.commit("two", token_counts.changes(gone, -1, "v"))
    assert ledger.commit("three", token_counts.revisions(counts.where("doc_id = 1"), token_counts.counted(revised), "v"))
    assert read() == {("s", "en", 1, 2), ("t", "en", 1, 5), (None, None, 1, 0)}
    with pytest.raises(ValueError):
        ledger.commit("../x", token_counts.changes(counts, 1, "v"))


# --- columns with the names that operators use inside ---


def test_filters_and_redaction_keep_columns_of_any_name(spark):
    rows = [(1, "write to jo@ex.org now please friends"), (2, "nothing here to see at all today"), (3, None), (4, ""), (5, "nothing here to see at all today")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "7 AS n_chars", "text AS __t", "'s' AS __spans", "'w' AS wide", "'p' AS passed", "'b' AS base_email", "'m' AS matched",
        "'r' AS repeated", "'__' AS __matched", "1 AS `a.b`", "text AS row", "'x' AS before", "'y' AS after",
    )
    plain = {r.doc_id: r for r in odd.collect()}
    got = pii.redact(odd, length_col="n_chars")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in odd.schema]
    for r in got.collect():
        old = plain[r.doc_id].asDict()
        assert r.asDict() == old | ({"text": "write to [EMAIL] now please friends", "n_chars": 35} if r.doc_id == 1 else {})
    assert sorted(r.doc_id for r in minhash.keep_one(odd).collect()) == [1, 2, 3, 4]
    items = spark.createDataFrame([(1, "nothing here to see at all today")], "item_id long, text string")
    left = decontaminate.clean(odd, items)
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4]
    for empty in (pii.redact(odd.where("false")), minhash.keep_one(odd.where("false")), decontaminate.clean(odd.where("false"), items)):
        assert empty.columns == odd.columns and empty.count() == 0
