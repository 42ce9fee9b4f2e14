"""Registered queries ``opN_<name>`` over the provided tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.llm import (
    conversations,
    decontaminate,
    html_text,
    langid,
    minhash,
    packing,
    passages,
    pii,
    quality,
    spelling,
    token_counts,
    topk,
    warc,
)
from saldoflow.llm.scratch import Scratch

NEXT_VOCABULARY = "byte_bpe_50k.json"  # the version that op10 moves some documents to


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives, reads them back, and gives the records that were read."""
    folder = f"{Scratch(spark, 'warc').folder}/archives"
    archives = warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, archives, folder).where("reason IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machines = langid.train(docs.where(~langid.held_out()))
    predicted = langid.predict(docs, machines)
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between documents with their passages; ``class_id`` is the least document that links lead to."""
    found = Scratch(spark, "passages").save(passages.repeated_passages(_table(spark, sf_dir, "documents")))
    return found.join(passages.classes(found), "doc_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after two loads, deletions, revised texts and a move to another tokenizer version, some of them committed twice.

    By crc32(doc_id as text) mod 16, documents with 3 are deleted, those with 5 have their text twice, joined by a
    space, and those with 6 and 7 are counted by the next tokenizer version.
    """
    scratch = Scratch(spark, "tokens")
    docs = _table(spark, sf_dir, "documents")
    share = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(16))
    counts = scratch.save(token_counts.counted(docs))
    doubled = token_counts.counted(docs.where(share == 5).withColumn("text", F.concat_ws(" ", "text", "text")))
    recounted = token_counts.counted(docs.where(share.isin(6, 7)), token_counts.vocabulary_path(NEXT_VOCABULARY))
    version, following = (x.removesuffix(".json") for x in (token_counts.DEFAULT_VOCABULARY, NEXT_VOCABULARY))

    ledger = token_counts.Ledger(spark, f"{scratch.folder}/ledger")
    ledger.commit("load-0", token_counts.changes(counts.where(share < 8), 1, version))
    ledger.commit("load-1", token_counts.changes(counts.where(share >= 8), 1, version))
    ledger.commit("load-0", token_counts.changes(counts.where(share < 8), 1, version))
    ledger.commit("delete", token_counts.changes(counts.where(share == 3), -1, version))
    ledger.compact()
    ledger.commit("delete", token_counts.changes(counts.where(share == 3), -1, version))
    ledger.commit("revise", token_counts.revisions(counts.where(share == 5), doubled, version))
    ledger.commit("move", token_counts.revisions(counts.where(share.isin(6, 7)), recounted, version, following))
    return ledger.totals()


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.occurrences(_table(spark, sf_dir, "documents"))
    return spelling.variants(spelling.vocabulary(spelling.planted(found)))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = quality.train(docs.where(~quality.held_out()), _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, field)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return conversations.digest(conversations.repair(conversations.damaged(rows)), rows.select("conv_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_inner_product": op1_topk_inner_product,
    "op2_pii": op2_pii,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_html_text": op6_html_text,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_quality": op12_quality,
    "op13_conversation_repair": op13_conversation_repair,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Checksums of byte lists, by a table of the remainders of all bytes.
_CRC_TABLE = """crc AS (
          SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                   lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)"""


def _crc32(codes: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLE: dict[str, str] = {
    "op1_topk_inner_product": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op3_minhash_dedup": rf"""
        WITH RECURSIVE lists AS (
          SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        w AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM lists),
        five AS (
          SELECT doc_id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS gram
          FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        g AS (
          SELECT DISTINCT doc_id, gram FROM five WHERE gram IS NOT NULL
          UNION ALL SELECT doc_id, string_agg(w, ' ' ORDER BY i) FROM w GROUP BY doc_id HAVING count(*) < 5),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        shared AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
        links AS (
          SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (
          SELECT doc_id, doc_id AS root FROM documents
          UNION SELECT edges.y, reached.root FROM reached JOIN edges ON edges.x = reached.doc_id),
        least AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY 1)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op4_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (
          SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
          FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f""",
    "op11_spelling_variants": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{spelling.LETTERS}]+')) AS run FROM documents),
        lowered AS (
          SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
          FROM runs WHERE length(run) >= 7),
        repeated AS (SELECT id, run, count(*) AS n FROM lowered GROUP BY ALL),
        checked AS (
          SELECT run, n, {_crc32("flatten(list_transform(string_split(id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195, ord(x) - 64] END))")} AS h
          FROM repeated, crc),
        words AS (
          SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM checked),
        vocabulary AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        places AS (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary),
        cut AS (SELECT DISTINCT word, n, left(word, i) || substr(word, i + 2) AS rest FROM places),
        holes AS (SELECT word, n, left(word, i) || '*' || substr(word, i + 2) AS hole FROM places),
        near AS (
          SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
          UNION ALL SELECT c.word, v.word, v.n FROM cut c JOIN vocabulary v ON v.word = c.rest
          UNION ALL SELECT v.word, c.word, c.n FROM cut c JOIN vocabulary v ON v.word = c.rest),
        best AS (
          SELECT word, count(*) AS n_near, min({{'n': -other_n, 'w': encode(other)}}) AS b FROM near GROUP BY word),
        forms AS (
          SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 10 * v.n THEN decode(b.w) END AS form, CASE WHEN -b.n >= 10 * v.n THEN -b.n END AS form_n
          FROM vocabulary v LEFT JOIN best USING (word)),
        chain AS (
          SELECT word, word AS root FROM forms
          UNION ALL SELECT chain.word, f.form FROM chain JOIN forms f ON f.word = chain.root WHERE f.form IS NOT NULL),
        ends AS (SELECT chain.word, root FROM chain JOIN forms f ON f.word = chain.root WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)""",
    "op13_conversation_repair": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        keyed AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        kinds AS (SELECT keyed.*, {_crc32("list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 20 AS kind FROM keyed, crc),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM kinds, range(2) AS time(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(length(role) || ':' || role || text)) AS i,
                 rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
        faults AS (
          SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                 CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM numbered),
        counts AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
        moves(begins, pre, reached, lines) AS (
          VALUES (0, '', 0, []), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']),
                 (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']),
                 (2, '', 2, []), (2, 'I', 3, ['assistant:']), (2, 'II', 2, ['assistant:', 'user:']),
                 (3, '', 3, []), (3, 'I', 2, ['user:']), (3, 'II', 3, ['user:', 'assistant:'])),
        legal(reached, initial, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        search(conv_id, i, state, best) AS (
          SELECT conv_id, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} FROM counts
          UNION ALL
          SELECT conv_id, i, state, min(best) FROM (
            SELECT f.conv_id, f.i, s.state, {{'cost': s.best.cost + 2, 'audit': s.best.audit || 'D', 'lines': s.best.lines}} AS best
            FROM search s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
            UNION ALL
            SELECT f.conv_id, f.i, CASE WHEN m.reached = 2 THEN 3 ELSE 2 END,
                   {{'cost': s.best.cost + 5 * length(m.pre) + 1 + CASE WHEN fault IS NULL THEN 0 ELSE 5 END, 'audit': s.best.audit || m.pre || 'R',
                     'lines': s.best.lines || m.lines || [CASE WHEN m.reached = 2 THEN 'assistant:' ELSE 'user:' END || f.text]}}
            FROM search s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1 AND f.fault IS DISTINCT FROM 'blank'
                 AND f.fault IS DISTINCT FROM 'duplicate' JOIN moves m ON m.begins = s.state
            UNION ALL
            SELECT f.conv_id, f.i, l.next,
                   {{'cost': s.best.cost + 5 * length(m.pre) + CASE WHEN fault IS NULL THEN 0 ELSE 5 END, 'audit': s.best.audit || m.pre || 'K',
                     'lines': s.best.lines || m.lines || [f.role || ':' || f.text]}}
            FROM search s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1 AND f.fault IS DISTINCT FROM 'blank'
                 AND f.fault IS DISTINCT FROM 'duplicate' JOIN moves m ON m.begins = s.state JOIN legal l ON l.reached = m.reached AND l.initial = f.initial
          ) GROUP BY conv_id, i, state),
        ended AS (
          SELECT s.conv_id, min({{'cost': s.best.cost + 5 * length(m.pre), 'audit': s.best.audit || m.pre, 'lines': s.best.lines || m.lines}}) AS best
          FROM search s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i
               JOIN moves m ON m.begins = s.state AND m.reached IN (0, 3) GROUP BY s.conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
               sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
             LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id""",
}
