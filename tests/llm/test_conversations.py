"""Conversation repair against every sequence of edits tried in turn."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from saldoflow.llm import conversations as cv

ROWS = "conv_id long, turn long, role string, text string, part int, place long, fault string, row_id long, digest string, head string"
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, "y", "z") for r in rows], ROWS)


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(cv.BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def cheapest(rows):
    """(cost, audit, lines) by trying every sequence of edits with at most two insertions in a row."""
    faults, best = faults_of(rows), None

    def go(i, state, cost, audit, lines, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and state in (0, 3):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        if inserted < 2:
            to = NEXT[state]
            go(i, to, cost + 5, audit + "I", [*lines, "user:" if to == 2 else "assistant:"], inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, state, cost + 2, audit + "D", lines, 0)
            if faults[i] not in ("blank", "duplicate"):
                extra, to = 5 if faults[i] else 0, NEXT[state]
                go(i + 1, to, cost + 1 + extra, audit + "R", [*lines, f"{'user' if to == 2 else 'assistant'}:{text}"], 0)
                if (state, role[:1]) in KEPT:
                    go(i + 1, KEPT[state, role[:1]], cost + extra, audit + "K", [*lines, f"{role}:{text}"], 0)

    go(0, 0, 0, "", [], 0)
    return best


def digest_of(rows):
    """The digest columns of rows in order."""
    cost, audit, lines = cheapest(rows)
    faults, turns = faults_of(rows), [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_rows(rng, conversations, most=7):
    rows = []
    for c in range(conversations):
        turns = sorted(rng.sample(range(12), rng.randint(1, most)))
        for t in turns:
            text = rng.choice(("a.", "b? ", "c", "", " \t", "d!\n", "é.", "word, word"))
            rows.append((c, t, rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "User", "")), text + rng.choice(("", str(t) + "."))))
    return rows


@pytest.fixture
def many_parts(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def by_conversation(rows):
    found = {}
    for c, *row in rows:
        found.setdefault(c, []).append(tuple(row))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in found.items()}


def digests(df, ids):
    return {r[0]: tuple(r)[1:] for r in cv.digest(cv.repair(df), ids).collect()}


def test_like_every_sequence_of_edits(spark, many_parts):
    rows = random_rows(random.Random(2), 300)
    shuffled = random.Random(3).sample(rows, len(rows))
    df = table(spark, shuffled)
    assert digests(df, df.select("conv_id")) == {c: digest_of(r) for c, r in by_conversation(rows).items()}


def test_a_long_conversation_over_many_parts(spark, many_parts):
    """All rows of one user: every cut decides on the rows before it, and nothing is final until the end."""
    rows = [(0, t, "user", f"{t}.") for t in range(1001)] + [(1, 0, "user", "q?"), (1, 1, "assistant", "a.")]
    df = table(spark, rows)
    got = digests(df, df.select("conv_id"))
    assert got[0][6] == "D" + "KR" * 500 and got[0][5] == 502
    assert got[1][6] == "KK"


def test_parts_agree_with_one_part(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(("user", "assistant", "system")), rng.choice(("a.", "b", "c?", "")) + str(t % 3)) for c in range(3) for t in range(200)]
    df = table(spark, rows)
    whole = digests(df.coalesce(1), df.select("conv_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert digests(df, df.select("conv_id")) == whole
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_survivors_hold_little_and_give_edits_early():
    survivors, most, final = cv.Survivors(), 0, 0
    for t in range(3000):
        final += sum(1 for _ in survivors.read(("user", "assistant")[t % 2], None, t))
        most = max(most, len(survivors.nodes))
    assert most < 40 and final > 2900
    assert final + sum(1 for _ in survivors.unresolved(survivors.best())) == 3000


def test_ranks_order_like_whole_texts():
    """The rank of a survivor orders it as its complete edits would."""
    rng = random.Random(4)
    for _ in range(200):
        survivors, written = cv.Survivors(), {cv.START: ""}
        for _ in range(30):
            before = {id(node): written[s] for s, (_, _, node) in survivors.alive.items()}
            list(survivors.read(rng.choice(("user", "assistant", "system", "x")), rng.choice((None, None, "truncated", "blank")), None))
            written = {}
            for state, (_, _, node) in survivors.alive.items():
                parents = [w for k, w in before.items() if node.parent is not None and k == id(node.parent)]
                written[state] = (parents[0] if parents else before.get(id(node), None) or next(iter(before.values()))) + node.edits
            if len({len(w) for w in written.values()}) and all(n.parent is not None for _, _, n in survivors.alive.values()):
                ranks = sorted(survivors.alive, key=lambda s: survivors.alive[s][1])
                assert ranks == sorted(written, key=written.get)
            else:
                break


def test_damage_nulls_and_lost_conversations(spark):
    rng = random.Random(6)
    rows = random_rows(rng, 150, 5) + [(None, None, None, None), (None, 3, "user", "x."), (500, None, "user", None), (501, 1, None, "a.")]
    lost = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone."))
    harmed = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        harmed += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    expected = {c: digest_of(r) for c, r in by_conversation(harmed).items()}
    for c in {r[0] for r in rows} - set(expected):
        expected[c] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert lost in expected
    df = table(spark, rows)
    assert digests(cv.damaged(df), df.select("conv_id")) == expected


def test_repeated_rows_and_equal_turns(spark):
    rows = [(1, 0, "user", "a.")] * 3 + [(1, 1, "assistant", "b."), (1, 1, "assistant", "b.")]
    df = table(spark, rows)
    assert digests(df, df.select("conv_id"))[1] == digest_of([r[1:] for r in rows])


def test_empty(spark):
    df = table(spark, [])
    assert cv.repair(df).count() == 0
    assert digests(df, df.select("conv_id")) == {}


def test_edits_give_back_the_repaired_rows(spark):
    df = table(spark, [(1, 0, "assistant", "hello."), (1, 1, "user", "hi"), (1, 2, "user", "q?"), (1, 4, "assistant", "a.")])
    got = [(r.edit, r.turn, r.role_before, r.role, r.text, r.fault, r.cost) for r in cv.repair(df).orderBy("part", "place").collect()]
    assert got == [
        ("Delete", 0, "assistant", None, "hello.", None, 2),
        ("Delete", 1, "user", None, "hi", "truncated", 2),
        ("Keep", 2, "user", "user", "q?", None, 0),
        ("Keep", 4, "assistant", "assistant", "a.", None, 0),
    ]
