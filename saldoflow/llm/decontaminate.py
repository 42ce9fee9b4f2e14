"""Benchmark passages in documents, found over edits by an embedding of edit distance into Hamming distance.

Texts are sequences of plain words: letters and digits, lower-cased; all other ASCII signs are blanks, and
each letter of a script without blanks is a word. An item is matched as a
whole if it has at most ``PART`` words, and else in consecutive parts of about that many, so that windows are bounded.
A match is a passage within an edit distance (of words) of ``EDITS`` times the words of the part.

1. A window of as many words as a part can only match if at least n - 1 - 2d of its word pairs are pairs of a part of that
   size, for d allowed edits: a word replaced or left out spoils two pairs, a word put in spoils one and pushes one
   out of the window. A table of fixed size says for a word pair of which sizes there are parts with it; a few pairs more
   pass for a large benchmark, none is lost.
2. The windows left are embedded by random walks: at each step a bit drawn from the step and the word under the
   reader says whether the reader moves on. Sequences at a small edit distance then agree in many places. ``SAMPLED``
   places make one key and ``REPEATS`` independent walks give as many chances; at the largest distance
   allowed the recall is about 0.998. A second filter holds back windows without a key of any part.
3. Windows and parts meet in a join on their keys, and the exact distance of the part to the best passage around the window decides.

Items of fewer than ``LEAST_WORDS`` words match where all of their words follow each other unchanged, also if that is one word:
which items are worth looking for is up to the benchmark. Null items, and items without words, match nothing. Null or empty texts have no
matches. Repeated item ids match as often as they occur, once per part. A document that occurs twice with one id is one
document. Null ids of documents take no part in ``matches`` and are kept by ``clean``. Extra columns are ignored by ``matches`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import BitFilter, Scratch, free_name
from saldoflow.llm.words import mix, shingles, word_slices

EDITS = 0.2
LEAST_WORDS = 8
PART = 64
SAMPLED, REPEATS = 2, 20
SEED = 20240229
BLOCK = 1 << 12
MOST_SLOTS = 1 << 21

_PART = "item_id long, part int, n int, words binary, keys array<long>, pairs array<long>, different int"
_WINDOW = "key long, doc_id long, start int, n int, words binary"
_SHORT = "item_id long, n int, key long"
_RUN = "key long, n int, doc_id long, start long"
_MATCH = "doc_id long, item_id long, part int, start long, stop long, n_words int, edits int, similarity double"


def _allowed(n: int) -> int:
    return int(n * EDITS + 1e-9)


def _needed(n: int) -> int:
    return max(1, n - 1 - 2 * _allowed(n))


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(0xA0761D6478BD642F) + words[1:])


def walk_keys(windows: np.ndarray) -> np.ndarray:
    """``REPEATS`` keys for every row of word hashes; rows of different lengths have unrelated keys."""
    rows, n = windows.shape
    random = np.random.default_rng(SEED)
    places = (np.sort(random.random((REPEATS, SAMPLED)), axis=1) * 2 * n).astype(np.int64)
    seeds = random.integers(1, 1 << 63, REPEATS).astype(np.uint64)
    reader = np.zeros((rows, REPEATS), dtype=np.int64)
    keys = np.tile(mix(seeds + np.uint64(n)), (rows, 1))
    at = np.arange(rows)[:, None]
    for step in range(int(places.max()) + 1):
        word = np.where(reader < n, windows[at, np.minimum(reader, n - 1)], np.uint64(0))
        taken = (places == step).any(axis=1)
        if taken.any():
            keys[:, taken] = mix(keys[:, taken] * np.uint64(31) + word[:, taken])
        moves = mix(word + seeds[None, :] + np.uint64((step + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(63)
        reader += moves.astype(np.int64) & (reader < n)
    return keys


def passage_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to any run of words in the text, with the run's start and end."""

    def best_end(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        steps = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, dtype=np.int64)
        for i, x in enumerate(a):
            new = np.empty_like(row)
            new[0] = i + 1
            np.minimum(row[:-1] + (b != x), row[1:] + 1, out=new[1:])
            row = np.minimum.accumulate(new - steps) + steps
        return int(row.min()), int(row.argmin())

    edits, stop = best_end(item, text)
    # Backwards from the end found, with the same number of edits, lies the start.
    back = text[:stop][::-1]
    steps = np.arange(len(back) + 1)
    row = steps.copy()
    for i, x in enumerate(item[::-1]):
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[:-1] + (back != x), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - steps) + steps
    return edits, stop - int(row.argmin()), stop


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for first, last, hashes, bounds, _, _ in word_slices(batch.column(1), plain=True):
            for i in range(first, last):
                words = hashes[bounds[i - first] : bounds[i - first + 1]]
                if len(words) < LEAST_WORDS:
                    continue
                count = -(-len(words) // PART)
                cuts = np.linspace(0, len(words), count + 1).astype(int)
                for k in range(count):
                    part = words[cuts[k] : cuts[k + 1]]
                    keys = walk_keys(part[None, :])[0].view(np.int64)
                    pairs = _pairs(part).view(np.int64)
                    out.append((ids[i], k, len(part), part.tobytes(), keys.tolist(), pairs.tolist(), len(np.unique(pairs))))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32())
        yield pa.record_batch([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in _PART.split(", ")])


def _pair_table(items: DataFrame, expected: int) -> np.ndarray:
    """For each slot that pairs of words fall to, the sizes of their parts: bit n - 1 for n words."""
    slots = 1 << 12
    while slots < min(16 * expected, MOST_SLOTS):
        slots <<= 1
    rows = (
        items.select("n", F.explode("pairs").alias("pair"))
        .select(F.col("pair").bitwiseAND(slots - 1).alias("slot"), F.expr("shiftleft(1L, n - 1)").alias("size"))
        .groupBy("slot")
        .agg(F.bit_or("size").alias("sizes"))
        .toArrow()
    )
    table = np.zeros(slots, dtype=np.uint64)
    table[rows["slot"].to_numpy()] = rows["sizes"].to_numpy().view(np.uint64)
    return table


def window_starts(at: np.ndarray, n: int, bounds: np.ndarray) -> np.ndarray:
    """Where windows of n words begin that hold enough of the pairs ``at``, in texts bounded by ``bounds``."""
    k, least = _needed(n), n - _allowed(n)
    if len(at) < k:
        return at[:0]
    first, last = at[: len(at) - k + 1], at[k - 1 :]
    near = last - first <= n - 2
    first, last = first[near], last[near]
    text = np.searchsorted(bounds, first, side="right") - 1
    low, high = np.maximum(last - (n - 2), bounds[text]), np.minimum(first, bounds[text + 1] - least)
    good = (low <= high) & (last < bounds[text + 1])
    sizes = (high - low + 1)[good]
    ends = np.cumsum(sizes)
    starts = np.unique(np.arange(ends[-1] if len(ends) else 0) + np.repeat(low[good] - (ends - sizes), sizes))
    return starts


def _different(pairs: np.ndarray) -> np.ndarray:
    """The number of different values but zero in each row."""
    pairs = np.sort(pairs, axis=1)
    return np.count_nonzero(pairs[:, 1:] != pairs[:, :-1], axis=1) + (pairs[:, 0] != 0)


def _windows(sizes: dict[int, int], table: np.ndarray, key_filter: BitFilter):
    """Windows that may match, one row for each key that a part may have; ``sizes`` has the least number of different
    pairs in a part of that many words, which keeps out lines that repeat a frequent pair."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    names = [x.split()[0] for x in _WINDOW.split(", ")]

    def in_slice(words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        pairs = _pairs(words)
        of_pair = table[pairs & np.uint64(len(table) - 1)]
        ends = bounds[1:][bounds[1:] < len(words)]
        of_pair[ends[ends > 0] - 1] = 0  # not across two texts
        places = np.flatnonzero(of_pair)
        every, of_pair = of_pair, of_pair[places]
        for n, different in sizes.items():
            starts = window_starts(places[(of_pair >> np.uint64(n - 1)) & np.uint64(1) == 1], n, bounds)
            for a in range(0, len(starts), BLOCK):
                some = starts[a : a + BLOCK]
                stop = bounds[np.searchsorted(bounds, some, side="right")]
                cells = some[:, None] + np.arange(n)[None, :]
                inside = cells < stop[:, None]
                at = np.minimum(cells[:, : n - 1], len(pairs) - 1)
                own = inside[:, 1:] & ((every[at] >> np.uint64(n - 1)) & np.uint64(1) == 1)
                rich = _different(np.where(own, pairs[at] | np.uint64(1), np.uint64(0))) >= max(1, different - 2 * _allowed(n))
                if not rich.any():
                    continue
                some, stop, cells, inside = some[rich], stop[rich], cells[rich], inside[rich]
                keys = walk_keys(np.where(inside, words[np.minimum(cells, len(words) - 1)], np.uint64(0)))
                passed = key_filter.passes(keys.reshape(-1)).reshape(keys.shape)
                for w, r in zip(*np.nonzero(passed), strict=True):
                    yield n, int(some[w]), int(stop[w]), int(keys[w, r])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids, out = batch.column(0).to_pylist(), []
            for first, _, words, bounds, _, _ in word_slices(batch.column(1), plain=True):
                if len(words) < 2:
                    continue
                for n, start, stop, key in in_slice(words, bounds):
                    text = int(np.searchsorted(bounds, start, side="right")) - 1
                    begin = max(int(bounds[text]), start - n)
                    around = words[begin : min(stop, begin + 3 * n)]  # the same for all windows of one begin
                    out.append((key - (key >> 63 << 64), ids[first + text], begin - int(bounds[text]), n, around.tobytes()))
                    if len(out) == BLOCK:
                        yield pa.record_batch([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=names)
                        out = []
            yield pa.record_batch([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=names)

    return run


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, begin, text, item_id, part, item in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
            item = np.frombuffer(item, dtype=np.uint64)
            edits, start, stop = passage_distance(item, np.frombuffer(text, dtype=np.uint64))
            if edits <= _allowed(len(item)):
                out.append((doc_id, item_id, part, begin + start, begin + stop, len(item), edits, 1 - edits / len(item)))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
        yield pa.record_batch([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in _MATCH.split(", ")])


def _run_keys(words: np.ndarray, n: int) -> np.ndarray:
    return mix(shingles(words, n) + np.uint64(n))


def _short_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for first, last, hashes, bounds, _, _ in word_slices(batch.column(1), plain=True):
            for i in range(first, last):
                words = hashes[bounds[i - first] : bounds[i - first + 1]]
                if 0 < len(words) < LEAST_WORDS:
                    out.append((ids[i], len(words), int(_run_keys(words, len(words)).view(np.int64)[0])))
        kinds = (pa.int64(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=["item_id", "n", "key"])


def _runs(sizes: list[int], key_filter: BitFilter):
    """The runs of words that may be a short item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, words, bounds, _, _ in word_slices(batch.column(1), plain=True):
                for n in sizes:
                    keys = _run_keys(words, n)
                    at = np.flatnonzero(key_filter.passes(keys))
                    text = np.searchsorted(bounds, at, side="right") - 1
                    inside = at + n <= bounds[text + 1]  # not across two texts
                    at, text = at[inside], text[inside]
                    columns = [pa.array(keys[at].view(np.int64)), pa.array(np.full(len(at), n, dtype=np.int32)), pa.array(ids[first + text].astype(np.int64)), pa.array((at - bounds[text]).astype(np.int64))]
                    yield pa.record_batch(columns, names=["key", "n", "doc_id", "start"])

    return run


def _exact(texts: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """The matches of items of fewer than ``LEAST_WORDS`` words."""
    items, seen = scratch.save_measured(asked.mapInArrow(_short_of, _SHORT), n=F.count("*"), sizes=F.collect_set("n"))
    if not seen["n"]:
        return texts.sparkSession.createDataFrame([], _MATCH)
    runs = texts.mapInArrow(_runs(sorted(seen["sizes"]), BitFilter.of(items, "key", seen["n"])), _RUN)
    met = runs.join(items, ["key", "n"])
    return met.selectExpr("doc_id", "item_id", "0 AS part", "start", "start + n AS stop", "n AS n_words", "0 AS edits", "1D AS similarity").distinct()


def _near(texts: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """The matches of items of ``LEAST_WORDS`` words at least."""
    items = asked.mapInArrow(_parts_of, _PART)
    items, seen = scratch.save_measured(items, n=F.count("*"), keys=F.coalesce(F.sum(F.size("keys")), F.lit(0)), pairs=F.coalesce(F.sum(F.size("pairs")), F.lit(0)))
    if not seen["n"]:
        return texts.sparkSession.createDataFrame([], _MATCH)
    sizes = {r.n: r.different for r in items.groupBy("n").agg(F.min("different").alias("different")).orderBy("n").collect()}
    table = _pair_table(items, seen["pairs"])
    key_filter = BitFilter.of(items.select(F.explode("keys").alias("key")), "key", seen["keys"])
    windows = texts.mapInArrow(_windows(sizes, table, key_filter), _WINDOW)
    keyed = items.select(F.explode(F.array_distinct("keys")).alias("key"), "n", "item_id", "part", F.col("words").alias("item_words"))
    met = windows.join(keyed, ["key", "n"])
    # Windows of one document that lie within half a part of each other meet the same passage: the first stands for them.
    nearby = ["doc_id", "item_id", "part", F.expr("CAST(start DIV greatest(n DIV 2, 1) AS int)").alias("near")]
    first = met.groupBy(*nearby).agg(F.min(F.struct("start", "words", "item_words")).alias("w"))
    asked = first.select("doc_id", F.col("w.start"), F.col("w.words"), "item_id", "part", F.col("w.item_words"))
    return asked.mapInArrow(_judge, _MATCH).distinct()


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, part, start, stop, n_words, edits, similarity)``: places in words of each part in each document."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    asked = benchmark.select(F.col(item_id).cast("long"), F.col(item_text).cast("string"))
    return _near(texts, asked, scratch).union(_exact(texts, asked, scratch))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark passage; columns stay as they are."""
    matched = free_name(docs, "matched")
    found = matches(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(matched)).distinct()
    return docs.join(found, F.col(f"`{id_col}`").cast("long") == F.col(matched), "left_anti")
