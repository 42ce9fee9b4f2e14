"""Groups of spelling variants: words of a corpus that differ by one letter, and the frequent form each one goes back to.

A word is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased. The words that count have at least ``MIN_LENGTH``
letters and ``MIN_COUNT`` occurrences. Two words are near if they differ by one inserted, deleted or replaced letter.

* Occurrences are counted where they are read; one row for each word and task is shuffled.
* The vocabulary becomes blocked Bloom filters, one for each length (``LONGEST`` and above share one). All filters together have at most ``MAX_BITS`` bits,
  whatever the vocabulary, so they can be broadcast. A fuller filter lets more edits pass, never fewer.
* Each word's edits are probed as hashes; no text is built before a filter says yes. A pair is generated from one side only: the longer word
  deletes a letter, or the word with the smaller letter replaces it by a larger one. Only edits that pass are shuffled, to an exact join with
  the vocabulary, which removes false positives.
* A word's form is its near word with most occurrences, ties to the first in code-point order, if it occurs at least ``FORM_FACTOR`` times as
  often. Counts grow tenfold along a chain of forms, so chains have fewer than twenty links and are closed in five rounds at most.

A null or empty text has no words; a null id counts as an empty one (ids matter only to ``planted``). Repeated rows are counted each. An empty table gives no
rows. Texts of any length are read whole; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import Scratch
from saldoflow.llm.words import mix

MIN_LENGTH, MIN_COUNT = 7, 2
FORM_FACTOR = 10
LETTERS = "A-Za-zÀ-ÿ"
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.uint32)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of this length and longer share a filter.
LONGEST = 64
# A block has eight lanes of 64 bits; a key sets one bit in each.
LANES, BITS_PER_KEY = 8, 16
MAX_BITS = 1 << 28

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LANE_SALTS = np.array([0x47B6137B44974D91, 0x8824AD5BA2B7289D, 0x705495C72DF1424B, 0x9EFC49475C6BFB31, 0x5C6BFB319EFC4947, 0x2DF1424B705495C7, 0xA2B7289D8824AD5B, 0x44974D9147B6137B], dtype=np.uint64)


def lowered(run: Column) -> Column:
    """A-Z as a-z; other letters stay. Runs of ASCII letters, nearly all, take the short way."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``(id, word)`` for every run of at least ``min_length`` letters."""
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"[{LETTERS}]{{{min_length},}}+"), F.lit(0))
    found = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    return found.select("id", lowered(F.col("run")).alias("word"))


def planted(words: DataFrame, every: int = 31) -> DataFrame:
    """The occurrences with one letter left out wherever the checksum of ``id:word`` is a multiple of ``every``."""
    check = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
    marked = words.select("word", check.alias("h"), F.char_length("word").alias("length"))
    at = F.pmod("h", "length").cast("int")
    shorter = F.concat(F.left("word", at), F.substring("word", at + 2, F.col("length")))
    return marked.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""
    long_enough = words.where(F.char_length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yields (rows, code points) for the words of each length."""
    texts = words.to_pylist()
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, np.array([texts[r] for r in rows], dtype=f"<U{length}").view("<u4").reshape(len(rows), int(length))


def _powers(length: int) -> np.ndarray:
    up = np.full(length, _BASE)
    up[0] = 1
    return np.cumprod(up)


def _sums(points: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, .. letters of each word as a polynomial modulo 2**64."""
    terms = points.astype(np.uint64) * _powers(points.shape[1])
    return np.concatenate([np.zeros((len(points), 1), dtype=np.uint64), np.cumsum(terms, axis=1)], axis=1)


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64)))


def _shard(length: int) -> int:
    return min(int(length), LONGEST)


class LengthFilters:
    """Blocked Bloom filters side by side, one for each length."""

    def __init__(self, starts: dict[int, int], blocks: dict[int, int], lanes: np.ndarray | None = None):
        self.starts, self.blocks, self.lanes = starts, blocks, lanes

    @classmethod
    def sized(cls, counts: dict[int, int]) -> LengthFilters:
        """Room for so many keys of each length, in powers of two and within ``MAX_BITS`` in all."""
        whole = sum(counts.values())
        starts, blocks, at = {}, {}, 0
        for shard, n in sorted(counts.items()):
            wanted = min(n * BITS_PER_KEY, MAX_BITS // 2 * n // whole)
            size = 1
            while size * LANES * 64 < wanted:
                size <<= 1
            starts[shard], blocks[shard] = at, size
            at += size * LANES
        return cls(starts, blocks)

    def _first_lane(self, keys: np.ndarray, shard: int) -> np.ndarray:
        return self.starts[shard] + (keys & np.uint64(self.blocks[shard] - 1)).astype(np.int64) * LANES

    @staticmethod
    def _bit(keys: np.ndarray, lane: int) -> np.ndarray:
        return np.uint64(1) << ((keys * _LANE_SALTS[lane]) >> np.uint64(58))

    def rows_of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lanes that words set, each once a batch."""
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for _, points in _by_length(batch.column(0)):
                length = points.shape[1]
                keys = _key(_sums(points)[:, -1], length)
                first = self._first_lane(keys, _shard(length))
                found += [(first + lane, self._bit(keys, lane)) for lane in range(LANES)]
            if found:
                at, bits = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                order = np.argsort(at, kind="stable")
                at, bits = at[order], bits[order]
                begins = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
                ored = np.bitwise_or.reduceat(bits, begins)
                yield pa.record_batch([pa.array(at[begins]), pa.array(ored.view(np.int64))], names=["at", "bits"])

    def filled(self, words: DataFrame) -> LengthFilters:
        """The filters of all words; at most ``MAX_BITS / 64`` rows come to the driver."""
        rows = words.select("word").mapInArrow(self.rows_of, "at long, bits long")
        table = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
        lanes = np.zeros(LANES * sum(self.blocks.values()), dtype=np.uint64)
        lanes[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
        return LengthFilters(self.starts, self.blocks, lanes)

    def passing(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Indices of the keys that may belong to a word of this length."""
        shard = _shard(length)
        if shard not in self.starts:
            return np.zeros(0, dtype=np.int64)
        left, first = np.arange(len(keys)), self._first_lane(keys, shard)
        for lane in range(LANES):
            bit = self._bit(keys[left], lane)
            left = left[self.lanes[first[left] + lane] & bit != 0]
        return left


def _edits(points: np.ndarray, filters: LengthFilters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yields (rows, code points) of the edits of words of one length that pass the filters."""
    length = points.shape[1]
    sums, up = _sums(points), _powers(length)
    # Of a letter that stands twice or more in a row only the first is deleted: the others give the same word.
    distinct = np.ones(points.shape, dtype=bool)
    distinct[:, 1:] = points[:, 1:] != points[:, :-1]
    row, at = np.nonzero(distinct)
    hashes = sums[row, at] + (sums[row, -1] - sums[row, at + 1]) * _BASE_INVERSE
    kept = filters.passing(_key(hashes, length - 1), length - 1) if length > 1 else np.zeros(0, dtype=np.int64)
    if len(kept):
        stay = np.arange(length)[None, :] != at[kept][:, None]
        yield row[kept], points[row[kept]][stay].reshape(len(kept), length - 1)
    for letter in ALPHABET:
        row, at = np.nonzero(points < letter)
        step = (np.uint64(letter) - points[row, at].astype(np.uint64)) * up[at]
        kept = filters.passing(_key(sums[row, -1] + step, length), length)
        if len(kept):
            changed = points[row[kept]]
            changed[np.arange(len(kept)), at[kept]] = letter
            yield row[kept], changed


def _prober(filters: LengthFilters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, points in _by_length(batch.column(0)):
                for picked, changed in _edits(np.ascontiguousarray(points), filters):
                    near = np.ascontiguousarray(changed).view(f"<U{changed.shape[1]}").reshape(-1)
                    taken = batch.take(pa.array(rows[picked]))
                    yield pa.record_batch([taken.column(0), taken.column(1), pa.array(near.tolist(), pa.string())], names=["word", "n", "edit"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)`` once for every pair of near words of a saved vocabulary ``(word, n)``."""
    spark = words.sparkSession
    shard = F.least(F.char_length("word"), F.lit(LONGEST)).alias("shard")
    counts = {r.shard: r.n for r in words.groupBy(shard).agg(F.count("*").alias("n")).collect()}  # one row for each length
    filters = LengthFilters.sized(counts).filled(words)
    # Probing costs far more than its few bytes tell, so the words are dealt over all tasks.
    dealt = words.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    edits = dealt.select("word", "n").mapInArrow(_prober(filters), "word string, n long, edit string")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return edits.join(known, edits["edit"] == known["near"]).select("word", "n", "near", "near_n")


def variants(words: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of a vocabulary ``(word, n)``."""
    scratch = scratch or Scratch(words.sparkSession, "spelling")
    words = scratch.save(words.select("word", "n"))
    pairs = near_pairs(words)
    link = lambda word, other, n: F.struct(F.col(word).alias("word"), F.col(other).alias("other"), F.col(n).alias("other_n"))
    sides = F.array(link("word", "near", "near_n"), link("near", "word", "n"))
    links = pairs.select(F.inline(sides)).select("word", F.lit(None).cast("long").alias("n"), "other", "other_n")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), "other")))
    found = alone.unionByName(links).groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    found = found.select("word", "n", "n_near", F.when(form_n >= FORM_FACTOR * F.col("n"), F.struct(F.col("best.other").alias("form"), form_n.alias("form_n"))).alias("to"))
    found = scratch.save(found.select("word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.form_n").alias("form_n")))
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"), scratch)
    joined = found.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)``: the end of the chain of forms; each round doubles the links followed."""
    reached = scratch.save(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        step, seen = scratch.save_measured(step, moved=F.count_if("moved"))
        reached = step.select("word", "root")
        if not seen["moved"]:
            return reached
