"""Token ids of whole texts from a vocabulary file.

A tokenizer whose tokens never span white space gives a text the ids of its words (runs between ASCII white space) one after the other. So only
the different words of a slice of texts are encoded, and a memory of words already seen serves the rest. The memory is
emptied when it reaches ``REMEMBERED`` words; that changes the time, not the ids. Other tokenizers read each text as a whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from saldoflow.llm.words import buffers, word_slices

REMEMBERED = 1 << 20
JOINED = 512
TEXTS = 64
DEFAULT_VOCABULARY = "word_bpe_49k.json"

_open: dict[str, WordTokenizer | TextTokenizer] = {}


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._encode = (tokenizer := Tokenizer.from_file(path)).encode_batch_fast
        # A special token between words keeps them apart: it is cut out before anything else is done to the text.
        self._mark_id, self._mark = min((i, t.content) for i, t in tokenizer.get_added_tokens_decoder().items())
        self._forget()

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """One instance for each Python worker."""
        if path not in _open:
            _open[path] = cls(path)
        return _open[path]

    def _forget(self) -> None:
        self._slots: dict[int, int] = {}
        self._sizes = np.zeros(1 << 12, dtype=np.int64)
        self._begins = np.zeros(1 << 12, dtype=np.int64)
        self._flat = np.zeros(1 << 14, dtype=np.uint32)
        self._used = 0

    def _ids_of(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words one after the other, and their number for each word."""
        mark = np.frombuffer(self._mark.encode(), dtype=np.uint8)
        sizes = end - begin + len(mark)
        ends = np.cumsum(sizes)
        joined = np.empty(int(ends[-1]), dtype=np.uint8)
        source = np.arange(len(joined)) + np.repeat(begin - (ends - sizes), sizes)
        inside = np.arange(len(joined)) < np.repeat(ends - len(mark), sizes)
        joined[inside] = data[source[inside]]
        joined[~inside] = np.tile(mark, len(begin))
        cuts = [0, *ends[JOINED - 1 :: JOINED].tolist()]
        if cuts[-1] != len(joined):
            cuts.append(len(joined))
        texts = [joined[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in self._encode(texts, add_special_tokens=False)])
        marks = np.flatnonzero(ids == self._mark_id)
        return ids[ids != self._mark_id], np.diff(marks, prepend=-1) - 1

    def _learn(self, data: np.ndarray, hashes: list[int], begin: np.ndarray, end: np.ndarray) -> None:
        ids, sizes = self._ids_of(data, begin, end)
        if len(sizes) != len(hashes):  # a word holds the mark itself: one by one
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begin, end, strict=True)]
            found = [x.ids for x in self._encode(texts, add_special_tokens=False)]
            ids, sizes = np.array([i for x in found for i in x], dtype=np.uint32), np.array([len(x) for x in found])
        n = len(self._slots)
        while n + len(sizes) > len(self._sizes):
            self._sizes, self._begins = np.append(self._sizes, self._sizes), np.append(self._begins, self._begins)
        while self._used + len(ids) > len(self._flat):
            self._flat = np.append(self._flat, self._flat)
        self._flat[self._used : self._used + len(ids)] = ids
        self._sizes[n : n + len(sizes)] = sizes
        self._begins[n : n + len(sizes)] = self._used + np.cumsum(sizes) - sizes
        self._used += len(ids)
        self._slots.update(zip(hashes, range(n, n + len(sizes)), strict=True))

    def _slots_of(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self._slots) > REMEMBERED:
            self._forget()
        different, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        keys = different.tolist()
        slots = np.fromiter(map(self._slots.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            n, at = len(self._slots), first[unknown]
            self._learn(data, different[unknown].tolist(), begin[at], end[at])
            slots[unknown] = np.arange(n, n + len(unknown))
        return slots[inverse]

    def _slices(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        data, offsets = buffers(texts)
        for first, last, hashes, bounds, starts, ends in word_slices(texts, fold=False):
            shift = np.repeat(offsets[first:last], np.diff(bounds))
            yield first, last, bounds, self._slots_of(hashes, data, starts + shift, ends + shift)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of every text; a null has none."""
        out = np.zeros(len(texts), dtype=np.int64)
        for first, last, bounds, slots in self._slices(texts):
            sums = np.concatenate([[0], np.cumsum(self._sizes[slots])])
            out[first:last] = np.diff(sums[bounds])
        return out

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of one text after the other."""
        for first, last, bounds, slots in self._slices(texts):
            sizes = self._sizes[slots]
            sums = np.concatenate([[0], np.cumsum(sizes)])
            at = np.arange(sums[-1]) + np.repeat(self._begins[slots] - sums[:-1], sizes)
            ids = self._flat[at]
            for i in range(last - first):
                yield ids[sums[bounds[i]] : sums[bounds[i + 1]]]


class TextTokenizer:
    """A tokenizer whose tokens may hold white space; every text is encoded as a whole, a few texts at a time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of every text; a null has none."""
        out = []
        for at in range(0, len(texts), TEXTS):
            part = [x or "" for x in texts.slice(at, TEXTS).to_pylist()]
            out += [len(x.ids) for x in self._tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return np.array(out, dtype=np.int64)


def counter(path: str) -> WordTokenizer | TextTokenizer:
    """The tokenizer for counts, one for each Python worker: by words if the file marks the ends of words."""
    if path not in _open:
        with open(path, encoding="utf-8") as file:
            by_word = bool(json.load(file)["model"].get("end_of_word_suffix"))
        _open[path] = WordTokenizer(path) if by_word else TextTokenizer(path)
    return _open[path]
