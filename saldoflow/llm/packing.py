"""Documents packed into training sequences by first-fit decreasing.

Every document becomes its token ids and an end id, cut into pieces of at most one sequence: full sequences and a
rest. The pieces are dealt at random to groups of about ``GROUP_PIECES`` and each group is packed on its own: pieces
in order of falling length go to the first bin with room, which a tournament tree over the room left in the bins finds
in logarithmic time. A group is bounded, whatever a document's length, because pieces are dealt, not documents.

A null or empty text is a document of the end id alone. Repeated rows are packed as often as they occur. A null id
stays null. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import Scratch
from saldoflow.llm.tokens import WordTokenizer, vocabulary_path
from saldoflow.llm.words import mix

SEQUENCE, END_ID = 2048, 1
GROUP_PIECES = 8192

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ROWS = 1 << 14


def _pieces(vocabulary: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(vocabulary)
        seen = 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.ids(batch.column(1)), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                seen += 1
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    rows.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids), (doc_id or 0) ^ (seen << 40) ^ (start << 20)))
                    if len(rows) == _ROWS:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:-1]]
    dealt = mix(np.array([x[-1] & 0xFFFFFFFFFFFFFFFF for x in rows], dtype=np.uint64)).view(np.int64)
    return pa.record_batch([*columns, pa.array(dealt)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"])


def first_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must fall. Bins are numbered as they are opened."""
    leaves = 1 << max(0, int(len(lengths) - 1).bit_length())
    room = [size] * (2 * leaves)  # node i has the larger room of nodes 2i and 2i + 1
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for k, length in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins[k], offsets[k] = node - leaves, size - room[node]
        room[node] -= length
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return np.array(bins, dtype=np.int64), np.array(offsets, dtype=np.int64)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    size: int = SEQUENCE, end_id: int = END_ID, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row for each piece: its document, place and length there, and the sequence and offset it is packed at.

    ``vocabulary`` is the path of a tokenizer file that every executor can open.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces, seen = scratch.save_measured(texts.mapInArrow(_pieces(vocabulary or vocabulary_path(), size, end_id), _PIECE), n=F.count("*"))
    groups = max(1, -(-seen["n"] // group_pieces))

    def packed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "deal", "doc_id", "start"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit(group["length"].to_numpy(), size)
        return group.assign(sequence_id=bins + (key[0] << 32), offset=offsets)[[x.split()[0] for x in _PACKED.split(", ")]]

    dealt = pieces.withColumn("pack_group", F.pmod("deal", F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(packed, _PACKED)
