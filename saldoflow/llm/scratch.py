"""Tables that cut lineage, and bit filters of a fixed size, for jobs of several steps."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saldoflow.session import shared_folder

# The largest bit filter: 16 MB, however large the input is. A fuller filter lets more rows pass, never fewer.
MAX_FILTER_BITS = 1 << 27


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    """Writes intermediate results as Parquet below the shared folder and reads them back."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self) -> str:
        self._count += 1
        return f"{self.folder}/{self._count}"

    def save(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_measured(self, df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        """Also returns aggregates of the written rows, taken while writing."""
        seen = Observation()
        saved = self.save(df.observe(seen, *[m.alias(k) for k, m in measures.items()]))
        return saved, seen.get


class BitFilter:
    """A Bloom filter with two bits a key over keys that are already well mixed 64-bit hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, keys: DataFrame, key: str, expected: int) -> BitFilter:
        """The distributed part ors the bits of a word together, so at most ``MAX_FILTER_BITS / 64`` rows are collected."""
        bits = 1 << 16
        while bits < min(16 * expected, MAX_FILTER_BITS):
            bits <<= 1
        at = F.explode(F.array(F.col(key).bitwiseAND(bits - 1), F.shiftrightunsigned(key, 33).bitwiseAND(bits - 1)))
        rows = (
            keys.select(at.alias("at"))
            .selectExpr("shiftright(at, 6) AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit")
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .toArrow()
        )
        words = np.zeros(bits >> 6, dtype=np.uint64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(words)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        """True for every key that was put in, and for few others."""
        keys = keys.view(np.uint64)
        mask = np.uint64((len(self.words) << 6) - 1)
        found = np.ones(len(keys), dtype=bool)
        for at in (keys & mask, (keys >> np.uint64(33)) & mask):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found
