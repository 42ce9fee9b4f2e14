"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's input. All
stages but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saldoflow.llm import decontaminate, langid, minhash, packing, pii
from saldoflow.llm.scratch import Scratch

# Near copies share at least so many per cent of their word shingles; op3's own contract is 85.
LEAST_SIMILARITY = 80
# A text is rejected if it has no letter or if neither its family nor its language is at all likely.
LEAST_LANGUAGE_SCORE = 0.01


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told."""
    machines = langid.train(docs.where(~langid.held_out()))
    return langid.only_identified(docs, machines, LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least id."""
    return minhash.keep_one(docs, threshold=LEAST_SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` brought up to date."""
    return pii.redact(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

# No SQL form: language identification is learned, and token ids come from a vocabulary file.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
