"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A ledger folder holds one folder for each committed batch with that batch's additive changes, already summed:
``(source, lang, tokenizer, docs, tokens)``. An inserted document adds its count, a deleted one takes it away, and a
revised one adds the new count less the old. Totals are the sum over batches, so they never need the documents again.

A batch is committed by writing it to a hidden folder and renaming that to its final name, which happens once: a
batch id that is already there is left as it is, so a repeated commit changes nothing, and a run that dies before the
rename leaves nothing that readers see. The order of batches does not matter. ``compact`` folds all committed batches
into one snapshot that remembers their ids.

A null or empty text has no tokens but counts as a document. Null sources and languages are groups of their own.
Repeated rows count as often as they occur. Extra columns are ignored. Groups whose documents are all gone leave the
totals. Sums are partial before they are shuffled, so a source may hold any share of the rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.llm.tokens import DEFAULT_VOCABULARY, counter, vocabulary_path  # noqa: F401

KEYS = ("source", "lang", "tokenizer")
CHANGES = "source string, lang string, tokenizer string, docs long, tokens long"
_BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _counter(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = counter(vocabulary)
        for batch in batches:
            counts = pa.array(tokenizer.counts(batch.column(0)), pa.int64())
            yield pa.record_batch([*batch.columns[1:], counts], names=["doc_id", "source", "lang", "n_tokens"])

    return run


def counted(
    docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """``(doc_id, source, lang, n_tokens)`` of every row; only counts leave the tasks."""
    texts = docs.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    return texts.mapInArrow(_counter(vocabulary or vocabulary_path()), "doc_id long, source string, lang string, n_tokens long")


def changes(counts: DataFrame, sign: int | Column, tokenizer: str) -> DataFrame:
    """Changes for documents with their counts: sign 1 inserts them, -1 deletes them."""
    sign = F.lit(sign) if isinstance(sign, int) else sign
    return counts.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), sign.cast("long").alias("docs"), (sign * F.col("n_tokens")).cast("long").alias("tokens"))


def revisions(before: DataFrame, after: DataFrame, tokenizer: str, new_tokenizer: str | None = None) -> DataFrame:
    """Changes for documents whose text, source, language or tokenizer was replaced: the old counts go, the new ones come."""
    return changes(before, -1, tokenizer).union(changes(after, 1, new_tokenizer or tokenizer))


class Ledger:
    """Committed batches below ``folder``, in any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._path(self.folder))

    def batches(self) -> list[str]:
        """Ids of the committed batches not yet folded into a snapshot."""
        found = self._files.listStatus(self._path(self.folder))
        return sorted(n.removeprefix("batch-") for n in (s.getPath().getName() for s in found) if n.startswith("batch-"))

    def _snapshots(self) -> list[int]:
        found = self._files.listStatus(self._path(self.folder))
        return sorted(int(n.removeprefix("snapshot-")) for n in (s.getPath().getName() for s in found) if n.startswith("snapshot-"))

    def _folded(self) -> list[str]:
        snapshots = self._snapshots()
        if not snapshots:
            return []
        rows = self.spark.read.parquet(f"{self.folder}/snapshot-{snapshots[-1]}/ids").collect()
        return [r.batch_id for r in rows]

    def _publish(self, hidden: str, name: str) -> bool:
        """One rename makes the folder visible; false if another run was first."""
        target = self._path(f"{self.folder}/{name}")
        done = not self._files.exists(target) and self._files.rename(self._path(hidden), target)
        if not done:
            self._files.delete(self._path(hidden), True)
        return done

    def commit(self, batch_id: str, change: DataFrame) -> bool:
        """Adds a batch once; returns whether this call added it."""
        if not _BATCH_ID.fullmatch(batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        if self._files.exists(self._path(f"{self.folder}/batch-{batch_id}")) or batch_id in self._folded():
            return False
        hidden = f"{self.folder}/_pending-{batch_id}-{self.spark.sparkContext.applicationId}"
        summed = change.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        summed.write.mode("overwrite").parquet(hidden)
        return self._publish(hidden, f"batch-{batch_id}")

    def _changes(self, batches: list[str]) -> DataFrame:
        paths = [f"{self.folder}/batch-{b}" for b in batches]
        snapshots = self._snapshots()
        if snapshots:
            paths.append(f"{self.folder}/snapshot-{snapshots[-1]}/totals")
        read = self.spark.read.schema(CHANGES)
        return read.parquet(*paths) if paths else self.spark.createDataFrame([], CHANGES)

    def _sum(self, batches: list[str]) -> DataFrame:
        totals = self._changes(batches).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return totals.where("docs <> 0 OR tokens <> 0")

    def _open_batches(self) -> list[str]:
        folded = set(self._folded())
        return [b for b in self.batches() if b not in folded]

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens)`` over everything committed."""
        return self._sum(self._open_batches())

    def compact(self) -> None:
        """Folds the committed batches into a snapshot; their folders go once it is visible."""
        batches, number = self._open_batches(), max(self._snapshots(), default=0) + 1
        ids = sorted({*self._folded(), *batches})
        hidden = f"{self.folder}/_pending-snapshot-{number}-{uuid.uuid4().hex}"
        self._sum(batches).write.mode("overwrite").parquet(f"{hidden}/totals")
        self.spark.createDataFrame([(i,) for i in ids], "batch_id string").write.mode("overwrite").parquet(f"{hidden}/ids")
        if self._publish(hidden, f"snapshot-{number}"):
            for b in batches:
                self._files.delete(self._path(f"{self.folder}/batch-{b}"), True)
