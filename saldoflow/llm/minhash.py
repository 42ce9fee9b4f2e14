"""Near-duplicate documents by bottom-k sketches from one hash function.

1. Every document becomes the set of its word shingles. Documents with equal sets form one class, which takes part once.
2. The ``SKETCH`` least shingle hashes of a set are its sketch. Each ``RUN`` neighbours among the ``LISTED`` least values
   put the set in an inverted list. Sets of similarity J share a list unless no run of that many neighbours in the
   order of their union lies in both; at J = 0.85 that has a probability of 1e-8. Single values would list far more
   sets that merely share a passage.
3. Short lists give all their pairs, long lists give a star around their least member. The bottom-k sketch of the union
   of both sets, estimated from both sketches, drops pairs that are 6.5 standard deviations below the threshold.
4. The rest is verified on full sets, and verified links are contracted to components.
5. Long lists with members of several components can hide links. Their members are clustered by the pairs of the stars with
   an estimated similarity of ``LOOSE`` at least; each cluster is cut into blocks of bounded size, and a task compares the full sets of two blocks and returns
   a spanning forest of the links, so that a group of near copies never becomes a list of pairs. Members of one list
   in different clusters and components are compared by their sketches in the same way: a task returns a spanning forest
   of the pairs that may reach the threshold. The components of these forests over all lists are clusters again, whose
   full sets are compared block against block. No list is capped, and no task returns more edges than it has members.
   Forests are stars around least members: only their components count, and lists with the same members give the same edges.

Rows are nodes, so repeated ids are allowed. A document without words (or with null text) has no shingles and links
with nothing. A null id keeps its row; it never becomes the id of a component that has another. Extra columns are
ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.components import components
from saldoflow.llm.scratch import BitFilter, Scratch, free_name
from saldoflow.llm.words import mix, shingle_slices

SKETCH, LISTED, RUN = 64, 42, 3
SHORT_LIST = 8
LOOSE = 35  # per cent
# A task holds two blocks: at most about 70 MB, besides sets that are larger than a block.
BLOCK_SETS, BLOCK_SHINGLES, COLUMNS, ROWS = 512, 1 << 18, 1024, 128
LEAST_SIMILARITY = 85  # per cent

_SIGNATURE = "doc_id long, n_shingles long, sid binary, sketch array<long>, place long"


def _set_of(grams: np.ndarray) -> np.ndarray:
    values = np.sort(grams.view(np.int64))
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _sid(values: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    x = values.view(np.uint64)
    two = mix(x + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64), mix(x ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return int(two[0]).to_bytes(8, "big") + int(two[1]).to_bytes(8, "big")


def _place(ids: pa.Array) -> np.ndarray:
    return mix(ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, sids, sketches = [], [], []
        for _, grams in shingle_slices(batch.column(1)):
            values = _set_of(grams)
            counts.append(len(values))
            sids.append(_sid(values))
            sketches.append(values[:SKETCH].copy())
        ends = np.cumsum([0, *map(len, sketches)], dtype=np.int32)
        flat = pa.array(np.concatenate(sketches) if sketches else np.zeros(0, dtype=np.int64))
        yield pa.record_batch(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(sids, pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(_place(batch.column(0)))],
            names=["doc_id", "n_shingles", "sid", "sketch", "place"],
        )


def _sets_of_some(places: BitFilter):
    """The full sets of documents that pass the filter, a little at a time."""

    def batch_of(sids: list[bytes], sets: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.cumsum([0, *map(len, sets)], dtype=np.int32))
        flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64))
        return pa.record_batch([pa.array(sids, pa.binary()), pa.ListArray.from_arrays(ends, flat)], names=["sid", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(places.passes(_place(batch.column(0)))))
            sids, sets, size = [], [], 0
            for _, grams in shingle_slices(batch.column(1)):
                values = _set_of(grams)
                if not len(values):
                    continue
                sids.append(_sid(values))
                sets.append(values)
                size += len(values)
                if size > 1 << 19:
                    yield batch_of(sids, sets)
                    sids, sets, size = [], [], 0
            yield batch_of(sids, sets)

    return run


def _keys_of(sketch: np.ndarray) -> np.ndarray:
    """One key for each run of neighbours among the least values; a set with fewer values has one key."""
    x = sketch[:LISTED].view(np.uint64)
    run = min(RUN, len(x))
    total = np.full(len(x) - run + 1, run, dtype=np.uint64)
    for k in range(run):
        total = total * np.uint64(0xA0761D6478BD642F) + x[k : len(x) - run + 1 + k]
    return mix(total)


def _listing(repeated: BitFilter | None):
    """``(key)`` of all sets, or ``(key, sid)`` where the filter passes the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = batch.column(1)
            keys = [_keys_of(x.values.to_numpy()) for x in sketches] or [np.zeros(0, dtype=np.uint64)]
            owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            keys = np.concatenate(keys)
            if repeated is None:
                yield pa.record_batch([pa.array(keys.view(np.int64))], names=["key"])
                continue
            kept = np.flatnonzero(repeated.passes(keys))
            sids = batch.column(0).take(pa.array(owner[kept]))
            yield pa.record_batch([pa.array(keys[kept].view(np.int64)), sids], names=["key", "sid"])

    return run


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """The components of a graph given as a symmetric matrix, each as a star around its first member."""
    new, edges = np.ones(len(linked), dtype=bool), []
    for start in range(len(linked)):
        if not new[start]:
            continue
        new[start], front = False, np.array([start])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & new)
            edges += [(start, i) for i in front.tolist()]
            new[front] = False
    return edges


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, from the values that several sets hold, a few columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    frequent = np.flatnonzero(count > 1)
    dense = np.full(len(count), -1)
    dense[frequent] = np.arange(len(frequent))
    column = dense[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, len(frequent), COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        held = np.zeros((len(sets), min(COLUMNS, len(frequent) - low)), dtype=np.float32)
        held[owner[part], column[part] - low] = 1
        common += held @ held.T
    return common


def _by_rows(n: int, judge: Callable[[slice], np.ndarray]) -> np.ndarray:
    """A matrix of truth values, made from a few rows at a time."""
    out = np.empty((n, n), dtype=bool)
    for low in range(0, n, ROWS):
        out[low : low + ROWS] = judge(slice(low, low + ROWS))
    return out


def _links_in_blocks(threshold: int):
    """The links among full sets, as a spanning forest."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("sid").sort_values("sid")  # stars of many blocks then share their centres
        sets = [np.asarray(x, dtype=np.int64) for x in group["shingles"]]
        sizes = np.array([len(x) for x in sets])
        common = _common(sets)
        linked = _by_rows(len(sets), lambda r: common[r] * 100 >= (sizes[r, None] + sizes[None, :] - common[r]) * threshold)
        np.fill_diagonal(linked, False)
        sids = group["sid"].tolist()
        return pd.DataFrame([(sids[i], sids[j]) for i, j in _forest(linked)], columns=["a", "b"])

    return run


def _candidates_in_blocks(threshold: int):
    """The pairs in different clusters and components whose sketches may reach the threshold, as a spanning forest."""
    least = _least_shared(threshold)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("sid").sort_values("sid")
        sets = [np.asarray(x, dtype=np.int64) for x in group["sketch"]]
        sizes = np.minimum([len(x) for x in sets], SKETCH)
        common = _common(sets)
        found = _by_rows(len(sets), lambda r: common[r] >= np.minimum(least, np.minimum(sizes[r, None], sizes[None, :]) * (threshold / 100)))
        for name in ("root", "cluster"):
            code = pd.factorize(group[name])[0]
            found &= code[:, None] != code[None, :]
        sids = group["sid"].tolist()
        return pd.DataFrame([(sids[i], sids[j]) for i, j in _forest(found)], columns=["a", "b"])

    return run


def _in_blocks(members: DataFrame, group: str, blocks: DataFrame) -> DataFrame:
    """Members once for every pair of blocks of their group that they belong to: ``blocks (group, blocks)``."""
    member = members.join(blocks, group).withColumn("block", F.expr("CAST(pmod(xxhash64(sid), blocks) AS int)"))
    # Block i meets every block; a block that is alone meets itself.
    member = member.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).where("block <> other OR blocks = 1")
    return member.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("block", "other", "blocks")


def _least_shared(threshold: int) -> int:
    p = threshold / 100
    return int(np.floor(p * SKETCH - 6.5 * np.sqrt(SKETCH * p * (1 - p))))


def _estimate(threshold: int) -> tuple[Column, Column]:
    """Whether the sketch of the union allows the similarity (exact where it holds the whole union), and whether it is ``LOOSE`` at least."""
    least = _least_shared(threshold)
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold
    reach = sizes & F.when(F.col("places") < SKETCH, F.col("shared") * 100 >= F.col("places") * threshold).otherwise(F.col("shared") >= least)
    return reach, F.col("shared") * 100 >= F.col("places") * LOOSE


class _Links:
    """Verified links between sets, found over several rounds."""

    def __init__(self, docs: DataFrame, scratch: Scratch, threshold: int):
        self.docs, self.scratch, self.threshold = docs, scratch, threshold
        self.rows = scratch.save(docs.mapInArrow(_signatures, _SIGNATURE))
        self.sets = scratch.save(
            self.rows.where("n_shingles > 0")
            .groupBy("sid")
            .agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.min("place").alias("place"))
        )
        self.near = self.sets
        self.full: DataFrame | None = None
        self.loose: DataFrame | None = None
        self.roots: DataFrame | None = None

    def verify(self, pairs: DataFrame, likely_later: DataFrame) -> None:
        """Adds the links among ``pairs (a, b)`` and reads the full sets of ``likely_later (sid)`` along."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        side = lambda c: self.near.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
        met = pairs.join(side("a"), "a").join(side("b"), "b")
        met = met.withColumn("union", F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH))
        met = met.withColumn("shared", F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), "union"))).withColumn("places", F.size("union"))
        reach, loose = _estimate(self.threshold)
        met = met.select("a", "b", "n_a", "n_b", reach.alias("reach"), loose.alias("loose")).where("reach OR loose")
        met, seen = self.scratch.save_measured(met, n=F.count_if("reach"), loose=F.count("*"))
        self.loose = met.select("a", "b")
        likely = met.where("reach").drop("reach", "loose")
        if not seen["n"]:
            return
        self._read_full(likely.selectExpr("explode(array(a, b)) AS sid").union(likely_later))
        full = lambda c: self.full.select(F.col("sid").alias(c), F.col("shingles").alias(f"set_{c}"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        judged = likely.join(full("a"), "a").join(full("b"), "b").select("a", "b", (F.col("n_a") + F.col("n_b")).alias("both"), common.alias("common"))
        linked = self.scratch.save(judged.where(F.col("common") * 100 >= (F.col("both") - F.col("common")) * self.threshold).select("a", "b"))
        self.add(linked)

    def add(self, linked: DataFrame) -> None:
        edges = linked if self.roots is None else linked.union(self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.roots = self.scratch.save(components(edges, self.scratch))

    def _read_full(self, wanted: DataFrame) -> None:
        """Reads the documents again for the full sets of some classes; sets that later rounds need come along."""
        wanted = wanted.distinct()
        if self.full is not None:
            wanted = wanted.join(self.full.select("sid"), "sid", "left_anti")
        places, seen = self.scratch.save_measured(self.sets.join(wanted, "sid", "left_semi").select("sid", "place"), n=F.count("*"))
        if not seen["n"]:
            return
        found = self.docs.mapInArrow(_sets_of_some(BitFilter.of(places, "place", seen["n"])), "sid binary, shingles array<long>")
        # Equal sets may come from several documents; one row each is enough.
        found = found.join(places.select("sid"), "sid", "left_semi").dropDuplicates(["sid"])
        found = self.scratch.save(found)
        self.full = found if self.full is None else self.full.union(found)

    def with_roots(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("root", F.col("sid"))
        return rows.join(self.roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))

    def unresolved(self, lists: DataFrame) -> DataFrame:
        """The long lists with members of several components, with the component of each member."""
        known = self.with_roots(lists)
        open_keys = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
        return known.join(open_keys, "key")

    def compare_clusters(self, clustered: DataFrame) -> None:
        """Adds the links inside each cluster of ``(sid, cluster)``, block against block."""
        self._read_full(clustered.select("sid"))
        sized = clustered.join(self.sets.select("sid", "n"), "sid")
        blocks = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
        counts = sized.groupBy("cluster").agg(F.count("*").alias("members"), blocks.alias("blocks")).where("members > 1").drop("members")
        member = _in_blocks(clustered, "cluster", counts).join(self.full, "sid")
        found = member.groupBy("cluster", "i", "j").applyInPandas(_links_in_blocks(self.threshold), "a binary, b binary")
        self.add(self.scratch.save(found))

    def compare_lists(self, rest: DataFrame) -> None:
        """Adds the links between clusters inside each list of ``(key, sid, root, cluster)``.

        Two sets that may be linked are joined by the forest of their blocks, so comparing each component of the forests
        in full finds every link without listing pairs.
        """
        counts = rest.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
        member = _in_blocks(rest, "key", counts).join(self.near.select("sid", "sketch"), "sid")
        met = member.groupBy("key", "i", "j").applyInPandas(_candidates_in_blocks(self.threshold), "a binary, b binary")
        met, seen = self.scratch.save_measured(met, n=F.count("*"))
        if seen["n"]:
            self.compare_clusters(components(met, self.scratch).select(F.col("node").alias("sid"), F.col("root").alias("cluster")))


def _similar_sets(docs: DataFrame, scratch: Scratch, threshold: int) -> _Links:
    links = _Links(docs, scratch, threshold)
    sketches = links.sets.select("sid", "sketch")
    repeated = sketches.mapInArrow(_listing(None), "key long").groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    repeated, seen = scratch.save_measured(repeated, n=F.count("*"))
    if not seen["n"]:
        return links
    lists = sketches.mapInArrow(_listing(BitFilter.of(repeated, "key", seen["n"])), "key long, sid binary")
    lists = scratch.save(lists.join(repeated, "key"))
    links.near = scratch.save(links.sets.join(lists.select("sid").distinct(), "sid", "left_semi"))
    least = lists.groupBy("key").agg(F.min("sid").alias("least"))
    star = lists.join(least, "key").where("sid <> least").select(F.col("least").alias("a"), F.col("sid").alias("b"))
    short = lists.where(f"size BETWEEN 3 AND {SHORT_LIST}").select("key", "sid")
    pairs = short.withColumnRenamed("sid", "a").join(short.withColumnRenamed("sid", "b"), "key").where("a < b").select("a", "b")
    long = lists.where(f"size > {SHORT_LIST}").select("key", "sid")
    links.verify(star.union(pairs), long.select("sid"))
    rest, seen = scratch.save_measured(links.unresolved(long), n=F.count("*"))
    if not seen["n"]:
        return links
    clusters = scratch.save(components(links.loose, scratch)).select(F.col("node").alias("sid"), F.col("root").alias("cluster"))
    links.compare_clusters(clusters.join(rest.select("sid").distinct(), "sid"))
    rest = links.unresolved(rest.select("key", "sid")).join(clusters, "sid", "left").withColumn("cluster", F.coalesce("cluster", "sid"))
    rest, seen = scratch.save_measured(rest, n=F.count("*"))
    if seen["n"]:
        links.compare_lists(rest)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = LEAST_SIMILARITY) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Sets are linked if 100 * intersection >= threshold * union. ``component_id`` is the least id reachable over links;
    a row is kept if it has that id.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    links = _similar_sets(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), scratch, threshold)
    named = links.with_roots(links.rows.select("doc_id", "n_shingles", "sid"))
    least = named.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("doc_id").eqNullSafe(F.col("least"))).otherwise(F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = LEAST_SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without those that repeat a document with a smaller id; columns stay as they are."""
    repeated = free_name(docs, "repeated")
    judged = near_duplicates(docs, id_col, text_col, threshold).where("NOT kept").select(F.col("doc_id").alias(repeated)).distinct()
    return docs.join(judged, F.col(f"`{id_col}`").cast("long") == F.col(repeated), "left_anti")
