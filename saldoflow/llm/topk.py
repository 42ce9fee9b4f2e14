"""Exact top-k by inner product over integer vectors.

Candidates are dealt at random to shards. A task has one shard and one block of queries; it goes through the shard in
order of falling length. Query and candidate are rotated so that most of a sample's variance lies in the leading
coordinates. For a block of candidates the task knows the leading partial products, and by Cauchy-Schwarz the rest is
at most the product of both residual lengths. Pairs whose bound lies below the query's k-th best score so far are
skipped, a query is done with the shard as soon as its length times the next candidate's cannot reach that score, and
what is left is scored exactly in integers. Every query starts from the k-th best score over the ``SEED`` longest
candidates, so all shards prune from their first block.

The bounds are computed in floating point with a margin above the rounding error; only integers decide. Scores fit in
64 bits while component products sum below 2^63.

A vector that is null, holds a null or a non-finite component, or has a null id takes no part. Only vectors of equal
dimension are compared. Ties go to the smaller id. A query's own id is no candidate; a repeated id is a candidate as
often as it occurs. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import Scratch

K, SCALE = 10, 1024
SHARD_ROWS, QUERY_BLOCK = 1 << 15, 1 << 10
SEED = 2048
FIT_ROWS = 4096
LEADING = 0.25
STEP = 1024

_HITS = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v array<long>, dim, norm)`` of the vectors that take part."""
    big = float(1 << 53)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    usable = lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))) & ~F.isnan(c)
    rows = rows.where("vec_id IS NOT NULL AND x IS NOT NULL").where(F.forall("x", usable))
    whole: Column = F.transform("x", lambda c: F.greatest(F.least(F.floor(c * scale).cast("double"), F.lit(big)), F.lit(-big)).cast("long"))
    rows = rows.select("vec_id", whole.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    return rows.select("vec_id", "v", F.size("v").alias("dim"), norm.alias("norm"))


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns in order of falling variance of the sample."""
    return np.linalg.svd(sample.T @ sample, hermitian=True)[0] if len(sample) else np.eye(sample.shape[1])


def search(queries: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The best k of ``rows`` for every query, of those scoring at least ``floor``; exact."""
    n, dim = rows.shape
    lead = max(1, int(np.ceil(dim * LEADING))) if dim else 0
    length = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -length))
    rows, ids, length = rows[order], ids[order], length[order]
    turned_q, q_length = queries.astype(np.float64) @ turn, np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    rest_q = np.sqrt((turned_q[:, lead:] ** 2).sum(axis=1))
    best = [[] for _ in queries]
    threshold = floor.astype(np.float64)
    alive = np.arange(len(queries))
    for start in range(0, n, STEP):
        # A relative margin far above the rounding error of the bounds.
        alive = alive[q_length[alive] * length[start] * (1 + 1e-9) + 1e-3 >= threshold[alive]]
        if not len(alive):
            break
        part, part_ids = rows[start : start + STEP], ids[start : start + STEP]
        turned = part.astype(np.float64) @ turn
        rest = np.sqrt((turned[:, lead:] ** 2).sum(axis=1))
        bound = turned_q[alive][:, :lead] @ turned[:, :lead].T + rest_q[alive][:, None] * rest[None, :]
        slack = 1e-9 * q_length[alive][:, None] * length[start] + 1e-3
        who, what = np.nonzero(bound + slack >= threshold[alive][:, None])
        own = q_ids[alive][who] != part_ids[what]
        who, what = who[own], what[own]
        for a in range(0, len(who), 1 << 16):
            w, c = who[a : a + (1 << 16)], what[a : a + (1 << 16)]
            scores = np.einsum("ij,ij->i", queries[alive[w]], part[c])
            good = scores >= threshold[alive[w]]
            w, c, scores = w[good], c[good], scores[good]
            cuts = np.flatnonzero(np.diff(w)) + 1
            for block in np.split(np.arange(len(w)), cuts) if len(w) else []:
                q = int(alive[w[block[0]]])
                found = best[q] + list(zip((-scores[block]).tolist(), part_ids[c[block]].tolist(), strict=True))
                found.sort()
                best[q] = found[:k]
                if len(found) >= k:
                    threshold[q] = max(threshold[q], -best[q][-1][0])
    return [(int(q_ids[q]), i, -s) for q, found in enumerate(best) for s, i in found]


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE,
    shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other vectors for each query; all, if there are fewer."""
    scratch = Scratch(vectors.sparkSession, "topk")
    rows, seen = scratch.save_measured(integer_vectors(vectors, id_col, vector_col, scale), n=F.count("*"))
    queries = rows.where(F.expr("true") & is_query)
    n_queries = queries.count()
    shards, blocks = max(1, -(-seen["n"] // shard_rows)), max(1, -(-n_queries // query_block))
    # Both samples are bounded: FIT_ROWS rows for the rotation, SEED rows for the first thresholds.
    fit = [(r.dim, r.v) for r in rows.orderBy(F.xxhash64("vec_id")).limit(FIT_ROWS).select("dim", "v").collect()]
    turns = {d: rotation(np.array([v for e, v in fit if e == d], dtype=np.float64)) for d in {e for e, _ in fit} if d}
    longest = [(r.dim, r.vec_id, r.v) for r in rows.orderBy(F.desc("norm"), "vec_id").limit(SEED).collect()]
    seeds = {
        d: (np.array([v for e, _, v in longest if e == d], dtype=np.int64), np.array([i for e, i, _ in longest if e == d]))
        for d in {e for e, _, _ in longest}
        if d
    }
    lowest = np.iinfo(np.int64).min

    def starts(batches):
        for batch in batches:
            floors = np.full(len(batch), lowest, dtype=np.int64)
            for at, (dim, vec_id, v) in enumerate(zip(batch["dim"], batch["vec_id"], batch["v"], strict=True)):
                if dim in seeds:
                    scores = np.sort((seeds[dim][0] @ np.asarray(v))[seeds[dim][1] != vec_id])
                    floors[at] = scores[-k] if len(scores) >= k else lowest
            yield batch.assign(floor=floors)

    sides = "vec_id long, v array<long>, dim int, floor long"
    queries = queries.select("vec_id", "v", "dim").mapInPandas(starts, sides)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    candidates = rows.select("vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"))
    candidates = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def scored(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, own in asked.groupby("dim"):
            against = offered[offered["dim"] == dim]
            if len(against):
                matrix = lambda f: np.stack(f["v"].to_list()).astype(np.int64) if dim else np.zeros((len(f), 0), dtype=np.int64)  # noqa: B023, E731
                turn = turns.get(int(dim), np.eye(int(dim)))
                out += search(matrix(own), own["vec_id"].to_numpy(), own["floor"].to_numpy(), matrix(against), against["vec_id"].to_numpy(), turn, k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    hits = queries.groupBy("block", "shard").cogroup(candidates.groupBy("block", "shard")).applyInPandas(scored, _HITS)
    # At most k rows a query and shard are ranked.
    ranked = hits.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    return ranked.where(f"rank <= {int(k)}").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
