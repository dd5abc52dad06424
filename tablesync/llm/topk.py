"""Operator 6: exact top-k by inner product, in buckets of similar length.

Components become floor(256 * x), so scores are whole numbers.  Vectors are
sorted by length and cut into buckets of nearly equal length; for a query of
length |q| whose k-th best score so far is s, a bucket whose longest vector is
m long needs a cosine of s / (|q| m) at least.  Above 1 the bucket is skipped.
Otherwise the bucket's threshold chooses how to prune: low ones keep the
vectors longer than s / |q| (length pruning), high ones keep those whose
strongest coordinate of the query lies where a vector of that cosine must have
it (coordinate pruning).  What remains is verified by its full product.
Bounds carry a margin far above rounding, so pruning never loses a result.

Queries are worked off in blocks, each broadcast (a fixed number of rows of
one vector) and held against all rows of the written, sorted table; the first
scores come from the longest vectors.  Tasks return at most k rows a query.

Defined cases: rows with a null id, a null vector, or a null or non-finite
component take no part; vectors of other dimensions than the query's are no
candidates; rows with the query's own id are not its candidates; other
repeated rows are candidates of their own; a repeated query (id and vector) is
asked once; scores must fit in 64 bits; other
columns are ignored.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

#: Queries that are broadcast at once.
BLOCK = 4096
#: Longest vectors that give each query its first threshold.
SEEDS = 1024
#: Shortest to longest vector of a bucket; cosine from which coordinates prune.
RATIO, COORDINATE_FROM = 0.9, 0.6
MARGIN = 1e-6


def whole_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``v`` (array of long) and ``norm`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    df = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    df = df.select(F.col(key).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * 256)).alias("v"))
    return df.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b' in whole numbers: through doubles only where all sums are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if most < 2**53 else a @ b.T


class Best:
    """The k best (score, id) of each query so far: scores down, then ids up."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.id[q], ids]), np.concatenate([self.score[q], scores])
        if len(ids) > self.k:  # all that reach the k-th score, then the order of ties
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= least
            ids, scores = ids[keep], scores[keep]
        order = np.lexsort((ids, -scores))[: self.k]
        self.id[q], self.score[q] = ids[order], scores[order]

    def least(self, q: int) -> float:
        return float(self.score[q][-1]) if len(self.score[q]) == self.k else -math.inf


def _search(ids: np.ndarray, v: np.ndarray, norm: np.ndarray, qid: np.ndarray, q: np.ndarray, qnorm: np.ndarray, floor: np.ndarray, best: Best) -> None:
    """Hold rows sorted by falling length against all queries of a block."""
    lo = 0
    strongest = np.abs(q).argmax(axis=1) if q.shape[1] else np.zeros(len(q), np.int64)
    while lo < len(ids):
        m = norm[lo]
        hi = len(ids) if m == 0 else lo + int(np.searchsorted(-norm[lo:], -m * RATIO, "right"))
        b_id, b_v, b_norm = ids[lo:hi], v[lo:hi], norm[lo:hi]
        unit = None
        least = np.maximum(floor, [best.least(i) for i in range(len(qid))])
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(qnorm * m > 0, least / (qnorm * m), np.where(least > 0, math.inf, -math.inf))
        live = np.flatnonzero(need <= 1 + MARGIN)
        by_length = live[need[live] < COORDINATE_FROM]
        for some in (by_length[i : i + 256] for i in range(0, len(by_length), 256)):
            with np.errstate(divide="ignore", invalid="ignore"):
                short = np.where(least[some] > 0, least[some] / qnorm[some], 0).min() * (1 - MARGIN)
            end = int(np.searchsorted(-b_norm, -short, "right"))
            got = products(q[some], b_v[:end])
            for row, i in enumerate(some):
                keep = np.flatnonzero((got[row] >= max(least[i], best.least(i))) & (b_id[:end] != qid[i]))
                if len(keep):
                    best.add(i, b_id[keep], got[row][keep])
        for i in live[need[live] >= COORDINATE_FROM]:
            if unit is None:
                unit = b_v / np.maximum(b_norm, 1e-300)[:, None]
            f = strongest[i]
            c, t = q[i, f] / qnorm[i], min(1.0, need[i])
            reach = math.sqrt(max(0.0, (1 - t * t) * (1 - c * c))) + MARGIN
            keep = unit[:, f] >= c * t - reach if c > 0 else unit[:, f] <= c * t + reach
            # beyond c itself the bound is on the other side of the query's direction
            keep = np.flatnonzero(keep & (b_norm >= least[i] / qnorm[i] * (1 - MARGIN)) & (b_id != qid[i]))
            if len(keep):
                got = products(q[i : i + 1], b_v[keep])[0]
                keep, got = keep[got >= least[i]], got[got >= least[i]]
                if len(keep):
                    best.add(i, b_id[keep], got)
        lo = hi


def _by_dimension(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    out: dict[int, list[int]] = {}
    for at, r in enumerate(rows):
        out.setdefault(len(r["v"]), []).append(at)
    return {d: (np.array([rows[i]["id"] for i in at], np.int64), np.array([rows[i]["v"] for i in at], np.int64).reshape(len(at), d), np.array([rows[i]["norm"] for i in at]), at) for d, at in out.items()}


def top_products(vectors: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` highest inner
    products of each query row with all other rows, ties to the smaller id."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors.withColumn(key, F.col(key)), key, vector)
    # sorted by length; rows of equal length (copies) spread by their id
    table = materialise(rows.repartitionByRange(F.desc("norm"), F.xxhash64("id")).sortWithinPartitions(F.desc("norm")), "top-k")
    queries = table.filter(is_query(F.col("id"))).select("id", "v", "norm").dropDuplicates(["id", "v"])
    seeds = _by_dimension(table.orderBy(F.desc("norm"), "id").limit(SEEDS).collect())
    n = queries.count()
    blocks = -(-n // BLOCK)
    found = None
    for block in range(blocks):
        mine = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == block)
        sent = {}
        for d, (qid, q, qnorm, at) in _by_dimension(mine.collect()).items():
            floor = Best(len(qid), k)
            if d in seeds:
                s_id, s, _, _ = seeds[d]
                got = products(q, s)
                for i in range(len(qid)):
                    other = s_id != qid[i]
                    floor.add(i, s_id[other], got[i][other])
            sent[d] = (qid, q, qnorm, np.array([floor.least(i) for i in range(len(qid))]), np.array(at, np.int64))
        sent = spark.sparkContext.broadcast(sent)

        def work(batches: Iterator[pa.RecordBatch], sent=sent, k=k, block=block) -> Iterator[pa.RecordBatch]:
            best = {d: Best(len(x[0]), k) for d, x in sent.value.items()}
            for b in batches:
                ids, norm = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
                lists = b.column(1)
                size = lists.value_lengths().to_numpy(zero_copy_only=False)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                start = np.concatenate([[0], np.cumsum(size)])
                for d, (qid, q, qnorm, floor, _) in sent.value.items():
                    own = np.flatnonzero(size == d)
                    own = own[np.argsort(-norm[own], kind="stable")]
                    for lo in range(0, len(own), 4096):
                        some = own[lo : lo + 4096]
                        v = values[(start[some][:, None] + np.arange(d)).ravel()].reshape(len(some), d)
                        _search(ids[some], v, norm[some], qid, q, qnorm, floor, best[d])
            for d, (qid, _, _, _, at) in sent.value.items():
                n_of = [len(x) for x in best[d].id]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(at, n_of) + block * (1 << 40)), pa.array(np.repeat(qid, n_of)), pa.array(np.concatenate(best[d].id) if n_of else np.zeros(0, np.int64)), pa.array(np.concatenate(best[d].score) if n_of else np.zeros(0, np.int64))], names=["query", "query_id", "vec_id", "score"])

        part = table.select("id", "v", "norm").mapInArrow(work, "query long, query_id long, vec_id long, score long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
