"""Approximate nearest neighbours with a permutation index.

A vector is represented by the pivots in order of nearness: its permutation.
Per shard, each pivot has an inverted file that posts every vector of the shard
with the pivot's place in the vector's permutation.  A query reads the files of
its own nearest pivots, sums the differences between the two places (Spearman's
footrule; a pivot beyond the posted ones counts as place ``POSTED``), takes the
share of the shard that promises the largest products (the cosine that a sum stands
for in this shard, times the vector's length; with equal lengths the smallest sums),
and ranks those by exact inner product in double precision.

Pivots come from a bounded sample (the ``PIVOT_SAMPLE`` rows with the smallest
hash, near copies left out).  Every vector is indexed.  Shards hold about
``SHARD_ROWS`` vectors, whatever the table's size; queries go to every shard in
blocks of ``QUERY_ROWS``, and only the best k of a shard come back.

Defined results: vectors that are null, empty, zero or hold null or non-finite
numbers take no part, as query or candidate; vectors of another dimension than
the most frequent one of the pivot sample take no part; equal scores rank by the smaller id; rows that
repeat an id count as further candidates of that id; with fewer than k
candidates all are returned; an empty table gives an empty result.  Only ids and
vectors are read; other columns do not matter.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions
from .vectors import dots, matrix, packed, usable

PIVOTS = 128
#: Documented bound of the fit.
PIVOT_SAMPLE = 2048
PIVOT_APART = 0.8
#: Places that are posted; the query reads as many files.
POSTED = 128
SHARD_ROWS = 4096
QUERY_ROWS = 4096
#: Share of a shard that is ranked exactly, and the least number.
RERANK_SHARE = 0.25
RERANK_LEAST = 256
#: Rows of a shard asked against it, and steps of the sums, to learn which cosine a sum stands for.
LEARN_ROWS, LEARN_STEPS = 24, 64


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Directions of the sample in hash order, no two closer than PIVOT_APART."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("vec").collect()
    found = list(dict.fromkeys(bytes(r["vec"]) for r in rows))
    if not found:
        return np.zeros((0, 0))
    size = Counter(map(len, found)).most_common(1)[0][0]
    m = matrix([v for v in found if len(v) == size])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    taken: list[int] = []
    for i in range(len(m)):  # near copies of a pivot would only repeat its place
        if len(taken) < pivots and (not taken or (m[taken] @ m[i]).max() < PIVOT_APART):
            taken.append(i)
    return m[taken]


class Shard:
    """The inverted files of one shard: for each pivot its place in every vector's permutation."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, pivots: np.ndarray, posted: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.pivots = ids[order], rows[order], pivots
        self.posted = min(posted, len(pivots), 127)
        places = places_of(self.rows, pivots)
        self.files = np.ascontiguousarray(np.minimum(places, self.posted).T)
        self.norm = np.linalg.norm(self.rows, axis=1)
        self.steps, self.cosine = self.learn(places)

    def learn(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mean cosine that goes with a footrule sum, never rising: some rows asked against all."""
        picked = np.unique(np.linspace(0, len(self.ids) - 1, LEARN_ROWS).astype(int))
        sums = np.concatenate([self.footrule(places[i]) for i in picked]).astype(np.int64)
        unit = self.rows / self.norm[:, None]
        cosine = (unit[picked] @ unit.T).ravel()
        width = max(1, int(sums.max()) // LEARN_STEPS)
        n = np.bincount(sums // width)
        mean = np.bincount(sums // width, weights=cosine)[n > 0] / n[n > 0]
        return np.flatnonzero(n) * width, np.minimum.accumulate(mean)

    def footrule(self, own: np.ndarray) -> np.ndarray:
        """Summed differences of places over the query's nearest pivots."""
        total = np.zeros(len(self.ids), np.uint16)
        for p in np.flatnonzero(own < self.posted):
            total += np.abs(self.files[p] - own[p]).view(np.uint8)
        return total

    def search(self, query_id: int, q: np.ndarray, own: np.ndarray, k: int, share: float, least: int):
        total = self.footrule(own)
        n = len(total)
        want = min(n, max(least, int(np.ceil(share * n))))
        if want < n:  # a long vector reaches the same product from further away
            hoped = self.norm * (np.interp(total, self.steps, self.cosine) - 1e-6 * total)
            near = np.lexsort((self.ids, -hoped))[:want]
        else:
            near = np.arange(n)
        near = near[self.ids[near] != query_id]
        score = dots(self.rows[near], q)
        if len(near) > 4 * k:
            edge = np.partition(score, len(score) - k)[len(score) - k]
            near, score = near[score >= edge], score[score >= edge]
        best = np.lexsort((self.ids[near], -score))[:k]
        return self.ids[near[best]], score[best]


def places_of(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Place of every pivot in each row's permutation (int8; rows x pivots)."""
    order = np.argsort(-(rows @ pivots.T), axis=1, kind="stable")
    out = np.empty(order.shape, np.int8)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int8)[None, :], 1)
    return out


def search(table: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", column: str = "embedding", share: float = RERANK_SHARE, least: int = RERANK_LEAST, pivots: int = PIVOTS, posted: int = POSTED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row where ``is_query``."""
    if pivots > 128:
        raise ValueError("places are stored in 7 bits: at most 128 pivots")
    rows = table.withColumn("__q", F.coalesce(is_query, F.lit(False))).where(usable(column) & F.col(id_column).isNotNull())
    vectors = packed(rows.select(F.col(id_column).cast("long").alias("id"), F.col("__q").alias("q"), F.col(column).alias("embedding")), "embedding")
    chosen = choose_pivots(vectors, pivots)
    schema = "query_id bigint, vec_id bigint, score double"
    if not len(chosen):
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = chosen.shape[1] * 8
    vectors = vectors.where(F.length("vec") == dim)
    count = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("q").cast("long")).alias("q")).first()
    shards = max(1, -(-count["n"] // SHARD_ROWS))
    blocks = max(1, -(-(count["q"] or 0) // QUERY_ROWS))
    # candidates by shard; queries to every (shard, block of queries)
    order = F.xxhash64("id", F.lit(3))
    data = vectors.select(F.pmod(order, F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "vec")
    queries = vectors.where("q").select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("int").alias("block"), "id", "vec")

    def run(left, right):
        if not right.num_rows or not left.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["query_id", "vec_id", "score"])
        shard = Shard(left.column("id").to_numpy(), matrix(left.column("vec").to_pylist()), chosen, posted)
        ids, q = right.column("id").to_numpy(), matrix(right.column("vec").to_pylist())
        own = places_of(q, chosen)
        found = [(i, *shard.search(i, v, p, k, share, least)) for i, v, p in zip(ids, q, own, strict=True)]
        return pa.table(
            [pa.array(np.concatenate([np.full(len(f[1]), f[0]) for f in found])), pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
            names=["query_id", "vec_id", "score"],
        )

    n = max(partitions(table), shards * blocks)
    found = data.repartition(n, "shard", "block").groupBy("shard", "block").cogroup(queries.repartition(n, "shard", "block").groupBy("shard", "block")).applyInArrow(run, schema)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
