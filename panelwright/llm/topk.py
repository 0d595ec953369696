"""Exact top-k by inner product: a KD-tree in every shard, searched best first.

Trees split at the median of the widest dimension and keep the tight box of each node. For a query q no vector
in a box scores above the sum of max(q_i * low_i, q_i * high_i). Nodes are visited by falling bound until the
bound is below the kth score so far. Every query first searches one shard, its home; the kth score found there
goes along to all other shards, where most boxes then fall at once.

Shards hold about ``per_shard`` vectors, whatever their number; queries travel in blocks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import store

LEAF = 256
NONE = -(1 << 63)


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.children, self.rows = [], [], [], []
        self.ids, self.vectors = ids, vectors
        self._grow(np.arange(len(ids)), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        own = self.vectors[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(rows)
        width = high - low
        if len(rows) > leaf and width.max(initial=0) > 0:
            axis = int(width.argmax())
            order = np.argsort(own[:, axis], kind="stable")
            half = len(rows) // 2
            self.rows[node] = None
            self.children[node] = (self._grow(rows[order[:half]], leaf), self._grow(rows[order[half:]], leaf))
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
        """(query number, ids, scores) of each query's k best of at least its floor; ``own`` ids are left out.

        Doubles multiply faster and are used where every sum is exact in them. Larger whole numbers are multiplied as
        such, which is exact as long as the score itself fits; their bounds get room for rounding.
        """
        largest = np.maximum(np.abs(self.low), np.abs(self.high)).astype(float)
        exact = largest.max(initial=0) * np.abs(queries).max(initial=0).astype(float) * queries.shape[1] < 1 << 53
        points, low, high = queries.astype(float), self.low.astype(float), self.high.astype(float)
        bounds = np.maximum(points, 0) @ high.T + np.minimum(points, 0) @ low.T
        if exact:
            queries, vectors = points, self.vectors.astype(float)
        else:
            vectors = self.vectors
            bounds += 1e-12 * (np.abs(points) @ largest.T) + 1
        for number, (query, me) in enumerate(zip(queries, own)):
            bound, kth = bounds[number].tolist(), int(floor[number])
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            heap = [(-bound[0], 0)]
            while heap and -heap[0][0] >= kth:
                node = heapq.heappop(heap)[1]
                if self.children[node]:
                    for child in self.children[node]:
                        if bound[child] >= kth:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                rows = self.rows[node]
                score = (vectors[rows] @ query).astype(np.int64)
                fit = (score >= kth) & (self.ids[rows] != me)
                if fit.any():
                    ids = np.concatenate((ids, self.ids[rows[fit]]))
                    scores = np.concatenate((scores, score[fit]))
                    if len(ids) > k:
                        best = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[best], scores[best]
                    if len(ids) == k:
                        kth = max(kth, int(scores.min()))
            yield number, ids, scores


def _matrix(values: pa.ListArray) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def _searcher(k: int, home: bool):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(vectors) and len(queries):
            tree = Tree(vectors["vec_id"].to_numpy(), _matrix(vectors["vector"].combine_chunks()))
            for i in range(len(queries)):
                block = queries.slice(i, 1)
                own = block["ids"].combine_chunks().flatten().to_numpy()
                points = _matrix(block["points"].combine_chunks().flatten())
                floor = np.full(len(own), NONE) if home else block["floors"].combine_chunks().flatten().to_numpy()
                for number, ids, scores in tree.search(points, own, floor, k):
                    out["query_id"].append(np.full(len(ids), own[number]))
                    out["vec_id"].append(ids)
                    out["score"].append(scores)
        return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
                         for c, v in out.items()})
    return run


def whole_vectors(rows: DataFrame, vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def top_k(rows: DataFrame, k: int = 20, every: int = 20, scale: int = 64, per_shard: int = 16_384,
          block: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of each row whose ``vec_id`` is divisible by ``every``.

    ``rows`` has vec_id and embedding; components become floor(scale * x), scores are their inner products. Ties
    go to the smaller vec_id. Null vectors, empty ones and those with a null or non-finite component take no part, nor do
    rows with null vec_id; a query has only vectors of its own length as candidates, and none of its own vec_id. Of
    rows that repeat a vec_id all are candidates, and the smallest vector is the query. Components may have any size as
    long as scores fit a long. An empty table gives no rows.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id is not null and size(embedding) > 0").where(~bad).select(
        F.col("vec_id").cast("long"), whole_vectors(rows, "embedding", scale).alias("vector"))
    rows = rows.withColumn("width", F.size("vector"))
    rows = store(rows, "vectors")
    shards = max(1, -(-rows.count() // per_shard))
    part = F.struct("width", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).alias("shard"))
    sharded = rows.withColumn("part", part)
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "width").agg(F.min("vector").alias("vector"))

    def blocks(queries: DataFrame) -> DataFrame:
        per = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.greatest(F.lit(1), F.ceil(F.col("many") / F.lit(block))))
        many = queries.groupBy("part").agg(F.count("*").alias("many"))
        return queries.join(many, "part").groupBy("part", per.alias("block")).agg(
            F.collect_list(F.struct("vec_id", "vector", "floor")).alias("all")).select(
            "part", F.col("all.vec_id").alias("ids"), F.col("all.vector").alias("points"), F.col("all.floor").alias("floors"))

    def search(queries: DataFrame, home: bool) -> DataFrame:
        return sharded.select("part", "vec_id", "vector").groupBy("part").cogroup(
            blocks(queries).groupBy("part")).applyInArrow(
            _searcher(k, home), "query_id long, vec_id long, score long")

    homed = asked.withColumn("part", part).withColumn("floor", F.lit(NONE).cast("long"))
    first = store(search(homed, True), "near-home")
    floors = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(NONE).cast("long")).alias("floor"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    away = homed.withColumnRenamed("part", "home").drop("floor").join(floors, "vec_id", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(NONE).cast("long"))).withColumn("shard", others).where(
        "shard <> home.shard").withColumn("part", F.struct("width", "shard"))
    found = first.union(search(away, False)) if shards > 1 else first
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
