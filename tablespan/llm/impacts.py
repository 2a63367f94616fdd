"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors are integers. They are dealt into shards of about SHARD vectors. Within a shard each dimension has a posting
list ordered by value, cut into segments of equal quantised value. For a query a segment's impact is the largest
contribution any posting in it can make, so lists are read from their high or low end by the query's sign. Segments of
all dimensions are processed by descending impact. What is left of a dimension bounds the contribution of every vector
not met there yet, so accumulators give an upper bound for every vector. The k best so far, scored exactly, give a lower
bound for the k-th score. Processing stops when so few vectors can still reach it that scoring them exactly costs less
than going on, or at the last of ROUNDS; all that still can are scored exactly. Ties at the bound count as able to reach it, so no member is lost.

Queries meet shards in blocks of about QUERIES, so that a task holds one shard and one block whatever the sizes of both
tables; a third step ranks the best of all shards per query.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors count as
padded with zeros; a query's candidates are all rows with another vec_id; where a vec_id is used by several rows, each
is a candidate, and its smallest vector is the query; rows without vec_id take no part; ties go to the smaller vec_id;
other columns are ignored; an empty table gives no rows. Scores have to fit 64 bits; within 2^53 the work is exact
throughout, beyond it bounds are widened by their rounding.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, QUERIES = 8192, 512
LEVELS = 16                # quantised impacts per sign of a dimension
FEW = 64                   # vectors that may be left to score exactly when processing stops, or
SHARE = 4                  # one in so many of the shard
ROUNDS = (0.6, 0.75, 0.9)  # shares of the segments after which it is seen who is left


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """vec_id and v: floor(scale x component) of every vector that takes part."""
    x = F.col(vector)
    number = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & sound).select("vec_id", number.alias("v"))


class ImpactIndex:
    """Posting lists of one shard, ordered by value and cut into segments."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, self.dims = vectors.shape
        order = np.argsort(-vectors, axis=0, kind="stable").T
        values = np.take_along_axis(vectors.T, order, axis=1)
        step = np.maximum(1, -(-np.abs(vectors).max(axis=0, initial=0) // LEVELS))
        level = values // step[:, None]
        new = np.ones((self.dims, n), bool)
        new[:, 1:] = level[:, 1:] != level[:, :-1]
        self.begin = np.flatnonzero(new.ravel())
        self.end = np.append(self.begin[1:], self.dims * n)
        self.dim = self.begin // max(1, n)
        self.postings, self.values = order.ravel(), values.ravel()
        self.most, self.least = self.values[self.begin], self.values[self.end - 1]

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows with another id than `own`, ties by id."""
        weight = query[self.dim]
        impact = np.maximum(weight * self.most, weight * self.least)
        by_impact = np.argsort(-impact, kind="stable")
        able = self.ids != own
        for part in ROUNDS:
            cut = int(np.ceil(part * len(by_impact)))
            done, left = by_impact[:cut], by_impact[cut:]
            rest = np.full(self.dims, np.iinfo(np.int64).min)
            np.maximum.at(rest, self.dim[left], impact[left])
            rest = np.where(np.isin(np.arange(self.dims), self.dim[left]), rest, 0)
            bound = self._accumulated(done, query, rest) + rest.sum()
            bound = bound + np.abs(bound) * 1e-12
            first = self._best(np.flatnonzero(able), bound, k)
            scores = self.vectors[first] @ query
            lower = scores.min() if len(first) == k else -np.inf
            members = np.flatnonzero(able & (bound >= lower))
            if len(members) <= max(FEW, k, len(self.ids) // SHARE):
                break
        exact = self.vectors[members] @ query
        best = np.lexsort((self.ids[members], -exact))[:k]
        return members[best], exact[best]

    def _accumulated(self, segments: np.ndarray, query: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Per vector, what its postings in the segments contribute beyond the rest of their dimension."""
        if len(segments) == 0:
            return np.zeros(len(self.ids))
        spans = list(zip(self.begin[segments].tolist(), self.end[segments].tolist()))
        size = self.end[segments] - self.begin[segments]
        dim = np.repeat(self.dim[segments], size)
        value = np.concatenate([self.values[a:b] for a, b in spans])
        return np.bincount(np.concatenate([self.postings[a:b] for a, b in spans]), query[dim] * value - rest[dim], len(self.ids))

    @staticmethod
    def _best(rows: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
        if len(rows) <= k:
            return rows
        return rows[np.argpartition(-bound[rows], k - 1)[:k]]


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _searched(k: int):
    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(shard) and len(queries):
            dims = max(1, shard["v"].map(len).max(), queries["v"].map(len).max())
            index = ImpactIndex(shard["vec_id"].to_numpy(np.int64), _matrix(shard["v"], dims))
            for own, query in zip(queries["vec_id"].tolist(), _matrix(queries["v"], dims)):
                rows, scores = index.top(query, own, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": index.ids[rows], "score": scores}))
        found = pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return found.astype("int64")

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. Both tables: vec_id, v."""
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-queries.count() // QUERIES))
    shard, block = F.pmod(F.xxhash64("vec_id", F.col("v")), F.lit(shards)), F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    index = vectors.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), "vec_id", "v")
    keys = [F.col("shard").cast("long"), F.col("block").cast("long")]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_searched(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
