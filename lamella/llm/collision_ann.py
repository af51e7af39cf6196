"""Nearest neighbours by inner product with collision-counting hashing.

Vectors are scaled by the largest norm and given one more coordinate, so that all
have norm one and the largest inner product is the smallest distance. Each of
``PROJECTIONS`` random directions is a hash: its values over a block of vectors
are sorted, and a query collides with the vectors in a window around its own
value. Widening the windows rehashes to a larger radius without a new table. A
vector within radius R falls into a window of half-width ``WIDTH * R`` with
probability 0.89 per direction, whatever R is, so those with ``THRESHOLD``
collisions or more are verified on the original vectors.

Two rounds. First, each query widens its windows over one block (a random sample
of at most ``BLOCK`` vectors) until ``k`` vectors pass the threshold. Of the true ``k``
nearest, the sample holds its share and hardly ever more than that and three times
its root; the score at that rank bounds the k-th of all from below. Then every block is
searched at the radius of that bound, and gives its best ``k`` per query beside those of the first round. Blocks of
vectors meet blocks of queries, so a task holds one of each; no count of
candidates is limited.

Defined cases: vectors that are NULL, zero or hold NULL or non-finite components
take no part, nor do rows without an id. Rows with one id are one vector (the
smallest). Vectors of different dimensions are never compared. Queries without
candidates give no rows; empty tables give empty results. Ties go to the smaller
id. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import written

PROJECTIONS = 128
WIDTH = 1.6
#: Binomial(128, 0.8904) stays below it with a chance of 0.1: what lies on the radius itself is found with 0.9, what is nearer more often.
THRESHOLD = 110
BLOCK = 8_192
#: A block is sorted once for so many queries.
QUERY_BLOCK = 4_096
#: Scaled inner products at which the first round widens its windows.
STEPS = (0.9, 0.6, 0.45, 0.3, 0.15, 0.0, -0.5, -1.0)
RESULT = "query_id bigint, vec_id bigint, score double"


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, seed: int = 13):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        rng = np.random.default_rng([seed, vectors.shape[1]])
        self.directions = rng.normal(size=(PROJECTIONS, vectors.shape[1] + 1))
        scaled = vectors / largest
        lift = np.sqrt(np.maximum(1 - np.einsum("nd,nd->n", scaled, scaled), 0))
        values = self.directions[:, :-1] @ scaled.T + np.outer(self.directions[:, -1], lift)
        self.order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=1)

    def projected(self, queries: np.ndarray) -> np.ndarray:
        norms = np.sqrt(np.einsum("nd,nd->n", queries, queries))
        return self.directions[:, :-1] @ (queries / norms[:, None]).T

    def windows(self, at: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last places of the windows, per direction and query."""
        low, high = np.empty(at.shape, dtype=np.int64), np.empty(at.shape, dtype=np.int64)
        for j in range(PROJECTIONS):
            low[j] = np.searchsorted(self.sorted[j], at[j] - WIDTH * radius, side="left")
            high[j] = np.searchsorted(self.sorted[j], at[j] + WIDTH * radius, side="right")
        return low, high

    def colliding(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the vectors in enough windows of one query. A window over more than half of the block is counted by
        what lies outside of it."""
        n = len(self.ids)
        wide = high - low > n // 2
        count = np.full(n, int(wide.sum()), dtype=np.int64)
        inside = [self.order[j, low[j]:high[j]] for j in np.flatnonzero(~wide)]
        outside = [part for j in np.flatnonzero(wide) for part in (self.order[j, :low[j]], self.order[j, high[j]:])]
        if inside:
            count += np.bincount(np.concatenate(inside), minlength=n)
        if outside:
            count -= np.bincount(np.concatenate(outside), minlength=n)
        return np.flatnonzero(count >= THRESHOLD)

    def verified(self, found: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` of the places found, without the query itself."""
        found = found[self.ids[found] != query_id]
        if len(found) > 4 * k:
            # A first product, in another order of addition, leaves those that can be among the best.
            rough = self.vectors[found] @ query
            least = np.partition(rough, len(rough) - k)[len(rough) - k]
            found = found[rough >= least - 1e-9 * (1 + np.abs(rough).max())]
        scores = (self.vectors[found] * query).sum(axis=1)
        best = np.lexsort((self.ids[found], -scores))[:k]
        return self.ids[found][best], scores[best]


def radius_of(scaled_score: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * scaled_score, 0)) + 1e-9


def usable(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """One row per id: vec_id and the vector as doubles."""
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias(vector))
    return (rows.filter(F.col("vec_id").isNotNull()).filter(F.coalesce(whole, F.lit(False))).filter(F.coalesce(some, F.lit(False)))
                .groupBy("vec_id").agg(F.min(vector).alias("v")))


def search(df: DataFrame, is_query, k: int = 20, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each row for which ``is_query`` (of vec_id) holds."""
    rows = written(usable(df, vector, vec_id).withColumn("size", F.size("v")), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    number, queries, largest = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.max(norm)).first()
    blocks, query_blocks = -(-number // BLOCK) or 1, -(-queries // QUERY_BLOCK) or 1
    largest = (largest or 1.0) * (1 + 1e-12)
    # New columns, so that the two sides of the cogroups are told apart.
    data = rows.select(*[F.col(c).alias(c) for c in rows.columns], F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("d"))
    data = data.toDF("d_vec_id", "d_v", "d_size", "d").select(F.col("d_size").alias("size"), "d", F.col("d_vec_id").alias("vec_id"), F.col("d_v").alias("v"))
    asked = rows.filter(is_query).withColumn("q", F.pmod(F.xxhash64("vec_id", F.lit("q")), F.lit(query_blocks)))

    def arrays(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return frame["vec_id"].to_numpy(dtype=np.int64), np.stack(frame["v"].to_numpy()).astype(np.float64)

    share = k / blocks
    rank = min(k, math.ceil(share + 3 * math.sqrt(share)) + 1)

    def widen(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Best ``k`` of the sample for each query, and the scaled score that bounds the k-th of all; none if the sample holds fewer."""
        out = {"query_id": [], "vec_id": [], "score": [], "bound": []}
        if len(left) and len(right):
            block, (ids, vectors) = Block(*arrays(left), largest), arrays(right)
            at, norms = block.projected(vectors), np.sqrt(np.einsum("nd,nd->n", vectors, vectors))
            todo = np.arange(len(ids))
            for step in STEPS:
                low, high = block.windows(at[:, todo], np.full(len(todo), radius_of(np.float64(step))))
                again = []
                for i, one in enumerate(todo):
                    best, scores = block.verified(block.colliding(low[:, i], high[:, i]), ids[one], vectors[one], k)
                    if len(best) == k:
                        out["query_id"].append(np.full(k, ids[one]))
                        out["vec_id"].append(best)
                        out["score"].append(scores)
                        out["bound"].append(np.full(k, scores[rank - 1] / (largest * norms[one])))
                    else:
                        again.append(one)
                todo = np.array(again, dtype=np.int64)
                if not len(todo):
                    break
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()})

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Best ``k`` of the block for each query, at the radius of its bound (all of the block without one)."""
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            block, (ids, vectors) = Block(*arrays(left), largest), arrays(right)
            bound = right["bound"].to_numpy(dtype=np.float64)
            low, high = block.windows(block.projected(vectors), radius_of(np.where(np.isnan(bound), -1, bound)))
            everything = np.arange(len(block.ids))
            for i, query_id in enumerate(ids):
                found = everything if np.isnan(bound[i]) else block.colliding(low[:, i], high[:, i])
                best, scores = block.verified(found, query_id, vectors[i], k)
                out["query_id"].append(np.full(len(best), query_id))
                out["vec_id"].append(best)
                out["score"].append(scores)
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()})

    sample = data.filter("d = 0").select("size", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), "vec_id", "v")
    asked_once = asked.select("size", F.col("q").cast("int").alias("q"), "vec_id", "v")
    first = sample.groupBy("size", "q").cogroup(asked_once.groupBy("size", "q")).applyInPandas(widen, f"{RESULT}, bound double")
    first = written(first, "bounds")
    limited = asked_once.join(first.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("bound").alias("bound")), "vec_id", "left")
    spread = data.select("size", F.col("d").cast("int").alias("d"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), "vec_id", "v")
    sent = limited.select("size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("d"), "q", "vec_id", "v", "bound")
    near = spread.groupBy("size", "d", "q").cogroup(sent.groupBy("size", "d", "q")).applyInPandas(visit, RESULT)
    near = near.unionByName(first.drop("bound")).dropDuplicates(["query_id", "vec_id"])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
