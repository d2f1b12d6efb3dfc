"""Approximate nearest neighbours by inner product, with vantage-point trees per shard.

Largest inner product becomes smallest distance: every vector gets one more component that
brings all to the largest norm, every query a zero and unit length.  Rows are dealt into shards
of bounded size and of like magnitude, each scaled by a power of two, so a vector that is far
longer than the others takes nothing from their precision.  A shard's vectors form a
vantage-point tree, where a node splits its rows at the median distance from one of them.  A
query goes down its own side first; the other side is left out when the triangle inequality
says that nothing there can be nearer than the k-th found so far: ``factor`` times the least
possible distance exceeds it.  Factor 1 is exact search, more leaves out more.  Queries come
in blocks and are searched together, so the leaves are matrix products; the shards' answers
are merged per query.

What comes near the k-th best is scored on the original vectors in double precision, one pair
at a time, and ranked by score and id at once, so of any number of equal scores the smallest
ids stay.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardledger.llm.common import stored

NEIGHBOURS = 20
#: Rows of a shard and queries of a block, on average: what one task has in memory.
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF_ROWS = 128
FACTOR = 1.5
#: Pairs that are scored at once.
PAIRS = 1 << 16
#: Rounding of products of unit vectors that pruning allows for.
SLACK = 1e-9
_NONE = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    """Whether a vector can take part: not null, all components finite numbers, one not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class VantageTree:
    """A vantage-point tree over the rows of ``points``; leaves are row numbers."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.points = points
        self.squares = np.einsum("ij,ij->i", points, points)
        self.root = self._build(np.arange(len(points)), leaf_rows)

    def _distances(self, rows: np.ndarray, at: int) -> np.ndarray:
        rest = self.points[rows] - self.points[at]
        return np.sqrt(np.einsum("ij,ij->i", rest, rest))

    def _build(self, rows: np.ndarray, leaf_rows: int):
        if len(rows) <= leaf_rows:
            return rows
        # The row farthest from the first one sees the others at the most varied distances.
        vantage = int(rows[np.argmax(self._distances(rows, int(rows[0])))])
        distance = self._distances(rows, vantage)
        middle = float(np.median(distance))
        inside = distance <= middle
        if inside.all():
            return rows  # all at one distance: nothing to split by
        near, far = distance[inside], distance[~inside]
        return (
            vantage,
            middle,
            (float(near.min()), float(near.max())),
            (float(far.min()), float(far.max())),
            self._build(rows[inside], leaf_rows),
            self._build(rows[~inside], leaf_rows),
        )

    def search(self, queries: Queries, factor: float) -> None:
        """Offers the queries every row that ``factor`` does not leave out."""
        self.queries, self.factor = queries, factor
        self._visit(self.root, np.arange(len(queries.ids)))

    def _visit(self, node, asked: np.ndarray) -> None:
        if not len(asked):
            return
        if isinstance(node, np.ndarray):
            self.queries.offer(asked, node)
            return
        vantage, middle, near_span, far_span, near, far = node
        distance = self.queries.distances(asked, self.points[vantage], self.squares[vantage])
        first = distance <= middle
        self._visit(near, asked[first])
        self._visit(far, asked[~first])
        for side, span, rest in ((far, far_span, first), (near, near_span, ~first)):
            least = np.maximum(np.maximum(distance - span[1], span[0] - distance), 0)
            worst = self.queries.worst(asked)
            self._visit(side, asked[rest & (least * self.factor <= worst * (1 + SLACK) + SLACK)])


class Queries:
    """A block of queries over the rows of one shard, with the k best of each, by score and then id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
        self.ids, self.vectors, self.rows, self.row_ids, self.k = ids, vectors, rows, row_ids, k
        self.scaled, largest = _to_unit(rows, rows)
        norms = np.einsum("ij,ij->i", self.scaled, self.scaled)
        self.reach = norms.max()
        self.lifted = np.column_stack([self.scaled, np.sqrt(np.maximum(self.reach - norms, 0))])
        own, sizes = _to_unit(vectors, vectors, each=True)
        self.unit = own / np.sqrt(np.einsum("ij,ij->i", own, own))[:, None]
        # A product that may leave the range of doubles is not pruned by its size.
        self.wild = np.log2(np.abs(vectors).max(axis=1)) + np.log2(largest) + np.log2(rows.shape[1]) > 1022
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), _NONE, dtype=np.int64)
        self.near = np.full((len(ids), k), -np.inf)  # the unit query's products, for pruning

    def distances(self, asked: np.ndarray, point: np.ndarray, square: float) -> np.ndarray:
        return np.sqrt(np.maximum(1 + square - 2 * (self.unit[asked] @ point[:-1]), 0))

    def worst(self, asked: np.ndarray) -> np.ndarray:
        least = np.where(self.wild[asked], -np.inf, self.near[asked].min(axis=1))
        return np.sqrt(np.maximum(1 + self.reach - 2 * least, 0))

    def offer(self, asked: np.ndarray, node: np.ndarray) -> None:
        for low in range(0, len(node), LEAF_ROWS):
            rows = node[low : low + LEAF_ROWS]
            products = self.unit[asked] @ self.scaled[rows].T
            least = np.where(self.wild[asked], -np.inf, self.near[asked].min(axis=1))
            close = (products >= least[:, None] - SLACK) & (self.row_ids[rows][None, :] != self.ids[asked][:, None])
            which, at = np.nonzero(close)
            for i in range(0, len(which), PAIRS):
                self._merge(asked[which[i : i + PAIRS]], rows[at[i : i + PAIRS]], products[which[i : i + PAIRS], at[i : i + PAIRS]])

    def _merge(self, query: np.ndarray, row: np.ndarray, product: np.ndarray) -> None:
        score = (self.rows[row] * self.vectors[query]).sum(axis=1)
        met = np.unique(query)
        owner = np.concatenate([np.repeat(met, self.k), query])
        score = np.concatenate([self.score[met].ravel(), score])
        ids = np.concatenate([self.found[met].ravel(), self.row_ids[row]])
        product = np.concatenate([self.near[met].ravel(), product])
        order = np.lexsort((ids, -score, ids == _NONE, owner))
        owner = owner[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        best = rank < self.k
        at = (owner[best], rank[best])
        self.score[at], self.found[at], self.near[at] = score[order][best], ids[order][best], product[order][best]


def _to_unit(vectors: np.ndarray, of: np.ndarray, each: bool = False) -> tuple[np.ndarray, np.ndarray | float]:
    """Vectors times a power of two, all or each, that brings their largest component near one; and that component."""
    largest = np.abs(of).max(axis=1) if each else np.abs(of).max()
    _, exponent = np.frexp(largest)
    return np.ldexp(vectors, -exponent[:, None] if each else -exponent), largest


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``queries`` holds, their k nearest others.

    Nearness is the largest inner product, ties go to the smaller id.  Rows with null ids,
    or vectors that are null, zero or hold a component that is null or no finite number,
    take no part.  Rows that share the query's id are its own.  Vectors of different length
    are never compared.  Repeated rows are answered once as queries (of several vectors with one
    id, the smallest is asked for), and each as candidates.  A product beyond the range of
    doubles is infinite, and none that is no number is ranked before one that is.
    """
    points = stored(
        vectors.filter(usable(F.col(vector_column)) & F.col(id_column).isNotNull()).select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(vector_column).cast("array<double>").alias("vector"),
            F.coalesce(queries, F.lit(False)).alias("asked"),
        ),
        "vectors",
    )
    # Of equal vectors the k + 1 smallest ids can be among the nearest k; salted, for one may be a third of all.
    twins = points.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for keys in (["vector", "salt"], ["vector"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        twins = twins.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    largest = F.array_max(F.transform("vector", F.abs))
    held = stored(twins.select("vec_id", "vector", F.floor(F.log2(largest)).cast("int").alias("band")), "points")
    bands = {r["band"]: math.ceil(r["count"] / shard_rows) for r in held.groupBy("band").count().collect()}  # exponents of doubles
    n_asked = points.filter("asked").count()
    blocks = max(1, math.ceil(n_asked / block_queries))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), n).cast("int")
    keys = ["size", "band", "shard", "block"]
    shards = F.create_map(*[F.lit(x) for pair in sorted(bands.items()) for x in pair] or [F.lit(0), F.lit(1)])
    rows = held.select(
        "vec_id",
        "vector",
        F.size("vector").alias("size"),
        "band",
        spread(shards[F.col("band")], 1).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    every = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(i).alias("shard")) for b, n in sorted(bands.items()) for i in range(n)])
    once = points.filter("asked").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = (
        once.select("vec_id", "vector", F.size("vector").alias("size"), spread(F.lit(blocks), 2).alias("block"), F.explode(every).alias("part"))
        .select("vec_id", "vector", "size", "block", "part.*")
        if bands
        else once.select("vec_id", "vector", *[F.lit(0).alias(c) for c in keys])
    )

    def answer(key, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _answers(held, asked, k, factor)

    found = (
        rows.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(answer, "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _answers(held: pd.DataFrame, asked: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    if held.empty or asked.empty:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    with np.errstate(over="ignore", invalid="ignore"):
        rows = np.stack(held["vector"].to_numpy()) + 0.0  # -0.0 becomes 0.0
        questions = Queries(
            asked["vec_id"].to_numpy(), np.stack(asked["vector"].to_numpy()) + 0.0, rows, held["vec_id"].to_numpy(), k
        )
        VantageTree(questions.lifted).search(questions, factor)
    there = questions.found != _NONE
    return pd.DataFrame(
        {
            "query_id": np.repeat(questions.ids, there.sum(axis=1)),
            "vec_id": questions.found[there],
            "score": questions.score[there],
        }
    )
