"""Approximate nearest neighbours with a vantage-point tree per shard.

Vectors are dealt to shards by a hash; each shard builds one tree: a vantage point, the
nearer and the farther half of the rest by distance to it, and so on.  Queries go to every
shard in blocks and descend the tree together.  A half is skipped when the triangle
inequality says that nothing in it can be nearer than the query's k-th best,
lower bound > factor x k-th best: factor 1 restores exact search, a smaller one skips more.
Each (shard, query block) is one task; the k best of a shard are merged by a window that
keeps k rows per query on each side of the shuffle.

Defined cases
* vectors that are null, empty, zero, or hold null or non-finite components, and rows with
  a null id, take no part, neither as query nor as candidate.
* vectors meet only vectors of the same length.
* repeated vec_id: every row is a candidate; a query never meets rows with its own id; the
  rows of a repeated query id are one query, by the row that sorts first.
* equal vectors: any number of them; equal distances go to the smaller vec_id.
* fewer candidates than k: all of them.  Empty table: no rows.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ship_package

K = 10
FACTOR = 1.0
LEAF = 64
SHARD_ROWS = 8192
QUERY_ROWS = 4096
SLACK = 1 + 1e-9  # rounding of distances never skips a half that the exact bound admits


def distances(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of each row of ``points`` to each row of ``q``; (points, q).

    A sum over one fixed axis: a pair gets the same bits wherever it is computed."""
    out = np.empty((len(points), len(q)))
    step = max(1, (1 << 20) // max(1, q.size))
    for i in range(0, len(points), step):
        out[i:i + step] = np.sqrt(((q[None, :, :] - points[i:i + step, None, :]) ** 2).sum(axis=2))
    return out


class Tree:
    """A vantage-point tree over the rows of ``points``, kept as nested tuples."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.leaf = points, ids, leaf
        self.root = self.build(np.lexsort((ids,)))

    def build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return (rows,)
        # the row farthest from the first one makes a better vantage point than a random one
        vantage = rows[np.argmax(distances(self.points[rows[:1]], self.points[rows])[0])]
        d = distances(self.points[[vantage]], self.points[rows])[0]
        order = np.lexsort((self.ids[rows], d))
        rows, d = rows[order], d[order]
        half = len(rows) // 2  # by rank, so that any number of equal distances splits
        return vantage, d[half - 1], d[half], d[-1], self.build(rows[:half]), self.build(rows[half:])


class Search:
    """The k best of one tree for a block of queries."""

    def __init__(self, tree: Tree, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float):
        self.tree, self.q, self.own, self.k, self.factor = tree, queries, query_ids, k, factor
        self.best = np.full((len(queries), k), np.inf)
        self.best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.compared = 0
        self.visit(tree.root, np.arange(len(queries)))

    def admitted(self, bound: np.ndarray, q: np.ndarray) -> np.ndarray:
        return bound <= self.factor * self.best[q, -1] * SLACK

    def visit(self, node, q: np.ndarray) -> None:
        if not len(q):
            return
        if len(node) == 1:
            return self.compare(node[0], q)
        vantage, near_high, far_low, far_high, near, far = node
        d = distances(self.tree.points[[vantage]], self.q[q])[0]
        inside = d <= (near_high + far_low) / 2
        low_near = np.maximum(0, d - near_high)
        low_far = np.maximum(0, np.maximum(far_low - d, d - far_high))
        for group, steps in ((inside, ((near, low_near), (far, low_far))), (~inside, ((far, low_far), (near, low_near)))):
            for child, low in steps:  # bounds are tested when the child's turn comes
                some = q[group]
                self.visit(child, some[self.admitted(low[group], some)])

    def compare(self, rows: np.ndarray, q: np.ndarray) -> None:
        self.compared += len(rows) * len(q)
        d = distances(self.tree.points[rows], self.q[q]).T
        ids = np.broadcast_to(self.tree.ids[rows], d.shape)
        d = np.where(ids == self.own[q][:, None], np.inf, d)
        better = np.flatnonzero((d <= self.best[q, -1:]).any(axis=1))
        q, d, ids = q[better], d[better], ids[better]
        all_d = np.concatenate([self.best[q], d], axis=1)
        all_id = np.concatenate([self.best_id[q], np.where(np.isinf(d), np.iinfo(np.int64).max, ids)], axis=1)
        order = np.lexsort((all_id, all_d), axis=1)[:, :self.k]
        self.best[q] = np.take_along_axis(all_d, order, axis=1)
        self.best_id[q] = np.take_along_axis(all_id, order, axis=1)


def usable(vec: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query row; ``is_query``
    is a condition over vec_id and the other columns."""
    ship_package(vectors.sparkSession)
    vec = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.withColumn("dim", F.size("v"))
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, groups = max(1, -(-n // shard_rows)), max(1, -(-asked // query_rows))
    queries = rows.where("asks").groupBy("vec_id", "dim").agg(F.min("v").alias("v"))

    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards).cast("long"))
    held = rows.select("dim", spread.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("block"), "vec_id", "v")
    posed = queries.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("block"), "vec_id", "v")

    def search(points: pa.Table, asking: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if points.num_rows and asking.num_rows:
            tree = Tree(matrix(points.column("v")), points.column("vec_id").to_numpy(), leaf)
            own = asking.column("vec_id").to_numpy()
            found = Search(tree, matrix(asking.column("v")), own, k, factor)
            there = np.isfinite(found.best)
            out = {"query_id": np.broadcast_to(own[:, None], there.shape)[there], "vec_id": found.best_id[there], "score": found.best[there]}
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int64(), pa.int64(), pa.float64()))})

    keys = ["dim", "shard", "block"]
    found = held.groupBy(*keys).cogroup(posed.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
