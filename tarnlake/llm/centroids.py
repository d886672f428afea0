"""Centroid clustering whose assignments search a vantage-point tree.

Each round builds a vantage-point tree over the centroids and broadcasts it.
Every vector finds its nearest centroid by best-first branch and bound: it
opens the node of least lower bound next and stops at the first node whose
bound exceeds the distance found. All rows of a batch take their steps side by
side, each with a frontier of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.vectors import ceil_root, finite, floor_root, matrix, row_distances, scaled, square_distances, take_nearer
from tarnlake.session import materialize

#: Centroids in a leaf of the tree.
LEAF = 4
FURTHEST = np.iinfo(np.int64).max


class VantageTree:
    """A vantage-point tree over integer points, laid out in arrays.

    An inner node holds a vantage point and two children with the least and
    greatest distance of their points from it, rounded outwards; a leaf holds
    up to ``LEAF`` points, padded by repeating one.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.vantage: list[int] = []
        self.child: list[list[int]] = []
        self.low: list[list[float]] = []
        self.high: list[list[float]] = []
        self.leaf: list[list[int]] = []
        self._add(np.arange(len(points)), square_distances(points, points))
        self.arrays = [np.array(x) for x in (self.vantage, self.child, self.low, self.high, self.leaf)]

    def _add(self, at: np.ndarray, d: np.ndarray) -> int:
        node = len(self.vantage)
        self.vantage.append(-1)
        self.child.append([0, 0])
        self.low.append([0.0, 0.0])
        self.high.append([0.0, 0.0])
        self.leaf.append([int(x) for x in np.resize(at, LEAF)])
        if len(at) <= LEAF:
            return node
        # The point whose distances to the others are spread most tells them apart best.
        spread = np.sqrt(d[np.ix_(at, at)].astype(np.float64)).var(axis=1)
        v = int(at[spread.argmax()])
        rest = at[at != v]
        rest = rest[np.lexsort((rest, d[v, rest]))]
        self.vantage[node] = v
        for side, part in enumerate((rest[: len(rest) // 2], rest[len(rest) // 2 :])):
            self.low[node][side] = float(floor_root(d[v, part].min()))
            self.high[node][side] = float(ceil_root(d[v, part].max()))
            self.child[node][side] = self._add(part, d)
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each row of ``x``.

        A node is opened while its bound does not exceed the radius found, so
        that centroids at equal distance are all met and the lowest number
        wins. Bounds are rounded down, distances are exact integers.
        """
        vantage, child, low, high, leaf = self.arrays
        n = len(x)
        best, who = np.full(n, FURTHEST), np.full(n, len(self.points))
        bound = np.full((n, len(vantage)), np.inf)
        bound[:, 0] = 0
        live = np.arange(n)
        while len(live):
            node = bound[live].argmin(axis=1)
            least = bound[live, node]
            on = least <= ceil_root(best[live])
            live, node, least = live[on], node[on], least[on]
            bound[live, node] = np.inf
            inner = vantage[node] >= 0
            rows, v = live[inner], node[inner]
            d = row_distances(x[rows], self.points[vantage[v]])
            take_nearer(best, who, rows, d, vantage[v])
            for side in (0, 1):
                gap = np.maximum(low[v, side] - ceil_root(d), floor_root(d) - high[v, side])
                bound[rows, child[v, side]] = np.maximum(gap, least[inner])
            rows, v = live[~inner], node[~inner]
            for i in range(LEAF):
                take_nearer(best, who, rows, row_distances(x[rows], self.points[leaf[v, i]]), leaf[v, i])
        return who, best


def _summed(kept: DataFrame, assign: Callable[[np.ndarray], np.ndarray], k: int, dim: int) -> dict[int, tuple[int, list[int]]]:
    """(count, component sums) of each cluster: one row a cluster and task,
    added up by cluster; ``k`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            x = matrix(b.column(0), np.int64)
            who = assign(x)
            n += np.bincount(who, minlength=k)
            np.add.at(sums, who, x)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(n[hit]), pa.array(sums[hit].tolist(), pa.list_(pa.int64()))], names=["c", "n", "sums"])

    parts = kept.select("ints").mapInArrow(run, "c int, n long, sums array<long>")
    every = F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)])
    return {r.c: (r.n, r.sums) for r in parts.groupBy("c").agg(F.sum("n").alias("n"), every.alias("sums")).collect()}


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)
    of every vector with exactly ``dim`` components, none null or non-finite.

    Components become floor(scale * x). The first centroids are the ``k``
    vectors with the least SHA-256 of salt and id (equal hashes: the lesser
    vector); a round assigns every vector to its nearest centroid, ties to the
    smaller number, and moves every non-empty centroid to the exact floor of
    its vectors' mean. The result is the assignment after ``rounds`` rounds.

    Null vectors and vectors of other lengths take no part, nor do vectors with
    a scaled component of 2**27 and more, whose distances leave 64 bits. Rows
    without an id are assigned but start no centroid. Repeated rows count as
    often as they come. Fewer than ``k`` vectors give as many centroids; none
    give an empty table. Other columns are not read. Every task keeps k sums,
    whatever its rows, so a cluster of any size is added up in parts.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    src = src.where((F.size("vec") == dim) & finite(F.col("vec")))
    kept = materialize(src.select("vec_id", scaled(F.col("vec"), scale).alias("ints")).where("ints is not null"), "kept")
    by_hash = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    # The k-th hash first, so that no more than the rows up to it are sorted whole.
    hashes = kept.where("vec_id is not null").select(by_hash.alias("h"), "ints")
    last = hashes.select("h").orderBy("h").limit(k).agg(F.max("h")).first()[0]
    first = hashes.where(F.col("h") <= F.lit(last)).orderBy("h", "ints").limit(k).select("ints").collect()
    centroids = np.array([r.ints for r in first], np.int64).reshape(-1, dim)
    sc = kept.sparkSession.sparkContext
    if not len(centroids):
        return kept.where("false").selectExpr("vec_id", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    for _ in range(rounds):
        tree = sc.broadcast(VantageTree(centroids))  # k points
        found = _summed(kept, lambda x, tree=tree: tree.value.nearest(x)[0], len(centroids), dim)
        tree.unpersist()
        for c, (n, sums) in found.items():
            centroids[c] = [s // n for s in sums]
    tree = sc.broadcast(VantageTree(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, d = tree.value.nearest(matrix(b.column(1), np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(who, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"])

    filed = materialize(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "filed")
    totals = {r.cluster: r.total for r in filed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    whole = sum(totals.values())
    rows = [(c, t, whole, digest(centroids[c].tolist())) for c, t in totals.items()]
    table = filed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    named = filed.join(F.broadcast(table), "cluster")  # at most k rows
    return named.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
