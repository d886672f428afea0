"""Approximate nearest neighbours over learned partitions.

A bounded sample gives a nearest-neighbour graph; the graph is cut into
balanced parts that keep neighbours together; a small classifier learns which
part a vector belongs to. Every row is filed under its most probable part, a
query visits its several most probable parts, and the rows found there are
ranked by exact distance.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnlake.llm.vectors import bounded_sample, matrix, usable
from tarnlake.session import materialize

#: Bounds of the fitted index: rows in a sample, parts that one router tells
#: apart, neighbours, hidden units. The number of parts grows with the square
#: root of the rows, up to MAX_PARTS; parts of the first level that then hold
#: more than twice ROWS_PER_PART rows are cut again by routers of their own, up
#: to MAX_PARTS * MAX_PARTS in all.
MAX_SAMPLE = 8192
MAX_PARTS = 128
ROWS_PER_PART = 1000
FINE_SAMPLE = 2048
GRAPH_DEGREE = 10
HIDDEN = 64
#: Share of sample neighbours that the visited parts must hold.
TARGET_RECALL = 0.95
#: Rows of one part, and queries, that one task compares at a time.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048


def knn_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Exact neighbours in the sample, block by block."""
    sq = (x * x).sum(axis=1)
    out = np.empty((len(x), degree), np.int64)
    for at in range(0, len(x), 512):
        d = sq[at : at + 512, None] + sq[None, :] - 2 * x[at : at + 512] @ x.T
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        out[at : at + 512] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    return out


def balanced_parts(graph: np.ndarray, parts: int, passes: int = 8, slack: float = 1.1) -> np.ndarray:
    """Cut the graph into parts of nearly equal size, few edges crossing.

    Nodes join, in breadth-first order, the part with most of their
    neighbours, discounted by how full it is; further passes let them move.
    """
    n = len(graph)
    around: list[list[int]] = [list(x) for x in graph.tolist()]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            around[j].append(i)
    order, seen = [], np.zeros(n, bool)
    for start in range(n):
        if not seen[start]:
            seen[start] = True
            queue = [start]
            for i in queue:
                for j in around[i]:
                    if not seen[j]:
                        seen[j] = True
                        queue.append(j)
            order += queue
    part, size, limit = np.full(n, -1), np.zeros(parts), slack * n / parts
    for _ in range(passes):
        for i in order:
            if part[i] >= 0:
                size[part[i]] -= 1
            near = part[around[i]]
            score = np.bincount(near[near >= 0], minlength=parts) * (1 - size / limit)
            score[size >= limit] = -1
            best = int(np.argmax(score)) if score.max() > 0 else int(np.argmin(size))
            part[i] = best
            size[best] += 1
    return part


class Router:
    """A classifier with one hidden layer, fitted by Adam on soft labels."""

    def __init__(self, x: np.ndarray, soft: np.ndarray, hidden: int = HIDDEN, epochs: int = 40, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std() + 1e-12
        z = (x - self.mean) / self.scale
        shapes = [(z.shape[1], hidden), (hidden,), (hidden, soft.shape[1]), (soft.shape[1],)]
        p = [rnd.normal(0, 1 / np.sqrt(max(s[0], 1)), s) if len(s) == 2 else np.zeros(s) for s in shapes]
        m, v, t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for _ in range(epochs):
            for rows in np.array_split(rnd.permutation(len(z)), max(1, len(z) // 128)):
                t += 1
                a = np.maximum(z[rows] @ p[0] + p[1], 0)
                d = (self._soft(a @ p[2] + p[3]) - soft[rows]) / len(rows)
                back = (d @ p[2].T) * (a > 0)
                grads = [z[rows].T @ back, back.sum(0), a.T @ d, d.sum(0)]
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.p = p

    @staticmethod
    def _soft(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        z = (x - self.mean) / self.scale
        return np.argsort(-(np.maximum(z @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]), axis=1, kind="stable")


def fit_router(sample: np.ndarray, parts: int) -> tuple[Router | None, int]:
    """Router and number of parts to visit; None: one part holds everything."""
    if parts < 2 or len(sample) < 2 * parts:
        return None, 1
    degree = min(GRAPH_DEGREE, len(sample) - 1)
    graph = knn_graph(sample, degree)
    part = balanced_parts(graph, parts)
    soft = np.zeros((len(sample), parts))
    np.add.at(soft, (np.arange(len(sample)), part), degree / 2)
    np.add.at(soft, (np.repeat(np.arange(len(sample)), degree), part[graph].ravel()), 1.0)
    # Fitted on four fifths; how many parts to visit is read from the rest.
    held = np.arange(len(sample)) % 5 == 0
    router = Router(sample[~held], (soft / soft.sum(axis=1, keepdims=True))[~held])
    order = router.order(sample)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(sample), 0), axis=1)
    filed = order[:, 0]
    rank = np.sort(place[np.flatnonzero(held)[:, None], filed[graph[held]]].ravel())
    return router, int(rank[min(len(rank) - 1, int(TARGET_RECALL * len(rank)))]) + 1


class Index:
    """A router over parts, and routers of their own for the large ones."""

    def __init__(self, router: Router | None, visits: int, width: int):
        self.router, self.visits, self.width = router, visits, width
        self.fine: dict[int, tuple[Router, int]] = {}

    def route(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the part a row is filed in, or those a query visits."""
        n = len(x)
        order = self.router.order(x)[:, : self.visits if query else 1] if self.router else np.zeros((n, 1), np.int64)
        rows, parts = [], []
        for coarse in np.unique(order):
            hit = np.flatnonzero((order == coarse).any(axis=1))
            below = np.zeros((len(hit), 1), np.int64)
            if coarse in self.fine:
                router, visits = self.fine[coarse]
                below = router.order(x[hit])[:, : visits if query else 1]
            rows.append(np.repeat(hit, below.shape[1]))
            parts.append((coarse * self.width + below).ravel())
        return (np.concatenate(rows), np.concatenate(parts)) if rows else (np.zeros(0, np.int64),) * 2


def _routed(df: DataFrame, index: Index, query: bool) -> DataFrame:
    """Add ``part``: one row for the part a row is filed in or each it visits."""
    names = [*df.columns, "part"]
    at = df.columns.index("vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                row, part = index.route(matrix(b.column(at)), query)
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(row)).columns, pa.array(part.astype(np.int32))], names=names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, part int")


def build_index(folded: DataFrame, n: int, rows_per_part: int = ROWS_PER_PART, max_parts: int = MAX_PARTS) -> Index:
    """Fit the index of ``n`` vectors on samples of bounded size.

    About sqrt(n) parts, two at least where the vectors allow a graph. First-level parts with
    more than twice ``rows_per_part`` rows get a router of their own, fitted in
    one task each on ``FINE_SAMPLE`` of their rows; the driver sees at most
    ``max_parts`` such routers.
    """
    parts = int(min(max_parts, max(2, round(n**0.5))))
    by_hash = F.xxhash64(F.lit(3), "h1", "h2")
    sample = bounded_sample(folded, by_hash, n, min(MAX_SAMPLE, max(2048, 64 * parts))).select("vec").collect()
    index = Index(*fit_router(np.array([r.vec for r in sample], np.float64), parts), max_parts)
    if n <= 2 * rows_per_part * parts:
        return index
    filed = materialize(_routed(folded.select("h1", "h2", "vec"), index, False), "coarse")
    wide = filed.groupBy(F.floor(F.col("part") / max_parts).cast("int").alias("coarse")).count()
    wide = wide.select("coarse", F.least(F.lit(max_parts), F.floor(F.col("count") / rows_per_part)).cast("int").alias("cut")).where("cut > 2")
    nth = F.row_number().over(W.partitionBy("part").orderBy(by_hash, "h1"))
    picked = filed.withColumn("nth", nth).where(F.col("nth") <= FINE_SAMPLE).withColumn("coarse", F.floor(F.col("part") / max_parts).cast("int"))

    def fit(key: tuple, t: pa.Table) -> pa.Table:
        router, visits = fit_router(matrix(t.column("vec")), t.column("cut")[0].as_py())
        return pa.table({"coarse": pa.array([key[0].as_py()], pa.int32()), "model": pa.array([pickle.dumps((router, visits))], pa.binary())})

    models = picked.join(wide, "coarse").groupBy("coarse").applyInArrow(fit, "coarse int, model binary").collect()
    found = {r.coarse: pickle.loads(r.model) for r in models}
    index.fine = {c: m for c, m in found.items() if m[0] is not None}
    return index


def _nearest(q: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query row the k least distances and all ties with the last."""
    sq = (x * x).sum(axis=1)
    for at in range(0, len(q), 64):
        part = q[at : at + 64]
        rough = (part * part).sum(axis=1)[:, None] + sq[None, :] - 2 * part @ x.T
        for r in range(len(part)):
            near = np.arange(len(x))
            if len(x) > k:
                last = np.partition(rough[r], k - 1)[k - 1]
                near = np.flatnonzero(rough[r] <= last + 1e-9 * (abs(last) + sq.max() + 1))
            d = np.sqrt(((x[near] - part[r]) ** 2).sum(axis=1))
            if len(near) > k:
                keep = d <= np.partition(d, k - 1)[k - 1]
                near, d = near[keep], d[keep]
            yield at + r, near, d


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    rows_per_part: int = ROWS_PER_PART,
    max_parts: int = MAX_PARTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score, visits, compared): the k nearest rows
    found, own id left out; the parts that the query visited, and how many
    distinct vectors they hold.

    Score is the Euclidean distance in double precision on the given vectors;
    ties go to the smaller id. Vectors that are null, zero, hold null or
    non-finite components, or have not the most frequent dimension take no
    part; nor do null ids. Rows of one id count once (of different vectors, the
    one of least hash). Equal vectors are folded before
    the search: only their k+1 least ids can be among anyone's k nearest, so
    folding loses nothing and a vector held by a third of all rows costs one
    comparison. Parts are compared in blocks of rows and queries, so a part
    that draws many rows is spread over tasks.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), is_query.alias("q"))
    src = src.where(F.col("id").isNotNull() & usable(F.col("vec")))
    src = src.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(7), F.reverse("vec"))})
    src = src.groupBy("id").agg(F.min_by(F.struct("vec", "q", "h1", "h2"), F.struct("h1", "h2")).alias("r")).select("id", "r.*")
    sizes = src.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = sizes["d"] if sizes else 0
    src = src.where(F.size("vec") == dim)
    least = W.partitionBy("h1", "h2").orderBy("id")
    top = src.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1)
    folded = materialize(
        top.groupBy("h1", "h2").agg(F.min_by("vec", "id").alias("vec"), F.array_sort(F.collect_list("id")).alias("ids")), "folded"
    )
    asked = src.where(F.coalesce("q", F.lit(False))).select(F.col("id").alias("query_id"), "h1", "h2")
    n = folded.count()
    index = build_index(folded, n, rows_per_part, max_parts)
    filed = materialize(_routed(folded, index, False), "filed")
    queries = folded.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "vec")
    routed = materialize(_routed(queries, index, True), "routed")
    # One row a part, at most ``max_parts`` squared: blocks of a part, by its number of rows.
    blocks = (
        filed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("vb"), F.count(F.lit(1)).alias("held"))
        .join(routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("qb")), "part")
    )
    blocks = F.broadcast(materialize(blocks, "blocks"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    rows = filed.join(blocks, "part").select(
        "part", F.pmod("h2", F.col("vb")).cast("int").alias("v"), every("qb").alias("w"), "ids", "vec"
    )
    asks = routed.join(blocks, "part").select(
        "part", every("vb").alias("v"), F.pmod("h2", F.col("qb")).cast("int").alias("w"), "h1", "h2", "vec"
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        q = matrix(left.column("vec")) if left.num_rows else np.zeros((0, dim))
        x = matrix(right.column("vec")) if right.num_rows else np.zeros((0, dim))
        h1, h2 = left.column("h1").to_numpy(), left.column("h2").to_numpy()
        ids = right.column("ids").combine_chunks()
        flat, begin = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])
        out: list[tuple] = []
        for row, near, d in _nearest(q, x, k + 1) if len(x) else ():
            pairs = [(dist, i) for j, dist in zip(near.tolist(), d.tolist(), strict=True) for i in flat[begin[j] : begin[j + 1]].tolist()]
            out += [(h1[row], h2[row], i, dist) for dist, i in sorted(pairs)[: k + 1]]
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["h1", "h2", "vec_id", "score"])

    key = ["part", "v", "w"]
    found = asks.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(compare, "h1 long, h2 long, vec_id long, score double")
    best = W.partitionBy("h1", "h2").orderBy("score", "vec_id")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    own = W.partitionBy("query_id").orderBy("score", "vec_id")
    effort = routed.join(blocks, "part").groupBy("h1", "h2").agg(F.count(F.lit(1)).cast("int").alias("visits"), F.sum("held").alias("compared"))
    named = asked.join(found, ["h1", "h2"]).where("query_id != vec_id").join(effort, ["h1", "h2"])
    named = named.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return named.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "visits", "compared")
