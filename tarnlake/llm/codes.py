"""Vector codes: product quantization with codebooks searched by GNATs.

Vectors are cut into parts; each part position has a codebook. The nearest
entry of a part is found in a geometric near-neighbour access tree over the
codebook: split points hold, for every child, the range of the child's
distances to them, and a query's distances to the split points rule out whole
children.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.vectors import ceil_root, finite, floor_root, matrix, scaled, square_distances, take_nearer
from tarnlake.session import materialize

#: Split points of a node; nodes of so many entries are leaves.
ARITY = 16
FURTHEST = np.iinfo(np.int64).max


class Gnat:
    """A geometric near-neighbour access tree over integer entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.d = square_distances(entries, entries)
        self.root = self._node(np.arange(len(entries)))

    def _node(self, at: np.ndarray) -> tuple:
        """(split points, low, high, children), or (entries,) of a leaf."""
        if len(at) <= ARITY:
            return (at,)
        # Split points far from one another; entries equal to one go to its child.
        split = [int(at[0])]
        gap = self.d[split[0], at].copy()
        while len(split) < ARITY and gap.max() > 0:
            split.append(int(at[gap.argmax()]))
            gap = np.minimum(gap, self.d[split[-1], at])
        if len(split) == 1:
            return (at,)
        rest = at[~np.isin(at, split)]
        home = self.d[np.ix_(split, rest)].argmin(axis=0)
        low, high, children = np.empty((len(split),) * 2), np.empty((len(split),) * 2), []
        for j, p in enumerate(split):
            below = rest[home == j]
            d = self.d[np.ix_(split, [p, *below])]
            low[:, j], high[:, j] = floor_root(d.min(axis=1)), ceil_root(d.max(axis=1))
            children.append(self._node(below) if len(below) else None)
        return np.array(split), low, high, children

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row: the nearest, ties to the lower index."""
        best, who = np.full(len(x), FURTHEST), np.full(len(x), len(self.entries))
        if len(x):
            self._visit(self.root, x, np.arange(len(x)), best, who)
        return who, best

    def _visit(self, node: tuple, x: np.ndarray, rows: np.ndarray, best: np.ndarray, who: np.ndarray) -> None:
        """A child is ruled out only where its range lies strictly beyond the
        radius found, all roots rounded to its favour: an entry that ties is
        met, and the exact distances decide."""
        if len(node) == 1:
            d = square_distances(x[rows], self.entries[node[0]])
            least = d.min(axis=1)
            name = np.where(d == least[:, None], node[0][None, :], len(self.entries)).min(axis=1)
            take_nearer(best, who, rows, least, name)
            return
        split, low, high, children = node
        alive = np.ones((len(rows), len(split)), bool)
        near, far = np.zeros((len(rows), len(split))), np.zeros((len(rows), len(split)))
        for i, p in enumerate(split):
            on = np.flatnonzero(alive[:, i])
            d = square_distances(x[rows[on]], self.entries[p : p + 1])[:, 0]
            take_nearer(best, who, rows[on], d, np.full(len(on), p))
            radius = ceil_root(best[rows[on]])[:, None]
            near[on, i], far[on, i] = floor_root(d), ceil_root(d)
            beyond = (near[on, i, None] - radius > high[i]) | (far[on, i, None] + radius < low[i])
            beyond[:, i] = near[on, i] - radius[:, 0] > high[i, i]
            alive[on] &= ~beyond
        for j, below in enumerate(children):
            if below is not None:
                # The radius may have shrunk in the children before.
                on = alive[:, j] & (near[:, j] - ceil_root(best[rows]) <= high[j, j])
                if on.any():
                    self._visit(below, x, rows[on], best, who)


class Codebooks:
    """A GNAT for each part position."""

    def __init__(self, entries: np.ndarray):
        self.trees = [Gnat(e) for e in entries]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances), each rows by parts."""
        cut = np.split(x, len(self.trees), axis=1)
        found = [t.nearest(part) for t, part in zip(self.trees, cut, strict=True)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def compress_vectors(
    vectors: DataFrame, parts: int = 4, size: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector.

    Components become floor(scale * x); codebooks start as the parts of the
    ``size`` least ids (of rows with one id, the lesser vectors first) and are
    moved ``rounds`` times to the exact floor of their parts' means; unused
    entries stay. A code is the parts' entries, two hex digits each.
    ``label_error`` adds up the errors of equal labels, nulls together.

    Null vectors and such with null or non-finite components are dropped. So
    are vectors that have not the commonest length divisible by ``parts`` (the
    shorter of equally common ones), since no codebook fits them, and those
    with a scaled component of 2**27 and more, whose distances leave 64 bits.
    Rows without an id are coded but start no entry; repeated rows count as
    often as they come. Fewer rows than ``size`` give shorter codebooks, none an
    empty table. Other columns are not read. A task keeps size * parts sums,
    whatever its rows.
    """
    if not 1 <= size <= 256:
        raise ValueError("codes of two hex digits tell 256 entries apart")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    src = src.where(finite(F.col("vec")) & (F.size("vec") > 0) & (F.size("vec") % parts == 0))
    kept = materialize(src.select("vec_id", "label", scaled(F.col("vec"), scale).alias("ints")).where("ints is not null"), "kept")
    lengths = kept.groupBy(F.size("ints").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = lengths["d"] if lengths else 0
    kept = kept.where(F.size("ints") == dim)
    # The last of the least ids first, so that no more than the rows up to it are sorted whole.
    last = kept.where("vec_id is not null").select("vec_id").orderBy("vec_id").limit(size).agg(F.max("vec_id")).first()[0]
    first = kept.where(F.col("vec_id") <= F.lit(last)).orderBy("vec_id", "ints").limit(size).select("ints").collect()
    if not first:
        return kept.where("false").selectExpr("vec_id", "'' code", "0L error", "0L label_error", "'' codebooks_sha256")
    wide = dim // parts
    books = np.stack(np.split(np.array([r.ints for r in first], np.int64), parts, axis=1))
    n, sc = books.shape[1], kept.sparkSession.sparkContext
    for _ in range(rounds):
        found = sc.broadcast(Codebooks(books))  # size * parts entries

        def gather(batches: Iterator[pa.RecordBatch], found=found) -> Iterator[pa.RecordBatch]:
            count, sums = np.zeros((parts, n), np.int64), np.zeros((parts, n, wide), np.int64)
            for b in batches:
                x = matrix(b.column(0), np.int64)
                code, _ = found.value.encode(x)
                for p, part in enumerate(np.split(x, parts, axis=1)):
                    count[p] += np.bincount(code[:, p], minlength=n)
                    np.add.at(sums[p], code[:, p], part)
            p, e = np.nonzero(count)
            cols = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["p", "e", "n", "sums"])

        rows = kept.select("ints").mapInArrow(gather, "p int, e int, n long, sums array<long>")
        every = F.array(*[F.sum(F.col("sums")[i]) for i in range(wide)])
        for r in rows.groupBy("p", "e").agg(F.sum("n").alias("n"), every.alias("sums")).collect():
            books[r.p, r.e] = [s // r.n for s in r.sums]
        found.unpersist()
    last = sc.broadcast(Codebooks(books))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, d = last.value.encode(matrix(b.column(2), np.int64))
            text = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(d.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    shape = f"vec_id long, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    coded = materialize(kept.select("vec_id", "label", "ints").mapInArrow(encode, shape), "coded")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    sums = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    named = coded.join(sums, F.col("label").eqNullSafe(F.col("_of")))
    return named.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
