"""Near-duplicate vectors through an inverted multi-index.

Unit vectors are cut into halves; each half has a codebook of its own, and the
pairs of entries form a grid of cells in which every vector is filed. A vector
visits the cells around its own in the order of its distance to their borders
(the multi-sequence order over both halves' sorted lists), until a linked
vector would be met with the target recall. Vectors met are verified by their
cosine.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.components import connected_components
from tarnlake.llm.vectors import bounded_sample, matrix, usable
from tarnlake.session import materialize, release

#: Bounds of the fitted index: sampled vectors, entries of a half's codebook.
MAX_SAMPLE, MAX_ENTRIES = 8192, 256
#: Vectors that a cell should hold on average; the grid grows with the rows.
ROWS_PER_CELL = 400
#: Share of the pairs just at the threshold that visits must bring together.
TARGET_RECALL = 0.99999
#: Partners drawn for each sampled vector to set the reach of the visits.
DRAWS = 16
#: Rows of one cell, and visitors, that one task compares at a time.
BLOCK = 4096
#: Cosines so close to the threshold are computed again in a fixed order.
CLOSE = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, initial=1e-323)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


class Half:
    """The codebook of one half: k-means over a sample."""

    def __init__(self, x: np.ndarray, size: int, passes: int = 10):
        rnd = np.random.default_rng(11)
        self.entries = np.unique(x[rnd.permutation(len(x))[:size]], axis=0)
        for _ in range(passes):
            own = self.gaps(x)[0]
            for j in range(len(self.entries)):
                if (own == j).any():
                    self.entries[j] = x[own == j].mean(axis=0)

    def gaps(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row, and the row's distance from the border
        between that entry and every other (0 for its own)."""
        c = self.entries
        d = (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T
        own = d.argmin(axis=1)
        apart = np.sqrt(np.maximum((c * c).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * c @ c.T, 0))[own]
        rows = np.arange(len(x))
        gap = np.divide(d - d[rows, own][:, None], 2 * apart, out=np.zeros_like(d), where=apart > 0)
        gap[rows, own] = 0
        return own, np.maximum(gap, 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Cells of the grid by growing distance from a vector, while within ``reach``.

    Both halves' lists are sorted; a cell is pushed once its neighbours before
    it in either list are popped, so few cells beyond the last are looked at.
    """
    a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
    x, y = (first[a] ** 2).tolist(), (second[b] ** 2).tolist()
    heap, limit = [(x[0] + y[0], 0, 0)], reach * reach
    while heap:
        s, i, j = heapq.heappop(heap)
        if s > limit:
            return
        yield int(a[i]), int(b[j])
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


class MultiIndex:
    """Two codebooks and how far from its own cell a vector visits."""

    def __init__(self, sample: np.ndarray, entries: int, cosine: float, recall: float):
        sample = np.pad(sample, ((0, 0), (0, max(0, 2 - sample.shape[1]))))
        self.dim = sample.shape[1]
        self.cut = self.dim // 2
        self.halves = [Half(h, entries) for h in self._halves(sample)]
        self.width = len(self.halves[1].entries)
        chord = math.sqrt(max(0.0, 2 - 2 * cosine))
        # Of a linked pair one lies within this of the other's cell: borders between
        # the two cells are crossed once, so squared gaps of both add up to the
        # squared distance at most.
        self.reach = chord / math.sqrt(2) * (1 + 1e-9)
        if recall < 1:
            self.reach = min(self.reach, self._measured(sample, cosine, recall))

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def _measured(self, x: np.ndarray, cosine: float, recall: float) -> float:
        """The reach that brings together that share of the pairs drawn at the
        threshold: the sampled vectors with partners in random directions."""
        rnd, near = np.random.default_rng(5), []
        x = x[(x != 0).any(axis=1)]
        for _ in range(DRAWS):
            w = rnd.normal(size=x.shape)
            w -= (w * x).sum(axis=1)[:, None] * x
            y = cosine * x + math.sqrt(1 - cosine * cosine) * w / np.maximum(np.sqrt((w * w).sum(axis=1)), 1e-300)[:, None]
            there, back, rows = np.zeros(len(x)), np.zeros(len(x)), np.arange(len(x))
            for half, p, q in zip(self.halves, self._halves(x), self._halves(y), strict=True):
                (own, gap), (other, gap_back) = half.gaps(p), half.gaps(q)
                there += gap[rows, other] ** 2
                back += gap_back[rows, own] ** 2
            near.append(np.minimum(there, back))
        return float(np.sqrt(np.quantile(np.concatenate(near), recall, method="higher"))) if len(x) else self.reach

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The cell of each row and the cells it visits, its own first."""
        x = x[:, : self.dim] if x.shape[1] >= self.dim else np.pad(x, ((0, 0), (0, self.dim - x.shape[1])))
        (own, gap), (other, far) = [h.gaps(p) for h, p in zip(self.halves, self._halves(x), strict=True)]
        cells = []
        for a, b, g, f in zip(own, other, gap, far, strict=True):
            home = int(a) * self.width + int(b)
            cells.append([home] + [c for i, j in multi_sequence(g, f, self.reach) if (c := i * self.width + j) != home])
        return own * self.width + other, cells


class _Groups:
    """Rows joined into groups of linked ones, each named by its least row."""

    def __init__(self, n: int):
        self.name = np.arange(n)

    def join(self, rows: np.ndarray) -> None:
        names = np.unique(self.name[rows])
        if len(names) > 1:
            self.name[np.isin(self.name, names)] = names[0]


def _linked(u: np.ndarray, x: np.ndarray, cosine: float) -> np.ndarray:
    """Pairs of unit rows whose cosine reaches the threshold."""
    s = u @ x.T
    hit = s >= cosine
    for i, j in zip(*np.nonzero(np.abs(s - cosine) < CLOSE), strict=True):
        hit[i, j] = math.fsum((u[i] * x[j]).tolist()) >= cosine
    return hit


def _compare(left: pa.Table, right: pa.Table, cosine: float) -> pa.Table:
    """Links between the visitors of a cell and its rows: for each row the
    links found here, by copies, and the least row it is joined with here.

    A pair whose vectors visit one another's cells is met twice; it counts in
    the lesser cell.
    """
    shape = pa.schema([("key", pa.string()), ("other", pa.string()), ("links", pa.int64())])
    if not left.num_rows or not right.num_rows:
        return shape.empty_table()
    here = right.column("at")[0].as_py()
    keys = [np.array(t.column("key").to_pylist()) for t in (left, right)]
    names, node = np.unique(np.concatenate(keys), return_inverse=True)
    guest, host = node[: left.num_rows], node[left.num_rows :]
    copies = [t.column("copies").to_numpy() for t in (left, right)]
    u, x = unit(matrix(left.column("vec"))), unit(matrix(right.column("vec")))
    home = left.column("cell").to_numpy()
    seen = right.column("visits").combine_chunks()
    flat, owner = seen.flatten().to_numpy(), np.repeat(np.arange(len(seen)), np.diff(seen.offsets.to_numpy()))
    met_there = {c: np.bincount(owner[flat == c], minlength=len(seen)) > 0 for c in np.unique(home) if c < here}
    links, groups = np.zeros(len(names), np.int64), _Groups(len(names))
    for at in range(0, len(u), 256):
        hit = _linked(u[at : at + 256], x, cosine)
        for row in np.flatnonzero(hit.any(axis=1)):
            i = at + row
            on = hit[row] & (host != guest[i])
            if home[i] < here:
                on &= ~met_there[home[i]]
            if on.any():
                links[guest[i]] += copies[1][on].sum()
                if home[i] != here:
                    links[host[on]] += copies[0][i]
                groups.join(np.append(host[on], guest[i]))
    hit = np.flatnonzero((groups.name != np.arange(len(names))) | (links > 0))
    return pa.table([pa.array(names[hit].tolist()), pa.array(names[groups.name[hit]].tolist()), pa.array(links[hit])], schema=shape)


def near_duplicate_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    target_recall: float = TARGET_RECALL,
    rows_per_cell: int = ROWS_PER_CELL,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows are linked if their labels are equal and not null and their vectors'
    cosine in double precision is at least ``cosine``; no link below it is
    returned. ``component_id`` is the smallest id reachable by links, ``kept``
    tells whether it is the row's own.

    Which cells are visited is fitted on at most ``MAX_SAMPLE`` vectors; all
    vectors are filed. With ``target_recall=1`` the visits reach as far as the
    proof requires (of any linked pair one vector lies within chord / sqrt(2)
    of the other's cell) and no link is missed; below it, they reach that share
    of pairs that lie just at the threshold, and more of closer ones.

    Vectors that are null, zero or hold null or non-finite components link with
    nothing, nor do rows without a label; vectors of different lengths have no
    cosine. Equal vectors of a label are folded first and count as often as
    they come. Rows without an id link others and count, but name no component
    (null, and kept, where no row of it has an id). Rows of one id are rows of
    their own. A cell or its visitors of any number are compared in blocks, and
    only counts and one edge a row leave a block. Other columns are not read.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    takes = F.col("label").isNotNull() & usable(F.col("vec"))
    name = F.md5(F.concat_ws(" ", F.hex(F.xxhash64("label", "vec")), F.hex(F.xxhash64(F.lit(7), F.reverse("vec"), "label"))))
    src = src.withColumn("key", F.when(takes, name)).select("vec_id", "label", "vec", "key")
    folded = src.where("key is not null").groupBy("key").agg(
        F.any_value("label").alias("label"), F.any_value("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")
    )
    folded = materialize(folded, "classes")
    n = folded.count()
    alone = src.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return alone
    dim = folded.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    sample = bounded_sample(folded.where(F.size("vec") == dim), F.xxhash64(F.lit(3), "key"), n, MAX_SAMPLE).select("vec").collect()
    entries = int(min(MAX_ENTRIES, max(2, math.sqrt(n / rows_per_cell))))
    index = MultiIndex(unit(np.array([r.vec for r in sample], np.float64)), entries, cosine, target_recall)
    names = ["key", "label", "vec", "copies"]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.array([len(v) for v in b.column(2)])
            for d in np.unique(sizes):
                part = b.filter(pa.array(sizes == d))
                cell, seen = index.visits(unit(matrix(part.column(2))))
                more = [pa.array(cell.astype(np.int32)), pa.array(seen, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*names, "cell", "visits"])

    shape = f"key string, label {src.schema['label'].dataType.simpleString()}, vec array<double>, copies long, cell int, visits array<int>"
    filed = materialize(folded.select(*names).mapInArrow(file, shape), "filed")
    sized = filed.withColumn("d", F.size("vec"))
    place = ["label", "d", "at"]
    guests = sized.select("key", "label", "d", "copies", "vec", "cell", F.explode("visits").alias("at"))
    hosts = sized.toDF(*sized.columns).select("key", "label", "d", "copies", "vec", "visits", F.col("cell").alias("at"))
    # Only cells that do not fit a block are listed: one row for ``block`` vectors at most.
    crowds = [x.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(c)) for x, c in ((hosts, "hb"), (guests, "gb"))]
    crowds = materialize(crowds[0].join(crowds[1], place, "full").where("hb > 1 or gb > 1"), "crowds")
    one = lambda c: F.coalesce(F.col(c), F.lit(1))
    every = lambda c: F.explode(F.sequence(F.lit(0), one(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("key"), one(c)).cast("int")
    guests = guests.join(crowds, place, "left").select("key", *place, "copies", "vec", "cell", every("hb").alias("h"), own("gb").alias("g"))
    hosts = hosts.join(crowds, place, "left").select("key", *place, "copies", "vec", "visits", own("hb").alias("h"), every("gb").alias("g"))
    by = [*place, "h", "g"]
    met = guests.groupBy(*by).cogroup(hosts.groupBy(*by)).applyInArrow(lambda left, right: _compare(left, right, cosine), "key string, other string, links long")
    met = materialize(met, "met")
    stars = materialize(connected_components(met.select(F.col("key").alias("src"), F.col("other").alias("dst"))), "stars")
    links = met.groupBy("key").agg(F.sum("links").alias("links"))
    ids = folded.select("key", "copies", "least").join(links, "key", "left").join(stars.withColumnRenamed("id", "key"), "key", "left")
    ids = materialize(ids.select("key", "copies", "least", "links", F.coalesce("component", "key").alias("component")), "named")
    found = ids.join(ids.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    found = materialize(found.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "found")
    release(folded, filed, crowds, met, stars, ids)
    linked = src.where("key is not null").select("key", "vec_id").join(found, "key")
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.select("vec_id", "n_links", "component_id", kept).unionByName(alone)
