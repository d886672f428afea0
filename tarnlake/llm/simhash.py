"""SimHash near-dedup through covering locality-sensitive hashing.

With radius r, every bit position gets a vector of r+1 bits; each non-zero
vector v of r+1 bits gives a mask of the positions whose vector has an odd
product with v. The positions in which two fingerprints within the radius
differ span at most r dimensions, so some v is orthogonal to all of them and
its mask shows none of the differences: each pair collides in some of the
2^(r+1)-1 tables, without a chance of a miss.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm.components import connected_components
from tarnlake.llm.text import row_map
from tarnlake.session import materialize

BITS = 64
RADIUS = 3
SHINGLE = 3
#: A bucket of more distinct fingerprints than this is linked through balls.
BLOCK = 2048


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash: bit set if it is set in over half the shingles' XXH64."""
    w = text.encode().lower().split() if text else []
    if not w:
        return 0
    if len(w) <= size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(w), 42)]
    else:
        flat = b" ".join(w)
        ends = np.cumsum([len(x) + 1 for x in w]).tolist()
        starts = [0, *ends]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[a : b - 1], 42) for a, b in zip(starts, ends[size - 1 :], strict=False)]
    n = len(hashes)
    raw = np.array(hashes, np.uint64).view(np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(raw[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``fp`` (the fingerprint as a signed long); null text has 0."""
    new = T.StructType([T.StructField("fp", T.LongType(), False)])
    return row_map(docs, lambda rows: ((signed(fingerprint(t)),) for (t,) in rows), [text_col], new, keep)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The 2^(radius+1)-1 masks. Positions get the non-zero vectors in turn, so
    each mask shows about half of the bits."""
    vectors = (1 << (radius + 1)) - 1
    phi = [i % vectors + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (phi[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _links_in_bucket(fp: np.ndarray, ids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within the radius, in blocks of rows."""
    n = len(fp)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = [], []
    step = max(1, (1 << 20) // n)
    for at in range(0, n, step):
        near = np.bitwise_count(fp[at : at + step, None] ^ fp[None, :]) <= radius
        a, b = np.nonzero(near)
        a = a + at
        for i, j in zip(a[a < b].tolist(), b[a < b].tolist(), strict=True):
            x, y = find(i), find(j)
            if x != y:
                root[y] = x
                left.append(ids[i])
                right.append(ids[j])
    return np.array(left, np.int64), np.array(right, np.int64)


def _ball(fp: np.ndarray, radius: int) -> np.ndarray:
    """All fingerprints within ``radius`` of each, as one row per fingerprint."""
    flips = [0]
    for r in range(1, radius + 1):
        flips += [sum(1 << i for i in at) for at in combinations(range(BITS), r)]
    return fp[:, None] ^ np.array(flips, np.uint64)[None, :]


def similarity_links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (src, dst) whose components are those of all pairs within radius.

    ``nodes`` has distinct ``fp`` and an ``id`` for each. Every node goes to
    one bucket per mask. Buckets of up to ``block`` members are compared in
    full inside a task, giving a spanning forest. The members of larger ones
    (close variants of one text) are linked exactly and in linear size: x and
    y are within radius iff some z is within 1 of x and radius-1 of y, so
    every z of an inner ball ties all whose outer ball holds it together.
    """
    masks = covering_masks(radius)
    spread = nodes.select(
        "id",
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("table", "bits"),
    )
    sizes = spread.groupBy("table", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(spread.join(sizes, ["table", "bits"]), "buckets")

    def small(key: tuple, t: pa.Table) -> pa.Table:
        fp = t.column("fp").to_numpy().view(np.uint64)
        a, b = _links_in_bucket(fp, t.column("id").to_numpy(), radius)
        return pa.table({"src": a, "dst": b})

    links = (
        shared.where(F.col("n") <= block)
        .select("table", "bits", "id", "fp")
        .groupBy("table", "bits")
        .applyInArrow(small, "src long, dst long")
    )
    big = shared.where(F.col("n") > block).select("id", "fp").distinct()

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                ids = b.column("id").to_numpy(zero_copy_only=False)
                outer, inner = _ball(fp, radius - 1), _ball(fp, 1)
                z = np.concatenate([outer.ravel(), inner.ravel()]).view(np.int64)
                who = np.concatenate([np.repeat(ids, outer.shape[1]), np.repeat(ids, inner.shape[1])])
                close = np.repeat([False, True], [outer.size, inner.size])
                yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(who), pa.array(close)], names=["z", "id", "close"])

    reach = big.mapInArrow(balls, "z long, id long, close boolean")
    hubs = reach.groupBy("z").agg(
        F.max("close").alias("close"), F.min("id").alias("src"), F.max("id").alias("other")
    ).where("close and src < other")
    ties = reach.select("z", "id").join(hubs.select("z", "src"), "z").where("id != src").select("src", F.col("id").alias("dst"))
    return links.unionByName(ties).distinct()


def near_duplicate_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, radius: int = RADIUS
) -> DataFrame:
    """Append fp, fingerprint (16 hex digits) and component_id to every row.

    component_id is the smallest id reachable over links of at most ``radius``
    differing bits. Equal texts share one fingerprint and are folded before
    the search, so copies cost nothing there. Rows without an id link others
    like any row, but never name a component: it is null only where no row of
    it has an id. Null and empty texts have fingerprint zero and link like any
    other; very long texts are read whole, in slices of a few rows a task.
    Repeated rows stay. Columns of these names are replaced. Buckets of more
    than ``BLOCK`` fingerprints are linked by another algorithm with the same
    components (``similarity_links``).
    """
    cols = [c for c in (docs.columns if keep is None else keep) if c not in ("fp", "fingerprint", "component_id")]
    prints = materialize(fingerprints(docs, text_col, cols), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min(id_col).cast("long").alias("least")), "nodes")
    # Fingerprints are linked first and components named by their ids afterwards.
    labels = connected_components(similarity_links(nodes.select("fp", F.col("fp").alias("id")), radius))
    placed = nodes.join(labels.select(F.col("id").alias("fp"), F.col("component").alias("group")), "fp", "left")
    placed = materialize(placed.select("fp", "least", F.coalesce("group", "fp").alias("group")), "placed")
    named = placed.select("fp", "group").join(placed.groupBy("group").agg(F.min("least").alias("component_id")), "group").drop("group")
    return (
        prints.join(named, "fp", "left")
        .withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
        .select(*cols, "fp", "fingerprint", "component_id")
    )


def near_duplicate_groups(
    docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, radius: int = RADIUS
) -> DataFrame:
    """Append fp and group, the least fingerprint reachable over links of at
    most ``radius`` differing bits, to every row. Ids play no part: rows are
    linked through their texts only."""
    cols = [c for c in (docs.columns if keep is None else keep) if c not in ("fp", "group")]
    prints = materialize(fingerprints(docs, text_col, cols), "fingerprints")
    nodes = materialize(prints.select("fp").distinct().withColumn("id", F.col("fp")), "nodes")
    labels = connected_components(similarity_links(nodes, radius)).select(F.col("id").alias("fp"), F.col("component").alias("group"))
    return prints.join(labels, "fp", "left").select(*cols, "fp", F.coalesce("group", "fp").alias("group"))


__all__ = [
    "covering_masks",
    "fingerprint",
    "fingerprints",
    "near_duplicate_components",
    "near_duplicate_groups",
    "similarity_links",
]
