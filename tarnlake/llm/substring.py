"""Substring dedup on a compacted de Bruijn graph of word windows.

A window of 50 consecutive words is an edge of the graph whose nodes are the
49-word sequences. Consecutive edges of a document that share a minimizer (the
least hash of the 16-word sequences inside) form one path, and that choice
depends on the words alone, so equal text is cut into equal paths wherever it
stands. A minimizer seen in one document only is dropped. Where the paths of a
minimizer differ (the graph branches inside them: the rim of a shared passage)
the distinct paths are opened into single edges, read from the source
coordinates of their first occurrence. All other paths are joined over the
nodes between them: where a node has one way in and one way out the two paths
become one, so that a passage repeated in many documents is one record however
long. Edges that are opened are compared by 128 bits of the SHA-256 of their
words. Every occurrence of a path or chain then gets the windows that start in
a smaller document, and they are removed only if its words are those at the
source coordinates, by SHA-256.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm.text import row_map, words
from tarnlake.session import materialize, release

SPAN = 50
#: Words of a minimizer: long enough to be rare, short enough for long paths.
SEED_WORDS = 16

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def _sequence_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` (a power of two) word hashes, by doubling."""
    size = 1
    while size < k:
        h = _mixed(h[:-size] + h[size:] * np.uint64(0x9E3779B97F4A7C15))
        size *= 2
    return h


def _check_span(span: int) -> None:
    if not SEED_WORDS <= span <= SEED_WORDS + 62:
        raise ValueError(f"span must lie between {SEED_WORDS} and {SEED_WORDS + 62} words")


def paths(w: list[bytes], span: int = SPAN, seed: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first edge, number of edges, minimizer hash, hash of all words) by path."""
    n = len(w) - span + 1
    h = _sequence_hash(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)), seed)
    width = span - seed + 1
    low = np.empty(n, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, width)
    for at in range(0, n, 1 << 15):
        low[at : at + (1 << 15)] = view[at : at + (1 << 15)].argmin(axis=1)
    low += np.arange(n)
    first = np.flatnonzero(np.diff(low, prepend=-1))
    count = np.diff(first, append=n)
    flat = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = ends - np.fromiter(map(len, w), np.int64, len(w)) - 1
    a, b = starts[first].tolist(), (ends[first + count + (span - 2)] - 1).tolist()
    whole = np.fromiter((xxhash.xxh3_64_intdigest(flat[i:j], 1) for i, j in zip(a, b, strict=True)), np.uint64, len(a))
    return first, count, h[low[first]], whole


def _occurrences(docs: DataFrame, id_col: str, text_col: str, span: int, bits: int) -> DataFrame:
    """(id, key, spot, seed, whole, before) of every path of every text.

    ``spot`` is the word at which the path starts, times 64, plus its number of
    edges (at most span - SEED_WORDS + 1); ``before`` is the hash of the path
    that comes before it in the text, 0 at its start.
    """
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), _key(text_col), F.col(text_col).alias("text"))
    names = ["id", "key", "spot", "seed", "whole", "before"]
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for i, key, text in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    w = words(text)
                    if len(w) >= span:
                        f, c, s, x = paths(w, span)
                        s, x = (s & mask).view(np.int64), (x & mask).view(np.int64)
                        before = np.concatenate([np.zeros(1, np.int64), x[:-1]])
                        out.append((np.full(len(f), i), np.full(len(f), key), f * 64 + c, s, x, before))
                if out:
                    cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return src.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _key(text_col: str) -> Column:
    """Tells apart rows of one id; the coordinates of a row hold for its text."""
    return F.xxhash64(F.col(text_col)).alias("key")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("id"), _key(text_col), F.col(text_col).alias("text"))
    return src.where("id is not null")


def _sources(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """Read paths and chains at their source coordinates.

    One row by path or chain: the SHA-256 of its ``words``, and of those to open
    (where the graph branches inside) the first 128 bits of each edge's.
    """
    wanted = classes.groupBy("id", "key").agg(F.collect_list(F.struct("first", "edges", "seed", "whole", "fork")).alias("at"))
    both = wanted.join(_texts(docs, id_col, text_col), ["id", "key"])
    names = ["seed", "whole", "id", "key", "first", "edges", "words", "parts"]
    kinds = [pa.int64()] * 6 + [pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                i, key, at, text = (part.column(c)[0].as_py() for c in range(4))
                w = words(text)
                flat = b" ".join(w)
                size = np.fromiter(map(len, w), np.int64, len(w)) + 1
                ends = np.cumsum(size)
                starts = (ends - size).tolist()
                ends = ends.tolist()
                out = []
                for p in at:
                    a, n = p["first"], p["edges"]
                    if a + n + span - 1 > len(w):  # another text under this id and hash
                        continue
                    whole = sha(flat[starts[a] : ends[a + n + span - 2] - 1]).digest()
                    opened = b"".join([sha(flat[starts[e] : ends[e + span - 1] - 1]).digest()[:16] for e in range(a, a + n)]) if p["fork"] else None
                    out.append((p["seed"], p["whole"], i, key, a, n, whole, opened))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    shape = ", ".join(f"{n} long" for n in names[:6]) + ", words binary, parts binary"
    return both.select("id", "key", "at", "text").mapInArrow(run, shape)


def _chains(solid: DataFrame) -> DataFrame:
    """Compact nonbranching paths: (seed, whole, id, key, first, edges) by chain.

    ``solid`` has one row per distinct path that no other path overlaps in
    part. The node between two paths has one edge in and one out if every
    occurrence of the later path comes after the earlier one, and that has no
    more occurrences than these. A join over the nodes finds such pairs; a chain
    of them lies in one piece in its source document, so the chains are the
    islands of linked paths along the source coordinates.
    """
    left = solid.select(
        F.col("whole").alias("before"), "n", "id", "key", (F.col("first") + F.col("edges")).alias("first"), F.lit(True).alias("linked")
    )
    only = F.when((F.col("low") == F.col("high")) & (F.col("low") != 0), F.col("low"))
    nodes = ["before", "n", "id", "key", "first"]
    linked = solid.withColumn("before", only).join(left, nodes, "left")
    w = W.partitionBy("id", "key").orderBy("first")
    head = F.when(F.col("linked") & (F.lag(F.col("first") + F.col("edges")).over(w) == F.col("first")), 0).otherwise(1)
    island = F.sum("head").over(w.rowsBetween(W.unboundedPreceding, 0))
    chains = linked.withColumn("head", head).withColumn("island", island).groupBy("id", "key", "island")
    least = F.min(F.struct("first", "seed", "whole")).alias("h")
    return chains.agg(least, F.sum("edges").alias("edges")).select("h.seed", "h.whole", "id", "key", "h.first", "edges")


RUN = "struct<nth: long, edges: long, oid: long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive windows of a path that start first in one document, as runs."""
    for b in batches:
        at = b.column("at")
        size = at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = at.flatten()
        row = np.repeat(np.arange(b.num_rows), size)
        nth, oid = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("nth", "least"))
        new = np.ones(len(row), bool)
        if len(row):
            new[1:] = (np.diff(row) != 0) | (np.diff(oid) != 0) | (np.diff(nth) != 1)
        start = np.flatnonzero(new)
        values = [nth[start], np.diff(start, append=len(row)), oid[start]]
        runs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], ["nth", "edges", "oid"])
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[start], minlength=b.num_rows))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)
        yield pa.RecordBatch.from_arrays([b.column("seed"), b.column("whole"), lists], names=["seed", "whole", "runs"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, bits: int = 64) -> DataFrame:
    """(id, key, spots): windows of a document that start in one of smaller id.

    A spot is (first, edges, words, runs): a path or chain that begins at word
    ``first`` with so many windows, the SHA-256 of its words where it occurs
    first, and the runs of its windows that start in smaller documents. ``bits``
    narrows the hashes by which paths are found; whoever applies the spots must
    compare the words.
    """
    _check_span(span)
    every = materialize(_occurrences(docs, id_col, text_col, span, bits), "paths")
    shared = every.groupBy("seed").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("seed")
    shared = materialize(shared, "seeds")
    seen = materialize(every.join(shared, "seed", "left_semi"), "repeats")
    release(every, shared)
    place = F.min(F.struct("id", "key", "spot")).alias("o")
    distinct = seen.groupBy("seed", "whole").agg(place, F.min("before").alias("low"), F.max("before").alias("high"), F.count(F.lit(1)).alias("n"))
    spot = [F.shiftright("o.spot", 6).alias("first"), F.col("o.spot").bitwiseAND(F.lit(63)).alias("edges")]
    distinct = materialize(distinct.select("seed", "whole", "o.id", "o.key", *spot, "low", "high", "n"), "distinct")
    forks = materialize(distinct.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("seed"), "forks")
    chains = _chains(distinct.join(forks, "seed", "left_anti")).withColumn("fork", F.lit(False))
    rims = distinct.join(forks, "seed", "left_semi").select("seed", "whole", "id", "key", "first", "edges", F.lit(True).alias("fork"))
    classes = materialize(chains.unionByName(rims), "classes")
    release(distinct, forks)
    sources = _sources(classes, docs, id_col, text_col, span)
    # Repeated source rows are read twice: one row by path.
    sources = materialize(sources.groupBy("seed", "whole").agg(F.first(F.struct("id", "edges", "words", "parts")).alias("s")).select("seed", "whole", "s.*"), "sources")
    release(classes)
    cut = lambda j: F.substring("parts", j * 16 + 1, F.lit(16))
    edges = sources.where("parts is not null").select(
        "seed", "whole", "id", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("edges").cast("int") - 1), cut)).alias("nth", "edge")
    )
    least = edges.groupBy("seed", "edge").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("c"))
    least = materialize(least.where("c > 1").drop("c"), "least")
    # Edges of one path only start where that path does.
    opened = edges.join(least, ["seed", "edge"], "left").withColumn("least", F.coalesce("least", "id"))
    opened = opened.groupBy("seed", "whole").agg(F.array_sort(F.collect_list(F.struct(F.col("nth").cast("long").alias("nth"), "least"))).alias("at"))
    opened = opened.mapInArrow(_runs, f"seed long, whole long, runs array<{RUN}>")
    alone = F.array(F.struct(F.lit(0).cast("long"), "edges", "id").cast(RUN))
    known = sources.select("seed", "whole", "edges", "words", "id", "parts").join(opened, ["seed", "whole"], "left")
    known = known.select("seed", "whole", "edges", "words", F.when(F.col("parts").isNull(), alone).otherwise(F.col("runs")).alias("runs"))
    known = materialize(known, "known")
    release(sources, least)
    # The head of a chain stands for it: the occurrences of its other paths find no partner here.
    hit = seen.select("seed", "whole", "id", "key", F.shiftright("spot", 6).alias("first")).join(known, ["seed", "whole"])
    hit = hit.withColumn("runs", F.filter("runs", lambda r: r["oid"] < F.col("id"))).where(F.size("runs") > 0)
    runs = F.transform("runs", lambda r: F.struct(r["nth"].alias("nth"), r["edges"].alias("edges")))
    # A set: equal rows of the table fold in the tasks.
    spots = F.collect_set(F.struct("first", "edges", "words", runs.alias("runs"))).alias("spots")
    spots = materialize(hit.groupBy("id", "key").agg(spots), "spots")
    release(seen, known)
    return spots


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_removed", T.LongType(), False),
        T.StructField("kept_sha256", T.StringType(), False),
    ]
)


def _cut(text: str | None, spots: list | None, span: int) -> tuple[str | None, int, int, str]:
    w = words(text)
    cover = np.zeros(len(w) + 1, np.int64)
    for s in spots or ():
        a, b = s["first"], s["first"] + s["edges"] + span - 1
        # The words themselves decide: a span that only its hashes claim stays.
        if b <= len(w) and hashlib.sha256(b" ".join(w[a:b])).digest() == s["words"]:
            for r in s["runs"]:
                cover[a + r["nth"]] += 1
                cover[a + r["nth"] + r["edges"] + span - 1] -= 1
    gone = np.cumsum(cover)[:-1] > 0
    if not gone.any():
        return text, len(w), 0, hashlib.sha256(b" ".join(w)).hexdigest()
    data = text.encode()
    turns = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
    where = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    kept, at = [], 0
    for a, b in zip(turns[::2], turns[1::2], strict=True):
        kept.append(data[at : where[a]])
        at = where[b]
    kept.append(data[at:])
    left = [x for x, g in zip(w, gone.tolist(), strict=True) if not g]
    return b"".join(kept).decode(), len(w), int(gone.sum()), hashlib.sha256(b" ".join(left)).hexdigest()


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    span: int = SPAN,
    bits: int = 64,
) -> DataFrame:
    """Cut repeated passages of ``span`` words or more out of the texts.

    A word goes if a ``span``-word window over it also starts in a document
    with a smaller id. Adds n_words, n_removed and kept_sha256 (of the kept
    words joined by one space); ``text_col``, if kept, holds the cleaned text
    with its own white space. Null and empty texts have no words and stay as
    they are; a row with a null id keeps all its words and removes none
    elsewhere; rows with one id never cut each other; equal rows are cut
    alike. Very long texts are cut into paths like any other. Columns of the
    new names are replaced, all others kept whatever their names.
    """
    cols = [c for c in (docs.columns if keep is None else keep) if c not in RESULT.names]
    spots = repeated_spans(docs, id_col, text_col, span, bits)
    # A row's own columns travel in one, so none can clash with the joined ones.
    own = [F.col(f"`{c}`") for c in cols if c != text_col] or [F.lit(0)]
    src = docs.select(F.struct(*own).alias("row"), F.col(id_col).cast("long").alias("id"), _key(text_col), F.col(text_col).alias("text"))
    joined = src.join(spots, ["id", "key"], "left").select("row", "text", "spots")
    fields = [T.StructField("text", T.StringType())] if text_col in cols else []
    new = T.StructType([*fields, *RESULT.fields])
    done = row_map(joined, lambda rows: (_cut(t, s, span)[1 - len(fields) :] for t, s in rows), ["text", "spots"], new, ["row"])
    return done.select(*[F.col("text" if c == text_col else f"row.`{c}`").alias(c) for c in cols], *RESULT.names)
