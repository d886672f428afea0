"""Best-fit packing of token sequences by bin completion.

All pieces of one length are alike, so the search runs over the histogram of
lengths: at most ``capacity`` numbers, however many documents there are. Around
the largest length left, all undominated fillings of the rest are enumerated,
each for as many sequences at once as its lengths allow and then for fewer;
branches whose waste cannot beat the best packing known are pruned, and
best-fit decreasing gives the incumbents. Spark then ranks the pieces of each
length and looks up the place of each rank.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnlake.llm.bpe import PieceCache
from tarnlake.session import materialize

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Steps of the search (nodes, and lengths tried for fillings); what it leaves
#: open is reported as the gap.
SEARCH_STEPS = 200_000
#: A best-fit packing completes every so many nodes.
ROLLOUT = 32
#: Steps that a node counts for.
NODE = 50

Step = tuple[int, tuple[int, ...]]  # (sequences, lengths in each)


@dataclass
class Work:
    """Search steps left."""

    left: int


class _Tokenizer:
    """Ids by the ``tokenizers`` library, its model called once per piece.

    The vocabulary must pre-tokenize by the byte-level pattern; then a text's
    ids are those of its pattern matches in turn.
    """

    def __init__(self, path: str):
        self.inner = Tokenizer.from_file(path)
        self.inner.encode_special_tokens = True
        kind = json.loads(self.inner.to_str())
        before = kind["pre_tokenizer"] or {}
        if kind["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError(f"{path} does not split by the byte-level pattern")
        # Byte-level vocabularies write each byte as one visible character.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain}
        self.shown = shown | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
        self.model = self.inner.model
        self.encode = PieceCache(self._pieces).encode

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        tokenize, shown = self.model.tokenize, self.shown
        words = (p.encode().decode("latin-1").translate(shown) for p in pieces)
        return [b"".join([t.id.to_bytes(4, "little") for t in tokenize(w)]) for w in words]


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> _Tokenizer:
    return _Tokenizer(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first is shorter."""
    count = -(-n // capacity)
    head = n - (count - 1) * capacity
    return [(0, head)] + [(head + i * capacity, capacity) for i in range(count - 1)]


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, row_key, piece, start, length, ids_crc32[, ids]) of every document."""
    path = path or public_tokenizers.path(VOCABULARY)
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_key"), F.col(text_col).alias("text"))
    names = ["doc_id", "row_key", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                rows, out = [], []
                for row, ids in enumerate(_tokenizer(path).encode([t or "" for t in b.column(2).to_pylist()])):
                    ids += end
                    for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * s : 4 * (s + n)]
                        rows.append(row)
                        out.append((k, s, n, zlib.crc32(part), part))
                cols = list(zip(*out, strict=True))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 4 + with_ids]
                taken = [b.column(i).take(pa.array(rows)) for i in range(2)]
                made = [pa.array(c, k) for c, k in zip(cols, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(taken + made, names=names)

    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row_key long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return src.mapInArrow(run, schema)


def _smear(bits: int, width: int) -> int:
    """Bits set wherever one lies 0 to ``width`` places higher."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        bits |= bits >> step
        done += step
    return bits


def undominated(fill: tuple[int, ...], room: int, spare: int) -> bool:
    """Whether no length left over may replace a part of the filling.

    ``spare`` has the bits of the lengths that are left over. A filling is
    dominated if one of them is at least as large as two or more of its
    lengths together, or larger than one of them, and still fits in their
    place; or if one fits beside them.
    """
    slack = room - sum(fill)
    one = several = 0
    for x in fill:
        several |= (several | one) << x
        one |= 1 << x
    near = _smear(spare, slack)
    larger = _smear(spare >> 1, slack - 1) if slack else 0
    return not (near & 1 or several & near or one & larger)


def _few(counts: list[int], sizes: list[int], target: int) -> Iterator[tuple[int, ...]]:
    """Fillings of one or two lengths that add up to ``target``."""
    if target < len(counts) and counts[target]:
        yield (target,)
    for s in sizes:
        if 2 * s < target:
            return
        if s < target and counts[target - s] and (2 * s != target or counts[s] > 1):
            yield s, target - s


def _many(counts: list[int], sizes: list[int], room: int, work: Work) -> Callable[[int], Iterator[tuple[int, ...]]]:
    """Fillings that add up to a target, largest lengths first.

    Bit sets of the sums that each tail of the lengths can reach keep the walk
    from dead ends; a walk ends where two or more of its lengths together could
    be replaced by one that it has passed over.
    """
    full = (1 << (room + 1)) - 1
    reach = [1]
    for s in reversed(sizes):
        sums, left, k = reach[-1], min(counts[s], room // s), 1
        while left:
            take = min(k, left)
            sums |= (sums << (take * s)) & full
            left -= take
            k *= 2
        reach.append(sums)
    reach.reverse()

    def exactly(i: int, target: int, one: int, several: int, passed: int, slack: int) -> Iterator[tuple[int, ...]]:
        if not target:
            yield ()
            return
        while reach[i] >> target & 1:
            s = sizes[i]
            i += 1
            for n in range(min(counts[s], target // s), 0, -1):
                if not reach[i] >> (target - n * s) & 1:
                    continue
                if not work.left:
                    return
                work.left -= 1
                more, single = several, one
                for _ in range(n):
                    more |= (more | single) << s
                    single |= 1 << s
                over = passed | (1 << s if n < counts[s] else 0)
                if not more & _smear(over, slack):
                    for rest in exactly(i, target - n * s, single, more, over, slack):
                        yield (s,) * n + rest
            passed |= 1 << s

    return lambda target: exactly(0, target, 0, 0, 0, room - target)


def fillings(counts: list[int], room: int, waste: int, work: Work, few_first: bool = False) -> Iterator[tuple[int, ...]]:
    """Every undominated filling of ``room`` that leaves at most ``waste`` free.

    Lazily: least waste first, then (``few_first``) one or two lengths before
    more, then the largest lengths first. Ends early only when ``work`` is
    used up.
    """
    sizes = [s for s in range(min(room, len(counts) - 1), 0, -1) if counts[s]]
    held, many = sum(1 << s for s in sizes), None

    def spare(fill: tuple[int, ...]) -> int:
        return held & ~sum(1 << s for s in set(fill) if fill.count(s) == counts[s])

    for free in range(min(waste, room) + 1):
        if free == room:
            if not sizes:
                yield ()
            return
        if few_first:
            yield from (f for f in _few(counts, sizes, room - free) if undominated(f, room, spare(f)))
        many = many or _many(counts, sizes, room, work)
        yield from (f for f in many(room - free) if not (few_first and len(f) < 3) and undominated(f, room, spare(f)))


def best_fit(counts: list[int], capacity: int) -> list[Step]:
    """Best-fit decreasing over a histogram, equal sequences at once: each
    piece goes to the fullest sequence that can take it."""
    free: list[list[Step]] = [[] for _ in range(capacity + 1)]  # by room left
    for s in range(len(counts) - 1, 0, -1):
        left = int(counts[s])
        while left:
            room = next((r for r in range(s, capacity + 1) if free[r]), capacity)
            times, fill = free[room].pop() if free[room] else (left, ())
            each = min(room // s, left)
            taken = min(times, left // each)
            if times > taken and fill:
                free[room].append((times - taken, fill))
            free[room - each * s].append((taken, fill + (s,) * each))
            left -= taken * each
    return [step for steps in free for step in steps]


def _times(counts: list[int], fill: tuple[int, ...]) -> int:
    return min(counts[s] // fill.count(s) for s in set(fill))


def least_bins(counts: list[int] | np.ndarray, capacity: int) -> int:
    """A lower bound: for every k, lengths over capacity-k stand alone, the
    other large ones take a bin each, and lengths from k on share their room."""
    counts = np.asarray(counts, np.int64)
    number, volume = np.cumsum(counts), np.cumsum(counts * np.arange(len(counts)))
    half = capacity // 2
    k = np.arange(1, half + 1)
    free = (number[capacity - k] - number[half]) * capacity - (volume[capacity - k] - volume[half])
    more = -(-(volume[half] - volume[k - 1] - free) // capacity)
    large = int(number[-1] - number[half])
    return max(-(-int(volume[-1]) // capacity), large + max(0, int(more.max(initial=0))))


@dataclass
class Packing:
    steps: list[Step]
    sequences: int
    #: No packing has fewer sequences than this.
    bound: int


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, search_steps: int = SEARCH_STEPS) -> Packing:
    """Pack a histogram (index: length); half of the steps go to each order of
    the fillings, the second only where the first has not proved its packing."""
    left = [int(c) for c in counts]
    best = best_fit(left, capacity)
    found = Packing(best, sum(k for k, _ in best), least_bins(left, capacity))
    for few_first in (True, False):
        if found.sequences > found.bound:
            _search(left, capacity, found, Work(search_steps // 2), few_first)
    return found


def _search(counts: list[int], capacity: int, found: Packing, work: Work, few_first: bool) -> None:
    """Bin-completion branch and bound; improves ``found``.

    Every packing has a sequence that holds the largest length, and some best
    one fills it without being dominated: so each node tries every undominated
    filling around the largest length left, as often as it fits, then every
    smaller number of times. A branch ends when its waste, or the bound on what
    is left, cannot beat the incumbent, or when the same lengths were left
    before. Incumbents are best-fit packings of the root and of nodes reached.
    The search ends when the incumbent meets the bound or no branch is left
    (then it is proved to be least), or after ``search_steps``: the problem is
    NP-hard, and the gap to the bound is then reported.
    """
    left = list(counts)
    total = sum(s * c for s, c in enumerate(left))
    used, trail = 0, []
    seen: dict[bytes, int] = {}

    def branches() -> Iterator[Step]:
        top = next(s for s in range(len(left) - 1, 0, -1) if left[s])
        left[top] -= 1
        rest = list(left)
        left[top] += 1
        for most in (True, False):
            waste = (found.sequences - 1 - used) * capacity - total
            for fill in fillings(rest, capacity - top, waste, work, few_first):
                whole = (top, *fill)
                n, lost = _times(left, whole), capacity - sum(whole)
                n = min(n, waste // lost) if lost else n
                for times in (n,) if most else range(n - 1, 0, -1):
                    yield times, whole

    def apply(step: Step, sign: int) -> None:
        nonlocal used, total
        for s in step[1]:
            left[s] -= sign * step[0]
        used += sign * step[0]
        total -= sign * step[0] * sum(step[1])

    open_nodes = [branches()]
    nodes = 0
    while open_nodes and work.left > 0:
        step = next(open_nodes[-1], None)
        if step is None:
            open_nodes.pop()
            if trail:
                apply(trail.pop(), -1)
            continue
        work.left -= min(work.left, NODE)
        apply(step, 1)
        trail.append(step)
        if not total:
            if used < found.sequences:
                found.steps, found.sequences = list(trail), used
        elif used + least_bins(left, capacity) < found.sequences:
            key = hashlib.blake2b(np.array(left, np.int64).tobytes(), digest_size=16).digest()
            if seen.get(key, used + 1) > used:
                seen[key] = used
                if nodes % ROLLOUT == 0:
                    rest = best_fit(left, capacity)
                    n = used + sum(k for k, _ in rest)
                    if n < found.sequences:
                        found.steps, found.sequences = [*trail, *rest], n
                nodes += 1
                if found.sequences == found.bound:
                    return
                open_nodes.append(branches())
                continue
        if found.sequences == found.bound:
            return
        apply(trail.pop(), -1)
    if work.left:
        found.bound = found.sequences


def places(steps: list[Step]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset) for each slot."""
    rank: dict[int, int] = {}
    out, base = [], 0
    for times, fill in steps:
        at = 0
        for s in fill:
            r = rank.get(s, 0)
            out.append((s, r, times, base, at))
            rank[s] = r + times
            at += s
        base += times
    return out


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces with sequence_id and offset; sequences hold ``capacity`` tokens.

    ``gap`` is by how many sequences the packing may exceed the least possible
    number: 0 where the search proved it least.

    Null text is an empty document: its end token alone. Null ids and repeated
    rows are packed like any other row. Other columns of ``docs`` are left out.
    The driver sees one count per length and sends back the places, both of a
    size that the capacity bounds; ranks come from a window over (length, hash
    bucket), so one very common length is spread over all tasks. ``with_ids``
    carries the packed token ids along.
    """
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, id_col, text_col, capacity, path, with_ids), "pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        histogram[length] = n
    packing = complete_bins(histogram, capacity)
    slots = places(packing.steps)
    by_length: dict[int, list] = {}
    for length, *slot in slots:
        by_length.setdefault(length, []).append(tuple(slot))
    table = spark.createDataFrame(
        list(by_length.items()), "length long, slots array<struct<rank: long, n: long, base: long, at: long>>"
    )
    buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The number of buckets is what can grow; counts per (length, bucket) are at most capacity x buckets.
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row_key", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = W.partitionBy("length", "bucket").orderBy("doc_id", "row_key", "piece")
    ranked = dealt.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
    rank = F.col("nth") + F.col("shift")
    placed = ranked.withColumn("rank", rank).join(F.broadcast(table), "length")
    # Slots are sorted by rank: the last that begins at or before the rank holds it.
    slot = F.element_at(F.filter("slots", lambda x: (x["rank"] <= F.col("rank")) & (F.col("rank") < x["rank"] + x["n"])), 1)
    placed = placed.withColumn("slot", slot)
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.base") + F.col("rank") - F.col("slot.rank")).alias("sequence_id"),
        F.col("slot.at").alias("offset"),
        F.lit(packing.sequences - packing.bound).cast("long").alias("gap"),
        *["ids"] * with_ids,
    )
