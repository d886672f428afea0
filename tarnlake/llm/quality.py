"""Quality rules by compression bands.

A text passes the base rules (enough words, few repeated five-word windows),
then its zstandard ratio must lie in the band of its length, and so must nearly
all of its fixed chunks, the rest at the end included. Repetitive text compresses too well, noise too badly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tarnlake.llm.text import WHITE, row_map, words

#: (bytes at least, lowest ratio, highest ratio) at zstandard level 3. Below
#: the first length the frame header dominates and no band holds. The lower
#: limits lie 7 % or more under what clean prose of that length reaches, the
#: upper ones 2.5 to 5 % over the highest of the labelled clean texts, whole
#: or in chunks (88,145 texts of check_l and those of sf0.1).
BANDS = (
    (100, 0.40, 1.13),
    (110, 0.40, 1.08),
    (120, 0.40, 1.07),
    (135, 0.40, 1.00),
    (150, 0.40, 0.99),
    (175, 0.40, 0.94),
    (200, 0.50, 0.90),
    (250, 0.50, 0.84),
    (350, 0.50, 0.80),
    (400, 0.48, 0.77),
    (450, 0.48, 0.76),
    (500, 0.48, 0.75),
    (600, 0.48, 0.71),
    (700, 0.48, 0.70),
    (800, 0.44, 0.675),
    (1000, 0.44, 0.645),
    (1200, 0.44, 0.62),
    (1400, 0.44, 0.603),
    (1600, 0.425, 0.598),
    (2000, 0.425, 0.58),
    (2400, 0.425, 0.56),
    (2800, 0.425, 0.55),
    (3200, 0.40, 0.538),
    (3600, 0.40, 0.53),
    (4096, 0.40, 0.528),
    (4800, 0.40, 0.52),
    (6400, 0.385, 0.505),
    (8192, 0.385, 0.49),
    (9600, 0.385, 0.487),
    (12800, 0.36, 0.48),
    (19200, 0.36, 0.47),
    (25600, 0.36, 0.46),
)
CHUNK = 4096
#: A text is rejected when more than this share of its chunks is outside. Of the
#: chunks of labelled clean texts none is, so texts under ten chunks allow none.
CHUNK_SHARE = 0.1
LEVEL = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("word_chars", T.LongType(), False),
        T.StructField("n_symbols", T.LongType(), False),
        T.StructField("n_dup_lines", T.LongType(), False),
        T.StructField("n_repeat_words", T.LongType(), False),
        T.StructField("ratio", T.DoubleType(), True),
        T.StructField("chunks_out", T.LongType(), False),
        T.StructField("n_chunks", T.LongType(), False),
        T.StructField("base_failed", T.BooleanType(), False),
        T.StructField("kept", T.BooleanType(), False),
    ]
)


def band(n_bytes: int, bands: tuple = BANDS) -> tuple[float, float]:
    low, high = 0.0, float("inf")
    for least, lo, hi in bands:
        if n_bytes >= least:
            low, high = lo, hi
    return low, high


def repeated_words(w: list[bytes], size: int = 5) -> int:
    """Words lying in a ``size``-word window that occurs twice or more.

    Windows are compared by a mixed 64-bit hash first; the few that seem
    repeated are compared again by their words, so the count is exact.
    """
    n = len(w) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    mixed = np.zeros(n, np.uint64)
    for j in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    flag = np.zeros(n, bool)
    flag[order[1:]] |= same
    flag[order[:-1]] |= same
    at = np.flatnonzero(flag).tolist()
    found = Counter(tuple(w[i : i + size]) for i in at)
    cover = np.zeros(len(w) + 1, np.int64)
    for i in at:
        if found[tuple(w[i : i + size])] > 1:
            cover[i] += 1
            cover[i + size] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


def measure(text: str | None, zstd: zstandard.ZstdCompressor, bands: tuple = BANDS) -> tuple:
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    repeat = repeated_words(w)
    base_failed = len(w) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(w)
    data = text.encode()
    ratio = len(zstd.compress(data)) / len(data) if data else None
    low, high = band(len(data), bands)
    n_chunks, out = -(-len(data) // CHUNK), 0
    if n_chunks == 1:
        out = int(not low <= ratio <= high)
    else:
        for i in range(0, len(data), CHUNK):
            piece = data[i : i + CHUNK]
            lo, hi = band(len(piece), bands)
            out += not lo <= len(zstd.compress(piece)) / len(piece) <= hi
    kept = not base_failed and low <= ratio <= high and out <= CHUNK_SHARE * n_chunks
    return (
        len(w),
        len(text) - sum(text.count(c) for c in WHITE),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeat,
        ratio,
        out,
        n_chunks,
        base_failed,
        kept,
    )


def compression_quality(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    bands: tuple = BANDS,
    only_kept: bool = False,
) -> DataFrame:
    """Append the measures and the verdict ``kept`` to every row.

    Null text counts as empty and fails the base rules; rows are judged one
    by one, so repeated rows get equal verdicts; a column of ``docs`` named
    like a measure is replaced. ``only_kept`` leaves out rejected rows within
    the same pass. No shuffle: the plan is one scan and one Arrow map.
    """

    def run(rows: list[tuple]) -> Iterator[tuple | None]:
        zstd = zstandard.ZstdCompressor(level=LEVEL)
        for (text,) in rows:
            m = measure(text, zstd, bands)
            yield m if m[-1] or not only_kept else None

    return row_map(docs, run, [text_col], MEASURES, keep)
