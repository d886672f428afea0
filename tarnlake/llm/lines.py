"""Line dedup by overlapping three-line windows, in DataFrame operations only.

Every three consecutive lines (trimmed) are hashed to 128 bits. A window whose
lines occurred before, by (doc_id, position), is a later occurrence; the lines
under later occurrences go, overlapping windows merged into spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import materialize

BLANKS = " \t\r\x0b\x0c"
WINDOW = 3


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, pos, h1, h2) of every window that is not blank throughout."""
    trimmed = F.transform(F.split(text_col, "\n"), lambda x: F.trim(x, F.lit(BLANKS)))

    def window(_: Column, i: Column) -> Column:
        part = [F.get(F.col("_lines"), i + j) for j in range(WINDOW)]
        whole = (i <= F.size("_lines") - WINDOW) & (F.concat(*part) != "")
        # Lengths go into the second hash, so the two do not share collisions.
        return F.when(
            whole,
            F.struct(
                i.alias("pos"),
                F.xxhash64(*part).alias("h1"),
                F.xxhash64(F.lit(7), *reversed(part), *[F.length(x) for x in part]).alias("h2"),
            ),
        )

    keyed = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), trimmed.alias("_lines")
    )
    spread = keyed.select("_id", "_key", F.explode(F.transform("_lines", window)).alias("w"))
    return spread.where("w is not null").select("_id", "_key", "w.*")


def _spans(starts: Column) -> Column:
    """Merge sorted window starts into spans struct(lo, hi) of line numbers."""
    first = F.filter(starts, lambda x, i: (i == 0) | (x > F.get(starts, i - 1) + WINDOW))
    last = F.filter(starts, lambda x, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > x + WINDOW))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("lo"), (b + (WINDOW - 1)).alias("hi")))


def line_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with repeated windows: _id, _key, spans to remove.

    The global pass keeps one row per distinct window (partial aggregation
    before the shuffle, so a window in a third of all documents is no hot
    key) and is written, so that the way back is an equi-join of two plain
    shuffles, whose hot keys adaptive execution splits.
    """
    windows = _windows(docs, id_col, text_col)
    place = F.struct("_id", "_key", "pos")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = materialize(repeated.where("_n > 1").drop("_n"), "windows")
    later = windows.join(repeated, ["h1", "h2"]).where(place > F.col("_first"))
    starts = later.groupBy("_id", "_key").agg(F.array_sort(F.collect_set("pos")).alias("_starts"))
    return starts.select("_id", "_key", _spans(F.col("_starts")).alias("spans"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``docs`` with cleaned text, plus n_lines and n_removed_lines.

    A null text stays null with zero lines; an empty text has one empty line.
    Texts of fewer than three lines never change. Order is (id, text key,
    position), null ids first; rows with equal id and text count as one
    document, so exact repeats of a row keep the same lines. If every line
    goes, the text becomes ''. Very long texts are one row of many windows. Columns
    named like the two counts are replaced, all others kept.
    """
    docs = docs.drop("n_lines", "n_removed_lines")
    spans = line_spans(docs, id_col, text_col)
    # A row's own columns travel in one, so none can clash with the joined ones.
    own = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0)]
    src = docs.select(F.struct(*own).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    both = src.join(spans, src["id"].eqNullSafe(spans["_id"]) & (src["key"] == spans["_key"]), "left")
    lines, n = F.split("text", "\n"), F.size(F.split("text", "\n"))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda j: F.struct(
            F.when(j == 0, F.lit(0)).otherwise(F.get(F.col("spans.hi"), j - 1) + 1).alias("a"),
            F.when(j == F.size("spans"), n).otherwise(F.get(F.col("spans.lo"), j)).alias("b"),
        ),
    )
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, F.greatest(g["b"] - g["a"], F.lit(0)))))
    removed = F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["hi"] - s["lo"] + 1)
    hit = F.col("spans").isNotNull()
    cleaned = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("text"))
    return both.select(
        *[(cleaned if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns],
        F.coalesce(n, F.lit(0)).cast("long").alias("n_lines"),
        F.when(hit, removed).otherwise(0).cast("long").alias("n_removed_lines"),
    )
