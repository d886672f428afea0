"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.session import materialize


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u != v").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``links`` (src, dst); component = least id.

    Each round hangs neighbours to the least neighbour (large star: those
    above a node; small star: those below), which halves distances, and ends
    when a round changes nothing. Minima are partial aggregates, written before
    the rows go back by an equi-join: both of its sides are then plain shuffles,
    of which adaptive execution splits those of a node with very many links. Every round is written to the shared folder: the plan stays short
    and a lost executor repeats one round at most. Only counts and a sum reach
    the driver. Empty links give no rows.
    """
    edges = materialize(_canonical(links), "edges")
    state = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # large star: neighbours above u hang from u's least neighbour
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        large = _canonical(large)
        # small star: u and its neighbours below hang from the least of them
        large = materialize(large, "large")
        down = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = large.join(down, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        small = small.unionByName(down.select(F.col("u").alias("src"), F.col("m").alias("dst")))
        edges = materialize(_canonical(small), "edges")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
