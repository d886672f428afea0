import math

import numpy as np
from pyspark.sql import functions as F

from tarnlake.llm.ann import balanced_parts, build_index, fit_router, knn_graph, nearest_neighbours


def brute(rows, k=10):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % 20 == 0:
            d = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in ok if j != i)
            out[i] = d[:k]
    return out


def test_exact_in_one_part_with_odd_vectors(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, np.float32(rnd.normal(size=8)).tolist()) for i in range(300)]
    rows += [(i, rows[20][1]) for i in range(400, 460)]  # many copies, one of them asked
    rows += [(500, None), (520, [0.0] * 8), (540, [float("nan")] * 8), (560, [1.0] * 7 + [float("inf")]), (580, [1.0, None] + [0.0] * 6), (601, [1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    whole = {"rows_per_part": 1000, "max_parts": 1}
    for r in nearest_neighbours(df, F.col("vec_id") % 20 == 0, **whole).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute([x for x in rows if x[0] != 601])
    assert set(got) == set(want)
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in near], rtol=1e-12, atol=0)
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert nearest_neighbours(few, F.col("vec_id") % 20 == 0).count() == 2


def recall(df, is_query, **how):
    """Share of true neighbours found; and every query has all its ranks."""
    rows = df.select("vec_id", "embedding", is_query.alias("q")).collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    got = {}
    for r in nearest_neighbours(df, is_query, **how).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = [i for i, r in enumerate(rows) if r.q]
    hit = 0
    for i in asked:
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        hit += len(got[int(ids[i])] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    return hit / (10 * len(asked))


def test_recall_over_learned_parts(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(12, 16))
    x = np.float32(centres[rnd.integers(0, 12, 9000)] + 0.6 * rnd.normal(size=(9000, 16)))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    assert recall(df, F.col("vec_id") % 100 == 0) >= 0.9
    # Two levels: eight parts, each cut again.
    assert recall(df, F.col("vec_id") % 100 == 0, rows_per_part=150, max_parts=8) >= 0.9
    folded = df.select(F.xxhash64("embedding").alias("h1"), F.col("vec_id").alias("h2"), F.col("embedding").alias("vec"))
    index = build_index(folded, 9000, 150, 8)
    assert len(index.fine) >= 6 and index.visits < 8
    rows, parts = index.route(x.astype(np.float64), False)
    assert sorted(rows.tolist()) == list(range(9000)) and len(set(parts.tolist())) > 30


def test_recall_on_the_given_tables(spark):
    """Parts by the square root of the rows. These vectors point in random
    directions: nine of ten neighbours cost most of the rows, never all."""
    for sf, n in (("0.01", 500), ("0.1", 2000)):
        df = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
        assert recall(df, F.col("vec_id") % 10 == 0) >= 0.9
        folded = df.select(F.xxhash64("embedding").alias("h1"), F.col("vec_id").alias("h2"), F.col("embedding").alias("vec"))
        index = build_index(folded, n)
        assert index.router.p[3].shape == (round(n**0.5),) and index.visits < round(n**0.5)
        got = nearest_neighbours(df, F.col("vec_id") % 10 == 0).agg(F.avg("compared"), F.max("visits")).first()
        assert got[0] < 0.95 * n and got[1] < round(n**0.5)


def test_clustered_vectors_are_hardly_searched(spark):
    rnd = np.random.default_rng(9)
    x = np.float32(rnd.normal(size=(40, 32))[rnd.integers(0, 40, 6000)] + 0.35 * rnd.normal(size=(6000, 32)))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    assert recall(df, F.col("vec_id") % 100 == 0) >= 0.9
    assert nearest_neighbours(df, F.col("vec_id") % 100 == 0).agg(F.avg("compared")).first()[0] < 0.2 * 6000


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 2.0]), (0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 3.0]), (1, [1.0, 3.0]), (2, [5.0, 5.0])]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1), (2, 2)]


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(1200, 8))
    part = balanced_parts(knn_graph(x, 10), 12)
    size = np.bincount(part, minlength=12)
    assert size.max() <= 1.2 * 100 and size.min() > 40
    router, visits = fit_router(x, 12)
    assert router is not None and 1 <= visits <= 12
    assert fit_router(x, 1) == (None, 1) and fit_router(x[:3], 2) == (None, 1)
