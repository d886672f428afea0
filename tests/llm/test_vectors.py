import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm.centroids import VantageTree, cluster_vectors
from tarnlake.llm.codes import Gnat, compress_vectors
from tarnlake.llm.multiindex import MultiIndex, multi_sequence, near_duplicate_vectors, unit

NAN, INF = float("nan"), float("inf")
SHAPE = "vec_id long, embedding array<float>, label int, key string, cell int, ints string"


def table(spark, rows):
    """Rows (id, vector, label), with further columns of clashing names."""
    return spark.createDataFrame([(i, v, x, "k", 1, "z") for i, v, x in rows], SHAPE)


def kept_rows(rows, dim=None):
    ok = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [r for r in ok if dim is None or len(r[1]) == dim]


def whole(v, scale):
    return [math.floor(scale * float(np.float32(c))) for c in v]


def nearest(x, points):
    return min((sum((a - b) ** 2 for a, b in zip(x, p, strict=True)), j) for j, p in enumerate(points))


def brute_clusters(rows, k, rounds, dim, scale=256):
    x = [(i, whole(v, scale)) for i, v, _ in kept_rows(rows, dim)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in x if i is not None)
    c = [v for _, v in order[:k]]
    for _ in range(rounds):
        own = [nearest(v, c)[1] for _, v in x]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(x, own, strict=True) if o == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    found = [(i, *nearest(v, c)) for i, v in x]
    total = {j: sum(d for _, d, o in found if o == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in c]
    return sorted((i is None, i or 0, o, d, total[o], sum(total.values()), sha[o]) for i, d, o in found)


def odd_vectors(rnd, dim, n, ids=None):
    """Vectors with copies, ties, repeated rows and ids, and unusable ones."""
    rows = [(i, np.float32(rnd.normal(size=dim)).tolist(), i % 3) for i in range(n)]
    rows += [(n + i, rows[1][1], 1) for i in range(n // 3)] + [rows[2], rows[2], (None, rows[3][1], 0), (4, rows[5][1], None)]
    rows += [(900, None, 0), (901, [NAN] * dim, 0), (902, [INF] * dim, 0), (903, [None] * dim, 0), (904, [0.0] * dim, 1), (905, [1.0] * (dim + 1), 1), (906, [], None)]
    return rows


def clusters(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_against_brute_force(spark):
    rows = odd_vectors(np.random.default_rng(3), 8, 120)
    rows += [(1000 + i, [float(i % 2)] * 8, 0) for i in range(30)]  # ties between centroids of equal vectors
    got = cluster_vectors(table(spark, rows), k=13, rounds=3, dim=8)
    assert clusters(got) == brute_clusters(rows, 13, 3, 8)
    few = rows[:5]
    assert clusters(cluster_vectors(table(spark, few), k=13, rounds=2, dim=8)) == brute_clusters(few, 13, 2, 8)
    assert cluster_vectors(table(spark, rows).limit(0)).collect() == []
    assert cluster_vectors(table(spark, [(1, [3e38] * 8, 0)]), dim=8).collect() == []


@pytest.mark.parametrize("spread", [1, 4, 1000, 1 << 25])
def test_vantage_tree_and_gnat_are_exact(spread):
    rnd = np.random.default_rng(spread)
    for n, dim in ((1, 3), (5, 1), (40, 8), (200, 4)):
        points = rnd.integers(-spread, spread + 1, (n, dim))
        x = np.concatenate([points, rnd.integers(-spread, spread + 1, (150, dim))])
        want = [nearest(r, points.tolist()) for r in x.tolist()]
        for found in (VantageTree(points), Gnat(points)):
            who, d = found.nearest(x)
            assert list(zip(d.tolist(), who.tolist(), strict=True)) == want


def test_trees_rule_out_most_of_clustered_points():
    """The bounds spare distances, not only sort them."""
    rnd = np.random.default_rng(1)
    points = (rnd.normal(size=(8, 1, 16)) * 4000 + rnd.normal(size=(8, 32, 16)) * 40).astype(np.int64).reshape(256, 16)
    x = points[::3] + rnd.integers(-5, 6, (86, 16))
    import tarnlake.llm.centroids as centroids
    import tarnlake.llm.codes as codes

    seen = []
    plain = codes.square_distances, centroids.row_distances
    tree, gnat = VantageTree(points), Gnat(points)
    codes.square_distances = lambda a, b: (seen.append(len(a) * len(b)), plain[0](a, b))[1]
    centroids.row_distances = lambda a, b: (seen.append(len(a)), plain[1](a, b))[1]
    try:
        for found in (tree, gnat):
            seen.clear()
            found.nearest(x)
            assert sum(seen) < 0.4 * len(x) * len(points)
    finally:
        codes.square_distances, centroids.row_distances = plain


def brute_codes(rows, parts, size, rounds, dim, scale=1024):
    x = [(i, whole(v, scale), lab) for i, v, lab in kept_rows(rows, dim)]
    first = sorted((i, v) for i, v, _ in x if i is not None)[:size]
    w = dim // parts
    books = [[v[p * w : p * w + w] for _, v in first] for p in range(parts)]
    find = lambda v: [nearest(v[p * w : p * w + w], books[p]) for p in range(parts)]
    for _ in range(rounds):
        own = [find(v) for _, v, _ in x]
        for p in range(parts):
            for e in range(len(first)):
                mine = [v[p * w : p * w + w] for (_, v, _), o in zip(x, own, strict=True) if o[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = [(i, lab, find(v)) for i, v, lab in x]
    error = {}
    for _, lab, f in found:
        error[lab] = error.get(lab, 0) + sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i is None, i or 0, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), error[lab], sha) for i, lab, f in found)


def test_codes_against_brute_force(spark):
    rows = odd_vectors(np.random.default_rng(5), 8, 90)
    got = lambda df, **how: sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress_vectors(df, **how).collect())
    assert got(table(spark, rows), size=40, rounds=2) == brute_codes(rows, 4, 40, 2, 8)
    assert got(table(spark, rows[:3]), rounds=1) == brute_codes(rows[:3], 4, 256, 1, 8)
    assert got(table(spark, rows).limit(0)) == []
    with pytest.raises(ValueError):
        compress_vectors(table(spark, rows), size=300)


def brute_links(rows, cosine):
    ok = [i for i, (_, v, x) in enumerate(rows) if x is not None and v and kept_rows([(0, v, x)]) and any(v)]
    links, reach = {i: set() for i in range(len(rows))}, {i: {i} for i in range(len(rows))}
    for a in ok:
        for b in ok:
            (_, v, x), (_, w, y) = rows[a], rows[b]
            if a != b and x == y and len(v) == len(w):
                v, w = np.float32(v).astype(np.float64).reshape(-1), np.float32(w).astype(np.float64).reshape(-1)
                if v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                    links[a].add(b)
    for a in range(len(rows)):
        todo = [a]
        while todo:
            for b in links[todo.pop()] - reach[a]:
                reach[a].add(b)
                todo.append(b)
    out = []
    for a, (i, _, _) in enumerate(rows):
        least = min((rows[b][0] for b in reach[a] if rows[b][0] is not None), default=None)
        out.append((i, len(links[a]), least, i == least))
    return sorted(out, key=repr)


def near_rows(rnd, dim, groups, spread):
    rows = []
    for g, size in enumerate(groups):
        centre = rnd.normal(size=dim)
        rows += [(len(rows) + j, np.float32((centre + spread * np.linalg.norm(centre) / dim**0.5 * rnd.normal(size=dim)) * (1 + j % 3)).tolist(), g % 2) for j in range(size)]
    return rows


@pytest.mark.parametrize("how", [{}, {"target_recall": 1}, {"target_recall": 1, "rows_per_cell": 5, "block": 16}, {"rows_per_cell": 5, "block": 16}])
def test_links_against_brute_force(spark, how):
    rnd = np.random.default_rng(8)
    rows = near_rows(rnd, 16, [60, 30, 5, 2, 2, 1, 1, 40], 0.13)
    rows += [(r[0] + 5000, *r[1:]) for r in rows[:20]] + [rows[7], rows[7], (None, rows[0][1], 0), (None, [1.0] + [0.0] * 15, 0)]
    rows += odd_vectors(rnd, 16, 30) + [(3000, [0.5], 1), (3001, [0.25], 1), (3002, [-1.0], 1), (3003, [1e-30] * 16, 1), (3004, [3e38] * 16, 1)]
    want = brute_links(rows, 0.98)
    assert 40 < sum(r[1] > 0 for r in want) and any(r[1] > 20 for r in want)
    got = near_duplicate_vectors(table(spark, rows), **how).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_links_of_nothing(spark):
    assert near_duplicate_vectors(table(spark, []).limit(0)).collect() == []
    only = near_duplicate_vectors(table(spark, [(1, None, 1), (None, [1.0], None)])).collect()
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in only) == [("1", 0, True), ("None", 0, True)]
    assert near_duplicate_vectors(table(spark, [(1, [1.0], 1)])).first().n_links == 0


def test_few_cells_are_visited_and_links_found():
    rnd = np.random.default_rng(2)
    x = unit(rnd.normal(size=(4000, 64)))
    w = rnd.normal(size=x.shape)
    w -= (w * x).sum(axis=1)[:, None] * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * unit(w)
    index = MultiIndex(x, 10, 0.98, 0.99999)
    (own, seen), (other, back) = index.visits(x), index.visits(y)
    assert sum(map(len, seen)) / len(seen) < 8  # of a hundred cells
    met = sum(b in s or a in t for a, s, b, t in zip(own, seen, other, back, strict=True))
    assert met >= 3999
    proof = MultiIndex(x, 10, 0.98, 1)
    (own, seen), (other, back) = proof.visits(x), proof.visits(y)
    assert all(b in s or a in t for a, s, b, t in zip(own, seen, other, back, strict=True))


def test_cells_come_by_distance():
    a, b = np.array([0.3, 0.0, 0.2]), np.array([0.0, 0.1, 0.4])
    got = list(multi_sequence(a, b, 0.35))
    far = {(i, j): math.hypot(a[i], b[j]) for i in range(3) for j in range(3)}
    assert set(got) == {c for c, d in far.items() if d <= 0.35}
    assert [far[c] for c in got] == sorted(far[c] for c in got)


def test_links_on_a_table_with_planted_groups(spark):
    """More rows, several cells a label, against all pairs."""
    rnd = np.random.default_rng(6)
    rows = near_rows(rnd, 64, [300, 200] + [2] * 200 + [1] * 2000, 0.1)
    x = unit(np.array([r[1] for r in rows], np.float32).astype(np.float64))
    labels = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    got = {r.vec_id: r for r in near_duplicate_vectors(table(spark, rows)).collect()}
    assert [got[i].n_links for i in range(len(rows))] == (near.sum(axis=1) - 1).tolist()
    assert got[0].component_id == 0 and sum(r.kept for r in got.values()) < len(rows)
    assert table(spark, rows).agg(F.count("*")).first()[0] == len(got)
