import hashlib
import math

import numpy as np
import pytest

from pitchline.llm import clustering, cover_tree


def brute(rows, k=16, rounds=3, dimensions=64, scale=64.0):
    """The contract, one vector at a time, in Python's integers."""
    kept = [(i, [float(x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    whole = lambda v: [math.floor(scale * x) for x in v]
    centroids = [whole(v) for _, v in hashed[:k]]
    vectors = [whole(v) for _, v in kept]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for v in vectors]
        for n in set(of):
            mine = [v for v, c in zip(vectors, of) if c == n]
            centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, *reversed(nearest(v))) for (i, _), v in zip(kept, vectors)]
    per = {}
    for _, c, d in out:
        per[c] = per.get(c, 0) + d
    cap = clustering.LARGEST
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, min(d, cap), min(per[c], cap), min(sum(per.values()), cap), sha[c]) for i, c, d in out]


def table(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


SCHEMA = "vec_id long, embedding array<float>, cluster int, x string, distance string, of int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "d", 2) for i, v in rows], SCHEMA)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64)]) for i in range(60)]
    rows += [(100, rows[0][1]), (100, rows[1][1]), (0, rows[0][1]), (None, rows[2][1]), (None, rows[3][1])]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63), (205, [float("nan")] * 64), (206, [float("inf")] + [0.0] * 63)]
    rows += [(300 + i, [0.0] * 64) for i in range(90)] + [(500, [1 / 128] * 64), (501, [-1 / 128] * 64)]
    assert table(clustering.clusters(frame(spark, rows))) == sorted(brute(rows), key=repr)


def test_components_of_any_size(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64) * 10.0 ** (i % 39)]) for i in range(80)]
    assert table(clustering.clusters(frame(spark, rows))) == sorted(brute(rows), key=repr)


def test_few_and_no_vectors(spark):
    assert table(clustering.clusters(frame(spark, []))) == []
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert table(clustering.clusters(frame(spark, rows))) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("kind", ["clustered", "uniform", "equal", "line"])
@pytest.mark.parametrize("k", [1, 7, 60])
def test_dual_tree_equals_exact_comparison(kind, k):
    rng = np.random.default_rng(5)
    make = {
        "clustered": lambda n: (rng.integers(-500, 500, (8, 6))[rng.integers(0, 8, n)] + rng.integers(-9, 9, (n, 6))),
        "uniform": lambda n: rng.integers(-4, 4, (n, 6)), "equal": lambda n: np.zeros((n, 6), np.int64), "line": lambda n: np.arange(n)[:, None] * np.ones(6, np.int64),
    }[kind]
    points, centroids = make(700), make(k)
    number, squared = cover_tree.nearest(cover_tree.build(points, 8), cover_tree.build(centroids, 1))
    d = ((points[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (squared == d.min(axis=1)).all()


def test_tree_covers_and_separates():
    points = np.random.default_rng(6).integers(-300, 300, (900, 5))
    tree = cover_tree.build(points, 4)
    assert (tree.points == points[tree.row]).all() and sorted(tree.row) == list(range(900))
    for n in range(len(tree.centre)):
        own = tree.points[tree.begin[n] : tree.end[n]]
        d = np.sqrt(((own - tree.points[tree.centre[n]]) ** 2).sum(axis=1))
        assert math.isclose(d.max(), tree.reach[n])
        if tree.last[n] > tree.first[n]:
            below = range(tree.first[n], tree.last[n])
            assert tree.begin[tree.first[n]] == tree.begin[n] and tree.end[tree.last[n] - 1] == tree.end[n]
            centres = tree.points[tree.centre[list(below)]]
            scale = 2.0 ** (math.ceil(math.log2(tree.reach[n])) - 1)
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
            assert (gaps[~np.eye(len(centres), dtype=bool)] > scale).all() and tree.reach[list(below)].max() <= scale


def test_far_pairs_are_dropped_before_they_are_compared(monkeypatch):
    rng = np.random.default_rng(7)
    middles = rng.integers(-9000, 9000, (32, 6))
    points = middles[rng.integers(0, 32, 3000)] + rng.integers(-20, 20, (3000, 6))
    compared = 0
    real = cover_tree._compare

    def counted(tree, centroids, v, c, best, number):
        nonlocal compared
        compared += int(((tree.end - tree.begin)[v] * (centroids.end - centroids.begin)[c]).sum())
        real(tree, centroids, v, c, best, number)

    monkeypatch.setattr(cover_tree, "_compare", counted)
    cover_tree.nearest(cover_tree.build(points, 16), cover_tree.build(middles, 1))
    assert compared < 3000 * 32 / 8
