import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from repotrend.llm import block_knn

ASKS = "vec_id % 100 = 0"
SCHEMA = "vec_id long, embedding array<double>, label int, key string, stripe int, v int"


def distance(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += (x - y) * (x - y)
    return math.sqrt(total)


def brute(rows, k=10):
    held = {(i, tuple(0.0 + x for x in v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in held:
        if i is not None and i % 100 == 0:
            near = sorted((distance(v, w), j is None, j or 0, j) for j, w in held if len(w) == len(v) and (j, w) != (i, v))
            out += [(i, r, j, d) for r, (d, _, _, j) in enumerate(near[:k], 1)]
    return sorted(out, key=str)


def got(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, 0, "k", 1, 2) for i, v in rows], SCHEMA).repartition(3) if isinstance(rows, list) else rows
    return sorted((tuple(r) for r in block_knn.neighbours(frame, F.expr(ASKS), **more).collect()), key=str)


def made(seed, n, size):
    rng = random.Random(seed)
    vector = lambda: [rng.gauss(0, 1) for _ in range(size)]
    centres = [vector() for _ in range(6)]
    rows = [(k, [x + rng.gauss(0, rng.choice([1e-9, 0.01, 1])) for x in rng.choice(centres)]) for k in range(n)]
    hot = vector()
    rows += [(2000 + 5 * k, list(hot)) for k in range(n // 2)]  # copies, a third of all, among them queries
    rows += [(7000 + k, [float(rng.randrange(2)) for _ in range(size)]) for k in range(n // 4)]  # ties
    return rows + rows[:5]


@pytest.mark.parametrize(("seed", "n", "size", "more"), [(1, 300, 8, {}), (2, 120, 3, {"block_bytes": 1000}), (3, 240, 5, {"k": 3, "block_bytes": 4000}), (4, 4, 2, {})])
def test_equals_brute_force(spark, seed, n, size, more):
    rows = made(seed, n, size)
    assert got(spark, rows, **more) == brute(rows, more.get("k", 10))


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [-0.0, 1.0]), (200, [0.0, 1.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [0.0, 1.0]), (None, [5.0, 5.0]), (9, [1e200, -1e200]),
            (300, [1e200, 1e200]), (10, [5e-324, 0.0]), (400, [1e-320, 0.0]), (500, [9.0, 9.0]), (500, [1.0, 1.0]), (600, [1.0, 2.0, 3.5])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, spark.createDataFrame([], SCHEMA)) == []
    assert got(spark, [(1, [1.0])]) == [] == got(spark, [(100, [1.0])])


def test_floats_of_a_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert got(spark, frame, block_bytes=20_000) == brute(rows)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    for scale in (1e-200, 1e-3, 1.0, 1e6, 1e150):
        x = rng.normal(size=(60, 1500)) * scale * rng.choice([1, 100], (60, 1))
        x[30:] = x[:30] * (1 + rng.choice([0, 1e-15, 1e-6], (30, 1)))
        rounded = block_knn.Rounded(x)
        lower, upper = rounded.bounds(slice(0, 60), rounded, slice(0, 60))
        i, j = (k.ravel() for k in np.mgrid[0:60, 0:60])
        true = block_knn.distances(x[i], x[j]).reshape(60, 60)
        assert (lower <= true).all() and (true <= upper).all()
        assert (block_knn.products(rounded.q, rounded.q) == rounded.q.astype(int) @ rounded.q.T.astype(int)).all()


def test_few_pairs_survive(monkeypatch):
    """The bounds do the work: of clustered vectors few pairs are recomputed, whatever the tiles."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 64))[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 64)) * 0.1
    seen = []
    real = block_knn.distances
    monkeypatch.setattr(block_knn, "distances", lambda a, b: seen.append(len(a)) or real(a, b))
    ids, none = np.arange(3000), np.zeros(3000, bool)
    found = list(block_knn.nearest(x[:50], ids[:50], x, ids, ids, none, 10, tile=512, rows=20))
    want = [sorted((real(np.repeat(x[[q]], 3000, 0), x)[j], j) for j in range(3000) if j != q)[:10] for q in range(50)]
    assert sorted((q, d, j) for q, d, j in found) == sorted((q, d, j) for q, own in enumerate(want) for d, j in own)
    assert sum(seen) < 50 * 3000 / 20
