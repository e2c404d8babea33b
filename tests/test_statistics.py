"""Local regression, outliers and the order of clusters against direct computations."""

import itertools
import math
import random

import numpy as np
import pytest

from lociframe.operators import stats as sx


def direct(x, y, at, span):
    """(value, slope) of the line through the nearest rows, by weighted least squares."""
    d = np.abs(x - at)
    h = np.sort(d)[max(1, int(len(x) * span + 1e-5)) - 1]
    w = (d == 0).astype(float) if h == 0 else np.where(d < h, (1 - np.minimum(d / h, 1) ** 3) ** 3, 0)
    if not w.any():
        return y[d <= h].mean(), 0.0
    if len(set(x[w > 0])) < 2:
        return np.average(y, weights=w), 0.0
    a = np.stack((np.ones_like(x), x - at), 1) * np.sqrt(w)[:, None]
    return tuple(np.linalg.lstsq(a, y * np.sqrt(w), rcond=None)[0])


@pytest.mark.parametrize("kind", ["smooth", "ties", "skewed"])
def test_local_lines(spark, kind):
    rng = random.Random(2)
    x = {"smooth": lambda: rng.random() * 10, "ties": lambda: float(rng.choice([0, 1, 1, 1, 5, 9])), "skewed": lambda: math.exp(8 * rng.random())}[kind]
    rows = [(k, v, math.sin(v / 3) + rng.random() / 5) for k, v in enumerate(x() for _ in range(300))]
    df = spark.createDataFrame([*rows, (900, None, 1.0), (901, 2.0, None)], "row long, a double, b double")
    xs, ys = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for span in (0.5, 0.1):
        lines = sx.local_lines(df, "a", "b", span, 9)
        assert [v for v, _, _ in lines] == pytest.approx(list(np.linspace(xs.min(), xs.max(), 9)))
        for v, value, slope in lines:
            a, b = direct(xs, ys, v, span)
            assert value == pytest.approx(a, rel=1e-6, abs=1e-8) and slope == pytest.approx(b, rel=1e-5, abs=1e-8)
        if kind == "smooth" and span == 0.5:  # the curve between the places stays near a fit at each row
            curve = {r.row: r.c for r in df.where("a IS NOT NULL").select("row", sx.along_lines(df.a, lines).alias("c")).collect()}
            assert max(abs(curve[k] - direct(xs, ys, v, span)[0]) for k, v, _ in rows[:80]) < 0.02


def test_nearest_distances_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, abs(rng.choice([rng.random(), 1e6 * rng.random(), 3.0]))) for k in (0, 1) for _ in range(3000)] + [(2, 0.0)] * 50
    df = spark.createDataFrame(rows, "k int, d double")
    for q in (1, 40):
        want = {k: sorted(d for j, d in rows if j == k)[q - 1] for k in (0, 1, 2)}
        assert sx.nearest_distances(df, q) == want


def test_without_outliers(spark):
    rng = random.Random(7)
    rows = [(k, v, 2 * v + rng.gauss(0, 1) + (40 if k in (3, 90) else 0)) for k, v in enumerate(rng.random() * 50 + 1 for _ in range(200))]
    df = spark.createDataFrame([*rows, (500, None, 1.0)], "row long, a double, b double")
    stay = {r.row for r in sx.without_outliers(df, "a", "b", 0.002).collect()}
    assert stay == set(range(200)) - {3, 90}
    assert {r.row for r in sx.without_outliers(df, "a", "b", 0.01, scale="log2").collect()} <= set(range(200))
    assert sx.without_outliers(df, "a", "b", 0.0).count() == 201
    assert sx.without_outliers(df.limit(0), "a", "b", 0.002).collect() == []
    same = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0)], "row long, a double, b double")
    assert sx.without_outliers(same, "a", "b", 0.002).count() == 2


@pytest.mark.parametrize("seed", range(5))
def test_leaf_order(seed):
    rng = random.Random(seed)
    points = [(rng.random(), rng.random()) for _ in range(7)]
    trees = [((k,), k, 0) for k in range(7)]  # leaves as ordered, least point, step at which it was made
    for step in range(1, 7):
        a, b = min(itertools.combinations(trees, 2), key=lambda ab: max(math.dist(points[i], points[j]) for i in ab[0][0] for j in ab[1][0]))
        if (a[2], a[1]) > (b[2], b[1]) and not a[2] == b[2] == 0:
            a, b = b, a
        trees = [t for t in trees if t not in (a, b)] + [(a[0] + b[0], min(a[1], b[1]), step)]
    assert tuple(sx.leaf_order(points)) == trees[0][0]
    assert sx.leaf_order([]) == [] and sx.leaf_order([(1.0,)]) == [0]
    assert sx.leaf_order([(0.0,), (10.0,), (1.0,), (11.0,), (30.0,)]) == [4, 0, 2, 1, 3]


def test_clusters(spark):
    rng = random.Random(1)
    centres = [(0.0, 0.0), (10.0, 0.0), (1.5, 0.0), (30.0, 4.0)]
    rows = [(k, [c + rng.gauss(0, 0.1) for c in centres[k % 4]]) for k in range(80)]
    got = {r.row: r.cluster for r in sx.clusters(spark.createDataFrame(rows, "row long, v array<double>"), 4).collect()}
    assert {k % 4: got[k] for k in got} == {3: 0, 1: 1, 0: 2, 2: 3} and len(set((k % 4, c) for k, c in got.items())) == 4
