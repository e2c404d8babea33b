"""Pairs of rows of matrices by blocks, against brute force: missing values, rows of one value, text for names."""

import itertools
import random

import numpy as np
import pytest

from lociframe.operators import matrix as mx

CELL = "row string, col bigint, value double"


def matrix(n, seed, columns=12, missing=0.3):
    rng = random.Random(seed)
    out = {}
    for k in range(n):
        full = [float(rng.randint(-9, 9)) if k % 7 else 3.3 for _ in range(columns)]
        out[f"{seed}r{k}"] = {c: (float("nan") if rng.random() < 0.05 else v) for c, v in enumerate(full) if rng.random() > missing}
    return out


def cells(spark, m):
    return spark.createDataFrame([(r, c, v) for r, of in m.items() for c, v in of.items()], CELL)


def shared(a, b):
    both = [c for c in a if c in b and a[c] == a[c] and b[c] == b[c]]
    return np.array([a[c] for c in both]), np.array([b[c] for c in both]), sorted(both)


@pytest.fixture(params=[(1024, 2048), (5, 4)], ids=["whole", "in parts"])
def sized(request, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_ROWS", request.param[0])
    monkeypatch.setattr(mx, "BLOCK_COLUMNS", request.param[1])


def test_pairs_are_those_of_brute_force(spark, sized):
    a, b = matrix(9, 1), matrix(13, 2)
    x, y = cells(spark, a), cells(spark, b)
    pairs = {(r, s): shared(a[r], b[s]) for r in a for s in b if len(shared(a[r], b[s])[0])}
    got = {(r.row1, r.row2): tuple(r)[2:] for r in mx.row_pairs(x, y).collect()}
    assert got.keys() == pairs.keys()
    for k, (u, v, _) in pairs.items():
        assert np.allclose(got[k], (len(u), u.sum(), v.sum(), (u * v).sum(), (u * u).sum(), (v * v).sum()))
    corr = {(r.row1, r.row2): r.r for r in mx.correlations(x, y).collect()}
    line = {(r.row1, r.row2): (r.c0, r.c1, r.chi2) for r in mx.regressions(x, y).collect()}
    assert corr.keys() == line.keys() == pairs.keys()
    for k, (u, v, _) in pairs.items():
        if len(u) < 2 or min(u.std(), v.std()) < 1e-12:
            assert corr[k] is None
        else:
            assert abs(corr[k] - np.corrcoef(u, v)[0, 1]) < 1e-9
        if u.std() < 1e-12:
            assert line[k] == (None, None, None)
        else:
            c1, c0 = np.polyfit(u, v, 1)
            assert np.allclose(line[k], (c0, c1, ((v - c0 - c1 * u) ** 2).mean()), atol=1e-8)
    over = {(r.row1, r.row2): r.n for r in mx.differences(x, y, 2.0, 1.0).collect()}
    assert over == {k: int(((u + 1 > 2 * (v + 1)) | (v + 1 > 2 * (u + 1))).sum()) for k, (u, v, _) in pairs.items()}
    by = {(r.row1, r.row2, r.col): r.value for r in mx.ratios(x, y).collect()}
    assert by == {(*k, c): (p / q if q else None) for k, (u, v, cols) in pairs.items() for c, p, q in zip(cols, u, v)}


def test_pairs_of_one_table_come_once(spark, sized):
    a = matrix(11, 3)
    got = sorted((r.row1, r.row2) for r in mx.correlations(cells(spark, a)).collect())
    assert got == [(r, s) for r, s in itertools.combinations(sorted(a), 2) if len(shared(a[r], a[s])[0])]
    boot = mx.bootstrap_correlations(cells(spark, a), 4, 5).collect()
    assert sorted((r.row1, r.row2) for r in boot) == got and all(r.mean is None or abs(r.mean) <= 1 + 1e-9 for r in boot)


def test_pairs_are_not_shuffled(spark):
    a = cells(spark, matrix(8, 4))
    for df in (mx.row_pairs(a, a), mx.correlations(a, a), mx.differences(a, a, 2.0), mx.ratios(a, a), mx.regressions(a, a), mx.bootstrap_correlations(a, 3, 1, a)):
        plan = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        cross = next(k for k, line in enumerate(plan) if "CartesianProduct" in line)
        assert not any("Aggregate" in line or "Join" in line for line in plan[:cross])
    assert mx.row_pairs(a, a.limit(0)).count() == 0
