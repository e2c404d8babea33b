"""Domain calls, smoothing in two dimensions and paths over lambda against direct computations on dense matrices."""

import itertools
import math
import random

import numpy as np
import pytest

from lociframe.operators import fusion as fu
from lociframe.operators import topdomains as td

CELLS = "chrom string, i long, j long, x double"


def matrices(seed=3):
    """Matrices with blocks, holes and an empty one: {chrom: n x n}."""
    rng = np.random.default_rng(seed)
    out = {}
    for chrom, n, edges in (("a", 61, [0, 12, 25, 40, 61]), ("b", 30, [0, 9, 20, 30]), ("c", 7, [0, 7]), ("d", 5, [0, 5])):
        m = np.zeros((n, n))
        for lo, hi in zip(edges, edges[1:]):
            for i, j in itertools.combinations_with_replacement(range(lo, hi), 2):
                m[i, j] = rng.poisson(30 / (1 + j - i))
        for i, j in itertools.combinations(range(n), 2):
            if not m[i, j]:
                m[i, j] = rng.poisson(3 / (1 + j - i))
        out[chrom] = np.triu(m) + np.triu(m, 1).T
    a = out["a"]
    a[28:33] = 0  # a gap in a domain, and one that leaves a short stretch behind
    a[:, 28:33] = 0
    a[36:39] = 0
    a[:, 36:39] = 0
    out["b"][-1] = out["b"][:, -1] = 0
    out["d"][:] = 0
    return out


def frames(spark, ms):
    cells = [(c, i, j, float(m[i, j])) for c, m in ms.items() for i in range(len(m)) for j in range(i, len(m)) if m[i, j]]
    return spark.createDataFrame(cells, CELLS), spark.createDataFrame([(c, len(m)) for c, m in ms.items()], "chrom string, n long")


def plain_gaps(m):
    n, gap, i = len(m), [False] * len(m), 0
    while i < n - 1:
        j = i + 1
        while j < n and not m[i : j + 1, i : j + 1].any():
            gap[i : j + 1] = [True] * (j + 1 - i)
            j += 1
        i = j
    return gap


def plain_runs(gap):
    out = []
    for free, part in itertools.groupby(range(len(gap)), lambda k: not gap[k]):
        part = list(part)
        if free and len(part) >= 4:
            out.append((part[0], part[-1]))
    return out


def plain_extremes(x):
    """The same rules, with the distances to the chord point by point."""
    n = len(x)
    found = [0] * n
    step = sum(abs(b - a) for a, b in zip(x, x[1:])) / (n - 1)
    if step == 0:
        return found
    y = [x[0] + (v - x[0]) / step for v in x]

    def value(i, j):
        chord = math.sqrt((j - i) ** 2 + (y[j] - y[i]) ** 2)
        return chord - sum(abs((y[j] - y[i]) * k - (j - i) * y[k] - i * y[j] + j * y[i]) for k in range(i + 1, j)) / chord

    bends, i = [0], 0
    while i < n - 1:
        j = next((j for j in range(i + 2, n) if value(i, j) < value(i, j - 1)), None)
        i = n - 1 if j is None else j - 1
        if j is not None:
            bends.append(i)
    bends.append(n - 1)
    for a, b in zip(bends[:-2], bends[1:-1]):
        if y[b] >= y[b - 1] and y[b] >= y[b + 1]:
            found[b] = 1
        elif y[b] < y[b - 1] and y[b] < y[b + 1]:
            found[b] = -1
        part = y[a : b + 1]
        if min(part) < min(y[a], y[b]):
            found[a + part.index(min(part))] = -1
        if max(part) > max(y[a], y[b]):
            found[a + part.index(max(part))] = 1
    return found


def plain_rank_sum(a, b):
    u = sum((x > y) + (x == y) / 2 for x in a for y in b)
    both = sorted([*a, *b])
    n, m, t = len(a), len(b), len(both)
    ties = sum(len(list(g)) ** 3 - both.count(k) for k, g in itertools.groupby(both))
    z = (u - n * m / 2 + 0.5) / math.sqrt(n * m / 12 * (t + 1 - ties / (t * (t - 1))))
    return z, (1 + math.erf(z / math.sqrt(2))) / 2


def plain_tests(m, window, runs):
    n = len(m)
    z = np.full((n, n), np.nan)
    for d in range(1, min(2 * window, n - 1) + 1):
        own = np.array([m[k, k + d] for k in range(n - d)])
        if len(own) > 1 and own.std() > 0:
            for k in range(n - d):
                z[k, k + d] = (own[k] - own.mean()) / own.std(ddof=1)
    p = {}
    for low, high in runs:
        for b in range(low, high + 1):
            if b == high:
                p[b] = 1.0
                continue
            left, right = range(max(low, b - window), b + 1), range(b + 1, min(high, b + window) + 1)
            across = [z[i, j] for i in left if i > b - window for j in right]
            beside = [z[i, j] for s in (left, right) for i, j in itertools.combinations(s, 2)]
            across, beside = [v for v in across if not np.isnan(v)], [v for v in beside if not np.isnan(v)]
            p[b] = plain_rank_sum(across, beside)[1] if across and beside else 1.0
    return p


def test_gaps_and_stretches(spark):
    ms = matrices()
    cells, sizes = frames(spark, ms)
    gaps = td.gaps(cells, sizes)
    got = {c: [r.gap for r in sorted(gaps.where(f"chrom = '{c}'").collect(), key=lambda r: r.i)] for c in ms}
    assert got == {c: plain_gaps(m) for c, m in ms.items()} and all(got["d"]) and any(got["a"])
    runs = {(r.chrom, r.low, r.high) for r in td.stretches(gaps).collect()}
    assert runs == {(c, *r) for c, m in ms.items() for r in plain_runs(plain_gaps(m))}


@pytest.mark.parametrize("seed", range(5))
def test_change_points(seed):
    rng = random.Random(seed)
    for n in (4, 5, 9, 40):
        for x in ([rng.random() for _ in range(n)], [float(rng.randrange(3)) for _ in range(n)], [1.0] * n, [float(k) for k in range(n)]):
            assert td.local_extremes(np.array(x)).tolist() == plain_extremes(x)


def test_rank_sum():
    rng = random.Random(1)
    for n, m in ((1, 1), (3, 7), (20, 25)):
        a, b = [float(rng.randrange(6)) for _ in range(n)], [float(rng.randrange(6)) + 0.5 * (n > 1) for _ in range(m)]
        if len({*a, *b}) > 1:
            assert np.allclose(td.rank_sum(np.array(a), np.array(b)), plain_rank_sum(a, b))
    assert td.rank_sum(np.array([1.0]), np.array([1.0]))[1] == 1.0 and td.rank_sum(np.array([np.nan]), np.array([1.0]))[1] == 1.0


@pytest.mark.parametrize("tile", [16, 256])
def test_boundary_tests(spark, monkeypatch, tile):
    monkeypatch.setattr(td, "TILE", tile)
    ms, window = matrices(), 5
    cells, sizes = frames(spark, ms)
    bins = td.stretches(td.gaps(cells, sizes))
    got = {(r.chrom, r.i): r.p for r in td.tests(cells, sizes, bins, window).collect()}
    want = {(c, b): p for c, m in ms.items() for b, p in plain_tests(m, window, plain_runs(plain_gaps(m))).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def plain_domains(m, window, bin_size, cut):
    n, gap = len(m), plain_gaps(m)
    mean = [m[max(0, b - window + 1) : b + 1, b + 1 : b + window + 1].mean() if b < n - 1 else 0.0 for b in range(n)]
    ext, p = [None] * n, plain_tests(m, window, plain_runs(gap)) if cut else {}
    for low, high in plain_runs(gap):
        ext[low : high + 1] = [0 if cut and e == -1 and p[low + k] >= cut else e for k, e in enumerate(plain_extremes(mean[low : high + 1]))]
    p = [p.get(b, 1.0) for b in range(n)]
    kinds = ["gap" if e is None else "end" if e == -1 else "domain" for e in ext]
    parts, at = [], 0
    for kind, run in itertools.groupby(kinds):
        size = len(list(run))
        alone = size == 1 and at > 0 and kind not in kinds[at + 1 :]
        if kind != "end" and not alone or not parts:
            parts.append([kind, at, at + size])
        else:
            parts[-1][2] = at + size
        at += size
    out = []
    for kind, a, b in parts:
        most = max(p[a:b])
        out.append((a * bin_size, b * bin_size, "boundary" if kind == "domain" and most < 0.05 else kind, round(most, 9)))
    return out


@pytest.mark.parametrize("cut", [0.05, 0.5, None])
def test_domains(spark, cut):
    ms = matrices()
    cells, sizes = frames(spark, ms)
    got = td.domains(td.domain_signal(cells, sizes, 5, cut), 100).collect()
    want = {(c, *d) for c, m in ms.items() for d in plain_domains(m, 5, 100, cut)}
    assert {(r.chrom, r.start, r.stop, r.tag, round(r.p, 9)) for r in got} == want and len(got) == len(want)
    assert {"gap", "domain"} <= {r.tag for r in got}
    assert td.domains(td.domain_signal(cells.limit(0), sizes.limit(0), 5, cut), 100).collect() == []


def test_marks(spark):
    ms = matrices()
    cells, sizes = frames(spark, ms)
    signal = spark.createDataFrame([("b", k, float(v)) for k, v in enumerate([0, 5, 9, 3, 9, 9, 1, 8])], "chrom string, i long, x double")
    own = td.extrema(signal, sizes.where("chrom = 'b'"), 0.1).where("boundary = 1").collect()
    assert sorted(r.i for r in own) == [0, 2, 7, 29]  # the level step of 9, 9 is no top
    rows = [("a", k, int(k in (3, 9, 10, 30, 60))) for k in range(61)] + [("c", 0, 1), ("d", 0, 1), ("d", 4, 1)]
    b = spark.createDataFrame(rows, "chrom string, i long, boundary int")
    best = {(r.chrom, r.low, r.high): r.score for r in td.mark_domains(cells, b, 2).collect()}
    sums = {(lo, hi): ms["a"][lo : hi + 1, lo : hi + 1].sum() for lo, hi in ((3, 9), (9, 10), (10, 30), (30, 60))}
    top = sorted(sums, key=lambda k: -sums[k])[:2]
    assert best == {**{("a", *k): sums[k] for k in top}, ("d", 0, 4): 0.0}
    got = {(r.i, r.j) for r in td.marked(td.mark_domains(cells, b, 2)).where("chrom = 'a'").collect()}
    assert got == {(i, j) for lo, hi in top for i in range(lo, hi + 1) for j in range(i, hi + 1)}
    assert {r.chrom: r.n for r in td.count_domains(b, 7).collect()} == {"a": 3, "d": 0}


def test_smoothing_in_two_dimensions(spark):
    rng = np.random.default_rng(7)
    y = {c: np.round(rng.normal(size=(n, n)) * 3 + (np.add.outer(np.arange(n), np.arange(n)) > n) * 5, 2) for c, n in (("a", 5), ("b", 1))}
    rows = spark.createDataFrame([(c, i, j, float(m[i, j])) for c, m in y.items() for i in range(len(m)) for j in range(len(m))], CELLS)
    found = {}
    for r in fu.smooth(rows, [0.0, 0.7, 100.0], tolerance=1e-6).collect():
        found.setdefault((r.chrom, r.lam), np.zeros_like(y[r.chrom]))[r.i, r.j] = r.x
    for (c, lam), x in found.items():
        m = y[c]
        goal = lambda z: ((z - m) ** 2).sum() / 2 + lam * (np.abs(np.diff(z, axis=0)).sum() + np.abs(np.diff(z, axis=1)).sum())  # noqa: B023, E731
        here = goal(x)
        for _ in range(200):  # the minimum of a convex function: no step leads lower
            part = np.zeros_like(x)
            i, j = rng.integers(0, len(x), 2)
            part[i : i + rng.integers(1, 4), j : j + rng.integers(1, 4)] = rng.normal()
            assert goal(x + 0.01 * part) >= here - 1e-4
        assert abs(x.mean() - m.mean()) < 1e-3
        if lam == 0:
            assert np.allclose(x, m)
        if lam == 100:
            assert np.allclose(x, m.mean(), atol=1e-2)
    thin = {(r.chrom, r.i, r.j): r.x for r in fu.smooth(rows, [0.7], gamma=1.5, tolerance=1e-6).collect()}
    assert all(abs(thin[c, i, j] - np.sign(v) * max(abs(v) - 1.5, 0)) < 1e-3 for (c, lam), x in found.items() if lam == 0.7 for (i, j), v in np.ndenumerate(x))
    with pytest.raises(RuntimeError):
        fu.smooth(rows, [0.7], tolerance=0.0, most_rounds=2)


def test_alternate(spark):
    rng = np.random.default_rng(2)
    m = rng.poisson(4, (5, 5)).astype(float)
    m = m + m.T
    rows = spark.createDataFrame([("a", i, j, float(m[i, j])) for i in range(5) for j in range(5)] + [("b", 0, 0, 0.5)], CELLS)
    got = fu.alternate(rows, 0.5, 0.2).collect()
    from lociframe.operators.contact import total_variation

    x, rounds = m, 0
    while True:
        new = np.array([fu.soft(total_variation(row, 0.5), 0.2) for row in x.T])
        change, x, rounds = np.abs(new - x).sum(), new, rounds + 1
        if change < 1:
            break
    assert rounds > 1 and {(r.i, r.j): r.x for r in got if r.chrom == "a"} == {k: pytest.approx(v) for k, v in np.ndenumerate(x)}
    assert {r.rounds for r in got if r.chrom == "a"} == {rounds} and [(r.rounds, round(r.x, 9)) for r in got if r.chrom == "b"] == [(1, 0.3)]


def plain_parts(m, most, tolerance):
    n, seen, parts = len(m), set(), 0
    ok = lambda i, j: 0 <= i < n and 0 <= j < n and abs(i - j) <= most and m[i, j] > 0 and m[i, j] >= tolerance
    for at in itertools.product(range(n), repeat=2):
        if at in seen or not ok(*at):
            continue
        parts += 1
        todo = [at]
        seen.add(at)
        while todo:
            i, j = todo.pop()
            for a, b in itertools.product((i - 1, i, i + 1), (j - 1, j, j + 1)):
                if (a, b) not in seen and ok(a, b) and abs(m[a, b] - m[i, j]) <= tolerance:
                    seen.add((a, b))
                    todo.append((a, b))
    return parts


def test_paths(spark):
    rng = np.random.default_rng(5)
    paths = {}
    for side in "xy":
        paths[side] = {(c, lam): np.round(rng.integers(0, 9, (n, n)) / (lam + 1)) for c, n in (("a", 12), ("b", 6)) for lam in (0.0, 1.0, 3.0, 8.0)}
    schema = "chrom string, lam double, i long, j long, x double"
    a, b = (spark.createDataFrame([(*k, i, j, float(v)) for k, m in paths[s].items() for (i, j), v in np.ndenumerate(m)], schema) for s in "xy")
    for most, tolerance in ((None, 0.0), (4, 0.0), (4, 1.0)):
        df = {(r.chrom, r.lam): r.df for r in fu.degrees_of_freedom(a, most, tolerance).collect()}
        assert df == {k: n for k, m in paths["x"].items() if (n := plain_parts(m, 99 if most is None else most, tolerance))}
    freedom = {s: {k: plain_parts(m, 99, 0.0) for k, m in paths[s].items()} for s in "xy"}
    best = {r.chrom: r.lam for r in fu.best_lambda(*(fu.degrees_of_freedom(p) for p in (a, b))).collect()}
    lams = [0.0, 1.0, 3.0, 8.0]
    for c in "ab":
        drops = [[freedom[s][c, y] - freedom[s][c, x] for x, y in zip(lams, lams[1:])] for s in "xy"]
        assert best[c] == lams[min(1 + d.index(min(d)) for d in drops)]

    def ranks(v):
        return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])

    for method in ("pearson", "spearman", "pearsonlog2"):
        got = {(r.chrom, r.lam, r.dist): r.r for r in fu.path_correlations(a, b, [2, 5], method).collect()}
        for (c, lam), m in paths["x"].items():
            d = np.subtract.outer(np.arange(len(m)), np.arange(len(m))).T
            for lo, hi in ((0, 2), (2, 5)):
                u, v = (p[c, lam][(d >= lo) & (d <= hi)] for p in (paths["x"], paths["y"]))
                if method == "spearman":
                    u, v = ranks(u), ranks(v)
                if method == "pearsonlog2":
                    least = [min(q[q > 0].min() for k, q in p.items() if k[0] == c) for p in (paths["x"], paths["y"])]
                    u, v = (np.log2(np.where(w > 0, w, e)) for w, e in zip((u, v), least))
                assert got[c, lam, hi] == (pytest.approx(np.corrcoef(u, v)[0, 1]) if u.std() * v.std() else None)
