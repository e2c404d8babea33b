"""Sums per reference row without pairs, and pairs that no shuffle moves."""

import random

import pytest

from lociframe.operators import overlap as ov
from lociframe.operators import scan as sc
from lociframe.plans import pipelines as pl

ROW = "label string, chrom string, strand string, start bigint, stop bigint"
REGION = "label string, intervals array<struct<chrom:string,strand:string,start:bigint,stop:bigint>>"


def rows(n, seed, span=200_000):
    """Rows in order, empty ones and some whose stop lies far before their start."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        s = rng.randint(1, span)
        out.append((f"{rng.randint(0, 150)}.{k}", f"c{rng.randint(1, 2)}", rng.choice("+-"), s, s + rng.choice([0, 5, 400, 70_000, -1, -2, -300])))
    return out


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("ignore", [False, True])
def test_sums_are_those_of_all_pairs(spark, ignore):
    a, b = rows(150, 1) * 2, rows(90, 2)
    test, ref = spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW)
    hits = {y: [x for x in a if x[1] == y[1] and (ignore or x[2] == y[2]) and x[3] <= y[4] and x[4] >= y[3]] for y in b}
    want = {
        "count": {y[0]: len(h) for y, h in hits.items()},
        "weighted": {y[0]: sum(min(100, int(x[0].split(".")[0])) for x in h) for y, h in hits.items()},
        "coverage": {y[0]: sum(min(x[4], y[4]) - max(x[3], y[3]) + 1 for x in h) for y, h in hits.items()},
    }
    got = {"count": ov.count(test, ref, ignore), "weighted": ov.count(test, ref, ignore, 100), "coverage": ov.coverage(test, ref, ignore)}
    for name, df in got.items():
        assert {r.label: r.n for r in df.collect()} == want[name], name
    both = ov.counts({"x": test, "y": test.where("strand = '+'")}, ref, True).collect()
    assert ignore is False or {r.label: r.x for r in both} == want["count"]


def test_no_pairs_are_made_for_sums(spark):
    a, b = (spark.createDataFrame([(f"r{k}", "c", "+", k + 1, 5000 + k) for k in range(n)], ROW) for n in (300, 200))
    for df in (ov.count(a, b), ov.coverage(a, b), ov.density(a, b)):
        assert "a_start" not in plan(df)  # no row of a meets one of b
    assert {r.n for r in ov.count(a, b).collect()} == {300}


def test_a_count_of_several_tables_reads_each_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("r", "c", "+", 1, 9), ("s", "c", "-", 5, 7)], ROW).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    few, many = (plan(ov.counts({f"n{k}": read() for k in range(n)}, read())).count("Relation [") for n in (1, 4))
    assert many <= 4 * few


@pytest.mark.parametrize("bins,ignore,op", [(4, False, "hits"), (7, True, "value"), (40, False, "hits")])
def test_signal_matrix_of_hand(spark, bins, ignore, op):
    rng = random.Random(bins)
    points = [(f"{k % 5}", f"c{rng.randint(1, 2)}", rng.choice("+-"), p, p + 30) for k in range(400) for p in [rng.randint(1, 900)]]
    regions = []
    for k in range(12):
        at, c, s, parts = rng.randint(1, 300), f"c{rng.randint(1, 2)}", rng.choice("+-"), []
        for _ in range(rng.randint(1, 3)):
            n = rng.choice([1, 9, 130])
            parts.append((c, s, at, at + n - 1))
            at += n + rng.choice([0, 50])
        regions.append((f"g{k}", parts))
    want = {}
    for g, parts in regions:
        bases = [(c, s, p) for c, s, lo, hi in parts for p in range(lo, hi + 1)]
        bases = bases if parts[0][1] == "+" else bases[::-1]
        for b in range(bins):
            want[g, b] = 0.0
        for k, (c, s, p) in enumerate(bases):
            for label, c2, s2, lo, hi in points:
                if c2 == c and (ignore or s2 == s) and p == (lo if s2 == "+" else hi):
                    want[g, bins * k // len(bases)] += float(label) if op == "value" else 1.0
    got = sc.signal_matrix({"x": spark.createDataFrame(points, ROW)}, spark.createDataFrame(regions, REGION), bins, op, ignore_strand=ignore)
    assert "a_start" not in plan(got)
    assert {(r.ref, r.bin): r.value for r in got.collect()} == want


def test_pairs_of_territories_are_not_moved(spark):
    test = spark.createDataFrame([("in", "c", "+", 100, 120), ("in", "c", "+", 100, 120), ("far", "c", "+", 90_000, 90_010), ("none", None, "+", 1, 2)], ROW)
    ref = spark.createDataFrame([("g", "c", "+", 90, 400), ("h", "c", "-", 1, 60)], ROW)
    df = ov.annotate_territory(test, ref, 50, 50, 10)
    want = [("far", "NA", None, None, "intergenic"), ("in", "g", 10, 30, "proximal"), ("in", "g", 10, 30, "proximal"), ("in", "h", -60, -40, "upstream"), ("in", "h", -60, -40, "upstream"), ("none", "NA", None, None, "intergenic")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    joins = [k for k, line in enumerate(lines) if "Join" in line]
    assert not any("Aggregate" in line or "Join" in line for line in lines[: joins[0]]) and "a_start" in lines[joins[0]]


def test_genes_are_not_looked_up_where_none_are_asked_for(spark):
    peaks = spark.createDataFrame([(f"p{k}", "c", "+", 100 * k + 1, 100 * k + 50) for k in range(6)], ROW)
    reads = spark.createDataFrame([(f"{k}", "c", "+", 20 * k + 1, 20 * k + 9) for k in range(30)], ROW)
    df = pl.differential_peaks(peaks, {"x": reads}, {"y": reads.where("start < 300")}, peaks)
    assert {"row", "genes"} <= set(df.columns) and {r.row: r.genes for r in df.collect()}["p0"] == "p0,p1,p2,p3,p4,p5"
    assert "a_start" not in plan(df.select("row", "fold", "change"))
