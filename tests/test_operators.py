"""Properties and edge cases of the interval operators; the registered queries are compared with SQL in test_queries.py."""

import random

import pytest
from pyspark.sql import functions as F

from lociframe.operators import contact as ct
from lociframe.operators import overlap as ov
from lociframe.operators import regions as rg
from lociframe.operators import scan as sc
from lociframe.operators import sets as st
from lociframe.operators import tables as tb
from lociframe.sources import formats as fm

ROW = "label string, chrom string, strand string, start bigint, stop bigint"


def rows(n, seed, span=5000, longest=400):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        s = rng.randint(1, span)
        out.append((f"r{k}", f"c{rng.randint(1, 2)}", rng.choice("+-"), s, s + rng.choice([0, 1, 5, longest, longest * 40])))
    return out


def brute(a, b, ignore=False):
    return sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and (ignore or x[2] == y[2]) and x[3] <= y[4] and x[4] >= y[3])


@pytest.mark.parametrize("span,longest", [(5000, 400), (3_000_000, 400), (3_000_000, 30_000)])
def test_binned_join_is_the_theta_join(spark, span, longest):
    a, b = rows(80, 1, span, longest), rows(60, 2, span, longest)
    for ignore in (False, True):
        got = ov.overlap_join(spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW), ignore).select("a_label", "b_label").collect()
        assert sorted(map(tuple, got)) == brute(a, b, ignore)


def test_few_pairs_meet_that_do_not_overlap(spark):
    rng = random.Random(3)
    reads = [(f"r{k}", "c", "+", s, s + 49) for k in range(4000) for s in [rng.randint(1, 20_000_000)]]
    features = [(f"f{k}", "c", "+", s, s + n) for k in range(300) for s, n in [(rng.randint(1, 20_000_000), rng.choice([200, 3000, 40_000, 1_000_000]))]]
    a, b, on = ov._sides(spark.createDataFrame(reads, ROW), spark.createDataFrame(features, ROW), False, False)
    keys = "a_chrom = b_chrom AND a_strand = b_strand AND a_own = b_other AND a_other = b_own AND a_bin = b_bin"
    assert keys.split(" AND ")[0] in on
    meet, hits = a.join(b, F.expr(keys)).count(), len(brute(reads, features))
    assert hits <= meet <= 10 * hits


def test_touching_and_single_bases(spark):
    a = spark.createDataFrame([("t", "c", "+", 10, 20)], ROW)
    b = spark.createDataFrame([("before", "c", "+", 1, 9), ("first", "c", "+", 1, 10), ("last", "c", "+", 20, 20), ("after", "c", "+", 21, 30), ("other", "c", "-", 10, 20)], ROW)
    assert sorted(r.b_label for r in ov.overlap_join(a, b).collect()) == ["first", "last"]
    assert {r.label: r.n for r in ov.count(a, b).collect()} == {"before": 0, "first": 1, "last": 1, "after": 0, "other": 0}
    assert ov.subset(a, b.limit(0)).count() == 0 and ov.subset(a, b.limit(0), invert=True).count() == 1


def test_link(spark):
    df = spark.createDataFrame([("1", "c", "+", 1, 10), ("2", "c", "+", 11, 12), ("3", "c", "+", 12, 30), ("4", "c", "+", 2_000_000, 2_000_010), ("5", "c", "+", 5, 2_000_000)], ROW)
    spans = lambda d: sorted((r.start, r.stop) for r in d.collect())
    assert spans(st.link(df)) == [(1, 2_000_010)]
    assert spans(st.link(df.where("label <> '5'"))) == [(1, 10), (11, 30), (2_000_000, 2_000_010)]
    assert spans(st.link(df.where("label <> '5'"), 1)) == [(1, 30), (2_000_000, 2_000_010)]
    once = st.link(spark.createDataFrame(rows(200, 3), ROW), 7)
    assert spans(st.link(once, 7)) == spans(once)


def test_inverse_of_the_inverse(spark):
    genome = spark.createDataFrame([("c1", 9_000_000), ("c2", 9_000_000)], "chrom string, size bigint")
    linked = st.link(spark.createDataFrame(rows(50, 4), ROW), 1)
    back = st.inverse(st.inverse(linked, genome), genome)
    key = lambda d: sorted((r.chrom, r.strand, r.start, r.stop) for r in d.collect())
    assert key(back) == key(linked)


def test_leaders(spark):
    df = rows(60, 5)
    kept = []
    for r in sorted(df, key=lambda r: (r[1], r[2], r[3], -r[4], r[0])):
        if not any(k[1:3] == r[1:3] and k[3] <= r[4] and k[4] >= r[3] for k in kept):
            kept.append(r)
    assert sorted(map(tuple, st.leaders(spark.createDataFrame(df, ROW)).collect())) == sorted(kept)


def test_formats_on_disk(spark, tmp_path):
    p = str(tmp_path)
    open(f"{p}/a.bed", "w").write("track name=x\nc1\t0\t10\tg\t5\t-\nc2\t4\t40\th\t0\t+\t4\t40\t0\t2\t5,6\t0,30\n")
    got = fm.read_regions(spark, f"{p}/a.bed")
    assert sorted((r.label, [(i.strand, i.start, i.stop) for i in r.intervals]) for r in got.collect()) == [("g", [("-", 1, 10)]), ("h", [("+", 5, 9), ("+", 35, 40)])]
    open(f"{p}/a.reg", "w").write("x\tc1 + 1 5 c1 + 8 9\ny\tc1 - 1,7 3,9\n")
    assert fm.sniff_format(spark, f"{p}/a.reg") == "reg" and [len(r.intervals) for r in fm.read_regions(spark, f"{p}/a.reg").collect()] == [2, 2]
    open(f"{p}/a.fa", "w").write(">c1 note\nACGT\nACG\n>c2\nTT\n")
    assert sorted((r.chrom, r.chunk, r.seq) for r in fm.read_chromosomes(spark, f"{p}/a.fa", 4).collect()) == [("c1", 0, "ACGT"), ("c1", 1, "ACG"), ("c2", 0, "TT")]
    open(f"{p}/g.bed", "w").write("c1\t0\t10\nc2\t0\t7\n")
    assert sorted(map(tuple, fm.read_bounds(spark, f"{p}/g.bed").collect())) == [("c1", 10), ("c2", 7)]
    open(f"{p}/bad.bed", "w").write("c1\t0\t10\nc1\t0\t7\n")
    with pytest.raises(Exception, match="different sizes"):
        fm.read_bounds(spark, f"{p}/bad.bed").collect()
    assert [r.value for r in fm.read_lines(spark, f"{p}/a.reg", skip=1).collect()] == ["y\tc1 - 1,7 3,9"]


def test_regions_of_hand(spark):
    df = spark.createDataFrame([("a", [("c", "+", 1, 10), ("c", "+", 10, 20), ("c", "+", 21, 30)])], f"label string, intervals array<{rg.iv.INTERVAL}>")
    ends = lambda d: [(i.start, i.stop) for r in d.collect() for i in r.intervals]
    assert ends(rg.union(df)) == [(1, 20), (21, 30)]
    assert ends(rg.gaps(df)) == [] and ends(rg.connect(df)) == [(1, 30)] and ends(rg.intersection(df)) == []
    assert ends(rg.center(df)) == [(5, 6), (15, 15), (25, 26)]
    assert ends(rg.divide(df)) == [(1, 5), (6, 10), (10, 14), (15, 20), (21, 25), (26, 30)]
    assert ends(rg.position(df, "c")) == [(6, 6), (15, 15), (26, 26)]


def test_tails():
    import math

    for k, mean in ((0, 0.5), (3, 2.0), (30, 20.0), (5, 20.0), (200, 100.0)):
        want = 1 - sum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(k + 1))
        assert abs(sc.poisson_tail([k], [mean])[0] - want) < 1e-11
    for k, n, p in ((0, 5, 0.5), (3, 10, 0.2), (10, 10, 0.3), (-1, 10, 0.3), (40, 60, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1, n + 1))
        assert abs(sc.binomial_tail([k], [n], [p])[0] - want) < 1e-11


def test_total_variation_by_its_conditions():
    import numpy as np

    rng = np.random.default_rng(1)
    for lam in (0.0, 0.3, 2.0, 50.0):
        y = rng.normal(size=40) * 3
        x = ct.total_variation(y, lam)
        dual = np.cumsum(y - x)  # within lam, and at it where x steps
        assert np.abs(dual).max() <= lam + 1e-9 and abs(dual[-1]) < 1e-9
        for k in range(39):
            if abs(x[k + 1] - x[k]) > 1e-9:
                assert abs(dual[k] + np.sign(x[k + 1] - x[k]) * lam) < 1e-6


def test_index_and_resampling(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert sorted((r.k, r["index"]) for r in tb.with_index(df, ["k"]).collect()) == [(i, i) for i in range(1000)]
    assert tb.resample(df, ["k"], 77, 1).count() == 77


def test_streaming_forms(spark, tmp_path):
    from lociframe.streaming import regions as sr

    path = str(tmp_path / "in")
    spark.createDataFrame(rows(30, 6), ROW).write.parquet(path)
    ref = spark.createDataFrame(rows(20, 7), ROW)
    stream = spark.readStream.schema(ROW).parquet(path)
    for name, df in (("bins", sr.bin_counts(stream, 1000)), ("hits", sr.overlap_counts(stream, ref))):
        df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("bins").groupBy().sum("n").first()[0] == 30
    assert spark.table("hits").groupBy().sum("n").first()[0] == len(brute(rows(30, 6), rows(20, 7)))
