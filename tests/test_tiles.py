"""Windows by tiles against plain loops over sorted rows, with tiles of every size."""

import random

import pytest
from pyspark.sql import functions as F

from lociframe.operators import sets as st
from lociframe.operators import tiles


@pytest.mark.parametrize("tile", [1, 7, 50, 1 << 20])
def test_across(spark, tile):
    rng = random.Random(tile)
    rows = [(rng.choice("ab"), rng.choice([None, "+"]), rng.randrange(-20, 300), rng.randrange(400), k) for k in range(120)] + [("c", "+", 5, 9, 200)]
    df = spark.createDataFrame(rows, "chrom string, strand string, start long, stop long, label long").repartition(4)
    x = F.col("stop")
    got = tiles.across(df, ["chrom", "strand"], ["start", "stop", "label"], tile, a=("lag", x), b=("lead", x), c=("max_before", x), d=("min_after", x), e=("sum", F.lit(1)), f=("sum", x))
    want = {}
    for key in {r[:2] for r in rows}:
        own = sorted((r for r in rows if r[:2] == key), key=lambda r: r[2:])
        stops = [r[3] for r in own]
        for k, r in enumerate(own):
            want[r] = (stops[k - 1] if k else None, stops[k + 1] if k + 1 < len(own) else None, max(stops[:k], default=None), min(stops[k + 1 :], default=None), k + 1, sum(stops[: k + 1]))
    assert {tuple(r)[:5]: tuple(r)[5:] for r in got.collect()} == want
    assert tiles.across(df.limit(0), ["chrom"], ["start"], a=("lag", x)).collect() == []


@pytest.mark.parametrize("tile", [10, 1 << 20])
def test_sets_across_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(tiles, "TILE", tile)
    monkeypatch.setattr(st, "across", lambda *a, **k: tiles.across(*a, tile, **k))
    rng = random.Random(3)
    rows = []
    for k in range(80):
        at = rng.randrange(1, 500)
        rows.append((f"r{k:02d}", rng.choice("ab"), rng.choice("+-"), at, at + rng.randrange(0, 60)))
    df = spark.createDataFrame(rows, "label string, chrom string, strand string, start long, stop long")
    kept = set()
    for key in {r[1:3] for r in rows}:
        end = 0
        for r in sorted((r for r in rows if r[1:3] == key), key=lambda r: (r[3], -r[4], r[0])):
            if r[3] > end:
                kept.add(r[0])
                end = r[4]
    assert {r.label for r in st.leaders(df).collect()} == kept
    n = st.test_sorted(df).collect()[0]
    inside = meets = 0
    for key in {r[1:3] for r in rows}:
        own = sorted((r for r in rows if r[1:3] == key), key=lambda r: (r[3], r[4], r[0]))
        for a, b in zip(own, own[1:]):
            inside += b[3] >= a[3] and b[4] <= a[4]
            meets += b[3] <= a[4]
    assert (n.n, n.inclusions, n.overlaps) == (80, inside, meets)
    chains = st.link(df, 3, label=",").collect()
    assert sorted(x for r in chains for x in r.label.split(",")) == sorted(r[0] for r in rows)
    assert {(r.chrom, r.strand, r.start, r.stop) for r in chains} == {(r.chrom, r.strand, r.start, r.stop) for r in st.link(df, 3).collect()}
