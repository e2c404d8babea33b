"""Sliding-window scans over points: micro-bins of the step's width, summed into windows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.functions import interval as iv
from lociframe.operators.overlap import running_sums, subset


def windows_of(df: DataFrame, genome: DataFrame, size: int, step: int) -> DataFrame:
    """A row for each window each point (chrom, strand, pos) is in; windows lie inside their chromosome."""
    if size % step:
        raise ValueError("a window's size must be a multiple of its step")
    n = size // step
    rows = df.withColumn("_m", F.floor((F.col("pos") - 1) / step)).join(F.broadcast(genome), "chrom")
    rows = rows.withColumn("w", F.explode(F.sequence(F.greatest(F.lit(0), F.col("_m") - (n - 1)), F.col("_m"))))
    rows = rows.where((F.col("w") >= 0) & (F.col("w") < F.floor(F.col("size") / step) - n + 1))
    own = [c for c in df.columns if c not in ("start", "stop")]
    return rows.select(*own, (F.col("w") * step + 1).alias("start"), (F.col("w") * step + size).alias("stop"))


def counts(df: DataFrame, genome: DataFrame, size: int = 500, step: int = 25, least: int = 10, op: str = "1", ignore_strand: bool = False, max_label_value: int = 1, ref: DataFrame | None = None) -> DataFrame:
    """Windows (chrom, strand, start, stop, n) with at least ``least`` rows of (label, chrom, strand, start, stop) in them by a reference point.

    Points are summed in micro-bins first, so what is dealt out to windows is a row for each bin, not for
    each point. With ``ref`` only windows that overlap one of its rows are given. Windows without a row
    are not: ``least`` is 1 at least.
    """
    point = iv.coordinate(F.struct("chrom", "strand", "start", "stop"), op)
    strand = F.lit("+") if ignore_strand else F.col("strand")
    bins = df.select("chrom", strand.alias("strand"), (F.floor((point - 1) / step) * step + 1).alias("pos"), iv.weight(F.col("label"), max_label_value).alias("v"))
    bins = bins.groupBy("chrom", "strand", "pos").agg(F.sum("v").alias("v"))
    out = windows_of(bins, genome, size, step).groupBy("chrom", "strand", "start", "stop").agg(F.sum("v").alias("n")).where(F.col("n") >= max(1, least))
    return out if ref is None else subset(out, ref, ignore_strand)


def covered(df: DataFrame, genome: DataFrame, size: int = 500, step: int = 25, least: int = 1) -> DataFrame:
    """Windows with ``n``, the bases that rows cover in them, counted for each row."""
    rows = df.withColumn("m", F.explode(F.sequence(F.floor((F.col("start") - 1) / step), F.floor((F.col("stop") - 1) / step))))
    low = F.col("m") * step + 1
    bases = F.least(F.col("stop"), low + step - 1) - F.greatest(F.col("start"), low) + 1
    bins = rows.groupBy("chrom", "strand", low.alias("pos")).agg(F.sum(bases).alias("v"))
    return windows_of(bins, genome, size, step).groupBy("chrom", "strand", "start", "stop").agg(F.sum("v").cast("long").alias("n")).where(F.col("n") >= least)


def genome_size(genome: DataFrame) -> DataFrame:
    return genome.agg(F.sum("size").alias("size"))


def library_size(df: DataFrame, max_label_value: int = 1) -> DataFrame:
    return df.agg(F.sum(iv.weight(F.col("label"), max_label_value)).alias("n"))


def _log_gamma(x):
    """ln gamma of positive numbers, by Stirling's series from 16 on."""
    x = np.asarray(x, float)

    shift = np.zeros_like(x)
    for _ in range(16):
        low = x < 16
        shift = np.where(low, shift + np.log(np.where(low, x, 1)), shift)
        x = np.where(low, x + 1, x)

    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) - shift


def _sum_of_tail(first, ratio, least_terms: int = 20_000):
    """first * (1 + r1 + r1 r2 + ...), ratio(j) giving the j-th ratio of terms."""
    total = term = first
    for j in range(least_terms):
        term = term * ratio(j)
        total = total + term
        if not (term > total * 1e-16).any():
            break
    return total


def poisson_tail(k, mean):
    """P(X > k) of Poisson variables, as arrays."""
    k, mean = np.floor(np.asarray(k, float)), np.asarray(mean, float)
    with np.errstate(all="ignore"):
        at = np.maximum(k + 1, 0)
        first = np.exp(at * np.log(mean) - mean - _log_gamma(at + 1))
        up = _sum_of_tail(first, lambda j: mean / (at + 1 + j))
        # below the mean the other tail is the smaller
        at = np.maximum(k, 0)
        first = np.exp(at * np.log(mean) - mean - _log_gamma(at + 1))
        down = 1 - _sum_of_tail(first, lambda j: np.maximum(at - j, 0) / mean)
    out = np.where(k < 0, 1.0, np.where(k + 1 > mean, up, down))
    return np.clip(np.where(mean <= 0, (k < 0) * 1.0, out), 0, 1)


def binomial_tail(k, n, p):
    """P(X > k) of binomial variables, as arrays."""
    k, n, p = np.floor(np.asarray(k, float)), np.asarray(n, float), np.asarray(p, float)
    with np.errstate(all="ignore"):
        odds = p / (1 - p)

        def at(i):
            i = np.clip(i, 0, n)
            return np.exp(_log_gamma(n + 1) - _log_gamma(i + 1) - _log_gamma(n - i + 1) + i * np.log(p) + (n - i) * np.log1p(-p)), i

        first, i = at(k + 1)
        up = _sum_of_tail(first, lambda j: np.maximum(n - i - j, 0) / (i + j + 1) * odds)
        first, i = at(k)
        down = 1 - _sum_of_tail(first, lambda j: np.maximum(i - j, 0) / np.maximum(n - i + j + 1, 1) / odds)
    out = np.where(k < 0, 1.0, np.where(k >= n, 0.0, np.where(k + 1 > n * p, up, down)))
    return np.clip(np.where(p <= 0, (k < 0) * 1.0, np.where(p >= 1, (k < n) * 1.0, out)), 0, 1)


def normal_tail(z):
    """P(X > z) of standard normal variables: the complementary error function by its continued fraction and series."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in np.asarray(z, float)])


def tail(method: str, k: Column, n: Column, p: Column) -> Column:
    """P(X > k) as a column, Arrow batches at a time: binomial of n draws of chance p, Poisson or normal of the same mean."""

    @F.pandas_udf("double")
    def poisson(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series(poisson_tail(k.to_numpy(float), n.to_numpy(float) * p.to_numpy(float)))

    @F.pandas_udf("double")
    def binomial(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series(binomial_tail(k.to_numpy(float), n.to_numpy(float), p.to_numpy(float)))

    @F.pandas_udf("double")
    def normal(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        k, n, p = (x.to_numpy(float) for x in (k, n, p))
        sd = np.sqrt(np.maximum(n * p * (1 - p), 1e-300))
        return pd.Series(normal_tail((k - n * p) / sd))

    f = {"poisson": poisson, "binomial": binomial, "normal": normal}[method]
    return f(k.cast("double"), n.cast("double"), p.cast("double"))


def peaks(signal: DataFrame, genome: DataFrame, control: DataFrame | None = None, size: int = 500, step: int = 25, least: int = 10, method: str = "poisson", cutoff: float = 1e-5) -> DataFrame:
    """Windows with their count ``v1``, the expected or control count ``v2`` and ``pvalue`` at most cutoff.

    Without a control the chance of a read in a window is its share of the genome; with one, the chance that a
    read of either is of the signal is the share of the signal's library. v1 and v2 count no more than
    the window's bases.
    """
    s = counts(signal, genome, size, step, least, ignore_strand=True)
    reads = library_size(signal)
    if control is None:
        whole = genome_size(genome)
        rows = s.join(F.broadcast(reads.withColumnRenamed("n", "total"))).join(F.broadcast(whole))
        rows = rows.select("chrom", "start", "stop", F.least("n", F.lit(size)).alias("v1"), (F.lit(float(size)) * F.col("total") / F.col("size")).alias("v2"))
        p = tail(method, F.col("v1") - 1, F.lit(size), F.least(F.col("v2") / size, F.lit(1.0)))
    else:
        c = counts(control, genome, size, step, 1, ignore_strand=True).select("chrom", "start", F.least("n", F.lit(size)).cast("double").alias("v2"))
        both = reads.select(F.col("n").alias("a")).join(F.broadcast(library_size(control).select(F.col("n").alias("b"))))
        rows = s.join(c, ["chrom", "start"], "left").join(F.broadcast(both))
        rows = rows.select("chrom", "start", "stop", F.least("n", F.lit(size)).alias("v1"), F.coalesce("v2", F.lit(0.0)).alias("v2"), (F.col("a") / (F.col("a") + F.col("b"))).alias("share"))
        p = tail(method, F.col("v1") - 1, F.col("v1") + F.col("v2"), F.col("share"))
    return rows.withColumn("pvalue", p).where(F.col("pvalue") <= cutoff).select("chrom", "start", "stop", "v1", "v2", "pvalue")


def q_cutoff(observed: DataFrame, random: DataFrame, cutoff: float, permutations: int = 1) -> DataFrame:
    """One row: the largest observed p-value whose false discovery rate is at most cutoff, null without one.

    Both have a column p. The rate at a p-value is the random p-values up to it, by permutations, by the
    observed ones up to it, and no larger than at any larger one. Equal values are first counted, so the
    windows go over distinct values; ranges of values are numbered first and only these sums are ordered
    in one place.
    """
    both = observed.select("p", F.lit(1).alias("o"), F.lit(0).alias("r")).union(random.select("p", F.lit(0), F.lit(1)))
    both = both.groupBy("p").agg(F.sum("o").alias("o"), F.sum("r").alias("r")).withColumn("b", F.floor(F.log2(F.greatest("p", F.lit(1e-300))) * 64))
    blocks = both.groupBy("b").agg(F.sum("o").alias("bo"), F.sum("r").alias("br"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("b", F.coalesce(F.sum("bo").over(before), F.lit(0)).alias("bo"), F.coalesce(F.sum("br").over(before), F.lit(0)).alias("br"))
    w = Window.partitionBy("b").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.join(F.broadcast(blocks), "b").select("p", "o", (F.sum("o").over(w) + F.col("bo")).alias("n"), (F.sum("r").over(w) + F.col("br")).alias("m"))
    return rows.where("o > 0").where(F.col("m") / permutations / F.col("n") <= cutoff).agg(F.max("p").alias("p"))


def signal_matrix(signals: dict[str, DataFrame], ref: DataFrame, bins: int, op: str = "hits", rpkm: bool = False, ignore_strand: bool = False, profile: str | None = None) -> DataFrame:
    """(ref, signal, bin, value) of each reference region's bins, empty ones 0: signal rows by their 5' ends.

    ref has (label, intervals). A point's place is counted along the intervals without their gaps, from the
    region's 5' end. op: hits counts points, value sums the numbers that labels begin with. rpkm divides
    by kilobases of a bin and millions of the signal's rows. profile sum or mean gives (signal, bin, value).
    """
    names = list(signals)
    zero = F.lit(0).cast("long")
    rows = None
    for name, df in signals.items():
        point = iv.coordinate(F.struct("chrom", "strand", "start", "stop"), "5p")
        one = df.select(F.lit(name).alias("signal"), "chrom", "strand", point.cast("long").alias("pos"), (iv.number_of(F.col("label")) if op == "value" else F.lit(1)).cast("long").alias("a"), zero.alias("b"))
        rows = one if rows is None else rows.union(one)
    pieces = ref.select("label", F.posexplode(F.array_sort("intervals")).alias("k", "i"), F.array_sort("intervals").alias("all"))
    before = F.aggregate(F.slice("all", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda s, i: s + iv.size(i))
    pieces = pieces.select("label", "i.*", before.alias("before"), iv.region_size(F.col("all"), True).alias("total")).where("start <= stop")
    # a bin's points are the sum up to its last place less that up to its first, as the sum at the border of two bins adds to one and is taken from
    # the other: no point meets a region, for of deep signals and many regions such pairs are as many as the square of the rows
    back = F.col("strand") == "-"
    first = F.when(back, F.col("total") - 1 - F.col("before") - F.col("stop") + F.col("start")).otherwise(F.col("before"))
    pieces = pieces.select("*", first.alias("first"), (first + F.col("stop") - F.col("start")).alias("last"))
    low, high = (F.floor(bins * F.col(c) / F.col("total")).cast("int") for c in ("first", "last"))
    borders = pieces.select("*", low.alias("low"), high.alias("high"), F.explode(F.sequence(low - 1, high)).alias("j"))
    along = F.when(F.col("j") < F.col("low"), F.col("first") - 1).when(F.col("j") == F.col("high"), F.col("last")).otherwise(F.ceil((F.col("j") + 1) * F.col("total") / bins) - 1)
    pos = F.when(back, F.col("stop") - 1 - (along - F.col("first"))).otherwise(F.col("start") + along - F.col("first")).cast("long")
    keys = ["signal", "chrom"] if ignore_strand else ["signal", "chrom", "strand"]
    asked = borders.select(F.explode(F.array(*map(F.lit, names))).alias("signal"), "chrom", *["strand"] * (not ignore_strand), pos.alias("pos"), F.col("label").alias("ref"), "j", "low", "high", F.when(back, -1).otherwise(1).alias("sign"))
    share = lambda bin, sign: F.struct(bin.cast("int").alias("bin"), (sign * F.col("sign") * F.col("a")).alias("v"))
    hit = running_sums(rows.drop("strand") if ignore_strand else rows, asked, keys)
    hit = hit.select("ref", "signal", "low", "high", F.explode(F.array(share(F.col("j"), 1), share(F.col("j") + 1, -1))).alias("e")).where("e.bin BETWEEN low AND high")
    hit = hit.groupBy("ref", "signal", "e.bin").agg(F.sum("e.v").cast("double").alias("v"))
    grid = ref.select(F.col("label").alias("ref"), iv.region_size(F.col("intervals"), True).alias("total"))
    grid = grid.select("ref", "total", F.explode(F.array(*map(F.lit, names))).alias("signal")).select("ref", "total", "signal", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(hit, ["ref", "signal", "bin"], "left").withColumn("value", F.coalesce("v", F.lit(0.0)))
    if rpkm:
        sizes = rows.groupBy("signal").agg(F.count("*").alias("n"))
        out = out.join(F.broadcast(sizes), "signal", "left").withColumn("value", F.col("value") / (F.col("n") / 1e6) / (F.col("total") / bins / 1000))
    if profile:
        return out.groupBy("signal", "bin").agg((F.sum if profile == "sum" else F.avg)("value").alias("value"))
    return out.select("ref", "signal", "bin", "value")
