"""Domains from diamond means: gaps, change points of each stretch, rank-sum tests, and the domains between what is left.

Cells are as in ``contact``: (chrom, i, j, x), i <= j, not negative. A chromosome's bins may be one task's: their number is
the genome's by the bin size, whatever the reads. Cells never are: they are added up, or dealt to tiles of bins.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.operators.contact import diamond_means, grid
from lociframe.sources.scratch import keep

#: Bins of a tile, whose cells one task tests; at least three windows wide.
TILE = 256
#: A stretch between gaps has so many bins at least.
LEAST_BINS = 4


def gaps(cells: DataFrame, sizes_: DataFrame) -> DataFrame:
    """(chrom, i, gap boolean) of every bin: whether it is in a block of two bins or more without a contact among them.

    Blocks are made from the left: each goes on until a contact would be in it, and the next begins there.
    """
    firsts = cells.where("x > 0").groupBy("chrom", "i").agg(F.min("j").alias("first"))
    rows = grid(sizes_).join(firsts, ["chrom", "i"], "left")

    def walk(pdf):
        pdf = pdf.sort_values("i").reset_index(drop=True)
        n = len(pdf)
        ends = np.minimum.accumulate(pdf["first"].fillna(n).to_numpy()[::-1])[::-1].astype(int)  # no contact within bins k..ends[k] - 1
        gap = np.zeros(n, bool)
        k = 0
        while k < n - 1:
            end = max(k + 1, ends[k])
            gap[k:end] = end - k > 1
            k = end
        return pdf[["chrom", "i"]].assign(gap=gap)

    return rows.select("chrom", "i", "first").groupBy("chrom").applyInPandas(walk, "chrom string, i bigint, gap boolean")


def stretches(gapped: DataFrame, least: int = LEAST_BINS) -> DataFrame:
    """(chrom, i, low, high) of the bins in gap-free stretches of ``least`` bins and more: the stretch's first and last bin."""
    free = gapped.where("NOT gap")
    run = free.withColumn("run", F.col("i") - F.row_number().over(Window.partitionBy("chrom").orderBy("i")))
    own = run.groupBy("chrom", "run").agg(F.min("i").alias("low"), F.max("i").alias("high")).where(F.col("high") - F.col("low") + 1 >= least)
    return run.join(own, ["chrom", "run"]).select("chrom", "i", "low", "high")


def change_points(y: np.ndarray) -> list[int]:
    """The bends of a line over 0, 1, 2, ...: its two ends, and wherever going further would lose more to what is left out than the chord gains.

    From a bend on, the chord to each later point is as good as its length less the distances of the points it
    passes; the last point before this falls is the next bend.
    """
    n, at, out = len(y), 0, [0]
    while at < n - 1:
        best, end = math.hypot(1.0, y[at + 1] - y[at]), at + 1
        while end < n - 1:
            end += 1
            dx, dy = float(end - at), y[end] - y[at]
            chord, k = math.hypot(dx, dy), np.arange(1, end - at)
            value = chord - np.abs(dy * k - dx * (y[at + 1 : end] - y[at])).sum() / chord
            if value < best:
                end -= 1
                out.append(end)
                break
            best = value
        at = end
    return [*out, n - 1]


def local_extremes(y: np.ndarray) -> np.ndarray:
    """-1 at the local minima of a stretch, 1 at its maxima, 0 elsewhere: bends that are ones, and the lowest and highest points between bends.

    Steps are scaled to a mean of 1 first; a stretch without any step has none. After the last bend but one nothing is looked for.
    """
    found = np.zeros(len(y), int)
    step = np.abs(np.diff(y)).mean()
    if not step > 0:
        return found
    y = y[0] + (y - y[0]) / step
    bends = change_points(y)
    for before, at in zip(bends, bends[1:-1]):
        if y[at] >= y[at - 1] and y[at] >= y[at + 1]:
            found[at] = 1
        elif y[at] < y[at - 1] and y[at] < y[at + 1]:
            found[at] = -1
        part = y[before : at + 1]
        if part.min() < min(y[before], y[at]):
            found[before + part.argmin()] = -1
        if part.max() > max(y[before], y[at]):
            found[before + part.argmax()] = 1
    return found


def extremes(signal: DataFrame) -> DataFrame:
    """(chrom, i, low, high, x, extreme) of rows (chrom, i, low, high, x); each stretch is a group."""

    def find(pdf):
        pdf = pdf.sort_values("i")
        return pdf.assign(extreme=local_extremes(pdf["x"].to_numpy(float)).astype("int32"))

    return signal.select("chrom", "i", "low", "high", "x").groupBy("chrom", "low").applyInPandas(find, "chrom string, i bigint, low bigint, high bigint, x double, extreme int")


def distance_scales(cells: DataFrame, sizes_: DataFrame, most: int) -> DataFrame:
    """(chrom, d, mean, sd) of the cells at each distance from 1 to ``most``, absent ones counted; sd is null for fewer than two cells."""
    d = sizes_.withColumn("d", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(most).cast("long"), F.greatest(F.col("n") - 1, F.lit(1))))))
    sums = cells.where((F.col("j") - F.col("i")).between(1, most)).groupBy("chrom", (F.col("j") - F.col("i")).alias("d")).agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    m, s, q = F.col("n") - F.col("d"), F.coalesce("s", F.lit(0.0)), F.coalesce("q", F.lit(0.0))
    sd = F.when(m > 1, F.sqrt(F.greatest(F.lit(0.0), (q - s * s / m) / (m - 1))))
    return d.join(sums, ["chrom", "d"], "left").where(m > 0).select("chrom", "d", (s / m).alias("mean"), sd.alias("sd"))


def standardised(cells: DataFrame, sizes_: DataFrame, most: int) -> DataFrame:
    """(chrom, i, j, x) for all cells at distances from 1 to ``most``, absent ones too, less their distance's mean, by its deviation; null where that is 0."""
    scale = distance_scales(cells, sizes_, most)
    rows = scale.join(F.broadcast(sizes_), "chrom").select("chrom", "d", "mean", "sd", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - F.col("d") - 1)).alias("i"))
    rows = rows.withColumn("j", F.col("i") + F.col("d")).join(cells.select("chrom", "i", "j", "x"), ["chrom", "i", "j"], "left")
    return rows.select("chrom", "i", "j", ((F.coalesce("x", F.lit(0.0)) - F.col("mean")) / F.nullif("sd", F.lit(0.0))).alias("x"))


def rank_sum(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(z, p) that a's values are lower than b's: normal approximation with correction for ties and continuity; (nan, 1) where there is none."""
    a, b = a[np.isfinite(a)], b[np.isfinite(b)]
    n, m = len(a), len(b)
    if not n or not m:
        return math.nan, 1.0
    _, place, k = np.unique(np.concatenate((a, b)), return_inverse=True, return_counts=True)
    rank = (np.cumsum(k) - (k - 1) / 2)[place]
    total = n + m
    variance = n * m / 12 * (total + 1 - (k.astype(float) ** 3 - k).sum() / (total * (total - 1)))
    if variance <= 0:
        return math.nan, 1.0
    z = (rank[:n].sum() - n * (n + 1) / 2 - n * m / 2 + 0.5) / math.sqrt(variance)
    return z, math.erfc(-z / math.sqrt(2)) / 2


def tests(cells: DataFrame, sizes_: DataFrame, bins: DataFrame, window: int) -> DataFrame:
    """(chrom, i, z, p) of bins (chrom, i, low, high): whether contacts across the bin's end are lower than those on either side of it.

    Across are the cells of up to ``window`` bins until i with as many after it; beside, those among the window + 1 bins until i, and
    among the window bins after it; all within the stretch low..high and standardised by distance. The last bin of a stretch has p 1.
    Tiles of bins are tasks, with the cells around them; absent cells are filled in there.
    """
    tile = max(TILE, 3 * window)
    scale = distance_scales(cells, sizes_, 2 * window)
    zero = scale.groupBy("chrom").agg(F.sort_array(F.collect_list(F.struct("d", (-F.col("mean") / F.nullif("sd", F.lit(0.0))).alias("z")))).alias("zero"))
    z = cells.withColumn("d", F.col("j") - F.col("i")).join(F.broadcast(scale), ["chrom", "d"]).select("chrom", "i", "d", ((F.col("x") - F.col("mean")) / F.nullif("sd", F.lit(0.0))).alias("z"))
    seen = F.sequence(F.floor(F.greatest(F.lit(0), F.col("i") + F.col("d") - window) / tile), F.floor((F.col("i") + window) / tile))
    z = z.withColumn("tile", F.explode(seen))
    own = bins.join(F.broadcast(zero), "chrom", "left").select("chrom", F.floor(F.col("i") / tile).alias("tile"), "i", "low", "high", F.col("zero.z").alias("zero"))

    def test(bins_, near):
        if not len(bins_):
            return bins_[["chrom", "i"]].assign(z=0.0, p=1.0)
        base = int(bins_["tile"].iloc[0]) * tile - window
        values = bins_["zero"].iloc[0]
        zero_ = np.full(2 * window + 1, np.nan)
        if values is not None:
            zero_[1 : 1 + len(values)] = [np.nan if v is None else v for v in values]
        band = np.tile(zero_, (tile + 2 * window + 2, 1))
        rows = near["i"].to_numpy(int) - base
        inside = (rows >= 0) & (rows < len(band))
        band[rows[inside], near["d"].to_numpy(int)[inside]] = near["z"].to_numpy(float)[inside]
        out = []
        for at, low, high in zip(bins_["i"], bins_["low"], bins_["high"]):
            if at == high:
                out.append((math.nan, 1.0))
                continue
            left, right = np.arange(max(low, at - window), at + 1), np.arange(at + 1, min(high, at + window) + 1)
            pick = lambda i, j: band[i - base, j - i]
            i, j = np.meshgrid(left[left > at - window], right, indexing="ij")
            across = pick(i, j)[j - i <= 2 * window]
            beside = []
            for side in (left, right):
                a, b = np.triu_indices(len(side), 1)
                beside.append(pick(side[a], side[b]))
            out.append(rank_sum(across, np.concatenate(beside)))
        return bins_[["chrom", "i"]].assign(z=[o[0] for o in out], p=[o[1] for o in out])

    found = own.groupBy("chrom", "tile").cogroup(z.groupBy("chrom", "tile")).applyInPandas(test, "chrom string, i bigint, z double, p double")
    return found.withColumn("z", F.nanvl("z", F.lit(None).cast("double")))


def domain_signal(cells: DataFrame, sizes_: DataFrame, window: int, cut: float | None = 0.05) -> DataFrame:
    """(chrom, i, x, extreme, p) of every bin: diamond mean, and -1 at boundaries, 1 at maxima, 0 at other bins, null in gaps and short stretches.

    Minima whose test has no p under ``cut`` are no boundaries; without a cut nothing is tested and p is 1.
    """
    bins = keep(stretches(gaps(cells, sizes_)), "stretches")
    signal = keep(extremes(bins.join(diamond_means(cells, sizes_, window), ["chrom", "i"])), "extremes")
    if cut is None:
        rows = signal.select("chrom", "i", "x", "extreme", F.lit(1.0).alias("p"))
    else:
        rows = signal.join(tests(cells, sizes_, bins, window).select("chrom", "i", "p"), ["chrom", "i"])
        rows = rows.select("chrom", "i", "x", F.when((F.col("extreme") == -1) & (F.col("p") >= cut), 0).otherwise(F.col("extreme")).alias("extreme"), "p")
    rows = grid(sizes_).select("chrom", "i").join(rows, ["chrom", "i"], "left")
    return rows.withColumn("p", F.coalesce("p", F.lit(1.0)))


def domains(signal: DataFrame, bin_size: int, cut: float = 0.05) -> DataFrame:
    """(chrom, start, stop, tag, p) of each chromosome's parts, end to end, start counted from 0 and stop not included.

    Parts are runs of bins that are gaps, or are neither gaps nor boundaries; a boundary's bin goes with the part before it. p is the
    largest of the part's bins; a domain all of whose bins are under ``cut`` is tagged boundary, others domain or gap. A last run of a
    kind that is one bin goes with the part before it, too.
    """
    kind = F.when(F.col("extreme").isNull(), "gap").when(F.col("extreme") == -1, "end").otherwise("domain")
    w = Window.partitionBy("chrom").orderBy("i")
    rows = signal.select("chrom", "i", "p", kind.alias("kind"))
    own = Window.partitionBy("chrom", "kind")
    new = (F.col("kind") != "end") & (F.lag("kind").over(w).isNull() | (F.lag("kind").over(w) != F.col("kind")))
    last = F.col("i") == F.max("i").over(own)
    rows = rows.withColumns({"new": new & ~(last & (F.col("i") > 0))})
    rows = rows.withColumn("part", F.sum(F.col("new").cast("int")).over(w)).where("part > 0")
    parts = rows.groupBy("chrom", "part").agg(F.min("i").alias("low"), F.max("i").alias("high"), F.max("p").alias("p"), F.min_by("kind", "i").alias("kind"))
    tag = F.when((F.col("kind") == "domain") & (F.col("p") < cut), "boundary").otherwise(F.col("kind"))
    return parts.select("chrom", (F.col("low") * bin_size).alias("start"), ((F.col("high") + 1) * bin_size).alias("stop"), tag.alias("tag"), "p")


def extrema(signal: DataFrame, sizes_: DataFrame, tolerance: float) -> DataFrame:
    """(chrom, i, boundary int) of every bin of a signal (chrom, i, x): the first and last bin, and those where a rise ends and falls next.

    Values under a chromosome's mean count as its least value, bins the signal lacks as 0; steps of under ``tolerance`` of the largest
    absolute value are level, and a level step between a rise and a fall makes none.
    """
    rows = grid(sizes_).join(signal.select("chrom", "i", "x"), ["chrom", "i"], "left").na.fill(0.0, ["x"])
    whole = rows.groupBy("chrom").agg(F.avg("x").alias("mean"), F.min("x").alias("least"))
    rows = rows.join(F.broadcast(whole), "chrom").withColumn("x", F.when(F.col("x") < F.col("mean"), F.col("least")).otherwise(F.col("x")))
    most = rows.groupBy("chrom").agg(F.max(F.abs("x")).alias("most"))
    w = Window.partitionBy("chrom").orderBy("i")
    step = (F.col("x") - F.lag("x").over(w)) / F.nullif("most", F.lit(0.0))
    rows = rows.join(F.broadcast(most), "chrom").select("chrom", "i", "n", F.when(F.abs(step) >= tolerance, F.signum(step)).otherwise(0.0).alias("e"))
    top = (F.coalesce("e", F.lit(0.0)) == 1) & (F.lead("e").over(w) == -1)
    return rows.select("chrom", "i", ((F.col("i") == 0) | (F.col("i") == F.col("n") - 1) | F.coalesce(top, F.lit(False))).cast("int").alias("boundary"))


def between(boundaries: DataFrame) -> DataFrame:
    """(chrom, low, high) of successive boundaries (chrom, i, boundary)."""
    next_ = F.lead("i").over(Window.partitionBy("chrom").orderBy("i"))
    return boundaries.where("boundary = 1").select("chrom", F.col("i").alias("low"), next_.alias("high")).where("high IS NOT NULL")


def mark_domains(cells: DataFrame, boundaries: DataFrame, top: int) -> DataFrame:
    """(chrom, low, high, score) of the ``top`` domains of each chromosome: from a boundary to the next, both included, by the sum of all cells among them.

    Ties go to the first. ``marked`` gives their cells.
    """
    own = between(boundaries)
    bins = own.select("chrom", "low", F.explode(F.sequence("low", "high")).alias("i"))
    both = cells.join(bins, ["chrom", "i"]).join(bins.select("chrom", F.col("low").alias("other"), F.col("i").alias("j")), ["chrom", "j"]).where("low = other")
    sums = both.groupBy("chrom", "low").agg(F.sum(F.when(F.col("i") == F.col("j"), F.col("x")).otherwise(2 * F.col("x"))).alias("score"))
    scored = own.join(sums, ["chrom", "low"], "left").na.fill(0.0, ["score"])
    place = F.row_number().over(Window.partitionBy("chrom").orderBy(F.desc("score"), "low"))
    return scored.withColumn("place", place).where(F.col("place") <= top).select("chrom", "low", "high", "score")


def marked(domains_: DataFrame) -> DataFrame:
    """(chrom, i, j, x) with x 1 for the cells i <= j of domains (chrom, low, high), once each."""
    rows = domains_.select("chrom", "high", F.explode(F.sequence("low", "high")).alias("i"))
    return rows.select("chrom", "i", F.explode(F.sequence("i", "high")).alias("j")).distinct().withColumn("x", F.lit(1.0))


def count_domains(boundaries: DataFrame, least: int) -> DataFrame:
    """(chrom, n): successive boundaries with at least ``least`` bins from one to the other, both included."""
    return between(boundaries).groupBy("chrom").agg(F.count(F.when(F.col("high") - F.col("low") + 1 >= least, 1)).alias("n"))
