"""Contact matrices as sparse cells (chrom, i, j, x), i <= j, each matrix symmetric; absent cells are zero.

``sizes`` has (chrom, n), the number of bins of each matrix. Means count absent cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.sources.scratch import keep


def sizes(genome: DataFrame, bin_size: int) -> DataFrame:
    return genome.select("chrom", F.ceil(F.col("size") / bin_size).cast("long").alias("n"))


def correlation(a: str, b: str) -> Column:
    """Pearson's correlation of two columns, as an aggregate; null where one of them is constant."""
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))


def full(cells: DataFrame) -> DataFrame:
    """Both triangles."""
    return cells.union(cells.where("i <> j").select("chrom", F.col("j").alias("i"), F.col("i").alias("j"), *cells.columns[3:]))


def grid(sizes_: DataFrame) -> DataFrame:
    return sizes_.select("chrom", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))


def expected(cells: DataFrame, sizes_: DataFrame) -> DataFrame:
    """(chrom, d, expected): mean cell at each distance."""
    sums = cells.groupBy("chrom", (F.col("j") - F.col("i")).alias("d")).agg(F.sum("x").alias("s"))
    return sums.join(F.broadcast(sizes_), "chrom").select("chrom", "d", (F.col("s") / (F.col("n") - F.col("d"))).alias("expected"))


def _whole(cells: DataFrame, sizes_: DataFrame) -> DataFrame:
    """(chrom, n, mean, most) of each matrix, all n * n cells counted."""
    s = cells.groupBy("chrom").agg(F.sum(F.when(F.col("i") == F.col("j"), F.col("x")).otherwise(2 * F.col("x"))).alias("s"), F.max("x").alias("most"))
    return s.join(F.broadcast(sizes_), "chrom").select("chrom", "n", (F.col("s") / (F.col("n") * F.col("n"))).alias("mean"), "most")


def preprocess(cells: DataFrame, sizes_: DataFrame, method: str = "none", pseudo: float = 1.0, cut: float = 0.0) -> DataFrame:
    """Cells by one of none, max, mean, log2, log2mean, rank, dist, distlog2, zscore.

    Absent cells stay absent: after log2 and log2mean they stand for the value of zero, after zscore for
    that of zero at their distance. rank counts all n * n cells, zeros first, equal ones by their mean rank.
    """
    x = F.col("x")
    if method == "none":
        return cells
    if method == "log2":
        return cells.withColumn("x", F.log2(x + pseudo))
    if method in ("max", "mean", "log2mean"):
        rows = cells.join(F.broadcast(_whole(cells, sizes_)), "chrom")
        value = {"max": x / F.col("most"), "mean": x / F.col("mean"), "log2mean": F.log2(x / F.col("mean") + pseudo)}[method]
        return rows.select("chrom", "i", "j", value.alias("x"))
    if method in ("dist", "distlog2"):
        e = expected(cells, sizes_)
        ratio = F.when(x < cut, 0.0).otherwise(x) / F.col("expected")
        rows = cells.withColumn("d", F.col("j") - F.col("i")).join(e, ["chrom", "d"])
        return rows.select("chrom", "i", "j", (ratio if method == "dist" else F.log2(F.greatest(ratio, F.lit(1.0)))).alias("x"))
    if method == "zscore":
        d = cells.groupBy("chrom", (F.col("j") - F.col("i")).alias("d")).agg(F.sum("x").alias("s"), F.sum(x * x).alias("q")).join(F.broadcast(sizes_), "chrom")
        m = F.col("n") - F.col("d")
        mean = F.col("s") / m
        d = d.select("chrom", "d", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), (F.col("q") - m * mean * mean) / F.greatest(m - 1, F.lit(1)))).alias("sd"))
        rows = cells.withColumn("d", F.col("j") - F.col("i")).join(d, ["chrom", "d"])
        return rows.select("chrom", "i", "j", F.when(F.col("sd") > 0, (x - F.col("mean")) / F.col("sd")).otherwise(0.0).alias("x"))
    if method == "rank":
        both = full(cells).groupBy("chrom", "x").agg(F.count("*").alias("k")).where("x > 0")
        w = Window.partitionBy("chrom").orderBy("x")
        total = both.groupBy("chrom").agg(F.sum("k").alias("filled")).join(F.broadcast(sizes_), "chrom")
        both = both.withColumn("upto", F.sum("k").over(w)).join(F.broadcast(total), "chrom")
        rank = F.col("n") * F.col("n") - F.col("filled") + F.col("upto") - (F.col("k") - 1) / 2
        ranks = both.select("chrom", "x", (rank / (F.col("n") * F.col("n"))).alias("r"))
        return cells.join(ranks, ["chrom", "x"]).select("chrom", "i", "j", F.col("r").alias("x"))
    raise ValueError(f"unknown method {method!r}")


def normalise(cells: DataFrame, features: DataFrame, reads: float, min_length: float = 0.0, min_mappability: float = 0.0) -> DataFrame:
    """Counts by effective lengths and millions of reads; null where a product of lengths or mappabilities is too small.

    features has (chrom, bin, length, mappability).
    """
    f = lambda k: features.select("chrom", F.col("bin").alias(k), F.col("length").alias(f"l{k}"), F.col("mappability").alias(f"m{k}"))
    rows = cells.join(f("i"), ["chrom", "i"]).join(f("j"), ["chrom", "j"])
    length, mapped = F.col("li") * F.col("lj"), F.col("mi") * F.col("mj")
    value = F.when((length >= min_length**2) & (mapped >= min_mappability**2), F.col("x") / (length / 1e6) / (reads / 1e9))
    return rows.select("chrom", "i", "j", value.alias("x"))


def impute(rows: DataFrame) -> DataFrame:
    """Null x of dense rows (chrom, i, j, x) by the line between the nearest known cells of the row; beyond the last, towards 0 outside."""
    w = Window.partitionBy("chrom", "i").orderBy("j")
    known = F.when(F.col("x").isNotNull(), F.struct("j", "x"))
    before = F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(known, True).over(w.rowsBetween(1, Window.unboundedFollowing))
    edge = F.max("j").over(Window.partitionBy("chrom", "i"))
    j0, x0 = F.coalesce(before.j, F.lit(-1)), F.coalesce(before.x, F.lit(0.0))
    j1, x1 = F.coalesce(after.j, edge + 1), F.coalesce(after.x, F.lit(0.0))
    line = x0 + (x1 - x0) * (F.col("j") - j0) / (j1 - j0)
    return rows.withColumn("x", F.coalesce("x", line))


def impute_symmetric(rows: DataFrame) -> DataFrame:
    """Rows, then columns, imputed; the two made symmetric by their mean."""
    turn = lambda df: df.select("chrom", F.col("j").alias("i"), F.col("i").alias("j"), "x")
    a = impute(rows)
    b = turn(impute(turn(rows)))
    both = a.union(b).union(turn(a)).union(turn(b))
    return both.groupBy("chrom", "i", "j").agg(F.avg("x").alias("x"))


def rotate(cells: DataFrame) -> DataFrame:
    """Turned by 45 degrees: row (i + j) div 2, column j - i."""
    return cells.select("chrom", F.floor((F.col("i") + F.col("j")) / 2).alias("i"), (F.col("j") - F.col("i")).alias("j"), "x")


def rotate_back(cells: DataFrame) -> DataFrame:
    """The cells that rotate made the rows and columns of."""
    low = F.col("i") - F.floor(F.col("j") / 2)
    return cells.select("chrom", low.alias("i"), (low + F.col("j")).alias("j"), "x")


def band(cells: DataFrame) -> DataFrame:
    """Row i, column j - i."""
    return cells.select("chrom", "i", (F.col("j") - F.col("i")).alias("j"), "x")


def band_back(cells: DataFrame) -> DataFrame:
    return cells.select("chrom", "i", (F.col("j") + F.col("i")).alias("j"), "x")


def standardise(cells: DataFrame, sizes_: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each distance scaled to the mean ``s`` of wanted (d, s); distances it lacks go."""
    rows = cells.withColumn("d", F.col("j") - F.col("i")).join(expected(cells, sizes_), ["chrom", "d"]).join(F.broadcast(wanted), "d")
    return rows.select("chrom", "i", "j", (F.col("x") / F.col("expected") * F.col("s")).alias("x"))


def submatrix(cells: DataFrame, start: int, end: int) -> DataFrame:
    return cells.where((F.col("i") >= start) & (F.col("j") <= end)).select("chrom", (F.col("i") - start).alias("i"), (F.col("j") - start).alias("j"), "x")


def distance_stats(cells: DataFrame, sizes_: DataFrame) -> DataFrame:
    """(d, average): expected counts at each distance, averaged over chromosomes that have it."""
    e = expected(cells, sizes_)
    return e.groupBy("d").agg(F.sum("expected").alias("s")).join(sizes_.crossJoin(F.broadcast(e.select("d").distinct())).where("d < n").groupBy("d").agg(F.count("*").alias("k")), "d").select("d", (F.col("s") / F.col("k")).alias("average"))


def reads(cells: DataFrame) -> DataFrame:
    return cells.groupBy("chrom").agg(F.sum("x").alias("reads"))


def correlate(a: DataFrame, b: DataFrame, max_dist: int | None = None) -> DataFrame:
    """(chrom, r, n) over cells that either has, absent ones 0; up to a distance if given."""
    x, y = (m.select("chrom", "i", "j", F.col("x").alias(c)) for m, c in ((a, "a"), (b, "b")))
    both = x.join(y, ["chrom", "i", "j"], "full").na.fill(0.0, ["a", "b"])
    if max_dist is not None:
        both = both.where(F.col("j") - F.col("i") <= max_dist)
    return both.groupBy("chrom").agg(correlation("a", "b").alias("r"), F.count("*").alias("n"))


def compare_by_distance(a: DataFrame, b: DataFrame, distances: list[int]) -> DataFrame:
    """(chrom, dist, r): correlation of cells up to each distance; cells are dealt to the distances that hold them."""
    x, y = (m.select("chrom", "i", "j", F.col("x").alias(c)) for m, c in ((a, "a"), (b, "b")))
    both = x.join(y, ["chrom", "i", "j"], "full").na.fill(0.0, ["a", "b"])
    each = F.explode(F.filter(F.array(*map(F.lit, distances)), lambda t: F.col("j") - F.col("i") <= t)).alias("dist")
    return both.select("chrom", "a", "b", "i", "j", each).groupBy("chrom", "dist").agg(correlation("a", "b").alias("r"))


def overlap_curve(a: DataFrame, b: DataFrame, cutoffs: list[float]) -> DataFrame:
    """(cutoff, overlap): cells over the cutoff in both, by those over it in either."""
    x, y = (m.select("chrom", "i", "j", F.col("x").alias(c)) for m, c in ((a, "a"), (b, "b")))
    both = x.join(y, ["chrom", "i", "j"], "full").na.fill(0.0, ["a", "b"]).withColumn("cutoff", F.explode(F.array(*map(F.lit, cutoffs))))
    p, q = F.col("a") > F.col("cutoff"), F.col("b") > F.col("cutoff")
    return both.groupBy("cutoff").agg((F.sum((p & q).cast("int")) / F.nullif(F.sum((p | q).cast("int")), F.lit(0))).alias("overlap"))


def boundary_scores(cells: DataFrame, sizes_: DataFrame, distance: int, skip: int = 0) -> DataFrame:
    """(chrom, i, 11 scores) of every bin.

    The triangles left and right of the bin and the square over it are means of cells within distance;
    each cell is dealt to the bins that see it, 2 * distance at most.
    """
    i, j, x, b = (F.col(c) for c in ("i", "j", "x", "b"))
    d = distance
    near = cells.where((j - i <= d) & (x > 0)).withColumn("b", F.explode(F.sequence(j - d + 1, i + d - 1)))
    wide = j - i >= skip
    left, right = (b >= j) & (i >= b - d + 1) & wide, (b <= i) & (j <= b + d - 1) & wide
    over = (i >= b - d + 1) & (i <= b - 1) & (j >= b + 1) & (j <= b + d - 1)
    pick = lambda ok, name: F.sum(F.when(ok, x).otherwise(0.0)).alias(name)
    sums = near.groupBy("chrom", "b").agg(pick(left, "l"), pick(right, "r"), pick(left & (i == b - d + 1), "l1"), pick(right & (i == b), "r1"), pick(over, "o"))
    triangle, line, square = (d - skip) * (d - skip + 1) / 2, d - skip, max(1, (d - 1) ** 2)
    rows = grid(sizes_).join(sums.withColumnRenamed("b", "i"), ["chrom", "i"], "left")
    has_left, has_right = i - d + 1 >= 0, i + d - 1 < F.col("n")
    on = lambda ok, c, by: F.when(ok, F.coalesce(F.col(c), F.lit(0.0)) / by).otherwise(0.0)
    rows = rows.select(
        "chrom", "i", on(has_left, "l", triangle).alias("intra_left"), on(has_right, "r", triangle).alias("intra_right"),
        on(has_left, "l1", line).alias("l1"), on(has_right, "r1", line).alias("r1"), on(has_left & has_right, "o", square / 2).alias("inter"),
    )
    d1 = F.col("r1") - F.col("l1")
    rows = rows.select(
        "*", F.greatest("intra_left", "intra_right").alias("intra_max"), F.least("intra_left", "intra_right").alias("intra_min"),
        (F.col("intra_right") - F.col("intra_left")).alias("diff"), F.when(d1 == 0, 0.0).otherwise(d1 * F.abs(d1) / (F.col("l1") + F.col("r1"))).alias("di"),
    )
    whole = rows.groupBy("chrom").agg(F.avg("inter").alias("pseudo"), F.max("inter").alias("most"), F.max("intra_max").alias("m1"), F.max("intra_min").alias("m2"))
    rows = rows.join(F.broadcast(whole), "chrom")
    safe = lambda a, c: F.coalesce(a / F.nullif(c, F.lit(0.0)), F.lit(0.0))
    share = 1 - safe(F.col("inter"), F.col("most"))
    rows = rows.select("*", safe(F.col("intra_max"), F.col("inter") + F.col("pseudo")).alias("ratio"), safe(F.col("diff"), F.col("inter") + F.col("pseudo")).alias("diffratio"), (safe(F.col("intra_max"), F.col("m1")) * share).alias("p1"), (safe(F.col("intra_min"), F.col("m2")) * share).alias("p2"))
    tops = rows.groupBy("chrom").agg(F.max("p1").alias("t1"), F.max("p2").alias("t2"))
    rows = rows.join(F.broadcast(tops), "chrom")
    return rows.select("chrom", "i", "intra_left", "intra_right", "intra_max", "intra_min", "inter", "diff", "di", "ratio", "diffratio", safe(F.col("p1"), F.col("t1")).alias("product_max"), safe(F.col("p2"), F.col("t2")).alias("product_min"))


def local_maxima_scores(scores: DataFrame, column: str, reach: int) -> DataFrame:
    """(chrom, i, score, lmax): how far the score falls on the side where it falls less, within reach bins."""
    w = Window.partitionBy("chrom").orderBy("i")
    x = F.col(column)
    low = F.greatest(F.min(x).over(w.rowsBetween(-reach, 0)), F.min(x).over(w.rowsBetween(0, reach)))
    return scores.select("chrom", "i", x.alias("score"), (x - low).alias("lmax"))


def local_maxima(scores: DataFrame, column: str, reach: int, least: float) -> DataFrame:
    """(chrom, i, boundary): greedily the highest bins, each taking the slopes to the lowest bins within reach at its sides.

    A chromosome's bins are walked in order of score, so they are a group; their number does not grow
    with the reads.
    """

    def walk(pdf):
        pdf = pdf.sort_values("i").reset_index(drop=True)
        x = pdf["score"].to_numpy(float)
        y = np.zeros(len(x), int)
        for k in np.lexsort((np.arange(len(x)), -x)):
            if y[k] or np.isnan(x[k]):
                continue
            a = max(0, k - reach)
            low = a + int(np.nanargmin(x[a : k + 1]))
            high = k + int(np.nanargmin(x[k : k + reach + 1]))
            span = y[low : high + 1]
            span[span == 0] = -1
            if x[k] >= least:
                y[k] = 1
        return pdf[["chrom", "i"]].assign(boundary=(y == 1).astype("int32"))

    return scores.select("chrom", "i", F.col(column).alias("score")).groupBy("chrom").applyInPandas(walk, "chrom string, i bigint, boundary int")


def domains(cells: DataFrame, sizes_: DataFrame, distance: int, reach: int, score: str = "ratio", least: float = 0.1) -> DataFrame:
    """(chrom, i, score, lmax, boundary): scores, their local maxima scaled by the 99 % quantile, and boundaries."""
    s = local_maxima_scores(boundary_scores(cells, sizes_, distance), score, reach)
    q = s.groupBy("chrom").agg(F.percentile("lmax", 0.99).alias("q"))
    s = s.join(F.broadcast(q), "chrom").select("chrom", "i", "score", F.coalesce(F.least(F.col("lmax") / F.nullif("q", F.lit(0.0)), F.lit(1.0)), F.lit(0.0)).alias("lmax"))
    s = keep(s, "scores")
    return s.join(local_maxima(s, "lmax", reach, least), ["chrom", "i"])


def domain_changes(a: DataFrame, b: DataFrame, flank: int, delta: float) -> DataFrame:
    """(chrom, i, change): -1 where only a has a boundary within flank bins and its score falls by delta, 1 for the converse."""
    rows = a.select("chrom", "i", F.col("lmax").alias("sa"), F.col("boundary").alias("ba")).join(b.select("chrom", "i", F.col("lmax").alias("sb"), F.col("boundary").alias("bb")), ["chrom", "i"])
    w = Window.partitionBy("chrom").orderBy("i").rowsBetween(-flank, flank)
    fa, fb, d = F.max("ba").over(w), F.max("bb").over(w), F.col("sb") - F.col("sa")
    rows = rows.select("chrom", "i", "ba", "bb", fa.alias("fa"), fb.alias("fb"), d.alias("d"))
    change = F.when((F.col("ba") == 1) & (F.col("fb") == 0) & (F.col("d") <= -delta), -1).when((F.col("bb") == 1) & (F.col("fa") == 0) & (F.col("d") >= delta), 1).otherwise(0)
    return rows.select("chrom", "i", change.alias("change"))


def domain_overlap(a: DataFrame, b: DataFrame, top: int) -> DataFrame:
    """One row: boundaries among the ``top`` of each, and those of a that b has exactly and within a bin."""
    best = lambda df, s: df.where("boundary = 1").orderBy(F.desc("lmax"), "chrom", "i").limit(top).select("chrom", "i", F.lit(1).alias(s))
    x, y = best(a, "in_a"), best(b, "in_b")
    wide = y.select("chrom", F.explode(F.array(F.col("i") - 1, F.col("i"), F.col("i") + 1)).alias("i")).distinct()
    exact = x.join(y, ["chrom", "i"], "left_semi").agg(F.count("*").alias("exact"))
    near = x.join(wide, ["chrom", "i"], "left_semi").agg(F.count("*").alias("near"))
    return x.agg(F.count("*").alias("n_a")).join(y.agg(F.count("*").alias("n_b"))).join(exact).join(near)


def loops(samples: dict[str, tuple[DataFrame, float]], sizes_: DataFrame, bin_size: int, cutoff: float, least: float, min_dist: int) -> DataFrame:
    """(chrom, i, j, distance, and for each sample count, scaled, norm) of cells over both cutoffs in some sample.

    norm is observed by expected at the distance; scaled is by billions of reads and squared kilobases of a bin.
    """
    rows, ok = None, F.lit(False)
    for name, (cells, n) in samples.items():
        a = 1.0 if n <= 0 else n / 1e9 * (bin_size / 1000) ** 2
        norm = preprocess(cells, sizes_, "dist").withColumnRenamed("x", f"{name}_norm")
        one = cells.select("chrom", "i", "j", F.col("x").alias(f"{name}_count"), (F.col("x") / a).alias(f"{name}_scaled")).join(norm, ["chrom", "i", "j"])
        rows = one if rows is None else rows.join(one, ["chrom", "i", "j"], "full")
        ok = ok | ((F.col(f"{name}_norm") >= cutoff) & (F.col(f"{name}_scaled") >= least))
    rows = rows.na.fill(0.0)
    return rows.where(ok).withColumn("distance", (F.col("j") - F.col("i")) * bin_size).where(F.col("distance") >= min_dist)


def loop_changes(a: tuple[DataFrame, float], b: tuple[DataFrame, float], sizes_: DataFrame, bin_size: int, cutoff: float, least: float, min_dist: int) -> DataFrame:
    """loops of two samples with log2 folds of scaled (plus half of least) and normalised values (plus a half), and the difference of z-scores."""
    rows = loops({"a": a, "b": b}, sizes_, bin_size, cutoff, least, min_dist)
    for m, (cells, _) in (("a", a), ("b", b)):
        rows = rows.join(preprocess(cells, sizes_, "zscore").withColumnRenamed("x", f"{m}_z"), ["chrom", "i", "j"], "left")
    p = least / 2
    return rows.select("chrom", "i", "j", "distance", F.log2((F.col("b_scaled") + p) / (F.col("a_scaled") + p)).alias("fold_scaled"), F.log2((F.col("b_norm") + 0.5) / (F.col("a_norm") + 0.5)).alias("fold_norm"), (F.coalesce("b_z", F.lit(0.0)) - F.coalesce("a_z", F.lit(0.0))).alias("diff_zscore"))


def connectivity_difference(cells: DataFrame, sizes_: DataFrame, d: int) -> DataFrame:
    """(chrom, i, x): contacts with the d bins after against those with the d bins before, without the ends of the matrix."""
    near = cells.where((F.col("j") > F.col("i")) & (F.col("j") - F.col("i") <= d))
    side = near.select("chrom", "i", F.col("x").alias("v")).union(near.select("chrom", F.col("j").alias("i"), (-F.col("x")).alias("v")))
    sums = side.groupBy("chrom", "i").agg(F.abs(F.sum("v")).alias("x"))
    rows = grid(sizes_).join(sums, ["chrom", "i"], "left")
    return rows.select("chrom", "i", F.when((F.col("i") >= d) & (F.col("i") < F.col("n") - d), F.coalesce("x", F.lit(0.0))).otherwise(0.0).alias("x"))


def diamond_means(cells: DataFrame, sizes_: DataFrame, window: int) -> DataFrame:
    """(chrom, i, x): mean contact of up to ``window`` bins until i with as many after it, cut at the matrix's ends; 0 at the last bin."""
    c = cells.where((F.col("j") > F.col("i")) & (F.col("j") - F.col("i") <= 2 * window - 1)).withColumn("b", F.explode(F.sequence(F.greatest(F.col("i"), F.col("j") - window), F.least(F.col("j") - 1, F.col("i") + window - 1))))
    sums = c.groupBy("chrom", F.col("b").alias("i")).agg(F.sum("x").alias("s"))
    rows = grid(sizes_).join(sums, ["chrom", "i"], "left")
    area = F.least(F.lit(window).cast("long"), F.col("i") + 1) * F.least(F.lit(window).cast("long"), F.col("n") - 1 - F.col("i"))
    return rows.select("chrom", "i", F.when(area > 0, F.coalesce("s", F.lit(0.0)) / area).otherwise(0.0).alias("x"))


def insulation(cells: DataFrame, sizes_: DataFrame, window: int, radius: int) -> DataFrame:
    """(chrom, i, x, border): contacts across i within window bins, 10000 if none; border where it is the least within radius."""
    c = cells.where((F.col("j") - F.col("i") <= window) & (F.col("j") > F.col("i"))).withColumn("b", F.explode(F.sequence(F.col("i") + 1, F.col("j"))))
    sums = c.groupBy("chrom", F.col("b").alias("i")).agg(F.sum("x").alias("s"))
    rows = grid(sizes_).join(sums, ["chrom", "i"], "left").select("chrom", "i", F.coalesce("s", F.lit(10000.0)).alias("x"))
    w = Window.partitionBy("chrom").orderBy("i")
    a, b = F.min("x").over(w.rowsBetween(-radius, -1)), F.min("x").over(w.rowsBetween(1, radius))
    return rows.select("chrom", "i", "x", ((F.col("x") < a) & (F.col("x") < b)).cast("int").alias("border")).na.fill(0, ["border"])


def penalty_ratio(fitted: DataFrame, observed: DataFrame, gamma: float, lam: float) -> DataFrame:
    """(chrom, ratio): the fused penalty of dense rows (chrom, i, j, x) by their squared distance from the observed ones."""
    a, b = Window.partitionBy("chrom", "i").orderBy("j"), Window.partitionBy("chrom", "j").orderBy("i")
    rows = fitted.select("chrom", "i", "j", "x", F.abs(F.col("x") - F.lag("x").over(a)).alias("da"), F.abs(F.col("x") - F.lag("x").over(b)).alias("db"))
    rows = rows.join(observed.withColumnRenamed("x", "y"), ["chrom", "i", "j"])
    g = rows.groupBy("chrom").agg(F.sum(F.abs("x")).alias("l1"), F.sum(F.coalesce("da", F.lit(0.0)) + F.coalesce("db", F.lit(0.0))).alias("tv"), F.sum((F.col("x") - F.col("y")) ** 2).alias("loss"))
    return g.select("chrom", ((gamma * F.col("l1") + lam * F.col("tv")) / F.nullif(F.col("loss"), F.lit(0.0))).alias("ratio"))


def total_variation(y: np.ndarray, lam: float) -> np.ndarray:
    """The minimiser of sum (x - y)^2 / 2 + lam * sum |x[k + 1] - x[k]|: the taut string through a tube of width 2 lam around y's sums."""
    n = len(y)
    sums = np.concatenate(([0.0], np.cumsum(y)))
    low, high = sums - lam, sums + lam
    low[0] = high[0] = 0.0
    low[n] = high[n] = sums[n]
    path = np.zeros(n + 1)
    at, value = 0, 0.0
    while at < n:
        top, bottom, top_at, bottom_at = np.inf, -np.inf, at, at
        k = at + 1
        while k <= n:
            up, down = (high[k] - value) / (k - at), (low[k] - value) / (k - at)
            if up < bottom:  # the string bends at the lower wall
                k_new, level = bottom_at, low[bottom_at]
                break
            if down > top:
                k_new, level = top_at, high[top_at]
                break
            if up <= top:
                top, top_at = up, k
            if down >= bottom:
                bottom, bottom_at = down, k
            k += 1
        else:
            k_new, level = n, sums[n]
            # the end is a point, so both walls agree there
        path[at : k_new + 1] = value + (level - value) * np.arange(k_new - at + 1) / (k_new - at)
        at, value = k_new, level
    return np.diff(path)


def estimate(cells: DataFrame, sizes_: DataFrame, lambdas: list[float]) -> DataFrame:
    """(chrom, lam, i, j, x): each row of each matrix smoothed by its total variation for each lambda; negative values are 0.

    A row of bins is a group: its length is the chromosome's number of bins.
    """
    rows = full(cells).join(F.broadcast(sizes_), "chrom").withColumn("lam", F.explode(F.array(*map(F.lit, lambdas))))

    def solve(pdf):
        n = int(pdf["n"].iloc[0])
        y = np.zeros(n)
        y[pdf["j"].to_numpy(int)] = pdf["x"].to_numpy(float)
        x = np.maximum(total_variation(y, float(pdf["lam"].iloc[0])), 0)
        one = pdf.iloc[[0] * n][["chrom", "lam", "i"]].reset_index(drop=True)
        return one.assign(j=np.arange(n), x=x)

    return rows.groupBy("chrom", "lam", "i").applyInPandas(solve, "chrom string, lam double, i bigint, j bigint, x double")


def solution(path: DataFrame, lam: float) -> DataFrame:
    return path.where(F.col("lam") == lam).drop("lam")


def balance(cells: DataFrame, rounds: int = 10, low: float = 0.0) -> DataFrame:
    """Cells divided until all rows have about one sum; rows with a mean under ``low`` go first. The rounds' rows are kept."""
    sums = full(cells).groupBy("chrom", "i").agg(F.avg("x").alias("m"))
    good = sums.where(F.col("m") > low).select("chrom", "i")
    now = cells.join(good, ["chrom", "i"], "left_semi").join(good.withColumnRenamed("i", "j"), ["chrom", "j"], "left_semi").select("chrom", "i", "j", F.col("x").cast("double").alias("x"))
    for _ in range(rounds):
        s = full(now).groupBy("chrom", "i").agg(F.sum("x").alias("s"))
        m = s.groupBy("chrom").agg(F.avg("s").alias("m"))
        f = s.join(F.broadcast(m), "chrom").select("chrom", "i", (F.col("s") / F.col("m")).alias("f"))
        now = now.join(f, ["chrom", "i"]).join(f.select("chrom", F.col("i").alias("j"), F.col("f").alias("g")), ["chrom", "j"])
        now = keep(now.select("chrom", "i", "j", (F.col("x") / F.nullif(F.col("f") * F.col("g"), F.lit(0.0))).alias("x")), "balance")
    return now


def poisson_normalise(cells: DataFrame, features: DataFrame) -> DataFrame:
    """Counts by what a Poisson regression on products of length and GC, with the log of mappability as offset, expects.

    features has (chrom, bin, length, gc, mappability), all positive.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    f = lambda k: features.select("chrom", F.col("bin").alias(k), *[F.ln(c).alias(f"{c}_{k}") for c in ("length", "gc", "mappability")])
    rows = cells.where("i < j").join(f("i"), ["chrom", "i"]).join(f("j"), ["chrom", "j"])
    rows = rows.select("chrom", "i", "j", "x", (F.col("length_i") + F.col("length_j")).alias("l"), (F.col("gc_i") + F.col("gc_j")).alias("g"), (F.col("mappability_i") + F.col("mappability_j")).alias("o"))
    rows = VectorAssembler(inputCols=["l", "g"], outputCol="v").transform(rows)
    model = GeneralizedLinearRegression(family="poisson", link="log", featuresCol="v", labelCol="x", offsetCol="o", maxIter=25).fit(rows)
    return model.transform(rows).select("chrom", "i", "j", (F.col("x") / F.col("prediction")).alias("x"))


def quadrants(cells: DataFrame, split_i: int, split_j: int) -> DataFrame:
    """(chrom, ratio): mean contact of two facing quadrants around a point by that of the other two."""
    a, b = F.col("i") < split_i, F.col("j") < split_j
    one = lambda ok: F.avg(F.when(ok, F.col("x")))
    return cells.groupBy("chrom").agg((one(a & ~b) / F.nullif(one(~a & ~b), F.lit(0.0))).alias("ratio"))


def long_format(cells: DataFrame, bin_size: int) -> DataFrame:
    """(chrom, start1, start2, x) for tools that read melted matrices."""
    return full(cells).select("chrom", (F.col("i") * bin_size).alias("start1"), (F.col("j") * bin_size).alias("start2"), "x")


