"""Matrices smoothed by total variation in two dimensions, in rounds over kept tables, and what their paths over lambda say.

Dense matrices are rows (chrom, lam, i, j, ...) of all n x n cells. A line of a matrix, a row or a column, is a group: its length is
the chromosome's number of bins. No task holds a matrix.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.operators.contact import correlation, full, grid, total_variation
from lociframe.sources.scratch import keep

STATE = "chrom string, lam double, i bigint, j bigint, y double, x double, p double, q double, u double, along double, across double"


def soft(x: np.ndarray, gamma: float) -> np.ndarray:
    """Values nearer to 0 by gamma, and 0 if they would pass it."""
    return np.sign(x) * np.maximum(np.abs(x) - gamma, 0.0)


def dense(cells: DataFrame, sizes_: DataFrame) -> DataFrame:
    """(chrom, i, j, x) of all n x n cells of symmetric matrices, absent ones 0."""
    rows = grid(sizes_).select("chrom", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("j"))
    return rows.join(full(cells).select("chrom", "i", "j", F.col("x").cast("double")), ["chrom", "i", "j"], "left").na.fill(0.0, ["x"])


def smooth(rows: DataFrame, lambdas: list[float], gamma: float = 0.0, tolerance: float = 1e-4, most_rounds: int = 500) -> DataFrame:
    """(chrom, lam, i, j, x) that minimises, for each matrix and lambda, half the sum of (x - y)^2, plus gamma times the sum of |x|, plus lam times that of |x - x'|
    over all neighbours in a row or column; y are dense rows (chrom, i, j, x).

    Rows and columns are smoothed in turn, each time with what the other took off given back (Dykstra's splitting), so that what is
    taken off stays a point of the dual problem. Rounds end when the gap between the two problems is under ``tolerance`` times half the sum of
    y^2 for all matrices, which bounds half the squared distance from the minimum; a matrix that is done stays as it is. A RuntimeError
    if ``most_rounds`` do not do. Sparsity comes last: soft thresholds of the minimum for gamma 0 are that for gamma.
    """
    zero = F.lit(0.0)
    start = rows.withColumn("lam", F.explode(F.array(*[F.lit(float(x)) for x in lambdas])))
    state = start.select("chrom", "lam", "i", "j", F.col("x").alias("y"), "x", zero.alias("p"), zero.alias("q"), zero.alias("u"), zero.alias("along"), zero.alias("across"))
    sums = rows.groupBy("chrom").agg((F.sum(F.col("x") * F.col("x")) / 2).alias("scale"))
    done: list[DataFrame] = []

    def row_step(pdf):
        pdf = pdf.sort_values("j")
        x, p = pdf["x"].to_numpy(float), pdf["p"].to_numpy(float)
        u = total_variation(x + p, float(pdf["lam"].iloc[0]))
        along = np.abs(np.diff(x, prepend=x[:1]))
        return pdf.assign(u=u, p=x + p - u, along=along)

    def column_step(pdf):
        pdf = pdf.sort_values("i")
        u, q = pdf["u"].to_numpy(float), pdf["q"].to_numpy(float)
        x = total_variation(u + q, float(pdf["lam"].iloc[0]))
        return pdf.assign(x=x, q=u + q - x, across=np.abs(np.diff(x, prepend=x[:1])))

    for k in range(most_rounds):
        state = keep(state.groupBy("chrom", "lam", "i").applyInPandas(row_step, STATE), "rows")
        if k:  # x is the last column step's, so x = y - p - q there: the duality gap is a plain sum
            gap = F.sum(F.col("x") * F.col("x") - F.col("x") * F.col("y") + F.col("lam") * (F.col("along") + F.col("across")))
            gaps = state.groupBy("chrom", "lam").agg(gap.alias("gap")).join(sums, "chrom")
            open_ = keep(gaps.where(F.col("gap") > tolerance * F.col("scale")).select("chrom", "lam"), "open")
            done.append(state.join(open_, ["chrom", "lam"], "left_anti"))
            if open_.isEmpty():
                break
            state = state.join(open_, ["chrom", "lam"], "left_semi")
        state = keep(state.groupBy("chrom", "lam", "j").applyInPandas(column_step, STATE), "columns")
    else:
        raise RuntimeError(f"the gap is not under {tolerance} after {most_rounds} rounds")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    x = F.col("x")
    return out.select("chrom", "lam", "i", "j", F.when(F.abs(x) <= gamma, 0.0).otherwise(x - F.signum(x) * gamma).alias("x"))


def alternate(rows: DataFrame, lam: float, gamma: float = 0.0, least_change: float = 1.0, most_rounds: int = 100) -> DataFrame:
    """(chrom, i, j, x, rounds int): dense rows (chrom, i, j, x), then their transposes, smoothed row by row, until the sum of all changes is under ``least_change``.

    A round transposes the matrix, smooths its rows by their total variation and takes soft thresholds; its change is that of each place of
    the matrix, before the transpose and after. A chromosome that is done, or after ``most_rounds``, stays as it is; rounds says how many it took.
    """

    def step(pdf):
        pdf = pdf.sort_values("i")
        x = soft(total_variation(pdf["x"].to_numpy(float), lam), gamma)
        return pdf[["chrom"]].assign(i=pdf["j"], j=pdf["i"], x=x)  # what was a column is a row

    now = rows.select("chrom", "i", "j", F.col("x").cast("double").alias("x"))
    done: list[DataFrame] = []
    for k in range(1, most_rounds + 1):
        new = keep(now.groupBy("chrom", "j").applyInPandas(step, "chrom string, i bigint, j bigint, x double"), "turned")
        changes = new.join(now.withColumnRenamed("x", "old"), ["chrom", "i", "j"]).groupBy("chrom").agg(F.sum(F.abs(F.col("x") - F.col("old"))).alias("e"))
        open_ = keep(changes.where(F.col("e") >= least_change).select("chrom"), "open")
        last = k == most_rounds or open_.isEmpty()
        done.append((new if last else new.join(F.broadcast(open_), "chrom", "left_anti")).withColumn("rounds", F.lit(k)))
        if last:
            break
        now = new.join(F.broadcast(open_), "chrom", "left_semi")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _parts(rows: DataFrame, tolerance: float) -> DataFrame:
    """(chrom, lam, df): connected parts of cells (chrom, lam, i, j, x) that differ by ``tolerance`` at most; eight neighbours count.

    Runs of a row are one node, and meet those of the next row; the smallest number of a node spreads along links, and by pointers to what it points
    to, until nothing changes.
    """
    w = Window.partitionBy("chrom", "lam", "i").orderBy("j")
    first = (F.col("j") != F.lag("j").over(w) + 1) | (F.abs(F.col("x") - F.lag("x").over(w)) > tolerance)
    rows = rows.select("chrom", "lam", "i", "j", "x", F.when(F.coalesce(first, F.lit(True)), F.col("j")).alias("from"))
    rows = rows.select("chrom", "lam", "i", "j", "x", F.xxhash64("chrom", "lam", "i", F.last("from", True).over(w)).alias("id"))
    rows = keep(rows, "runs")
    near = rows.withColumn("dj", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    near = near.select("chrom", "lam", (F.col("i") + 1).alias("i"), (F.col("j") + F.col("dj")).alias("j"), F.col("x").alias("y"), F.col("id").alias("other"))
    links = rows.join(near, ["chrom", "lam", "i", "j"]).where(F.abs(F.col("x") - F.col("y")) <= tolerance).select(F.col("id").alias("u"), F.col("other").alias("v")).distinct()
    links = keep(links, "links")
    links = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    state = keep(rows.select("chrom", "lam", "id", F.col("id").alias("root")).distinct(), "roots")
    while True:
        least = links.join(state.select(F.col("id").alias("v"), "root"), "v").groupBy(F.col("u").alias("id")).agg(F.min("root").alias("low"))
        new = state.join(least, "id", "left").select("chrom", "lam", "id", F.col("root").alias("old"), F.least("root", F.coalesce("low", "root")).alias("root"))
        hop = new.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = keep(new.join(hop, "root").select("chrom", "lam", "id", "old", F.col("next").alias("root")), "roots")
        if new.where("root <> old").isEmpty():
            return new.groupBy("chrom", "lam").agg(F.count_distinct("root").alias("df"))
        state = new.drop("old")


def degrees_of_freedom(cells: DataFrame, max_dist: int | None = None, tolerance: float = 0.0) -> DataFrame:
    """(chrom, lam, df): connected parts of positive cells (chrom, lam, i, j, x) that differ by ``tolerance`` at most; eight neighbours count.

    Cells further than max_dist from the diagonal, or under the tolerance, take no part; a matrix without parts has no row.
    """
    rows = cells.where((F.col("x") > 0) & (F.col("x") >= tolerance))
    if max_dist is not None:
        rows = rows.where(F.abs(F.col("i") - F.col("j")) <= max_dist)
    return _parts(rows, tolerance)


def plateaus(cells: DataFrame, tolerance: float) -> DataFrame:
    """(chrom, parts): connected parts of near-equal neighbouring cells (chrom, i, j, x), whatever their values; eight neighbours count."""
    return _parts(cells.withColumn("lam", F.lit(0.0)), tolerance).select("chrom", F.col("df").alias("parts"))


def path_correlations(a: DataFrame, b: DataFrame, distances: list[int], method: str = "pearson") -> DataFrame:
    """(chrom, lam, dist, r): correlation of two paths (chrom, lam, i, j, x) of dense cells whose distance is from one of 0 and ``distances`` to the next, ``dist``, both included.

    method is pearson; pearsonlog2, of logs, values of 0 and less counting as the least positive one of the path; or spearman, of mean ranks,
    which orders the distinct values of a band of one matrix in one task.
    """
    if method not in ("pearson", "pearsonlog2", "spearman"):
        raise ValueError(f"unknown method {method!r}")
    ends = sorted({0, *distances})
    bands = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in zip(ends, ends[1:])])
    d = F.col("j") - F.col("i")
    rows = a.where("j >= i").join(b.withColumnRenamed("x", "z"), ["chrom", "lam", "i", "j"])
    if method == "pearsonlog2":
        for c, side in (("x", a), ("z", b)):
            least = side.where("x > 0").groupBy("chrom").agg(F.min("x").alias("least"))
            rows = rows.join(F.broadcast(least), "chrom").withColumn(c, F.log2(F.when(F.col(c) > 0, F.col(c)).otherwise(F.col("least")))).drop("least")
    rows = rows.select("chrom", "lam", "x", "z", F.explode(F.filter(bands, lambda s: (d >= s.lo) & (d <= s.hi))).alias("band")).select("chrom", "lam", "x", "z", F.col("band.hi").alias("dist"))
    keys = ["chrom", "lam", "dist"]
    if method == "spearman":
        for c in ("x", "z"):
            k = rows.groupBy(*keys, c).agg(F.count("*").alias("k"))
            rank = F.sum("k").over(Window.partitionBy(*keys).orderBy(c)) - (F.col("k") - 1) / 2
            rows = rows.join(k.select(*keys, c, rank.alias("rank")), [*keys, c]).drop(c).withColumnRenamed("rank", c)
    return rows.groupBy(*keys).agg(correlation("x", "z").alias("r"))


def best_lambda(*freedoms: DataFrame) -> DataFrame:
    """(chrom, lam): the lambda after the largest drop of degrees of freedom (chrom, lam, df) from one lambda to the next, the first if equal; of several paths the least."""
    out = None
    for df in freedoms:
        w = Window.partitionBy("chrom").orderBy("lam")
        drop = df.select("chrom", "lam", (F.col("df") - F.lag("df").over(w)).alias("drop")).where("drop IS NOT NULL")
        best = drop.groupBy("chrom").agg(F.min_by("lam", F.struct("drop", "lam")).alias("lam"))
        out = best if out is None else out.union(best)
    return out.groupBy("chrom").agg(F.min("lam").alias("lam"))
