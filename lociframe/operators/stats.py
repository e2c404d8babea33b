"""Statistics of long tables (row, col, value): normalisation, folds, false discovery rates, components, clusters, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def quantile_normalise(df: DataFrame) -> DataFrame:
    """Each column's values replaced by the mean over columns of the values of their rank; equal values by row.

    Ranks are a window for each column; the means meet them by rank, a row each.
    """
    w = Window.partitionBy("col").orderBy("value", "row")
    ranked = df.withColumn("r", F.row_number().over(w))
    means = ranked.groupBy("r").agg(F.avg("value").alias("m"))
    return ranked.join(means, "r").select("row", "col", F.col("m").alias("value"))


def fold(x: Column, y: Column, method: str = "mean") -> Column:
    """Fold of arrays of replicates: mean(x) / mean(y), mean of paired ratios, or mean over all pairs."""
    add = lambda v: F.aggregate(v, F.lit(0.0), lambda s, a: s + a)
    mean = lambda v: add(v) / F.size(v)
    if method == "mean":
        return mean(x) / mean(y)
    if method == "paired":
        return mean(F.zip_with(x, y, lambda a, b: a / b))
    if method == "pairwise":
        return mean(F.flatten(F.transform(x, lambda a: F.transform(y, lambda b: a / b))))
    raise ValueError(f"unknown method {method!r}")


def fdr(observed: DataFrame, background: DataFrame) -> DataFrame:
    """(x, fdr) of observed scores (x): background scores at least as large by observed ones, each by their number, never rising with x.

    Scores are counted by value first. Windows over values are by blocks of the score's logarithm, whose
    sums alone are ordered in one place.
    """
    both = observed.select("x", F.lit(1).alias("o"), F.lit(0).alias("b")).union(background.select("x", F.lit(0), F.lit(1)))
    both = both.groupBy("x").agg(F.sum("o").alias("o"), F.sum("b").alias("b")).withColumn("k", F.floor(F.log2(F.greatest("x", F.lit(1e-300))) * 64))
    blocks = both.groupBy("k").agg(F.sum("o").alias("ko"), F.sum("b").alias("kb"))
    after = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("k", F.coalesce(F.sum("ko").over(after), F.lit(0)).alias("ko"), F.coalesce(F.sum("kb").over(after), F.lit(0)).alias("kb"))
    w = Window.partitionBy("k").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    rows = both.join(F.broadcast(blocks), "k").select("x", "o", "k", (F.sum("o").over(w) + F.col("ko")).alias("no"), (F.sum("b").over(w) + F.col("kb")).alias("nb"))
    total = rows.agg(F.max("no").alias("to"), F.max("nb").alias("tb"))
    rows = rows.join(F.broadcast(total)).where("no > 0").select("x", "o", "k", ((F.col("nb") / F.greatest("tb", F.lit(1))) / (F.col("no") / F.col("to"))).alias("f"))
    least = rows.groupBy("k").agg(F.min("f").alias("kf"))
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    least = least.select("k", F.coalesce(F.min("kf").over(before), F.lit(float("inf"))).alias("kf"))
    up = Window.partitionBy("k").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(least), "k").select("x", "o", F.least(F.min("f").over(up), F.col("kf"), F.lit(1.0)).alias("fdr")).where("o > 0").drop("o")


def fdr_cutoff(observed: DataFrame, background: DataFrame, cutoff: float) -> DataFrame:
    """One row: the smallest score whose rate is at most cutoff."""
    return fdr(observed, background).where(F.col("fdr") <= cutoff).agg(F.min("x").alias("x"))


def binned_fdr(observed: DataFrame, background: DataFrame, width: float, smooth: int = 2) -> DataFrame:
    """(bin, x, fdr) of scores (level, x): the rate within bins of the level's logarithm, each with ``smooth`` bins at either side."""
    b = F.floor(F.log2(F.greatest("level", F.lit(1e-300))) / width).cast("long")
    spread = lambda df: df.select("x", b.alias("own")).withColumn("bin", F.explode(F.sequence(F.col("own") - smooth, F.col("own") + smooth)))
    both = spread(observed).select("bin", "x", (F.col("bin") == F.col("own")).alias("here"), F.lit(1).alias("o"), F.lit(0).alias("g")).union(spread(background).select("bin", "x", F.lit(False), F.lit(0), F.lit(1)))
    both = both.groupBy("bin", "x").agg(F.sum("o").alias("o"), F.sum("g").alias("g"), F.sum(F.when(F.col("here"), F.col("o")).otherwise(0)).alias("own"))
    w = Window.partitionBy("bin").orderBy(F.desc("x"))
    all_ = Window.partitionBy("bin")
    rate = (F.sum("g").over(w) / F.greatest(F.sum("g").over(all_), F.lit(1))) / (F.sum("o").over(w) / F.sum("o").over(all_))
    rows = both.select("bin", "x", "own", F.sum("o").over(all_).alias("n"), rate.alias("f")).where("n > 0")
    up = Window.partitionBy("bin").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("fdr", F.least(F.min("f").over(up), F.lit(1.0))).where("own > 0").select("bin", "x", "fdr")


def differential(df: DataFrame, x: list[str], y: list[str], least: float = 1.0, min_fold: float = 2.0, max_fdr: float = 0.05) -> DataFrame:
    """Rows of (row, columns x and y) with their fold of y against x, its rate among folds between replicates, and gain or loss.

    Values are ``least`` at the least; the background are folds between replicates of one group.
    """
    up = lambda cs: F.array(*[F.greatest(F.col(c), F.lit(least)) for c in cs])
    rows = df.select("row", fold(up(y), up(x)).alias("fold")).withColumn("x", F.greatest("fold", 1 / F.col("fold")))
    inner = [F.greatest(F.greatest(F.col(a), F.lit(least)) / F.greatest(F.col(b), F.lit(least)), F.greatest(F.col(b), F.lit(least)) / F.greatest(F.col(a), F.lit(least))) for g in (x, y) for k, a in enumerate(g) for b in g[k + 1 :]]
    background = df.select(F.explode(F.array(*inner)).alias("x")) if inner else df.select(F.lit(1.0).alias("x")).limit(0)
    out = rows.join(fdr(rows.select("x"), background), "x")
    change = F.when((F.col("x") < min_fold) | (F.col("fdr") > max_fdr), "none").when(F.col("fold") > 1, "gain").otherwise("loss")
    return out.select("row", "fold", "fdr", change.alias("change"))


def nearest_distances(rows: DataFrame, q: int) -> dict[int, float]:
    """The q-th smallest ``d`` of each ``k`` of rows (k, d), for a few k: counts in ever finer parts of the distances, the last part by value.

    Only one row for each k comes to the driver in a round.
    """
    parts, fine = 4096, 100_000
    ends = {r["k"]: (0.0, r["most"], q, r["n"]) for r in rows.groupBy("k").agg(F.max("d").alias("most"), F.count("*").alias("n")).collect()}
    for _ in range(8):
        if all(n <= fine or hi <= lo for lo, hi, _, n in ends.values()):
            break
        known = rows.sparkSession.createDataFrame([(k, lo, hi, rest) for k, (lo, hi, rest, _) in ends.items()], "k int, lo double, hi double, rest bigint")
        own = rows.join(F.broadcast(known), "k").where((F.col("d") >= F.col("lo")) & (F.col("d") <= F.col("hi")))
        part = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(parts - 1), F.floor((F.col("d") - F.col("lo")) / (F.col("hi") - F.col("lo")) * parts))).otherwise(0)
        counts = own.groupBy("k", "rest", part.alias("part")).agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))
        counts = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("part"))).where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
        ends = {r["k"]: (r["lo"], r["hi"], r["rest"] - (r["upto"] - r["n"]), r["n"]) for r in counts.collect()}
    known = rows.sparkSession.createDataFrame([(k, lo, hi, rest) for k, (lo, hi, rest, _) in ends.items()], "k int, lo double, hi double, rest bigint")
    own = rows.join(F.broadcast(known), "k").where((F.col("d") >= F.col("lo")) & (F.col("d") <= F.col("hi"))).groupBy("k", "rest", "d").agg(F.count("*").alias("n"))
    own = own.withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("d"))).where("upto >= rest").groupBy("k").agg(F.min("d").alias("d"))
    return {r["k"]: r["d"] for r in own.collect()}


def local_lines(df: DataFrame, x: str, y: str, span: float = 0.5, points: int = 33) -> list[tuple[float, float, float]]:
    """(place, value, slope) of local regression at evenly spaced places from the least x to the greatest.

    At each place a line is fitted to the nearest ``span`` of all rows, weighted by the tricube of their distances by the farthest one's; where those
    have one x it is their mean, level. All rows count at every place, as sums made before the shuffle; rows with a null do not. No rows give no places.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    lo, hi, n = rows.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if not n:
        return []
    places = [lo + (hi - lo) * k / (points - 1) for k in range(points)] if hi > lo else [lo]
    near = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in enumerate(places)])).alias("p")
    rows = rows.select("x", "y", near).select(F.col("p.k").alias("k"), (F.col("x") - F.col("p.v")).alias("dx"), "y")
    widths = nearest_distances(rows.select("k", F.abs("dx").alias("d")), max(1, min(n, int(n * span + 1e-5))))
    h = F.element_at(F.array(*[F.lit(widths[k]) for k in range(len(places))]), F.col("k") + 1)
    d = F.abs("dx")
    w = F.when(h == 0, (d == 0).cast("double")).when(d < h, F.pow(1 - F.pow(d / F.nullif(h, F.lit(0.0)), F.lit(3)), F.lit(3))).otherwise(0.0)
    sums = rows.withColumn("w", w).where("w > 0").groupBy("k").agg(*[F.sum(c).alias(name) for name, c in (("s", F.col("w")), ("sx", F.expr("w * dx")), ("sxx", F.expr("w * dx * dx")), ("sy", F.expr("w * y")), ("sxy", F.expr("w * dx * y")))])
    found = {r["k"]: r for r in sums.collect()}
    out = []
    for k, v in enumerate(places):
        r = found.get(k)
        if r is None:  # only rows as far as the farthest one, whose weight is 0: they are alike
            r = rows.where((F.col("k") == k) & (d <= widths[k])).agg(F.count("*").alias("s"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sxx"), F.sum("y").alias("sy"), F.lit(0.0).alias("sxy")).first()
        spread = r["s"] * r["sxx"] - r["sx"] ** 2
        slope = (r["s"] * r["sxy"] - r["sx"] * r["sy"]) / spread if spread > 1e-9 * r["s"] * r["sxx"] else 0.0
        out.append((v, (r["sy"] - slope * r["sx"]) / r["s"], slope))
    return out


def along_lines(x: Column, lines: list[tuple[float, float, float]]) -> Column:
    """The curve through local_lines' places with their slopes: a cubic between every two of them."""
    if len(lines) < 2:
        return F.lit(lines[0][1] if lines else None).cast("double")
    lo, step = lines[0][0], (lines[-1][0] - lines[0][0]) / (len(lines) - 1)
    cell = F.greatest(F.lit(0), F.least(F.lit(len(lines) - 2), F.floor((x - lo) / step))).cast("int")
    at = lambda j, k: F.element_at(F.array(*[F.lit(line[j]) for line in lines]), cell + 1 + k)
    t = (x - at(0, 0)) / step
    return (2 * t * t * t - 3 * t * t + 1) * at(1, 0) + (t * t * t - 2 * t * t + t) * step * at(2, 0) + (3 * t * t - 2 * t * t * t) * at(1, 1) + (t * t * t - t * t) * step * at(2, 1)


def without_outliers(df: DataFrame, x: str, y: str, least_density: float, span: float = 0.5, scale: str = "none", points: int = 33) -> DataFrame:
    """Rows whose y differs from local regression on x by what has a normal density over ``least_density``, with all differences' mean and deviation.

    Values under the least positive one of both columns count as that; scale is none, or log2 of them. A density of 0 or less keeps all rows; rows with
    a null go, and if all differences are equal all others stay. Curve: ``along_lines`` of ``local_lines``.
    """
    if least_density <= 0:
        return df
    least = df.agg(F.least(F.min(F.when(F.col(x) > 0, F.col(x))), F.min(F.when(F.col(y) > 0, F.col(y))))).first()[0]
    value = {"none": lambda c: c, "log2": F.log2}[scale]
    raised = lambda c: value(F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(least))).cast("double"))
    rows = df.withColumns({"_x": raised(x), "_y": raised(y)}).where("_x IS NOT NULL AND _y IS NOT NULL")
    rows = rows.withColumn("_r", F.col("_y") - along_lines(F.col("_x"), local_lines(rows, "_x", "_y", span, points)))
    whole = rows.agg(F.avg("_r").alias("_m"), F.stddev_samp("_r").alias("_s"))
    z = (F.col("_r") - F.col("_m")) / F.nullif("_s", F.lit(0.0))
    density = F.exp(-z * z / 2) / (F.nullif("_s", F.lit(0.0)) * F.sqrt(2 * F.pi()))
    return rows.join(F.broadcast(whole)).where(F.coalesce(density > least_density, F.lit(True))).select(df.columns)


def principal_components(df: DataFrame, k: int) -> DataFrame:
    """(row, pc array) of vectors (row, v): scores on the first k components after centring, each component's largest loading positive."""
    import numpy as np
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.select("row", array_to_vector("v").alias("f"))
    rows = StandardScaler(inputCol="f", outputCol="c", withMean=True, withStd=False).fit(rows).transform(rows)
    model = PCA(k=k, inputCol="c", outputCol="p").fit(rows)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(0), np.arange(loadings.shape[1])])
    scores = F.transform(vector_to_array("p"), lambda x, i: x * F.element_at(F.array(*[F.lit(float(s)) for s in signs]), i + 1))
    return model.transform(rows).select("row", scores.alias("pc"))


def heat_rows(df: DataFrame, norm: str = "none", log: bool = True, least: float = 0.0, spread: float = 0.0, top: int | None = None) -> DataFrame:
    """(row, v) filtered and normalised for clustering: max, mean (of all), rowmax, rowmean or rowrange; then log2 of 1 more.

    Rows with a largest value under ``least`` or largest less smallest under ``spread`` go; ``top`` keeps those of the largest spread.
    """
    hi, lo = F.array_max("v"), F.array_min("v")
    mean = F.aggregate("v", F.lit(0.0), lambda s, x: s + x) / F.size("v")
    rows = df
    if norm in ("max", "mean"):
        whole = df.agg((F.max(hi) if norm == "max" else F.avg(mean)).alias("_w"))
        rows = df.join(F.broadcast(whole)).withColumn("v", F.transform("v", lambda x: x / F.col("_w"))).drop("_w")
    elif norm in ("rowmax", "rowmean"):
        by = hi if norm == "rowmax" else mean
        rows = df.withColumn("_w", by).withColumn("v", F.transform("v", lambda x: x / F.col("_w"))).drop("_w")
    elif norm == "rowrange":
        rows = df.withColumns({"_w": hi - lo, "_l": lo}).withColumn("v", F.transform("v", lambda x: (x - F.col("_l")) / F.col("_w"))).drop("_w", "_l")
    if log:
        rows = rows.withColumn("v", F.transform("v", lambda x: F.log2(x + 1)))
    rows = rows.where((F.array_max("v") >= least) & (F.array_max("v") - F.array_min("v") >= spread))
    return rows if top is None else rows.orderBy(F.desc(F.array_max("v") - F.array_min("v")), "row").limit(top)


def leaf_order(points: list[tuple[float, ...]]) -> list[int]:
    """Points in the order of a tree's leaves: of all clusters the two nearest are joined, by the farthest two of their points, until one is left.

    Of two that are joined, a single point stands left of a cluster, an earlier cluster left of a later one, and of two points the first. For a
    few points, such as the centres of clusters.
    """
    import math

    own = [(k,) for k in range(len(points))]
    age = [(0, k) for k in range(len(points))]
    step = 0
    while len(own) > 1:
        far = lambda a, b: max(math.dist(points[i], points[j]) for i in a for j in b)
        _, i, j = min((far(own[i], own[j]), i, j) for i in range(len(own)) for j in range(i + 1, len(own)))
        step += 1
        first, second = sorted((i, j), key=lambda k: age[k])
        joined = own[first] + own[second]
        own = [c for k, c in enumerate(own) if k not in (i, j)] + [joined]
        age = [c for k, c in enumerate(age) if k not in (i, j)] + [(1, step)]
    return list(own[0]) if own else []


def clusters(df: DataFrame, k: int, seed: int = 1, starts: int = 10) -> DataFrame:
    """(row, cluster) of vectors (row, v) by k-means, the best of several starts; clusters are numbered from 0 in the order of their centres' tree.

    The tree is ``leaf_order`` of the centres, which are sorted by their values first, so numbers depend on the clusters alone.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.select("row", array_to_vector("v").alias("features")).persist()
    models = [KMeans(k=k, seed=seed + j, maxIter=30).fit(rows) for j in range(starts)]
    model = min(models, key=lambda m: m.summary.trainingCost)
    rows.unpersist()
    centres = [tuple(map(float, c)) for c in model.clusterCenters()]
    sorted_ = sorted(range(len(centres)), key=lambda i: centres[i])
    order = [sorted_[i] for i in leaf_order([centres[i] for i in sorted_])]
    number = F.create_map(*[F.lit(x) for place, i in enumerate(order) for x in (i, place)])
    return model.transform(rows).select("row", number[F.col("prediction")].alias("cluster"))


def co_occurrence(df: DataFrame, sep: str = ",") -> DataFrame:
    """(mark1, mark2, n, enrichment) of pairs (marks1, marks2): observed by expected from either mark's share."""
    rows = df.select(F.explode(F.split("marks1", sep)).alias("mark1"), "marks2").select("mark1", F.explode(F.split("marks2", sep)).alias("mark2"))
    pairs = rows.groupBy("mark1", "mark2").agg(F.count("*").alias("n"))
    a = pairs.groupBy("mark1").agg(F.sum("n").alias("na"))
    b = pairs.groupBy("mark2").agg(F.sum("n").alias("nb"))
    total = pairs.agg(F.sum("n").alias("t"))
    return pairs.join(a, "mark1").join(b, "mark2").join(F.broadcast(total)).select("mark1", "mark2", "n", (F.col("n") * F.col("t") / (F.col("na") * F.col("nb"))).alias("enrichment"))


def summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(*by).agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("n"), F.stddev_samp(v).alias("sd"), (F.stddev_samp(v) / F.sqrt(F.count(v))).alias("se"))


def shares(df: DataFrame, by: str, value: str) -> DataFrame:
    """``percent`` of value within groups of ``by``, from their sums."""
    sums = df.groupBy(by).agg(F.sum(value).alias("_t"))
    return df.join(sums, by).withColumn("percent", 100.0 * F.col(value) / F.col("_t")).drop("_t")


def alignment_stats(df: DataFrame) -> DataFrame:
    """Percentages of (sample, total, aligned, unique): aligned, deduplicated, unaligned, duplicated."""
    p = lambda c: 100.0 * c / F.col("total")
    return df.select("sample", p(F.col("aligned")).alias("aligned"), p(F.col("unique")).alias("deduplicated"), p(F.col("total") - F.col("aligned")).alias("unaligned"), p(F.col("aligned") - F.col("unique")).alias("duplicated"))
