"""Composed queries: one lazy plan for each, where a shell would have a pipe of programs and files between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.operators import contact as ct
from lociframe.operators import overlap as ov
from lociframe.operators import pairs as pr
from lociframe.operators import scan as sc
from lociframe.operators import sets as st
from lociframe.operators import stats as sx
from lociframe.sources.scratch import keep


def boundary_regions(domains: DataFrame, flank: int, blacklist: DataFrame | None = None) -> DataFrame:
    """Both ends of each row, widened by flank, without those on the blacklist, linked."""
    end = lambda c: domains.select("label", "chrom", "strand", F.greatest(F.lit(1), F.col(c) - flank).alias("start"), (F.col(c) + flank).alias("stop"))
    both = end("start").union(end("stop"))
    if blacklist is not None:
        both = ov.subset(both, blacklist, True, invert=True)
    return st.link(both)


def compare_boundaries(a: DataFrame, b: DataFrame, flank: int, blacklist: DataFrame | None = None) -> DataFrame:
    """One row: stretches with a boundary of either, of both, and their ratio."""
    x, y = boundary_regions(a, flank, blacklist), boundary_regions(b, flank, blacklist)
    union = st.link(x.union(y))
    common = ov.subset(union, st.link(ov.intersect(x, y)))
    return union.agg(F.count("*").alias("total")).join(common.agg(F.count("*").alias("common"))).withColumn("overlap", F.col("common") / F.nullif("total", F.lit(0)))


def ignored_loci(genome: DataFrame, size: int, excluded: DataFrame) -> DataFrame:
    """Loci chrom:start-stop of the genome's tiles that overlap excluded regions."""
    t = pr.tiles(genome, size).select(F.col("fragment").alias("label"), "chrom", F.lit("+").alias("strand"), "start", "stop")
    return ov.subset(t, excluded, True).select(F.format_string("%s:%d-%d", "chrom", "start", "stop").alias("locus"))


def peak_table(peaks: DataFrame, signals: dict[str, DataFrame], genes: DataFrame, gap: int = 500) -> DataFrame:
    """(peak, chrom, start, stop, a count for each signal, nearby genes) of peaks linked over gaps."""
    merged = st.link(peaks, gap, False)
    merged = merged.select(F.format_string("%s:%d-%d", "chrom", "start", "stop").alias("label"), "chrom", "strand", "start", "stop")
    out = ov.counts(signals, merged, True)
    near = ov.annotate_territory(merged, genes).where("ref <> 'NA'").groupBy("label").agg(F.array_join(F.array_sort(F.collect_set("ref")), ",").alias("genes"))
    return out.join(near, "label", "left").na.fill("NA", ["genes"])


def reference_matrix(genes: DataFrame, signals: dict[str, DataFrame], flank: int, bins: int) -> DataFrame:
    """Signal in bins over flanks around the 5' ends of genes, by kilobase and million rows."""
    five = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("stop"))
    ref = genes.select("label", F.array(F.struct("chrom", "strand", F.greatest(F.lit(1), five - flank).alias("start"), (five + flank - 1).alias("stop"))).alias("intervals"))
    return sc.signal_matrix(signals, ref, bins, rpkm=True, ignore_strand=True)


def filtered_matrix(pairs: DataFrame, fragments: DataFrame, regions: DataFrame, size: int, **rules) -> DataFrame:
    """Contact counts of regions from raw pairs: fragments, classes, duplicates, bins."""
    return pr.region_matrix(pr.filter_pairs(pr.classify(pr.with_fragments(pairs, fragments), **rules)), regions, size)


def annotated_interactions(loops: DataFrame, notes: DataFrame, size: int) -> DataFrame:
    """Cells (chrom, i, j, …) with the labels of rows that overlap either bin, N/A without any."""
    ends = loops.select("chrom", F.col("i").alias("b")).union(loops.select("chrom", "j")).distinct()
    rows = ends.select(F.col("b").cast("string").alias("label"), "chrom", F.lit("+").alias("strand"), (F.col("b") * size + 1).alias("start"), ((F.col("b") + 1) * size).alias("stop"), "b")
    hit = ov.overlap_join(rows, notes, True).groupBy(F.col("a_chrom").alias("chrom"), F.col("a_b").alias("b")).agg(F.array_join(F.array_sort(F.collect_set("b_label")), ",").alias("note"))
    out = loops
    for k in ("i", "j"):
        out = out.join(hit.withColumnsRenamed({"b": k, "note": f"note_{k}"}), ["chrom", k], "left")
    return out.na.fill("N/A", ["note_i", "note_j"])


def bin_features(genome: DataFrame, size: int, effective: DataFrame, scores: DataFrame) -> DataFrame:
    """(chrom, start, effective, score) of the genome's tiles: bases covered by effective rows, mean score of overlapping rows."""
    t = pr.tiles(genome, size).select(F.col("fragment").alias("label"), "chrom", F.lit("+").alias("strand"), "start", "stop")
    covered = ov.coverage(effective, t, True).select("chrom", "start", F.col("n").alias("effective"))
    mean = ov.overlap_join(scores, t, True).groupBy(F.col("b_chrom").alias("chrom"), F.col("b_start").alias("start")).agg(F.avg("a_score").alias("score"))
    return covered.join(mean, ["chrom", "start"], "left").na.fill(0.0, ["score"])


def domains_between(boundaries: DataFrame, genome: DataFrame, size: int) -> DataFrame:
    """What lies between boundary bins (chrom, i)."""
    rows = boundaries.select(F.lit("b").alias("label"), "chrom", F.lit("+").alias("strand"), (F.col("i") * size + 1).alias("start"), ((F.col("i") + 1) * size).alias("stop"))
    return st.inverse(st.link(rows), genome)


def score_components(scores: DataFrame, k: int = 2) -> DataFrame:
    """(row, pc) of samples from long scores (row sample, col bin, value), quantile-normalised by sample."""
    turned = sx.quantile_normalise(scores.select(F.col("col").alias("row"), F.col("row").alias("col"), "value"))
    rows = turned.groupBy(F.col("col").alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "value"))), lambda p: p.value).alias("v"))
    return sx.principal_components(rows, k)


def differential_peaks(peaks: DataFrame, x: dict[str, DataFrame], y: dict[str, DataFrame], genes: DataFrame, **rules) -> DataFrame:
    """(label, fold, fdr, change, genes) of peaks counted in replicates of two groups."""
    rows = keep(ov.counts({**x, **y}, peaks, True), "counts")  # the folds, their background and the rates all read them
    changes = sx.differential(rows.withColumnRenamed("label", "row"), list(x), list(y), **rules)
    near = ov.annotate_territory(peaks, genes).groupBy(F.col("label").alias("row")).agg(F.array_join(F.array_sort(F.collect_set("ref")), ",").alias("genes"))
    return changes.join(near, "row", "left")  # every peak has a row; where no genes are asked for, none are looked up


def change_track(changes: DataFrame, size: int, flank: int) -> DataFrame:
    """Rows (chrom, start, stop, change) of changed boundary bins, widened."""
    return changes.where("change <> 0").select("chrom", F.greatest(F.lit(1), F.col("i") * size + 1 - flank).alias("start"), ((F.col("i") + 1) * size + flank).alias("stop"), "change")


def browser_track(pairs: DataFrame, size: int, least: float) -> DataFrame:
    """Binned pairs within chromosomes as a long-range track."""
    cells = pr.bin_matrix(pairs, size).where("chrom1 = chrom2").select(F.col("chrom1").alias("chrom"), F.col("bin1").alias("i"), F.col("bin2").alias("j"), "n")
    return pr.long_range_track(cells, size, least)


def coverage_track(reads: DataFrame, library: float) -> DataFrame:
    """Stretches of one coverage by millions of rows."""
    from lociframe.sources.formats import depth

    rows = depth(reads.select(F.array(F.struct("chrom", "strand", "start", "stop")).alias("intervals")))
    return rows.select("chrom", "start", "stop", (F.col("depth") / (library / 1e6)).alias("value"))


def run_plan(sheet: DataFrame, by: str, size: int = 2) -> DataFrame:
    """(group, members) to compare: all sets of ``size`` groups of a sample sheet, and each group's samples."""
    groups = sheet.groupBy(F.col(by).alias("object")).agg(F.array_join(F.array_sort(F.collect_list("sample")), ",").alias("samples"))
    out = groups.select(F.array("object").alias("objects"), F.array("samples").alias("members"))
    for _ in range(size - 1):
        out = out.join(groups, F.col("object") > F.element_at("objects", -1)).select(F.concat("objects", F.array("object")).alias("objects"), F.concat("members", F.array("samples")).alias("members"))
    return out.select(F.array_join("objects", ".").alias("objects"), F.array_join("members", ";").alias("members"))


def stale(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of a plan (objects, made from inputs at time changed) that are not done, or were before their inputs changed."""
    return plan.join(done.select("objects", F.col("at")), "objects", "left").where("at IS NULL OR at < changed").drop("at")


def compare_contacts(a: DataFrame, b: DataFrame, sizes: DataFrame, distances: list[int]) -> DataFrame:
    """Correlations of observed by expected cells up to each distance."""
    return ct.compare_by_distance(ct.preprocess(a, sizes, "dist"), ct.preprocess(b, sizes, "dist"), distances)


def easy_differences(samples: DataFrame, x: list[str], y: list[str], normalise: bool = True, least: float = float("-inf"), outlier_density: float = 0.0, min_fold: float = 1.5, max_fdr: float = 0.05) -> DataFrame:
    """(row, fold, fdr, change) of a table (row, one column a sample): reference samples x against samples y.

    Columns are quantile-normalised, rows with no value of ``least`` go, as do outliers between the first two
    replicates of each group, by local regression, if a density is given; those that stay are tested by the folds between replicates.
    """
    rows = samples
    if normalise:
        cells = samples.unpivot("row", [*x, *y], "col", "value")
        rows = sx.quantile_normalise(cells).groupBy("row").pivot("col", [*x, *y]).agg(F.first("value"))
    rows = keep(rows.where(F.greatest(*x, *y) >= least), "tested")
    for group in (x, y):
        if len(group) > 1:
            rows = sx.without_outliers(rows, group[0], group[1], outlier_density)
    return sx.differential(keep(rows, "samples"), x, y, float("-inf"), min_fold, max_fdr)
