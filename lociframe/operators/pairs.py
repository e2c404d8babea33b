"""Read pairs: assembly, fragments, classes, duplicates, bins and contact matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.operators.overlap import overlap_join
from lociframe.operators.tiles import TILE, across

#: The classes of read pairs.
CLASSES = (
    "unpaired", "unmapped", "single-sided", "multihit", "no-fragment", "same-fragment", "too-close", "too-far",
    "ds-accepted-intra", "ds-accepted-inter", "ds-duplicate-intra", "ds-duplicate-inter", "other",
)


def assemble(reads: DataFrame) -> DataFrame:
    """One row for each pair of (name, chrom, strand, pos, mapq, mapped): mates have one name, or names that end in .1 and .2.

    ``complete`` says whether both mates are there. Mates are told apart by their ending, else by ``mate``.
    """
    base = F.regexp_replace("name", r"[./][12]$", "")
    mate = F.when(F.col("name").rlike(r"[./][12]$"), F.right("name", F.lit(1)).cast("int")).otherwise(F.col("mate"))
    rows = reads.select(base.alias("id"), mate.alias("mate"), F.struct("chrom", "strand", "pos", "mapq", "mapped").alias("read"))
    both = rows.groupBy("id").agg(F.max_by("read", F.when(F.col("mate") == 1, 1)).alias("a"), F.max_by("read", F.when(F.col("mate") == 2, 1)).alias("b"), F.count("*").alias("n"))
    names = ("chrom", "strand", "pos", "mapq", "mapped")
    return both.select("id", *[F.col(f"{m}.{c}").alias(f"{c}{k}") for k, m in ((1, "a"), (2, "b")) for c in names], ((F.col("n") == 2) & F.col("a").isNotNull() & F.col("b").isNotNull()).alias("complete"))


def tiles(genome: DataFrame, size: int) -> DataFrame:
    """Fragments (fragment, chrom, start, stop) of equal length over the genome, the last of a chromosome shorter."""
    rows = genome.select("chrom", "size", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("size"), F.lit(size).cast("long"))).alias("k", "start"))
    return rows.select(F.concat_ws(":", "chrom", F.col("k").cast("string")).alias("fragment"), "chrom", "start", F.least(F.col("start") + size - 1, F.col("size")).alias("stop"))


def with_fragments(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """Pairs with fragment1, f1_start, f1_stop and the same of the second end; null where no fragment holds the point."""
    cut = fragments.withColumn("strand", F.lit("+"))
    out = pairs
    for k in (1, 2):
        p = pairs.select("id", F.col(f"chrom{k}").alias("chrom"), F.lit("+").alias("strand"), F.col(f"pos{k}").cast("long").alias("start"), F.col(f"pos{k}").cast("long").alias("stop"))
        hit = overlap_join(p, cut, True, points=True).groupBy(F.col("a_id").alias("id")).agg(F.min(F.struct("b_start", "b_stop", "b_fragment")).alias("f"))
        out = out.join(hit.select("id", F.col("f.b_fragment").alias(f"fragment{k}"), F.col("f.b_start").alias(f"f{k}_start"), F.col("f.b_stop").alias(f"f{k}_stop")), "id", "left")
    return out


def _end_offset(k: int) -> Column:
    """Bases from a read's point to the fragment end that it faces."""
    return F.when(F.col(f"strand{k}") == "+", F.col(f"f{k}_stop") - F.col(f"pos{k}")).otherwise(F.col(f"pos{k}") - F.col(f"f{k}_start"))


def classify(pairs: DataFrame, mapq: int = 30, min_dist: int = 500, max_offset: int = 500) -> DataFrame:
    """``class`` of pairs with fragments, by the first rule that holds.

    The rules in order: nothing mapped, one side mapped, a low mapping quality, no fragment, one
    fragment, facing closer than min_dist on opposite strands (whatever the chromosomes), both points
    within max_offset of the fragment ends they face; the rest are too far.
    """
    m1 = F.coalesce(F.col("mapped1"), F.lit(True)) if "mapped1" in pairs.columns else F.lit(True)
    m2 = F.coalesce(F.col("mapped2"), F.lit(True)) if "mapped2" in pairs.columns else F.lit(True)
    q1 = F.col("mapq1") if "mapq1" in pairs.columns else F.col("mapq")
    q2 = F.col("mapq2") if "mapq2" in pairs.columns else F.col("mapq")
    near = (F.col("strand1") != F.col("strand2")) & (F.abs(F.col("pos1") - F.col("pos2")) < min_dist)
    good = (_end_offset(1) <= max_offset) & (_end_offset(2) <= max_offset)
    kind = (
        F.when(~m1 & ~m2, "unmapped").when(~m1 | ~m2, "single-sided").when(F.least(q1, q2) < mapq, "multihit")
        .when(F.col("fragment1").isNull() | F.col("fragment2").isNull(), "no-fragment").when(F.col("fragment1") == F.col("fragment2"), "same-fragment")
        .when(near, "too-close").when(good & (F.col("chrom1") == F.col("chrom2")), "ds-accepted-intra").when(good, "ds-accepted-inter").otherwise("too-far")
    )
    return pairs.withColumn("class", kind)


def mark_duplicates(pairs: DataFrame) -> DataFrame:
    """``duplicate``: not the first by id with its chromosomes, strands and points in this order; mirrored pairs are other pairs."""
    w = Window.partitionBy("chrom1", "strand1", "chrom2", "strand2", "pos2", "pos1").orderBy("id")
    return pairs.withColumn("duplicate", F.row_number().over(w) > 1)


def filter_pairs(pairs: DataFrame, drop_duplicates: bool = True) -> DataFrame:
    """The accepted of classified pairs: (id, chrom1, strand1, pos1, chrom2, strand2, pos2)."""
    good = pairs.where(F.col("class").startswith("ds-accepted"))
    if drop_duplicates:
        good = mark_duplicates(good).where("NOT duplicate")
    return good.select("id", "chrom1", "strand1", "pos1", "chrom2", "strand2", "pos2")


def class_stats(pairs: DataFrame) -> DataFrame:
    """(class, n, percent) of classified pairs."""
    n = pairs.groupBy("class").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(n.agg(F.sum("n").alias("total")))).select("class", "n", (100.0 * F.col("n") / F.col("total")).alias("percent"))


def bins(pairs: DataFrame, size: int) -> DataFrame:
    """Each pair's bins: (id, chrom1, bin1, chrom2, bin2), counted from 0."""
    b = lambda k: F.floor((F.col(f"pos{k}") - 1) / size).cast("long").alias(f"bin{k}")
    return pairs.select("id", "chrom1", b(1), "chrom2", b(2))


def bin_matrix(pairs: DataFrame, size: int) -> DataFrame:
    """Symmetric counts (chrom1, bin1, chrom2, bin2, n): cells off the diagonal appear at both places."""
    b = bins(pairs, size)
    turned = b.select(F.col("chrom2").alias("chrom1"), F.col("bin2").alias("bin1"), F.col("chrom1").alias("chrom2"), F.col("bin1").alias("bin2")).where("NOT (chrom1 = chrom2 AND bin1 = bin2)")
    return b.drop("id").unionByName(turned).groupBy("chrom1", "bin1", "chrom2", "bin2").agg(F.count("*").alias("n"))


def bin_bounds(cells: DataFrame, genome: DataFrame, size: int) -> DataFrame:
    """Cells with the locus of either bin, chrom:start-stop, the last of a chromosome cut at its end."""
    out = cells
    for k in (1, 2):
        g = genome.select(F.col("chrom").alias(f"chrom{k}"), F.col("size").alias("_s"))
        at = F.col(f"bin{k}") * size
        out = out.join(F.broadcast(g), f"chrom{k}").withColumn(f"locus{k}", F.concat(f"chrom{k}", F.lit(":"), (at + 1).cast("string"), F.lit("-"), F.least(at + size, F.col("_s")).cast("string"))).drop("_s")
    return out


def region_matrix(pairs: DataFrame, regions: DataFrame, size: int, max_dist: int | None = None, layout: str = "full") -> DataFrame:
    """Counts (region, i, j, n) of pairs with both points in one region (label, chrom, start, stop).

    layout full gives symmetric cells; band gives columns max_bin + j - i at both places; rotated gives
    row (i + j) / 2 and column |i - j| once. max_dist bounds |i - j| in bases. Pairs over two regions go.
    """
    ref = regions.withColumn("strand", F.lit("+"))
    out = None
    for k in (1, 2):
        p = pairs.select("id", F.col(f"chrom{k}").alias("chrom"), F.lit("+").alias("strand"), F.col(f"pos{k}").cast("long").alias("start"), F.col(f"pos{k}").cast("long").alias("stop"))
        hit = overlap_join(p, ref, True, points=True).groupBy(F.col("a_id").alias("id")).agg(F.min(F.struct("b_start", "b_label", (F.col("a_start") - F.col("b_start")).alias("at"))).alias("h"))
        hit = hit.select("id", F.col("h.b_label").alias(f"region{k}"), F.floor(F.col("h.at") / size).cast("long").alias(f"b{k}"))
        out = hit if out is None else out.join(hit, "id")
    out = out.where("region1 = region2").select(F.col("region1").alias("region"), F.col("b1").alias("i"), F.col("b2").alias("j"))
    top = None if max_dist is None else max_dist // size
    if top is not None:
        out = out.where(F.abs(F.col("i") - F.col("j")) <= top)
    if layout == "rotated":
        out = out.select("region", F.floor((F.col("i") + F.col("j")) / 2).alias("i"), F.abs(F.col("i") - F.col("j")).alias("j"))
    else:
        out = out.union(out.where("i <> j").select("region", F.col("j").alias("i"), F.col("i").alias("j")))
        if layout == "band":
            out = out.select("region", "i", (F.lit(top or 0) + F.col("j") - F.col("i")).alias("j"))
    return out.groupBy("region", "i", "j").agg(F.count("*").alias("n"))


def long_range_track(cells: DataFrame, size: int, least: float = 0.0, max_dist: int | None = None) -> DataFrame:
    """Rows of a browser's long-range track of cells (chrom, i, j, n): chrom, start, stop, target, id, flag.

    Cells with |n| of ``least`` or less go, as do those farther than max_dist; flag is + upstream, - downstream,
    . on the diagonal; ids number the rows by place within a chromosome.
    """
    rows = cells.where(F.abs("n") > least)
    if max_dist is not None:
        rows = rows.where(F.abs(F.col("j") - F.col("i")) * size <= max_dist)
    target = F.concat(F.col("chrom"), F.lit(":"), (F.col("j") * size).cast("string"), F.lit("-"), ((F.col("j") + 1) * size).cast("string"), F.lit(","), F.col("n").cast("string"))
    rows = across(rows.select("chrom", "i", "j", "n"), ["chrom"], ["i", "j"], max(1, TILE // size), id=("sum", F.lit(1)))
    flag = F.when(F.col("i") < F.col("j"), "+").when(F.col("i") > F.col("j"), "-").otherwise(".")
    return rows.select("chrom", (F.col("i") * size).alias("start"), ((F.col("i") + 1) * size).alias("stop"), target.alias("target"), F.col("id").cast("int").alias("id"), flag.alias("flag"))


def best_alignments(reads: DataFrame) -> DataFrame:
    """Of alignments (name, length, chrom, pos) of ever shorter parts of reads, each read's longest."""
    return reads.groupBy("name").agg(F.max_by(F.struct("chrom", "pos", "length"), "length").alias("a")).select("name", "a.*")
