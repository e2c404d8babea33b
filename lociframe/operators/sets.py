"""Set-wise operators of single-interval rows (label, chrom, strand, start, stop): windows over sorted rows.

Windows are by chromosome, strand and tile (``tiles.across``), with what crosses a tile's border carried. ``link`` first merges
inside tiles, which leaves a row for each merged stretch, and only then across them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.operators.tiles import TILE, across

#: Rows of a chromosome and strand are sorted by these.
ORDER = ["start", "stop", "label"]


def _keys(by_strand: bool) -> list[str]:
    return ["chrom", "strand"] if by_strand else ["chrom"]


def global_sort(df: DataFrame, by_strand: bool = True) -> DataFrame:
    """By chromosome, strand, start; of equal starts the longer first. A range-partitioned sort."""
    return df.orderBy(*_keys(by_strand), "start", F.desc("stop"), "label")


def sort_bed(df: DataFrame, ignore_strand: bool = False) -> DataFrame:
    return df.orderBy(*_keys(not ignore_strand), "start")


def reverse_minus(df: DataFrame) -> DataFrame:
    """+ rows by start, - rows by descending start."""
    return df.orderBy("chrom", "strand", F.when(F.col("strand") == "+", F.col("start")).otherwise(-F.col("start")))


def gap_distances(df: DataFrame, op1: str = "2", op2: str = "1") -> DataFrame:
    """``distance`` from each row to the next of its chromosome and strand; NaN at the last."""
    from lociframe.functions import interval as iv

    here = F.struct("strand", "start", "stop")
    d = iv.coordinate(F.col("_after"), op2) - iv.coordinate(here, op1)
    rows = across(df, _keys(True), ORDER, _after=("lead", here))
    return rows.withColumn("distance", F.coalesce(d.cast("double"), F.lit(float("nan")))).drop("_after")


def inverse(df: DataFrame, genome: DataFrame) -> DataFrame:
    """What sorted rows that do not overlap leave of their chromosomes, labelled _.

    Chromosomes and strands without rows give nothing, and a last gap of one base is left out.
    """
    rows = across(df.select("chrom", "strand", "start", "stop"), _keys(True), ["start", "stop"], before=("lag", F.col("stop")), after=("lead", F.col("start"))).na.fill(0, ["before"])
    head = rows.select("chrom", "strand", (F.col("before") + 1).alias("start"), (F.col("start") - 1).alias("stop"))
    tail = rows.where("after IS NULL").join(F.broadcast(genome), "chrom").where("stop + 1 < size").select("chrom", "strand", (F.col("stop") + 1).alias("start"), F.col("size").alias("stop"))
    return head.where("start <= stop").union(tail).select(F.lit("_").alias("label"), "chrom", "strand", "start", "stop")


def _chains(df: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """``chain``: a number for each run of rows that begin at most ``gap`` after all before have ended."""
    order = [c for c in ORDER if c in df.columns]
    df = across(df, [*keys], order, _reached=("max_before", F.col("stop")))
    new = F.when(F.col("_reached").isNull() | (F.col("start") - F.col("_reached") > gap), 1).otherwise(0)
    return across(df.withColumn("_new", new), [*keys], order, chain=("sum", F.col("_new"))).drop("_new", "_reached")


def _chains_within(df: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """_chains of rows of which the keys leave few together: a window for each."""
    w = Window.partitionBy(*keys).orderBy("start", "stop")
    reached = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_new", F.when(reached.isNull() | (F.col("start") - reached > gap), 1).otherwise(0))
    return df.withColumn("chain", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def link(df: DataFrame, gap: int = 0, by_strand: bool = True, label: str | None = None) -> DataFrame:
    """Rows merged into chains whose next start is at most ``gap`` after the largest stop so far; 0 asks for a shared base.

    label: None gives _, min, max and sum aggregate labels as numbers, anything else joins them by it in
    order of start. Rows merge inside tiles first where no order of labels is asked for.
    """
    keys = _keys(by_strand)
    number = F.coalesce(F.expr("try_cast(label AS double)"), F.lit(0.0))
    strand = [] if by_strand else [F.min_by("strand", "start").alias("strand")]
    if label in (None, "min", "max", "sum"):
        f = {"min": F.min, "max": F.max, "sum": F.sum}.get(label or "min")
        df = df.select("chrom", "strand", "start", "stop", number.alias("v"), F.floor(F.col("start") / TILE).alias("tile"))
        part = _chains_within(df, [*keys, "tile"], gap).groupBy(*keys, "tile", "chain").agg(*strand, F.min("start").alias("start"), F.max("stop").alias("stop"), f("v").alias("v"))
        whole = _chains_within(part.drop("chain"), keys, gap).groupBy(*keys, "chain").agg(*strand, F.min("start").alias("start"), F.max("stop").alias("stop"), f("v").alias("v"))
        text = F.lit("_") if label is None else F.when(F.col("v") == F.floor("v"), F.col("v").cast("long").cast("string")).otherwise(F.col("v").cast("string"))
        return whole.select(text.alias("label"), "chrom", "strand", "start", "stop")
    labels = F.array_join(F.array_sort(F.collect_list(F.struct("start", "stop", "label")))["label"], label)
    whole = _chains(df, keys, gap).groupBy(*keys, "chain").agg(*strand, F.min("start").alias("start"), F.max("stop").alias("stop"), labels.alias("label"))
    return whole.select("label", "chrom", "strand", "start", "stop")


def test_sorted(df: DataFrame, by_strand: bool = True) -> DataFrame:
    """One row: rows, how many lie inside the row before, and how many overlap it, in sorted order."""
    rows = across(df.select("chrom", "strand", *ORDER), _keys(by_strand), ORDER, before=("lag", F.col("stop")), begun=("lag", F.col("start")))
    rows = rows.select(((F.col("start") >= F.col("begun")) & (F.col("stop") <= F.col("before"))).alias("inside"), (F.col("start") <= F.col("before")).alias("meets"))
    one = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return rows.agg(F.count("*").alias("n"), one("inside").alias("inclusions"), one("meets").alias("overlaps"))


def partition(df: DataFrame) -> DataFrame:
    """The genome cut at every start and end: segments (chrom, strand, start, stop) with the sorted labels that cover them, joined by commas."""
    from lociframe.operators.overlap import overlap_join

    cuts = df.select("chrom", "strand", F.explode(F.array(F.col("start"), F.col("stop") + 1)).alias("start")).distinct()
    parts = across(cuts, _keys(True), ["start"], after=("lead", F.col("start"))).where("after IS NOT NULL").select("chrom", "strand", "start", (F.col("after") - 1).alias("stop"))
    both = overlap_join(parts, df)
    return both.groupBy(*[F.col(f"a_{c}").alias(c) for c in ("chrom", "strand", "start", "stop")]).agg(F.array_join(F.sort_array(F.collect_list("b_label")), ",").alias("label"))


def leaders(df: DataFrame) -> DataFrame:
    """Rows that overlap no row kept before them, in sorted order.

    Rows of one chain only depend on each other, so each chain is a group, and a chain's rows are
    walked in order; chains, not chromosomes, bound a task.
    """
    rows = _chains(df, ["chrom", "strand"], 0)

    def walk(pdf):
        pdf = pdf.sort_values(["start", "stop", "label"], ascending=[True, False, True])
        kept, end = [], None
        for start, stop in zip(pdf["start"], pdf["stop"]):
            good = end is None or start > end
            kept.append(good)
            end = stop if good else end
        return pdf[kept].drop(columns="chain")

    names = df.columns
    return rows.select(*names, "chain").groupBy("chrom", "strand", "chain").applyInPandas(walk, df.schema)


def global_scan(df: DataFrame, genome: DataFrame, size: int, step: int, sep: str = ",") -> DataFrame:
    """Labels of the rows that begin in each sliding window, joined in order."""
    from lociframe.operators.scan import windows_of

    w = windows_of(df.select("*", F.col("start").alias("pos")), genome, size, step)
    return w.groupBy("chrom", "strand", "start", "stop").agg(F.array_join(F.array_sort(F.collect_list(F.struct("pos", "label")))["label"], sep).alias("labels"))


def upstream(df: DataFrame, most: int = 1_000_000, least: int = 10_000) -> DataFrame:
    """Upstream territories (upstream:label), cut where they meet another gene's on the strand but never under ``least`` bases.

    A territory reaches up to ``most`` bases before the 5' end, to the nearest gene body before it.
    """
    df = across(df.select("label", "chrom", "strand", "start", "stop"), _keys(True), ORDER, _before=("max_before", F.col("stop")), _after=("min_after", F.col("start")))
    before, after = F.col("_before"), F.col("_after")
    plus = F.col("strand") == "+"
    low = F.when(plus, F.least(F.greatest(F.col("start") - most, F.coalesce(before + 1, F.col("start") - most)), F.col("start") - least)).otherwise(F.col("stop") + 1)
    high = F.when(plus, F.col("start") - 1).otherwise(F.greatest(F.least(F.col("stop") + most, F.coalesce(after - 1, F.col("stop") + most)), F.col("stop") + least))
    out = df.select(F.concat(F.lit("upstream:"), "label").alias("label"), "chrom", "strand", F.greatest(low, F.lit(1)).alias("start"), high.alias("stop"))
    return out.where("start <= stop")


