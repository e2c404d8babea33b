"""Row-wise operators of regions (label, intervals): each handles a row on its own, other columns pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions import interval as iv



def _each(df: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn("intervals", F.transform("intervals", f))


def _not_empty(df: DataFrame) -> DataFrame:
    return df.where(F.size("intervals") > 0)


def flat(df: DataFrame) -> DataFrame:
    """One row an interval: label, k from 0, chrom, strand, start, stop."""
    # an inner explode has Spark look at the array's size first, below all that makes the array, with every step's expressions written out in it
    return df.select("label", F.posexplode_outer("intervals").alias("k", "i")).where("k IS NOT NULL").select("label", "k", "i.*")


def with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """The lengths of the genome's chromosomes as a map column ``lengths``; one small row for each chromosome."""
    sizes = bounds.agg(F.map_from_entries(F.collect_list(F.struct("chrom", "size"))).alias("lengths"))
    return df.join(F.broadcast(sizes))


def bounds(df: DataFrame, genome: DataFrame) -> DataFrame:
    """Intervals clipped to their chromosome; those outside go, unknown chromosomes stay as they are."""
    df = with_bounds(df, genome)
    return _not_empty(_each(df, lambda i: iv.bounded(i, F.col("lengths")[i.chrom])).withColumn("intervals", F.filter("intervals", iv.valid)).drop("lengths"))


def center(df: DataFrame) -> DataFrame:
    """The one or two middle bases of each interval."""

    def middle(i: Column) -> Column:
        half = F.floor((i.stop - i.start) / 2).cast("long")
        return iv.moved(i, i.start + half, i.stop - half)

    return _each(df, middle)


def rename_chromosomes(df: DataFrame, names: DataFrame) -> DataFrame:
    """Chromosomes by a table (chrom, name); those it lacks keep their name."""
    table = names.agg(F.map_from_entries(F.collect_list(F.struct("chrom", "name"))).alias("names"))
    df = df.join(F.broadcast(table))
    return _each(df, lambda i: iv.interval(F.coalesce(F.col("names")[i.chrom], i.chrom), i.strand, i.start, i.stop)).drop("names")


def connect(df: DataFrame) -> DataFrame:
    """One interval from the least start to the largest stop, on the first interval's chromosome and strand."""
    first = F.element_at("intervals", 1)
    return df.withColumn("intervals", F.array(iv.moved(first, F.array_min(F.col("intervals.start")), F.array_max(F.col("intervals.stop")))))


def _successive(f: Callable[[Column, Column], Column]) -> Column:
    n = F.greatest(F.size("intervals") - 1, F.lit(0))
    return F.zip_with(F.slice("intervals", F.lit(1), n), F.slice("intervals", F.lit(2), n), f)


def gaps(df: DataFrame) -> DataFrame:
    """What lies between successive intervals; regions without a gap go."""
    between = F.filter(_successive(lambda a, b: iv.moved(a, a.stop + 1, b.start - 1)), iv.valid)
    return _not_empty(df.withColumn("intervals", between))


def distances(df: DataFrame, op1: str = "2", op2: str = "1") -> DataFrame:
    """``distances`` between reference points of successive intervals, infinite across chromosomes."""
    far = F.lit(float("inf"))
    return df.withColumn("distances", _successive(lambda a, b: F.when(a.chrom == b.chrom, (iv.coordinate(b, op2) - iv.coordinate(a, op1)).cast("double")).otherwise(far)))


def divide(df: DataFrame) -> DataFrame:
    """Each interval as two halves; one base stays whole."""

    def halves(i: Column) -> Column:
        half = F.floor((i.stop - i.start + 1) / 2).cast("long")
        return F.when(i.stop <= i.start, F.array(i)).otherwise(F.array(iv.moved(i, i.start, i.start + half - 1), iv.moved(i, i.start + half, i.stop)))

    return df.withColumn("intervals", F.flatten(F.transform("intervals", halves)))


def fix(df: DataFrame) -> DataFrame:
    """Without invalid intervals."""
    return _not_empty(df.withColumn("intervals", F.filter("intervals", iv.valid)))


def intersection(df: DataFrame) -> DataFrame:
    """What all intervals of a region have in common; regions without such go."""
    first = F.element_at("intervals", 1)
    common = iv.moved(first, F.array_max(F.col("intervals.start")), F.array_min(F.col("intervals.stop")))
    return df.where(iv.compatible(F.col("intervals"))).withColumn("intervals", F.array(common)).where(iv.valid(F.col("intervals")[0]))


def length(df: DataFrame) -> DataFrame:
    """``n``: the bases of all intervals."""
    return df.withColumn("n", iv.region_size(F.col("intervals"), True))


def position(df: DataFrame, op: str = "1", shift: int = 0) -> DataFrame:
    return _each(df, lambda i: iv.at_position(i, op, shift))


def select(df: DataFrame, first: bool = False, last: bool = False, five: bool = False, three: bool = False) -> DataFrame:
    """The first or last interval, by coordinate or along the strand; both if asked; none if none is asked."""
    ordered = sort(df)
    ends = F.element_at("intervals", 1), F.element_at("intervals", -1)
    plus = ends[0].strand == "+"
    take_first = F.lit(first) | F.when(plus, F.lit(five)).otherwise(F.lit(three))
    take_last = F.lit(last) | F.when(plus, F.lit(three)).otherwise(F.lit(five))
    none = F.array().cast(f"array<{iv.INTERVAL}>")
    chosen = F.concat(F.when(take_first, F.array(ends[0])).otherwise(none), F.when(take_last, F.array(ends[1])).otherwise(none))
    return _not_empty(ordered.withColumn("intervals", chosen))


def shift(df: DataFrame, start: int = 0, stop: int = 0) -> DataFrame:
    return _each(df, lambda i: iv.shifted(i, start, stop))


def shift_by_strand(df: DataFrame, five: int = 0, three: int = 0) -> DataFrame:
    return _each(df, lambda i: iv.shifted_by_strand(i, five, three))


def sort(df: DataFrame) -> DataFrame:
    """Intervals by chromosome, strand, start."""
    return df.withColumn("intervals", F.array_sort("intervals"))


def split(df: DataFrame, by_strand: bool = False) -> DataFrame:
    """A region for each interval, or for each chromosome and strand."""
    if not by_strand:
        return df.withColumn("_i", F.explode("intervals")).withColumn("intervals", F.array("_i")).drop("_i")
    parts = F.array_distinct(F.transform("intervals", lambda i: F.struct(i.chrom.alias("chrom"), i.strand.alias("strand"))))
    df = sort(df).withColumn("_part", F.explode(parts))
    return df.withColumn("intervals", F.filter("intervals", lambda i: (i.chrom == F.col("_part.chrom")) & (i.strand == F.col("_part.strand")))).drop("_part")


def strand(df: DataFrame, op: str) -> DataFrame:
    """All strands to + or -, or each to the other (r)."""
    new = (lambda i: F.when(i.strand == "+", "-").otherwise("+")) if op == "r" else lambda i: F.lit(op)
    return _each(df, lambda i: iv.interval(i.chrom, new(i), i.start, i.stop))


def union(df: DataFrame) -> DataFrame:
    """Overlapping intervals of a region merged; intervals that only touch stay apart."""
    none = F.array().cast(f"array<{iv.INTERVAL}>")

    def add(done: Column, i: Column) -> Column:
        last = F.element_at(done, -1)
        joined = (F.size(done) > 0) & (last.chrom == i.chrom) & (last.strand == i.strand) & (i.start <= last.stop)
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(iv.moved(last, last.start, F.greatest(last.stop, i.stop))))
        return F.when(F.size(done) == 0, F.array(i)).when(joined, longer).otherwise(F.concat(done, F.array(i)))

    merged = F.aggregate(F.array_sort("intervals"), none, lambda done, i: F.when(F.size(done) == 0, F.array(i)).otherwise(add(done, i)))
    return df.withColumn("intervals", merged)


def windows(df: DataFrame, size: int, step: int, small: bool = False) -> DataFrame:
    """Windows of ``size`` each ``step`` bases of every interval, labelled label#k from 1; shorter ones at the end if ``small``."""
    rows = df.select("label", F.explode("intervals").alias("i"))
    last = F.col("i.stop") if small else F.col("i.stop") - size + 1
    starts = F.when(last >= F.col("i.start"), F.sequence(F.col("i.start"), last, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("label", "i", F.posexplode(starts).alias("k", "at"))
    found = iv.moved(F.col("i"), F.col("at"), F.least(F.col("at") + size - 1, F.col("i.stop")))
    return rows.select(F.concat_ws("#", "label", (F.col("k") + 1).cast("string")).alias("label"), F.array(found).alias("intervals"))


def reverse_positions(df: DataFrame, genome: DataFrame) -> DataFrame:
    """- strand coordinates counted from the chromosome's end."""
    return _each(with_bounds(df, genome), lambda i: iv.mirrored(i, F.col("lengths")[i.chrom])).drop("lengths")


def random_place(df: DataFrame, genome: DataFrame, seed: int) -> DataFrame:
    """Each region at a random place of its chromosome, its inner distances kept; the same seed and rows give the same places."""
    df = with_bounds(df, genome)
    low, high = F.array_min(F.col("intervals.start")), F.array_max(F.col("intervals.stop"))
    room = F.greatest(F.lit(0), F.col("lengths")[F.col("intervals")[0].chrom] - (high - low))
    df = df.withColumn("_by", F.pmod(F.xxhash64(F.lit(seed), "label", F.to_json("intervals")), room + 1) + 1 - low)
    return _each(df, lambda i: iv.moved(i, i.start + F.col("_by"), i.stop + F.col("_by"))).drop("_by", "lengths")


def offset_list(df: DataFrame, op: str = "1") -> DataFrame:
    """``offsets``: each interval's ends counted from the region's reference point."""
    whole = df.withColumn("w", iv.moved(F.element_at("intervals", 1), F.array_min(F.col("intervals.start")), F.array_max(F.col("intervals.stop"))))
    return whole.withColumn("offsets", F.transform("intervals", lambda i: F.struct(*[c.alias(n) for c, n in zip(iv.offsets(i, F.col("w"), op), ("start", "stop"))]))).drop("w")


# sequences -------------------------------------------------------------------------------------

COMPLEMENT = ("ACGTacgt", "TGCAtgca")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, *COMPLEMENT))


def extract(df: DataFrame, genome: DataFrame, replace_n: bool = False) -> DataFrame:
    """``seq`` of each region from chunked chromosomes (chrom, chunk from 0, width, seq).

    Intervals meet only the chunks they touch; parts are joined in order, and a - strand region is
    reverse-complemented as a whole.
    """
    whole = F.struct(*[F.col(c) for c in df.columns])
    width = genome.select(F.max("width").alias("_w"))
    parts = df.select(F.monotonically_increasing_id().alias("_id"), whole.alias("row"))
    parts = parts.select("_id", "row", F.posexplode("row.intervals").alias("k", "i")).join(F.broadcast(width))
    parts = parts.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("i.start") - 1) / F.col("_w")), F.floor((F.col("i.stop") - 1) / F.col("_w")))))
    g = genome.select(F.col("chrom").alias("_c"), F.col("chunk").alias("_k"), F.col("seq").alias("_s"))
    parts = parts.join(g, (F.col("i.chrom") == F.col("_c")) & (F.col("chunk") == F.col("_k")), "left")
    at = F.col("chunk") * F.col("_w")
    low, high = F.greatest(F.col("i.start") - at, F.lit(1)), F.least(F.col("i.stop") - at, F.col("_w"))
    piece = F.coalesce(F.substring("_s", low.cast("int"), (high - low + 1).cast("int")), F.lit(""))
    # the numbers of rows are used in this one place, so it does not matter which row gets which
    seqs = parts.groupBy("_id").agg(F.first("row").alias("row"), F.array_sort(F.collect_list(F.struct("k", "chunk", piece.alias("piece")))).alias("ps"))
    seq = F.array_join(F.col("ps.piece"), "")
    seq = F.translate(seq, "Nn", "aa") if replace_n else seq
    turned = F.when(F.col("row.intervals")[0].strand == "-", reverse_complement(seq)).otherwise(seq)
    return seqs.select(*[F.col("row").getField(c).alias(c) for c in df.columns], turned.alias("seq"))


def verify(df: DataFrame, genome: DataFrame) -> DataFrame:
    """``ok``: whether a region's label is its sequence or the reverse complement of that, in either case."""
    seq, label = F.upper("seq"), F.upper("label")
    return extract(df, genome).withColumn("ok", (label == seq) | (label == reverse_complement(seq)))


def search(sequences: DataFrame, pattern: str) -> DataFrame:
    """Every place where an alternative of ``pattern`` (separated by |, N is any base) begins in (label, intervals, seq).

    Matches may overlap; of alternatives at one place the first counts. Places on the - strand are
    counted from the region's end.
    """
    options = [p.replace("N", ".") for p in pattern.split("|")]
    at = F.explode(F.filter(F.sequence(F.lit(1), F.length("seq")), lambda p: F.substr("seq", p).rlike("^(?:" + "|".join(options) + ")")))
    rows = sequences.where(F.length("seq") > 0).select("label", F.col("intervals")[0].alias("i"), "seq", at.alias("at"))
    width = F.length(F.regexp_extract(F.substr("seq", F.col("at")), "^(?:" + "|".join(options) + ")", 0))
    rows = rows.withColumn("w", width)
    start = F.when(F.col("i.strand") == "-", F.col("i.stop") - F.col("at") - F.col("w") + 2).otherwise(F.col("i.start") + F.col("at") - 1)
    return rows.select("label", F.array(iv.moved(F.col("i"), start, start + F.col("w") - 1)).alias("intervals"))


def known_length(df: DataFrame) -> DataFrame:
    """``n``: bases of seq that are not N."""
    return df.withColumn("n", F.length(F.translate("seq", "Nn", "")).cast("long"))


def known_runs(df: DataFrame) -> DataFrame:
    """The longest runs without N of (label, intervals, seq) as intervals, counted along the first interval from its start."""
    tokens = F.regexp_extract_all(F.upper("seq"), F.lit("[^N]+|N+"), 0)
    i = F.col("intervals")[0]
    zero = F.struct(i.start.alias("at"), F.array().cast(f"array<{iv.INTERVAL}>").alias("runs"))

    def step(s: Column, t: Column) -> Column:
        after = s.at + F.length(t)
        return F.struct(after.cast("long").alias("at"), F.when(t.startswith("N"), s.runs).otherwise(F.concat(s.runs, F.array(iv.moved(i, s.at, after - 1)))).alias("runs"))

    return _not_empty(df.where(F.length("seq") > 0).withColumn("intervals", F.aggregate(tokens, zero, step)["runs"]))


def align(df: DataFrame) -> DataFrame:
    """Gapped texts of alignments (cigar, seq, qual, ref): ``query``, ``target``, ``ops`` and ``quality``, one column for each operation's base.

    ops has = and X for matches and mismatches, and D, I, N, P, S as in the CIGAR. A fold over the
    CIGAR's tokens; ``ref`` is the reference from the alignment's first base on.
    """
    tokens = F.transform(F.regexp_extract_all("cigar", F.lit("[0-9]+[MIDNSHP=X]"), 0), lambda t: F.struct(F.regexp_extract(t, "[0-9]+", 0).cast("int").alias("n"), F.right(t, F.lit(1)).alias("op")))
    zero = F.struct(F.lit(1).alias("q"), F.lit(1).alias("r"), F.lit("").alias("query"), F.lit("").alias("target"), F.lit("").alias("ops"), F.lit("").alias("quality"))

    def step(s: Column, t: Column) -> Column:
        both, gap = t.op.isin("M", "=", "X"), F.repeat(F.lit("*"), t.n)
        takes_q, takes_r = both | t.op.isin("I", "S"), both | t.op.isin("D", "N")
        q, qual = F.when(takes_q, F.substring("seq", s.q, t.n)).otherwise(gap), F.when(takes_q, F.substring("qual", s.q, t.n)).otherwise(gap)
        r = F.when(takes_r, F.substring("ref", s.r, t.n)).otherwise(gap)
        same = F.array_join(F.zip_with(F.split(q, ""), F.split(r, ""), lambda a, b: F.when(F.upper(a) == F.upper(b), "=").otherwise("X")), "")
        skip = t.op == "H"
        return F.struct(
            (s.q + F.when(takes_q, t.n).otherwise(0)).alias("q"), (s.r + F.when(takes_r, t.n).otherwise(0)).alias("r"),
            F.concat(s.query, F.when(skip, "").when(t.op == "S", F.lower(q)).when(t.op == "N", "...").otherwise(q)).alias("query"), F.concat(s.target, F.when(skip, "").when(t.op == "N", "...").otherwise(r)).alias("target"),
            F.concat(s.ops, F.when(skip, "").when(both, same).when(t.op == "N", "NNN").otherwise(F.repeat(t.op, t.n))).alias("ops"), F.concat(s.quality, F.when(skip, "").when(t.op == "N", "...").otherwise(qual)).alias("quality"),
        )

    out = F.aggregate(tokens, zero, step)
    return df.withColumn("_a", out).select(*df.columns, *[F.col(f"_a.{c}").alias(c) for c in ("query", "target", "ops", "quality")])
