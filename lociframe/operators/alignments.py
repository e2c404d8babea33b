"""Alignments with their bases: clipping to a stretch of the reference, splitting at skips, strands, merging of files.

Rows have the columns of ``formats.parse_sam``. CIGARs are folded token by token inside expressions; nothing is shuffled
but by ``merge``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions import interval as iv
from lociframe.operators import regions as rg

#: Operations that go along the reference, and along the read's bases.
ALONG_REFERENCE, ALONG_READ = ("M", "D", "=", "X"), ("M", "I", "S", "=", "X")
TOKEN = "struct<n:bigint,op:string>"


def tokens(cigar: Column) -> Column:
    return F.transform(F.regexp_extract_all(cigar, F.lit("[0-9]+[MIDNSHP=X]"), 0), lambda t: F.struct(F.regexp_extract(t, "[0-9]+", 0).cast("long").alias("n"), F.right(t, F.lit(1)).alias("op")))


def written(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda t: F.concat(t.n.cast("string"), t.op)), "")


def _cut(parts: Column, bases: Column) -> Column:
    """(left, cut, kept) of tokens less the first ``bases`` of the reference; cut counts the read's bases that go with them.

    Operations that do not go along the reference go with what stands before the cut: insertions whole, clips at
    most as many bases as there are to cut.
    """
    zero = F.struct(F.greatest(bases, F.lit(0).cast("long")).alias("left"), F.lit(0).cast("long").alias("cut"), (bases <= 0).alias("done"), F.array().cast(f"array<{TOKEN}>").alias("kept"))

    def step(s: Column, t: Column) -> Column:
        along, read = t.op.isin(*ALONG_REFERENCE), t.op.isin(*ALONG_READ)
        last = along & (t.n > s.left)
        gone = F.when(~read, 0).when(t.op == "I", t.n).otherwise(F.least(s.left, t.n))
        rest = F.struct((t.n - s.left).alias("n"), t.op.alias("op"))
        return F.struct(
            F.when(s.done | last, 0).when(along, s.left - t.n).otherwise(s.left).cast("long").alias("left"), F.when(s.done, s.cut).otherwise(s.cut + gone).cast("long").alias("cut"), (s.done | last).alias("done"),
            F.when(s.done, F.concat(s.kept, F.array(t))).when(last, F.concat(s.kept, F.array(rest))).otherwise(s.kept).alias("kept"),
        )

    return F.aggregate(parts, zero, step)


def clip(df: DataFrame, start: Column, stop: Column, label: Column | None = None) -> DataFrame:
    """Alignments without skips cut to reference bases start to stop: position, CIGAR, bases and qualities; tlen is 0, a sequence of nothing is *.

    Alignments that do not reach start to stop go; a label is joined to the read's by a colon.
    """
    first = F.col("intervals")[0]
    rows = df.withColumns({"_a": F.greatest(first.start, start), "_b": F.least(F.element_at("intervals", -1).stop, stop)}).where("_a <= _b")
    before, after = F.col("_a") - first.start, F.element_at("intervals", -1).stop - F.col("_b")
    parts = tokens(F.col("cigar"))
    rows = rows.withColumns({"_x": _cut(parts, before), "_y": _cut(F.reverse(parts), after)})
    n = F.length("seq") - F.col("_x.cut") - F.col("_y.cut")
    part = lambda c: F.when((F.col(c) == "*") | (n <= 0), "*").otherwise(F.substr(c, (F.col("_x.cut") + 1).cast("int"), n.cast("int")))
    changed = {
        "pos": F.col("_a"), "cigar": written(F.reverse(_cut(F.reverse(F.col("_x.kept")), after).kept)), "tlen": F.lit(0).cast("long"), "seq": part("seq"), "qual": part("qual"),
        "intervals": F.array(iv.interval(first.chrom, first.strand, F.col("_a"), F.col("_b"))),
    }
    if label is not None:
        changed["label"] = F.concat_ws(":", "label", label)
    return rows.withColumns(changed).select(df.columns)


def split(df: DataFrame) -> DataFrame:
    """One alignment for each stretch between skips (N), with its part of CIGAR, bases and qualities; tlen stays."""
    zero = F.struct(F.lit("").alias("cigar"), F.lit(0).cast("long").alias("from"), F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<cigar:string,from:bigint,n:bigint>>").alias("done"))
    piece = lambda s: F.concat(s.done, F.array(F.struct(s.cigar.alias("cigar"), s["from"].alias("from"), s.n.alias("n"))))

    def step(s: Column, t: Column) -> Column:
        skip, read = t.op == "N", F.when(t.op.isin(*ALONG_READ), t.n).otherwise(0)
        return F.struct(
            F.when(skip, "").otherwise(F.concat(s.cigar, t.n.cast("string"), t.op)).alias("cigar"), F.when(skip, s["from"] + s.n).otherwise(s["from"]).cast("long").alias("from"),
            F.when(skip, 0).otherwise(s.n + read).cast("long").alias("n"), F.when(skip, piece(s)).otherwise(s.done).alias("done"),
        )

    pieces = F.aggregate(tokens(F.col("cigar")), zero, step, piece)
    rows = df.withColumn("_p", F.explode(F.arrays_zip(F.col("intervals").alias("i"), pieces.alias("p")))).where("_p.i IS NOT NULL")
    part = lambda c: F.when(F.col(c) == "*", "*").otherwise(F.substr(c, (F.col("_p.p.from") + 1).cast("int"), F.col("_p.p.n").cast("int")))
    return rows.withColumns({"pos": F.col("_p.i.start"), "cigar": F.col("_p.p.cigar"), "seq": part("seq"), "qual": part("qual"), "intervals": F.array("_p.i")}).select(df.columns)


def strand(df: DataFrame, op: str) -> DataFrame:
    """Alignments on another strand (``regions.strand``): bit 16 of the flag follows, and bases of rows that changed are reverse-complemented."""
    old = F.col("intervals")[0].strand
    out = rg.strand(df.withColumn("_old", old), op)
    new = F.col("intervals")[0].strand
    flag = F.when(new == "-", F.col("flag").bitwiseOR(16)).otherwise(F.col("flag").bitwiseAND(~16))
    turned = F.when((new != F.col("_old")) & (F.col("seq") != "*"), F.reverse(F.translate("seq", "ACGTacgt", "TGCAtgca"))).otherwise(F.col("seq"))
    return out.withColumns({"flag": flag, "seq": turned}).select(df.columns)


def no_windows(df: DataFrame) -> DataFrame:
    raise ValueError("alignments have no windows: take their intervals as regions first")


def merge(*files: DataFrame) -> DataFrame:
    """Rows of several files by place: a range-partitioned sort, columns that a file lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), files).orderBy("chrom", "pos", "label")


def with_header(header: DataFrame, *bodies: DataFrame) -> DataFrame:
    """Lines (value) of files one after another under one header, each in its own order; header lines of the bodies (those with @) go."""
    numbered = lambda df, k: df.select(F.lit(k).alias("_f"), F.monotonically_increasing_id().alias("_n"), "value")
    lines = numbered(header, 0)
    for k, body in enumerate(bodies):
        lines = lines.union(numbered(body, k + 1).where(~F.col("value").startswith("@")))
    return lines.orderBy("_f", "_n").select("value")
