"""Column expressions of single intervals: struct<chrom, strand, start, stop>, 1-based, both ends included."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERVAL = "struct<chrom:string,strand:string,start:bigint,stop:bigint>"
REGION = f"label string, intervals array<{INTERVAL}>"


def interval(chrom: Column, strand: Column, start: Column, stop: Column) -> Column:
    return F.struct(chrom.alias("chrom"), strand.alias("strand"), start.cast("long").alias("start"), stop.cast("long").alias("stop"))


def moved(i: Column, start: Column, stop: Column) -> Column:
    """The interval with other ends."""
    return interval(i.chrom, i.strand, start, stop)


def strand_of(text: Column) -> Column:
    """+ or - from the spellings + - 1 -1 and . (which is +); null for any other."""
    return F.when(text.isin("+", "1", "."), "+").when(text.isin("-", "-1"), "-")


def size(i: Column) -> Column:
    return F.greatest(F.lit(0), i.stop - i.start + 1).cast("long")


def overlap_length(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a.stop, b.stop) - F.greatest(a.start, b.start) + 1).cast("long")


def overlaps(a: Column, b: Column, ignore_strand: bool = False) -> Column:
    same = (a.chrom == b.chrom) & (a.start <= b.stop) & (a.stop >= b.start)
    return same if ignore_strand else same & (a.strand == b.strand)


def contained(a: Column, b: Column) -> Column:
    return (a.start >= b.start) & (a.stop <= b.stop)


def coordinate(i: Column, op: str) -> Column:
    """A reference point: 1 start, 2 stop, 5p and 3p by strand, c the centre (start plus half the distance to stop)."""
    if op == "1":
        return i.start
    if op == "2":
        return i.stop
    if op == "5p":
        return F.when(i.strand == "+", i.start).otherwise(i.stop)
    if op == "3p":
        return F.when(i.strand == "+", i.stop).otherwise(i.start)
    if op == "c":
        return i.start + F.floor((i.stop - i.start) / 2).cast("long")
    raise ValueError(f"unknown reference point {op!r}")


def distance(a: Column, b: Column, op_a: str = "1", op_b: str = "1") -> Column:
    return coordinate(a, op_a) - coordinate(b, op_b)


def offsets(i: Column, ref: Column, op: str) -> tuple[Column, Column]:
    """(start, stop) of i from ref's reference point; mirrored where that point's strand runs backwards."""
    point = coordinate(ref, op)
    a, b = i.start - point, i.stop - point
    back = {"5p": ref.strand == "-", "3p": ref.strand == "+"}.get(op, F.lit(False))
    return F.when(back, -b).otherwise(a), F.when(back, -a).otherwise(b)


def shifted(i: Column, start: int, stop: int) -> Column:
    return moved(i, i.start + start, i.stop + stop)


def shifted_by_strand(i: Column, five: int, three: int) -> Column:
    """Ends moved along the strand: five for the 5' end, three for the 3' end."""
    plus = i.strand == "+"
    return moved(i, F.when(plus, i.start + five).otherwise(i.start - three), F.when(plus, i.stop + three).otherwise(i.stop - five))


def at_position(i: Column, op: str, shift: int = 0) -> Column:
    """The interval collapsed to a point; for c to the middle (start plus half the size) and ``shift`` at either side."""
    if op == "c":
        middle = i.start + F.floor((i.stop - i.start + 1) / 2).cast("long")
        return moved(i, middle - shift, middle + shift)
    return moved(i, coordinate(i, op), coordinate(i, op))


def bounded(i: Column, length: Column) -> Column:
    """Clipped to 1..length; (0, 0) if all of it is outside; unchanged if length is null."""
    outside = (i.stop < 1) | (i.start > length)
    return F.when(length.isNull(), i).when(outside, moved(i, F.lit(0), F.lit(0))).otherwise(moved(i, F.greatest(F.lit(1), i.start), F.least(length, i.stop)))


def mirrored(i: Column, length: Column) -> Column:
    """Coordinates counted from the chromosome's end, for intervals on the - strand."""
    return F.when(i.strand == "-", moved(i, length - i.stop + 1, length - i.start + 1)).otherwise(i)


def valid(i: Column) -> Column:
    return (i.start >= 1) & (i.start <= i.stop)


def weight(label: Column, most: int) -> Column:
    """1 if at most one counts; else the number a label begins with, up to ``most``."""
    if most <= 1:
        return F.lit(1).cast("long")
    return F.least(F.lit(most).cast("long"), number_of(label))


def number_of(label: Column) -> Column:
    """The whole number that a label begins with, 0 if none."""
    return F.coalesce(F.when(label.rlike(r"^\s*[-+]?\d"), F.regexp_extract(label, r"^\s*([-+]?\d+)", 1).cast("long")), F.lit(0).cast("long"))


def region_size(intervals: Column, skip_gaps: bool) -> Column:
    """Bases of a region: its intervals', or its whole span's."""
    if skip_gaps:
        return F.aggregate(intervals, F.lit(0).cast("long"), lambda a, i: a + size(i))
    return F.element_at(intervals, -1).stop - F.element_at(intervals, 1).start + 1


def covered_by(a: Column, b: Column, ignore_strand: bool = False) -> Column:
    """Whether every interval of a overlaps some interval of b."""
    return F.forall(a, lambda x: F.exists(b, lambda y: overlaps(x, y, ignore_strand)))


def regions_overlap(a: Column, b: Column, ignore_strand: bool = False) -> Column:
    return F.exists(a, lambda x: F.exists(b, lambda y: overlaps(x, y, ignore_strand)))


def compatible(intervals: Column) -> Column:
    """Whether all intervals are on one chromosome and strand."""
    first = F.element_at(intervals, 1)
    return F.forall(intervals, lambda i: (i.chrom == first.chrom) & (i.strand == first.strand))


def sorted_apart(intervals: Column) -> Column:
    """Whether the intervals are compatible, sorted, and each starts after the one before ends."""
    following = F.slice(intervals, 2, F.greatest(F.size(intervals) - 1, F.lit(0)))
    before = F.slice(intervals, 1, F.greatest(F.size(intervals) - 1, F.lit(0)))
    return compatible(intervals) & F.forall(F.zip_with(before, following, lambda a, b: b.start > a.stop), lambda x: x)
