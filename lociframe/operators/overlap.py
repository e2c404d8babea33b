"""Overlap joins of single-interval rows (label, chrom, strand, start, stop), by bins and an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.functions import interval as iv

#: Bits of the bin sizes. A feature's own bins are the smallest of which it has at most SPAN + 1.
LEVELS, SPAN = (10, 13, 16, 19, 22, 25), 8
#: Bits of the tiles of the genome in which ends are added up.
TILE_BITS = 16


#: A feature's own bits, in SQL; features too long for all levels have more of the last level's bins.
OWN = "CASE " + " ".join(f"WHEN stop - start < {SPAN << b} THEN {b}" for b in LEVELS[:-1]) + f" ELSE {LEVELS[-1]} END"


def _binned(df: DataFrame, mark: str, other: DataFrame, points: bool) -> DataFrame:
    """Columns named mark_*, and a row for each bin at each level at which rows of ``other`` meet the feature.

    mark_own and mark_other are both features' own bits: pairs of levels that do not occur cost no rows.
    """
    each = f"{LEVELS[0]}" if points else f"explode(array{LEVELS})"  # points are of the first level
    rows = df.selectExpr(*[f"`{c}` AS `{mark}_{c}`" for c in df.columns], f"{OWN} AS {mark}_own", f"{each} AS {mark}_other")
    if not points and not other.isStreaming:  # a row for each level at most
        rows = rows.join(F.broadcast(other.selectExpr(f"{OWN} AS {mark}_other").distinct()), f"{mark}_other", "left_semi")
    at = f"shiftright({mark}_%s, greatest({mark}_own, {mark}_other))"
    return rows.selectExpr("*", f"explode(sequence({at % 'start'}, {at % 'stop'})) AS {mark}_bin")


def _sides(left: DataFrame, right: DataFrame, ignore_strand: bool, points: bool) -> tuple[DataFrame, DataFrame, str]:
    """Both sides by bins, and the condition by which they meet."""
    a, b = _binned(left, "a", right, False), _binned(right, "b", left, points)
    on = "a_chrom = b_chrom AND a_own = b_other AND a_other = b_own AND a_bin = b_bin AND a_start <= b_stop AND a_stop >= b_start"
    return a, b, on if ignore_strand else on + " AND a_strand = b_strand"


def overlap_join(left: DataFrame, right: DataFrame, ignore_strand: bool = False, points: bool = False) -> DataFrame:
    """Pairs of rows that share a base, each pair once: columns a_* of left and b_* of right.

    Each row has a level by its length, and for each level of the other side a row for the bins it touches at the
    coarser of both: so both levels are part of the key, and short rows never meet in the wide bins that
    long ones need. Above the lowest level the longer row of a pair is longer than the bin, so few pairs that meet do not
    overlap. A pair counts in the bin where the later start lies, so no distinct is needed. The levels of each side
    are looked up in the same job; ``points`` says that left has single bases, which saves reading it for that.
    A bin with very many rows is one key, of which adaptive skew joins split the larger side.
    """
    a, b, on = _sides(left, right, ignore_strand, points)
    first = " AND a_bin = shiftright(greatest(a_start, b_start), greatest(a_own, a_other))"
    return a.join(b, F.expr(on + first)).drop(*[f"{m}_{c}" for m in "ab" for c in ("own", "other", "bin")])


def region_overlap_join(left: DataFrame, right: DataFrame, ignore_strand: bool = False, gaps: bool = False) -> DataFrame:
    """As overlap_join for regions (label, intervals): spans meet, then with ``gaps`` that is enough, else some intervals must."""

    def span(df: DataFrame) -> DataFrame:
        first = F.element_at("intervals", 1)
        return df.select("label", "intervals", first.chrom.alias("chrom"), first.strand.alias("strand"), F.array_min("intervals.start").alias("start"), F.array_max("intervals.stop").alias("stop"))

    both = overlap_join(span(left), span(right), ignore_strand)
    return both if gaps else both.where(iv.regions_overlap(F.col("a_intervals"), F.col("b_intervals"), ignore_strand))


def overlap(test: DataFrame, ref: DataFrame, ignore_strand: bool = False, label: bool = False, sep: str = ":") -> DataFrame:
    """The test row once for each reference row it overlaps; labels as test:ref if asked."""
    name = F.concat_ws(sep, "a_label", "b_label") if label else F.col("a_label")
    return overlap_join(test, ref, ignore_strand).select(name.alias("label"), *[F.col(f"a_{c}").alias(c) for c in ("chrom", "strand", "start", "stop")])


def intersect(test: DataFrame, ref: DataFrame, ignore_strand: bool = False, label: bool = False) -> DataFrame:
    """The part of the test row inside each reference row it overlaps."""
    name = F.concat_ws(":", "a_label", "b_label") if label else F.col("a_label")
    return overlap_join(test, ref, ignore_strand).select(name.alias("label"), F.col("a_chrom").alias("chrom"), F.col("a_strand").alias("strand"), F.greatest("a_start", "b_start").alias("start"), F.least("a_stop", "b_stop").alias("stop"))


def subset(test: DataFrame, ref: DataFrame, ignore_strand: bool = False, invert: bool = False) -> DataFrame:
    """Test rows that overlap some reference row, or none.

    Distinct places look into the bins they touch: a semi join, which stops at the first hit, and one row for a
    place that has hits in several bins.
    """
    cols = ["chrom", "start", "stop"] if ignore_strand else ["chrom", "strand", "start", "stop"]
    a, b, on = _sides(test.select(cols).distinct(), ref, ignore_strand, False)
    hit = a.join(b, F.expr(on), "left_semi").select(*[F.col(f"a_{c}").alias(c) for c in cols]).distinct()
    return test.join(hit, cols, "left_anti" if invert else "left_semi").select(test.columns)


def running_sums(events: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """asked (keys, pos, …) with ``a`` and ``b``: the sums of events (keys, pos, a, b) of the same keys up to pos.

    Rows are dealt out by tiles of the genome, once; of events only the sums of tiles are carried across their borders.
    """
    more = [c for c in asked.columns if c not in (*keys, "pos")]
    nothing = F.lit(0).cast("long")
    none = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in more]
    rows = events.groupBy(*keys, "pos").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).select(*keys, "pos", *none, F.lit(0).alias("_asked"), "a", "b")
    rows = rows.union(asked.select(*keys, "pos", *more, F.lit(1), nothing, nothing)).withColumn("_tile", F.shiftright("pos", TILE_BITS))
    before = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = rows.groupBy(*keys, "_tile").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    tiles = tiles.select(*keys, "_tile", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in "ab"])
    inside = Window.partitionBy(*keys, "_tile").orderBy("pos", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.join(tiles, [*keys, "_tile"]).select(*asked.columns, "_asked", *[(F.sum(c).over(inside) + F.col(f"_{c}")).alias(c) for c in "ab"])
    return sums.where("_asked = 1").drop("_asked")


def _place_sums(test: DataFrame, ref: DataFrame, bases: bool, ignore_strand: bool, most: int) -> DataFrame:
    """Places (chrom, strand, start, stop) of ref with ``n``, the weights of overlapping test rows added up, for each base they share if asked.

    No pairs are made, which are as many as the square of the rows: what starts up to a reference row's stop, less what stops before
    its start, is what overlaps it, so that sums of ends up to two places are enough. Rows whose stop lies before their
    start have no such order of ends: if there are any, they are joined.
    """
    place = ["chrom", "strand", "start", "stop"]
    kept = [c for c in place if c != "strand" or not ignore_strand]
    keys = kept[:-2]
    tests = test.select(*kept, F.coalesce(iv.weight(F.col("label"), most), F.lit(0)).alias("weight"))
    places = ref.select(place).distinct()
    end = lambda pos, a, b: F.struct(pos.cast("long").alias("pos"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    w, start, stop, none = F.col("weight"), F.col("start"), F.col("stop"), F.lit(0)
    # bases up to pos: of each row that starts by then pos + 1 - start, less what lies behind its stop
    ends = (end(start, w, w * start), end(stop + 1, -w, -w * (stop + 1))) if bases else (end(start, w, none), end(stop, none, w))
    events = tests.where("start <= stop").select(*keys, F.explode(F.array(*ends)).alias("e")).select(*keys, "e.*")
    asked = F.array(F.struct(stop.alias("pos"), F.lit(1).alias("sign")), F.struct((start - 1).alias("pos"), F.lit(-1).alias("sign")))
    sums = running_sums(events, places.where("start <= stop + 1").select(*place, F.explode(asked).alias("q")).select(*place, "q.*"), keys)
    n = F.col("sign") * ((F.col("pos") + 1) * F.col("a") - F.col("b")) if bases else F.when(F.col("sign") > 0, F.col("a")).otherwise(-F.col("b"))
    sums = sums.select(*place, n.alias("n"))
    each = (F.least("a_stop", "b_stop") - F.greatest("a_start", "b_start") + 1) * F.col("a_weight") if bases else F.col("a_weight")
    joined = lambda a, b: overlap_join(a, b, ignore_strand).select(*[F.col(f"b_{c}") for c in place], each.alias("n"))
    if not tests.where("start > stop").isEmpty():
        sums = sums.union(joined(tests.where("start > stop"), places))
    if not ref.where("start > stop + 1").isEmpty():
        sums = sums.union(joined(tests.where("start <= stop"), places.where("start > stop + 1")))
    return sums.groupBy(*place).agg(F.sum("n").alias("n"))


def counts(tests: dict[str, DataFrame], ref: DataFrame, ignore_strand: bool = False) -> DataFrame:
    """ref rows with a column for each of tests: its rows that overlap, as ``count`` gives them."""
    out = ref
    for name, test in tests.items():
        sums = _place_sums(test, ref, False, ignore_strand, 1)
        out = out.join(sums, ["chrom", "strand", "start", "stop"], "left").select(*out.columns, F.coalesce("n", F.lit(0)).cast("long").alias(name))
    return out


def _per_ref(test: DataFrame, ref: DataFrame, bases: bool, ignore_strand: bool, most: int) -> DataFrame:
    """ref rows with ``n``, 0 without overlapping test rows. Reference rows at one place share their sum, so the place is the key and no row numbers are needed."""
    sums = _place_sums(test, ref, bases, ignore_strand, most)
    return ref.join(sums, ["chrom", "strand", "start", "stop"], "left").select(*ref.columns, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def count(test: DataFrame, ref: DataFrame, ignore_strand: bool = False, max_label_value: int = 1, least: int = 0) -> DataFrame:
    """ref rows with ``n``: overlapping test rows, or the sum of the numbers their labels begin with up to max_label_value."""
    return _per_ref(test, ref, False, ignore_strand, max_label_value).where(F.col("n") >= least)


def coverage(test: DataFrame, ref: DataFrame, ignore_strand: bool = False, max_label_value: int = 1) -> DataFrame:
    """ref rows with ``n``: overlapping bases, counted for each test row."""
    return _per_ref(test, ref, True, ignore_strand, max_label_value)


def density(test: DataFrame, ref: DataFrame, ignore_strand: bool = False, least: float = 0.0) -> DataFrame:
    """ref rows with ``density``: coverage by the row's bases."""
    out = coverage(test, ref, ignore_strand)
    return out.withColumn("density", F.col("n") / (F.col("stop") - F.col("start") + 1)).drop("n").where(F.col("density") >= least)


def rpkm(test: DataFrame, ref: DataFrame, ignore_strand: bool = False) -> DataFrame:
    """ref rows with ``rpkm``: hits by kilobase and million hits; the library is all hits, NaN for rows without length."""
    hits = count(test, ref, ignore_strand)
    total = hits.agg(F.sum("n").alias("total"))
    size = F.col("stop") - F.col("start") + 1
    value = F.when(size <= 0, float("nan")).otherwise(1000 * F.col("n") / size / (F.col("total") / 1e6))
    return hits.join(F.broadcast(total)).withColumn("rpkm", F.when(F.col("total") == 0, 0.0).otherwise(value)).drop("total", "n")


def offset(test: DataFrame, ref: DataFrame, op: str = "5p", ignore_strand: bool = False, fraction: bool = False, center: bool = False) -> DataFrame:
    """Each pair's test ends counted from the reference row's point, as a part of its size and from its middle if asked."""
    both = overlap_join(test, ref, ignore_strand)
    a, b = (F.struct(F.col(f"{m}_strand").alias("strand"), F.col(f"{m}_start").alias("start"), F.col(f"{m}_stop").alias("stop")) for m in "ab")
    low, high = iv.offsets(a, b, op)
    if center:
        low = high = F.floor((low + high) / 2)
    if fraction:
        size = F.col("b_stop") - F.col("b_start") + 1
        low, high = low / size, high / size
    return both.select("a_label", "b_label", low.alias("low"), high.alias("high"))


def gapless_offset(test: DataFrame, ref: DataFrame) -> DataFrame:
    """Pairs (test point, region) with ``offset`` along the region's intervals, their gaps left out, 0 at its 5' end.

    test has single intervals, of which the start is meant; ref has (label, intervals) on one chromosome and strand.
    """
    pieces = ref.withColumn("rid", F.monotonically_increasing_id()).select("rid", "label", F.posexplode(F.array_sort("intervals")).alias("k", "i"), F.array_sort("intervals").alias("all"))
    before = F.aggregate(F.slice("all", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda s, i: s + iv.size(i))
    pieces = pieces.select("label", "i.*", before.alias("before"), iv.region_size(F.col("all"), True).alias("total"))
    points = test.withColumn("stop", F.col("start"))
    both = overlap_join(points, pieces, points=True)
    along = F.col("b_before") + F.col("a_start") - F.col("b_start")
    return both.select("a_label", "b_label", F.when(F.col("b_strand") == "-", F.col("b_total") - 1 - along).otherwise(along).alias("offset"))


def annotate(test: DataFrame, ref: DataFrame, query_op: str = "1", most: int = 1_000_000, least: int = 10_000, proximal: int | None = None) -> DataFrame:
    """Test rows with the genes they lie in (offset from the 5' end) and whose upstream territory they lie in (from the 3' end of it).

    (label, ref, offset[, class]): class is proximal or distal by the offset's size.
    """
    from lociframe.operators.sets import upstream

    t = F.struct(F.col("a_strand").alias("strand"), F.col("a_start").alias("start"), F.col("a_stop").alias("stop"))
    b = F.struct(F.col("b_strand").alias("strand"), F.col("b_start").alias("start"), F.col("b_stop").alias("stop"))
    point = iv.coordinate(t, query_op)
    at = lambda op, sign: F.when(b.strand == "+", point - iv.coordinate(b, op)).otherwise(iv.coordinate(b, op) - point) * sign
    inside = overlap_join(test, ref, True).select(F.col("a_label").alias("label"), F.col("b_label").alias("ref"), at("5p", 1).alias("offset"))
    above = overlap_join(test, upstream(ref, most, least), True).select(F.col("a_label").alias("label"), F.col("b_label").alias("ref"), at("3p", 1).alias("offset"))
    out = inside.unionByName(above)
    if query_op == "c":
        out = out.where("offset >= 0")
    return out if proximal is None else out.withColumn("class", F.when(F.abs("offset") <= proximal, "proximal").otherwise("distal"))


def annotate_territory(test: DataFrame, ref: DataFrame, upstream: int = 10_000, downstream: int = 10_000, proximal: int = 1000) -> DataFrame:
    """Every test row with each gene whose extended territory it overlaps, or one row NA and intergenic.

    (label, ref, d_start, d_stop, class): distances of the test ends from the gene's 5' end along its
    strand; proximal if the nearest base is within ``proximal`` or the ends lie at both sides of the 5' end, else
    upstream or downstream.
    """
    plus = F.col("strand") == "+"
    wide = ref.select("label", "chrom", "strand", F.greatest(F.lit(1), F.col("start") - F.when(plus, upstream).otherwise(downstream)).alias("start"), (F.col("stop") + F.when(plus, downstream).otherwise(upstream)).alias("stop"), F.when(plus, F.col("start")).otherwise(F.col("stop")).alias("tss"))
    # the pairs, far more than rows, are made by one join and go nowhere after it; rows without any come by themselves
    hits = overlap_join(test, wide, True)
    forward = F.col("b_strand") == "+"
    low = F.when(forward, F.col("a_start") - F.col("b_tss")).otherwise(F.col("b_tss") - F.col("a_stop"))
    high = F.when(forward, F.col("a_stop") - F.col("b_tss")).otherwise(F.col("b_tss") - F.col("a_start"))
    near = (F.least(F.abs(low), F.abs(high)) <= proximal) | ((low < 0) & (high > 0))
    hits = hits.select(F.col("a_label").alias("label"), F.coalesce("b_label", F.lit("NA")).alias("ref"), low.alias("d_start"), high.alias("d_stop"), F.when(near, "proximal").when(high < 0, "upstream").otherwise("downstream").alias("class"))
    none = F.lit(None).cast("long")
    return hits.union(subset(test, wide, True, invert=True).select("label", F.lit("NA"), none, none, F.lit("intergenic")))


def bin_pairs(pairs: DataFrame, ref: DataFrame) -> DataFrame:
    """(id, ref1, ref2): every reference row at a pair's first point with every one at its second; strands do not count."""

    def ends(k: int) -> DataFrame:
        p = pairs.select("id", F.col(f"chrom{k}").alias("chrom"), F.col(f"strand{k}").alias("strand"), F.col(f"pos{k}").cast("long").alias("start"), F.col(f"pos{k}").cast("long").alias("stop"))
        return overlap_join(p, ref, True, points=True).select(F.col("a_id").alias("id"), F.col("b_label").alias(f"ref{k}"))

    return ends(1).join(ends(2), "id")


def reduce(df: DataFrame, ignore_strand: bool = False) -> DataFrame:
    """Regions (row_id, label, intervals) not covered by one of a smaller row_id: covered is each interval overlapping one of it."""
    rows = df.select("row_id", F.posexplode("intervals").alias("k", "i")).select("row_id", "k", "i.*")
    both = overlap_join(rows, rows, ignore_strand).where("b_row_id < a_row_id")
    met = both.select("a_row_id", "b_row_id", "a_k").distinct().groupBy("a_row_id", "b_row_id").agg(F.count("*").alias("met"))
    sizes = df.select(F.col("row_id").alias("a_row_id"), F.size("intervals").alias("n"))
    covered = met.join(sizes, "a_row_id").where("met = n").select(F.col("a_row_id").alias("row_id")).distinct()
    return df.join(covered, "row_id", "left_anti")


def breakpoint_distances(pairs: DataFrame, points: DataFrame, reach: int) -> DataFrame:
    """Pairs with the distance of each end to the nearest of ``points`` (chrom, pos) within ``reach``; null without one.

    Ties go to the smaller position.
    """

    def end(k: int) -> DataFrame:
        p = pairs.select("id", F.col(f"chrom{k}").alias("chrom"), F.lit("+").alias("strand"), (F.col(f"pos{k}") - reach).cast("long").alias("start"), (F.col(f"pos{k}") + reach).cast("long").alias("stop"), F.col(f"pos{k}").cast("long").alias("pos"))
        q = points.select("chrom", F.lit("+").alias("strand"), F.col("pos").cast("long").alias("start"), F.col("pos").cast("long").alias("stop"))
        p = p.withColumn("start", F.greatest("start", F.lit(0)))
        d = F.col("b_start") - F.col("a_pos")
        return overlap_join(p, q, True).groupBy(F.col("a_id").alias("id")).agg(F.min_by(d, F.struct(F.abs(d), F.col("b_start"))).alias(f"d{k}"))

    return pairs.join(end(1), "id", "left").join(end(2), "id", "left")


def shuffled_into(df: DataFrame, ref: DataFrame, seed: int) -> DataFrame:
    """Each row at a random place in the reference rows of its chromosome and strand, as if these stood end to end.

    A row that passes the end of a reference row goes on in the next, so it may give several rows. Rows longer than all
    their reference rows together, or without any, go. The same seed and rows give the same places; equal rows get places
    of their own. The reference is laid end to end by sums of tiles, rows find their pieces by the overlap join.
    """
    at = ["chrom", "strand"]
    sized = ref.select(*at, "start", "stop", "label", (F.col("stop") - F.col("start") + 1).alias("n"), F.shiftright("start", 20).alias("tile"))
    tiles = sized.groupBy(*at, "tile").agg(F.sum("n").alias("all"))
    before = F.coalesce(F.sum("all").over(Window.partitionBy(*at).orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tiles = tiles.select(*at, "tile", before.alias("before"))
    inside = F.sum("n").over(Window.partitionBy(*at, "tile").orderBy("start", "stop", "label").rowsBetween(Window.unboundedPreceding, 0))
    laid = sized.join(tiles, [*at, "tile"]).select(*at, "label", F.col("start").alias("at"), (F.col("before") + inside - F.col("n") + 1).alias("start"), (F.col("before") + inside).alias("stop"))
    room = laid.groupBy(*at).agg(F.max("stop").alias("room"))

    rows = df.groupBy("label", *at, "start", "stop").agg(F.count("*").alias("copies")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    rows = rows.select("label", *at, (F.col("stop") - F.col("start") + 1).alias("n"), F.xxhash64(F.lit(seed), "label", *at, "start", "stop", "copy").alias("draw"))
    rows = rows.join(room, at).where("n <= room").withColumn("start", 1 + F.pmod("draw", F.col("room") - F.col("n") + 1))
    rows = rows.select("label", *at, "start", (F.col("start") + F.col("n") - 1).alias("stop"))
    both = overlap_join(rows, laid)
    moved = lambda c: F.col("b_at") + c - F.col("b_start")
    return both.select(F.col("a_label").alias("label"), F.col("a_chrom").alias("chrom"), F.col("a_strand").alias("strand"), moved(F.greatest("a_start", "b_start")).alias("start"), moved(F.least("a_stop", "b_stop")).alias("stop"))
