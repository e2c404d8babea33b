"""Text formats of regions, alignments, sequences, vectors and matrices, as DataFrames in and out.

Regions are (label, intervals), 1-based with both ends included; files that count from 0 are shifted here.
Compressed text is read by its extension; a list of paths reads as one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import interval as iv

HEADER = r"^(browser|track|#|@(HD|SQ|RG|PG|CO)\t)"


def read_lines(spark: SparkSession, paths: str | list[str], skip_header: bool = True, skip: int = 0) -> DataFrame:
    """Lines as column value; header lines of the formats go, and the first ``skip`` lines of each file."""
    df = spark.read.text(paths)
    if skip:
        first = df.select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
        start = first.where("b = 0").groupBy("f").agg(F.min("n").alias("s"))
        df = first.join(F.broadcast(start), "f").where(F.col("n") >= F.col("s") + skip).select("value")
    if not skip_header:
        return df
    # null where it is a header, so that no filter that is moved before this one can try to parse it
    return df.select(F.when(~F.col("value").rlike(HEADER) & (F.trim("value") != ""), F.col("value")).alias("value")).where("value IS NOT NULL")


def header_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).where(F.col("value").rlike(HEADER))


def sniff_format(spark: SparkSession, path: str) -> str:
    """seq, sam, gff, reg or bed by a file's first lines."""
    lines = [r.value for r in spark.read.text(path).limit(50).collect()]
    for line in lines:
        if line.startswith(("browser", "track")) or not line.strip():
            continue
        if line.startswith("@"):
            return "sam"
        if line.startswith("##"):
            return "gff"
        if line.startswith("#"):
            continue
        if line.startswith(">"):
            return "seq"
        parts = line.split("\t")
        if len(parts) == 2:
            return "reg"
        if len(parts) >= 11 and parts[1].isdigit() and not (len(parts) >= 6 and parts[5] in "+-"):
            return "sam"
        if 8 <= len(parts) <= 10 and parts[3].isdigit() and parts[4].isdigit() and not parts[1].isdigit():
            return "gff"
        return "bed"
    return "bed"


def read_regions(spark: SparkSession, paths: str | list[str], format: str | None = None) -> DataFrame:
    """Regions of files of one format, found by the first file's lines where it is not given."""
    kind = format or sniff_format(spark, paths if isinstance(paths, str) else paths[0])
    return {"reg": read_reg, "bed": read_bed, "sam": read_sam, "gff": read_gff, "seq": read_seq}[kind](spark, paths)


def parse_reg(lines: DataFrame) -> DataFrame:
    """label, tab, then chrom strand start stop for each interval, or chrom strand and comma-separated starts and stops."""
    parts = F.split("value", "\t")
    t = F.split(F.trim(parts[1]), r"\s+")
    starts, stops = F.split(t[2], ","), F.split(t[3], ",")
    compact = F.transform(F.sequence(F.lit(0), F.size(starts) - 1), lambda k: iv.interval(t[0], iv.strand_of(t[1]), F.get(starts, k), F.get(stops, k)))
    regular = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(t) / 4).cast("int") - 1, F.lit(0))), lambda k: iv.interval(F.get(t, 4 * k), iv.strand_of(F.get(t, 4 * k + 1)), F.get(t, 4 * k + 2), F.get(t, 4 * k + 3)))
    return lines.select(parts[0].alias("label"), F.when((F.size(t) == 4) & t[2].contains(","), compact).otherwise(regular).alias("intervals"))


def read_reg(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_reg(read_lines(spark, paths))


def parse_bed(lines: DataFrame) -> DataFrame:
    """BED of 3 to 12 columns with score, thick_start, thick_end and item_rgb where they are; blocks become intervals."""
    p = F.split("value", r"\t| +")
    at = lambda k: F.get(p, F.lit(k))
    strand = F.coalesce(iv.strand_of(at(5)), F.lit("+"))
    start = at(1).cast("long")
    sizes, begins = (F.filter(F.split(at(k), ","), lambda x: x != "") for k in (10, 11))
    blocks = F.zip_with(sizes, begins, lambda n, b: iv.interval(at(0), strand, start + b.cast("long") + 1, start + b.cast("long") + n.cast("long")))
    one = F.array(iv.interval(at(0), strand, start + 1, at(2).cast("long")))
    return lines.select(
        F.coalesce(at(3), F.lit("_")).alias("label"), F.when(F.size(p) >= 12, blocks).otherwise(one).alias("intervals"), at(4).cast("double").alias("score"),
        at(6).cast("long").alias("thick_start"), at(7).cast("long").alias("thick_end"), at(8).alias("item_rgb"), F.size(p).alias("n_columns"),
    )


def read_bed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_bed(read_lines(spark, paths))


def cigar_intervals(chrom: Column, strand: Column, pos: Column, cigar: Column) -> Column:
    """The reference stretches of an alignment: M, D, = and X go along it, N parts it."""
    tokens = F.transform(F.regexp_extract_all(cigar, F.lit("[0-9]+[MIDNSHP=X]"), 0), lambda t: F.struct(F.regexp_extract(t, "[0-9]+", 0).cast("long").alias("n"), F.right(t, F.lit(1)).alias("op")))
    zero = F.struct(pos.alias("start"), pos.alias("at"), F.array().cast(f"array<{iv.INTERVAL}>").alias("done"))

    def step(s: Column, t: Column) -> Column:
        along = F.when(t.op.isin("M", "D", "=", "X", "N"), t.n).otherwise(0)
        cut = t.op == "N"
        return F.struct(F.when(cut, s.at + t.n).otherwise(s.start).alias("start"), (s.at + along).alias("at"), F.when(cut & (s.at > s.start), F.concat(s.done, F.array(iv.interval(chrom, strand, s.start, s.at - 1)))).otherwise(s.done).alias("done"))

    end = lambda s: F.when(s.at > s.start, F.concat(s.done, F.array(iv.interval(chrom, strand, s.start, s.at - 1)))).otherwise(s.done)
    return F.aggregate(tokens, zero, step, end)


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments with their columns and reference intervals; a CIGAR of * is as many matches as the read has bases."""
    p = F.split("value", "\t", 12)
    df = lines.select(
        p[0].alias("label"), p[1].cast("int").alias("flag"), p[2].alias("chrom"), p[3].cast("long").alias("pos"), p[4].cast("int").alias("mapq"), p[5].alias("cigar"),
        p[6].alias("rnext"), p[7].cast("long").alias("pnext"), p[8].cast("long").alias("tlen"), p[9].alias("seq"), p[10].alias("qual"), F.get(p, F.lit(11)).alias("optional"),
    )
    return with_intervals(df)


def with_intervals(df: DataFrame) -> DataFrame:
    """Alignments' columns with their reference intervals."""
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    cigar = F.when(F.col("cigar") == "*", F.concat(F.length("seq").cast("string"), F.lit("M"))).otherwise(F.col("cigar"))
    return df.withColumn("intervals", cigar_intervals(F.col("chrom"), strand, F.col("pos"), cigar))


def read_bam(spark: SparkSession, path: str, split: int | None = None) -> DataFrame:
    """Alignments of a BAM file, or a folder of them, as ``read_sam`` gives them; files are read in ranges of ``split`` bytes."""
    from lociframe.sources import bam

    spark.dataSource.register(bam.BamSource)
    return with_intervals(spark.read.format("bam").option("split", split or bam.SPLIT).load(path))


def write_bam(df: DataFrame, path: str, references: dict[str, int]) -> None:
    """Alignments as BAM files in a folder, one for each task; references are the header's names and sizes."""
    from lociframe.sources import bam

    df.sparkSession.dataSource.register(bam.BamSource)
    columns = [c.split()[0] for c in bam.SCHEMA.split(", ")]
    df.select(*columns).write.format("bam").option("references", ",".join(f"{n}:{s}" for n, s in references.items())).mode("append").save(path)


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_sam(read_lines(spark, paths))


def parse_gff(lines: DataFrame) -> DataFrame:
    p = F.split("value", "\t")
    at = lambda k: F.get(p, F.lit(k))
    strand = F.coalesce(iv.strand_of(at(6)), F.lit("+"))
    return lines.select(F.coalesce(at(8), at(2)).alias("label"), F.array(iv.interval(at(0), strand, at(3), at(4))).alias("intervals"), at(1).alias("source"), at(2).alias("feature"), at(5).alias("score"), at(7).alias("frame"), at(9).alias("comment"))


def read_gff(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_gff(read_lines(spark, paths))


def read_seq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of a region line after > and lines of sequence."""
    rec = spark.read.option("lineSep", ">").text(paths).where(F.trim("value") != "")
    lines = F.split("value", "\n")
    rows = rec.select(F.element_at(lines, 1).alias("value"), F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), "").alias("seq"))
    t = F.split(F.trim(F.element_at(F.split("value", "\t"), 2)), r"\s+")
    found = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(t) / 4).cast("int") - 1, F.lit(0))), lambda k: iv.interval(F.get(t, 4 * k), iv.strand_of(F.get(t, 4 * k + 1)), F.get(t, 4 * k + 2), F.get(t, 4 * k + 3)))
    return rows.select(F.element_at(F.split("value", "\t"), 1).alias("label"), found.alias("intervals"), "seq")


def read_chromosomes(spark: SparkSession, paths: str | list[str], width: int = 1 << 16) -> DataFrame:
    """Chromosomes of FASTA files in chunks (chrom, chunk, width, seq), so that no row holds a whole genome's join key."""
    rec = spark.read.option("lineSep", ">").text(paths).where(F.trim("value") != "")
    lines = F.split("value", "\n")
    seq = F.regexp_replace(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), ""), r"\s", "")
    rows = rec.select(F.trim(F.element_at(F.split(F.element_at(lines, 1), r"\s"), 1)).alias("chrom"), seq.alias("s")).where(F.length("s") > 0)
    rows = rows.select("chrom", "s", F.explode(F.sequence(F.lit(0), F.floor((F.length("s") - 1) / width).cast("int"))).alias("k"))
    return rows.select("chrom", F.col("k").cast("long").alias("chunk"), F.lit(width).alias("width"), F.substring("s", F.col("k") * width + 1, F.lit(width)).alias("seq"))


def read_bounds(spark: SparkSession, paths: str | list[str], format: str | None = None) -> DataFrame:
    """(chrom, size) of regions of one interval a chromosome; different sizes of one chromosome are an error when it is read."""
    rows = read_regions(spark, paths, format).select(F.explode("intervals").alias("i")).groupBy(F.col("i.chrom").alias("chrom")).agg(F.min("i.stop").alias("lo"), F.max("i.stop").alias("size"))
    checked = F.when(F.col("lo") == F.col("size"), F.col("size")).otherwise(F.raise_error(F.concat(F.lit("different sizes of "), "chrom")).cast("long"))
    return rows.select("chrom", checked.alias("size"))


def parse_vectors(lines: DataFrame) -> DataFrame:
    """(label, v) of lines label, tab, numbers; lines without a tab have the label of their text's hash. What is no number is NaN."""
    p = F.split("value", "\t", 2)
    has = F.size(p) > 1
    numbers = F.split(F.trim(F.when(has, F.get(p, F.lit(1))).otherwise(p[0])), r"\s+")
    v = F.transform(F.filter(numbers, lambda x: x != ""), lambda x: F.coalesce(F.when(x.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), x).cast("double"), F.when(F.lower(x).isin("inf", "+inf"), float("inf")), F.lit(float("nan"))))
    return lines.select(F.when(has, p[0]).otherwise(F.sha1("value")).alias("label"), v.alias("v"))


def read_vectors(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_vectors(read_lines(spark, paths, False))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)


# writing: each gives lines (value), which write.text takes ----------------------------------------


def reg_lines(df: DataFrame, compact: bool = False) -> DataFrame:
    first = F.col("intervals")[0]
    text = lambda c: F.transform("intervals", lambda i: i[c].cast("string"))
    body = F.concat_ws(" ", first.chrom, first.strand, F.array_join(text("start"), ","), F.array_join(text("stop"), ",")) if compact else F.array_join(F.transform("intervals", lambda i: F.concat_ws(" ", i.chrom, i.strand, i.start.cast("string"), i.stop.cast("string"))), " ")
    return df.select(F.concat_ws("\t", "label", body).alias("value"))


def bed_lines(df: DataFrame, score: int = 1000, color: str = "0,0,0", prefix: bool = False) -> DataFrame:
    """BED of six columns, or of twelve for regions of several intervals; prefix writes chr before the chromosome and M for MT."""
    first, n = F.col("intervals")[0], F.size("intervals")
    chrom = F.when(F.lit(prefix), F.concat(F.lit("chr"), F.when(first.chrom == "MT", "M").otherwise(first.chrom))).otherwise(first.chrom)
    start, stop = F.array_min("intervals.start") - 1, F.array_max("intervals.stop")
    six = F.concat_ws("\t", chrom, start.cast("string"), stop.cast("string"), "label", F.lit(str(score)), first.strand)
    sizes = F.array_join(F.transform("intervals", lambda i: iv.size(i).cast("string")), ",")
    begins = F.array_join(F.transform("intervals", lambda i: (i.start - 1 - start).cast("string")), ",")
    twelve = F.concat_ws("\t", six, start.cast("string"), stop.cast("string"), F.lit(color), n.cast("string"), sizes, begins)
    return df.select(F.when(n > 1, twelve).otherwise(six).alias("value"))


def bed_rows(df: DataFrame) -> DataFrame:
    """BED lines of the rows of parse_bed after edits, with as many columns as came in (``n_columns``).

    The thick part shrinks to the new ends; where nothing of it is left it is empty at the start.
    """
    first = F.col("intervals")[0]
    start, stop = first.start - 1, F.element_at("intervals", -1).stop
    thick, end = F.greatest(F.coalesce("thick_start", start), start), F.least(F.coalesce("thick_end", stop), stop)
    text = lambda c: F.coalesce(c.cast("string"), F.lit("0"))
    sizes = F.array_join(F.transform("intervals", lambda i: iv.size(i).cast("string")), ",")
    begins = F.array_join(F.transform("intervals", lambda i: (i.start - 1 - start).cast("string")), ",")
    all_ = F.array(
        first.chrom, text(start), text(stop), F.col("label"), text(F.col("score").cast("long")), first.strand, text(F.when(end <= thick, start).otherwise(thick)), text(F.when(end <= thick, start).otherwise(end)),
        F.coalesce("item_rgb", F.lit("0")), F.size("intervals").cast("string"), sizes, begins,
    )
    return df.where(F.size("intervals") > 0).select(F.array_join(F.slice(all_, F.lit(1), F.least(F.lit(12), "n_columns")), "\t").alias("value"))


def gff_lines(df: DataFrame) -> DataFrame:
    """Lines of the rows of parse_gff after edits, one for each interval; label and comment stand where they are."""
    i = F.col("i")
    return df.withColumn("i", F.explode("intervals")).select(F.concat_ws("\t", i.chrom, "source", "feature", i.start.cast("string"), i.stop.cast("string"), "score", i.strand, "frame", "label", "comment").alias("value"))


def clipped_gff(df: DataFrame, start: Column, stop: Column, label: Column | None = None) -> DataFrame:
    """Rows of parse_gff cut to bases start to stop; those that do not reach there go; a label is joined by a colon."""
    i = F.col("intervals")[0]
    rows = df.withColumns({"_a": F.greatest(i.start, start), "_b": F.least(i.stop, stop)}).where("_a <= _b")
    rows = rows.withColumn("intervals", F.array(iv.interval(i.chrom, i.strand, F.col("_a"), F.col("_b"))))
    return (rows if label is None else rows.withColumn("label", F.concat_ws(":", "label", label))).select(df.columns)


def wiggle_values(df: DataFrame, scale: float = 1.0, center: bool = False) -> DataFrame:
    """(chrom, start, value): labels as numbers, at starts or middles."""
    i = F.col("i")
    at = iv.coordinate(i, "c") if center else i.start
    return df.select("label", F.explode("intervals").alias("i")).select(i.chrom.alias("chrom"), at.alias("start"), (F.coalesce(F.expr("try_cast(label AS double)"), F.lit(0.0)) * scale).alias("value"))


def wiggle_lines(df: DataFrame, span: int = 1) -> DataFrame:
    """Lines of a variableStep track from (chrom, start, value), in order: a header before each chromosome's first line."""
    head = df.select("chrom").distinct().select(F.col("chrom"), F.lit(-1).cast("long").alias("start"), F.concat(F.lit("variableStep chrom="), "chrom", F.lit(f" span={span}")).alias("value"))
    rows = df.select("chrom", "start", F.concat_ws(" ", F.col("start").cast("string"), F.col("value").cast("string")).alias("value"))
    return head.union(rows).orderBy("chrom", "start").select("value")


def bedgraph_lines(df: DataFrame) -> DataFrame:
    """Lines of (chrom, start, stop, value)."""
    return df.select(F.concat_ws("\t", "chrom", (F.col("start") - 1).cast("string"), F.col("stop").cast("string"), F.col("value").cast("string")).alias("value"))


def sam_lines(df: DataFrame) -> DataFrame:
    cols = ["label", "flag", "chrom", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "optional"]
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in cols]).alias("value"))


def edited_sam(df: DataFrame) -> DataFrame:
    """Alignments whose intervals were changed: CIGAR and position from the intervals, pairing, bases and optional fields dropped."""
    later = F.slice("intervals", F.lit(2), F.greatest(F.size("intervals") - 1, F.lit(0)))
    pairs = F.zip_with(F.slice("intervals", F.lit(1), F.greatest(F.size("intervals") - 1, F.lit(0))), later, lambda a, b: F.concat((b.start - a.stop - 1).cast("string"), F.lit("N"), iv.size(b).cast("string"), F.lit("M")))
    first = F.col("intervals")[0]
    flag = F.when(first.strand == "-", F.col("flag").bitwiseOR(16)).otherwise(F.col("flag").bitwiseAND(~16))
    return df.withColumns({
        "cigar": F.concat(iv.size(first).cast("string"), F.lit("M"), F.array_join(pairs, "")), "pos": first.start, "chrom": first.chrom, "flag": flag, "mapq": F.lit(255),
        "pnext": F.lit(0).cast("long"), "tlen": F.lit(0).cast("long"), "seq": F.lit("*"), "qual": F.lit("*"), "optional": F.lit(None).cast("string"),
    })


def matrix_lines(cells: DataFrame) -> DataFrame:
    """Lines locus1, locus2, count of bounded cells, sorted; absent cells are zero."""
    return cells.orderBy("locus1", "locus2").select(F.concat_ws("\t", "locus1", "locus2", F.col("n").cast("string")).alias("value"))


# alignment files' own operations -----------------------------------------------------------------


def view(df: DataFrame, need: int = 0, avoid: int = 0, mapq: int = 0, chrom: str | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    flag = F.col("flag")
    ok = (flag.bitwiseAND(need) == need) & (flag.bitwiseAND(avoid) == 0) & (F.col("mapq") >= mapq)
    if chrom is not None:
        ok &= F.exists("intervals", lambda i: (i.chrom == chrom) & (i.start <= (stop or (1 << 40))) & (i.stop >= (start or 1)))
    return df.where(ok)


def flag_stats(df: DataFrame) -> DataFrame:
    """One row of counts by flag bits."""
    has = lambda b: F.col("flag").bitwiseAND(b) == b
    one = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    mapped = F.col("flag").bitwiseAND(4) == 0
    return df.agg(
        F.count("*").alias("total"), one(has(256)).alias("secondary"), one(has(2048)).alias("supplementary"), one(has(1024)).alias("duplicates"), one(mapped).alias("mapped"), one(has(1)).alias("paired"),
        one(has(1) & has(64)).alias("read1"), one(has(1) & has(128)).alias("read2"), one(has(1) & has(2) & mapped).alias("proper"), one(has(1) & mapped & (F.col("flag").bitwiseAND(8) == 0)).alias("both_mapped"), one(has(1) & mapped & has(8)).alias("singletons"),
    )


def index_stats(df: DataFrame) -> DataFrame:
    mapped = F.col("flag").bitwiseAND(4) == 0
    return df.groupBy("chrom").agg(F.sum(mapped.cast("long")).alias("mapped"), F.sum((~mapped).cast("long")).alias("unmapped"))


def fastq_lines(df: DataFrame) -> DataFrame:
    back = F.col("flag").bitwiseAND(16) != 0
    seq = F.when(back, F.reverse(F.translate("seq", "ACGTacgt", "TGCAtgca"))).otherwise(F.col("seq"))
    return df.select(F.concat_ws("\n", F.concat(F.lit("@"), "label"), seq, F.lit("+"), F.when(back, F.reverse("qual")).otherwise(F.col("qual"))).alias("value"))


def without_duplicates(df: DataFrame) -> DataFrame:
    """Of alignments with one chromosome, 5' end and strand the one with the largest sum of base qualities, then the first by name."""
    back = F.col("flag").bitwiseAND(16) != 0
    five = F.when(back, F.element_at("intervals", -1).stop).otherwise(F.element_at("intervals", 1).start)
    total = F.aggregate(F.split("qual", ""), F.lit(0), lambda s, c: s + F.when(c != "", F.ascii(c) - 33).otherwise(0))
    best = F.min_by(F.struct(*df.columns), F.struct((-total).alias("t"), "label", "flag"))
    return df.groupBy(F.col("chrom").alias("_c"), five.alias("_f"), back.alias("_b")).agg(best.alias("r")).select("r.*")


def mates(df: DataFrame) -> DataFrame:
    """rnext, pnext and tlen of pairs filled in from the mate of the same name."""
    first = F.col("flag").bitwiseAND(64) != 0
    m = df.groupBy("label").agg(F.max_by(F.struct("chrom", "pos", F.element_at("intervals", -1).stop.alias("stop")), F.when(first, 1)).alias("a"), F.max_by(F.struct("chrom", "pos", F.element_at("intervals", -1).stop.alias("stop")), F.when(~first, 1)).alias("b"))
    rows = df.join(m, "label")
    other = F.when(first, F.col("b")).otherwise(F.col("a"))
    low, high = F.least("a.pos", "b.pos"), F.greatest("a.stop", "b.stop")
    span = F.when((F.col("a.chrom") == F.col("b.chrom")) & F.col("b").isNotNull(), high - low + 1).otherwise(0)
    sign = F.when(F.col("pos") == low, 1).otherwise(-1)
    return rows.withColumns({"rnext": F.when(other.isNull(), "*").when(other.chrom == F.col("chrom"), "=").otherwise(other.chrom), "pnext": F.coalesce(other.pos, F.lit(0).cast("long")), "tlen": (span * sign).cast("long")}).select(df.columns)


def depth(df: DataFrame) -> DataFrame:
    """(chrom, start, stop, depth): stretches of one coverage over 0, from +1 and -1 where intervals begin and end.

    Events are summed by place before the running sum; chromosomes are cut into tiles whose sums carry over.
    """
    from pyspark.sql import Window

    i = df.select(F.explode("intervals").alias("i")).select("i.*")
    ev = i.select("chrom", F.col("start").alias("p"), F.lit(1).alias("v")).union(i.select("chrom", F.col("stop") + 1, F.lit(-1)))
    ev = ev.groupBy("chrom", "p").agg(F.sum("v").alias("v")).withColumn("t", F.shiftright("p", 20))
    tiles = ev.groupBy("chrom", "t").agg(F.sum("v").alias("s"), F.min("p").alias("first"))
    w = Window.partitionBy("chrom").orderBy("t")
    tiles = tiles.select("chrom", "t", F.coalesce(F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.lead("first").over(w).alias("next"))
    w = Window.partitionBy("chrom", "t").orderBy("p")
    rows = ev.join(tiles, ["chrom", "t"]).select("chrom", F.col("p").alias("start"), (F.coalesce(F.lead("p").over(w), F.col("next")) - 1).alias("stop"), (F.sum("v").over(w) + F.col("before")).alias("depth"))
    return rows.where("depth > 0")
