"""Queries and SQL of the formats, the composed pipelines and the streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociframe.operators import alignments as al
from lociframe.operators import contact as ct
from lociframe.operators import overlap as ov
from lociframe.operators import pairs as pr
from lociframe.operators import regions as rg
from lociframe.functions import arrays as ar
from lociframe.operators import matrix as mx
from lociframe.operators import tables as tb
from lociframe.plans import pipelines as pl
from lociframe.plans.cell_queries import CELLS, CON, DOM, FRAG, KIND, OTHER, SIZES, _ctes
from lociframe.plans.region_queries import ANY, HIT, LINKED
from lociframe.plans.table_queries import SHEET, SHEET_SQL, loess_sql
from lociframe.sources import formats as fm
from lociframe.sources.fixtures import fixture, regions, single, table
from lociframe.sources.scratch import folder

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


READS, REFS, GENOME, PAIRS = (lambda s, d, t=t: fixture(s, d, t) for t in ("reads", "refs", "bounds", "pairs"))
FLAT = "SELECT label, k, chrom, strand, start_ AS start, stop_ AS stop FROM exons"

# formats: what is written is read again ------------------------------------------------------------
add("io05_reg", lambda s, d: rg.flat(fm.parse_reg(fm.reg_lines(regions(s, d)))), _ctes("exons") + FLAT)
add("io05_reg_compact", lambda s, d: rg.flat(fm.parse_reg(fm.reg_lines(regions(s, d), True))), _ctes("exons") + FLAT)
add("io06_bed12", lambda s, d: rg.flat(fm.parse_bed(fm.bed_lines(regions(s, d)))), _ctes("exons") + FLAT)
add("io06_bed6", lambda s, d: rg.flat(fm.parse_bed(fm.bed_lines(single(READS(s, d))))).drop("k"), _ctes("reads") + "SELECT label, chrom, strand, start_ AS start, stop_ AS stop FROM reads")
add("io14_reg_sink", lambda s, d: fm.reg_lines(single(REFS(s, d))), _ctes("refs") + "SELECT concat(label, chr(9), chrom, ' ', strand, ' ', start_, ' ', stop_) AS value FROM refs")
add("io15_bed_sink", lambda s, d: fm.bed_lines(single(REFS(s, d))), _ctes("refs") + "SELECT concat(chrom, chr(9), start_ - 1, chr(9), stop_, chr(9), label, chr(9), '1000', chr(9), strand) AS value FROM refs")
add("io16_wiggle", lambda s, d: fm.wiggle_values(single(READS(s, d)), 2.0, True), _ctes("reads") + "SELECT chrom, start_ + (stop_ - start_) // 2 AS start, cast(label AS double) * 2 AS value FROM reads")
add("io17_bedgraph", lambda s, d: fm.bedgraph_lines(REFS(s, d).select("chrom", "start", "stop", F.length("label").alias("value"))), _ctes("refs") + "SELECT concat(chrom, chr(9), start_ - 1, chr(9), stop_, chr(9), length(label)) AS value FROM refs")
SAM = lambda s, d: fm.parse_sam(REFS(s, d).select(F.concat_ws("\t", "label", F.when(F.col("strand") == "-", "16").otherwise("0"), "chrom", F.col("start").cast("string"), (F.col("start") % 60).cast("string"), F.concat(F.lit("5S20M"), F.col("start") % 90 + 1, F.lit("N3D10M2I4=")), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*")).alias("value")))
add("io07_sam", lambda s, d: rg.flat(SAM(s, d)), _ctes("refs") + "SELECT label, k, chrom, strand, CASE k WHEN 0 THEN start_ ELSE start_ + 20 + start_ % 90 + 1 END AS start, CASE k WHEN 0 THEN start_ + 19 ELSE start_ + 20 + start_ % 90 + 1 + 16 END AS stop FROM refs CROSS JOIN (VALUES (0), (1)) AS ks(k)")
add("io18_sam_sink", lambda s, d: rg.flat(fm.parse_sam(fm.sam_lines(fm.edited_sam(rg.shift(SAM(s, d), 5, 5))))).where("k = 1"), _ctes("refs") + "SELECT label, 1 AS k, chrom, strand, start_ + 26 + start_ % 90 AS start, start_ + 42 + start_ % 90 AS stop FROM refs")
add("io09_gff", lambda s, d: rg.flat(fm.parse_gff(REFS(s, d).select(F.concat_ws("\t", "chrom", F.lit("src"), F.lit("gene"), F.col("start").cast("string"), F.col("stop").cast("string"), F.lit("."), "strand", F.lit("."), "label").alias("value")))), _ctes("refs") + "SELECT label, 0 AS k, chrom, strand, start_ AS start, stop_ AS stop FROM refs")
add("io19_vectors", lambda s, d: fm.parse_vectors(table(s, d, "embeddings").select(F.concat_ws("\t", F.col("vec_id").cast("string"), F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 100).cast("int").cast("string")), " ")).alias("value"))).select("label", F.posexplode("v").alias("i", "x")), "SELECT cast(vec_id AS varchar) AS label, cast(generate_subscripts(embedding, 1) - 1 AS int) AS i, round(cast(unnest(embedding) AS double) * 100) + cast(0 AS double) AS x FROM embeddings")
add("io20_matrix_sink", lambda s, d: fm.matrix_lines(pr.bin_bounds(pr.bin_matrix(PAIRS(s, d), 100000), GENOME(s, d), 100000)).agg(F.count("*").alias("n")), _ctes("pairs") + "SELECT count(*) AS n FROM (SELECT DISTINCT * FROM (SELECT chrom1 AS a, (pos1 - 1) // 100000 AS i, chrom2 AS b, (pos2 - 1) // 100000 AS j FROM pairs UNION ALL SELECT chrom2, (pos2 - 1) // 100000, chrom1, (pos1 - 1) // 100000 FROM pairs) AS u) AS v")
add("s01_view", lambda s, d: fm.view(SAM(s, d), avoid=16, mapq=30, chrom="chr2").select("label"), _ctes("refs") + "SELECT label FROM refs WHERE strand = '+' AND start_ % 60 >= 30 AND chrom = 'chr2'")
add("s06_idxstats", lambda s, d: fm.index_stats(SAM(s, d)), _ctes("refs") + "SELECT chrom, count(*) AS mapped, cast(0 AS bigint) AS unmapped FROM refs GROUP BY chrom")
add("s12_depth", lambda s, d: fm.depth(single(READS(s, d))), _ctes("reads") + ", e AS (SELECT chrom, start_ AS p, 1 AS v FROM reads UNION ALL SELECT chrom, stop_ + 1, -1 FROM reads), g AS (SELECT chrom, p, sum(v) AS v FROM e GROUP BY chrom, p), r AS (SELECT chrom, p AS start, lead(p) OVER w - 1 AS stop, cast(sum(v) OVER w AS bigint) AS depth FROM g WINDOW w AS (PARTITION BY chrom ORDER BY p)) SELECT * FROM r WHERE depth > 0")
READSAM = lambda s, d: fm.parse_sam(PAIRS(s, d).select(F.explode(F.array(*[F.concat_ws("\t", F.col("id").cast("string"), F.when(F.col(f"strand{k}") == "-", str(17 + 64 * k)).otherwise(str(1 + 64 * k)), f"chrom{k}", (F.floor(F.col(f"pos{k}") / 50) * 50 + 1).cast("string"), F.lit("30"), F.lit("4M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.concat(F.chr(F.lit(40) + F.col("id") % 30), F.lit("III")), ) for k in (1, 2)])).alias("value")))
add("s03_fastq", lambda s, d: fm.fastq_lines(READSAM(s, d)).select(F.md5("value").alias("m")), _ctes("pairs") + ", r AS (SELECT id, strand1 AS strand FROM pairs UNION ALL SELECT id, strand2 FROM pairs) SELECT md5(concat('@', id, chr(10), 'ACGT', chr(10), '+', chr(10), CASE strand WHEN '-' THEN concat('III', chr(cast(40 + id % 30 AS int))) ELSE concat(chr(cast(40 + id % 30 AS int)), 'III') END)) AS m FROM r")
add("s08_fixmate", lambda s, d: fm.mates(READSAM(s, d)).select("label", "flag", "rnext", "pnext", "tlen"), _ctes("pairs") + ", e AS (SELECT id, 1 AS k, strand1 AS strand, chrom1 AS chrom, (pos1 // 50) * 50 + 1 AS p, chrom2 AS c2, (pos2 // 50) * 50 + 1 AS p2 FROM pairs UNION ALL SELECT id, 2, strand2, chrom2, (pos2 // 50) * 50 + 1, chrom1, (pos1 // 50) * 50 + 1 FROM pairs) SELECT cast(id AS varchar) AS label, cast(CASE WHEN strand = '-' THEN 17 ELSE 1 END + 64 * k AS int) AS flag, CASE WHEN chrom = c2 THEN '=' ELSE c2 END AS rnext, p2 AS pnext, CASE WHEN chrom = c2 THEN (abs(p - p2) + 4) * CASE WHEN p <= p2 THEN 1 ELSE -1 END ELSE 0 END AS tlen FROM e")
add("s09_rmdup", lambda s, d: fm.without_duplicates(READSAM(s, d)).select("label", "flag", "chrom", "pos", "qual"), _ctes("pairs") + ", e AS (SELECT id, 1 AS k, strand1 AS strand, chrom1 AS chrom, (pos1 // 50) * 50 + 1 AS p FROM pairs UNION ALL SELECT id, 2, strand2, chrom2, (pos2 // 50) * 50 + 1 FROM pairs), f AS (SELECT cast(id AS varchar) AS label, cast(CASE WHEN strand = '-' THEN 17 ELSE 1 END + 64 * k AS int) AS flag, chrom, p AS pos, concat(chr(cast(40 + id % 30 AS int)), 'III') AS qual, row_number() OVER (PARTITION BY chrom, strand, p ORDER BY id % 30 DESC, cast(id AS varchar), 64 * k) AS n FROM e) SELECT label, flag, chrom, pos, qual FROM f WHERE n = 1")


def on_disk(lines, name, compression="none", files=None):
    """A new path in the shared folder that holds the lines as text files."""
    path = folder(lines.sparkSession, name)
    (lines if files is None else lines.coalesce(files)).write.text(path, compression=compression)
    return path


def with_heads(lines, *heads):
    return lines.sparkSession.createDataFrame([(h,) for h in heads], "value string").union(lines)


REFLAT = _ctes("refs") + "SELECT label, 0 AS k, chrom, strand, start_ AS start, stop_ AS stop FROM refs"
add("io01_text", lambda s, d: rg.flat(fm.read_regions(s, on_disk(with_heads(fm.reg_lines(single(REFS(s, d))), "# notes"), "text"))), REFLAT)
add("io02_gzip", lambda s, d: rg.flat(fm.read_regions(s, on_disk(fm.reg_lines(single(REFS(s, d))), "zipped", "gzip"))), REFLAT)
add("io04_factory", lambda s, d: rg.flat(fm.read_regions(s, on_disk(with_heads(fm.bed_lines(single(REFS(s, d))), "track name=x", "browser position chr1"), "bed", files=1))), REFLAT)
add("io10_seq", lambda s, d: fm.read_seq(s, on_disk(REFS(s, d).select(F.concat(F.lit(">"), "label", F.lit("\t"), F.concat_ws(" ", "chrom", "strand", F.col("start").cast("string"), F.col("stop").cast("string")), F.lit("\nACGT"), F.lpad(F.lit(""), 3, "N"), "label").alias("value")), "seq")).select("label", "seq", F.explode("intervals").alias("i")).select("label", "seq", "i.*"), _ctes("refs") + "SELECT label, concat('ACGTNNN', label) AS seq, chrom, strand, start_ AS start, stop_ AS stop FROM refs")
REACHED = lambda s, d: READS(s, d).groupBy("chrom").agg(F.max("stop").alias("size"))
add("io11_bounds", lambda s, d: fm.read_bounds(s, on_disk(REACHED(s, d).select(F.concat_ws("\t", "chrom", F.concat_ws(" ", "chrom", F.lit("+"), F.lit("1"), F.col("size").cast("string"))).alias("value")), "bounds")), _ctes("reads") + "SELECT chrom, max(stop_) AS size FROM reads GROUP BY chrom")
LETTERS = lambda c: F.translate(F.md5(c), "0123456789abcdef", "ACGTACGTACGTACGN")
add("io12_fasta", lambda s, d: fm.read_chromosomes(s, on_disk(REFS(s, d).select(F.concat(F.lit(">"), "label", F.lit(" note\n"), LETTERS(F.col("label")), F.lit("\n"), LETTERS(F.col("chrom")), F.substring(LETTERS(F.concat("label", "chrom")), 1, 15), F.lit("\n")).alias("value")), "fasta"), 64).select("chrom", "chunk", "seq"), _ctes("refs") + ", q AS (SELECT label, concat(translate(md5(label), '0123456789abcdef', 'ACGTACGTACGTACGN'), translate(md5(chrom), '0123456789abcdef', 'ACGTACGTACGTACGN'), translate(md5(concat(label, chrom)), '0123456789abcdef', 'ACGTACGTACGTACGN')[1:15]) AS seq FROM refs) SELECT label AS chrom, k AS chunk, substr(seq, cast(64 * k + 1 AS int), 64) AS seq FROM q CROSS JOIN range(2) AS ks(k)")
add("io13_header", lambda s, d: fm.header_lines(s, on_disk(with_heads(fm.bed_lines(single(REFS(s, d))), "track name=x", "# y", "@SQ\tSN:chr1"), "heads")), "SELECT * FROM (VALUES ('track name=x'), ('# y'), (concat('@SQ', chr(9), 'SN:chr1'))) AS v(value)")
add("io24_concat", lambda s, d: rg.flat(fm.read_regions(s, [on_disk(fm.reg_lines(single(REFS(s, d).where("strand = '+'"))), "plus", "gzip"), on_disk(fm.reg_lines(single(REFS(s, d).where("strand = '-'"))), "minus")], "reg")), REFLAT)
add("io25_skip", lambda s, d: fm.read_lines(s, on_disk(with_heads(REFS(s, d).select("label"), "a", "b").coalesce(1).sortWithinPartitions("value"), "skip"), skip=2).agg(F.count("*").alias("n"), F.min("value").alias("first")), _ctes("refs") + "SELECT count(*) AS n, min(label) AS first FROM refs")
add("m13_shuffle", lambda s, d: mx.shuffled(table(s, d, "embeddings").select(F.col("vec_id").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("v")), 3).select("label", F.posexplode(F.array_sort("v")).alias("i", "x")), "SELECT vec_id AS label, cast(generate_subscripts(embedding, 1) - 1 AS int) AS i, unnest(list_sort([cast(x AS double) FOR x IN embedding])) AS x FROM embeddings")
add("t04_numbers", lambda s, d: tb.numbers(table(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, "NAN").otherwise(F.col("p_size").cast("string")).alias("x")), ["x"]).select("p_partkey", F.isnan("x").alias("none"), F.when(~F.isnan("x"), F.col("x")).alias("x")), "SELECT p_partkey, p_size % 3 <> 2 AS \"none\", CASE WHEN p_size % 3 = 2 THEN cast(p_size AS double) END AS x FROM part")
add("t04_triangle", lambda s, d: tb.upper_triangle(fixture(s, d, "triples").select(F.col("k2").alias("k1"), F.lower("k2").alias("k2"), "value").union(fixture(s, d, "triples").select(F.lit("A").alias("k1"), "k2", "value"))).groupBy("k1", "k2").agg(F.count("*").alias("n")), _ctes("triples") + "SELECT k1, k2, count(*) AS n FROM (SELECT k2 AS k1, lower(k2) AS k2 FROM triples UNION ALL SELECT 'A', k2 FROM triples) AS t WHERE k1 < k2 GROUP BY k1, k2")
BAGS = lambda s, d: table(s, d, "orders").select("o_orderkey", *[ar.parsed(F.concat_ws(" ", *[(F.col("o_orderkey") * m % n).cast("string") for m, n in x])).alias(c) for c, x in (("a", ((3, 5), (7, 4), (1, 3), (11, 6))), ("b", ((1, 5), (5, 7), (2, 3))))])
BAGS_SQL = "WITH bags AS (SELECT o_orderkey, [o_orderkey * 3 % 5, o_orderkey * 7 % 4, o_orderkey % 3, o_orderkey * 11 % 6] AS a, [o_orderkey % 5, o_orderkey * 5 % 7, o_orderkey * 2 % 3] AS b FROM orders) "
add("l01_sorted", lambda s, d: BAGS(s, d).select("o_orderkey", ar.is_sorted(F.col("a")).alias("ok"), F.array_join(F.array_sort("a"), " ").alias("v")), BAGS_SQL + "SELECT o_orderkey, a = list_sort(a) AS ok, array_to_string(list_sort(a), ' ') AS v FROM bags")
add("l02_bag", lambda s, d: BAGS(s, d).select("o_orderkey", F.explode(ar.bag(F.col("a"))).alias("x")).select("o_orderkey", "x.value", F.col("x.n").cast("long").alias("n")), BAGS_SQL + "SELECT o_orderkey, value, count(*) AS n FROM (SELECT o_orderkey, unnest(a) AS value FROM bags) AS u GROUP BY o_orderkey, value")
add("l03_unique", lambda s, d: BAGS(s, d).select("o_orderkey", F.array_join(ar.unique(F.col("a")), " ").alias("v")), BAGS_SQL + "SELECT o_orderkey, array_to_string(list_sort(list_distinct(a)), ' ') AS v FROM bags")
add("l04_intersection", lambda s, d: BAGS(s, d).select("o_orderkey", F.array_join(ar.bag_intersection(F.col("a"), F.col("b")), " ").alias("v")), BAGS_SQL + "SELECT o_orderkey, array_to_string(list_sort(list_concat([x FOR x IN a IF list_contains(b, x)], [x FOR x IN b IF list_contains(a, x)])), ' ') AS v FROM bags")
add("l05_union", lambda s, d: BAGS(s, d).select("o_orderkey", F.array_join(ar.bag_union(F.col("a"), F.col("b")), " ").alias("v")), BAGS_SQL + "SELECT o_orderkey, array_to_string(list_sort(list_concat(a, b)), ' ') AS v FROM bags")
add("l06_product", lambda s, d: BAGS(s, d).select("o_orderkey", F.arrays_overlap("a", "b").alias("meet"), ar.product(F.col("a")).alias("p")), BAGS_SQL + "SELECT o_orderkey, list_has_any(a, b) AS meet, a[1] * a[2] * a[3] * a[4] AS p FROM bags")

# alignments with bases, and files that keep their columns --------------------------------------------
BASES = "AACCGGTTACGTACGTAGGATTCCAGTGACTTGACCATGCA"  # 41: 5 clipped, 20 + 10 + 4 along the reference, 2 inserted
WITH_BASES = lambda s, d, cigar: fm.parse_sam(REFS(s, d).select(F.concat_ws("\t", "label", F.when(F.col("strand") == "-", "16").otherwise("0"), "chrom", F.col("start").cast("string"), F.lit("30"), F.lit(cigar), F.lit("*"), F.lit("0"), F.lit("9"), F.lit(BASES), F.lit(BASES.lower())).alias("value")))
CUTS = lambda: (F.col("pos") + F.col("pos") % 23, F.col("pos") + 36 - F.col("pos") % 4)
add("f02_clip", lambda s, d: al.clip(WITH_BASES(s, d, "5S20M3D10M2I4="), *CUTS()).select("label", "pos", "cigar", "seq", "qual"), _ctes("refs") + f""", c AS (SELECT label, start_, start_ % 23 AS a, start_ % 4 AS b, '{BASES}' AS q FROM refs), x AS (SELECT *, CASE WHEN a = 0 THEN 0 ELSE least(a, 5) + least(a, 20) END AS f FROM c)
SELECT label, start_ + a AS pos, concat(CASE WHEN a = 0 THEN '5S20M3D' WHEN a < 20 THEN concat(20 - a, 'M3D') ELSE concat(23 - a, 'D') END, '10M2I', 4 - b, '=') AS cigar, substr(q, cast(f + 1 AS int), cast(41 - f - b AS int)) AS seq, lower(substr(q, cast(f + 1 AS int), cast(41 - f - b AS int))) AS qual FROM x""")
add("f03_strand", lambda s, d: al.strand(WITH_BASES(s, d, "5S20M3D10M2I4="), "+").select("label", "flag", "seq"), _ctes("refs") + f"SELECT label, cast(0 AS int) AS flag, CASE strand WHEN '-' THEN reverse(translate('{BASES}', 'ACGT', 'TGCA')) ELSE '{BASES}' END AS seq FROM refs")
add("f04_split", lambda s, d: al.split(WITH_BASES(s, d, "5S20M7N3D10M2I90N4=")).select("label", "pos", "cigar", "seq", "qual", "tlen"), _ctes("refs") + f", p AS (SELECT * FROM (VALUES (0, '5S20M', 1, 25), (27, '3D10M2I', 26, 12), (130, '4=', 38, 4)) AS v(o, cigar, f, n)) SELECT label, start_ + o AS pos, cigar, substr('{BASES}', f, n) AS seq, lower(substr('{BASES}', f, n)) AS qual, cast(9 AS bigint) AS tlen FROM refs CROSS JOIN p")
add("f05_sort_union", lambda s, d: rg.flat(rg.union(rg.sort(WITH_BASES(s, d, "5S20M3D10M2I4=")))), _ctes("refs") + "SELECT label, 0 AS k, chrom, strand, start_ AS start, start_ + 36 AS stop FROM refs")
BED = lambda s, d, n: fm.parse_bed(REFS(s, d).select(F.array_join(F.slice(F.array("chrom", (F.col("start") - 1).cast("string"), F.col("stop").cast("string"), "label", F.lit("7"), "strand", (F.col("start") + 9).cast("string"), (F.col("start") + 499).cast("string"), F.lit("1,2,3")), 1, n), "\t").alias("value")))
add("f07_bed_thick", lambda s, d: fm.bed_rows(rg.shift(BED(s, d, 9), 100, 0)), _ctes("refs") + "SELECT concat(chrom, chr(9), start_ + 99, chr(9), stop_, chr(9), label, chr(9), '7', chr(9), strand, chr(9), start_ + 99, chr(9), CASE WHEN least(stop_, start_ + 499) <= start_ + 99 THEN start_ + 99 ELSE least(stop_, start_ + 499) END, chr(9), '1,2,3') AS value FROM refs")
add("f07_bed_columns", lambda s, d: fm.bed_rows(rg.shift(BED(s, d, 5), 0, 10)), _ctes("refs") + "SELECT concat(chrom, chr(9), start_ - 1, chr(9), stop_ + 10, chr(9), label, chr(9), '7') AS value FROM refs")
GFF = lambda s, d: fm.parse_gff(REFS(s, d).select(F.concat_ws("\t", "chrom", F.lit("src"), F.lit("gene"), F.col("start").cast("string"), F.col("stop").cast("string"), F.lit("5.5"), "strand", F.lit("0"), "label", F.lit("note")).alias("value")))
add("f09_gff_clip", lambda s, d: fm.gff_lines(fm.clipped_gff(GFF(s, d), F.lit(100_000), F.lit(400_000), F.lit("win"))), _ctes("refs") + "SELECT concat(chrom, chr(9), 'src', chr(9), 'gene', chr(9), greatest(start_, 100000), chr(9), least(stop_, 400000), chr(9), '5.5', chr(9), strand, chr(9), '0', chr(9), label, ':win', chr(9), 'note') AS value FROM refs WHERE start_ <= 400000 AND stop_ >= 100000")
add("s05_merge", lambda s, d: al.merge(SAM(s, d).where("pos % 2 = 0"), SAM(s, d).where("pos % 2 = 1")).select("label", "chrom", "pos"), _ctes("refs") + "SELECT label, chrom, start_ AS pos FROM refs")
HEAD = lambda s: s.createDataFrame([("@HD\tVN:1.0",), ("@SQ\tSN:chr1\tLN:1000100",)], "value string")
add("s13_cat", lambda s, d: al.with_header(HEAD(s), fm.sam_lines(SAM(s, d).where("flag = 0")).union(HEAD(s)), fm.sam_lines(SAM(s, d).where("flag = 16"))).select(F.get(F.split("value", "\t"), F.lit(0)).alias("first")), _ctes("refs") + "SELECT label AS first FROM refs UNION ALL SELECT '@HD' UNION ALL SELECT '@SQ'")
add("r20_shuffle", lambda s, d: ov.shuffled_into(READS(s, d), REFS(s, d), 5))
add("r20_shuffle_bases", lambda s, d: ov.shuffled_into(READS(s, d), REFS(s, d), 5).groupBy("label").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("n")), _ctes("reads") + "SELECT label, cast(sum(stop_ - start_ + 1) AS bigint) AS n FROM reads GROUP BY label")

add("r01_align", lambda s, d: rg.align(REFS(s, d).select("label", F.lit("2S3M1I2M2D1M3N2M").alias("cigar"), F.lit("ggACGTTTACC").alias("seq"), F.lit("!!IIIIIIIII").alias("qual"), F.lit("ACCTTGGANNNCC").alias("ref"))).select("label", "query", "target", "ops"), _ctes("refs") + "SELECT label, 'ggACGTTT**A...CC' AS query, '**ACC*TTGGA...CC' AS target, 'SS==XI==DD=NNN==' AS ops FROM refs")

# composed queries -----------------------------------------------------------------------------------
HALF = lambda s, d, k: REFS(s, d).where(f"cast(substring(label, 2) AS bigint) % 2 = {k}")
ENDS = lambda k: f"e{k} AS (SELECT '' AS label, chrom, strand, greatest(1, p - 300) AS start_, p + 300 AS stop_ FROM (SELECT chrom, strand, start_ AS p, label FROM refs UNION ALL SELECT chrom, strand, stop_, label FROM refs) AS q WHERE cast(substr(label, 2) AS bigint) % 2 = {k}), l{k} AS (SELECT '' AS label, chrom, strand, min(start_) AS start_, max(stop_) AS stop_ FROM {LINKED(0, 'chrom, strand', f'e{k}')} GROUP BY chrom, strand, chain)"
add("q01_boundaries", lambda s, d: pl.compare_boundaries(HALF(s, d, 0), HALF(s, d, 1), 300), _ctes("refs") + ", " + ENDS(0) + ", " + ENDS(1) + f", a AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1), u AS (SELECT chrom, strand, min(start_) AS start_, max(stop_) AS stop_ FROM {LINKED(0, 'chrom, strand', 'a')} GROUP BY chrom, strand, chain), c AS (SELECT * FROM u WHERE EXISTS (SELECT 1 FROM l0 t JOIN l1 r ON {HIT} WHERE t.chrom = u.chrom AND t.strand = u.strand AND t.start_ <= u.stop_ AND t.stop_ >= u.start_)) SELECT (SELECT count(*) FROM u) AS total, (SELECT count(*) FROM c) AS common, (SELECT count(*) FROM c) / cast((SELECT count(*) FROM u) AS double) AS overlap")
add("q02_ignored_loci", lambda s, d: pl.ignored_loci(GENOME(s, d), 1000, REFS(s, d)), _ctes("refs", "bounds") + ", t AS (SELECT chrom, g AS start_, least(g + 999, size) AS stop_ FROM (SELECT *, unnest(generate_series(1::bigint, size, 1000::bigint)) AS g FROM bounds) AS b) SELECT concat(chrom, ':', start_, '-', stop_) AS locus FROM t WHERE EXISTS (SELECT 1 FROM refs r WHERE " + ANY + ")")
add("q03_peak_table", lambda s, d: pl.peak_table(REFS(s, d), {"n1": READS(s, d)}, REFS(s, d).where("stop - start > 4000")).select("label", "n1"), _ctes("refs", "reads") + f", m AS (SELECT chrom, min(start_) AS start_, max(stop_) AS stop_ FROM {LINKED(500, 'chrom')} GROUP BY chrom, chain) SELECT concat(r.chrom, ':', r.start_, '-', r.stop_) AS label, count(t.label) AS n1 FROM m r LEFT JOIN reads t ON {ANY} GROUP BY r.chrom, r.start_, r.stop_")
add("q04_reference_matrix", lambda s, d: pl.reference_matrix(REFS(s, d), {"a": READS(s, d)}, 1000, 4).select("ref", "bin", "value"), _ctes("refs", "reads") + """, w AS (SELECT label, chrom, strand, greatest(1, CASE strand WHEN '+' THEN start_ ELSE stop_ END - 1000) AS lo, CASE strand WHEN '+' THEN start_ ELSE stop_ END + 999 AS hi FROM refs), p AS (SELECT chrom, CASE strand WHEN '+' THEN start_ ELSE stop_ END AS p FROM reads),
h AS (SELECT w.label, cast(floor(4 * CASE w.strand WHEN '-' THEN hi - p ELSE p - lo END / cast(hi - lo + 1 AS double)) AS int) AS bin FROM p JOIN w ON p.chrom = w.chrom AND p BETWEEN lo AND hi), g AS (SELECT label, hi - lo + 1 AS total, cast(b AS int) AS bin FROM w CROSS JOIN range(4) AS bs(b))
SELECT g.label AS ref, g.bin, count(h.bin) / ((SELECT count(*) FROM reads) / 1e6) / (total / 4.0 / 1000) AS value FROM g LEFT JOIN h ON h.label = g.label AND h.bin = g.bin GROUP BY g.label, g.bin, total""")
AREAS = lambda s, d: s.createDataFrame([("A", "chr1", 1, 400000), ("B", "chr2", 500001, 900000)], "label string, chrom string, start bigint, stop bigint")
add("q05_filtered_matrix", lambda s, d: pl.filtered_matrix(PAIRS(s, d), pr.tiles(GENOME(s, d), 4000), AREAS(s, d), 20000, mapq=25, min_dist=3000, max_offset=2500).groupBy("region").agg(F.sum("n").alias("n")), _ctes("pairs", "bounds") + FRAG + KIND + """, d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chrom1, strand1, chrom2, strand2, pos2, pos1 ORDER BY id) AS n FROM k WHERE class LIKE 'ds-accepted%') AS y WHERE n = 1),
z AS (SELECT region, (pos1 - lo) // 20000 AS i, (pos2 - lo) // 20000 AS j FROM d JOIN (VALUES ('A', 'chr1', 1, 400000), ('B', 'chr2', 500001, 900000)) AS a(region, chrom, lo, hi) ON chrom1 = chrom AND chrom2 = chrom AND pos1 BETWEEN lo AND hi AND pos2 BETWEEN lo AND hi)
SELECT region, cast(sum(CASE WHEN i = j THEN 1 ELSE 2 END) AS bigint) AS n FROM z GROUP BY region""")
add("q06_annotated", lambda s, d: pl.annotated_interactions(CELLS(s, d).where("x >= 3 AND j - i >= 2"), REFS(s, d).where("stop - start > 4500"), 10000), CON.replace("WITH ", _ctes("refs") + ", ", 1) + ", n AS (SELECT chrom, b, string_agg(DISTINCT label, ',' ORDER BY label) AS note FROM (SELECT chrom, label, unnest(generate_series((start_ - 1) // 10000, (stop_ - 1) // 10000)) AS b FROM refs WHERE stop_ - start_ > 4500) AS q GROUP BY chrom, b) SELECT c.chrom, i, j, x, coalesce(a.note, 'N/A') AS note_i, coalesce(b.note, 'N/A') AS note_j FROM cells c LEFT JOIN n a ON a.chrom = c.chrom AND a.b = i LEFT JOIN n b ON b.chrom = c.chrom AND b.b = j WHERE x >= 3 AND j - i >= 2")
add("q07_features", lambda s, d: pl.bin_features(GENOME(s, d), 10000, REFS(s, d), READS(s, d).withColumn("score", (F.col("stop") - F.col("start")).cast("double"))), _ctes("refs", "reads", "bounds") + ", t AS (SELECT chrom, g AS start_, least(g + 9999, size) AS stop_ FROM (SELECT *, unnest(generate_series(1::bigint, size, 10000::bigint)) AS g FROM bounds) AS b), c AS (SELECT t.chrom, t.start_, cast(coalesce(sum(CASE WHEN r.label IS NULL THEN 0 ELSE least(t.stop_, r.stop_) - greatest(t.start_, r.start_) + 1 END), 0) AS bigint) AS effective FROM t LEFT JOIN refs r ON " + ANY + " GROUP BY t.chrom, t.start_), m AS (SELECT t.chrom, t.start_, avg(r.stop_ - r.start_) AS score FROM t JOIN reads r ON " + ANY + " GROUP BY t.chrom, t.start_) SELECT c.chrom, c.start_ AS start, effective, coalesce(score, 0) AS score FROM c LEFT JOIN m ON m.chrom = c.chrom AND m.start_ = c.start_")
add("q08_domains", lambda s, d: pl.domains_between(DOM(s, d).where("boundary = 1"), GENOME(s, d), 10000).drop("label"), _ctes("bounds") + "SELECT chrom, '+' AS strand, 70000 * b + 10001 AS start, 70000 * (b + 1) AS stop FROM bounds CROSS JOIN range(14) AS bs(b) UNION ALL SELECT chrom, '+', 70000 * 14 + 10001, size FROM bounds")
add("q09_components", lambda s, d: pl.score_components(ct.boundary_scores(CELLS(s, d), SIZES(s, d), 6).select(F.col("chrom").alias("row"), F.col("i").alias("col"), F.col("ratio").alias("value"))).select("row", F.round(F.col("pc")[0], 5).alias("pc1")))
THIRDS = lambda s, d: {k: READS(s, d).where(f"start % 4 = {i}") for i, k in enumerate(("x1", "x2", "y1", "y2"))}
add("q10_differential", lambda s, d: (lambda t: pl.differential_peaks(REFS(s, d), {k: t[k] for k in ("x1", "x2")}, {k: t[k] for k in ("y1", "y2")}, REFS(s, d)))(THIRDS(s, d)).select("row", "fold", "change"), _ctes("reads", "refs") + """, c AS (SELECT r.label AS "row", greatest(count(*) FILTER (t.start_ % 4 = 0), 1) AS c0, greatest(count(*) FILTER (t.start_ % 4 = 1), 1) AS c1, greatest(count(*) FILTER (t.start_ % 4 = 2), 1) AS c2, greatest(count(*) FILTER (t.start_ % 4 = 3), 1) AS c3
FROM refs r LEFT JOIN reads t ON t.chrom = r.chrom AND t.start_ <= r.stop_ AND t.stop_ >= r.start_ GROUP BY r.label), o AS (SELECT "row", f AS fold, greatest(f, 1 / f) AS x FROM (SELECT "row", (c2 + c3) / (c0 + c1) AS f FROM c) AS g),
b AS (SELECT greatest(c0 / c1, c1 / c0) AS x FROM c UNION ALL SELECT greatest(c2 / c3, c3 / c2) FROM c), v AS (SELECT DISTINCT x FROM o),
f AS (SELECT x, ((SELECT count(*) FROM b WHERE b.x >= v.x) / cast((SELECT count(*) FROM b) AS double)) / ((SELECT count(*) FROM o WHERE o.x >= v.x) / cast((SELECT count(*) FROM o) AS double)) AS f FROM v), g AS (SELECT x, least(1.0, min(f) OVER (ORDER BY x)) AS fdr FROM f)
SELECT "row", fold, CASE WHEN o.x < 2 OR fdr > 0.05 THEN 'none' WHEN fold > 1 THEN 'gain' ELSE 'loss' END AS change FROM o JOIN g ON o.x = g.x""")
add("q11_change_track", lambda s, d: pl.change_track(DOM(s, d).select("chrom", "i", F.when(F.col("boundary") == 1, 1).otherwise(0).alias("change")), 10000, 500), _ctes("bounds") + "SELECT chrom, cast(greatest(1, 70000 * b + 1 - 500) AS bigint) AS start, 70000 * b + 10500 AS stop, 1 AS change FROM bounds CROSS JOIN range(15) AS bs(b)")
add("q12_browser_track", lambda s, d: pl.browser_track(PAIRS(s, d), 10000, 3).drop("id"), CON + "SELECT chrom, i * 10000 AS start, (i + 1) * 10000 AS stop, concat(chrom, ':', j * 10000, '-', (j + 1) * 10000, ',', cast(x AS bigint)) AS target, CASE WHEN i < j THEN '+' WHEN i > j THEN '-' ELSE '.' END AS flag FROM ful WHERE x > 3")
add("q13_coverage_track", lambda s, d: pl.coverage_track(READS(s, d), 1e6), _ctes("reads") + ORACLE_SQL["s12_depth"].removeprefix(_ctes("reads")).replace("SELECT * FROM r WHERE depth > 0", "SELECT chrom, start, stop, cast(depth AS double) AS value FROM r WHERE depth > 0"))
add("q14_run_plan", lambda s, d: pl.run_plan(SHEET(s, d), "group"), SHEET_SQL + ", g AS (SELECT \"group\" AS o, string_agg(sample, ',' ORDER BY sample) AS m FROM sheet GROUP BY 1) SELECT concat(a.o, '.', b.o) AS objects, concat(a.m, ';', b.m) AS members FROM g a JOIN g b ON a.o < b.o")
add("c13_compare_norm", lambda s, d: pl.compare_contacts(CELLS(s, d), OTHER(s, d), SIZES(s, d), [5, 20]).select("chrom", "dist", F.round("r", 6).alias("r")), CON + ", eo AS (SELECT chrom, j - i AS d, sum(x) / (101 - (j - i)) AS e FROM other GROUP BY chrom, j - i), na AS (SELECT c.chrom, i, j, x / e AS a FROM cells c JOIN ex ON ex.chrom = c.chrom AND d = j - i), nb AS (SELECT c.chrom, i, j, x / e AS b FROM other c JOIN eo ON eo.chrom = c.chrom AND d = j - i), ab AS (SELECT chrom, i, j, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM na FULL JOIN nb USING (chrom, i, j)) SELECT chrom, cast(t AS int) AS dist, round(corr(a, b), 6) AS r FROM ab JOIN (VALUES (5), (20)) AS ts(t) ON j - i <= t GROUP BY chrom, t")

# a table of samples from its values to the rows that change
SAMPLES = lambda s, d: table(s, d, "embeddings").select(F.col("vec_id").alias("row"), *[(F.round(F.col("embedding")[k].cast("double") * 100) + 400).alias(f"c{k}") for k in range(4)])
add("a07_easydiff", lambda s, d: pl.easy_differences(SAMPLES(s, d), ["c0", "c1"], ["c2", "c3"], least=410.0, outlier_density=0.004, min_fold=1.05, max_fdr=0.9), """WITH t AS (SELECT vec_id AS "row", k, round(cast(embedding[k + 1] AS double) * 100) + 400 AS value FROM embeddings CROSS JOIN range(4) AS ks(k)),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY value, "row") AS r FROM t), q AS (SELECT "row", k, avg(value) OVER (PARTITION BY r) AS v FROM r),
w AS (SELECT "row", max(v) FILTER (k = 0) AS c0, max(v) FILTER (k = 1) AS c1, max(v) FILTER (k = 2) AS c2, max(v) FILTER (k = 3) AS c3 FROM q GROUP BY "row" HAVING max(v) >= 410),
""" + loess_sql("w1", "w", "c0", "c1", 0.004) + ", " + loess_sql("w2", "w1", "c2", "c3", 0.004) + """,
o AS (SELECT "row", f AS fold, greatest(f, 1 / f) AS x FROM (SELECT "row", (c2 + c3) / (c0 + c1) AS f FROM w2) AS g), b AS (SELECT greatest(c0 / c1, c1 / c0) AS x FROM w2 UNION ALL SELECT greatest(c2 / c3, c3 / c2) FROM w2), v AS (SELECT DISTINCT x FROM o),
f AS (SELECT x, ((SELECT count(*) FROM b WHERE b.x >= v.x) / cast((SELECT count(*) FROM b) AS double)) / ((SELECT count(*) FROM o WHERE o.x >= v.x) / cast((SELECT count(*) FROM o) AS double)) AS f FROM v), g AS (SELECT x, least(1.0, min(f) OVER (ORDER BY x)) AS fdr FROM f)
SELECT "row", fold, fdr, CASE WHEN o.x < 1.05 OR fdr > 0.9 THEN 'none' WHEN fold > 1 THEN 'gain' ELSE 'loss' END AS change FROM o JOIN g ON o.x = g.x""")
