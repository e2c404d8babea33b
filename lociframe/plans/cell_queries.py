"""Queries and SQL of the scan, read-pair and contact-matrix operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociframe.operators import contact as ct
from lociframe.operators import pairs as pr
from lociframe.operators import scan as sc
from lociframe.sources.fixtures import SQL, fixture, regions, table

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _ctes(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " "


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


READS, REFS, GENOME, PAIRS = (lambda s, d, t=t: fixture(s, d, t) for t in ("reads", "refs", "bounds", "pairs"))

# scans ------------------------------------------------------------------------------------------
WINDOWS = """, p AS (SELECT chrom, {strand} AS strand, ({pos} - 1) // 25 AS m, 1 AS v FROM reads), w AS (SELECT chrom, strand, m - b AS w, v FROM p CROSS JOIN range(20) AS bs(b)),
win AS (SELECT chrom, strand, 25 * w + 1 AS start, 25 * w + 500 AS stop, cast(sum(v) AS bigint) AS n FROM w WHERE w >= 0 AND w < 1000100 // 25 - 19 GROUP BY chrom, strand, w) """
add("sc01_counts", lambda s, d: sc.counts(READS(s, d), GENOME(s, d), 500, 25, 10), _ctes("reads") + WINDOWS.format(strand="strand", pos="start_") + "SELECT * FROM win WHERE n >= 10")
add("sc01_counts_any_strand", lambda s, d: sc.counts(READS(s, d), GENOME(s, d), 500, 25, 12, "c", True), _ctes("reads") + WINDOWS.format(strand="'+'", pos="(start_ + (stop_ - start_) // 2)") + "SELECT * FROM win WHERE n >= 12")
add("sc01_counts_in_refs", lambda s, d: sc.counts(READS(s, d), GENOME(s, d), 500, 25, 10, ref=REFS(s, d)), _ctes("reads", "refs") + WINDOWS.format(strand="strand", pos="start_") + "SELECT * FROM win WHERE n >= 10 AND EXISTS (SELECT 1 FROM refs r WHERE r.chrom = win.chrom AND r.strand = win.strand AND r.start_ <= win.stop AND r.stop_ >= win.start)")
add("sc02_covered", lambda s, d: sc.covered(READS(s, d), GENOME(s, d), 500, 100, 200), _ctes("reads") + """, p AS (SELECT chrom, strand, start_, stop_, unnest(generate_series((start_ - 1) // 100, (stop_ - 1) // 100)) AS m FROM reads), c AS (SELECT chrom, strand, m, least(stop_, 100 * m + 100) - greatest(start_, 100 * m + 1) + 1 AS v FROM p)
SELECT * FROM (SELECT chrom, strand, 100 * (m - b) + 1 AS start, 100 * (m - b) + 500 AS stop, cast(sum(v) AS bigint) AS n FROM c CROSS JOIN range(5) AS bs(b) WHERE m - b >= 0 AND m - b < 1000100 // 100 - 4 GROUP BY chrom, strand, m - b) AS w WHERE n >= 200""")
add("sc03_peaks", lambda s, d: sc.peaks(READS(s, d), GENOME(s, d), None, 500, 25, 10, "poisson", 1e-3).select("chrom", "start", "stop", "v1"), _ctes("reads") + WINDOWS.format(strand="'+'", pos="start_") + """, q AS (SELECT chrom, start, stop, least(n, 500) AS v1 FROM win WHERE n >= 10), l AS (SELECT 500.0::double * count(*) / 5000500 AS l FROM reads)
SELECT chrom, start, stop, v1 FROM q CROSS JOIN l WHERE 1 - list_sum([exp(t * ln(l) - l - lgamma(t + 1)) FOR t IN range(v1)]) <= 1e-3""")
ONE = WINDOWS.format(strand="'+'", pos="start_")
TWO = ONE.replace(", p AS", ", p2 AS").replace("FROM p ", "FROM p2 ").replace(", w AS (", ", w2 AS (").replace("FROM w ", "FROM w2 ").replace("win AS", "win2 AS")
add("sc03_peaks_control", lambda s, d: sc.peaks(READS(s, d).where("strand = '+'"), GENOME(s, d), READS(s, d).where("strand = '-'"), 500, 25, 10, "binomial", 1e-2).select("chrom", "start", "stop", "v1", "v2"), _ctes("reads") + ONE.replace("FROM reads", "FROM reads WHERE strand = '+'") + TWO.replace("FROM reads", "FROM reads WHERE strand = '-'") + """, q AS (SELECT a.chrom, a.start, a.stop, least(a.n, 500) AS v1, cast(least(coalesce(b.n, 0), 500) AS double) AS v2 FROM win a LEFT JOIN win2 b ON a.chrom = b.chrom AND a.start = b.start WHERE a.n >= 10), l AS (SELECT avg(CASE strand WHEN '+' THEN 1.0 ELSE 0.0 END) AS p FROM reads)
SELECT chrom, start, stop, v1, v2 FROM q CROSS JOIN l WHERE list_sum([exp(lgamma(v1 + v2 + 1) - lgamma(t + 1) - lgamma(v1 + v2 - t + 1) + t * ln(p) + (v1 + v2 - t) * ln(1 - p)) FOR t IN range(v1, cast(v1 + v2 AS bigint) + 1)]) <= 1e-2""")
PARTS = lambda s, d: table(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("k"))
add("sc04_tails", lambda s, d: PARTS(s, d).select("id", F.round(sc.tail("poisson", F.col("k") - 1, F.lit(100), F.lit(0.2)), 8).alias("poisson"), F.round(sc.tail("binomial", F.col("k") - 1, F.lit(60), F.lit(0.3)), 8).alias("binomial"), F.round(sc.tail("normal", F.col("k"), F.lit(100), F.lit(0.2)), 8).alias("normal")), """SELECT p_partkey AS id, round(1 - list_sum([exp(i * ln(20) - 20 - lgamma(i + 1)) FOR i IN range(p_size)]), 8) AS poisson,
round(list_sum([exp(lgamma(61) - lgamma(i + 1) - lgamma(61 - i) + i * ln(0.3) + (60 - i) * ln(0.7)) FOR i IN range(p_size, 61)]), 8) AS binomial,
round(list_sum([(CASE WHEN j IN (0, 2400) THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END) * exp(0 - pow((p_size - 20.0) / 4 + j * 0.005, 2) / 2) FOR j IN range(2401)]) * 0.005 / 3 / sqrt(2 * pi()), 8) AS normal FROM part""")
PV = lambda col: lambda s, d: PAIRS(s, d).select(((F.col(col) % 9973 + 1) / 9974.0).alias("p"))
OBS = lambda s, d: PAIRS(s, d).select((((F.col("pos1") % 9973 + 1) / 9974.0) * ((F.col("pos2") % 97 + 1) / 98.0)).alias("p"))
add("sc05_qvalue", lambda s, d: sc.q_cutoff(OBS(s, d), PV("pos2")(s, d), 0.5), _ctes("pairs") + ", o AS (SELECT (pos1 % 9973 + 1) / 9974.0::double * ((pos2 % 97 + 1) / 98.0::double) AS p FROM pairs), r AS (SELECT (pos2 % 9973 + 1) / 9974.0::double AS p FROM pairs), b AS (SELECT p, 1 AS o, 0 AS r FROM o UNION ALL SELECT p, 0, 1 FROM r), g AS (SELECT p, sum(o) AS o, sum(r) AS r FROM b GROUP BY p), c AS (SELECT p, o, sum(o) OVER (ORDER BY p) AS n, sum(r) OVER (ORDER BY p) AS m FROM g) SELECT max(p) AS p FROM c WHERE o > 0 AND m / n <= 0.5")
add("sc06_sizes", lambda s, d: sc.genome_size(GENOME(s, d)).join(sc.library_size(READS(s, d), 10)), _ctes("reads", "bounds") + "SELECT (SELECT cast(sum(size) AS bigint) FROM bounds) AS size, (SELECT cast(sum(least(10, cast(split_part(label, '.', 1) AS bigint))) AS bigint) FROM reads) AS n")
MATRIX = """, e AS (SELECT *, coalesce(sum(stop_ - start_ + 1) OVER (PARTITION BY label ORDER BY start_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(stop_ - start_ + 1) OVER (PARTITION BY label) AS total FROM exons),
q AS (SELECT CASE WHEN cast(split_part(label, '.', 2) AS int) <= 2 THEN 'a' ELSE 'b' END AS signal, chrom, strand, CASE strand WHEN '+' THEN start_ ELSE stop_ END AS p FROM reads),
h AS (SELECT e.label AS ref, signal, cast(floor(10 * CASE e.strand WHEN '-' THEN total - 1 - (before + p - start_) ELSE before + p - start_ END / cast(total AS double)) AS int) AS bin FROM q JOIN e ON q.chrom = e.chrom AND q.strand = e.strand AND p BETWEEN start_ AND stop_),
c AS (SELECT ref, signal, bin, count(*) AS v FROM h GROUP BY ALL), g AS (SELECT DISTINCT label AS ref, total, signal, cast(bin AS int) AS bin FROM e CROSS JOIN (VALUES ('a'), ('b')) AS s(signal) CROSS JOIN range(10) AS b(bin)),
n AS (SELECT signal, count(*) AS n FROM q GROUP BY signal), f AS (SELECT g.ref, g.signal, g.bin, coalesce(v, 0)::double AS value, coalesce(v, 0) / (n / 1e6) / (total / 10.0 / 1000) AS rpkm FROM g LEFT JOIN c ON g.ref = c.ref AND g.signal = c.signal AND g.bin = c.bin JOIN n ON n.signal = g.signal) """
SIGNALS = lambda s, d: {"a": READS(s, d).where(F.substring_index("label", ".", -1).cast("int") <= 2), "b": READS(s, d).where(F.substring_index("label", ".", -1).cast("int") > 2)}
add("sc07_matrix", lambda s, d: sc.signal_matrix(SIGNALS(s, d), regions(s, d), 10), _ctes("reads", "exons") + MATRIX + "SELECT ref, signal, bin, value FROM f")
add("sc07_matrix_rpkm", lambda s, d: sc.signal_matrix(SIGNALS(s, d), regions(s, d), 10, rpkm=True), _ctes("reads", "exons") + MATRIX + "SELECT ref, signal, bin, rpkm AS value FROM f")
add("sc07_profile", lambda s, d: sc.signal_matrix(SIGNALS(s, d), regions(s, d), 10, profile="sum"), _ctes("reads", "exons") + MATRIX + "SELECT signal, bin, sum(value) AS value FROM f GROUP BY signal, bin")

# pairs ------------------------------------------------------------------------------------------
MATES = lambda s, d: PAIRS(s, d).select(F.explode(F.array(*[F.struct(F.concat(F.col("id").cast("string"), F.lit(f"/{k}")).alias("name"), F.col(f"chrom{k}").alias("chrom"), F.col(f"strand{k}").alias("strand"), F.col(f"pos{k}").alias("pos"), F.col("mapq"), (F.col("id") % 50 != k).alias("mapped"), F.lit(k).alias("mate")) for k in (1, 2)])).alias("r")).select("r.*")
add("h01_assemble", lambda s, d: pr.assemble(MATES(s, d).where("NOT (name LIKE '%7/2')")).select("id", "chrom1", "pos1", "mapped1", "chrom2", "pos2", "complete"), _ctes("pairs") + "SELECT cast(id AS varchar) AS id, chrom1, pos1, id % 50 <> 1 AS mapped1, CASE WHEN id % 10 <> 7 THEN chrom2 END AS chrom2, CASE WHEN id % 10 <> 7 THEN pos2 END AS pos2, id % 10 <> 7 AS complete FROM pairs")
FRAG = ", f AS (SELECT concat(chrom, ':', cast((g - 1) // 4000 AS varchar)) AS fragment, chrom, g AS start, least(g + 3999, size) AS stop FROM (SELECT *, unnest(generate_series(1::bigint, size, 4000::bigint)) AS g FROM bounds) AS b), x AS (SELECT p.*, a.fragment AS fragment1, a.start AS f1_start, a.stop AS f1_stop, b.fragment AS fragment2, b.start AS f2_start, b.stop AS f2_stop FROM pairs p LEFT JOIN f a ON a.chrom = chrom1 AND pos1 BETWEEN a.start AND a.stop LEFT JOIN f b ON b.chrom = chrom2 AND pos2 BETWEEN b.start AND b.stop) "
CUT = lambda s, d: pr.with_fragments(PAIRS(s, d), pr.tiles(GENOME(s, d), 4000))
add("h02_fragments", lambda s, d: CUT(s, d).select("id", "fragment1", "f1_start", "f2_stop"), _ctes("pairs", "bounds") + FRAG + "SELECT id, fragment1, f1_start, f2_stop FROM x")
KIND = """, k AS (SELECT *, CASE WHEN mapq < 25 THEN 'multihit' WHEN fragment1 IS NULL OR fragment2 IS NULL THEN 'no-fragment' WHEN fragment1 = fragment2 THEN 'same-fragment' WHEN strand1 <> strand2 AND abs(pos1 - pos2) < 3000 THEN 'too-close'
WHEN CASE strand1 WHEN '+' THEN f1_stop - pos1 ELSE pos1 - f1_start END <= 2500 AND CASE strand2 WHEN '+' THEN f2_stop - pos2 ELSE pos2 - f2_start END <= 2500 THEN CASE WHEN chrom1 = chrom2 THEN 'ds-accepted-intra' ELSE 'ds-accepted-inter' END ELSE 'too-far' END AS class FROM x) """
CLASSED = lambda s, d: pr.classify(CUT(s, d), 25, 3000, 2500)
add("h03_classify", lambda s, d: CLASSED(s, d).select("id", "class"), _ctes("pairs", "bounds") + FRAG + KIND + "SELECT id, class FROM k")
add("h04_filter", lambda s, d: pr.filter_pairs(CLASSED(s, d)), _ctes("pairs", "bounds") + FRAG + KIND + "SELECT id, chrom1, strand1, pos1, chrom2, strand2, pos2 FROM (SELECT *, row_number() OVER (PARTITION BY chrom1, strand1, chrom2, strand2, pos2, pos1 ORDER BY id) AS n FROM k WHERE class LIKE 'ds-accepted%') AS y WHERE n = 1")
add("h04_stats", lambda s, d: pr.class_stats(CLASSED(s, d)), _ctes("pairs", "bounds") + FRAG + KIND + "SELECT class, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS percent FROM k GROUP BY class")
COARSE = lambda s, d: PAIRS(s, d).withColumns({f"pos{k}": (F.floor((F.col(f"pos{k}") - 1) / 20000) * 20000 + 1).cast("long") for k in (1, 2)})
add("h05_duplicates", lambda s, d: pr.mark_duplicates(COARSE(s, d)).select("id", "duplicate"), _ctes("pairs") + "SELECT id, row_number() OVER (PARTITION BY chrom1, strand1, chrom2, strand2, (pos2 - 1) // 20000, (pos1 - 1) // 20000 ORDER BY id) > 1 AS duplicate FROM pairs")
add("h06_bin", lambda s, d: pr.bins(PAIRS(s, d), 10000), _ctes("pairs") + "SELECT id, chrom1, (pos1 - 1) // 10000 AS bin1, chrom2, (pos2 - 1) // 10000 AS bin2 FROM pairs")
HALVES = ", b AS (SELECT chrom1, (pos1 - 1) // 10000 AS bin1, chrom2, (pos2 - 1) // 10000 AS bin2 FROM pairs), u AS (SELECT * FROM b UNION ALL SELECT chrom2, bin2, chrom1, bin1 FROM b WHERE NOT (chrom1 = chrom2 AND bin1 = bin2)), c AS (SELECT chrom1, bin1, chrom2, bin2, count(*) AS n FROM u GROUP BY ALL) "
add("h06_matrix", lambda s, d: pr.bin_matrix(PAIRS(s, d), 10000), _ctes("pairs") + HALVES + "SELECT * FROM c")
add("h06_loci", lambda s, d: pr.bin_bounds(pr.bin_matrix(PAIRS(s, d), 10000), GENOME(s, d), 10000).select("locus1", "locus2", "n"), _ctes("pairs") + HALVES + "SELECT concat(chrom1, ':', bin1 * 10000 + 1, '-', least(bin1 * 10000 + 10000, 1000100)) AS locus1, concat(chrom2, ':', bin2 * 10000 + 1, '-', least(bin2 * 10000 + 10000, 1000100)) AS locus2, n FROM c")
AREAS = lambda s, d: s.createDataFrame([("A", "chr1", 1, 400000), ("B", "chr1", 500001, 900000), ("C", "chr3", 100001, 300000)], "label string, chrom string, start bigint, stop bigint")
AREA = ", r(label, chrom, start, stop) AS (VALUES ('A', 'chr1', 1, 400000), ('B', 'chr1', 500001, 900000), ('C', 'chr3', 100001, 300000)), z AS (SELECT a.label AS region, (pos1 - a.start) // 10000 AS i, (pos2 - b.start) // 10000 AS j FROM pairs JOIN r a ON a.chrom = chrom1 AND pos1 BETWEEN a.start AND a.stop JOIN r b ON b.chrom = chrom2 AND pos2 BETWEEN b.start AND b.stop WHERE a.label = b.label) "
add("h07_region_matrix", lambda s, d: pr.region_matrix(PAIRS(s, d), AREAS(s, d), 10000), _ctes("pairs") + AREA + "SELECT region, i, j, count(*) AS n FROM (SELECT * FROM z UNION ALL SELECT region, j, i FROM z WHERE i <> j) AS y GROUP BY region, i, j")
add("h07_region_band", lambda s, d: pr.region_matrix(PAIRS(s, d), AREAS(s, d), 10000, 30000, "band"), _ctes("pairs") + AREA + "SELECT region, i, 3 + j - i AS j, count(*) AS n FROM (SELECT * FROM z UNION ALL SELECT region, j, i FROM z WHERE i <> j) AS y WHERE abs(i - j) <= 3 GROUP BY region, i, 3 + j - i")
add("h07_region_rotated", lambda s, d: pr.region_matrix(PAIRS(s, d), AREAS(s, d), 10000, None, "rotated"), _ctes("pairs") + AREA + "SELECT region, (i + j) // 2 AS i, abs(i - j) AS j, count(*) AS n FROM z GROUP BY 1, 2, 3")
CON = _ctes("pairs") + ", cells AS (SELECT chrom, cast(i_ AS bigint) AS i, cast(j_ AS bigint) AS j, cast(count(*) AS double) AS x FROM (" + SQL["contacts"] + ") AS c GROUP BY chrom, i_, j_), other AS (SELECT chrom, i, j, x * (1 + i % 2) AS x FROM cells WHERE (i + j) % 3 <> 0), ex AS (SELECT chrom, j - i AS d, sum(x) / (101 - (j - i)) AS e FROM cells GROUP BY chrom, j - i), ful AS (SELECT chrom, i, j, x FROM cells UNION ALL SELECT chrom, j, i, x FROM cells WHERE i <> j) "
add("h08_track", lambda s, d: pr.long_range_track(CELLS(s, d).withColumn("n", F.col("x").cast("long")), 10000, 1), CON + "SELECT chrom, i * 10000 AS start, (i + 1) * 10000 AS stop, concat(chrom, ':', j * 10000, '-', (j + 1) * 10000, ',', cast(x AS bigint)) AS target, cast(row_number() OVER (PARTITION BY chrom ORDER BY i, j) AS int) AS id, CASE WHEN i < j THEN '+' WHEN i > j THEN '-' ELSE '.' END AS flag FROM cells WHERE abs(x) > 1")
add("h09_best", lambda s, d: pr.best_alignments(READS(s, d).select(F.split("label", r"\.")[0].alias("name"), (F.col("stop") - F.col("start")).alias("length"), "chrom", F.col("start").alias("pos"))).select("name", "length"), _ctes("reads") + "SELECT split_part(label, '.', 1) AS name, max(stop_ - start_) AS length FROM reads GROUP BY 1")

# contact matrices: 101 bins a chromosome ----------------------------------------------------------
CELLS = lambda s, d: fixture(s, d, "contacts").select("chrom", "i", "j", F.col("n").cast("double").alias("x"))
SIZES = lambda s, d: ct.sizes(GENOME(s, d), 10000)
OTHER = lambda s, d: CELLS(s, d).where("(i + j) % 3 <> 0").withColumn("x", F.col("x") * (1 + F.col("i") % 2))
cell = lambda name, f, sql: add(name, lambda s, d: f(CELLS(s, d), SIZES(s, d)), CON + sql)
cell("c01_none", lambda c, z: ct.preprocess(c, z), "SELECT * FROM cells")
cell("c01_max", lambda c, z: ct.preprocess(c, z, "max"), "SELECT chrom, i, j, x / max(x) OVER (PARTITION BY chrom) AS x FROM cells")
cell("c01_mean", lambda c, z: ct.preprocess(c, z, "mean"), "SELECT c.chrom, i, j, x / m AS x FROM cells c JOIN (SELECT chrom, sum(x) / (101 * 101) AS m FROM ful GROUP BY chrom) AS w ON c.chrom = w.chrom")
cell("c01_log2", lambda c, z: ct.preprocess(c, z, "log2"), "SELECT chrom, i, j, log2(x + 1) AS x FROM cells")
cell("c01_dist", lambda c, z: ct.preprocess(c, z, "dist"), "SELECT c.chrom, i, j, x / e AS x FROM cells c JOIN ex ON ex.chrom = c.chrom AND d = j - i")
cell("c01_distlog2", lambda c, z: ct.preprocess(c, z, "distlog2", cut=2.0), "SELECT c.chrom, i, j, log2(greatest(CASE WHEN x < 2 THEN 0 ELSE x END / e, 1.0)) AS x FROM cells c JOIN ex ON ex.chrom = c.chrom AND d = j - i")
cell("c01_zscore", lambda c, z: ct.preprocess(c, z, "zscore").withColumn("x", F.round("x", 6) + F.lit(0.0)), "SELECT c.chrom, i, j, CASE WHEN sd > 0 THEN round((x - e) / sd, 6) ELSE 0 END + cast(0 AS double) AS x FROM cells c JOIN (SELECT f.chrom, f.d, f.e, sqrt(greatest(0, (q - (101 - f.d) * f.e * f.e) / greatest(100 - f.d, 1))) AS sd FROM ex f JOIN (SELECT chrom, j - i AS d, sum(x * x) AS q FROM cells GROUP BY chrom, j - i) AS g ON f.chrom = g.chrom AND f.d = g.d) AS z ON z.chrom = c.chrom AND d = j - i")
cell("c01_rank", lambda c, z: ct.preprocess(c, z, "rank"), "SELECT c.chrom, i, j, r AS x FROM cells c JOIN (SELECT chrom, x, (101 * 101 - sum(k) OVER (PARTITION BY chrom) + sum(k) OVER (PARTITION BY chrom ORDER BY x) - (k - 1) / 2.0) / (101.0 * 101) AS r FROM (SELECT chrom, x, count(*) AS k FROM ful GROUP BY chrom, x) AS a) AS b ON b.chrom = c.chrom AND b.x = c.x")
cell("c02_expected", ct.expected, "SELECT chrom, d, e AS expected FROM ex")
FEATURES = lambda s, d: ct.grid(SIZES(s, d)).select("chrom", F.col("i").alias("bin"), (F.lit(5000.0) + 40 * F.col("i")).alias("length"), (0.5 + F.col("i") % 5 / 10).alias("mappability"), (0.3 + F.col("i") % 7 / 20).alias("gc"))
add("c03_normalise", lambda s, d: ct.normalise(CELLS(s, d), FEATURES(s, d), 1e6, 5500, 0.6), CON + "SELECT chrom, i, j, CASE WHEN l >= 5500 * 5500 AND m >= 0.36 THEN x / (l / 1e6) / 0.001 END AS x FROM (SELECT *, (5000.0::double + 40 * i) * (5000.0::double + 40 * j) AS l, (0.5 + i % 5 / 10.0::double) * (0.5 + j % 5 / 10.0::double) AS m FROM cells) AS c")
DENSE = lambda s, d: ct.grid(SIZES(s, d)).select("chrom", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("j")).join(ct.full(CELLS(s, d)), ["chrom", "i", "j"], "left").withColumn("x", F.when((F.col("i") * F.col("j")) % 4 != 3, F.coalesce("x", F.lit(0.0))))
DENSE_SQL = ", den AS (SELECT c.chrom, a.i, b.j, CASE WHEN (a.i * b.j) % 4 <> 3 THEN coalesce(x, 0) END AS x FROM (SELECT unnest(['chr1','chr2','chr3','chr4','chr5']) AS chrom) AS c CROSS JOIN range(101) AS a(i) CROSS JOIN range(101) AS b(j) LEFT JOIN ful f ON f.chrom = c.chrom AND f.i = a.i AND f.j = b.j), n AS (SELECT *, max(CASE WHEN x IS NOT NULL THEN j END) OVER (PARTITION BY chrom, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS j0, min(CASE WHEN x IS NOT NULL THEN j END) OVER (PARTITION BY chrom, i ORDER BY j ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS j1 FROM den), imp AS (SELECT n.chrom, n.i, n.j, coalesce(n.x, coalesce(a.x, 0) + (coalesce(b.x, 0) - coalesce(a.x, 0)) * (n.j - coalesce(n.j0, -1)) / cast(coalesce(n.j1, 101) - coalesce(n.j0, -1) AS double)) AS x FROM n LEFT JOIN den a ON a.chrom = n.chrom AND a.i = n.i AND a.j = n.j0 LEFT JOIN den b ON b.chrom = n.chrom AND b.i = n.i AND b.j = n.j1) "
add("c04_impute", lambda s, d: ct.impute(DENSE(s, d)), CON + DENSE_SQL + "SELECT * FROM imp")
add("c04_impute_symmetric", lambda s, d: ct.impute_symmetric(DENSE(s, d)), CON + DENSE_SQL + "SELECT a.chrom, a.i, a.j, (a.x + b.x) / 2 AS x FROM imp a JOIN imp b ON a.chrom = b.chrom AND a.i = b.j AND a.j = b.i")
cell("c05_rotate", lambda c, z: ct.rotate(c), "SELECT chrom, (i + j) // 2 AS i, j - i AS j, x FROM cells")
cell("c05_rotate_back", lambda c, z: ct.rotate_back(ct.rotate(c)), "SELECT * FROM cells")
cell("c06_band", lambda c, z: ct.band(c), "SELECT chrom, i, j - i AS j, x FROM cells")
cell("c06_band_back", lambda c, z: ct.band_back(ct.band(c)), "SELECT * FROM cells")
add("c07_standardise", lambda s, d: ct.standardise(CELLS(s, d), SIZES(s, d), s.range(10).select(F.col("id").alias("d"), (10.0 / (F.col("id") + 1)).alias("s"))), CON + "SELECT c.chrom, i, j, x / e * (10.0 / (j - i + 1)) AS x FROM cells c JOIN ex ON ex.chrom = c.chrom AND d = j - i WHERE j - i < 10")
cell("c08_submatrix", lambda c, z: ct.submatrix(c, 20, 60), "SELECT chrom, i - 20 AS i, j - 20 AS j, x FROM cells WHERE i >= 20 AND j <= 60")
cell("c09_stats", ct.distance_stats, "SELECT d, sum(e) / 5 AS average FROM ex GROUP BY d")
add("c10_estimate", lambda s, d: ct.estimate(CELLS(s, d), SIZES(s, d), [0.0, 1.0, 4.0]).groupBy("chrom", "lam").agg(F.count("*").alias("n"), F.round(F.sum("x"), 6).alias("total")))
add("c11_solution", lambda s, d: ct.solution(ct.estimate(CELLS(s, d), SIZES(s, d), [0.0, 2.0]), 0.0).where("x > 0"), CON + "SELECT * FROM ful")
BOTH = ", ab AS (SELECT coalesce(c.chrom, o.chrom) AS chrom, coalesce(c.i, o.i) AS i, coalesce(c.j, o.j) AS j, coalesce(c.x, 0) AS a, coalesce(o.x, 0) AS b FROM cells c FULL JOIN other o ON c.chrom = o.chrom AND c.i = o.i AND c.j = o.j) "
add("c12_corr", lambda s, d: ct.correlate(CELLS(s, d), OTHER(s, d)), CON + BOTH + "SELECT chrom, corr(a, b) AS r, count(*) AS n FROM ab GROUP BY chrom")
add("c13_compare", lambda s, d: ct.compare_by_distance(CELLS(s, d), OTHER(s, d), [1, 3, 10, 50]), CON + BOTH + "SELECT chrom, cast(t AS int) AS dist, corr(a, b) AS r FROM ab JOIN (VALUES (1), (3), (10), (50)) AS ts(t) ON j - i <= t GROUP BY chrom, t")
add("c14_overlap_curve", lambda s, d: ct.overlap_curve(CELLS(s, d), OTHER(s, d), [0.5, 1.5, 4.0]), CON + BOTH + "SELECT t::double AS cutoff, sum(CASE WHEN a > t AND b > t THEN 1 ELSE 0 END) / cast(sum(CASE WHEN a > t OR b > t THEN 1 ELSE 0 END) AS double) AS overlap FROM ab CROSS JOIN (VALUES (0.5), (1.5), (4.0)) AS ts(t) GROUP BY t")
add("c16_penalty", lambda s, d: ct.penalty_ratio(DENSE(s, d).na.fill(0.0, ["x"]), DENSE(s, d).na.fill(1.0, ["x"]), 0.5, 2.0), CON + DENSE_SQL + ", y AS (SELECT chrom, i, j, coalesce(x, 0) AS x, coalesce(x, 1) AS y FROM den), t AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY chrom, i ORDER BY j)) AS da, abs(x - lag(x) OVER (PARTITION BY chrom, j ORDER BY i)) AS db FROM y) SELECT chrom, (0.5 * sum(abs(x)) + 2 * sum(coalesce(da, 0) + coalesce(db, 0))) / sum((x - y) * (x - y)) AS ratio FROM t GROUP BY chrom")
SCORES = """, b AS (SELECT chrom, cast(b AS bigint) AS i FROM (SELECT DISTINCT chrom FROM cells) AS c CROSS JOIN range(101) AS r(b)), s AS (SELECT b.chrom, b.i,
CASE WHEN b.i >= 5 THEN coalesce(sum(CASE WHEN c.i >= b.i - 5 AND c.j <= b.i THEN x END), 0) / 21 ELSE 0 END AS l, CASE WHEN b.i <= 95 THEN coalesce(sum(CASE WHEN c.i >= b.i AND c.j <= b.i + 5 THEN x END), 0) / 21 ELSE 0 END AS r,
CASE WHEN b.i >= 5 THEN coalesce(sum(CASE WHEN c.i = b.i - 5 AND c.j <= b.i THEN x END), 0) / 6 ELSE 0 END AS l1, CASE WHEN b.i <= 95 THEN coalesce(sum(CASE WHEN c.i = b.i AND c.j <= b.i + 5 THEN x END), 0) / 6 ELSE 0 END AS r1,
CASE WHEN b.i BETWEEN 5 AND 95 THEN coalesce(sum(CASE WHEN c.i BETWEEN b.i - 5 AND b.i - 1 AND c.j BETWEEN b.i + 1 AND b.i + 5 AND c.j - c.i <= 6 THEN x END), 0) / 12.5 ELSE 0 END AS o
FROM b LEFT JOIN cells c ON c.chrom = b.chrom AND c.i BETWEEN b.i - 5 AND b.i + 5 AND c.j BETWEEN b.i - 5 AND b.i + 5 GROUP BY b.chrom, b.i),
t AS (SELECT *, greatest(l, r) AS hi, least(l, r) AS lo, avg(o) OVER (PARTITION BY chrom) AS pseudo, max(o) OVER (PARTITION BY chrom) AS mo FROM s), u AS (SELECT *, coalesce(hi / nullif(max(hi) OVER (PARTITION BY chrom), 0), 0) * (1 - coalesce(o / nullif(mo, 0), 0)) AS p1, coalesce(lo / nullif(max(lo) OVER (PARTITION BY chrom), 0), 0) * (1 - coalesce(o / nullif(mo, 0), 0)) AS p2 FROM t),
sco AS (SELECT chrom, i, l AS intra_left, r AS intra_right, hi AS intra_max, lo AS intra_min, o AS inter, r - l AS diff, CASE WHEN r1 = l1 THEN 0 ELSE (r1 - l1) * abs(r1 - l1) / (l1 + r1) END AS di, coalesce(hi / nullif(o + pseudo, 0), 0) AS ratio, coalesce((r - l) / nullif(o + pseudo, 0), 0) AS diffratio, coalesce(p1 / nullif(max(p1) OVER (PARTITION BY chrom), 0), 0) AS product_max, coalesce(p2 / nullif(max(p2) OVER (PARTITION BY chrom), 0), 0) AS product_min FROM u) """
ROUND = ["intra_left", "intra_right", "intra_max", "intra_min", "inter", "diff", "di", "ratio", "diffratio", "product_max", "product_min"]
cell("c17_scores", lambda c, z: ct.boundary_scores(c, z, 6).select("chrom", "i", *[(F.round(x, 6) + F.lit(0.0)).alias(x) for x in ROUND]), SCORES + "SELECT chrom, i, " + ", ".join(f"round({x}, 6) + cast(0 AS double) AS {x}" for x in ROUND) + " FROM sco")
LMAX = SCORES + ", lm AS (SELECT chrom, i, ratio AS score, ratio - greatest(min(ratio) OVER (PARTITION BY chrom ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), min(ratio) OVER (PARTITION BY chrom ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS lmax FROM sco) "
cell("c18_lmax", lambda c, z: ct.local_maxima_scores(ct.boundary_scores(c, z, 6), "ratio", 4).select("chrom", "i", (F.round("score", 6) + F.lit(0.0)).alias("score"), (F.round("lmax", 6) + F.lit(0.0)).alias("lmax")), LMAX + "SELECT chrom, i, round(score, 6) + cast(0 AS double) AS score, round(lmax, 6) + cast(0 AS double) AS lmax FROM lm")
GREEDY = """, wide AS (SELECT chrom, i, {x} AS x, list({x}) OVER (PARTITION BY chrom ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a, list({x}) OVER (PARTITION BY chrom ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS b FROM {t}),
slopes AS (SELECT chrom, i, x, i - len(a) + list_position(a, list_min(a)) AS low, i + list_position(b, list_min(b)) - 1 AS high, row_number() OVER (PARTITION BY chrom ORDER BY x DESC, i) AS n FROM wide),
walk AS (SELECT chrom, cast(0 AS bigint) AS n, list_transform(range(101), lambda v: 0) AS y FROM (SELECT DISTINCT chrom FROM slopes) AS c UNION ALL SELECT walk.chrom, s.n, CASE WHEN y[s.i + 1] <> 0 THEN y ELSE
list_transform(range(101), lambda v: CASE WHEN v = s.i AND s.x >= {least} THEN 1 WHEN v BETWEEN s.low AND s.high AND y[v + 1] = 0 THEN -1 ELSE y[v + 1] END) END FROM walk JOIN slopes s ON s.chrom = walk.chrom AND s.n = walk.n + 1),
marked AS (SELECT chrom, unnest(range(101)) AS i, unnest(y) AS y FROM walk WHERE n = 101) """
add("c19_maxima", lambda s, d: ct.local_maxima(ct.boundary_scores(CELLS(s, d), SIZES(s, d), 6), "ratio", 4, 0.5), CON.replace("WITH", "WITH RECURSIVE", 1) + SCORES + GREEDY.format(x="ratio", t="sco", least=0.5) + "SELECT chrom, i, cast(CASE WHEN y = 1 THEN 1 ELSE 0 END AS int) AS boundary FROM marked")
add("c20_domains", lambda s, d: ct.domains(CELLS(s, d), SIZES(s, d), 6, 4), CON.replace("WITH", "WITH RECURSIVE", 1) + LMAX + ", qs AS (SELECT chrom, quantile_cont(lmax, 0.99) AS q FROM lm GROUP BY chrom), dom AS (SELECT lm.chrom, i, score, coalesce(least(lmax / nullif(q, 0), 1.0), 0.0) AS lmax FROM lm JOIN qs ON lm.chrom = qs.chrom)" + GREEDY.format(x="lmax", t="dom", least=0.1) + "SELECT chrom, i, score, lmax, cast(CASE WHEN y = 1 THEN 1 ELSE 0 END AS int) AS boundary FROM marked JOIN dom USING (chrom, i)")
DOM = lambda s, d: ct.boundary_scores(CELLS(s, d), SIZES(s, d), 6).select("chrom", "i", F.round("ratio", 5).alias("lmax"), (F.col("i") % 7 == 0).cast("int").alias("boundary"))
DOM2 = lambda s, d: ct.boundary_scores(OTHER(s, d), SIZES(s, d), 6).select("chrom", "i", F.round("ratio", 5).alias("lmax"), (F.col("i") % 11 == 0).cast("int").alias("boundary"))
OTHERS = SCORES.replace("FROM cells)", "FROM other)").replace("LEFT JOIN cells", "LEFT JOIN other").replace(", b AS (", ", b2 AS (").replace("FROM b LEFT", "FROM b2 b LEFT").replace(", s AS (SELECT b", ", s2 AS (SELECT b").replace("FROM s), u AS", "FROM s2), u2 AS").replace("\nt AS (", "\nt2 AS (").replace("FROM t),", "FROM t2),").replace("sco AS (", "sco2 AS (").replace("FROM u) ", "FROM u2) ")
DIFF = SCORES + OTHERS + ", da AS (SELECT chrom, i, round(ratio, 5) AS lmax, CASE WHEN i % 7 = 0 THEN 1 ELSE 0 END AS boundary FROM sco), db AS (SELECT chrom, i, round(ratio, 5) AS lmax, CASE WHEN i % 11 = 0 THEN 1 ELSE 0 END AS boundary FROM sco2) "
add("c21_changes", lambda s, d: ct.domain_changes(DOM(s, d), DOM2(s, d), 2, 0.05), CON + DIFF + ", x AS (SELECT da.chrom, da.i, da.boundary AS ba, db.boundary AS bb, max(da.boundary) OVER w AS fa, max(db.boundary) OVER w AS fb, db.lmax - da.lmax AS d FROM da JOIN db ON da.chrom = db.chrom AND da.i = db.i WINDOW w AS (PARTITION BY da.chrom ORDER BY da.i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) SELECT chrom, i, CASE WHEN ba = 1 AND fb = 0 AND d <= -0.05 THEN -1 WHEN bb = 1 AND fa = 0 AND d >= 0.05 THEN 1 ELSE 0 END AS change FROM x")
add("c22_domain_overlap", lambda s, d: ct.domain_overlap(DOM(s, d), DOM2(s, d), 30), CON + DIFF + ", p AS (SELECT chrom, i FROM da WHERE boundary = 1 ORDER BY lmax DESC, chrom, i LIMIT 30), q AS (SELECT chrom, i FROM db WHERE boundary = 1 ORDER BY lmax DESC, chrom, i LIMIT 30) SELECT (SELECT count(*) FROM p) AS n_a, (SELECT count(*) FROM q) AS n_b, (SELECT count(*) FROM p WHERE EXISTS (SELECT 1 FROM q WHERE q.chrom = p.chrom AND q.i = p.i)) AS exact, (SELECT count(*) FROM p WHERE EXISTS (SELECT 1 FROM q WHERE q.chrom = p.chrom AND abs(q.i - p.i) <= 1)) AS near")
LOOPS = ", eo AS (SELECT chrom, j - i AS d, sum(x) / (101 - (j - i)) AS e FROM other GROUP BY chrom, j - i), lo AS (SELECT ab.chrom, ab.i, ab.j, a AS a_count, a / 0.1 AS a_scaled, coalesce(a / ex.e, 0) AS a_norm, b AS b_count, b / 0.1 AS b_scaled, coalesce(b / eo.e, 0) AS b_norm, (ab.j - ab.i) * 10000 AS distance FROM ab LEFT JOIN ex ON ex.chrom = ab.chrom AND ex.d = ab.j - ab.i LEFT JOIN eo ON eo.chrom = ab.chrom AND eo.d = ab.j - ab.i), sel AS (SELECT * FROM lo WHERE ((a_norm >= 2 AND a_scaled >= 20) OR (b_norm >= 2 AND b_scaled >= 20)) AND distance >= 20000) "
add("c23_loops", lambda s, d: ct.loops({"a": (CELLS(s, d), 1e6), "b": (OTHER(s, d), 1e6)}, SIZES(s, d), 10000, 2.0, 20.0, 20000), CON + BOTH + LOOPS + "SELECT * FROM sel")
add("c24_loop_changes", lambda s, d: ct.loop_changes((CELLS(s, d), 1e6), (OTHER(s, d), 1e6), SIZES(s, d), 10000, 2.0, 20.0, 20000).drop("diff_zscore"), CON + BOTH + LOOPS + "SELECT chrom, i, j, distance, log2((b_scaled + 10) / (a_scaled + 10)) AS fold_scaled, log2((b_norm + 0.5) / (a_norm + 0.5)) AS fold_norm FROM sel")
cell("c25_quadrants", lambda c, z: ct.quadrants(c, 50, 60), "SELECT chrom, avg(CASE WHEN i < 50 AND j >= 60 THEN x END) / nullif(avg(CASE WHEN i >= 50 AND j >= 60 THEN x END), 0) AS ratio FROM cells GROUP BY chrom")
cell("c27_connectivity", lambda c, z: ct.connectivity_difference(c, z, 4), "SELECT g.chrom, g.i, CASE WHEN g.i >= 4 AND g.i < 97 THEN abs(coalesce(sum(CASE WHEN f.j > f.i THEN x ELSE -x END), 0)) ELSE 0 END AS x FROM (SELECT DISTINCT chrom, b AS i FROM cells CROSS JOIN range(101) AS r(b)) AS g LEFT JOIN ful f ON f.chrom = g.chrom AND f.i = g.i AND f.i <> f.j AND abs(f.i - f.j) <= 4 GROUP BY g.chrom, g.i".replace("FROM (SELECT", "FROM (SELECT"))
add("c28_poisson", lambda s, d: ct.poisson_normalise(CELLS(s, d), FEATURES(s, d)).select("chrom", "i", "j"), CON + "SELECT chrom, i, j FROM cells WHERE i < j")
add("c29_balance", lambda s, d: ct.balance(CELLS(s, d), 3).select("chrom", "i", "j"), CON + "SELECT chrom, i, j FROM cells")
cell("c30_diamond", lambda c, z: ct.diamond_means(c, z, 5), "SELECT g.chrom, g.i, CASE WHEN g.i = 100 THEN 0 ELSE coalesce(sum(x), 0) / (least(5, g.i + 1) * least(5, 100 - g.i)) END AS x FROM (SELECT DISTINCT chrom, b AS i FROM cells CROSS JOIN range(101) AS r(b)) AS g LEFT JOIN cells f ON f.chrom = g.chrom AND f.i BETWEEN g.i - 4 AND g.i AND f.j BETWEEN g.i + 1 AND g.i + 5 GROUP BY g.chrom, g.i")
cell("c31_insulation", lambda c, z: ct.insulation(c, z, 5, 3), ", s AS (SELECT g.chrom, g.i, coalesce(sum(x), 10000) AS x FROM (SELECT DISTINCT chrom, b AS i FROM cells CROSS JOIN range(101) AS r(b)) AS g LEFT JOIN cells f ON f.chrom = g.chrom AND f.i < g.i AND f.j >= g.i AND f.j - f.i <= 5 GROUP BY g.chrom, g.i) SELECT chrom, i, x, CASE WHEN x < min(x) OVER (PARTITION BY chrom ORDER BY i ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AND x < min(x) OVER (PARTITION BY chrom ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) THEN 1 ELSE 0 END AS border FROM s")
cell("c33_reads", lambda c, z: ct.reads(c), "SELECT chrom, sum(x) AS reads FROM cells GROUP BY chrom")
cell("c34_long", lambda c, z: ct.long_format(c, 10000), "SELECT chrom, i * 10000 AS start1, j * 10000 AS start2, x FROM ful")
