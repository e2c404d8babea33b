"""Queries and SQL of the region, set and overlap operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociframe.operators import overlap as ov
from lociframe.operators import regions as rg
from lociframe.operators import sets as st
from lociframe.sources.fixtures import SQL, fixture, regions, single

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _ctes(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " "


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def row(name, f, select, where="", source="exons"):
    """A row-wise operator over the exons, and SQL over their flat rows."""
    add(name, lambda s, d: rg.flat(f(regions(s, d), s, d)), _ctes("exons", "bounds") + f"SELECT label, {select} FROM {source} {where}")


ENDS = "label, k, chrom, strand, start_ AS start, stop_ AS stop"
HALF = "((stop_ - start_) - (stop_ - start_) % 2) / 2"
row("r03_bounds", lambda r, s, d: rg.shift(r, -500_000, 500_000).transform(rg.bounds, fixture(s, d, "bounds")), "k, chrom, strand, greatest(1, start_ - 500000) AS start, least(1000100, stop_ + 500000) AS stop")
row("r04_center", lambda r, s, d: rg.center(r), f"k, chrom, strand, cast(start_ + {HALF} AS bigint) AS start, cast(stop_ - {HALF} AS bigint) AS stop")
row("r05_chrom", lambda r, s, d: rg.rename_chromosomes(r, s.createDataFrame([("chr1", "1"), ("chr2", "2")], "chrom string, name string")), "k, CASE chrom WHEN 'chr1' THEN '1' WHEN 'chr2' THEN '2' ELSE chrom END AS chrom, strand, start_ AS start, stop_ AS stop")
row("r06_connect", lambda r, s, d: rg.connect(r), "0 AS k, min(chrom) AS chrom, min(strand) AS strand, min(start_) AS start, max(stop_) AS stop", "GROUP BY label")
NEXT = f"(SELECT *, lead(start_) OVER (PARTITION BY label ORDER BY k) AS s2, lead(stop_) OVER (PARTITION BY label ORDER BY k) AS e2, lag(stop_) OVER (PARTITION BY label ORDER BY k) AS e0 FROM exons) AS n"
row("r07_diff", lambda r, s, d: rg.gaps(r), "cast(row_number() OVER (PARTITION BY label ORDER BY k) - 1 AS int) AS k, chrom, strand, stop_ + 1 AS start, s2 - 1 AS stop", "WHERE s2 - 1 >= stop_ + 1", NEXT)
add("r08_dist", lambda s, d: rg.distances(regions(s, d)).select("label", F.posexplode("distances").alias("k", "d")), _ctes("exons") + f"SELECT label, k, cast(s2 - stop_ AS double) AS d FROM {NEXT} WHERE s2 IS NOT NULL")
row("r09_divide", lambda r, s, d: rg.divide(r), "cast(2 * k + h AS int) AS k, chrom, strand, cast(CASE h WHEN 0 THEN start_ ELSE start_ + ((stop_ - start_ + 1) - (stop_ - start_ + 1) % 2) / 2 END AS bigint) AS start, cast(CASE h WHEN 1 THEN stop_ ELSE start_ + ((stop_ - start_ + 1) - (stop_ - start_ + 1) % 2) / 2 - 1 END AS bigint) AS stop", "", "exons CROSS JOIN (VALUES (0), (1)) AS hs(h)")
row("r10_fix", lambda r, s, d: rg.fix(rg.shift(r, 0, -600)), "cast(row_number() OVER (PARTITION BY label ORDER BY k) - 1 AS int) AS k, chrom, strand, start_ AS start, stop_ - 600 AS stop", "WHERE stop_ - 600 >= start_")
row("r11_int", lambda r, s, d: rg.intersection(rg.shift(r, 0, 2000)), "0 AS k, min(chrom) AS chrom, min(strand) AS strand, max(start_) AS start, min(stop_) + 2000 AS stop", "GROUP BY label HAVING max(start_) <= min(stop_) + 2000")
add("r12_n", lambda s, d: rg.length(regions(s, d)).select("label", "n"), _ctes("exons") + "SELECT label, cast(sum(stop_ - start_ + 1) AS bigint) AS n FROM exons GROUP BY label")
for op, e in (("1", "start_"), ("2", "stop_"), ("5p", "CASE strand WHEN '+' THEN start_ ELSE stop_ END"), ("3p", "CASE strand WHEN '+' THEN stop_ ELSE start_ END")):
    row(f"r13_pos_{op}", lambda r, s, d, op=op: rg.position(r, op), f"k, chrom, strand, {e} AS start, {e} AS stop")
MID = "start_ + ((stop_ - start_ + 1) - (stop_ - start_ + 1) % 2) / 2"
row("r13_pos_c", lambda r, s, d: rg.position(r, "c", 50), f"k, chrom, strand, cast({MID} - 50 AS bigint) AS start, cast({MID} + 50 AS bigint) AS stop")
add("r15_rnd", lambda s, d: rg.flat(rg.random_place(regions(s, d), fixture(s, d, "bounds"), 7)))
row("r17_select", lambda r, s, d: rg.select(r, five=True), "0 AS k, chrom, strand, start_ AS start, stop_ AS stop", "WHERE k = CASE strand WHEN '+' THEN 0 ELSE 2 END")
row("r18_shift", lambda r, s, d: rg.shift(r, -10, 20), "k, chrom, strand, start_ - 10 AS start, stop_ + 20 AS stop")
row("r19_shiftp", lambda r, s, d: rg.shift_by_strand(r, -10, 20), "k, chrom, strand, start_ - CASE strand WHEN '+' THEN 10 ELSE 20 END AS start, stop_ + CASE strand WHEN '+' THEN 20 ELSE 10 END AS stop")
row("r21_sort", lambda r, s, d: rg.sort(r.withColumn("intervals", F.reverse("intervals"))), ENDS.removeprefix("label, "))
row("r22_split", lambda r, s, d: rg.split(r), "0 AS k, chrom, strand, start_ AS start, stop_ AS stop")
row("r22_split_strand", lambda r, s, d: rg.split(r, True), ENDS.removeprefix("label, "))
row("r23_strand", lambda r, s, d: rg.strand(r, "r"), "k, chrom, CASE strand WHEN '+' THEN '-' ELSE '+' END AS strand, start_ AS start, stop_ AS stop")
row("r24_union", lambda r, s, d: rg.union(r), "cast(row_number() OVER (PARTITION BY label ORDER BY min(start_)) - 1 AS int) AS k, min(chrom) AS chrom, min(strand) AS strand, min(start_) AS start, max(stop_) AS stop", "GROUP BY label, island", "(SELECT *, sum(CASE WHEN e0 IS NULL OR start_ > e0 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY k) AS island FROM " + NEXT + ") AS i")
add("r26_win", lambda s, d: rg.flat(rg.windows(regions(s, d), 200, 100)), _ctes("exons") + "SELECT concat(label, '#', cast((a - start_) / 100 + 1 AS bigint)) AS label, 0 AS k, chrom, strand, a AS start, a + 199 AS stop FROM (SELECT *, unnest(generate_series(start_, stop_ - 199, 100)) AS a FROM exons) AS w")
add("r26_win_small", lambda s, d: rg.flat(rg.windows(regions(s, d), 200, 100, True)), _ctes("exons") + "SELECT concat(label, '#', cast((a - start_) / 100 + 1 AS bigint)) AS label, 0 AS k, chrom, strand, a AS start, least(a + 199, stop_) AS stop FROM (SELECT *, unnest(generate_series(start_, stop_, 100)) AS a FROM exons) AS w")
row("r28_rc", lambda r, s, d: rg.reverse_positions(r, fixture(s, d, "bounds")), "k, chrom, strand, CASE strand WHEN '-' THEN 1000100 - stop_ + 1 ELSE start_ END AS start, CASE strand WHEN '-' THEN 1000100 - start_ + 1 ELSE stop_ END AS stop")
add("r32_offsets", lambda s, d: rg.offset_list(regions(s, d), "5p").select("label", F.posexplode("offsets").alias("k", "o")).select("label", "k", "o.*"), _ctes("exons") + "SELECT label, k, CASE strand WHEN '+' THEN start_ - lo ELSE hi - stop_ END AS start, CASE strand WHEN '+' THEN stop_ - lo ELSE hi - start_ END AS stop FROM (SELECT *, min(start_) OVER (PARTITION BY label) AS lo, max(stop_) OVER (PARTITION BY label) AS hi FROM exons) AS x")

# sequences: chunks of 32 bases
DNA = "translate(md5(concat({c}, ':', cast({k} AS varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGN')"


def _dna(spark):
    ks = spark.range(0, 32_000).select(F.explode(F.array(*[F.lit(f"chr{c}") for c in range(1, 6)])).alias("chrom"), F.col("id").alias("chunk"))
    return ks.select("chrom", "chunk", F.lit(32).alias("width"), F.expr(DNA.format(c="chrom", k="chunk")).alias("seq"))


_SEQ = f""", few AS (SELECT * FROM exons), spans AS (SELECT label, k, chrom, strand, start_, stop_, unnest(generate_series((start_ - 1) // 32, (stop_ - 1) // 32)) AS c FROM few),
bits AS (SELECT label, k, strand, c, substr({DNA.format(c='chrom', k='c')}, cast(greatest(start_ - c * 32, 1) AS int), cast(least(stop_ - c * 32, 32) - greatest(start_ - c * 32, 1) + 1 AS int)) AS piece FROM spans),
seqs AS (SELECT label, min(strand) AS strand, string_agg(piece, '' ORDER BY k, c) AS seq FROM bits GROUP BY label),
dna AS (SELECT label, CASE strand WHEN '-' THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq FROM seqs) """
add("r27_extract", lambda s, d: rg.extract(regions(s, d), _dna(s)).select("label", F.md5("seq").alias("seq_md5"), F.length("seq").cast("long").alias("n")), _ctes("exons") + _SEQ + "SELECT label, md5(seq) AS seq_md5, length(seq) AS n FROM dna")
add("r29_len", lambda s, d: rg.known_length(rg.extract(regions(s, d), _dna(s))).select("label", "n"), _ctes("exons") + _SEQ + "SELECT label, length(replace(seq, 'N', '')) AS n FROM dna")
_FIRST = _ctes("exons") + _SEQ.replace("FROM exons", "FROM exons WHERE k = 0")
add("r16_search", lambda s, d: rg.flat(rg.search(rg.extract(rg.select(regions(s, d), first=True), _dna(s)), "ACGTA|GNTTC")), _FIRST + """, spots AS (SELECT label, seq, unnest(range(1, length(seq) - 3)) AS p FROM dna)
SELECT label, cast(0 AS int) AS k, chrom, strand, CASE strand WHEN '-' THEN stop_ - p - 3 ELSE start_ + p - 1 END AS start, CASE strand WHEN '-' THEN stop_ - p + 1 ELSE start_ + p + 3 END AS stop
FROM spots JOIN few USING (label) WHERE regexp_matches(substr(seq, p, 5), '^(ACGTA|G.TTC)$')""")
add("r30_known", lambda s, d: rg.flat(rg.known_runs(rg.extract(rg.select(regions(s, d), first=True), _dna(s)))), _FIRST + """, spots AS (SELECT label, seq, unnest(range(1, length(seq) + 1)) AS p FROM dna),
known AS (SELECT label, p, p - row_number() OVER (PARTITION BY label ORDER BY p) AS run FROM spots WHERE substr(seq, p, 1) <> 'N'), runs AS (SELECT label, min(p) AS a, max(p) AS b FROM known GROUP BY label, run)
SELECT label, cast(row_number() OVER (PARTITION BY label ORDER BY a) - 1 AS int) AS k, chrom, strand, start_ + a - 1 AS start, start_ + b - 1 AS stop FROM runs JOIN few USING (label)""")
add("r31_verify", lambda s, d: rg.verify(rg.extract(regions(s, d), _dna(s)).select(F.col("seq").alias("label"), "intervals"), _dna(s)).agg(F.count("*").alias("n"), F.sum(F.col("ok").cast("long")).alias("n_ok")), _ctes("exons") + "SELECT count(DISTINCT label) AS n, cast(count(DISTINCT label) AS bigint) AS n_ok FROM exons")

# sets -------------------------------------------------------------------------------------------
REFS, READS = lambda s, d: fixture(s, d, "refs"), lambda s, d: fixture(s, d, "reads")
RANGE = "chrom, strand, start_ AS start, stop_ AS stop"
LINKED = lambda gap, keys, src="refs": f"""(SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY start_, stop_, label) AS chain FROM (SELECT *, CASE WHEN start_ - max(stop_) OVER (PARTITION BY {keys} ORDER BY start_, stop_, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap} THEN 0 ELSE 1 END AS fresh FROM {src}) AS a) AS b"""
add("v01_annotator", lambda s, d: st.upstream(REFS(s, d), 5000, 500), _ctes("refs") + """SELECT concat('upstream:', label) AS label, chrom, strand, start, stop FROM (SELECT label, chrom, strand,
 greatest(1, CASE strand WHEN '+' THEN least(greatest(start_ - 5000, coalesce(b + 1, start_ - 5000)), start_ - 500) ELSE stop_ + 1 END) AS start,
 CASE strand WHEN '+' THEN start_ - 1 ELSE greatest(least(stop_ + 5000, coalesce(f - 1, stop_ + 5000)), stop_ + 500) END AS stop FROM (SELECT *,
 max(stop_) OVER (PARTITION BY chrom, strand ORDER BY start_, stop_, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
 min(start_) OVER (PARTITION BY chrom, strand ORDER BY start_, stop_, label ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS f FROM refs) AS x) AS y WHERE start <= stop""")
add("v02_gdist", lambda s, d: st.gap_distances(REFS(s, d)).select("label", "distance"), _ctes("refs") + "SELECT label, coalesce(cast(lead(start_) OVER (PARTITION BY chrom, strand ORDER BY start_, stop_, label) - stop_ AS double), 'nan'::double) AS distance FROM refs")
add("v03_gsort", lambda s, d: st.global_sort(READS(s, d)), _ctes("reads") + f"SELECT label, {RANGE} FROM reads")
add("v04_inv", lambda s, d: st.inverse(st.link(REFS(s, d)), fixture(s, d, "bounds")), _ctes("refs", "bounds") + f""", l AS (SELECT chrom, strand, min(start_) AS s, max(stop_) AS e FROM {LINKED(0, 'chrom, strand')} GROUP BY chrom, strand, chain),
n AS (SELECT *, lag(e, 1, 0) OVER w AS b, lead(s) OVER w AS f FROM l WINDOW w AS (PARTITION BY chrom, strand ORDER BY s))
SELECT '_' AS label, chrom, strand, b + 1 AS start, s - 1 AS stop FROM n WHERE b + 1 <= s - 1 UNION ALL SELECT '_', n.chrom, strand, e + 1, size FROM n JOIN bounds ON n.chrom = bounds.chrom WHERE f IS NULL AND e + 1 < size""")
add("v05_link", lambda s, d: st.link(READS(s, d), 5), _ctes("reads") + f"SELECT '_' AS label, chrom, strand, min(start_) AS start, max(stop_) AS stop FROM {LINKED(5, 'chrom, strand', 'reads')} GROUP BY chrom, strand, chain")
add("v05_link_labels", lambda s, d: st.link(REFS(s, d), 0, True, ","), _ctes("refs") + f"SELECT string_agg(label, ',' ORDER BY start_, stop_, label) AS label, chrom, strand, min(start_) AS start, max(stop_) AS stop FROM {LINKED(0, 'chrom, strand')} GROUP BY chrom, strand, chain")
add("v05_link_max", lambda s, d: st.link(READS(s, d).withColumn("label", (F.col("stop") - F.col("start")).cast("string")), 20, True, "max").select(F.col("label").cast("double").alias("v"), "chrom", "strand", "start", "stop"), _ctes("reads") + f"SELECT cast(max(stop_ - start_) AS double) AS v, chrom, strand, min(start_) AS start, max(stop_) AS stop FROM {LINKED(20, 'chrom, strand', 'reads')} GROUP BY chrom, strand, chain")
add("v06_test", lambda s, d: st.test_sorted(REFS(s, d)), _ctes("refs") + "SELECT count(*) AS n, cast(sum(CASE WHEN start_ >= s0 AND stop_ <= e0 THEN 1 ELSE 0 END) AS bigint) AS inclusions, cast(sum(CASE WHEN start_ <= e0 THEN 1 ELSE 0 END) AS bigint) AS overlaps FROM (SELECT *, lag(start_) OVER w AS s0, lag(stop_) OVER w AS e0 FROM refs WINDOW w AS (PARTITION BY chrom, strand ORDER BY start_, stop_, label)) AS x")
add("v07_cluster", lambda s, d: st.leaders(REFS(s, d)), _ctes("refs").replace("WITH", "WITH RECURSIVE", 1) + """, o AS (SELECT *, row_number() OVER (PARTITION BY chrom, strand ORDER BY start_, stop_ DESC, label) AS n FROM refs),
nx AS (SELECT o.chrom, o.strand, o.n, min(p.n) AS m FROM o LEFT JOIN o p ON p.chrom = o.chrom AND p.strand = o.strand AND p.start_ > o.stop_ GROUP BY o.chrom, o.strand, o.n),
w AS (SELECT chrom, strand, n FROM nx WHERE n = 1 UNION ALL SELECT w.chrom, w.strand, nx.m FROM w JOIN nx ON w.chrom = nx.chrom AND w.strand = nx.strand AND w.n = nx.n WHERE nx.m IS NOT NULL)
SELECT label, chrom, strand, start_ AS start, stop_ AS stop FROM o JOIN w USING (chrom, strand, n)""")
add("v08_partition", lambda s, d: st.partition(REFS(s, d)), _ctes("refs") + """, cuts AS (SELECT chrom, strand, start_ AS p FROM refs UNION SELECT chrom, strand, stop_ + 1 FROM refs), segs AS (SELECT chrom, strand, p AS start, lead(p) OVER (PARTITION BY chrom, strand ORDER BY p) - 1 AS stop FROM cuts)
SELECT s.chrom, s.strand, start, stop, string_agg(label, ',' ORDER BY label) AS label FROM segs s JOIN refs r ON s.chrom = r.chrom AND s.strand = r.strand AND start <= stop_ AND stop >= start_ GROUP BY s.chrom, s.strand, start, stop""")
add("v09_rev", lambda s, d: st.reverse_minus(REFS(s, d)), _ctes("refs") + f"SELECT label, {RANGE} FROM refs")
add("v10_scan_labels", lambda s, d: st.global_scan(REFS(s, d), fixture(s, d, "bounds"), 2000, 1000), _ctes("refs") + """SELECT chrom, strand, 1000 * w + 1 AS start, 1000 * w + 2000 AS stop, string_agg(label, ',' ORDER BY start_, label) AS labels FROM (SELECT *, (start_ - 1) // 1000 - b AS w FROM refs CROSS JOIN (VALUES (0), (1)) AS bs(b)) AS x WHERE w >= 0 AND w < 1000100 // 1000 - 1 GROUP BY chrom, strand, w""")
add("v11_sortbed", lambda s, d: st.sort_bed(READS(s, d), True), _ctes("reads") + f"SELECT label, {RANGE} FROM reads")

# overlaps ---------------------------------------------------------------------------------------
HIT = "t.chrom = r.chrom AND t.strand = r.strand AND t.start_ <= r.stop_ AND t.stop_ >= r.start_"
ANY = "t.chrom = r.chrom AND t.start_ <= r.stop_ AND t.stop_ >= r.start_"
BOTH = _ctes("reads", "refs")
EXONS = lambda s, d: rg.flat(regions(s, d))
add("j01_overlap", lambda s, d: ov.overlap(READS(s, d), REFS(s, d), label=True), BOTH + f"SELECT concat(t.label, ':', r.label) AS label, t.chrom, t.strand, t.start_ AS start, t.stop_ AS stop FROM reads t JOIN refs r ON {HIT}")
add("j01_overlap_any_strand", lambda s, d: ov.overlap(READS(s, d), REFS(s, d), True), BOTH + f"SELECT t.label, t.chrom, t.strand, t.start_ AS start, t.stop_ AS stop FROM reads t JOIN refs r ON {ANY}")
add("j01_overlap_regions", lambda s, d: ov.region_overlap_join(single(READS(s, d)), regions(s, d)).select("a_label", "b_label"), _ctes("reads", "exons") + f"SELECT label AS a_label, other AS b_label FROM (SELECT DISTINCT rid, t.label, r.label AS other FROM (SELECT *, row_number() OVER () AS rid FROM reads) t JOIN exons r ON {HIT}) AS x")
add("j01_overlap_gaps", lambda s, d: ov.region_overlap_join(single(READS(s, d)), regions(s, d), gaps=True).select("a_label", "b_label"), _ctes("reads", "exons") + f"SELECT t.label AS a_label, r.label AS b_label FROM reads t JOIN (SELECT label, min(chrom) AS chrom, min(strand) AS strand, min(start_) AS start_, max(stop_) AS stop_ FROM exons GROUP BY label) r ON {HIT}")
add("j02_intersect", lambda s, d: ov.intersect(READS(s, d), REFS(s, d)), BOTH + f"SELECT t.label, t.chrom, t.strand, greatest(t.start_, r.start_) AS start, least(t.stop_, r.stop_) AS stop FROM reads t JOIN refs r ON {HIT}")
add("j03_subset", lambda s, d: ov.subset(READS(s, d), REFS(s, d)), BOTH + f"SELECT label, {RANGE} FROM reads t WHERE EXISTS (SELECT 1 FROM refs r WHERE {HIT})")
add("j03_subset_inv", lambda s, d: ov.subset(READS(s, d), REFS(s, d), invert=True), BOTH + f"SELECT label, {RANGE} FROM reads t WHERE NOT EXISTS (SELECT 1 FROM refs r WHERE {HIT})")
add("j03_subset_any_strand", lambda s, d: ov.subset(READS(s, d), REFS(s, d), True), BOTH + f"SELECT label, {RANGE} FROM reads t WHERE EXISTS (SELECT 1 FROM refs r WHERE {ANY})")
PER = lambda v, extra="": BOTH + f"SELECT r.label, r.chrom, r.strand, r.start_ AS start, r.stop_ AS stop, {v} FROM refs r LEFT JOIN reads t ON {HIT} GROUP BY r.label, r.chrom, r.strand, r.start_, r.stop_ {extra}"
BASES = "coalesce(sum(CASE WHEN t.label IS NULL THEN 0 ELSE least(t.stop_, r.stop_) - greatest(t.start_, r.start_) + 1 END), 0)"
add("j04_count", lambda s, d: ov.count(READS(s, d), REFS(s, d)), PER("count(t.label) AS n"))
add("j04_count_weighted", lambda s, d: ov.count(READS(s, d), REFS(s, d), max_label_value=100, least=50), PER("cast(coalesce(sum(CASE WHEN t.label IS NULL THEN 0 ELSE least(100, cast(split_part(t.label, '.', 1) AS bigint)) END), 0) AS bigint) AS n", "HAVING coalesce(sum(CASE WHEN t.label IS NULL THEN 0 ELSE least(100, cast(split_part(t.label, '.', 1) AS bigint)) END), 0) >= 50"))
add("j05_coverage", lambda s, d: ov.coverage(READS(s, d), REFS(s, d)), PER(f"cast({BASES} AS bigint) AS n"))
add("j06_density", lambda s, d: ov.density(READS(s, d), REFS(s, d)), PER(f"{BASES} / cast(r.stop_ - r.start_ + 1 AS double) AS density"))
add("j07_rpkm", lambda s, d: ov.rpkm(READS(s, d), REFS(s, d)), BOTH + f", h AS (SELECT r.label, r.chrom, r.strand, r.start_ AS start, r.stop_ AS stop, count(t.label) AS n FROM refs r LEFT JOIN reads t ON {HIT} GROUP BY ALL) SELECT label, chrom, strand, start, stop, 1000.0 * n / (stop - start + 1) / (sum(n) OVER () / 1e6) AS rpkm FROM h")
add("j08_offset", lambda s, d: ov.offset(READS(s, d), REFS(s, d), "5p"), BOTH + f"SELECT t.label AS a_label, r.label AS b_label, CASE r.strand WHEN '+' THEN t.start_ - r.start_ ELSE r.stop_ - t.stop_ END AS low, CASE r.strand WHEN '+' THEN t.stop_ - r.start_ ELSE r.stop_ - t.start_ END AS high FROM reads t JOIN refs r ON {HIT}")
add("j08_offset_fraction", lambda s, d: ov.offset(READS(s, d), REFS(s, d), "1", fraction=True), BOTH + f"SELECT t.label AS a_label, r.label AS b_label, (t.start_ - r.start_) / cast(r.stop_ - r.start_ + 1 AS double) AS low, (t.stop_ - r.start_) / cast(r.stop_ - r.start_ + 1 AS double) AS high FROM reads t JOIN refs r ON {HIT}")
add("j08_offset_gapless", lambda s, d: ov.gapless_offset(READS(s, d), regions(s, d)), _ctes("reads", "exons") + """, e AS (SELECT *, coalesce(sum(stop_ - start_ + 1) OVER (PARTITION BY label ORDER BY start_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(stop_ - start_ + 1) OVER (PARTITION BY label) AS total FROM exons)
SELECT t.label AS a_label, r.label AS b_label, cast(CASE r.strand WHEN '-' THEN total - 1 - (before + t.start_ - r.start_) ELSE before + t.start_ - r.start_ END AS bigint) AS "offset" FROM reads t JOIN e r ON t.chrom = r.chrom AND t.strand = r.strand AND t.start_ BETWEEN r.start_ AND r.stop_""")
UP = ORACLE_SQL["v01_annotator"].removeprefix(_ctes("refs"))
add("j09_annotate", lambda s, d: ov.annotate(READS(s, d), REFS(s, d), "1", 5000, 500, 1000), _ctes("reads", "refs") + f""", up AS ({UP}), o AS (
SELECT t.label, r.label AS ref, CASE r.strand WHEN '+' THEN t.start_ - r.start_ ELSE r.stop_ - t.start_ END AS "offset" FROM reads t JOIN refs r ON {ANY} UNION ALL
SELECT t.label, r.label, CASE r.strand WHEN '+' THEN t.start_ - r.stop ELSE r.start - t.start_ END FROM reads t JOIN up r ON t.chrom = r.chrom AND t.start_ <= r.stop AND t.stop_ >= r.start)
SELECT label, ref, "offset", CASE WHEN abs("offset") <= 1000 THEN 'proximal' ELSE 'distal' END AS class FROM o""")
add("j10_annotate2", lambda s, d: ov.annotate_territory(READS(s, d), REFS(s, d), 3000, 500, 1000), _ctes("reads", "refs") + """, w AS (SELECT label, chrom, strand, greatest(1, start_ - CASE strand WHEN '+' THEN 3000 ELSE 500 END) AS start_, stop_ + CASE strand WHEN '+' THEN 500 ELSE 3000 END AS stop_, CASE strand WHEN '+' THEN start_ ELSE stop_ END AS tss FROM refs),
h AS (SELECT t.label, r.label AS ref, CASE r.strand WHEN '+' THEN t.start_ - tss ELSE tss - t.stop_ END AS lo, CASE r.strand WHEN '+' THEN t.stop_ - tss ELSE tss - t.start_ END AS hi FROM reads t LEFT JOIN w r ON t.chrom = r.chrom AND t.start_ <= r.stop_ AND t.stop_ >= r.start_)
SELECT label, coalesce(ref, 'NA') AS ref, lo AS d_start, hi AS d_stop, CASE WHEN ref IS NULL THEN 'intergenic' WHEN least(abs(lo), abs(hi)) <= 1000 OR (lo < 0 AND hi > 0) THEN 'proximal' WHEN hi < 0 THEN 'upstream' ELSE 'downstream' END AS class FROM h""")
add("j11_bin", lambda s, d: ov.bin_pairs(fixture(s, d, "pairs"), REFS(s, d)), _ctes("pairs", "refs") + "SELECT id, a.label AS ref1, b.label AS ref2 FROM pairs p JOIN refs a ON a.chrom = chrom1 AND pos1 BETWEEN a.start_ AND a.stop_ JOIN refs b ON b.chrom = chrom2 AND pos2 BETWEEN b.start_ AND b.stop_")
add("j12_reduce", lambda s, d: ov.reduce(single(REFS(s, d)).withColumn("row_id", F.substring("label", 2, 20).cast("long"))).select("row_id", "label"), _ctes("refs") + f", n AS (SELECT *, cast(substr(label, 2) AS bigint) AS row_id FROM refs) SELECT row_id, label FROM n t WHERE NOT EXISTS (SELECT 1 FROM n r WHERE {HIT} AND r.row_id < t.row_id)")
add("j12_reduce_regions", lambda s, d: ov.reduce(regions(s, d).withColumn("row_id", F.substring("label", 2, 20).cast("long"))).select("row_id", "label"), _ctes("exons") + f", n AS (SELECT *, cast(substr(label, 2) AS bigint) AS row_id FROM exons), m AS (SELECT t.row_id, r.row_id AS other, count(DISTINCT t.k) AS c FROM n t JOIN n r ON {HIT} AND r.row_id < t.row_id GROUP BY t.row_id, r.row_id) SELECT DISTINCT row_id, label FROM n WHERE row_id NOT IN (SELECT row_id FROM m WHERE c = 3)")
add("j13_dist", lambda s, d: ov.breakpoint_distances(fixture(s, d, "pairs"), REFS(s, d).select("chrom", F.col("start").alias("pos")), 2000).select("id", "d1", "d2"), _ctes("pairs", "refs") + ", c AS (SELECT id, 1 AS k, start_ - pos1 AS x, start_ AS p FROM pairs JOIN refs ON chrom = chrom1 AND abs(start_ - pos1) <= 2000 UNION ALL SELECT id, 2, start_ - pos2, start_ FROM pairs JOIN refs ON chrom = chrom2 AND abs(start_ - pos2) <= 2000), n AS (SELECT id, k, arg_min(x, abs(x) * 10000000 + p) AS x FROM c GROUP BY id, k) SELECT p.id, a.x AS d1, b.x AS d2 FROM pairs p LEFT JOIN n a ON a.id = p.id AND a.k = 1 LEFT JOIN n b ON b.id = p.id AND b.k = 2")
