"""Queries and SQL of domain calls, smoothing in two dimensions and paths over lambda."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociframe.operators import contact as ct
from lociframe.operators import fusion as fu
from lociframe.operators import topdomains as td
from lociframe.plans.cell_queries import CELLS, CON, DENSE, OTHER, SIZES

QUERIES: dict = {}
ORACLE_SQL: dict = {}
WINDOW = 5


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


# domain calls, of matrices whose bins 40 to 46 and 60 to 61 no read maps to --------------------------
UNMAPPED = "(({0} BETWEEN 40 AND 46) OR ({0} BETWEEN 60 AND 61))"
HOLED = lambda s, d: CELLS(s, d).where(f"NOT {UNMAPPED.format('i')} AND NOT {UNMAPPED.format('j')}")
BINS = lambda s, d: td.stretches(td.gaps(HOLED(s, d), SIZES(s, d)))
GAPS = CON.replace("WITH", "WITH RECURSIVE", 1) + f""", hol AS (SELECT * FROM cells WHERE NOT {UNMAPPED.format('i')} AND NOT {UNMAPPED.format('j')}),
bins AS (SELECT chrom, cast(b AS bigint) AS i FROM (SELECT unnest(['chr1','chr2','chr3','chr4','chr5']) AS chrom) AS c CROSS JOIN range(101) AS r(b)), first AS (SELECT chrom, i, min(j) AS f FROM hol GROUP BY chrom, i),
ends AS (SELECT b.chrom, b.i, min(coalesce(f, 101)) OVER (PARTITION BY b.chrom ORDER BY b.i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM bins b LEFT JOIN first f ON f.chrom = b.chrom AND f.i = b.i),
blocks AS (SELECT chrom, cast(0 AS bigint) AS k, greatest(1, e) AS stop FROM ends WHERE i = 0 UNION ALL SELECT b.chrom, b.stop, greatest(b.stop + 1, e.e) FROM blocks b JOIN ends e ON e.chrom = b.chrom AND e.i = b.stop WHERE b.stop < 100),
gaps AS (SELECT b.chrom, b.i, count(k.k) > 0 AS gap FROM bins b LEFT JOIN blocks k ON k.chrom = b.chrom AND k.stop - k.k > 1 AND b.i >= k.k AND b.i < k.stop GROUP BY b.chrom, b.i),
runs AS (SELECT chrom, i, i - row_number() OVER (PARTITION BY chrom ORDER BY i) AS run FROM gaps WHERE NOT gap),
stretch AS (SELECT *, min(i) OVER (PARTITION BY chrom, run) AS low, max(i) OVER (PARTITION BY chrom, run) AS high FROM runs QUALIFY count(*) OVER (PARTITION BY chrom, run) >= 4) """
add("c30_gaps", lambda s, d: td.gaps(HOLED(s, d), SIZES(s, d)), GAPS + "SELECT * FROM gaps")
add("c30_stretches", BINS, GAPS + "SELECT chrom, i, low, high FROM stretch")
SCALED = f""", dense AS (SELECT b.chrom, b.i, b.i + d AS j, d, coalesce(x, 0) AS x FROM bins b CROSS JOIN range(1, {2 * WINDOW + 1}) AS ds(d) LEFT JOIN hol h ON h.chrom = b.chrom AND h.i = b.i AND h.j = b.i + d WHERE b.i + d <= 100),
scl AS (SELECT chrom, i, j, d, (x - avg(x) OVER w) / nullif(stddev_samp(x) OVER w, 0) AS z FROM dense WINDOW w AS (PARTITION BY chrom, d)) """
add("c30_standardised", lambda s, d: td.standardised(HOLED(s, d), SIZES(s, d), 2 * WINDOW).withColumn("x", F.round("x", 6) + F.lit(0.0)), GAPS + SCALED + "SELECT chrom, i, j, round(z, 6) + cast(0 AS double) AS x FROM scl")
RANKS = f""", dealt AS (SELECT s.chrom, s.i, round(z, 9) AS z, c.i <= s.i AND c.j > s.i AS across FROM stretch s JOIN scl c ON c.chrom = s.chrom AND s.i < s.high AND c.i >= s.low AND c.j <= s.high AND c.i >= s.i - {WINDOW} AND c.j <= s.i + {WINDOW}
  AND (c.j <= s.i OR c.i > s.i OR c.i > s.i - {WINDOW}) WHERE z IS NOT NULL),
ties AS (SELECT chrom, i, z, count(*) AS k, count(*) FILTER (across) AS a FROM dealt GROUP BY chrom, i, z), place AS (SELECT *, sum(k) OVER (PARTITION BY chrom, i ORDER BY z) - (k - 1) / 2.0 AS r FROM ties),
test AS (SELECT chrom, i, sum(a * r) AS w, sum(a) AS n, sum(k) - sum(a) AS m, sum(k) AS t, sum(cast(k AS double) * k * k - k) AS tie FROM place GROUP BY chrom, i),
zs AS (SELECT s.chrom, s.i, (w - n * (n + 1) / 2 - n * m / 2 + 0.5) / sqrt(n * m / 12.0 * (t + 1 - tie / (t * (t - 1)))) AS z FROM stretch s LEFT JOIN test t ON t.chrom = s.chrom AND t.i = s.i) """
add("c30_tests", lambda s, d: td.tests(HOLED(s, d), SIZES(s, d), BINS(s, d), WINDOW).select("chrom", "i", (F.round("z", 6) + F.lit(0.0)).alias("z")), GAPS + SCALED + RANKS + "SELECT chrom, i, round(z, 6) + cast(0 AS double) AS z FROM zs")
# change points: each round of the recursion goes one bin further, or bends
BENDS = f""", dia AS (SELECT s.chrom, s.i, s.low, s.high, CASE WHEN s.i = 100 THEN 0 ELSE coalesce(sum(x), 0) / (least({WINDOW}, s.i + 1) * least({WINDOW}, 100 - s.i)) END AS x FROM stretch s LEFT JOIN hol h ON h.chrom = s.chrom AND h.i BETWEEN s.i - {WINDOW - 1} AND s.i AND h.j BETWEEN s.i + 1 AND s.i + {WINDOW} GROUP BY s.chrom, s.i, s.low, s.high),
raw AS (SELECT chrom, low, list(x ORDER BY i) AS x FROM dia GROUP BY chrom, low), sig AS (SELECT chrom, low, len(x) AS n, list_transform(x, lambda v: x[1] + (v - x[1]) / nullif(list_sum([abs(x[k + 1] - x[k]) FOR k IN range(1, len(x))]) / (len(x) - 1), 0)) AS y FROM raw),
walk AS (SELECT chrom, low, n, y, cast(1 AS bigint) AS a0, cast(2 AS bigint) AS j, sqrt(1 + (y[2] - y[1]) ** 2) AS best, cast([1] AS bigint[]) AS bends, false AS done FROM sig WHERE y[1] IS NOT NULL
  UNION ALL SELECT chrom, low, n, y, CASE WHEN j = n OR v >= best THEN a0 ELSE j END, CASE WHEN j = n THEN j ELSE j + 1 END, CASE WHEN j = n OR v >= best THEN v ELSE sqrt(1 + (y[j + 1] - y[j]) ** 2) END, CASE WHEN j = n OR v >= best THEN bends ELSE list_append(bends, j) END, j = n
  FROM (SELECT *, c - coalesce(list_sum([abs((y[j + 1] - y[a0]) * (k - a0) - (j + 1 - a0) * (y[k] - y[a0])) FOR k IN range(a0 + 1, j + 1)]), 0) / c AS v FROM (SELECT *, sqrt((j + 1 - a0) ** 2 + (y[j + 1] - y[a0]) ** 2) AS c FROM walk WHERE NOT done))),
bent AS (SELECT chrom, low, n, y, unnest(list_append(bends, n)[2:len(bends)]) AS b, unnest(bends[1:len(bends) - 1]) AS a FROM walk WHERE done),
part AS (SELECT *, y[a:b] AS p FROM bent), ext AS (SELECT chrom, low + b - 1 AS i, CASE WHEN y[b] >= y[b - 1] AND y[b] >= y[b + 1] THEN 1 WHEN y[b] < y[b - 1] AND y[b] < y[b + 1] THEN -1 END AS e FROM part
  UNION ALL SELECT chrom, low + a - 2 + list_position(p, list_min(p)), -1 FROM part WHERE list_min(p) < least(y[a], y[b]) UNION ALL SELECT chrom, low + a - 2 + list_position(p, list_max(p)), 1 FROM part WHERE list_max(p) > greatest(y[a], y[b])),
marks AS (SELECT chrom, i, max(e) AS e FROM ext WHERE e IS NOT NULL GROUP BY chrom, i), extremes AS (SELECT d.chrom, d.i, d.low, d.high, d.x, cast(coalesce(e, 0) AS int) AS extreme FROM dia d LEFT JOIN marks m ON m.chrom = d.chrom AND m.i = d.i) """
add("c30_extremes", lambda s, d: td.extremes(BINS(s, d).join(ct.diamond_means(HOLED(s, d), SIZES(s, d), WINDOW), ["chrom", "i"])), GAPS + BENDS + "SELECT * FROM extremes")
#: The z whose lower tail is 0.05.
Z05 = -1.6448536269514722
DOMAINS = f""", signal AS (SELECT b.chrom, b.i, CASE WHEN extreme = -1 AND (z IS NULL OR z >= {Z05}) THEN 0 ELSE extreme END AS e, coalesce(z < {Z05}, false) AS low FROM bins b LEFT JOIN extremes x ON x.chrom = b.chrom AND x.i = b.i LEFT JOIN zs ON zs.chrom = b.chrom AND zs.i = b.i),
kinds AS (SELECT *, CASE WHEN e IS NULL THEN 'gap' WHEN e = -1 THEN 'end' ELSE 'domain' END AS kind FROM signal),
news AS (SELECT *, kind <> 'end' AND kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY chrom ORDER BY i) AND (i = 0 OR i <> max(i) OVER (PARTITION BY chrom, kind)) AS new FROM kinds),
parts AS (SELECT *, count(*) FILTER (new) OVER (PARTITION BY chrom ORDER BY i) AS part FROM news)
SELECT chrom, min(i) * 10000 AS start, (max(i) + 1) * 10000 AS stop, CASE WHEN arg_min(kind, i) = 'domain' AND bool_and(low) THEN 'boundary' ELSE arg_min(kind, i) END AS tag FROM parts WHERE part > 0 GROUP BY chrom, part"""
add("c30_domains", lambda s, d: td.domains(td.domain_signal(HOLED(s, d), SIZES(s, d), WINDOW), 10000).select("chrom", "start", "stop", "tag"), GAPS + SCALED + RANKS + BENDS + DOMAINS)
add("c30_domains_untested", lambda s, d: td.domains(td.domain_signal(HOLED(s, d), SIZES(s, d), WINDOW, None), 10000).select("chrom", "start", "stop", "tag"), GAPS + SCALED + RANKS + BENDS + DOMAINS.replace(f"CASE WHEN extreme = -1 AND (z IS NULL OR z >= {Z05}) THEN 0 ELSE extreme END", "extreme").replace("bool_and(low)", "false"))

# marks on a matrix ---------------------------------------------------------------------------------
SIGNAL = lambda s, d: ct.connectivity_difference(CELLS(s, d), SIZES(s, d), 4)
MARKS = CON + """, sig AS (SELECT g.chrom, g.i, CASE WHEN g.i >= 4 AND g.i < 97 THEN abs(coalesce(sum(CASE WHEN f.j > f.i THEN x ELSE -x END), 0)) ELSE 0 END AS x FROM (SELECT DISTINCT chrom, cast(b AS bigint) AS i FROM cells CROSS JOIN range(101) AS r(b)) AS g
  LEFT JOIN ful f ON f.chrom = g.chrom AND f.i = g.i AND f.i <> f.j AND abs(f.i - f.j) <= 4 GROUP BY g.chrom, g.i),
flat AS (SELECT chrom, i, CASE WHEN x < avg(x) OVER w THEN min(x) OVER w ELSE x END AS x FROM sig WINDOW w AS (PARTITION BY chrom)), step AS (SELECT chrom, i, (x - lag(x) OVER (PARTITION BY chrom ORDER BY i)) / nullif(max(abs(x)) OVER (PARTITION BY chrom), 0) AS s FROM flat),
way AS (SELECT chrom, i, CASE WHEN abs(s) >= 0.1 THEN sign(s) ELSE 0 END AS e FROM step), b AS (SELECT chrom, i, CASE WHEN i IN (0, 100) OR (e = 1 AND lead(e) OVER (PARTITION BY chrom ORDER BY i) = -1) THEN 1 ELSE 0 END AS boundary FROM way),
two AS (SELECT chrom, i AS low, lead(i) OVER (PARTITION BY chrom ORDER BY i) AS high FROM b WHERE boundary = 1), scored AS (SELECT t.chrom, low, high, coalesce(sum(CASE WHEN c.i = c.j THEN x ELSE 2 * x END), 0) AS score FROM two t LEFT JOIN cells c ON c.chrom = t.chrom AND c.i >= low AND c.j <= high WHERE high IS NOT NULL GROUP BY t.chrom, low, high),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY score DESC, low) <= 4) """
BOUNDS = lambda s, d: td.extrema(SIGNAL(s, d), SIZES(s, d), 0.1)
add("c27_extrema", BOUNDS, MARKS + "SELECT chrom, i, cast(boundary AS int) AS boundary FROM b")
add("c27_mark_domains", lambda s, d: td.mark_domains(CELLS(s, d), BOUNDS(s, d), 4), MARKS + "SELECT * FROM best")
add("c27_marked_cells", lambda s, d: td.marked(td.mark_domains(CELLS(s, d), BOUNDS(s, d), 4)), MARKS + "SELECT DISTINCT chrom, cast(p AS bigint) AS i, cast(q AS bigint) AS j, cast(1 AS double) AS x FROM best CROSS JOIN range(101) AS ps(p) CROSS JOIN range(101) AS qs(q) WHERE p >= low AND q <= high AND p <= q")
add("c27_count_domains", lambda s, d: td.count_domains(BOUNDS(s, d), 4), MARKS + "SELECT chrom, count(*) FILTER (high - low + 1 >= 4) AS n FROM two WHERE high IS NOT NULL GROUP BY chrom")

# smoothing, and paths over lambda ------------------------------------------------------------------
TENTHS = lambda df: df.withColumn("x", F.round("x", 2))
add("c10_smooth_2d", lambda s, d: fu.smooth(fu.dense(CELLS(s, d), SIZES(s, d)), [0.5], 0.1, 1e-3))
add("c27_alternate", lambda s, d: fu.alternate(fu.dense(CELLS(s, d), SIZES(s, d)), 0.5, 0.1, 50.0))
PATH = lambda cells: lambda s, d: ct.estimate(cells(s, d), SIZES(s, d), [0.0, 0.5, 2.0]).withColumn("x", F.round("x", 6))
add("c13_by_lambda", lambda s, d: fu.path_correlations(PATH(CELLS)(s, d), PATH(OTHER)(s, d), [3, 10, 50], "spearman"))
add("c13_best_lambda", lambda s, d: fu.best_lambda(fu.degrees_of_freedom(PATH(CELLS)(s, d), 50), fu.degrees_of_freedom(PATH(OTHER)(s, d), 50)))
ZERO = lambda cells: lambda s, d: ct.full(cells(s, d)).withColumn("lam", F.lit(0.0))
add("c15_freedom", lambda s, d: fu.degrees_of_freedom(ZERO(CELLS)(s, d)), CON.replace("WITH", "WITH RECURSIVE", 1) + """, reach(chrom, i, j, k, l) AS (SELECT chrom, i, j, i, j FROM ful UNION SELECT r.chrom, r.i, r.j, b.i, b.j FROM reach r JOIN ful a ON a.chrom = r.chrom AND a.i = r.k AND a.j = r.l JOIN ful b ON b.chrom = a.chrom AND b.x = a.x AND abs(b.i - a.i) <= 1 AND abs(b.j - a.j) <= 1),
least AS (SELECT chrom, i, j, min(k * 1000 + l) AS root FROM reach GROUP BY chrom, i, j) SELECT chrom, cast(0 AS double) AS lam, count(DISTINCT root) AS df FROM least GROUP BY chrom""")
add("c15_plateaus", lambda s, d: fu.plateaus(DENSE(s, d).na.fill(0.0, ["x"]), 0.5))
DENSE2 = lambda cells: lambda s, d: fu.dense(cells(s, d), SIZES(s, d)).withColumn("lam", F.lit(0.0))
BANDS = """, al AS (SELECT c.chrom, a.i, b.j, coalesce(f.x, 0) AS x, coalesce(o.x, 0) AS y FROM (SELECT DISTINCT chrom FROM cells) AS c CROSS JOIN range(101) AS a(i) CROSS JOIN range(101) AS b(j) LEFT JOIN cells f ON f.chrom = c.chrom AND f.i = a.i AND f.j = b.j LEFT JOIN other o ON o.chrom = c.chrom AND o.i = a.i AND o.j = b.j WHERE a.i <= b.j),
band AS (SELECT chrom, hi AS dist, x, y FROM al JOIN (VALUES (0, 3), (3, 10), (10, 50)) AS t(lo, hi) ON j - i BETWEEN lo AND hi), ranks AS (SELECT chrom, dist, rank() OVER (PARTITION BY chrom, dist ORDER BY x) + (count(*) OVER (PARTITION BY chrom, dist, x) - 1) / 2.0 AS x, rank() OVER (PARTITION BY chrom, dist ORDER BY y) + (count(*) OVER (PARTITION BY chrom, dist, y) - 1) / 2.0 AS y FROM band) """
for method, source in (("pearson", "band"), ("spearman", "ranks")):
    add(f"c13_{method}", lambda s, d, m=method: fu.path_correlations(DENSE2(CELLS)(s, d), DENSE2(OTHER)(s, d), [3, 10, 50], m).withColumn("r", F.round("r", 9)), CON + BANDS + f"SELECT chrom, cast(0 AS double) AS lam, cast(dist AS int) AS dist, round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 9) AS r FROM {source} GROUP BY chrom, dist")
