"""Queries and SQL of the vector, matrix, table and statistics operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociframe.functions import arrays as ar
from lociframe.operators import matrix as mx
from lociframe.operators import stats as sx
from lociframe.operators import tables as tb
from lociframe.sources.fixtures import SQL, fixture, table

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("label"), F.transform("embedding", lambda x: F.round(x.cast("double") * 100) + F.lit(0.0)).alias("v"))


def _asked(spark, sf_dir):
    """The vectors that are compared with all others where pairs of rows are asked for: those whose id 20 divides."""
    return _vectors(spark, sf_dir).where("label % 20 = 0")


VEC = "WITH vec AS (SELECT vec_id AS label, [round(cast(x AS double) * 100) + cast(0 AS double) FOR x IN embedding] AS v FROM embeddings), cell AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM vec) "


def scalar(name, f, sql):
    add(name, lambda s, d: _vectors(s, d).select("label", f(F.col("v")).alias("y")), VEC + f"SELECT label, {sql} AS y FROM cell GROUP BY label")


def element(name, f, sql):
    """Element-wise results, exploded with their places."""
    add(name, lambda s, d: _vectors(s, d).select("label", F.posexplode(f(F.col("v"))).alias("i", "y")), VEC + f"SELECT label, cast(i AS int) AS i, {sql}")


scalar("vc01_absmax", ar.absmax, "CASE WHEN abs(max(x)) > abs(min(x)) THEN max(x) ELSE min(x) END")
add("vc02_bins", lambda s, d: _vectors(s, d).select("label", F.posexplode(ar.histogram(F.col("v"), -40.0, 10.0, 8)).alias("b", "n")), VEC + "SELECT label, cast(b AS int) AS b, cast(sum(CASE WHEN x >= -40 + 10 * b AND x < -30 + 10 * b THEN 1 ELSE 0 END) AS int) AS n FROM cell CROSS JOIN range(8) AS bs(b) GROUP BY label, b")
add("vc02_bins_merged", lambda s, d: _vectors(s, d).select("label", F.posexplode(ar.histogram(F.col("v"), -40.0, 10.0, 8, 3)).alias("b", "n")), VEC + "SELECT label, cast(b AS int) AS b, cast(sum(CASE WHEN x >= -40 + 10 * b AND x < -10 + 10 * b THEN 1 ELSE 0 END) AS int) AS n FROM cell CROSS JOIN range(6) AS bs(b) GROUP BY label, b")
element("vc03_cutoff", lambda v: ar.cutoff(v, 0.0), "CASE WHEN x < 0 THEN 0 ELSE x END AS y FROM cell")
element("vc03_cutoff_above", lambda v: ar.cutoff(v, 10.0, 10.0, True), "CASE WHEN x > 10 THEN 10 ELSE x END AS y FROM cell")
element("vc04_div", lambda v: ar.divide_by_first(F.transform(v, lambda x: x + 200)), "y FROM (SELECT label, i - 1 AS i, (x + 200) / (first_value(x) OVER (PARTITION BY label ORDER BY i) + 200) AS y FROM cell) AS c WHERE i >= 0")
element("vc05_exp", lambda v: ar.exponents(F.transform(v, lambda x: x / 100), 2.0), "pow(2.0, x / 100) AS y FROM cell")
element("vc06_fold", lambda v: ar.fold_changes(F.transform(v, lambda x: x + 200))[0], "y FROM (SELECT label, i - 1 AS i, (x + 200) / (first_value(x) OVER (PARTITION BY label ORDER BY i) + 200) - 1 AS y FROM cell) AS c WHERE i >= 0")
element("vc06_fold_step", lambda v: ar.fold_changes(F.transform(v, lambda x: x + 200))[1], "y FROM (SELECT label, i - 1 AS i, (x + 200) / (lag(x) OVER (PARTITION BY label ORDER BY i) + 200) - 1 AS y FROM cell) AS c WHERE i >= 0")
add("vc07_format", lambda s, d: _vectors(s, d).select("label", ar.formatted(F.col("v"), 1, ",").alias("y")), VEC + "SELECT label, string_agg(printf('%.1f', x), ',' ORDER BY i) AS y FROM cell GROUP BY label")
add("vc08_hist", lambda s, d: _hist(s, d), VEC + "SELECT cast(b AS int) AS b, count(x) AS n, count(x) / (SELECT cast(count(*) AS double) FROM cell) AS share FROM range(8) AS bs(b) LEFT JOIN cell ON floor((x + 40) / 10) = b GROUP BY b")


def _hist(s, d):
    cell = mx.cells(_vectors(s, d))
    n = cell.where((F.col("value") >= -40) & (F.col("value") < 40)).groupBy(F.floor((F.col("value") + 40) / 10).cast("int").alias("b")).agg(F.count("*").alias("n"))
    total = cell.agg(F.count("*").cast("double").alias("t"))
    return s.range(8).select(F.col("id").cast("int").alias("b")).join(n, "b", "left").join(F.broadcast(total)).select("b", F.coalesce("n", F.lit(0).cast("long")).alias("n"), (F.coalesce("n", F.lit(0)) / F.col("t")).alias("share"))


scalar("vc09_imax", lambda v: ar.place_of(v, ar.largest(v)), "cast(arg_min(i, (-x) * 1000 + i) AS int)")
scalar("vc09_imin", lambda v: ar.place_of(v, ar.smallest(v)), "cast(arg_min(i, x * 1000 + i) AS int)")
add("vc10_items", lambda s, d: _vectors(s, d).select("label", F.explode(ar.items(F.col("v"), 100)).alias("y")), VEC + "SELECT label, cast(100 * i + trunc(x) AS bigint) AS y FROM cell WHERE x <> 0")
element("vc11_log", lambda v: ar.logs(F.transform(v, F.abs), 2.0, 1.0), "ln(abs(x) + 1) / ln(2) AS y FROM cell")
scalar("vc12_m", ar.mean, "avg(x)")
add("vc12_m_trimmed", lambda s, d: _vectors(s, d).select("label", ar.mean(F.col("v"), 0.1).alias("y")), VEC + "SELECT label, avg(x) AS y FROM (SELECT label, x, row_number() OVER (PARTITION BY label ORDER BY x) AS r, count(*) OVER (PARTITION BY label) AS n FROM cell) AS c WHERE r > floor(n * 0.1) AND r <= n - floor(n * 0.1) GROUP BY label")
for key, f, sql in (("max", ar.largest, "max(x)"), ("min", ar.smallest, "min(x)"), ("sum", ar.total, "sum(x)"), ("n", ar.count, "cast(count(x) AS int)")):
    scalar(f"vc13_{key}", f, sql)
scalar("vc14_med", ar.median, "quantile_cont(x, 0.5)")
scalar("vc14_q1", lambda v: ar.quantile(v, 0.25), "quantile_cont(x, 0.25)")
add("vc15_merge", lambda s, d: tb.merge_values(fixture(s, d, "keyed_rows"), "key", "value", "row_id", " ", True, ["user_id"]).select("user_id", "key", "merged"), f"WITH k AS ({SQL['keyed_rows']}), f AS (SELECT *, CASE WHEN lag(key) OVER (PARTITION BY user_id ORDER BY row_id) = key THEN 0 ELSE 1 END AS fresh FROM k), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY row_id) AS island FROM f) SELECT user_id, key, string_agg(cast(value AS varchar), ' ' ORDER BY row_id) AS merged FROM g GROUP BY user_id, island, key")
element("vc16_norm", ar.normalised, "(x - avg(x) OVER (PARTITION BY label)) / stddev_pop(x) OVER (PARTITION BY label) AS y FROM cell")
element("vc16_norm_range", ar.ranged, "(x - min(x) OVER (PARTITION BY label)) / (max(x) OVER (PARTITION BY label) - min(x) OVER (PARTITION BY label)) AS y FROM cell")
add("vc17_pairs", lambda s, d: _asked(s, d).alias("a").join(_vectors(s, d).alias("b"), F.col("a.label") != F.col("b.label")).select(F.concat_ws("|", F.col("a.label").cast("string"), F.col("b.label").cast("string")).alias("label"), (F.col("a.v")[0] + F.col("b.v")[0]).alias("y")), VEC + "SELECT concat(a.label, '|', b.label) AS label, a.v[1] + b.v[1] AS y FROM vec a JOIN vec b ON a.label <> b.label WHERE a.label % 20 = 0")
add("vc18_shuffle", lambda s, d: mx.shuffled(_vectors(s, d), 5).select("label", F.array_sort("v")[0].alias("least")), VEC + "SELECT label, min(x) AS least FROM cell GROUP BY label")
element("vc19_pow", lambda v: ar.powers(v, 2.0), "x * x AS y FROM cell")
element("vc20_rank", ar.ranks, "cast(row_number() OVER (PARTITION BY label ORDER BY x, i) AS double) AS y FROM cell")
element("vc21_rev", F.reverse, "y FROM (SELECT label, (SELECT max(len(v)) FROM vec) - 1 - i AS i, x AS y FROM cell) AS c")
element("vc21_sort", F.array_sort, "y FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY x) - 1 AS i, x AS y FROM cell) AS c")
scalar("vc22_sd", ar.deviation, "stddev_pop(x)")
add("vc23_slide", lambda s, d: _vectors(s, d).select("label", F.posexplode(ar.slices(F.col("v"), 2, 3)).alias("k", "w")).select("label", "k", ar.total(F.col("w")).alias("y")), VEC + "SELECT label, cast(k AS int) AS k, sum(x) AS y FROM cell JOIN range(20) AS ks(k) ON i BETWEEN 3 * k AND 3 * k + 4 WHERE 3 * k + 5 <= 64 GROUP BY label, k")
add("vc24_sparse", lambda s, d: _vectors(s, d).select("label", F.array_join(ar.sparse(F.col("v")), " ").alias("y")), VEC + "SELECT label, string_agg(concat(i, ':', cast(x AS varchar)), ' ' ORDER BY i) AS y FROM cell WHERE x <> 0 GROUP BY label")
add("vc25_stat", lambda s, d: _vectors(s, d).select("label", *[f(F.col("v")).alias(n) for n, f in (("n", ar.count), ("total", ar.total), ("lo", ar.smallest), ("hi", ar.largest), ("mean", ar.mean), ("sd", ar.deviation), ("med", ar.median))]), VEC + "SELECT label, cast(count(x) AS int) AS n, sum(x) AS total, min(x) AS lo, max(x) AS hi, avg(x) AS mean, stddev_pop(x) AS sd, median(x) AS med FROM cell GROUP BY label")
element("vc26_test", lambda v: ar.test(v, 5.0, True, True), "CASE WHEN x >= 5 THEN 1 ELSE 0 END AS y FROM cell")
PAIR = VEC + ", p AS (SELECT a.label, a.x, b.x AS z FROM cell a JOIN cell b ON b.label = a.label + 1 AND a.i = b.i) "


def pair(name, f, sql):
    def q(s, d):
        a, b = _vectors(s, d), _vectors(s, d).select((F.col("label") - 1).alias("label"), F.col("v").alias("w"))
        return a.join(b, "label").select("label", f(F.col("v"), F.col("w")).alias("y"))

    add(name, q, PAIR + f"SELECT label, {sql} AS y FROM p GROUP BY label")


pair("vl_covariance", lambda a, b: F.round(ar.covariance(a, b) * 4096), "round(covar_pop(x, z) * 4096)")
pair("vl_correlation", ar.correlation, "corr(x, z)")
pair("vl_euclidean", ar.euclidean, "sqrt(sum((x - z) * (x - z)))")
pair("vl_hamming", ar.hamming, "cast(sum(CASE WHEN x <> z THEN 1 ELSE 0 END) AS int)")
pair("vl_jaccard", lambda a, b: ar.jaccard(ar.cutoff(a, 10.0), ar.cutoff(b, 10.0)), "cast(sum(CASE WHEN x >= 10 AND z >= 10 THEN 1 ELSE 0 END) AS double) / sum(CASE WHEN x >= 10 OR z >= 10 THEN 1 ELSE 0 END)")
pair("vl_chi_square", lambda a, b: ar.chi_square(F.transform(a, lambda x: x + 200), F.transform(b, lambda x: x + 200)), "sum((x - z) * (x - z) / (z + 200))")
scalar("vl_norm", ar.length, "sqrt(sum(x * x))")
scalar("vl_entropy", lambda v: ar.entropy(F.transform(v, lambda x: x + 200)), "-sum((x + 200) / 1.0 * log2(x + 200)) / sum(x + 200) + log2(sum(x + 200))")
scalar("vl_variability", ar.variability, "(SELECT avg(s) FROM (SELECT abs(x - lag(x) OVER (ORDER BY i)) AS s FROM cell c2 WHERE c2.label = cell.label) AS q)")
element("vl_smooth", lambda v: ar.smoothed(v, 2), "avg(x) OVER (PARTITION BY label ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS y FROM cell")

# matrices: rows vec_id, columns from 0 -----------------------------------------------------------
CELLS = lambda s, d: mx.cells(_vectors(s, d))
ASKED = lambda s, d: mx.cells(_asked(s, d))
MAT = VEC + ", m AS (SELECT label AS \"row\", cast(i AS int) AS col, x AS value FROM cell), few AS (SELECT * FROM m WHERE \"row\" % 20 = 0) "
R = '"row"'


def cellwise(name, f, value, rest="FROM m"):
    add(name, lambda s, d: f(CELLS(s, d)), MAT + f"SELECT {R}, col, {value} AS value {rest}")


add("m01_transpose", lambda s, d: mx.transpose(CELLS(s, d)), MAT + f'SELECT col AS "row", {R} AS col, value FROM m')
cellwise("m02_norm", lambda m: mx.scaled(m, 3.0, 2.0), "(value - 3) / 2")
cellwise("m03_rnorm", mx.row_normalised, f"(value - avg(value) OVER (PARTITION BY {R})) / stddev_pop(value) OVER (PARTITION BY {R})")
cellwise("m03_rnorm_range", lambda m: mx.row_normalised(m, True), f"(value - min(value) OVER (PARTITION BY {R})) / (max(value) OVER (PARTITION BY {R}) - min(value) OVER (PARTITION BY {R}))")
cellwise("m04_cnorm", mx.col_normalised, "(value - avg(value) OVER (PARTITION BY col)) / stddev_pop(value) OVER (PARTITION BY col)")
add("m05_cstat", lambda s, d: mx.col_stats(CELLS(s, d)), MAT + "SELECT col, sum(value) AS sum, min(value) AS min, max(value) AS max, avg(value) AS avg, stddev_pop(value) AS std FROM m GROUP BY col")
add("m06_rstat", lambda s, d: mx.row_stats(CELLS(s, d)).drop("cv"), MAT + f"SELECT {R}, sum(value) AS sum, min(value) AS min, max(value) AS max, avg(value) AS avg, stddev_pop(value) AS std, count(*) AS n FROM m GROUP BY {R}")
add("m07_csum", lambda s, d: mx.col_sums(CELLS(s, d)), MAT + "SELECT col, sum(value) AS sum FROM m GROUP BY col")
cellwise("m08_cutoff", lambda m: mx.cutoff(m, 0.0), "CASE WHEN value < 0 THEN 0 ELSE value END")
cellwise("m09_test", lambda m: mx.test(m, 0.0, True), "CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END::double")
add("m10_pairs", lambda s, d: mx.row_pairs(ASKED(s, d), CELLS(s, d)), MAT + "SELECT a.\"row\" AS row1, b.\"row\" AS row2, count(*) AS n, sum(a.value) AS sum_x, sum(b.value) AS sum_y, sum(a.value * b.value) AS sum_xy, sum(a.value * a.value) AS sum_xx, sum(b.value * b.value) AS sum_yy FROM few a JOIN m b ON a.col = b.col GROUP BY 1, 2")
add("m12_encode", lambda s, d: mx.encode(CELLS(s, d), 100), MAT + f"SELECT {R}, col, cast(col * 100 + trunc(value) AS bigint) AS code FROM m")
add("m15_shrink", lambda s, d: mx.shrink(mx.cutoff(CELLS(s, d), 25.0)), MAT + f"SELECT {R}, col, CASE WHEN value < 25 THEN 0 ELSE value END AS value FROM m WHERE col IN (SELECT col FROM m WHERE value >= 25)")
cellwise("m16_mult", lambda m: mx.multiplied(m, 3.0), "value * 3")
add("m17_diag", lambda s, d: mx.diagonal_band(CELLS(s, d), 5).where(~F.isnan("value")), MAT + f"SELECT {R}, col, value FROM m WHERE abs({R} - col) <= 5")
add("m18_rel", lambda s, d: mx.relative(CELLS(s, d).withColumn("value", F.col("value") + 200)), MAT + f"SELECT {R}, col, value FROM (SELECT {R}, col, (value + 200) / (lag(value) OVER (PARTITION BY {R} ORDER BY col) + 200) AS value FROM m) AS c WHERE col > 0")
add("m18_rel_first", lambda s, d: mx.relative(CELLS(s, d).withColumn("value", F.col("value") + 200), "first"), MAT + f"SELECT {R}, col, value FROM (SELECT {R}, col, (value + 200) / (first_value(value) OVER (PARTITION BY {R} ORDER BY col) + 200) AS value FROM m) AS c WHERE col > 0")
add("m18_rel_all", lambda s, d: mx.relative_all(CELLS(s, d).withColumn("value", F.col("value") + 200)), MAT + f"SELECT a.{R}, a.col AS col1, b.col AS col2, (b.value + 200) / (a.value + 200) AS value FROM m a JOIN m b ON a.{R} = b.{R} AND a.col < b.col")
add("m19_del", lambda s, d: mx.uncorrelated(_vectors(s, d), 0.3).select("label"), VEC.replace("WITH", "WITH RECURSIVE", 1) + """, few AS (SELECT * FROM cell), e AS (SELECT a.label AS l1, b.label AS l2 FROM few a JOIN few b ON a.i = b.i AND a.label < b.label GROUP BY 1, 2 HAVING corr(a.x, b.x) > 0.3),
g AS MATERIALIZED (SELECT l2, list(l1) AS earlier FROM e GROUP BY l2), o AS MATERIALIZED (SELECT l.label, row_number() OVER (ORDER BY l.label) AS n, earlier FROM (SELECT DISTINCT label FROM few) AS l LEFT JOIN g ON l2 = l.label),
w AS (SELECT cast(0 AS bigint) AS n, cast([] AS bigint[]) AS kept UNION ALL SELECT o.n, CASE WHEN coalesce(list_has_any(kept, earlier), false) THEN kept ELSE list_append(kept, label) END FROM w JOIN o ON o.n = w.n + 1)
SELECT unnest(kept) AS label FROM (SELECT arg_max(kept, n) AS kept FROM w) AS x""")
add("m20_corr", lambda s, d: mx.correlations(ASKED(s, d), CELLS(s, d)).withColumn("r", F.round("r", 9) + F.lit(0.0)), MAT + "SELECT a.\"row\" AS row1, b.\"row\" AS row2, round(corr(a.value, b.value), 9) + cast(0 AS double) AS r FROM few a JOIN m b ON a.col = b.col GROUP BY 1, 2")
add("m21_corrp", lambda s, d: mx.bootstrap_correlations(ASKED(s, d), 5, 3, CELLS(s, d)))
add("m22_diff", lambda s, d: mx.differences(ASKED(s, d).withColumn("value", F.abs("value")), CELLS(s, d).withColumn("value", F.abs("value")), 2.0, 1.0), MAT + "SELECT a.\"row\" AS row1, b.\"row\" AS row2, cast(sum(CASE WHEN abs(a.value) + 1 > 2 * (abs(b.value) + 1) OR abs(b.value) + 1 > 2 * (abs(a.value) + 1) THEN 1 ELSE 0 END) AS bigint) AS n FROM few a JOIN m b ON a.col = b.col GROUP BY 1, 2")
add("m23_div", lambda s, d: mx.divided(CELLS(s, d), CELLS(s, d).withColumn("value", F.col("value") + 200)), MAT + f"SELECT {R}, col, value / (first_value(value) OVER (PARTITION BY {R} ORDER BY col) + 200) AS value FROM m")
add("m24_prod", lambda s, d: mx.ratios(ASKED(s, d), CELLS(s, d).withColumn("value", F.col("value") + 200)), MAT + f"SELECT a.{R} AS row1, b.{R} AS row2, a.col, a.value / (b.value + 200) AS value FROM few a JOIN m b ON a.col = b.col")
add("m25_reg", lambda s, d: mx.regressions(ASKED(s, d), CELLS(s, d)).select("row1", "row2", (F.round("c0", 6) + F.lit(0.0)).alias("c0"), (F.round("c1", 6) + F.lit(0.0)).alias("c1"), (F.round("chi2", 4) + F.lit(0.0)).alias("chi2")), MAT + f"SELECT row1, row2, round(c0, 6) + cast(0 AS double) AS c0, round(c1, 6) + cast(0 AS double) AS c1, round((syy - c1 * sxy) / n, 4) + cast(0 AS double) AS chi2 FROM (SELECT a.{R} AS row1, b.{R} AS row2, regr_intercept(b.value, a.value) AS c0, regr_slope(b.value, a.value) AS c1, regr_syy(b.value, a.value) AS syy, regr_sxy(b.value, a.value) AS sxy, count(*) AS n FROM few a JOIN m b ON a.col = b.col GROUP BY 1, 2) AS g")

# tables -----------------------------------------------------------------------------------------
TRI = f"WITH t AS ({SQL['triples']}) "
KINDS = ["click", "view", "purchase", "signup", "error"]
TRIPLES = lambda s, d: fixture(s, d, "triples")
add("t01_pivot", lambda s, d: tb.pivot(TRIPLES(s, d), KINDS), TRI + "SELECT k1, " + ", ".join(f"coalesce(sum(CASE WHEN k2 = '{k}' THEN value END), 0) AS {k}" for k in KINDS) + " FROM t GROUP BY k1")
add("t02_unpivot", lambda s, d: tb.unpivot(tb.pivot(TRIPLES(s, d), KINDS), "k1", KINDS, 500.0, True, True), TRI + ", p AS (SELECT k1, k2, sum(value) AS value FROM t GROUP BY k1, k2) SELECT k1, k2, value FROM p WHERE value >= 500")
add("t03_unpivot_all", lambda s, d: tb.unpivot(tb.pivot(TRIPLES(s, d), KINDS), "k1", KINDS), TRI + ", k AS (SELECT unnest(['" + "', '".join(KINDS) + "']) AS k2), u AS (SELECT DISTINCT k1 FROM t), p AS (SELECT k1, k2, sum(value) AS value FROM t GROUP BY k1, k2) SELECT u.k1, k.k2, coalesce(value, 0) AS value FROM u CROSS JOIN k LEFT JOIN p ON p.k1 = u.k1 AND p.k2 = k.k2")
add("t05_rnorm", lambda s, d: mx.row_normalised(TRIPLES(s, d).groupBy(F.col("k1").alias("row"), F.col("k2").alias("col")).agg(F.sum("value").alias("value"))), TRI + ", p AS (SELECT k1, k2, sum(value) AS value FROM t GROUP BY k1, k2) SELECT k1 AS \"row\", k2 AS col, coalesce((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 'nan'::double) AS value FROM p WINDOW w AS (PARTITION BY k1)")
CUST = lambda s, d: table(s, d, "customer").select("c_custkey", "c_name")
add("t06_permute", lambda s, d: tb.permute(CUST(s, d), 3), "SELECT c_custkey, c_name FROM customer")
add("t07_resample", lambda s, d: tb.resample(CUST(s, d), ["c_custkey"], 500, 9))
add("t08_number", lambda s, d: tb.number_rows(CUST(s, d), ["c_custkey"], "r").select("c_custkey", "row_name"), "SELECT c_custkey, concat('r', lpad(cast(row_number() OVER (ORDER BY c_custkey) AS varchar), 12, '0')) AS row_name FROM customer")
add("t09_select", lambda s, d: tb.select_rows(CUST(s, d), ["c_custkey"], [0, 5, 7, 99]), "SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) AS c WHERE i IN (0, 5, 7, 99)")
add("t09_exclude", lambda s, d: tb.select_rows(CUST(s, d), ["c_custkey"], [0, 5, 7, 99], True), "SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) AS c WHERE i NOT IN (0, 5, 7, 99)")
add("t10_period", lambda s, d: tb.every(CUST(s, d), ["c_custkey"], 7), "SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) AS c WHERE i % 7 = 0")
add("t10_merge", lambda s, d: tb.merge_every(CUST(s, d), ["c_custkey"], "c_custkey", 7, "+"), "SELECT i // 7 AS block, string_agg(cast(c_custkey AS varchar), '+' ORDER BY i) AS merged FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) AS c GROUP BY 1")
add("t11_cols", lambda s, d: tb.columns(table(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), [2, 0, 2]), "SELECT n_regionkey, n_nationkey, n_regionkey AS n_regionkey_2 FROM nation")
add("t12_join_columns", lambda s, d: tb.joined_columns(table(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), 2, ":"), "SELECT concat(n_nationkey, ':', n_name) AS key, n_regionkey FROM nation")
ISL = f"WITH k AS ({SQL['keyed_rows']}), f AS (SELECT *, CASE WHEN lag(key) OVER (PARTITION BY user_id ORDER BY row_id) = key THEN 0 ELSE 1 END AS fresh FROM k), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY row_id) AS island FROM f) "
KEYED = lambda s, d: fixture(s, d, "keyed_rows")
add("t13_add", lambda s, d: tb.merge_add(KEYED(s, d), "key", "value", "row_id", True, ["user_id"]).select("user_id", "island", "key", F.round("total", 4).alias("total"), "n"), ISL + "SELECT user_id, cast(island AS bigint) AS island, key, round(sum(value), 4) AS total, count(*) AS n FROM g GROUP BY user_id, island, key")
add("t13_add_all", lambda s, d: tb.merge_add(KEYED(s, d), "key", "value", "row_id", False).select("key", F.round("total", 2).alias("total"), "n"), ISL + "SELECT key, round(sum(value), 2) AS total, count(*) AS n FROM g GROUP BY key")
add("t14_vectors", lambda s, d: tb.merge_vectors(table(s, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.round(x.cast("double") * 100)).alias("v")), "label", "vec_id", "add", True, False).select("label", F.posexplode("v").alias("i", "y")), "SELECT label, cast(i AS int) AS i, avg(x) AS y FROM (SELECT label, round(cast(unnest(embedding) AS double) * 100) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) AS c GROUP BY label, i")
add("t15_merge", lambda s, d: tb.merge_values(KEYED(s, d), "key", "row_id", "row_id", ",", True, ["user_id"]).select("user_id", "key", "merged"), ISL + "SELECT user_id, key, string_agg(cast(row_id AS varchar), ',' ORDER BY row_id) AS merged FROM g GROUP BY user_id, island, key")
add("t16_expand", lambda s, d: tb.expand_keys(table(s, d, "part").select("p_partkey", "p_name"), "p_partkey", "p_name"), "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS value FROM part")
add("t17_repeated", lambda s, d: tb.repeated(table(s, d, "lineitem").select("l_orderkey", "l_linenumber")), "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
add("t18_gains", lambda s, d: tb.gains_and_losses(table(s, d, "part").select("p_partkey", (F.col("p_partkey") % 9 - 4).alias("lfc"), F.col("p_size").alias("val")), F.col("lfc"), F.col("val"), 2, 20), "SELECT p_partkey, p_partkey % 9 - 4 AS lfc, p_size AS val, CASE WHEN p_partkey % 9 - 4 >= 2 THEN 'gain' ELSE 'loss' END AS change FROM part WHERE abs(p_partkey % 9 - 4) >= 2 AND p_size >= 20")

# joins of tables ---------------------------------------------------------------------------------
NAT = lambda s, d: table(s, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name", "n_regionkey")
add("j14_join_tables", lambda s, d: tb.join_tables(table(s, d, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey"), NAT(s, d).where("n_regionkey < 3"), "k"), "SELECT c_nationkey AS k, c_custkey, n_name, n_regionkey FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) AS n ON c_nationkey = n_nationkey")
add("j15_multi_paste", lambda s, d: tb.multi_paste([NAT(s, d), table(s, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers")), table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))], "k"), "SELECT n_nationkey AS k, n_name, n_regionkey, customers, suppliers FROM nation JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) ON c_nationkey = n_nationkey JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey")
add("j16_annotate_pairs", lambda s, d: tb.annotate_pairs(table(s, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 30).alias("locus1"), (F.col("o_orderkey") % 30).alias("locus2")), NAT(s, d).select(F.col("k").alias("locus"), F.col("n_name").alias("note"))), "SELECT o_orderkey AS id, o_custkey % 30 AS locus1, o_orderkey % 30 AS locus2, coalesce(a.n_name, 'N/A') AS note1, coalesce(b.n_name, 'N/A') AS note2 FROM orders LEFT JOIN nation a ON a.n_nationkey = o_custkey % 30 LEFT JOIN nation b ON b.n_nationkey = o_orderkey % 30")
SHEET = lambda s, d: NAT(s, d).join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("sample"), F.col("r_name").alias("group"), F.when(F.col("k") % 3 == 0, "NONE").otherwise(F.lit("CHINA")).alias("control"))
SHEET_SQL = "WITH sheet AS (SELECT n_name AS sample, r_name AS \"group\", CASE WHEN n_nationkey % 3 = 0 THEN 'NONE' ELSE 'CHINA' END AS control FROM nation JOIN region ON n_regionkey = r_regionkey) "
add("j17_sheet", lambda s, d: tb.lookup(SHEET(s, d), "group", NAT(s, d).where("k < 9").select(F.col("n_name").alias("sample"))), SHEET_SQL + "SELECT sample, \"group\" FROM sheet WHERE sample IN (SELECT n_name FROM nation WHERE n_nationkey < 9)")
add("j20_controls", lambda s, d: tb.missing_controls(SHEET(s, d)), SHEET_SQL + "SELECT DISTINCT control AS sample FROM sheet WHERE control NOT IN (SELECT sample FROM sheet)")

# statistics ---------------------------------------------------------------------------------------
SUMS = lambda s, d: TRIPLES(s, d).groupBy(F.col("k1").alias("row"), F.col("k2").alias("col")).agg(F.round(F.sum("value"), 3).alias("value"))
SUMS_SQL = TRI + ", u AS (SELECT k1 AS \"row\", k2 AS col, round(sum(value), 3) AS value FROM t GROUP BY k1, k2) "
add("a01_quantile", lambda s, d: sx.quantile_normalise(SUMS(s, d)), SUMS_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY value, \"row\") AS r FROM u) SELECT \"row\", col, avg(value) OVER (PARTITION BY r) AS value FROM r")
V3 = lambda a: f"(v[{a}] + 200)"
FOLDS = lambda m: lambda s, d: _vectors(s, d).select("label", sx.fold(F.transform(F.slice("v", 1, 3), lambda x: x + 200), F.transform(F.slice("v", 4, 3), lambda x: x + 200), m).alias("y"))
add("a02_fold_mean", FOLDS("mean"), VEC + f"SELECT label, ({V3(1)} + {V3(2)} + {V3(3)}) / ({V3(4)} + {V3(5)} + {V3(6)}) AS y FROM vec")
add("a02_fold_paired", FOLDS("paired"), VEC + f"SELECT label, ({V3(1)} / {V3(4)} + {V3(2)} / {V3(5)} + {V3(3)} / {V3(6)}) / 3 AS y FROM vec")
add("a02_fold_pairwise", FOLDS("pairwise"), VEC + "SELECT label, (" + " + ".join(f"{V3(a)} / {V3(b)}" for a in (1, 2, 3) for b in (4, 5, 6)) + ") / 9 AS y FROM vec")
OBS = lambda s, d: table(s, d, "part").select((F.col("p_size") + F.col("p_partkey") % 7).cast("double").alias("x"))
BACK = lambda s, d: table(s, d, "part").select((F.col("p_partkey") % 40).cast("double").alias("x"))
FDR = """WITH o AS (SELECT cast(p_size + p_partkey % 7 AS double) AS x FROM part), b AS (SELECT cast(p_partkey % 40 AS double) AS x FROM part), v AS (SELECT DISTINCT x FROM o),
f AS (SELECT x, ((SELECT count(*) FROM b WHERE b.x >= v.x) / cast((SELECT count(*) FROM b) AS double)) / ((SELECT count(*) FROM o WHERE o.x >= v.x) / cast((SELECT count(*) FROM o) AS double)) AS f FROM v),
g AS (SELECT x, least(1.0, min(f) OVER (ORDER BY x)) AS fdr FROM f) """
add("a03_fdr", lambda s, d: sx.fdr(OBS(s, d), BACK(s, d)), FDR + "SELECT x, fdr FROM g")
add("a03_fdr_cutoff", lambda s, d: sx.fdr_cutoff(OBS(s, d), BACK(s, d), 0.3), FDR + "SELECT min(x) AS x FROM g WHERE fdr <= 0.3")
add("a04_binned_fdr", lambda s, d: sx.binned_fdr(OBS(s, d).withColumn("level", F.col("x") + 1), BACK(s, d).withColumn("level", F.col("x") + 1), 1.0), """WITH o AS (SELECT cast(p_size + p_partkey % 7 AS double) AS x FROM part), b AS (SELECT cast(p_partkey % 40 AS double) AS x FROM part),
ob AS (SELECT x, floor(log2(x + 1)) AS own FROM o), bb AS (SELECT x, floor(log2(x + 1)) AS own FROM b), bins AS (SELECT DISTINCT own + k AS bin FROM ob CROSS JOIN range(-2, 3) AS ks(k)),
v AS (SELECT DISTINCT bin, x FROM bins JOIN (SELECT * FROM ob UNION ALL SELECT * FROM bb) AS u ON abs(u.own - bin) <= 2),
f AS (SELECT bin, x, (SELECT count(*) FROM bb WHERE abs(own - bin) <= 2 AND bb.x >= v.x) / greatest((SELECT count(*) FROM bb WHERE abs(own - bin) <= 2), 1) / ((SELECT count(*) FROM ob WHERE abs(own - bin) <= 2 AND ob.x >= v.x) / cast((SELECT count(*) FROM ob WHERE abs(own - bin) <= 2) AS double)) AS f FROM v),
g AS (SELECT bin, x, least(1.0, min(f) OVER (PARTITION BY bin ORDER BY x)) AS fdr FROM f) SELECT cast(bin AS bigint) AS bin, x, fdr FROM g WHERE EXISTS (SELECT 1 FROM ob WHERE own = bin AND ob.x = g.x)""")
REPS = lambda s, d: _vectors(s, d).select(F.col("label").alias("row"), *[(F.col("v")[k] + 100).alias(f"c{k}") for k in range(4)])
add("a05_differential", lambda s, d: sx.differential(REPS(s, d), ["c0", "c1"], ["c2", "c3"], 1.0, 1.2, 0.5), VEC + """, c AS (SELECT label AS "row", greatest(v[1] + 100, 1) AS c0, greatest(v[2] + 100, 1) AS c1, greatest(v[3] + 100, 1) AS c2, greatest(v[4] + 100, 1) AS c3 FROM vec), o AS (SELECT "row", f AS fold, greatest(f, 1 / f) AS x FROM (SELECT "row", (c2 + c3) / (c0 + c1) AS f FROM c) AS g),
b AS (SELECT greatest(c0 / c1, c1 / c0) AS x FROM c UNION ALL SELECT greatest(c2 / c3, c3 / c2) FROM c), v AS (SELECT DISTINCT x FROM o),
f AS (SELECT x, ((SELECT count(*) FROM b WHERE b.x >= v.x) / cast((SELECT count(*) FROM b) AS double)) / ((SELECT count(*) FROM o WHERE o.x >= v.x) / cast((SELECT count(*) FROM o) AS double)) AS f FROM v), g AS (SELECT x, least(1.0, min(f) OVER (ORDER BY x)) AS fdr FROM f)
SELECT "row", fold, fdr, CASE WHEN o.x < 1.2 OR fdr > 0.5 THEN 'none' WHEN fold > 1 THEN 'gain' ELSE 'loss' END AS change FROM o JOIN g ON o.x = g.x""")
def loess_sql(name: str, source: str, x: str, y: str, least: float) -> str:
    """CTEs that end in ``name``: rows of source (row, ...) that local regression of y on x keeps, as operators.stats.without_outliers does."""
    n = name
    return f"""{n}l AS (SELECT min(v) AS least FROM (SELECT {x} AS v FROM {source} UNION ALL SELECT {y} FROM {source}) WHERE v > 0), {n}r AS (SELECT s.*, greatest({x}, least) AS lx, greatest({y}, least) AS ly FROM {source} s, {n}l),
{n}e AS (SELECT min(lx) AS lo, max(lx) AS hi, count(*) AS n FROM {n}r), {n}v AS (SELECT k, lo + (hi - lo) * k / 32 AS v, (hi - lo) / 32 AS step, n FROM {n}e CROSS JOIN range(33) AS ks(k)),
{n}d AS (SELECT k, v, lx - v AS dx, ly, n, row_number() OVER (PARTITION BY k ORDER BY abs(lx - v)) AS place FROM {n}v CROSS JOIN {n}r), {n}h AS (SELECT k, abs(dx) AS h FROM {n}d WHERE place = floor(n * 0.5 + 1e-5)),
{n}w AS (SELECT d.k, v, dx, ly, (1 - (abs(dx) / h) ** 3) ** 3 AS w FROM {n}d d JOIN {n}h h ON h.k = d.k WHERE abs(dx) < h),
{n}s AS (SELECT k, any_value(v) AS v, sum(w) AS s, sum(w * dx) AS sx, sum(w * dx * dx) AS sxx, sum(w * ly) AS sy, sum(w * dx * ly) AS sxy FROM {n}w GROUP BY k), {n}b AS (SELECT *, CASE WHEN s * sxx - sx * sx > 1e-9 * s * sxx THEN (s * sxy - sx * sy) / (s * sxx - sx * sx) ELSE 0 END AS b FROM {n}s), {n}a AS (SELECT k, v, b, (sy - b * sx) / s AS a FROM {n}b),
{n}t AS (SELECT r.*, step, (lx - p.v) / step AS t, p.a AS a0, p.b AS b0, q.a AS a1, q.b AS b1 FROM {n}r r, (SELECT lo, (hi - lo) / 32 AS step FROM {n}e) AS e JOIN {n}a p ON p.k = least(31, floor((lx - lo) / step)) JOIN {n}a q ON q.k = p.k + 1),
{n}z AS (SELECT *, ly - ((2 * t ** 3 - 3 * t ** 2 + 1) * a0 + (t ** 3 - 2 * t ** 2 + t) * step * b0 + (3 * t ** 2 - 2 * t ** 3) * a1 + (t ** 3 - t ** 2) * step * b1) AS r FROM {n}t),
{name} AS (SELECT * EXCLUDE (lx, ly, step, t, a0, b0, a1, b1, r) FROM {n}z QUALIFY exp(0 - pow((r - avg(r) OVER ()) / stddev_samp(r) OVER (), 2) / 2) / (stddev_samp(r) OVER () * sqrt(2 * pi())) > {least})"""


add("a06_outliers", lambda s, d: sx.without_outliers(REPS(s, d), "c0", "c1", 0.004), VEC + """, c AS (SELECT label AS "row", v[1] + 100 AS c0, v[2] + 100 AS c1, v[3] + 100 AS c2, v[4] + 100 AS c3 FROM vec), """ + loess_sql("stay", "c", "c0", "c1", 0.004) + " SELECT * FROM stay")
add("a08_pca", lambda s, d: sx.principal_components(_vectors(s, d).withColumnRenamed("label", "row"), 2).select("row", F.round(F.col("pc")[0], 4).alias("pc1"), F.round(F.col("pc")[1], 4).alias("pc2")))
add("a09_heat_rows", lambda s, d: sx.heat_rows(_vectors(s, d).select(F.col("label").alias("row"), F.transform("v", lambda x: x + 200).alias("v")), "rowmax", True, 0.5, 0.1, 100).select("row", F.array_max("v").alias("hi")), VEC + "SELECT label AS \"row\", log2(2) AS hi FROM (SELECT label, log2((min(x) + 200) / (max(x) + 200) + 1) AS lo FROM cell GROUP BY label) AS c WHERE 1 - lo >= 0.1 ORDER BY 1 - lo DESC, label LIMIT 100")
add("a09_clusters", lambda s, d: sx.clusters(_vectors(s, d).withColumnRenamed("label", "row"), 4))
MARKS = lambda s, d: table(s, d, "part").select(F.concat_ws(",", F.concat(F.lit("a"), F.col("p_size") % 3), F.concat(F.lit("b"), F.col("p_partkey") % 2)).alias("marks1"), F.concat_ws(",", F.concat(F.lit("a"), F.col("p_partkey") % 5), F.lit("z")).alias("marks2"))
add("a11_enrichment", lambda s, d: sx.co_occurrence(MARKS(s, d)), "WITH p AS (SELECT unnest([concat('a', p_size % 3), concat('b', p_partkey % 2)]) AS mark1, [concat('a', p_partkey % 5), 'z'] AS m2 FROM part), q AS (SELECT mark1, unnest(m2) AS mark2 FROM p), c AS (SELECT mark1, mark2, count(*) AS n FROM q GROUP BY 1, 2) SELECT mark1, mark2, n, n * (sum(n) OVER ()) / cast((sum(n) OVER (PARTITION BY mark1)) * (sum(n) OVER (PARTITION BY mark2)) AS double) AS enrichment FROM c")
add("a12_summary", lambda s, d: sx.summary(TRIPLES(s, d), ["k2"], "value"), TRI + "SELECT k2, avg(value) AS mean, min(value) AS min, max(value) AS max, count(value) AS n, stddev_samp(value) AS sd, stddev_samp(value) / sqrt(count(value)) AS se FROM t GROUP BY k2")
add("a13_shares", lambda s, d: sx.shares(SUMS(s, d), "row", "value"), SUMS_SQL + "SELECT \"row\", col, value, 100.0 * value / sum(value) OVER (PARTITION BY \"row\") AS percent FROM u")
add("a14_alignment", lambda s, d: sx.alignment_stats(table(s, d, "supplier").select(F.col("s_suppkey").alias("sample"), F.lit(1000.0).alias("total"), (F.col("s_suppkey") % 100 + 800.0).alias("aligned"), (F.col("s_suppkey") % 90 + 600.0).alias("unique"))), "SELECT s_suppkey AS sample, (s_suppkey % 100 + 800) / 10.0 AS aligned, (s_suppkey % 90 + 600) / 10.0 AS deduplicated, (200 - s_suppkey % 100) / 10.0 AS unaligned, (s_suppkey % 100 + 200 - s_suppkey % 90) / 10.0 AS duplicated FROM supplier")
