"""Regions, read pairs and matrices taken from the star-schema tables, for the registered queries.

Each table is one SQL text that Spark and DuckDB both run, so that a query and its SQL start alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions.interval import interval

#: Chromosomes of the fixtures and their common length.
CHROMS, LENGTH = 5, 1_000_100

SQL = {
    "reads": """SELECT concat(cast(l_orderkey AS varchar(20)), '.', cast(l_linenumber AS varchar(20))) AS label, concat('chr', cast(1 + l_suppkey % 5 AS varchar(20))) AS chrom,
        CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, 1 + (l_partkey * 7919 + l_orderkey * 31 + l_linenumber * 17) % 1000000 AS start_,
        (l_partkey * 7919 + l_orderkey * 31 + l_linenumber * 17) % 1000000 + cast(l_quantity AS bigint) AS stop_ FROM lineitem""",
    "refs": """SELECT concat('g', cast(p_partkey AS varchar(20))) AS label, concat('chr', cast(1 + p_partkey % 5 AS varchar(20))) AS chrom,
        CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, 1 + (p_partkey * 104729) % 990000 AS start_, 1 + (p_partkey * 104729) % 990000 + p_size * 100 AS stop_ FROM part""",
    "exons": """SELECT concat('g', cast(p_partkey AS varchar(20))) AS label, concat('chr', cast(1 + p_partkey % 5 AS varchar(20))) AS chrom,
        CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, k, 1 + (p_partkey * 104729) % 990000 + k * p_size * 40 AS start_,
        1 + (p_partkey * 104729) % 990000 + k * p_size * 40 + p_size * (CASE k WHEN 0 THEN 45 WHEN 1 THEN 20 ELSE 10 END) AS stop_
        FROM part CROSS JOIN (VALUES (0), (1), (2)) AS ks(k)""",
    "bounds": "SELECT concat('chr', cast(c AS varchar(20))) AS chrom, cast(1000100 AS bigint) AS size FROM (VALUES (1), (2), (3), (4), (5)) AS cs(c)",
    "pairs": """SELECT o_orderkey AS id, concat('chr', cast(1 + o_custkey % 5 AS varchar(20))) AS chrom1, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand1,
        1 + (o_orderkey * 7919) % 1000000 AS pos1, concat('chr', cast(1 + (o_custkey + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) % 5 AS varchar(20))) AS chrom2,
        CASE WHEN o_custkey % 3 = 0 THEN '+' ELSE '-' END AS strand2, 1 + (o_orderkey * 7919 + (o_custkey * 131) % 50000) % 1000000 AS pos2, 20 + o_orderkey % 30 AS mapq FROM orders""",
    "contacts": """SELECT chrom1 AS chrom, least((pos1 - 1 - (pos1 - 1) % 10000) / 10000, (pos2 - 1 - (pos2 - 1) % 10000) / 10000) AS i_,
        greatest((pos1 - 1 - (pos1 - 1) % 10000) / 10000, (pos2 - 1 - (pos2 - 1) % 10000) / 10000) AS j_ FROM pairs WHERE chrom1 = chrom2""",
    "triples": "SELECT cast(user_id AS varchar(20)) AS k1, event_type AS k2, cast(value AS double) AS value FROM events",
    "keyed_rows": "SELECT row_number() OVER (ORDER BY user_id, ts, event_id) AS row_id, user_id, event_type AS key, cast(value AS double) AS value FROM events",
}

_TABLES = {"reads": ["lineitem"], "refs": ["part"], "exons": ["part"], "bounds": [], "pairs": ["orders"], "contacts": ["orders"], "triples": ["events"], "keyed_rows": ["events"]}


def cells_sql() -> str:
    """Upper-triangle contact counts (chrom, i, j, n) in bins of 10,000, as SQL over the pairs."""
    return f"SELECT chrom, cast(i_ AS bigint) AS i, cast(j_ AS bigint) AS j, count(*) AS n FROM ({SQL['contacts']}) AS c GROUP BY chrom, i_, j_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame; intervals' ends are named start and stop."""
    sql = SQL[name]
    inner = {t: table(spark, sf_dir, t) for t in _TABLES[name]}
    if name == "contacts":
        return spark.sql(cells_sql().replace("FROM pairs", f"FROM ({SQL['pairs'].replace('FROM orders', 'FROM {orders}')}) AS pairs"), **inner)
    for t in inner:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    df = spark.sql(sql, **inner)
    for old, new in (("start_", "start"), ("stop_", "stop")):
        if old in df.columns:
            df = df.withColumn(new, F.col(old).cast("long")).drop(old)
    return df


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of three intervals, in one struct array a row: the exons."""
    e = fixture(spark, sf_dir, "refs").drop("start", "stop")
    part = table(spark, sf_dir, "part").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("label"), (1 + (F.col("p_partkey") * 104729) % 990000).alias("s"), F.col("p_size").cast("long").alias("p"))
    rows = e.join(part, "label")
    step = [rows.s + k * rows.p * 40 for k in range(3)]
    return rows.select("label", F.array(*[interval(F.col("chrom"), F.col("strand"), step[k], step[k] + rows.p * w) for k, w in enumerate((45, 20, 10))]).alias("intervals"))


def single(df: DataFrame) -> DataFrame:
    """Rows of one interval as regions: (label, intervals)."""
    return df.select("label", F.array(interval(F.col("chrom"), F.col("strand"), F.col("start"), F.col("stop"))).alias("intervals"))
