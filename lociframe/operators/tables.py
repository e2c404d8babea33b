"""Tables of keys and values, rows and columns: pivots, selections, merging of equal keys, joins of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.sources.scratch import keep


def pivot(df: DataFrame, columns: list | None = None, missing: float | None = 0.0) -> DataFrame:
    """(k1, one column for each k2) of triples (k1, k2, value): repeated keys add up; absent ones are ``missing``."""
    out = df.groupBy("k1").pivot("k2", columns).agg(F.sum("value"))
    return out.na.fill(float("nan") if missing is None else missing)


def unpivot(df: DataFrame, key: str, columns: list[str], c: float | None = None, greater: bool = False, equal: bool = False) -> DataFrame:
    """(k1, k2, value) of a table's columns; with c only values below it, or above, or equal too."""
    out = df.unpivot([key], columns, "k2", "value").withColumnRenamed(key, "k1")
    if c is None:
        return out
    x = F.col("value")
    return out.where((x > c if greater else x < c) | ((x == c) if equal else F.lit(False)))


def upper_triangle(df: DataFrame) -> DataFrame:
    return df.where("k1 < k2")


def numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns as numbers, NaN where they are none."""
    return df.withColumns({c: F.coalesce(F.expr(f"try_cast(`{c}` AS double)"), F.lit(float("nan"))) for c in columns})


def number_rows(df: DataFrame, order: list[str], prefix: str = "") -> DataFrame:
    """``row_name``: prefix and a number of 12 digits by order.

    Numbers come from a range-partitioned sort and the sizes of its partitions, not from one window over all rows.
    """
    return with_index(df, order).withColumn("row_name", F.concat(F.lit(prefix), F.lpad((F.col("index") + 1).cast("string"), 12, "0")))


def with_index(df: DataFrame, order: list[str]) -> DataFrame:
    """``index`` of each row from 0 by order.

    Rows and the numbers of their ranges are kept in the shared folder first: ranges are cut by a sample, and both
    readings, or a repeated task, must see the same ones.
    """
    placed = keep(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    spread = placed.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spread.select("_p", before.alias("_s"))
    w = Window.partitionBy("_p").orderBy(*order)
    return placed.join(F.broadcast(starts), "_p").withColumn("index", F.row_number().over(w) - 1 + F.col("_s")).drop("_p", "_s")


def select_rows(df: DataFrame, order: list[str], wanted: list[int], exclude: bool = False) -> DataFrame:
    ok = F.col("index").isin(*wanted)
    return with_index(df, order).where(~ok if exclude else ok).drop("index")


def every(df: DataFrame, order: list[str], period: int) -> DataFrame:
    return with_index(df, order).where(F.col("index") % period == 0).drop("index")


def merge_every(df: DataFrame, order: list[str], value: str, period: int, sep: str = "\t") -> DataFrame:
    """Values of each ``period`` successive rows joined."""
    rows = with_index(df, order).withColumn("block", F.floor(F.col("index") / period))
    return rows.groupBy("block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", F.col(value).cast("string").alias("x")))), lambda p: p.x), sep).alias("merged"))


def permute(df: DataFrame, seed: int) -> DataFrame:
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns))


def resample(df: DataFrame, order: list[str], n: int, seed: int) -> DataFrame:
    """n rows drawn with replacement."""
    rows = with_index(df, order)
    total = rows.agg((F.max("index") + 1).alias("total"))
    draws = df.sparkSession.range(n).join(F.broadcast(total)).select(F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("total")).alias("index"))
    return draws.join(rows, "index").drop("index")


def columns(df: DataFrame, wanted: list[int]) -> DataFrame:
    """Columns by place from 0, in this order, repeated ones with their place added."""
    if any(not 0 <= i < len(df.columns) for i in wanted):
        raise ValueError(f"columns go from 0 to {len(df.columns) - 1}")
    names = [df.columns[i] for i in wanted]
    return df.select(*[F.col(n).alias(n if n not in names[:k] else f"{n}_{k}") for k, n in enumerate(names)])


def joined_columns(df: DataFrame, first: int, sep: str) -> DataFrame:
    """The first columns as one text column, the rest as they are."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns[:first]]).alias("key"), *df.columns[first:])


def islands(df: DataFrame, key: str, order: str, within: list[str] | None = None) -> DataFrame:
    """``island``: a number for each run of successive rows of one key, inside groups of ``within``."""
    w = Window.partitionBy(*(within or [])).orderBy(order)
    new = F.when(F.lag(key).over(w).eqNullSafe(F.col(key)), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(w)).drop("_new")


def _grouped(df: DataFrame, key: str, order: str, consecutive: bool, within: list[str] | None) -> tuple[DataFrame, list[str]]:
    if consecutive:
        return islands(df, key, order, within), [*(within or []), "island", key]
    return df, [*(within or []), key]


def merge_add(df: DataFrame, key: str, value: str, order: str, consecutive: bool = True, within: list[str] | None = None) -> DataFrame:
    """Sums of value over successive rows of one key, or over all rows of it."""
    rows, by = _grouped(df, key, order, consecutive, within)
    return rows.groupBy(*by).agg(F.sum(value).alias("total"), F.count("*").alias("n"))


def merge_values(df: DataFrame, key: str, value: str, order: str, sep: str = ",", consecutive: bool = True, within: list[str] | None = None) -> DataFrame:
    rows, by = _grouped(df, key, order, consecutive, within)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(value).cast("string").alias("_x")))), lambda p: p["_x"]), sep)
    return rows.groupBy(*by).agg(joined.alias("merged"))


def merge_vectors(df: DataFrame, key: str, order: str, func: str = "add", average: bool = False, consecutive: bool = True) -> DataFrame:
    """Vectors v of one key folded element by element in order: add, sub, prod or div; by their number if averaged."""
    rows, by = _grouped(df, key, order, consecutive, None)
    g = rows.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "v"))), lambda p: p.v).alias("vs"))
    op = {"add": lambda a, b: a + b, "sub": lambda a, b: a - b, "prod": lambda a, b: a * b, "div": lambda a, b: a / b}[func]
    folded = F.aggregate(F.slice("vs", F.lit(2), F.greatest(F.size("vs") - 1, F.lit(0))), F.col("vs")[0], lambda s, v: F.zip_with(s, v, op))
    return g.select(*by, (F.transform(folded, lambda x: x / F.size("vs")) if average else folded).alias("v"))


def expand_keys(df: DataFrame, key: str, values: str, sep: str = " ") -> DataFrame:
    return df.select(key, F.explode(F.split(values, sep)).alias("value"))


def join_tables(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b, key, "left")


def multi_paste(tables: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key), tables)


def annotate_pairs(pairs: DataFrame, notes: DataFrame, missing: str = "N/A") -> DataFrame:
    """(locus1, locus2, …) with note1 and note2 of notes (locus, note)."""
    n = lambda k: notes.distinct().select(F.col("locus").alias(f"locus{k}"), F.col("note").alias(f"note{k}"))
    return pairs.join(n(1), "locus1", "left").join(n(2), "locus2", "left").na.fill(missing, ["note1", "note2"])


def lookup(sheet: DataFrame, column: str, names: DataFrame | None = None, key: str = "sample") -> DataFrame:
    return (sheet if names is None else sheet.join(names, key, "left_semi")).select(key, column)


def missing_controls(sheet: DataFrame) -> DataFrame:
    """Controls of (sample, control) that are no sample."""
    return sheet.where("control IS NOT NULL").select(F.col("control").alias("sample")).distinct().join(sheet.select("sample"), "sample", "left_anti")


def repeated(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("n")).where("n > 1").drop("n")


def gains_and_losses(df: DataFrame, log2fold: Column, value: Column, fold: float, least: float) -> DataFrame:
    """``change``: gain or loss, with at least ``least`` of value; the strongest first."""
    kind = F.when(log2fold >= fold, "gain").when(log2fold <= -fold, "loss")
    return df.withColumn("change", kind).where(kind.isNotNull() & (value >= least)).orderBy("change", F.desc(F.abs(log2fold)))
