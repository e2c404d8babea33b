"""Shared helpers of the training-data operators: scratch tables, sized joins, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.sources.scratch import shared_dir

#: Rows of at most this many bytes in all may be broadcast; the size is counted first.
BROADCAST_BYTES = 16 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the file system removes it when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


class Kept:
    """A DataFrame written to the shared folder and read back: its lineage is the written table.

    Losing executors costs no recomputation of what is behind it. ``drop`` removes the files.
    """

    codec = None  # Parquet's; None: the session's

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path, self.schema = scratch_path(self.spark, name), df.schema
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")  # a shuffle's files end with its write, for the table is read from now on
        try:
            df.write.parquet(self.path, compression=self.codec)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        self.df = self.read()

    def read(self) -> DataFrame:
        """The table once more, with columns of its own, as a side of a join with itself."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        _remove(self.spark, self.path)


class KeptTexts(Kept):
    """A table that is mostly text: smaller by a third than with the session's codec."""

    codec = "zstd"


def keep(df: DataFrame, name: str) -> DataFrame:
    return Kept(df, name).df


def small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if its counted rows fit BROADCAST_BYTES; else df as it is, for a shuffled join.

    df should be cheap to count: a kept table, or rows may be given.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected edges (u, v) of longs by alternating large-star and small-star.

    Returns (node, root), root being the smallest node reachable; nodes without an edge do not appear.
    Loops and null ends are ignored. No edges give no rows. Every step aggregates before it shuffles a
    node's neighbours, so a node of very many links costs no task all of them, and writes its edges to
    the shared folder.
    """
    ends = F.least("u", "v"), F.greatest("u", "v")
    now = Kept(edges.where("u <> v").select(ends[1].alias("u"), ends[0].alias("v")).distinct(), name)

    def signature(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return r[0], r[1]

    seen = signature(now.df)
    while seen[0]:
        both = now.df.union(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = Kept(large, name)
        # every edge now has u > v, so a node's lower neighbours are its v
        low = large.df.groupBy("u").agg(F.min("v").alias("m"))
        tree = large.df.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        new = Kept(tree.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), name)
        now.drop()
        large.drop()
        now, before = new, seen
        seen = signature(now.df)
        if seen == before:
            break
    links = now.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return links.union(links.select(F.col("root").alias("node"), "root").distinct())


def rows_of(batches: Iterator, size: int = 256) -> Iterator[dict]:
    """Rows of Arrow batches as dicts, few at a time in Python."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from batch.slice(at, size).to_pylist()


def batches_of(rows: Iterator[tuple], schema, size: int = 1024) -> Iterator:
    """Arrow batches of tuples in the order of an Arrow schema."""
    import pyarrow as pa

    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
