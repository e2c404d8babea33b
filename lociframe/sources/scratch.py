"""Tables kept in the folder all executors share, to cut lineage between rounds of an iteration."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder of a local master or a cluster's warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        shared = "file://" + tempfile.mkdtemp(prefix="scratch-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which the file system removes when the driver ends."""
    path = f"{shared_dir(spark)}/rounds/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def keep(df: DataFrame, name: str) -> DataFrame:
    """df written and read back; losing executors costs nothing of what is behind it."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
