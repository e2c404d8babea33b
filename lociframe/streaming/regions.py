"""Structured Streaming forms: extensions, for sources of regions or events that keep arriving.

Row-wise operators take streaming DataFrames as they are. These keep state: bounded by a watermark where
events have times, and by the genome where they have places only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows by keys and windows of time; windows close once the watermark has passed them."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), *keys, "n")


def sessions(events: DataFrame, time: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Chains of rows by keys whose times lie less than gap apart: link along time."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), *keys, "n")


def bin_counts(regions: DataFrame, size: int) -> DataFrame:
    """Running counts of starts in bins of the genome; its state is a row for each bin."""
    return regions.groupBy("chrom", "strand", F.floor((F.col("start") - 1) / size).alias("bin")).agg(F.count("*").alias("n"))


def overlap_counts(regions: DataFrame, ref: DataFrame) -> DataFrame:
    """Running counts of streamed rows for each row of a static table."""
    from lociframe.operators.overlap import overlap_join

    return overlap_join(regions, ref).groupBy(F.col("b_label").alias("label")).agg(F.count("*").alias("n"))
