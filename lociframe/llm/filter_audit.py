"""What each filter of a chain removes, in every order of the filters, by replaying all orders over documents' flags."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import keep, small

#: The filters' letters, in the order of the flags' bits.
FILTERS = "ABCDE"
#: The text rules: least words; least distinct words, and most capitals, in percent; characters that fail.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 200, 50, 2, "[#$%&*|]"
#: Copies of one text are spread over so many parts where the texts that repeat are too many to broadcast.
SALTS = 32


def flags(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask int, good, toxic boolean) of every row: the bits of mask are the filters of FILTERS that it fails.

    A: under LEAST_WORDS words (maximal runs without white space of ASCII). B: distinct words are under DISTINCT_PERCENT of words. C:
    over CAPITAL_PERCENT of the code points are A-Z. D: holds one of MARKS. E: some row with a smaller id has
    the same text. A null text is an empty one, which fails A only, and E if repeated; rows of one id are no copies of each other, a
    null id is nobody's copy and has none. A null part is the empty one. Labels of one id add up: good if any says quality 1, toxic
    likewise; ids without labels are neither. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split("text", "[ \t-\r]+"), lambda w: w != "")
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    docs = docs.withColumn("words", words).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.size("words") < LEAST_WORDS).alias("A"), (100 * F.size(F.array_distinct("words")) < DISTINCT_PERCENT * F.size("words")).alias("B"),
        (100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > CAPITAL_PERCENT * F.length("text")).alias("C"), F.col("text").rlike(MARKS).alias("D"),
    )
    docs = keep(docs, "flags")
    copies = docs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    copies = keep(copies, "copies")
    n = copies.count()
    first = small(copies, 64, n)
    if first is copies:  # too many to broadcast: the copies of one text meet its first in several parts
        docs = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        first = copies.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    docs = docs.join(first, [c for c in first.columns if c != "first"], "left")
    own = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    own = keep(own.where("doc_id IS NOT NULL"), "labelled")
    docs = docs.join(small(own, 24), "doc_id", "left")
    mask = sum((F.coalesce(F.col(x) if x != "E" else F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << i) for i, x in enumerate(FILTERS)), F.lit(0))
    return docs.select("part", mask.alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def orders(df: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(filter_order, bits array<int>): every order of the filters and their bits of the mask, in this order."""
    rows = [("".join(p), [1 << filters.index(x) for x in p]) for p in permutations(filters)]
    return df.sparkSession.createDataFrame(rows, "filter_order string, bits array<int>")


def audit(flagged: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of rows as ``flags`` gives them.

    Every row meets every order (the factorial of the number of filters, broadcast) and every step of it; its first failure in
    the order tells what the step does to it, and sums are made before the shuffle, so a part of any size costs a task only its
    own rows. Parts without rows have no row in the result, parts with rows all orders and steps.
    """
    steps = F.sequence(F.lit(1), F.lit(len(filters)))
    replay = flagged.crossJoin(F.broadcast(orders(flagged, filters)))
    failed: Column = F.lit(None).cast("int")
    for k in reversed(range(len(filters))):
        failed = F.when(F.col("mask").bitwiseAND(F.col("bits")[k]) != 0, F.lit(k + 1)).otherwise(failed)
    replay = replay.withColumn("first", failed).select("part", "mask", "good", "toxic", "filter_order", "bits", "first", F.explode(steps).alias("step"))
    bit = F.element_at("bits", F.col("step"))
    here, fails = F.col("first") == F.col("step"), F.col("mask").bitwiseAND(bit) != 0
    count = lambda c: F.count(F.when(c, 1))
    sums = replay.groupBy("part", "filter_order", "step").agg(
        count(F.col("first").isNull() | (F.col("first") > F.col("step"))).alias("kept"), count(here).alias("removed"),
        count(fails & (F.col("first") < F.col("step"))).alias("redundant"), count(F.col("mask") == bit).alias("unique_fails"),
        count(here & F.col("good")).alias("good_lost"), count(here & F.col("toxic")).alias("toxic_lost"),
    )
    sums = keep(sums, "sums").withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    shares = sums.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return sums.join(shares, ["part", "letter"]).drop("letter")
