"""Importance resampling towards a target distribution, by hashed runs of words: two passes over Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches_of, keep, rows_of
from lociframe.operators.tables import with_index

#: Buckets of features, the longest run of words, and how many words a text is cut into at once.
BUCKETS, RUN, BLOCK = 10_000, 3, 1 << 16
#: Drawn: PERCENT of the documents with LEAST_WORDS words; SEED of the draw.
PERCENT, LEAST_WORDS, SEED = 5, 20, 42
#: A-Z to lower case, and what ends a word (ASCII but letters and digits) to a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def features(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of successive blocks of a text's words.

    The features are all runs of 1 to RUN words, joined by a space; a run's bucket is the CRC-32 of its
    bytes modulo BUCKETS. A CRC goes on from that of the run without its last word.
    """
    raw = (text or "").encode("utf-8").translate(_TABLE)
    at, before = 0, []  # the last words of the block before
    while at < len(raw):
        end = raw.find(b" ", at + 8 * BLOCK)
        end = len(raw) if end < 0 else end
        new = raw[at:end].split()
        at = end
        if not new:
            continue
        words = before + new
        spaced = [b" " + w for w in words]
        crc, hashes = list(map(crc32, words)), []
        for n in range(RUN):
            hashes.append(np.array(crc[max(0, len(before) - n) :], np.uint32))  # of runs of n + 1 words, those that end in new ones
            crc = list(map(crc32, spaced[n + 1 :], crc))
        yield len(new), (np.concatenate(hashes) % BUCKETS).astype(np.int64)
        before = words[-(RUN - 1) :]


def bucket_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts are in each bucket: a vector a partition, merged as a tree; the driver gets the last few."""
    import pyarrow as pa

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for r in rows_of(batches, 64):
            for _, buckets in features(r["text"]):
                total += np.bincount(buckets, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    sc = df.sparkSession.sparkContext
    vectors = df.select(F.col(text_col).alias("text")).mapInArrow(count, "counts binary").rdd.map(lambda r: np.frombuffer(r["counts"], np.int64))
    return sc.union([vectors, sc.parallelize([np.zeros(BUCKETS, np.int64)], 1)]).treeReduce(np.add)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: 1000 times the log of its share in the target over that in the corpus, both smoothed, floored."""
    all_s, all_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())], np.float64)


def weights(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_features, weight long) of every row; gain is broadcast, BUCKETS numbers.

    A null text has no words. Sums are exact: they are of whole numbers, far below 2**53.
    """
    import pyarrow as pa

    shared, kind = df.sparkSession.sparkContext.broadcast(gain), df.schema[id_col].dataType

    def weigh(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        gain_of = shared.value
        schema = pa.schema([("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

        def sums(blocks: list, n: int) -> np.ndarray:
            if not blocks:
                return np.zeros((3, n))
            owner, words, buckets = zip(*blocks)
            sizes = [len(b) for b in buckets]
            added = np.bincount(np.repeat(owner, sizes), gain_of[np.concatenate(buckets)], n)
            return np.stack((np.bincount(owner, words, n), np.bincount(owner, sizes, n), added))

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, blocks, size = part.num_rows, [], 0
                total = np.zeros((3, n))
                for i, text in enumerate(part.column("text").to_pylist()):
                    for words, buckets in features(text):
                        blocks.append((i, words, buckets))
                        size += len(buckets)
                        if size > 16 * BLOCK:  # also within a very long text
                            total += sums(blocks, n)
                            blocks, size = [], 0
                total += sums(blocks, n)
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(t.astype(np.int64)) for t in total]], schema=schema)

    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(weigh, f"id {kind.simpleString()}, n_words bigint, n_features bigint, weight bigint").withColumnRenamed("id", id_col)


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(id_col, n_features, weight, score, rank long) of every row of df: a draw without replacement in proportion to the weights.

    A document's weight is the sum of its features' gains towards the texts of target; score adds seeded Gumbel noise, so the highest
    scores are such a draw. Of the n documents with ``least_words`` words the highest floor(percent * n / 100) have a rank from
    1, ties to the smaller id, then in any order; all others have none. A null text has no features, weight 0 and no rank; the noise of
    a null id is that of the text "null", and it comes before other ids. Rows that repeat an id are ranked each. Other
    columns are not read; an empty df gives no rows, an empty target gains from the smoothing alone.
    """
    gain = gains(bucket_counts(df, text_col), bucket_counts(target, text_col))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    found = weights(df, gain, id_col, text_col).withColumns({"score": (F.col("weight") + noise).cast("long"), "_row": F.monotonically_increasing_id()})
    found = keep(found, "weighted")
    long = found.where(F.col("n_words") >= least_words)
    drawn = long.count() * percent // 100
    ranked = with_index(long, [F.desc("score"), F.asc(id_col), F.asc("_row")])
    rank = F.when(F.col("index") < drawn, F.col("index") + 1).cast("long")
    out = ranked.withColumn("rank", rank).drop("index").unionByName(found.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(id_col, "n_features", "weight", "score", "rank")
