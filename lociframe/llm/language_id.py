"""Language ID by rank-order profiles: a document's most frequent n-grams against each language's, out of place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.llm.common import batches_of, keep, rows_of, small

#: n-grams in a profile, of one to three characters of words with a space at either side.
PROFILE = 400
#: Labelled documents a language's profile is learned from, at most: those with the smallest hash of their id.
LEARN_DOCS = 2000
#: Characters whose n-grams are counted at a time.
CHUNK = 1 << 20
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, as numbers in ascending order, and their counts.

    Letters count in lower case, all else is a space, and n-grams do not go across words. An n-gram's
    number has 21 bits for each character.
    """
    none = np.empty(0, np.int64)
    if not text:
        return none, none
    a = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.int64)
    letter = _is_letter()[a]
    if not letter.any():
        return none, none
    a = np.where(letter, a, 32)
    wanted = letter.copy()
    wanted[1:] |= letter[:-1]
    a = np.concatenate(([32], a[wanted], [32]))
    keys, counts = none, none
    for at in range(0, len(a), CHUNK):
        x = a[at : at + CHUNK + 2]
        m = min(CHUNK, len(x))
        two = x[:-1] << 21 | x[1:]
        three = two[:-1] << 21 | x[2:]
        parts = (x[:m][x[:m] != 32], two[:m][two[:m] != (32 << 21 | 32)], three[:m][x[1 : 1 + len(three[:m])] != 32])
        k, n = np.unique(np.concatenate(parts), return_counts=True)
        if len(keys):
            k, where = np.unique(np.concatenate((keys, k)), return_inverse=True)
            n = np.bincount(where, np.concatenate((counts, n))).astype(np.int64)
        keys, counts = k, n
    return keys, counts


def top(keys: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent, most frequent first, ties by number."""
    if len(keys) > n:
        enough = np.partition(counts, -n)[-n]
        keys, counts = keys[counts >= enough], counts[counts >= enough]
    return keys[np.argsort(-counts, kind="stable")[:n]]


class Profiles:
    """The learned languages' ranks of n-grams."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.languages, self.size = sorted(ranked), size
        self.keys = np.unique(np.concatenate([np.empty(0, np.int64), *[np.array(ranked[k], np.int64) for k in self.languages]]))
        self.ranks = np.full((len(self.keys) + 1, len(self.languages)), -1, np.int64)
        for j, k in enumerate(self.languages):
            self.ranks[np.searchsorted(self.keys, ranked[k]), j] = np.arange(len(ranked[k]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): one less the distance's share of the largest possible; und and 0 without letters or languages."""
        mine = top(*grams(text), self.size)
        if not len(mine) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, mine)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != mine)] = len(self.keys)
        ranks = self.ranks[at]
        far = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(mine))[:, None])).sum(0)
        best = int(far.argmin())  # of equals the first by name
        return self.languages[best], float(1 - far[best] / (self.size * len(mine)))


def held_out(id_col: str = "doc_id"):
    """Rows that no profile learns from: crc32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, docs: int = LEARN_DOCS) -> Profiles:
    """Profiles of the languages of labelled rows: ids that are null or held out, and null labels, do not count.

    Of each language ``docs`` rows are used, those whose ids have the smallest hashes: a bounded sample
    that does not depend on the order of rows. What is collected is ``size`` n-grams a language.
    """
    import pyarrow as pa

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    # only rows of a hash below what about four times as many have are ordered, so no language is one task's
    order = F.shiftrightunsigned(F.xxhash64("id"), 1)
    counts = keep(rows.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")), "languages")
    counts = counts.select("lang", F.least(F.lit(float(2**63)), F.lit(4.0 * docs * 2**63) / F.greatest(F.lit(1), "n")).alias("most"))
    few = rows.select("id", "lang", order.alias("order")).join(small(counts, 64), "lang").where(F.col("order") <= F.col("most")).select("id", "lang", "order").distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id"))
    chosen = keep(few.withColumn("nth", nth).where(F.col("nth") <= docs).select("id", "lang"), "sample")
    sample = rows.join(small(chosen, 80), ["id", "lang"], "left_semi")

    def count(batches):
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
        found: dict[str, list] = {}
        for r in rows_of(batches):
            k, n = grams(r["text"])
            found.setdefault(r["lang"], []).append((k, n))
        for lang, parts in found.items():
            k, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, np.concatenate([p[1] for p in parts]), len(k)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(n)], schema=schema)

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("place", place).where(F.col("place") <= size).select("lang", "place", "gram").collect()
    ranked: dict[str, list[int]] = {}
    for r in sorted(best):
        ranked.setdefault(r.lang, []).append(r.gram)
    return Profiles(ranked, size)


def identify(df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, *more, lang_pred, score) of every row, by its whole text only.

    Texts that are null or have no letter are ``und`` with score 0, as is everything where no language was
    learned; equal distances go to the first language by name. Repeated rows give a row each, null ids stay,
    columns not asked for are not read. Each row is handled on its own.
    """
    import pyarrow as pa

    shared = df.sparkSession.sparkContext.broadcast(profiles)
    names = {c: "text" if c == text_col else f"more{i}" for i, c in enumerate(more)}
    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(n) for c, n in names.items() if n != "text"])
    kept = [own.schema[n] for n in ("id", *names.values())]

    def run(batches: Iterator):
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in kept], ("lang_pred", pa.string()), ("score", pa.float64())])
        known = shared.value
        rows = ((*[r[f.name] for f in kept], *known.predict(r["text"])) for r in rows_of(batches))
        yield from batches_of(rows, schema)

    out = own.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double")
    return out.withColumnsRenamed({"id": id_col, **{n: c for c, n in names.items()}})
