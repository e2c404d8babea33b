"""MinHash near-dedup: universal hash minima in bands, signatures and exact sets verified, components by stars."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches_of, components, keep, rows_of, small

#: Words of a shingle, and the least Jaccard similarity of linked sets in percent.
WORDS, PERCENT = 5, 75
#: Bands of rows: sets that are 0.75 alike agree in no band once in 190,000 times.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Of the signature's bytes so many agree at least, for a pair to be verified; 0.75 alike fall below once in 400,000 times.
AGREE = 74
#: Members that one task compares with each other; larger groups are split and every two parts compared.
BLOCK = 512
#: Hashes of words that a worker keeps; only a cache.
WORDS_KEPT = 50_000

_rng = np.random.default_rng(20240101)
_A = _rng.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1)
_C = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, kept for the words seen last: a worker lives on through the stages that follow."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes: A-Z in lower case, words between white space."""
    if not text:
        return np.empty(0, np.uint64)
    found = text.encode("utf-8").lower().split()  # of bytes, both touch ASCII only
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, found), np.uint64, n)
    if n < words:
        acc = np.array([n], np.uint64)
        for k in range(n):
            acc = acc * _C + h[k : k + 1]
        return mixed(acc)
    acc = h[: n - words + 1].copy()
    for k in range(1, words):
        acc *= _C
        acc += h[k : n - words + 1 + k]
    return np.unique(mixed(acc))


def minima(hashed: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function over a set that is not empty."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashed), 1024):
        x = np.multiply.outer(_A, hashed[at : at + 1024])
        x += _B[:, None]
        np.minimum(low, x.min(1), out=low)
    return low >> np.uint64(20)


def band_keys(low: np.ndarray) -> np.ndarray:
    parts = mixed(low).reshape(BANDS, ROWS)
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        acc = acc * _C + parts[:, k]
    return mixed(acc).view(np.int64)


def sketch(low: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return (mixed(low) >> np.uint64(56)).astype(np.uint8)


def signatures(df: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, sketch) of rows (doc_id, text); the last three null for empty sets."""
    import pyarrow as pa

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

        def rows():
            for r in rows_of(batches):
                own = shingles(r["text"], words)
                if not len(own):
                    yield r["doc_id"], 0, None, None, None
                    continue
                low = minima(own)
                yield r["doc_id"], len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), band_keys(low), sketch(low).tobytes()

        yield from batches_of(rows(), schema)

    return df.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch binary")


def groups_of(batches: Iterator, keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys, from sorted Arrow batches."""
    group: list[dict] = []
    key = None
    for r in rows_of(batches):
        k = tuple(r[c] for c in keys)
        if k != key:
            if len(group) > 1:
                yield group
            group, key = [], k
        group.append(r)
    if len(group) > 1:
        yield group


def forest(group: list[dict]) -> Iterator[tuple[int, int]]:
    """Links that connect the members whose sketches agree enough: each member is reached once, from one before it."""
    ids = [r["node"] for r in group]
    marks = np.frombuffer(b"".join(r["sketch"] for r in group), np.uint8).reshape(len(group), HASHES)
    left = np.arange(len(group))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = (marks[left] == marks[at]).sum(1) >= AGREE
            for j in left[near].tolist():
                queue.append(j)
                if ids[at] != ids[j]:
                    yield ids[at], ids[j]
            left = left[~near]


def links(group: list[dict], percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Links of verified sets that connect what any verified links would: most alike first, none inside a component.

    Those that are settled are of one component already.
    """
    n = len(group)
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in group]
    size = np.array([len(s) for s in sets])
    marks = np.frombuffer(b"".join(r["sketch"] for r in group), np.uint8).reshape(n, HASHES)
    settled = np.array([r["settled"] for r in group], bool)
    found = []
    for i in range(n - 1):
        same = (marks[i + 1 :] == marks[i]).sum(1)
        fits = (same >= AGREE) & (100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i])) & ~(settled[i + 1 :] & settled[i])
        j = np.flatnonzero(fits)
        found.append(np.stack((same[j], np.full(len(j), i), j + i + 1), 1))
    root = np.where(settled, settled.argmax(), np.arange(n)).tolist()

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    pairs = np.concatenate(found)
    for _, i, j in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
        a, b = top(i), top(j)
        if a != b:
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[a] = b
                if group[i]["node"] != group[j]["node"]:
                    yield group[i]["node"], group[j]["node"]


def _in_groups(df: DataFrame, key: str, size: str, found, open_: str | None = None) -> DataFrame:
    """Links (u, v) that ``found`` gives for the rows of each key; keys of over 2 BLOCK rows go as pairs of parts of about BLOCK.

    Rows that are ``settled`` need no comparison with each other: with ``open_``, the number of the key's rows that are not,
    their parts meet only the parts of those.
    """
    import pyarrow as pa

    parts = lambda n: F.when(n <= 2 * BLOCK, F.lit(1)).otherwise(F.ceil(n / BLOCK)).cast("int")
    free = F.col(size) if open_ is None else F.col(open_)
    fixed = F.lit(0) if open_ is None else F.when(F.col(size) > free, parts(F.col(size) - free)).otherwise(0)
    settled = F.lit(False) if open_ is None else F.col("settled")
    df = df.withColumns({"fixed": fixed, "free": parts(free), "settled": settled})
    own = F.when(F.col("settled"), F.pmod(F.xxhash64("node"), "fixed")).otherwise(F.col("fixed") + F.pmod(F.xxhash64("node"), "free")).cast("int")
    other = F.explode(F.sequence(F.when(F.col("settled"), F.col("fixed")).otherwise(0), F.col("fixed") + F.col("free") - 1))
    df = df.withColumns({"own": own, "other": other})
    df = df.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other", "fixed", "free", size, *([open_] if open_ else []))

    def run(batches):
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        yield from batches_of((e for g in groups_of(batches, (key, "i", "j")) for e in found(g)), schema)

    return df.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node").mapInArrow(run, "u bigint, v bigint")


def like_first(docs: DataFrame, large: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, settled) of the rows (doc_id, root) of large components: whether the exact set is linked with that of the component's first."""
    import pyarrow as pa

    def one(batches):
        yield from batches_of(((r["root"], shingles(r["text"], words).tobytes()) for r in rows_of(batches, 32)), pa.schema([("root", pa.int64()), ("first", pa.binary())]), 128)

    roots = large.where("doc_id = root").distinct()
    first = docs.join(small(roots, 16), "doc_id").select("root", "text").mapInArrow(one, "root bigint, first binary").groupBy("root").agg(F.min("first").alias("first"))
    first = keep(first, "first")
    size = first.agg(F.coalesce(F.sum(F.octet_length("first") + 64), F.lit(0))).first()[0]

    def compare(batches):
        def rows():
            for r in rows_of(batches, 32):
                a, b = shingles(r["text"], words), np.frombuffer(r["first"], np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                yield r["doc_id"], 100 * both >= percent * (len(a) + len(b) - both)

        yield from batches_of(rows(), pa.schema([("doc_id", pa.int64()), ("settled", pa.bool_())]))

    rows = docs.join(small(large.distinct(), 32), "doc_id").join(small(first, 1, rows=size), "root").select("doc_id", "text", "first")
    return rows.mapInArrow(compare, "doc_id bigint, settled boolean").groupBy("doc_id").agg(F.min("settled").alias("settled"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id_col long, n_shingles, component_id, kept) of every row.

    Texts are linked if ``100 * intersection >= percent * union`` of their sets of distinct shingles of
    ``words`` words (fewer words are one shingle); component_id is the smallest id reachable by links,
    kept says it is the row's own. A text without words, or null, has an empty set and is linked with
    nothing. Rows that repeat an id share its component; a null id has component null and is kept. Other
    columns are not read; an empty table gives an empty one.

    Equal sets are one node. Nodes that share a band are compared by sketches, in parts of bounded size,
    which only leaves links enough to connect them; within the components of these, sets are made again
    from the texts and verified exactly. Groups, pairs and sets never leave the executors.
    """
    import pyarrow as pa

    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = keep(signatures(docs, words), "signatures")
    full = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    # only sets that repeat are looked up, and only keys that do: a hot one costs the counting no task all its rows
    repeated = keep(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep"), "repeated")
    full = full.join(small(repeated, 64), "digest", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    member = keep(full.select("doc_id", "n_shingles", "rep"), "members")
    node = full.where("doc_id = rep")

    bands = node.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    counts = keep(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    shared = bands.join(small(counts, 32), "key")
    shared = shared.join(node.select(F.col("doc_id").alias("node"), "sketch"), "node")
    close = components(_in_groups(shared, "key", "n", forest).distinct(), "close")

    close = keep(close, "close")
    sizes = close.groupBy("root").agg(F.count("*").alias("size"))
    chosen = keep(close.join(sizes, "root").select(F.col("node").alias("doc_id"), "root", "size"), "chosen")
    large = keep(chosen.where(F.col("size") > 2 * BLOCK).select("doc_id", "root"), "large")
    begun = keep(like_first(docs, large, words, percent).join(small(large.distinct(), 32), "doc_id"), "begun")
    left = begun.where("NOT settled").groupBy("root").agg(F.count("*").alias("open"))
    open_ = chosen.join(begun.drop("root"), "doc_id", "left").join(left, "root", "left").withColumns({"settled": F.coalesce("settled", F.lit(False)), "open": F.when(F.col("size") > 2 * BLOCK, F.coalesce("open", F.lit(0))).otherwise(F.col("size"))})
    open_ = keep(open_.where("open > 0").select("doc_id", "root", "size", "settled", "open"), "open")
    again = docs.join(small(open_, 64), "doc_id")

    def whole(batches):
        schema = pa.schema([("root", pa.int64()), ("size", pa.int64()), ("settled", pa.bool_()), ("open", pa.int64()), ("node", pa.int64()), ("shingles", pa.binary()), ("sketch", pa.binary())])

        def rows():
            for r in rows_of(batches):
                own = shingles(r["text"], words)
                if len(own):
                    yield r["root"], r["size"], r["settled"], r["open"], r["doc_id"], own.tobytes(), sketch(minima(own)).tobytes()

        yield from batches_of(rows(), schema, 128)

    sets = again.mapInArrow(whole, "root bigint, size bigint, settled boolean, open bigint, node bigint, shingles binary, sketch binary")
    sure = begun.where("settled AND doc_id <> root").select(F.col("doc_id").alias("u"), F.col("root").alias("v"))
    # an id whose rows have several texts links their classes
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("doc_id")
    tied = member.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    linked = components(_in_groups(sets, "root", "size", lambda g: links(g, percent), "open").union(sure).union(tied), "linked")

    found = member.join(linked.withColumnsRenamed({"node": "rep"}), "rep", "left").select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    rest = signed.where("digest IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = found.union(rest.select("doc_id", "n_shingles", "component_id"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
