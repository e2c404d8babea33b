"""Best-fit packing planned over the histogram of lengths; pieces take planned slots by their rank within their length."""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociframe.llm.bpe import byte_letters
from lociframe.llm.common import batches_of, keep, rows_of, small

#: Tokens of a sequence, and the id that ends each document.
SIZE, END = 2048, 0
#: How the tokenizer's file cuts normalised text into words; other files are given to the library text by text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: The same for lower-case ASCII, in the faster standard library.
SPLIT_ASCII = r"[a-z]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^ \t-\ra-z0-9]+"
#: A worker remembers about so many words; a text is cut into words in parts of about so many characters, at white space.
CACHED_WORDS, PART_CHARS = 300_000, 1 << 18
#: Pieces of one length that are numbered together; a length with more is split.
NUMBERED = 100_000


class _Words(dict):
    """A word's ids, made when it is first asked for."""

    def __init__(self, made):
        super().__init__()
        self.made = made

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.made(word)
        return ids


class Tokens:
    """Ids of texts by the tokenizers library, each distinct word encoded once.

    A word's ids do not depend on what is around it where the file's rules are the normaliser and the
    split checked here; for any other file, and for texts that write a special token, the library gets whole texts.
    """

    def __init__(self, source: str):
        import json

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(source)
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        rule = SPLIT.replace(r"\p{L}+", r"[\p{L}]+").replace(r"\p{N}|", r"[\p{N}]|")
        by_word = kinds == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and cuts[0].get("pattern") == {"Regex": rule} and cuts[0].get("invert")
        self.by_word = bool(by_word and not cuts[1].get("use_regex") and not spec.get("post_processor"))
        self.model, self.letters = self.library.model, {b: c for c, b in byte_letters().items()}
        self.packed = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.find = regex.compile(SPLIT).findall
        self.border = regex.compile(r"[ \n](?=[A-Za-z0-9])")
        self.find_ascii = re.compile(SPLIT_ASCII).findall
        self.words = _Words(self._word)

    def _word(self, word: str) -> bytes:
        """A normalised word's ids: by the library's model, which takes bytes as the letters that stand for them, or where it has other letters by the
        library, whose tables of what a letter is may be older than ours."""
        if not word.isascii():
            return self._whole(word)
        if not word.isprintable():
            word = "".join(map(self.letters.__getitem__, word.encode("utf-8")))
        return b"".join([self.packed[t.id] for t in self.model.tokenize(word)])

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.library.encode(text, add_special_tokens=False).ids))

    @staticmethod
    def normalised(text: str) -> str:
        import unicodedata

        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # a sigma's lower case is one, wherever it stands

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts between which no word, mark or special token stands."""
        at = 0
        while len(text) - at > PART_CHARS:
            cut = self.border.search(text, at + PART_CHARS)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; of a null text none."""
        if not text:
            return b""
        if not self.by_word or any(s in text for s in self.special):
            return self._whole(text)
        out = []
        for part in self.parts(text):
            part = self.normalised(part)
            words = (self.find_ascii if part.isascii() else self.find)(part)
            if len(self.words) > CACHED_WORDS:
                self.words.clear()
            out.append(b"".join(map(self.words.__getitem__, words)))
        return b"".join(out)


_loaded: dict[bytes, Tokens] = {}


def _tokens(source: str) -> Tokens:
    key = hashlib.sha256(source.encode()).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokens(source)
    return _loaded[key]


def pieces(spark: SparkSession, df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """(id_col, piece int, start long, length long, ids binary): every document's tokens and the id ``end``, cut into pieces of ``size``.

    tokenizer is a file's JSON (bpe.read_vocabulary), broadcast: a few MB whatever the data. A null text is
    empty: one piece of one token. Ids may be null or repeated, each row gives its own pieces; other
    columns are not read; an empty table gives none. A worker holds one document's ids and a bounded cache.
    """
    import pyarrow as pa

    shared, kind, last = spark.sparkContext.broadcast(tokenizer), df.schema[id_col].dataType, end.to_bytes(4, "little")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        t = _tokens(shared.value)
        schema = pa.schema([("id", to_arrow_type(kind)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

        def rows():
            for r in rows_of(batches, 64):
                ids = t.encode(r["text"]) + last
                for k in range(0, len(ids), 4 * size):
                    part = ids[k : k + 4 * size]
                    yield r["id"], k // (4 * size), k // 4, len(part) // 4, part

        yield from batches_of(rows(), schema)

    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = own.mapInArrow(run, f"id {kind.simpleString()}, piece int, start bigint, length bigint, ids binary")
    return out.withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts: rows (length, first, n, sequence, per, offset).

    The n pieces of a length from rank ``first`` on take places in successive sequences from ``sequence``,
    ``per`` of them in each, side by side from ``offset``. Sequences that have the same space left are one
    group, so the work depends on the lengths that occur: a length splits at most one group in three, and
    a group that is filled has less than half its space left, so there are at most 3 size log2(size) rows.
    """
    if any(not 1 <= n <= size for n in counts):
        raise ValueError(f"lengths go from 1 to {size}")
    groups: dict[int, list[tuple[int, int]]] = {}  # space left: (first sequence, sequences)
    spaces: list[int] = []  # its keys, in order
    rows: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in groups:
                insort(spaces, space)
            groups.setdefault(space, []).append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            k = bisect_left(spaces, length)
            if k == len(spaces):  # nothing fits: open what the rest of this length needs
                n = -(-left // (size // length))
                put(size, opened, n)
                opened += n
                continue
            space = spaces[k]
            first, n = groups[space].pop()
            if not groups[space]:
                del groups[space], spaces[k]
            per = space // length
            full = min(n, left // per)
            for many, each in ((full, per), (1 if full < n and left > full * per else 0, left - full * per)):
                if many:
                    rows.append((length, rank, many * each, first, each, size - space))
                    put(space - each * length, first, many)
                    rank, left, first, n = rank + many * each, left - many * each, first + many, n - many
            put(space, first, n)
    return rows


def place(df: DataFrame, size: int = SIZE) -> DataFrame:
    """df's rows with sequence_id and offset long: as few sequences of ``size`` as best fit makes of their ``length``.

    Sequences are filled without gaps from 0. Rows of a length are alike to the plan; which of them takes
    which slot is by a number that is written with the kept rows, so repeated tasks see the same. A length of more than
    NUMBERED rows is numbered in parts. Lengths are 1 to size, another fails; no rows give none; other columns are carried.
    Only counts of at most ``size`` lengths come to the driver.
    """
    spark = df.sparkSession
    cols = df.columns
    rows = keep(df.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan(counts, size), "length bigint, first bigint, n bigint, sequence bigint, per bigint, at bigint")
    split = spark.createDataFrame([(k, -(-n // NUMBERED)) for k, n in counts.items()], "length bigint, splits bigint")
    rows = rows.join(F.broadcast(split), "length").withColumn("_split", F.pmod(F.xxhash64("_row"), "splits"))
    parts = rows.groupBy("length", "_split").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    starts = keep(parts.select("length", "_split", F.coalesce(before, F.lit(0)).alias("_start")), "starts")
    rank = F.row_number().over(Window.partitionBy("length", "_split").orderBy("_row")) - 1
    rows = rows.withColumn("_rank", rank).join(small(starts, 32), ["length", "_split"]).withColumn("_rank", F.col("_rank") + F.col("_start"))
    s = slots.select(F.col("length").alias("_length"), "first", "n", "sequence", "per", "at")
    rows = rows.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)], F.col("length").alias("_own"), "_rank")
    rows = rows.join(F.broadcast(s), (F.col("_own") == F.col("_length")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("first") + F.col("n")))
    nth = F.col("_rank") - F.col("first")
    return rows.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)],
        (F.col("sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"), (F.col("at") + nth % F.col("per") * F.col("_own")).cast("long").alias("offset"),
    )


def pack(spark: SparkSession, df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """pieces with their places: (id_col, piece, start, length, ids, sequence_id, offset)."""
    return place(pieces(spark, df, tokenizer, id_col, text_col, size, end), size)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary): each sequence's ids joined, at most ``size`` of them."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("parts")).select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p.ids)).alias("ids"))
