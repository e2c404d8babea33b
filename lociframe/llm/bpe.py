"""Byte-level BPE by a depth-first walk over the trie of distinct words.

The encoding of a prefix is fixed by its last token: the longest token t that ends the prefix and may
follow the last token of the prefix without t. So the walk keeps one token a trie node, prefixes that
words share are encoded once, and a word's encoding is read back along its path.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm.common import batches_of, rows_of

#: Splits text before the merges, as byte-level tokenizers do.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A worker remembers about so many words of at most so many letters, the last ones seen, and so many answers to may_follow; all are only caches.
CACHED_WORDS, CACHED_LETTERS, CACHED_ANSWERS = 200_000, 64, 150_000
#: Texts are cut into words together until they have so many characters; a longer text is alone.
BATCH_CHARS = 1 << 19


def byte_letters() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, ids and the merges that make them, from a byte-level tokenizer file's JSON."""

    def __init__(self, source: str):
        import numpy as np
        import regex

        spec = json.loads(source)
        self._refuse_others(spec)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = spec["model"]["vocab"]
        self.ids = {raw(k): v for k, v in vocab.items() if k not in self.special}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for k, v in self.ids.items():
            self.bytes[v] = k
        for k, v in self.special.items():
            self.bytes[v] = k.encode("utf-8")
        self.rank = [-1] * size  # of the merge that makes a token; bytes have none
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(size)]
        self.merged: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            t = self.ids[a + b]
            left, right = self.ids[a], self.ids[b]
            self.merged[left, right] = t
            self.rank[t], self.parts[t] = r, (left, right)
        # lengths of tokens, longest first, by the last four bytes they end with; and by fewer, at a word's start
        ends: dict[bytes, set[int]] = {k[-4:]: {len(k)} if len(k) < 4 else set() for k in self.ids}
        for k in self.ids:
            if len(k) > 3:
                ends[k[-4:]].add(len(k))
            for n in (2, 3):  # ends that are no token's last four bytes
                ends.setdefault(k[-n:], set())
        for k, lengths in ends.items():
            lengths.update(n for n in (1, 2, 3) if n <= len(k) and k[-n:] in self.ids)
        self.lengths = {k: tuple(sorted(n, reverse=True)) for k, n in ends.items()}
        self.split = regex.compile(SPLIT)
        self.mark = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.follows: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the words before; those that come again move to words
        self.packed = [int(i).to_bytes(4, "little") for i in range(size)]
        self.sizes = [len(b) for b in self.bytes]
        self.table = np.array(self.bytes + [None], dtype=object)[:-1]

    @staticmethod
    def _refuse_others(spec: dict) -> None:
        """A ValueError for a file whose rules are not those built here: it would get wrong tokens."""
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if not plain or spec.get("normalizer") or model.get("type", "BPE") != "BPE":
            raise ValueError("not a byte-level BPE file without normalizer and added space")
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("a BPE model with dropout, affixes, byte fallback or ignored merges")
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take white space or whole words only")

    def may_follow(self, a: int, b: int) -> bool:
        """Whether b stays a token of its own right after a: no merge across the border comes first.

        Undoing the later merge of the two tokens at the border, again and again, shows every pair that
        met there; such a pair's own merge must not precede the merge that consumed one of its sides.
        """
        x, y, rank, parts, merged = a, b, self.rank, self.parts, self.merged
        limit_x = limit_y = len(merged)  # ranks of the merges that consumed x and y; none did yet
        good = True
        while True:
            t = merged.get((x, y))
            if t is not None:
                r = rank[t]
                # merges by rank; of two of one rank that overlap, the left one comes first
                if r < limit_x and r < limit_y or r == limit_y and r < limit_x:
                    good = False
                    break
            if rank[x] < 0 and rank[y] < 0:
                break
            if rank[x] > rank[y]:
                limit_x, x = rank[x], parts[x][1]
            else:
                limit_y, y = rank[y], parts[y][0]
        if len(self.follows) > CACHED_ANSWERS:
            self.follows.clear()
        self.follows[a << 32 | b] = good
        return good

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct words, each id as four little-endian bytes."""
        id_of, may_follow, packed, size, follows, lengths = self.ids.get, self.may_follow, self.packed, self.sizes, self.follows.get, self.lengths.get
        out: dict[str, bytes] = {}
        path, last = b"", [-1]  # the trie's path, and its nodes' last tokens; sorted words are the trie in depth-first order
        for word in sorted(words):  # letters sort as their bytes do
            raw = word.encode("utf-8")
            if raw.startswith(path):
                shared = len(path)
            else:
                shared = 0
                while path[shared] == raw[shared]:  # they differ before either ends
                    shared += 1
                del last[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                tail = raw[end - 4 : end] if end > 3 else raw[:end]
                for n in lengths(tail) or lengths(tail[-3:]) or lengths(tail[-2:]) or (1,):
                    if n > end:
                        continue
                    t = id_of(raw[end - n : end])
                    if t is None:
                        continue
                    if n == end:
                        break
                    before = last[end - n]
                    ok = follows(before << 32 | t)
                    if ok or ok is None and may_follow(before, t):
                        break
                else:  # a byte that the vocabulary lacks
                    raise ValueError(f"the vocabulary has no token for byte {raw[end - 1]}")
                last.append(t)
            path, end, back = raw, len(raw), []
            while end:  # the token that ends here, and so on at its start
                back.append(packed[last[end]])
                end -= size[last[end]]
            back.reverse()
            out[word] = b"".join(back)
        return out

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, packed; strings of special tokens are these tokens."""
        find, mark = self.split.findall, self.mark
        cut: list[list[list[str] | bytes]] = []
        for text in texts:
            pieces: list[list[str] | bytes] = []
            at = 0
            for m in mark.finditer(text or "") if mark else ():
                pieces += [find(text[at : m.start()]), self.packed[self.special[m[0]]]]
                at = m.end()
            pieces.append(find(text[at:] if at else text or ""))
            cut.append(pieces)
        words = set().union(*[p for pieces in cut for p in pieces if isinstance(p, list)])
        if len(self.words) > CACHED_WORDS // 2:
            self.older, self.words = self.words, {}
        missing = words.difference(self.words)
        again = missing & self.older.keys()
        self.words.update((w, self.older[w]) for w in again)
        self.words.update(self.encode_words(missing - again))
        get = self.words.__getitem__
        out = [b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in pieces]) for pieces in cut]
        for w in missing:
            if len(w) > CACHED_LETTERS:
                del self.words[w]
        return out

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are not UTF-8 give U+FFFD."""
        import numpy as np

        return b"".join(self.table[np.frombuffer(packed, "<u4")].tolist()).decode("utf-8", "replace")


_loaded: dict[bytes, Vocabulary] = {}


def _vocabulary(source: str) -> Vocabulary:
    key = hashlib.sha256(source.encode()).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(source)
    return _loaded[key]


def read_vocabulary(path: str) -> str:
    """A tokenizer file's JSON, on the driver; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(spark: SparkSession, df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", batch: int = 512) -> DataFrame:
    """(id_col, ids binary): the tokens of every whole text as little-endian unsigned 32-bit integers.

    vocabulary is a byte-level BPE file's JSON (read_vocabulary); it is broadcast, a few MB whatever the
    data. A null text is empty and has no tokens; repeated rows each give a row; ids may be null; other
    columns are not read. A worker holds the words of
    about BATCH_CHARS characters, or of one longer text, and a bounded cache; a word of any length takes memory by its length.
    """
    return _tokens(spark, df, vocabulary, id_col, text_col, batch, False).select(id_col, "ids")


def encode_decode(spark: SparkSession, df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", batch: int = 512) -> DataFrame:
    """(id_col, ids binary, decoded string): as encode, and the ids decoded again."""
    return _tokens(spark, df, vocabulary, id_col, text_col, batch, True)


def decode(spark: SparkSession, df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of packed ids as encode gives them; null ids are empty."""
    import pyarrow as pa

    shared, kind = spark.sparkContext.broadcast(vocabulary), df.schema[id_col].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        v = _vocabulary(shared.value)
        schema = pa.schema([("id", to_arrow_type(kind)), ("text", pa.large_string())])
        yield from batches_of(((r["id"], v.decode(r["ids"] or b"")) for r in rows_of(batches)), pa.schema([schema[0], pa.field("text", pa.string())]), 128)

    own = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return own.mapInArrow(run, f"id {kind.simpleString()}, text string").select(F.col("id").alias(id_col), "text")


def _tokens(spark, df, vocabulary, id_col, text_col, batch, decoded):
    import pyarrow as pa

    shared, kind = spark.sparkContext.broadcast(vocabulary), df.schema[id_col].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        v = _vocabulary(shared.value)
        schema = pa.schema([("id", to_arrow_type(kind)), ("ids", pa.binary()), *[("decoded", pa.string())] * decoded])
        def encoded(rows):
            packed = v.encode_batch([r["text"] for r in rows])
            cols = [[r["id"] for r in rows], packed, *[[v.decode(p) for p in packed]] * decoded]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        part, size = [], 0
        for r in rows_of(batches, 64):
            part.append(r)
            size += len(r["text"] or "")
            if size >= BATCH_CHARS or len(part) >= batch:
                yield encoded(part)
                part, size = [], 0
        if part:
            yield encoded(part)

    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = own.mapInArrow(run, f"id {kind.simpleString()}, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("id", id_col)
