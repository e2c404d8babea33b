"""Benchmark decontamination: CGK random walks and bit sampling over item-sized windows, then exact edit distance.

Texts are sequences of lower-case words. A window of an item's length is a candidate where it shares a
run of words that no text within the allowed edits can lack; the run's place in the item gives the
window's place. Of an item of many words each segment has windows: a text within its edits is within the
edits of some segment. The walk embeds candidate windows and items so that edit distance becomes Hamming
distance; sampled positions of the embeddings are compared, often enough for the target recall; what
agrees once is verified by the exact edit distance of the item to the text around the window.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches_of, keep

#: Word edits divided by the item's words are at most one less this.
SIMILARITY = 0.75
#: Independent walks, positions sampled together, and samples from each walk.
WALKS, SAMPLED, SAMPLES = 8, 3, 10
#: Items of more words have windows of equal parts of at most so many: walks of long texts drift apart with their edits.
SEGMENT = 48
#: UTF-8 bytes and segments of benchmark texts that are broadcast at a time; a larger benchmark is searched in parts.
PART_BYTES, PART_SEGMENTS = 4 << 20, 1 << 15

#: Letters of scripts that are written without spaces are words each.
UNSPACED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
APART = re.compile(f"[{UNSPACED}]")
WORD = re.compile(rf"(?=[^\W_])[{UNSPACED}]|(?:(?![{UNSPACED}])[^\W_])+")
PLAIN = re.compile(r"[^\W_]+")  # the same in texts without such letters, and faster


def lowered(text: str | None) -> str:
    """text in lower case, character for character: what would become several characters stays."""
    low = (text or "").lower()
    return low if len(low) == len(text or "") else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def word_pattern(low: str) -> re.Pattern:
    return PLAIN if low.isascii() or not APART.search(low) else WORD


def words_of(text: str | None) -> list[str]:
    low = lowered(text)
    return word_pattern(low).findall(low)


def allowed(n: int, similarity: float) -> int:
    """Edits that an item of n words may have."""
    return int(math.floor((1 - similarity) * n + 1e-9))


def search(item: list[int], text: list[int]) -> tuple[int, int]:
    """(distance, end) of the part of text nearest to item by word edits, the first end of equals; bit-parallel."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, far = full, 0, n
    best = (n, 0)
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        x = eq | down
        diag = ((((x & up) + up) ^ up) | x) & full
        right_up, right_down = (down | ~(diag | up)) & full, up & diag
        if right_up & top:
            far += 1
        if right_down & top:
            far -= 1
        right_up, right_down = (right_up << 1) & full, (right_down << 1) & full
        up, down = (right_down | ~(diag | right_up)) & full, right_up & diag
        if far < best[0]:
            best = (far, j + 1)
    return best


def segments(n: int) -> list[tuple[int, int]]:
    """(first word, words) of the parts of an item of n words that have windows."""
    m = -(-n // SEGMENT)
    cuts = [n * i // m for i in range(m + 1)] if m else []
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def step(walk: int, at: int, words: np.ndarray) -> np.ndarray:
    """The random bits by which a walk goes on from words at one step: the same for equal words, in whatever text."""
    x = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((walk * 0x10001 + at) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(63)).astype(np.int64)


class Items:
    """A part of the benchmark: words as numbers, runs of words to look up, and embedded segments of items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, seed: int = 7, walks: int = WALKS, sampled: int = SAMPLED, samples: int = SAMPLES):
        rng = np.random.default_rng(seed)
        self.vocab: dict[str, int] = {}
        self.ids, self.words = [], []
        for item_id, text in items:
            if w := words_of(text):
                self.ids.append(item_id)
                self.words.append([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w])
        self.edits = [allowed(len(w), similarity) for w in self.words]
        self.base = len(self.vocab) + 1
        self.walks, self.sampled = walks, sampled
        # the item of each segment, its first word in the item and its words
        cut = [(i, a, n) for i, w in enumerate(self.words) for a, n in segments(len(w))]
        self.item, self.first, self.lengths = (np.array(c, np.int64) for c in (zip(*cut) if cut else ([], [], [])))
        edits = [allowed(n, similarity) for _, _, n in cut]
        # a text within e edits of n words keeps a run of this many, at least: e edits leave n - e words in e + 1 runs
        run = [max(1, min(3, -(-(n - e) // (e + 1)))) for (_, _, n), e in zip(cut, edits)]
        self.runs = {}
        for q in sorted(set(run)):
            rows = [(self._code(self.words[i][o : o + q]), k, o - a) for k, (i, a, n) in enumerate(cut) if run[k] == q for o in range(a, a + n - q + 1)]
            rows = np.array(sorted(rows), np.int64).reshape(-1, 3)
            keys, starts, counts = np.unique(rows[:, 0], return_index=True, return_counts=True)
            self.runs[q] = (keys, starts, counts, rows[:, 1].astype(np.int32), rows[:, 2].astype(np.int32))
        # sampled steps of each segment and walk, and what it shows there: of the first 2n steps, for later ones show the padding of most texts
        self.steps_at = rng.integers(0, np.maximum(1, 2 * self.lengths)[:, None, None], (len(cut), walks, samples * sampled)).astype(np.int16)
        self.wanted = np.zeros(self.steps_at.shape, np.int32)
        for at in range(0, len(cut), 4096):
            part = cut[at : at + 4096]
            window = np.full((len(part), SEGMENT + 1), self.base, np.int64)
            for k, (i, a, n) in enumerate(part):
                window[k, :n] = self.words[i][a : a + n]
            for k in range(walks):
                self.wanted[at : at + 4096, k] = np.take_along_axis(self._shown(window, self.lengths[at : at + 4096], k), self.steps_at[at : at + 4096, k].astype(np.int64), 1)

    def _code(self, run) -> int:
        c = 0
        for w in run:
            c = c * self.base + w
        return c

    def _shown(self, window: np.ndarray, n: np.ndarray, walk: int) -> np.ndarray:
        """What a walk shows over each row of window in its first steps: at each the word it stands on, going on by the word's bit.

        Rows have n words and are padded by the number that no word has.
        """
        on, lanes = np.zeros(len(window), np.int64), np.arange(len(window))
        shown = np.empty((len(window), 2 * int(n.max(initial=0))), np.int64)
        for j in range(shown.shape[1]):
            w = window[lanes, on]
            shown[:, j] = w
            on = np.minimum(on + step(walk, j, w), n)
        return shown

    def candidates(self, stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Distinct (segment, text, window start) that share a run with a text, starts possibly before its first word.

        stream has the words of all texts, each followed by a 0; starts has where each begins.
        """
        found = []
        for q, (keys, rows_from, counts, owner, offsets) in self.runs.items():
            m = len(stream) - q + 1
            if m <= 0:
                continue
            code, known = np.zeros(m, np.int64), np.ones(m, bool)
            for k in range(q):
                part = stream[k : k + m]
                code = code * self.base + part
                known &= part > 0
            places = np.flatnonzero(known)
            at = np.searchsorted(keys, code[places])
            ok = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == code[places])
            places, at = places[ok], at[ok]
            if not len(places):
                continue
            n = counts[at]
            row = np.repeat(rows_from[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(places, n)
            found.append(np.stack((owner[row], np.searchsorted(starts, place, "right") - 1, place - offsets[row]), 1))
        if not found:
            return np.empty((0, 3), np.int64)
        both = np.concatenate(found)
        both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
        new = (both[1:] != both[:-1]).any(1)
        # a segment of few words that allows no edit is found by its run, and the first place is as good as others
        new &= (both[1:, :2] != both[:-1, :2]).any(1) | (self.lengths[both[1:, 0]] > 3)
        return both[np.concatenate(([True], new))]

    def alike(self, stream: np.ndarray, ends: np.ndarray, starts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Which candidates agree with their segment on all positions of at least one sample."""
        good = np.zeros(len(pairs), bool)
        for at in range(0, len(pairs), 4096):
            own, text, start = pairs[at : at + 4096].T
            n = self.lengths[own]
            index = start[:, None] + np.arange(int(n.max()) + 1)
            inside = (index >= starts[text][:, None]) & (index < ends[text][:, None]) & (np.arange(index.shape[1]) < n[:, None])
            window = np.where(inside, stream[np.clip(index, 0, len(stream) - 1)], self.base)
            hit = np.zeros(len(own), bool)
            for k in range(self.walks):
                left = np.flatnonzero(~hit)  # those that no walk before has found
                if not len(left):
                    break
                shown = self._shown(window[left], n[left], k)
                seen = np.take_along_axis(shown, self.steps_at[own[left], k].astype(np.int64), 1)
                hit[left] = (seen == self.wanted[own[left], k]).reshape(len(left), -1, self.sampled).all(2).any(1)
            good[at : at + 4096] = hit
        return good

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item id, first word, end word, edits, item words) of the items in texts: of each in a text the nearest place, the first of equals."""
        if not self.ids:
            return []
        get = self.vocab.get
        stream: list[int] = []
        starts, ends = [], []
        for text in texts:
            starts.append(len(stream))
            stream += map(get, words_of(text), repeat(0))
            ends.append(len(stream))
            stream.append(0)
        words, first, last = np.array(stream, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)
        pairs = self.candidates(words, first)
        pairs = pairs[self.alike(words, last, first, pairs)]
        # where the whole item would begin; places that are near each other are searched together
        whole = np.stack((self.item[pairs[:, 0]], pairs[:, 1], pairs[:, 2] - self.first[pairs[:, 0]]), 1)
        whole = whole[np.lexsort((whole[:, 2], whole[:, 1], whole[:, 0]))].tolist()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        at = 0
        while at < len(whole):
            i, text, start = whole[at]
            item, e, end = self.words[i], self.edits[i], start
            while at < len(whole) and whole[at][:2] == [i, text] and whole[at][2] <= end + len(item):
                end = whole[at][2]
                at += 1
            lo, hi = max(starts[text], start - e), min(ends[text], end + len(item) + e)
            around = stream[lo:hi]
            far, end = search(item, around)
            if far > e:
                continue
            _, back = search(item[::-1], around[:end][::-1])
            found = (far, lo + end - back - starts[text], lo + end - starts[text])
            if (text, i) not in best or found < best[text, i]:
                best[text, i] = found
        return [(text, self.ids[i], s, t, far, len(self.words[i])) for (text, i), (far, s, t) in sorted(best.items())]


def parts(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's (item, text) rows in lists of bounded size, by a hash of the text."""
    own = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    own = keep(own, "benchmark")
    # a segment may have few letters more than words
    size, rows = own.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)), F.sum(1 + F.octet_length("text") / (2 * SEGMENT))).first()
    n = max(-(-int(size) // PART_BYTES), -(-int(rows or 0) // PART_SEGMENTS))
    for k in range(n):
        yield [(r.item, r.text) for r in own.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k).orderBy("item", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id_col, item_id, start, end, edits, similarity): the benchmark items each document holds.

    start and end are code points of the document's text, end exclusive, of the place nearest to the item;
    similarity is one less word edits by item words, ``similarity`` or more, so items under four words are found
    word for word; each letter of a script without spaces is a word. Texts that are null, empty or
    without a word match nothing; repeated rows give rows each; an
    item id that has several texts may give several rows; other columns are not read; empty tables give
    no rows. Documents are not shuffled. The benchmark is searched in broadcast parts of PART_BYTES.
    """
    import pyarrow as pa

    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    item_kind = benchmark.schema[item_col].dataType
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = f"id {kind.simpleString()}, item_id {item_kind.simpleString()}, start bigint, end bigint, edits int, similarity double"
    out = spark.createDataFrame([], columns)
    for part in parts(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Items(part, similarity))

        def run(batches, shared=shared):
            from pyspark.sql.pandas.types import to_arrow_type

            schema = pa.schema([("id", to_arrow_type(kind)), ("item_id", to_arrow_type(item_kind)), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())])
            items = shared.value

            def rows():
                for b in batches:
                    for at in range(0, b.num_rows, 512):
                        ids, texts = b.slice(at, 512).to_pydict().values()
                        spans, of = [], -1
                        for k, item, s, e, far, n in items.matches(texts):
                            if k != of:
                                low, of = lowered(texts[k]), k
                                spans = [m.span() for m in word_pattern(low).finditer(low)]
                            yield ids[k], item, spans[s][0], spans[e - 1][1], far, 1 - far / n

            yield from batches_of(rows(), schema)

        out = out.union(own.mapInArrow(run, columns))
    return out.withColumnRenamed("id", id_col)
