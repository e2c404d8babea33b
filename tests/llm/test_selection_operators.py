"""Packing, filter audit and importance resampling against brute force: sequential best fit, replayed filters, plain counting."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter
from itertools import permutations

import pytest

pytest.importorskip("lociframe.llm")
tokenizers = pytest.importorskip("tokenizers")

from lociframe.llm import best_fit, bpe, filter_audit, importance, queries  # noqa: E402

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed=5, n=60):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdefgh')}{rng.choice(['', 'É', 'x', 'Qu'])}w{i}" for i in range(150)]
    out = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 19, 20, 150, 199, 200, 230]))) for _ in range(n)]
    out[7] = out[3]
    out[9] = out[3]
    out[11] = "COST $5 " + out[11]
    out[13] = "ABC " * 250
    out[15] = " \t\r\n\x0b\x0c "
    out[17] = "don't you'll ΣΑΣ İstanbul 12345 <|endoftext|> ’s é \U0001f600 ___"
    out[19] = "x" * 5000 + " end"
    out[21] = " ".join(rng.choice(words) for _ in range(120_000))  # longer than a part or block of the operators
    return [*out, None, None, ""]


def docs_frame(spark, rows):
    """Rows (doc_id, text, source) with columns whose names clash with the operators' own."""
    more = "part string, length string, rank string, first string, n string, mask string, index string, ids string, digest string, `offset` string"
    return spark.createDataFrame([(*r, *["?"] * 10) for r in rows], f"doc_id long, text string, source string, {more}")


@pytest.fixture(scope="module")
def rows():
    sources = ["web", "news", None, ""]
    made = [(3 * i, t, "web" if i % 3 else sources[i % 4]) for i, t in enumerate(texts())]
    return [*made, made[5], made[5], (None, "a text of nobody", "news"), (None, made[3][1], "web")]


def library():
    t = tokenizers.Tokenizer.from_file(queries.WORD_VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_words_are_the_librarys():
    source = bpe.read_vocabulary(queries.WORD_VOCABULARY)
    own, lib = best_fit.Tokens(source), library()
    assert own.by_word
    few = [t or "" for t in texts(8)] + ["it's'sthe're" * 3 + "''s --'ll", "1½²٣", "ȩ́ ﬁ ẞ ǅ", "a\x1cb\x85c d​e"]
    for text in few:
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids) if (ids := lib.encode(text, add_special_tokens=False).ids) else own.encode(text) == b""
    points = [c for c in range(0x3000) if not 0xD800 <= c <= 0xDFFF] + list(range(0x1F000, 0x1FB00))
    around = [f"a{chr(c)}b {chr(c)}" for c in points]
    assert [own.encode(t) for t in around] == [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in lib.encode_batch(around, add_special_tokens=False)]
    assert not best_fit.Tokens(bpe.read_vocabulary(queries.VOCABULARY)).by_word


def best_fit_bins(lengths, size):
    """Sequences of best fit, longest first, one piece at a time."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(space, i) for i, space in enumerate(left) if space >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(size - n)
    return len(left)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 64, 100])
    lengths = [min(size, 1 + int(rng.expovariate(1 / rng.choice([3, 20, 60])))) for _ in range(rng.choice([1, 40, 700]))]
    counts = Counter(lengths)
    slots = best_fit.plan(counts, size)
    held = {}
    for length in counts:
        own = sorted(r for r in slots if r[0] == length)
        assert own[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(own, own[1:])) and own[-1][1] + own[-1][2] == counts[length]
        for _, _first, n, sequence, per, at in own:
            for k in range(n):
                held.setdefault(sequence + k // per, []).append((at + k % per * length, length))
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= size
    assert len(held) == best_fit_bins(lengths, size)


def test_plan_does_not_grow_with_the_counts():
    some = {n: 1 + (n * 7919) % 50 for n in range(1, 2049)}
    small, large = best_fit.plan(some), best_fit.plan({k: v * 10**9 for k, v in some.items()})
    assert len(small) < 40_000 and len(large) < 40_000
    total = sum(k * v for k, v in some.items()) * 10**9
    assert max(r[3] + -(-r[2] // r[4]) for r in large) <= 1.001 * total / 2048
    with pytest.raises(ValueError):
        best_fit.plan({2049: 1})


def test_packing(spark, rows, monkeypatch):
    monkeypatch.setattr(best_fit, "NUMBERED", 7)  # lengths are numbered in parts
    source, lib = bpe.read_vocabulary(queries.WORD_VOCABULARY), library()
    df = docs_frame(spark, rows).repartition(5)
    packed = best_fit.pack(spark, df, source, size=64)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    got = packed.collect()
    want = Counter()
    for i, text, _ in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, len(ids[k : k + 64]), struct.pack(f"<{len(ids[k:k + 64])}I", *ids[k : k + 64])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(places, places[1:])) and places[-1][0] + places[-1][1] <= 64
    assert len(held) == best_fit_bins([r.length for r in got], 64)
    joined = {r.sequence_id: bytes(r.ids) for r in best_fit.sequences(packed).collect()}
    assert joined.keys() == held.keys() and all(len(ids) == sum(p[1] for p in held[k]) * 4 for k, ids in joined.items())
    assert best_fit.pack(spark, df.limit(0), source).collect() == []


def test_packed_digests(spark, tmp_path, rows):
    docs_frame(spark, [r for r in rows if r[0] is not None]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_best_fit_packing(spark, str(tmp_path)).collect()
    lib, want = library(), Counter()
    for i, text, _ in rows:
        if i is not None:
            ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
            want.update((i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(struct.pack(f"<{len(ids[k:k + 2048])}I", *ids[k : k + 2048]))) for k in range(0, len(ids), 2048))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert len({r.sequence_id for r in got}) == best_fit_bins([r.length for r in got], 2048)


def replayed(rows, labels):
    """Counts by (part, order, step), filter by filter over lists of documents."""
    first, marks = {}, {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (False, False))
        marks[i] = good or quality == 1, bad or toxic == 1
    docs = []
    for i, text, part in rows:
        text = text or ""
        w = WHITE.findall(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        fails["E"] = i is not None and first[text] < i
        docs.append((part or "", {x for x in fails if fails[x]}, *(marks.get(i, (False, False)) if i is not None else (False, False))))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = own = [d for d in docs if d[0] == part]
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                before = set(order[: step - 1])
                out[part, order, step] = [len(left), len(gone), sum(x in d[1] and bool(d[1] & before) for d in own), sum(d[1] == {x} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
                shapley[part, x] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_filter_audit(spark, rows, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(filter_audit, "small", lambda df, *_: df)
    labels = [(3 * i, i % 2, int(i % 5 == 0)) for i in range(0, 60, 2)] + [(9, 1, 1), (9, 0, None), (None, 1, 1), (21, None, 1)]
    table = spark.createDataFrame([(*r, "?") for r in labels], "doc_id long, quality int, toxic int, text string")
    df = docs_frame(spark, rows)
    got = filter_audit.audit(filter_audit.flags(df, table)).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == replayed(rows, labels)
    assert len(got) == 3 * 600
    assert filter_audit.audit(filter_audit.flags(df.limit(0), table)).collect() == []
    one = filter_audit.audit(filter_audit.flags(df.where("doc_id = 63"), table.limit(0))).collect()
    assert len(one) == 600 and {r.removed for r in one} <= {0, 1} and {r.good_lost for r in one} == {0}


def drawn(rows, benchmark):
    table = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    word = re.compile(rb"[0-9a-z\x80-\xff]+")

    def buckets(text):
        w = word.findall((text or "").encode().translate(table))
        return w, [zlib.crc32(b" ".join(w[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for r in rows:
        s.update(buckets(r[1])[1])
    for text in benchmark:
        t.update(buckets(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(big_s + 10000) / (float(s[b] + 1) * float(big_t + 10000)))) for b in range(10000)]
    found = []
    for i, text, _ in rows:
        w, own = buckets(text)
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        found.append((i, len(w), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((f for f in found if f[1] >= 20), key=lambda f: (-f[4], -1 if f[0] is None else f[0]))
    best = Counter()
    out = [(i, n, weight, score, None) for i, words, n, weight, score in found if words < 20]
    for k, (i, _, n, weight, score) in enumerate(long):
        out.append((i, n, weight, score, k + 1 if k < 5 * len(long) // 100 else None))
    best.update(out)
    return best


def test_importance_resampling(spark, rows, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 200)  # texts and sums in many blocks
    benchmark = [rows[1][1], None, "", "Été w1 w2, w3"]
    df, target = docs_frame(spark, rows).repartition(3), spark.createDataFrame([(1, t) for t in benchmark], "item_id long, text string")
    out = importance.resample(df, target)
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(tuple(r) for r in out.collect()) == drawn(rows, benchmark)
    assert importance.resample(df.limit(0), target).collect() == []
    few = rows[:8]
    assert Counter(tuple(r) for r in importance.resample(docs_frame(spark, few), target.limit(0)).collect()) == drawn(few, [])


def test_blocks_hold_every_run(monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 1)
    for text in [*texts(3, 30), "a", "a b", "a-b_c d", "é" * 40 + " b c d e f"]:
        blocks = list(importance.features(text))
        w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
        assert sum(n for n, _ in blocks) == len(w)
        want = Counter(zlib.crc32(b" ".join(w[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1))
        assert Counter(b for _, bs in blocks for b in bs.tolist()) == want
