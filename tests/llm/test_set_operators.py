"""Near duplicates, repeated lines, benchmark copies, vectors and archives: small cases and brute force."""

import gzip
import io
import random
import tracemalloc

import numpy as np
import pytest

from lociframe.llm import common, decontaminate, line_dedup, near_dedup, vector_search, warc
from pyspark.sql import functions as F


def shingle_sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [(i, shingle_sets(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in root}


def copies(rng, groups, members, words=80):
    rows, k = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(9999)}" for _ in range(words)]
        for _ in range(rng.randint(1, members)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = f"v{rng.randrange(9999)}"
            rows.append((k, " ".join(t)))
            k += 1
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(block)
    rows = copies(rng, 12, 14) + [(500, ""), (501, None), (502, " \t\n"), (503, "a b"), (504, "A  B"), (505, "a b c"), (506, "é É"), (507, "É é"), (508, "a b")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(df).collect()}
    want = brute_components(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingle_sets(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{i % 5000}x{i}" for i in range(30_000))
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u"), (4, long), (5, long + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False)]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7), (5, 5)]
    root = {}

    def top(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        if u != v:
            a, b = top(u), top(v)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: top(i) for i in root}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_lines(spark):
    words = " ".join(f"word{i * i % 97}x{i}" for i in range(120))
    rows = [
        (3, "Same line here.\nown three"), (1, "Same line here.\nown one\n\nown one"), (2, "same  LINE, here\n" + words), (4, words.replace("word1x1 ", "word1x1 inserted ")),
        (5, None), (6, ""), (7, "\n\n"), (8, "Same line here."), (None, "null first\nSame line here."), (9, "null first"), (1, "Same line here.\nown one\n\nown one"),
    ]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, doc string, rid int")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "doc", "rid", "n_lines", "n_removed"]
    got = sorted(((r.doc_id or 0, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)
    want = [
        (0, "null first\nSame line here.", 2, 0), (1, "own one\n", 4, 2), (1, "own one\n", 4, 2), (2, words, 2, 1), (3, "own three", 2, 1), (4, "", 1, 1),
        (5, None, 0, 0), (6, "", 1, 0), (7, "\n\n", 3, 0), (8, "", 1, 1), (9, "", 1, 1),
    ]
    assert got == sorted(want, key=str)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def near(item, words):
    """Least word edits of item to any part of words."""
    last = [0] * (len(words) + 1)
    for i, w in enumerate(item):
        now = [i + 1]
        for j, x in enumerate(words):
            now.append(min(last[j] + (w != x), last[j + 1] + 1, now[j] + 1))
        last = now
    return min(last)


def test_decontamination_by_brute_force(spark):
    rng = random.Random(7)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 50)))) for i in range(30)] + [(98, None), (99, ""), (97, "w1 w2 w3"), (96, "w7"), (95, "w1 w2 w3 w4 w5")]
    docs = []
    for d in range(150):
        body = [word() for _ in range(rng.randint(0, 200))]
        if d % 2:
            copy = items[rng.randrange(30)][1].split()
            for _ in range(rng.randint(0, len(copy) // 6)):
                at = rng.randrange(len(copy))
                kind = rng.randrange(3)
                copy[at : at + 1] = [[], ["zz"], [copy[at], "zz"]][kind]
            at = rng.randint(0, len(body))
            body[at:at] = copy
        docs.append((d, " ".join(body).capitalize() + "."))
    want = {(d, i) for d, t in docs for i, x in items if x and near(x.lower().split(), decontaminate.words_of(t)) <= decontaminate.allowed(len(x.split()), 0.75)}
    df = spark.createDataFrame([*docs, (None, docs[1][1]), (777, None), (778, "")], "doc_id long, text string")
    rows = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in rows if r.doc_id is not None}
    assert got <= want and len(got) >= 0.98 * len(want) > 50
    text = dict(docs)
    for r in rows:
        if r.doc_id is not None and r.edits == 0:
            assert decontaminate.words_of(text[r.doc_id][r.start : r.end]) == decontaminate.words_of(dict(items)[r.item_id])
    assert decontaminate.contaminated(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontaminate.contaminated(df, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_decontamination_recall_at_the_most_edits():
    rng = random.Random(17)
    word = lambda: f"w{rng.randrange(5000)}"
    for n in (5, 8, 20, 47, 60, 100, 300, 600):
        items = [(i, [word() for _ in range(n)]) for i in range(40)]
        own = decontaminate.Items([(i, " ".join(w)) for i, w in items])
        found = 0
        for i, w in items:
            e = decontaminate.allowed(n, 0.75)
            copy = list(w)
            for at in sorted(rng.sample(range(n), e), reverse=True):
                copy[at : at + 1] = rng.choice(([], ["zz"], ["yy", copy[at]]))
            text = [word() for _ in range(rng.randint(0, 300))]
            text[len(text) // 2 : len(text) // 2] = copy
            found += i in {m[1] for m in own.matches([" ".join(text)])}
        assert found >= 38, (n, found)


def test_long_short_and_unspaced_items():
    rng = random.Random(18)
    long = " ".join(f"w{rng.randrange(6000)}" for _ in range(20_000))
    chinese = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(66))
    tracemalloc.start()
    own = decontaminate.Items([(1, long), (2, chinese), (3, "yes"), (4, "one two three four"), (5, "no no")])
    edited = long.replace("w1", "v1", 3000)
    got = [(t, i) for t, i, *_ in own.matches([edited, "abc" + chinese[:30] + "x" + chinese[31:] + "def", "Yes, one x four y", "one two three.", "no. No!", "eyes on"])]
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert got == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5)]


def test_edit_search_by_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        item, text = [rng.randrange(4) + 1 for _ in range(rng.randint(1, 9))], [rng.randrange(5) for _ in range(rng.randint(0, 14))]
        assert decontaminate.search(item, text)[0] == near(item, text)


def test_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    v = [(int(i), [float(x) for x in centres[i % 6] * (1 + i % 3) + rng.normal(size=16) * 0.4]) for i in range(1500)]
    v += [(2000 + i, v[0][1]) for i in range(60)] + [(3000, None), (3001, [0.0] * 16), (3002, [1.0, None] + [0.0] * 14), (3003, [float("nan")] * 16), (3004, [float("inf")] * 16), (None, v[1][1]), (3020, [1.0, 2.0]), (3021, [2.0, 1.0]), (3022, [])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    rows = vector_search.nearest(df, df.where("vec_id % 20 = 0"), 20).collect()
    good = [(i, np.array(x)) for i, x in v if i is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = total = 0
    for q, x in good:
        if q % 20:
            continue
        want = sorted(((-float((x * y).sum()), i) for i, y in good if i != q and len(y) == len(x)))[:20]
        mine = got.pop(q)
        assert mine == sorted(mine, key=lambda p: (-p[1], p[0])) and len(mine) == len(want) and q not in {i for i, _ in mine}
        hit += len({i for i, _ in mine} & {i for _, i in want})
        total += len(want)
    assert not got and hit >= 0.95 * total
    assert vector_search.nearest(df.limit(0), df, 20).count() == vector_search.nearest(df, df.limit(0), 20).count() == 0


def test_recall_in_a_full_shard():
    rng = np.random.default_rng(4)
    n, dim = vector_search.SHARD_ROWS + 300, 48
    centres = rng.normal(size=(60, dim))
    x = centres[rng.integers(0, 60, n)] + rng.normal(size=(n, dim)) * 0.6
    x *= rng.uniform(0.3, 2.0, n)[:, None]  # unequal norms
    x[-200:] = x[:200] * 1.0001  # all but copies
    edges, start = vector_search.build(x)
    edges = np.concatenate((edges, np.full((1, edges.shape[1]), n)))
    asked = x[rng.integers(0, n, 200)]
    found, _ = vector_search.beam_search(x.astype(np.float32), edges, start, asked.astype(np.float32), vector_search.QUERY_BEAM)
    hit = 0
    for q, mine in zip(asked, found):
        mine = mine[mine < n]
        mine = mine[np.argsort(-(x[mine] @ q), kind="stable")[:20]]
        hit += len(set(mine.tolist()) & set(np.argsort(-(x @ q), kind="stable")[:20].tolist()))
    assert hit >= 0.9 * 20 * len(asked), hit / 20 / len(asked)


def test_archives(spark):
    big = "é" * 600
    rows = [(1, "http://a/ ü\n", big), (5, None, big), (3, "u", big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", big), (5, "v", big), (8, "u", "x" * 700_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("other"))
    manifest = warc.write_archives(df)
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload) for r in warc.read_archives(manifest).collect()), key=str)
    want = [(0, "response", None, 1200, big), (1, "revisit", 5, 1200, None), (2, "response", None, 5, "small"), (3, "revisit", 5, 1200, None), (4, "response", None, 5, "small"), (5, "response", None, 1200, big), (5, "response", None, 1200, big), (6, "response", None, 0, ""), (7, "response", None, 0, ""), (8, "response", None, 700_000, "x" * 700_000)]
    assert got == sorted(want, key=str)
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_broken_archives():
    whole = warc.record(1, "u", b"payload" * 100, None) + warc.record(2, "u", b"", 1)
    read = lambda data: [warc.read_record(m) for m in warc.members(io.BytesIO(data))]
    assert [r["page_id"] for r in read(whole)] == [1, 2]
    with pytest.raises(ValueError, match="ends inside"):
        read(whole[:-4])
    text = gzip.decompress(warc.record(1, "u", b"payload", None))
    for bad in (text.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"), text[:-1], text + b"x", b"junk", text.replace(b"WARC/1.1", b"XXXX/1.1")):
        with pytest.raises(ValueError):
            read(gzip.compress(bad))


def test_foreign_records():
    page = "é".encode("latin-1") * 20
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n" + page
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\r\nContent-Length: {len(http)}\r\n\r\n".encode()
    r = warc.read_record([head + http + b"\r\n\r\n"])
    assert r["payload"] == "é" * 20 and r["page_id"] is None and r["payload_bytes"] == 20 and len(r["payload_digest"]) == 40
    assert warc.read_record(next(warc.members(io.BytesIO(warc.about("x.warc.gz")))))["record_type"] == "warcinfo"
    text = gzip.decompress(warc.record(2, "u", b"p" * 2000, 9)).decode()
    assert f"WARC-Refers-To: {warc._record_id(9, 'any')}" in text


def test_references_without_broadcast(spark, monkeypatch):
    rows = [(i, "u", "x" * 1500 if i % 3 else f"y{i}" * 600) for i in range(60)] + [(None, "u", "x" * 1500), (59, "u", "x" * 1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(str, warc.with_references(df).collect()))
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    assert sorted(map(str, warc.with_references(df).collect())) == want


def edits(a, b):
    last = list(range(len(b) + 1))
    for i, w in enumerate(a):
        now = [i + 1]
        for j, x in enumerate(b):
            now.append(min(last[j] + (w != x), last[j + 1] + 1, now[j] + 1))
        last = now
    return last[-1]


def test_alike_lines_by_brute_force(spark):
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(60)] + [f"longer{i}" for i in range(60)] + ["the"] * 20
    lines = []
    for n in (4, 5, 6, 9, 10, 14, 15, 20, 30, 50, 100) * 4:
        base = [rng.choice(vocab) for _ in range(n)] if rng.random() < 0.8 else ["so", "on"] * (n // 2)
        lines.append(base)
        for share in (0.01, 0.05, 0.1, 0.15, 0.2):
            w = list(base)
            for _ in range(max(1, int(share * n))):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice(([], [rng.choice(vocab)], [rng.choice(vocab), w[at]]))
                w = w or ["x"]
            lines.append(w)
    lines = sorted({" ".join(w) for w in lines})
    rng.shuffle(lines)
    root = list(range(len(lines)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            x, y = a.split(), b.split()
            most = max(len(x), len(y)) // 5
            if abs(len(x) - len(y)) <= most and edits(x, y) <= most:
                p, q = sorted((top(i), top(j)))
                root[q] = p
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id for r in line_dedup.dedup_lines(df).collect() if r.n_removed == 0}
    assert got == {i for i in range(len(root)) if root[i] == i} and len(got) < len(lines) / 2


def test_recall_of_alike_lines_at_the_most_edits(spark):
    rng = random.Random(22)
    vocab = [f"w{i}" for i in range(3000)]
    for low, high in ((5, 10), (10, 40), (40, 300)):
        lines = []
        for i in range(400):
            base = rng.choices(vocab, k=rng.randint(low, high))
            copy = list(base)
            most = len(base) // 5
            for k in range(most):  # every fifth word, which leaves the fewest pairs
                copy[5 * k + 2] = "new" + str(rng.randrange(10**6))
            lines += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        out = line_dedup.dedup_lines(spark.createDataFrame(lines, "doc_id long, text string"))
        gone = [r.doc_id for r in out.where("n_removed > 0").select("doc_id").collect()]
        assert all(d % 2 for d in gone) and len(gone) >= 0.98 * 400, (low, len(gone))


def test_short_lines_and_short_words_repeat(spark):
    text = "the cat sat on the mat and saw a dog in the big old box"
    rows = [(1, text), (2, text.replace("dog", "cow")), (3, "a b c d e"), (4, "a b c d"), (5, "a b c x y"), (6, "甲乙丙丁戊"), (7, "甲乙丙丁己"), (8, "甲乙丙子丑")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect() if r.n_removed) == [2, 4, 7]


def test_lines_of_common_words_lose_no_link(spark):
    """Every pair is at the most edits, and shares a run of words that all lines have and no other run of three."""
    rng = random.Random(23)
    lines = []
    for i in range(150):
        base = rng.choices([f"w{j}" for j in range(100000)], k=10)
        base[3:7] = ["as", "far", "as", "possible"]
        copy = list(base)
        copy[2], copy[7] = f"new{i}", f"other{i}"
        lines += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    lines += [(1000 + i, " ".join(["twice", f"x{i}", "over"] * 2 + [f"y{i}", "as", "far", "as", "possible"])) for i in range(40)]
    lines += [(2000 + i, " ".join(["twice", f"x{i}", "over"] * 2 + [f"z{i}", "as", "far", "as"])) for i in range(40)]
    out = line_dedup.dedup_lines(spark.createDataFrame(lines, "doc_id long, text string"))
    gone = {r.doc_id for r in out.where("n_removed > 0").select("doc_id").collect()}
    assert gone == {2 * i + 1 for i in range(150)} | {2000 + i for i in range(40)}


@pytest.mark.parametrize("common", [1, 3])
def test_alike_lines_whatever_key_is_common(spark, monkeypatch, common):
    monkeypatch.setattr(line_dedup, "COMMON", common)
    monkeypatch.setattr(line_dedup, "PART_ROWS", 4 * common)
    test_alike_lines_by_brute_force(spark)


def test_lines_alike_have_two_keys_in_common(spark):
    """Words that repeat, and the lengths before another edit is allowed."""
    rng = random.Random(24)
    rows, pairs = [], 0
    for i in range(1500):
        base = rng.choices(["a", "bb", "ccc", "dd"] + [f"w{j}" for j in range(rng.choice((0, 5, 50)))], k=rng.randint(4, 40))
        copy = list(base)
        for _ in range((len(base) + 1) // 5):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice(([], ["new"], ["bb", copy[at]], [copy[at], "new"]))
        rows += [(2 * i, len(base), " ".join(base)), (2 * i + 1, len(copy), " ".join(copy))]
    keys = {}
    for r in line_dedup.key_table(line_dedup.text_table(spark.createDataFrame(rows, "line long, n int, norm string"))).collect():
        keys.setdefault(r.line, set()).add(r.key)
    for i in range(1500):
        x, y = (rows[2 * i + k][2].split() for k in (0, 1))
        if 0 < edits(x, y) <= max(len(x), len(y)) // 5:
            assert len(keys[2 * i] & keys[2 * i + 1]) > 1, (x, y)
            pairs += 1
    assert pairs > 500


def test_lines_with_a_passage_in_common_are_kept_and_compared_once(spark, monkeypatch):
    """lines that share a passage, but are not alike, have very many keys and pairs of keys in common, all of the same lines."""
    monkeypatch.setattr(line_dedup, "COMMON", 8)
    passage = " ".join(f"passageword{i}" for i in range(24))
    lines = [(i, " ".join([passage, *[f"o{i}x{j}" for j in range(24)]])) for i in range(40)] + [(100 + i, " ".join([passage, *[f"o{i}x{j}" for j in range(20)]])) for i in range(3)]
    rows = {}

    class Counted(common.Kept):
        def __init__(self, df, name):
            super().__init__(df, name)
            rows[name] = rows.get(name, 0) + self.df.count()

    monkeypatch.setattr(line_dedup, "Kept", Counted)
    out = line_dedup.dedup_lines(spark.createDataFrame(lines, "doc_id long, text string"))
    assert {r.doc_id for r in out.collect() if r.n_removed} == {100, 101, 102}
    tables = {k: v for k, v in rows.items() if k not in ("lines", "texts")}
    assert sum(tables.values()) < 15_000, tables


def test_lines_of_many_common_keys_meet_once(spark, monkeypatch):
    """near lines of one passage are not listed for every two of its keys, and those alike are found."""
    monkeypatch.setattr(line_dedup, "COMMON", 4)
    passage = [f"passageword{i}" for i in range(24)]
    # each line lacks another word of the passage, so keys have different lines; with its own words it has an edit too many, which sketches can't tell
    lines = [(i, " ".join(passage[: 2 * i] + passage[2 * i + 1 :] + [f"o{i}x{j}" for j in range(4)])) for i in range(12)]
    lines += [(100 + i, lines[i][1].replace(f"o{i}x3", f"other{i}")) for i in range(5)]
    frame, made = type(spark.range(0)), []
    distinct = frame.distinct

    def counted(self):
        if self.columns == ["u", "v"]:
            made.append(self.count())
        return distinct(self)

    monkeypatch.setattr(frame, "distinct", counted)
    out = line_dedup.dedup_lines(spark.createDataFrame(lines, "doc_id long, text string"))
    assert {r.doc_id for r in out.collect() if r.n_removed} == {100 + i for i in range(5)}
    assert max(made) <= 8 * 17 * 16 / 2, made


@pytest.mark.parametrize("common_lines", [1, 32])
def test_texts_of_lines_that_only_share_a_passage_are_not_moved(spark, monkeypatch, common_lines):
    """pairs are told apart by sketches before their texts are joined, whatever made them meet."""
    monkeypatch.setattr(line_dedup, "COMMON", common_lines)
    lines = [(i, " ".join([f"passage{i // 2}word{j}" for j in range(4)] + [f"o{i}x{j}" for j in range(20)])) for i in range(60)]
    lines += [(100 + i, " ".join([f"passage{i}word{j}" for j in range(4)] + [f"o{2 * i}x{j}" for j in range(17)])) for i in range(3)]
    kept, init = [], common.Kept.__init__

    def counted(self, df, name):
        init(self, df, name)
        kept.append((name, self.df.count(), self.df.inputFiles()))

    monkeypatch.setattr(common.Kept, "__init__", counted)
    out = line_dedup.dedup_lines(spark.createDataFrame(lines, "doc_id long, text string"))
    assert {r.doc_id for r in out.collect() if r.n_removed} == {100, 101, 102}
    distinct, *moved = [n for name, n, _ in kept if name == "texts"]
    assert distinct == 63 and sum(moved) <= 12, moved
    assert all(f.endswith(".zstd.parquet") for name, _, files in kept if name in ("lines", "texts") for f in files)


def test_lines_alike_by_a_common_key_and_one_of_few_lines(spark, monkeypatch):
    """The two keys that lines alike surely share may be one of either kind."""
    monkeypatch.setattr(line_dedup, "COMMON", 4)
    rows = [(2 * i, f"incomparable circumstances d{i} e{i} f{i}") for i in range(12)] + [(2 * i + 1, f"incomparable circumstances d{i} g{i} f{i}") for i in range(12)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect() if r.n_removed) == [2 * i + 1 for i in range(12)]
