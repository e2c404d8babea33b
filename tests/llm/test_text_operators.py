"""Secrets, languages, pages' text, licences, tokens: small cases and brute force."""

import base64
import bz2
import gzip
import lzma
import random
import re
import tracemalloc
import urllib.parse
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lociframe.llm import bpe, html_text, language_id, license_scan, secret_scan

KEY = "AKIA" + "B7" * 8


def spans(text):
    return [(k, s, e) for k, s, e, *_ in secret_scan.scan_text(text)]


def test_secrets_written_plainly():
    text = f'é token = "abcdef123456" and {KEY}, 0123456789abcdef; password: short'
    assert spans(text) == [("assign", 2, 23), ("access", 29, 49), ("hex", 51, 67)]
    assert spans("PassWord=ABCDEFGHIJKL") == [("assign", 0, 21)]
    assert spans("paſſword=ABCDEFGHIJKL") == []  # only A-Z fold
    assert spans("") == spans(None) == []


def test_leftmost_and_failing_matches_take_their_text():
    # the first match takes "token=..." as its value
    assert spans("secret=token=abcdefghijkl") == [("assign", 0, 25)]
    assert spans("AKIAAKIA" + "X" * 14) == [("access", 0, 22)]


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: urllib.parse.quote(s, safe="").replace("A", "%41"),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
        lambda s: urllib.parse.quote(base64.b64encode(zlib.compress(base64.b64encode(s.encode()))).decode(), safe=""),
    ],
)
def test_wrapped_secrets(wrap):
    inner = f"key {KEY} end"
    text = "é before " + (w := wrap(inner)) + " after"
    got = spans(text)
    assert [k for k, *_ in got if k == "access"] == ["access"]
    (_, s, e) = next(x for x in got if x[0] == "access")
    assert 9 <= s < e <= 9 + len(w)


def b64(data):
    return base64.b64encode(data).decode()


def lines_of(text, width, end="\n"):
    return end.join(text[i : i + width] for i in range(0, len(text), width))


PACKED = random.Random(4).randbytes(150).hex().encode()[:90] + f" {KEY} ".encode() + random.Random(5).randbytes(90)


@pytest.mark.parametrize(
    "text",
    [
        b64(gzip.compress(b"first") + gzip.compress(KEY.encode())),  # two members
        b64(gzip.compress(PACKED)[:-20]),  # cut off
        "https://x/ab/" + b64(f"a {KEY} b".encode()),
        "data-" + b64(f"a {KEY} b".encode()),
        "path/of-it/" + b64(zlib.compress(KEY.encode())),
        lines_of(b64(gzip.compress(PACKED)), 76),
        "> " + lines_of(b64(bz2.compress(PACKED)), 40, "\r\n > "),
        lines_of(b64(PACKED), 64, "\\n"),
        b64(KEY.encode("utf-16")),
        b64(f"a {KEY}".encode("utf-16-be")),
        "%FF" + "".join(f"%{c:02X}" for c in KEY.encode()),
        "".join(f"\\x{c:02x}" for c in b"\xff\xfe" + KEY.encode()),
        urllib.parse.quote(zlib.compress(KEY.encode()), safe=""),
        "".join(f"%u{ord(c):04x}" for c in f"😀 {KEY} "[1:]),
        "x/" + b64(("y/" + b64(gzip.compress(lines_of(b64(KEY.encode()), 20).encode()))).encode()),
        b64(lzma.compress(PACKED)),
        b64(gzip.compress(bytes(40 << 20) + KEY.encode())),  # three windows
    ],
    ids=range(17),
)
def test_secrets_in_layers_that_are_not_whole(text):
    got = [(s, e, v) for k, s, e, _, _, v in secret_scan.scan_text(f"é before {text} after") if k == "access"]
    assert [v for *_, v in got] == [KEY] and 9 <= got[0][0] < got[0][1] <= 9 + len(text)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("before", [0, 30_000, 64_000, 65_530, 100_000, 131_000])
def test_layers_across_windows_are_whole(monkeypatch, pack, before):
    monkeypatch.setattr(secret_scan, "WINDOW", 1 << 16)
    monkeypatch.setattr(secret_scan, "OVERLAP", 1 << 12)
    rng = random.Random(before)
    inner = gzip.compress(rng.randbytes(20_000) + f" {KEY} ".encode() + rng.randbytes(20_000))
    deep = gzip.compress(rng.randbytes(70_000) + inner + rng.randbytes(70_000))  # and one more within it
    for layer in (inner, deep):
        text = "x " + b64(pack(b"." * before + layer + b"." * 90_000)) + " y"
        got = [(s, e) for k, s, e, _, _, v in secret_scan.scan_text(text) if k == "access" and v == KEY]
        assert got and all(2 <= s < e <= len(text) - 2 for s, e in got)


def test_compressed_secret_of_few_letters():
    assert [f[5] for f in secret_scan.scan_text(b64(zlib.compress(b"a" * 16)))] == ["a" * 16]


def test_compressed_data_that_holds_itself_ends(monkeypatch):
    held = bytes.fromhex("1f8b0800")
    monkeypatch.setattr(secret_scan, "inflated", lambda data, start=0: iter([(held + f" {KEY} ".encode(), len(data))]))
    assert [f[5] for f in secret_scan.scan_text("x " + b64(held + f" {KEY} ".encode()))].count(KEY) >= 1


def test_url_and_base64_spans_are_exact():
    text = "x " + f"%20{KEY[:4]}%42{KEY[5:]}%20"
    assert spans(text) == [("access", 5, 5 + len(KEY) + 2)]
    coded = base64.b64encode(("abc" + KEY + "d").encode()).decode()
    assert spans("= " + coded) == [("access", 2 + 4, 2 + -(-23 * 4 // 3))]


def test_cycles_and_junk_end():
    w = "QUFB" * 50
    for _ in range(4):
        w = base64.b64encode(w.encode()).decode()
    secret_scan.scan_text(w + " %25%32%35 \\u005cu0041 &#38;#65;")
    rng = random.Random(1)
    for _ in range(200):
        secret_scan.scan_text("".join(rng.choice("%41\\ux{}&#;AKIAb=64 é😀") for _ in range(80)))


def test_brute_force_on_random_texts():
    rng = random.Random(2)
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for _ in range(500):
        t = "".join(rng.choice(["token", "Secret", "=", ":", " ", "abc", "0123456789ab", "AKIA", "XYZ9", "é", '"']) for _ in range(14))
        want = {("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 12}
        want |= {("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18}
        want |= {("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16}
        assert {f[:3] for f in secret_scan.scan_text(t) if f[3] == 0} == want


def test_secret_frame(spark):
    df = spark.createDataFrame([(1, "token=abcdefghijkl", 5), (1, None, 5), (None, "", 6), (2, "x" * 300_000, 7)], "doc_id long, text string, findings int")
    got = sorted(((r.doc_id or 0, len(r.findings)) for r in secret_scan.scan_secrets(df).collect()))
    assert got == [(0, 0), (1, 0), (1, 1), (2, 0)]
    assert secret_scan.scan_secrets(df.limit(0)).count() == 0


def test_language_learns_and_predicts(spark):
    rng = random.Random(3)
    kinds = {"aa": "abra cada bra", "bb": "xylo phon zyx"}
    rows = [(i, " ".join(rng.choice(kinds[k].split()) for _ in range(30)), k) for i in range(400) for k in [("aa", "bb")[i % 2]]]
    rows += [(900, None, "aa"), (901, "123 !!", "bb"), (None, "abra cada", None), (903, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.learn(df, docs=50)
    assert profiles.languages == ["aa", "bb"]
    got = {r.doc_id: r for r in language_id.identify(df, profiles, more=("lang", "text")).collect()}
    assert all(got[i].lang_pred == ("aa", "bb")[i % 2] and 0 <= got[i].score <= 1 for i in range(400))
    assert {got[i].lang_pred for i in (900, 901, 903)} == {"und"} and got[None].lang_pred == "aa"
    assert got[5].lang == "bb" and got[5].text == rows[5][1]
    none = language_id.learn(df.limit(0))
    assert {(r.lang_pred, r.score) for r in language_id.identify(df, none).collect()} == {("und", 0.0)}


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, language_id.learn(docs), more=("lang", "text")).where(language_id.held_out("doc_id") & F.col("lang").isNotNull())
    rows = [r for r in found.collect() if sum(c.isalpha() for c in r.text or "") >= 40]
    right = [r for r in rows if r.lang == r.lang_pred]
    assert len(rows) > 100 and len(right) >= 0.97 * len(rows), len(right) / len(rows)
    assert all(r.score >= 0.2 for r in right)


def test_grams_by_counting():
    text = "Aé b, ab"
    want = Counter()
    for w in ("aé", "b", "ab"):
        want.update(w)
        padded = f" {w} "
        for n in (2, 3):
            want.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    keys, counts = language_id.grams(text)
    got = {"".join(chr(k >> s & 0x1FFFFF) for s in (42, 21, 0)).lstrip("\0"): n for k, n in zip(keys.tolist(), counts.tolist())}
    assert got == want
    old, language_id.CHUNK = language_id.CHUNK, 3
    try:
        assert [x.tolist() for x in language_id.grams(text)] == [keys.tolist(), counts.tolist()]
    finally:
        language_id.CHUNK = old


def overlap_f1(got, want):
    g, w = Counter(got.split()), Counter(want.split())
    return 2 * sum((g & w).values()) / (sum(g.values()) + sum(w.values()) or 1)


def test_pages_of_layouts_not_learned_from():
    rng = random.Random(99)
    words = lambda n: " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 10))) for _ in range(n))
    scores = {}
    for _ in range(60):
        paragraphs = [words(rng.choice((6, 15, 30, 60, 120))) for _ in range(rng.randint(3, 12))]
        title = words(rng.randint(3, 9))
        want = f"{title} {' '.join(paragraphs)}"
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        menu = "".join(f"<a href=x>{words(2)}</a> | " for _ in range(8))
        side = "".join(f"<dt><a href=x>{words(3)}</a></dt>" for _ in range(5))
        layouts = {
            "article": f"<html><head><title>t</title></head><body><header>{words(4)}</header><p>{menu}</p><article>{body}</article><section id='comments'><p>{words(30)}</p></section><footer>{words(9)}</footer></body></html>",
            "main": f"<body><nav>{menu}</nav><main><div>{body}</div><aside>{words(20)}</aside></main><form>{words(4)}<input></form></body>",
            "named divs": f"<body><div id=top>{menu}</div><div class=content><div class=inner>{body}</div></div><dl>{side}</dl><div class='site-footer'>{words(8)}</div></body>",
            "plain divs": f"<body><p>{menu}</p><div><section>{body}</section></div><div><dl>{side}</dl></div><div><span>{words(5)}</span></div></body>",
        }
        for k, page in layouts.items():
            scores.setdefault(k, []).append(overlap_f1(html_text.main_text(page), want))
    mean = {k: sum(v) / len(v) for k, v in scores.items()}
    assert mean["article"] == mean["main"] == 1 and min(mean.values()) > 0.97, mean


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><nav><ul><li><a href="/">Home</a></li></ul></nav></header><div class="cookie-notice">We use cookies all day and all night</div>
%s<aside>Side words here</aside><section id="comments"><article class="comment"><p>What a long comment this is, longer than the text itself, on and on and on.</p></article></section>
<form><p>Name</p><input></form><footer>&copy; someone</footer></body></html>"""


@pytest.mark.parametrize("box", ["article", "main", "div"])
def test_main_text(box):
    body = f"<{box}><h1>The  title</h1><p>One <b>bo</b>ld &amp; &eacute;<br>two<p>Three\n four five six seven eight nine ten<div class='ad'>Buy this now</div><ul><li>five more words stand in this<li>six more words stand in that one</ul></{box}>"
    assert html_text.main_text(PAGE % body) == "The title One bold & é two Three four five six seven eight nine ten five more words stand in this six more words stand in that one"


def test_names_inside_an_article_drop_no_text():
    some = lambda k, n=30: " ".join(f"word{k}x{i}" for i in range(n))
    links = "<ul>" + "".join(f"<li><a href='/{i}'>own link {i}</a></li>" for i in range(30)) + "</ul>"
    tables = "<h2>A table</h2>" + "".join(f"<table><tr><td>cell {i}</td><td>of it</td></tr></table>" for i in range(12))
    parts = {
        '<h2 id="search">A heading</h2>': "A heading", '<section id="related-work"><p>Other work.</p></section>': "Other work.", '<p class="legal">By law.</p>': "By law.", '<p class="alert">Mind this.</p>': "Mind this.",
        '<ul class="menu-items"><li>Soup</li></ul>': "Soup", links: " ".join(f"own link {i}" for i in range(30)), tables: "A table " + " ".join(f"cell {i} of it" for i in range(12)), "<pre><code id='header'>a &lt; b</code></pre>": "a < b",
        '<div class="ad-slot">Buy now</div>': "", '<div id="comments"><p>First!</p></div>': "", "<p class='advertisement'>Buy now</p>": "", "<nav><a>Home</a></nav>": "", "<form><p>Name</p></form>": "",
    }
    for html, text in parts.items():
        page = f"<html><body><div class='menu'><a>Home</a></div><article><h1>Title</h1><p>{some(1)}</p>{html}<p>{some(2)}</p></article><div class='related'><a>More</a></div></body></html>"
        assert html_text.main_text(page) == " ".join(f"Title {some(1)} {text} {some(2)}".split()), html


def test_nested_and_long_pages_take_time_by_their_length(spark):
    import time

    began = time.process_time()
    assert html_text.main_text("<div>" * 100_000 + "some words here" + "</div>" * 100_000) == "some words here"
    assert html_text.main_text("<div><span></p>" * 100_000 + "some words here") == "some words here"
    assert time.process_time() - began < 10
    long = "a word and another " * 60_000
    assert html_text.main_text(f"<article><p>{long}</p></article>") == long.strip()
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(empty).collect() == []


def test_odd_pages(spark):
    for page in (None, "", "   ", "<", "<p", "<div class=\"a'>x", "<!-- open", "<script>", "<table><tr><td>", "</div></p>"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("just words") == "just words"
    df = spark.createDataFrame([(1, "u", "<p>a</p>", "z"), (1, "u", "<p>a</p>", "z"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in html_text.extract(df).collect()) == [(0, ""), (1, "a"), (1, "a")]
    assert html_text.best_run([-1, 2, -1, 2, -5, 3]) == (1, 4) and html_text.best_run([]) == html_text.best_run([-1]) == (0, 0)


def test_best_run_is_best():
    rng = random.Random(4)
    for _ in range(200):
        xs = [rng.randint(-4, 4) for _ in range(9)]
        s, e = html_text.best_run(xs)
        assert sum(xs[s:e]) == max(sum(xs[i:j]) for i in range(10) for j in range(i, 10))


def test_licences(spark):
    rows = [
        (1, "Foo.\nReleased under the MIT License. Bar", "a"), (2, "Licensed under the Apache License, Version 2.0.", "b"),
        (3, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: nothing", "c"),
        (4, "No licence here", None), (5, None, None), (6, "", None), (1, "Foo.\nReleased under the MIT License. Bar", "a"),
        (7, "See below. Unless required. You may not use this file except in compliance with the License. Some text. You may obtain a copy of the License at\nhttp://x", "d"), (8, "RELEASED UNDER THE MIT LICENSE", "e"),
    ]
    got = sorted((r.doc_id, list(r.sentence_ids), list(r.licenses)) for r in license_scan.find_licenses(spark.createDataFrame(rows, "doc_id long, text string, licenses string")).collect())
    assert got == [
        (1, ["mit_released"], ["MIT"]), (1, ["mit_released"], ["MIT"]), (2, ["apache2_licensed"], ["Apache-2.0"]),
        (7, ["apache2_compliance", "apache2_copy"], ["Apache-2.0"]), (8, ["mit_released"], ["MIT"]),
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.find_licenses(empty).count() == 0


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
%s Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
%s Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_wrapped_licences(spark):
    marked = lambda text, mark: "\n".join(f"{mark} {x}".rstrip() for x in text.split("\n"))
    texts = {"MIT": MIT, "BSD-2-Clause": BSD2 % ("1.", "2."), "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "MPL-2.0": MPL, "ISC": ISC}
    rows = [(k, t) for k, v in texts.items() for t in (v, v.replace("\n", "\r\n"), marked(v, "#"), marked(v, " *"), marked(v, "//"))]
    rows += [("BSD-2-Clause", BSD2 % marks) for marks in (("*", "*"), ("(a)", "(b)"), ("1)", "2)"))]
    got = license_scan.find_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and all(list(r.licenses) == [r.doc_id] for r in got)
    assert {tuple(r.sentence_ids) for r in got if r.doc_id == "MIT"} == {("mit_title", "mit_grant", "mit_notice", "mit_as_is", "mit_liability")}
    apart = [(1, "Released under\n\nthe MIT License"), (2, "Released under. The MIT License\nwe do not like"), (3, "It was not released under the MIT License")]
    got = license_scan.find_licenses(spark.createDataFrame(apart, "doc_id long, text string")).collect()
    assert [(r.doc_id, list(r.licenses)) for r in got] == [(1, []), (2, [])]


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_tokens_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    own, other = bpe.Vocabulary(bpe.read_vocabulary(VOCABULARY)), tokenizers.Tokenizer.from_file(VOCABULARY)
    rng = random.Random(5)
    texts = ["", "a", "<|endoftext|>", "x<|endoftext|> y", " " * 300 + "a", "ab" * 200, "a" * 99, "\n" * 70, "don't I'LL 'S", "\x00\x85\xa0 x", "é😀 ﷽ 你好"]
    texts += ["".join(rng.choice("ab  thein\n\t'sre12é€😀") for _ in range(rng.randint(0, 80))) for _ in range(800)]
    for t, p in zip(texts, own.encode_batch(texts)):
        ids = other.encode(t, add_special_tokens=False).ids
        assert [int.from_bytes(p[i : i + 4], "little") for i in range(0, len(p), 4)] == ids
        assert own.decode(p) == other.decode(ids, skip_special_tokens=False) == t
    assert own.decode(own.packed[own.ids[b"\xc3"]]) == "�"
    df = spark.createDataFrame([(1, t) for t in texts[:12]] + [(None, None)], "doc_id long, text string").withColumnRenamed("text", "ids")
    back = bpe.decode(spark, bpe.encode(spark, df, bpe.read_vocabulary(VOCABULARY), text_col="ids"), bpe.read_vocabulary(VOCABULARY))
    assert sorted(r.text for r in back.collect()) == sorted([*texts[:12], ""])


def test_few_cached_words_change_no_tokens(monkeypatch):
    source = bpe.read_vocabulary(VOCABULARY)
    texts = [f"alpha beta{i % 3} gamma{i} alpha" for i in range(40)]
    want = bpe.Vocabulary(source).encode_batch(texts)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 4)
    monkeypatch.setattr(bpe, "CACHED_ANSWERS", 4)
    v = bpe.Vocabulary(source)
    assert [v.encode_batch([t])[0] for t in texts] == want
    assert len(v.words) + len(v.older) <= 12


def test_words_of_any_length_take_memory_by_their_length():
    tokenizers = pytest.importorskip("tokenizers")
    own, other = bpe.Vocabulary(bpe.read_vocabulary(VOCABULARY)), tokenizers.Tokenizer.from_file(VOCABULARY)
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "".join(rng.choices("中文字符日本語", k=40_000)), "ACGT" * 5000]
    tracemalloc.start()
    got = own.encode_batch(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 300 << 20 and not own.words  # nor does the cache keep them
    for t, p in zip(texts, got):
        assert [int.from_bytes(p[i : i + 4], "little") for i in range(0, len(p), 4)] == other.encode(t, add_special_tokens=False).ids


def test_files_with_other_rules_are_refused():
    import json

    spec = json.loads(bpe.read_vocabulary(VOCABULARY))
    for other in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}):
        with pytest.raises(ValueError):
            bpe.Vocabulary(json.dumps(spec | other))


def test_words_in_order_of_letters_or_bytes():
    """The walk takes words by their letters: beyond U+FFFF too that is the order of their bytes."""
    tokenizers = pytest.importorskip("tokenizers")
    own, other = bpe.Vocabulary(bpe.read_vocabulary(VOCABULARY)), tokenizers.Tokenizer.from_file(VOCABULARY)
    words = ["\uffee", "\U00010400\uffee", "\ue000a", "\U0001f600", "z\U0001f600", "zz", "z", "zoo", "zoos", "\uffeez", "\x7f", "\x80", "a\x00", "a"]
    for word, ids in own.encode_words(words).items():
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == other.encode(word, add_special_tokens=False).ids or len(own.split.findall(word)) > 1, word
    assert own.sizes == [len(b) for b in own.bytes]
