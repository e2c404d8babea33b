"""HTML extraction by a maximum-scoring run of words and tags, with weights learned from labelled pages."""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable
from functools import cache
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches_of, rows_of

# Names of HTML elements by their part in a page.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "xmp")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
DROPPED = set("head nav footer aside form dialog menu search button select option datalist label fieldset canvas audio video map".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
#: Words of class and id attributes that mark what is not the article; an own list.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promoted promotion outbrain taboola "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager skip "
    "header masthead footer colophon topbar toolbar sidebar sidebars aside widget widgets rail "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup paywall "
    "comment comments commentlist disqus respond replies reply discussion "
    "share sharing social related recommended recommendations copyright legal login search".split()
)
#: Of these, the words that mark adverts, and with them what else is no text of an article even where it stands within one.
ADVERTS = set("ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promoted promotion outbrain taboola".split())
WITHIN = ADVERTS | set("nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar sidebars cookie cookies consent gdpr popup modal newsletter subscribe paywall comment comments commentlist disqus respond replies share sharing social".split())
#: Words that say nothing of what a name marks; elements of running text, whose names are anchors and styles.
PLAIN = set("area box block container content inline item list main section slot text top bottom wrap wrapper".split())
TEXTUAL = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption hgroup".split())
HEADINGS = {"h1", "h2"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>",
    re.S | re.I,
)
ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![\w-])(hidden)(?![\w-])")
#: Marks that stand alone, such as those between links, are no words.
MARK = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
PIECE = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


def marked(name: str, value: str, inside: bool) -> bool:
    """Whether a class or id says that an element is no part of an article.

    Elements of running text, and all elements within an article or main element, go only by a name that says so with nothing else in it,
    such as ad-slot or comments: others, such as related-work or search, are names for parts of the article itself.
    """
    if name not in TEXTUAL and not inside:
        return any(p.lower() in MARKS for p in PIECE.findall(value))
    marks = ADVERTS if name in TEXTUAL else WITHIN
    for one in value.split():
        pieces = {p.lower() for p in PIECE.findall(one)} - PLAIN
        if pieces and pieces <= marks:
            return True
    return False


def unwanted(name: str, attrs: str, within: Counter, inside: bool) -> bool:
    """Whether an element is no part of an article, by its name, role, class, id or because it is hidden; within counts the open elements."""
    if name in DROPPED:
        return name != "footer" or not within["blockquote"]
    if name == "header":
        return not (within["article"] or within["main"])
    if name in ("html", "body", "main"):
        return False
    for key, a, b, c, hidden in ATTR.findall(attrs) if attrs.strip() else ():
        key, value = key.lower(), a or b or c
        if hidden or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and value.lower() in ROLES and not (inside and value.lower() in ("alert", "menu", "toolbar")):
            return True
        if key in ("class", "id") and marked(name, value, inside):
            # names such as "has-sidebar" on what holds the article say nothing of it
            if name != "article" or re.search(r"comment|reply|promo|sponsor|\bads?\b|advert|related", value, re.I):
                return True
    return False


class Block(NamedTuple):
    """A block's text, the words of it in links, the tags since the block before, its article or main element or 0, and whether it is marked as no part of one."""

    text: str
    linked: int
    tags: list[str]
    inside: int
    off: bool


class Page:
    """A page as blocks of text with the tags between them. Marked elements inside a paragraph are left out at once."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self._buffer: list[str] = []
        self._tags: list[str] = []
        self._linked = links = 0
        stack: list[tuple[str, bool, int, bool]] = []  # open elements: name, marked or inside such, article number, left out
        open_: Counter = Counter()
        at = articles = 0
        for m in TOKEN.finditer(source):
            if m.start() > at and not (stack and stack[-1][3]):
                self._add(source[at : m.start()], links > 0)
            at = m.end()
            name = (m["name"] or "").lower()
            if not name:
                continue
            if name == "a":
                links = 0 if m["end"] else 1
            off, inside, out = stack[-1][1:] if stack else (False, 0, False)
            if name in BLOCKS:
                self._flush(inside, off)
            if not out:
                self._tags.append(name)
            if m["end"]:
                if open_[name]:
                    if name in DROPPED:
                        self._flush(inside, off)
                    closed = ""
                    while closed != name:
                        closed = stack.pop()[0]
                        open_[closed] -= 1
                continue
            if name in BLOCKS and stack and name != "br":  # these end an open paragraph; an item ends the item before it
                for closed in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                    if stack[-1][0] == closed and (closed == "p" or name == closed or {closed, name} <= {"dt", "dd"} or {closed, name} <= {"td", "th"}):
                        open_[stack.pop()[0]] -= 1
                        break
                off, inside, out = stack[-1][1:] if stack else (False, 0, False)
            if name in VOID or m["attrs"].endswith("/") and name not in BLOCKS:
                continue
            if not off and unwanted(name, m["attrs"], open_, bool(inside)):
                off = True
                out = name not in BLOCKS
            if name in ("article", "main") and not off and not inside:
                articles += 1
                inside = articles
            if name in BLOCKS or name in DROPPED or off:
                stack.append((name, off, inside, out))
                open_[name] += 1
        if not (stack and stack[-1][3]):
            self._add(source[at:], links > 0)
        self._flush(stack[-1][2] if stack else 0, bool(stack and stack[-1][1]))
        held = Counter()
        for b in self.blocks:
            held[b.inside] += 0 if b.off else len(b.text)
        #: The article or main element that most text is in, or 0.
        self.article = max((n for n in held if n), key=lambda n: (held[n], -n), default=0)

    def _add(self, text: str, linked: bool) -> None:
        self._buffer.append(text)
        if linked:
            self._linked += len(text.split())

    def _flush(self, inside: int, off: bool) -> None:
        text = "".join(self._buffer)
        self._buffer.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            self.blocks.append(Block(text, self._linked, self._tags, inside, off))
            self._tags = []
        self._linked = 0

    def features(self, b: Block) -> Counter:
        """What a block is scored by: tags, words and words in links, each by where it stands."""
        where = "off" if b.off else "" if not self.article else "in" if b.inside == self.article else "out"
        n = b.text.count(" ") + 1 - len(MARK.findall(b.text))
        found = Counter((t, where) for t in b.tags)
        found["LINKED", where] += min(n, b.linked)
        found["WORD", where] += n - min(n, b.linked)
        return found


def best_run(scores: Iterable[float]) -> tuple[int, int]:
    """(start, end) of the consecutive scores with the largest sum, the first and longest of equals; one scan."""
    best, total, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or total == best and start == found[0] and found[1] > found[0]:
            best, found = total, (start, i + 1)
    return found


def labelled_pages() -> list[tuple[str, set[str]]]:
    """Pages with the words of their articles, made by a rule.

    They differ in the length and number of paragraphs, headings, lists, quotes and tables in the article, in whether an
    article or main element or only a div holds it, in the furniture before and after it, in
    whether that is marked by names, and in the length of words. Words of the article begin with x.
    """
    out = []
    for k in range(96):
        rng = random.Random(k)
        letters = rng.choice(("abcdefgh", "ñóéaiosr", "деносталк", "的一是不了人我"))
        word = lambda mark="": mark + "".join(rng.choices(letters, k=rng.randint(1, 9)))
        some = lambda n, mark="": " ".join(word(mark) for _ in range(n))
        links = lambda n: "".join(f'<li><a href="/{i}">{some(rng.randint(1, 3))}</a></li>' for i in range(n))

        def paragraph(rng=rng, some=some):
            kind, text = rng.random(), some(rng.choice((3, 8, 20, 40, 90)), "x")
            if kind < 0.7:
                return f"<p>{text} <a href='/'>{some(rng.randint(1, 4), 'x')}</a> <b>{some(1, 'x')}</b> {some(4, 'x')}</p>" if kind < 0.4 else f"<p>{text}</p>"
            if kind < 0.8:
                return "<ul>" + "".join(f"<li>{some(rng.randint(2, 14), 'x')}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
            if kind < 0.85:
                return f"<blockquote><p>{text}</p></blockquote>"
            if kind < 0.87:  # an article's own list of links, and tables of a row each
                return "<ul>" + "".join(f"<li><a href='/{i}'>{some(rng.randint(2, 5), 'x')}</a></li>" for i in range(rng.randint(5, 40))) + "</ul>"
            if kind < 0.9:
                return f"<h2>{some(3, 'x')}</h2>" + "".join(f"<table><tr><td>{some(1, 'x')}</td><td>{some(rng.randint(1, 6), 'x')}</td></tr></table>" for _ in range(rng.randint(3, 14)))
            return f"<h2>{some(3, 'x')}</h2><p>{text}</p>" if kind < 0.96 else f"<table><tr><td>{some(4, 'x')}</td><td>{text}</td></tr></table>"

        inner = f"<h1>{some(rng.randint(2, 9), 'x')}</h1>" + "".join(paragraph() for _ in range(rng.randint(2, 9)))
        name = rng.choice(("article", "main", "div", "div", "div"))
        marked = rng.random() < 0.6
        held = lambda tag, cls, text, marked=marked: f"<{tag} class='{cls}'>{text}</{tag}>" if marked else f"<div>{text}</div>"
        before = [held("nav", "menu", f"<ul>{links(rng.randint(3, 9))}</ul>"), held("div", "banner", some(rng.randint(2, 8))), f"<div><span><a>{some(2)}</a></span> <span>{some(2)}</span></div>"]
        after = [held("div", "related", f"<ul>{links(rng.randint(2, 6))}</ul>"), held("footer", "footer", f"<p>{some(rng.randint(3, 7))}</p><ul>{links(3)}</ul>"), f"<table><tr><td><a>{some(2)}</a></td><td>{word()}</td></tr></table>"]
        if marked:
            after.append("<div class='comments'>" + "".join(f"<div><b>{word()}</b><p>{some(rng.randint(5, 40))}</p></div>" for _ in range(rng.randint(1, 5))) + "</div>")
            cut = inner.split("</p>", 1)
            inner = cut[0] + "</p>" + rng.choice(("", f"<div class='ad'>{some(6)}</div>")) + cut[1] if len(cut) > 1 else inner
        before, after = (rng.sample(x, rng.randint(1, len(x))) for x in (before, after))
        out.append(f"<html><body>{''.join(before)}<{name}>{inner}</{name}>{''.join(after)}</body></html>")
    return out


@cache
def weights() -> tuple[dict[tuple[str, str], float], dict[str, float]]:
    """(weights of features, weights of tags that no page has, by place): the log odds of each in an article of the labelled pages.

    Words score positive and tags negative: a sign that says otherwise is cut to nearly nothing, but for words that are marked,
    linked, or outside of the article element.
    """
    within, outside = Counter(), Counter()
    for source in labelled_pages():
        page = Page(source)
        for b in page.blocks:
            (within if b.text.startswith("x") else outside).update(page.features(b))
    a, b = sum(within.values()), sum(outside.values())
    odds = {k: math.log((within[k] + 0.5) / a * b / (outside[k] + 0.5)) for k in {*within, *outside}}
    for k, v in odds.items():
        if k[0] not in ("WORD", "LINKED"):
            odds[k] = min(-0.05, v)
        elif k == ("WORD", ""):
            odds[k] = max(0.1, v)
    other = {w: min([-0.05, *(v / 2 for (t, x), v in odds.items() if x == w and t not in ("WORD", "LINKED"))]) for w in ("", "in", "out", "off")}
    return odds, other


def main_text(source: str | None) -> str:
    """The article of a page: the run of blocks with the largest score, less those in it that are marked as no part of it."""
    if not source:
        return ""
    page = Page(source)
    known, other = weights()
    scores: list[float] = []  # by turns a block's tags and its words
    for b in page.blocks:
        tags = words = 0.0
        for k, n in page.features(b).items():
            if k[0] in ("WORD", "LINKED"):
                words += n * known.get(k, 0.0)
            else:
                tags += n * known.get(k, other[k[1]])
        scores += [tags, words]
    start, end = best_run(scores)
    first, last = start // 2, -(-end // 2)
    if first < last and first and HEADINGS & set(page.blocks[first - 1].tags) and not page.blocks[first - 1].off:  # a title stands right before
        first -= 1
    return " ".join(b.text for b in page.blocks[first:last] if not b.off)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", more: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id_col, *more, text): the main text of every page's whole HTML.

    Character references are decoded, white space inside a block is one space, blocks are joined by one
    space in page order. A null, empty or wordless page has the empty text. Equal scores give the first
    run. Repeated rows give a row each, ids may be null, other columns are not read; each row is a task's
    own matter.
    """
    import pyarrow as pa

    own = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"), *[F.col(c).alias(f"more{i}") for i, c in enumerate(more)])
    kept = [f for f in own.schema if f.name != "html"]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in kept], ("text", pa.string())])
        yield from batches_of(((*[r[f.name] for f in kept], main_text(r["html"])) for r in rows_of(batches)), schema)

    out = own.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", text string")
    return out.withColumnsRenamed({"id": id_col, **{f"more{i}": c for i, c in enumerate(more)}})
