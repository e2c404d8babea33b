"""Secret scans: a recursive decoding worklist over URL, Unicode, base64 and compressed layers."""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches_of, rows_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
# A run that is long enough is found at its first character, as by matching runs of any length and dropping the short.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|(?:%u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
# Lines of base64 that follow each other are one run; a compressed secret takes 14 letters or more.
LETTERS = r"[A-Za-z0-9+/_-]"
BASE64 = re.compile(rf"{LETTERS}{{14,}}(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>#*]*{LETTERS}{{14,}})*(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>#*]*{LETTERS}+)?")
RUN = re.compile(rf"{LETTERS}+")
TO_PLAIN = str.maketrans("-_", "+/")
#: Bytes that may hold a secret or another layer: so many that can be printed, or the beginning of compressed data.
PRINTED = re.compile(rb"[\t\n\r\x20-\x7e]{12}")
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}|(?:\x00[\t\n\r\x20-\x7e]){12,}")
#: What is compressed is looked at in windows of so many bytes, which overlap by so many; smaller layers are one window.
WINDOW, OVERLAP = 16 << 20, 1 << 20

Up = Callable[[int, int], tuple[int, int]]


def find(text: str) -> Iterator[tuple[str, int, int]]:
    """Secrets written plainly in text: (kind, start, end)."""
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _streams(chunks: Iterator[bytes], state: dict | None = None) -> Iterator[tuple[bytes, int]]:
    """(bytes, how much was read) of compressed data, piece by piece: all members, and what comes before a fault.

    state, if given, says at the end whether the data ended within a member.
    """
    state = {} if state is None else state
    state["cut"] = False
    data, read, more = b"", 0, True

    def enough() -> None:
        nonlocal data, more
        while more and len(data) < 8:
            part = next(chunks, None)
            more, data = part is not None, data + (part or b"")

    enough()
    while MAGIC.match(data):
        d = bz2.BZ2Decompressor() if data[:2] == b"BZ" else lzma.LZMADecompressor() if data[:2] == b"\xfd7" else zlib.decompressobj(47)
        flat = data[:1] in (b"\x1f", b"\x78")
        state["cut"] = True
        while not d.eof:
            try:
                out = d.decompress(data, OVERLAP)
                read += len(data)
                yield out, read - len(d.unused_data)
                while not d.eof and (out := d.decompress(d.unconsumed_tail if flat else b"", OVERLAP)):
                    yield out, read
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                state["cut"] = False
                return
            if not d.eof:
                data = next(chunks, None)
                if data is None:
                    return
        state["cut"] = False
        data = d.unused_data
        read -= len(data)
        enough()


def _skipped(pieces: Iterator[tuple[bytes, int]], n: int) -> Iterator[bytes]:
    """What pieces hold from their n-th byte on."""
    for out, _ in pieces:
        if n < len(out):
            yield out[n:]
        n = max(0, n - len(out))


def _ends_within(data: bytes) -> bool:
    """Whether compressed data begins here that goes on after the data."""
    state: dict = {}
    for _ in _streams(iter([data]), state):
        pass
    return state["cut"]


def _windows(source: Callable[[], Iterator[bytes]], level: int = 1) -> Iterator[tuple[bytes, int, int]]:
    """(content, how much was read, level) of compressed data in windows, and of what is compressed within it and crosses a window's end.

    Such a layer is read from its beginning on, by inflating what is around it once more, so it is whole; of level 1 is the data's own content.
    """
    held, size, base, end, first = [], 0, 0, 0, 0
    for out, end in _streams(source()):
        held.append(out)
        size += len(out)
        if size >= WINDOW:
            whole = b"".join(held)
            yield whole, end, level
            for m in MAGIC.finditer(whole, first):
                if _ends_within(whole[m.start() :]):
                    yield from _windows(lambda at=base + m.start(): _skipped(_streams(source()), at), level + 1)
            base, first = base + len(whole) - OVERLAP, OVERLAP
            held, size = [whole[-OVERLAP:]], OVERLAP
    if size:
        yield b"".join(held), end, level


def inflated(data: bytes, start: int = 0) -> Iterator[tuple[bytes, int]]:
    """(content, end of the data read) of gzip, zlib, bzip2 or xz data from start, in windows; nothing of other data.

    Compressed layers in it that no window holds whole follow the window in which they begin.
    """
    view = memoryview(data)[start:]
    done = 0
    for window, end, level in _windows(lambda: (bytes(view[at : at + 4096]) for at in range(0, len(view), 4096))):
        done = max(done, end) if level == 1 else done
        yield window, start + done


def _unescaped(run: str) -> str | None:
    """What one run of escapes stands for; a byte that is not UTF-8 becomes the code point of surrogateescape."""
    if run[:2] == "%u":
        return bytes.fromhex(run.replace("%u", "")).decode("utf-16-be", "replace")
    if run[0] == "%" or run[:2] == "\\x":
        return bytes.fromhex(run.replace("%", "").replace("\\x", "")).decode("utf-8", "surrogateescape")
    try:
        if run[:2] == "&#":
            out = chr(int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1]))
        elif run[:3] == "\\u{":
            out = chr(int(run[3:-1], 16))
        elif run[:2] == "\\U":
            out = chr(int(run[2:], 16))
        else:
            return bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "replace")
    except (ValueError, OverflowError):
        return None
    return "\ufffd" if "\ud800" <= out <= "\udfff" else out


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def _located(pieces: list[tuple[int, int, int, bool]], up: Up) -> Up:
    """A map of spans of a new text, which has pieces (its start, start and end in the old text, one to one), to the root."""
    starts = [p[0] for p in pieces]

    def mapped(s: int, e: int) -> tuple[int, int]:
        (n, a, _, same), (m, c, d, also) = pieces[bisect_right(starts, s) - 1], pieces[bisect_right(starts, max(s, e - 1)) - 1]
        return up(a + (s - n) * same, c + (e - m) if also else d)

    return mapped


def _substituted(text: str, pattern: re.Pattern, up: Up) -> tuple[str, Up] | None:
    """text with the pattern's runs decoded, and a map of its spans to the root."""
    out: list[str] = []
    pieces: list[tuple[int, int, int, bool]] = []
    at = n = 0
    for m in pattern.finditer(text):
        new, s = _unescaped(m[0]), m.start()
        if not new:
            continue
        if s > at:
            out.append(text[at:s])
            pieces.append((n, at, s, True))
            n += s - at
        unit = 4 if m[0][:2] == "\\x" else 3 if m[0][0] == "%" and m[0][1] != "u" else 0
        if unit or m[0][:2] in ("\\u", "%u") and m[0][2] != "{":
            for ch in new:  # each character has its own bytes
                e = s + (unit * len(_bytes(ch)) if unit else 12 if ord(ch) > 0xFFFF else 6)
                pieces.append((n, s, e, False))
                n, s = n + 1, e
        else:
            pieces.append((n, s, m.end(), False))
            n += len(new)
        out.append(new)
        at = m.end()
    if not out:
        return None
    out.append(text[at:])
    pieces.append((n, at, len(text), True))
    return "".join(out), _located(pieces, up)


def _from_base64(m: re.Match, up: Up) -> Iterator[tuple[bytes, Up]]:
    """The bytes of a run of base64 letters from its first four letters on, and a map of their spans; a prefix may be glued to the run."""
    pieces, lines, n = [], [], 0
    for x in RUN.finditer(m[0].replace("\\r", "  ").replace("\\n", "  ") if "\\" in m[0] else m[0]):
        pieces.append((n, m.start() + x.start(), m.start() + x.end(), True))
        lines.append(x[0])
        n += len(x[0])
    letters, located = "".join(lines).translate(TO_PLAIN), _located(pieces, up)
    for first in range(min(4, n)):
        body = letters[first : n - ((n - first) % 4 == 1)]

        def mapped(s: int, e: int, first=first) -> tuple[int, int]:
            return located(first + s * 4 // 3, min(n, first - (-e * 4 // 3)))

        yield binascii.a2b_base64(body + "=" * (-len(body) % 4)), mapped


def _in_bytes(data: bytes, up: Up) -> Iterator[tuple[str, str | bytes, Up]]:
    """The layers in bytes: their text, if any of it can be printed, UTF-16 in them, and what they have compressed."""
    if PRINTED.search(data):
        text = data.decode("utf-8", "surrogateescape")
        if len(text) == len(data):
            yield "", text, up
        else:
            yield "", text, lambda s, e: up(a := len(_bytes(text[:s])), a + len(_bytes(text[s:e])))
    for m in WIDE.finditer(data):
        yield "utf-16", m[0].replace(b"\0", b"").decode("ascii"), lambda s, e, at=m.start(): up(at + 2 * s, at + 2 * e)
    at = 0
    while m := MAGIC.search(data, at):
        at = m.start() + 1
        for window, end in inflated(data, m.start()):
            yield "compressed", window, lambda _s, _e, s=m.start(), e=end: up(s, e)
            at = max(at, end)


def unwrapped(layer: str | bytes, up: Up) -> Iterator[tuple[str, str | bytes, Up]]:
    """The layers directly under one, text or bytes: (how it was wrapped, the layer, a map of its spans to the root)."""
    if isinstance(layer, bytes):
        yield from _in_bytes(layer, up)
        return
    for name, pattern, mark in (("url", PERCENT, "%"), ("unicode", ESCAPED, None)):
        if (mark in layer if mark else "\\" in layer or "&#" in layer or "%u" in layer) and (got := _substituted(layer, pattern, up)):
            inner, mapped = got
            yield name, inner, mapped
            if MAGIC.search(data := _bytes(inner)):
                chars = lambda s, e, data=data, mapped=mapped: mapped(a := len(data[:s].decode("utf-8", "surrogateescape")), a + len(data[s:e].decode("utf-8", "surrogateescape")))
                yield from ((f"{name}>{how}", part, at) for how, part, at in _in_bytes(data, chars) if how == "compressed")
    for m in BASE64.finditer(layer):
        for data, mapped in _from_base64(m, up):
            for how, inner, located in _in_bytes(data, mapped):
                yield f"base64>{how}" if how else "base64", inner, located


def scan_text(text: str | None) -> list[tuple[str, int, int, int, str, str]]:
    """(kind, start, end, depth, layer, value) of all secrets in text and in what is wrapped in it.

    A worklist holds the layers not yet looked at, text or bytes, of each depth the next one only, so
    that a layer of any size is held a window at a time. A layer that was seen before at its place is
    not entered again, so compressed data that holds itself ends, too. Spans are those of the root text that the secret,
    or the wrapping around it, takes. Of compressed data over WINDOW bytes, a plain secret of over OVERLAP bytes may be cut; compressed layers within it are
    whole (``_windows``).
    """
    if not text:
        return []
    found: dict[tuple, tuple] = {}
    seen: set[tuple] = set()
    work: list[Iterator[tuple[str, str | bytes, Up]]] = [iter([("", text, lambda s, e: (s, e))])]
    paths: list[str] = [""]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            paths.pop()
            continue
        how, now, up = layer
        # the same content at another place is another finding; at the same place it is a cycle
        key = (hashlib.blake2b(now if isinstance(now, bytes) else now.encode("utf-8", "surrogatepass"), digest_size=16).digest(), isinstance(now, bytes), *up(0, len(now)))
        if key in seen:
            continue
        seen.add(key)
        depth, path = len(work) - 1, ">".join(x for x in (paths[-1], how) if x)
        for kind, s, e in find(now) if isinstance(now, str) else ():
            a, b = up(s, e)
            old = found.get((kind, a, b))
            if old is None or depth < old[3]:
                found[kind, a, b] = (kind, a, b, depth, path, now[s:e])
        work.append(unwrapped(now, up))
        paths.append(path)
    return sorted(found.values(), key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


FOUND = "array<struct<kind:string,start:bigint,end:bigint,depth:int,layer:string,value:string>>"


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every text: (id_col, findings).

    findings are sorted by start, kind (assign, access, hex), end; spans count code points of the text,
    end exclusive; depth 0 is written plainly, and layer names the wrappings of deeper ones. A null or
    empty text has no findings; repeated rows each give a row; a null id stays null; other columns of df
    are not read; an empty table gives an empty one. Each row is a task's own matter: nothing is shuffled.
    """
    import pyarrow as pa

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32()), ("layer", pa.string()), ("value", pa.string())])
    kind = df.schema[id_col].dataType

    def scan(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([("id", to_arrow_type(kind)), ("findings", pa.list_(span))])
        names = [f.name for f in span]
        rows = ((r["id"], [dict(zip(names, f)) for f in scan_text(r["text"])]) for r in rows_of(batches))
        yield from batches_of(rows, schema)

    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = own.mapInArrow(scan, f"id {kind.simpleString()}, findings {FOUND}")
    return out.select(F.col("id").alias(id_col), "findings")
