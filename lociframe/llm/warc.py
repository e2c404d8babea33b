"""WARC archives: one gzip member a record, revisit records for repeated payloads, a sequential checked reader."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import BROADCAST_BYTES, batches_of, keep, rows_of, scratch_path

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
#: An archive file is closed once it has so many compressed bytes.
ARCHIVE_BYTES = 64 << 20
#: Bytes that the reader takes from a file, or from a member, at a time.
CHUNK = 256 << 10
#: Every record has this date, so that writing the same pages again gives the same archives.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(url: str | None) -> str:
    """A target URI that fits one header line: what is not printable ASCII is percent-encoded."""
    raw = (url or "about:blank").encode("utf-8")
    return "".join(chr(b) if 33 <= b <= 126 else f"%{b:02X}" for b in raw)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, _uri(url) if page_id is None else f'page:{page_id}')}>"


def _member(head: list[str], block: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def about(name: str) -> bytes:
    """The record that begins an archive file and says what it is."""
    block = b"software: lociframe\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Date: {DATE}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Filename: {name}"]
    return _member([*head, "Content-Type: application/warc-fields", f"Content-Length: {len(block)}", f"WARC-Block-Digest: {_sha1(block)}"], block)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member: a response, or a revisit of refers_to's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}", f"WARC-Record-ID: {_record_id(page_id, url)}"]
    head += [f"WARC-Target-URI: {_uri(url)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"WARC-Block-Digest: {_sha1(block)}", f"WARC-Payload-Digest: {_sha1(payload)}"]
    head += [f"X-Page-ID: {page_id}"] * (page_id is not None)
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, None)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return _member(head, block)


def members(source: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as its decompressed chunks; a member is read to its end before the next."""
    rest = source.read(CHUNK)
    while rest:
        unpack = zlib.decompressobj(31)

        def chunks() -> Iterator[bytes]:
            nonlocal rest
            while not unpack.eof:
                if not rest and not (rest := source.read(CHUNK)):
                    raise ValueError("an archive ends inside a gzip member")
                data = unpack.decompress(rest, CHUNK)
                rest = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
                if data:
                    yield data

        member = chunks()
        yield member
        for _ in member:
            pass
        rest = rest or source.read(CHUNK)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}


def _text(payload: bytes, content_type: str) -> str:
    """A payload in the charset its header names, UTF-8 else; bytes that are not of it become U+FFFD."""
    named = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def read_record(chunks: Iterable[bytes]) -> dict:
    """One member's record; ValueError if its framing or one of its digests is wrong."""
    chunks, buffer = iter(chunks), bytearray()
    while (cut := buffer.find(b"\r\n\r\n")) < 0:
        more = next(chunks, b"")
        if not more:
            raise ValueError("a record has no end of its header")
        buffer += more
    fields = _fields(bytes(buffer[:cut]))
    if not buffer.startswith(b"WARC/") or "content-length" not in fields:
        raise ValueError("not a WARC record")
    length, start = int(fields["content-length"]), cut + 4
    del buffer[:start]
    for more in chunks:
        buffer += more
        if len(buffer) > length + 4:
            break
    if len(buffer) != length + 4 or buffer[length:] != b"\r\n\r\n":
        raise ValueError("a record's content length differs from its block")
    block = bytes(buffer[:length])
    if fields.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise ValueError("a block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, own, other = fields.get("warc-type", ""), fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    replied = _fields(http) if kind in ("response", "revisit") else {}
    digest = fields.get("warc-payload-digest", "")
    plain = "chunked" not in replied.get("transfer-encoding", "")
    size = int(replied.get("content-length", len(payload)))
    if kind == "response":
        if digest.startswith("sha1:") and digest != _sha1(payload) or plain and size != len(payload):
            raise ValueError("a payload digest or length differs")
        digest, size = _sha1(payload), len(payload)
    return {
        "page_id": None if own is None else int(own), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": size,
        "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None, "refers_to": None if other is None else int(other),
        "payload": _text(payload, replied.get("content-type", "")) if kind == "response" else None,
    }


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if re.match(r"\w+:/", path) else f"file://{path}")


def with_references(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): the largest page_id among equal payloads of ``least`` bytes for all its other pages.

    A null html is empty. A row without page_id is neither referred to nor refers; rows that repeat the
    largest page_id are all responses. Only repeated digests meet the pages again: broadcast if their
    counted size is small, else by joins in which no digest brings payloads together.
    """
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    own = own.withColumns({"n": F.octet_length("html"), "digest": F.sha2("html", 256)})
    again = own.where(f"n >= {int(least)}").groupBy("digest").agg(F.max("page_id").alias("first"), F.min("page_id").alias("other"))
    again = keep(again.where("first <> other").select("digest", "first"), "repeated")
    if again.count() * 120 <= BROADCAST_BYTES:
        joined = own.join(F.broadcast(again), "digest", "left")
    else:  # a common payload is one digest: without their payloads its rows find the first, and by their ids the payloads
        found = own.select("page_id", "digest").where("page_id IS NOT NULL").distinct().join(again, "digest")
        joined = own.join(found, ["page_id", "digest"], "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page as a record into archives under ``folder`` and return the kept manifest (path, records, bytes).

    ``folder`` is a URI that all executors reach (default: a new one beside spark.checkpoint.dir).
    A task names its files by itself and at random, so a task that runs twice, after an executor was
    lost, leaves files that no manifest row names; readers follow the manifest. An empty table writes
    nothing. Rows, sizes and nulls are as in with_references.
    """
    import pyarrow as pa

    to = (folder or scratch_path(pages.sparkSession, "warc")).rstrip("/")

    def write(batches):
        filesystem, root = _open(to)
        filesystem.create_dir(root, recursive=True)
        schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        done: list[tuple] = []
        out, path, n = None, "", 0
        for r in rows_of(batches, 64):
            if out is None:
                path, n = f"{uuid.uuid4().hex}.warc.gz", 0
                out = filesystem.open_output_stream(f"{root}/{path}", compression=None)
                out.write(about(path))
            out.write(record(r["page_id"], r["url"], r["html"].encode("utf-8"), r["refers_to"]))
            n += 1
            if out.tell() >= ARCHIVE_BYTES:
                done.append((f"{to}/{path}", n, out.tell()))
                out.close()
                out = None
        if out is not None:
            done.append((f"{to}/{path}", n, out.tell()))
            out.close()
        yield from batches_of(iter(done), schema)

    return keep(with_references(pages, id_col, url_col, html_col).mapInArrow(write, "path string, records bigint, bytes bigint"), "manifest")


RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload string"


def read_archives(manifest: DataFrame) -> DataFrame:
    """All responses and revisits of the archives a manifest names, checked: framing, block and payload digests (bare lower-case hex).

    Records of other kinds are checked and left out. A payload is read in the charset of its HTTP header.

    A file is read in order by one task, a few hundred KB and one record in memory at a time. A broken
    record fails the read. Revisits have a null payload and the full payload's length and digest.
    """
    import pyarrow as pa

    def read(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())])

        def records():
            for r in rows_of(batches):
                filesystem, path = _open(r["path"])
                with filesystem.open_input_stream(path, compression=None) as source:
                    for member in members(source):
                        x = read_record(member)
                        if x["record_type"] in ("response", "revisit"):
                            yield tuple(x[f.name] for f in schema)

        yield from batches_of(records(), schema, 128)

    files = manifest.select("path")
    return files.repartition(max(1, min(files.count(), 10_000))).mapInArrow(read, RECORD)
