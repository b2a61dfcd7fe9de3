"""WARC archives: written record by record, read back sequentially.

Every record is one gzip member. The reader decompresses in pieces, frames blocks by their
Content-Length, and verifies block and payload digests; it holds one piece, and a whole
payload only if payloads are asked for. Of pages with equal payloads the one with the
largest id is written as response; the others are revisits that refer to it.

Tasks write to the shared folder under a name of their own attempt and rename the finished
file, so a repeated task replaces its file as a whole. The table of finished files, not a
listing of the folder, says what is read.

Defined results: null html is an empty payload; a null id is written without one and read
as null, and is a response only if no equal payload has an id; rows that repeat id and payload are
repeated records of the same type; null urls are left out; other columns play no part,
whatever their names; an empty table gives no records. Damaged archives raise.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyboard.llm.common import broadcast_measured, col
from tallyboard.session import scratch_path, scratch_table

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1_000_000_000  # an archive of this size is followed by another
PIECE = 1 << 18


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _urn(name: str | None) -> str:
    return "<urn:page:" + ("" if name is None else "i" + quote(name, safe="")) + ">"


def _name(urn: str) -> str | None:
    inner = re.fullmatch(r"<urn:page:(?:i(.*))?>", urn)
    if not inner:
        raise ValueError(f"not a page id: {urn}")
    return None if inner[1] is None else unquote(inner[1])


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([packer.compress(VERSION + head.encode() + b"\r\n"), packer.compress(block), packer.compress(END), packer.flush()])


def record(name: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool, date: str) -> bytes:
    """One gzip member: a response with the payload, or a revisit with its HTTP head alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(name)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0], safe=""), url)))
    if revisit:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", "sha1:" + _base32(hashlib.sha1(payload).digest())),
               ("WARC-Block-Digest", "sha1:" + _base32(hashlib.sha1(block).digest()))]
    return _member(fields, block)


class _Archive:
    """One archive being written under the name of this attempt."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        self.final = f"{folder}/{name}"
        self.files, self.path = fs.FileSystem.from_uri(self.final)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.own, compression=None)
        self.records = self.size = 0
        self.add(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(name)), ("Content-Type", "application/warc-fields")],
                         b"format: WARC File Format 1.1\r\n"))
        self.records = 0

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.records += 1
        self.size += len(member)

    def finish(self) -> tuple[str, int, int]:
        self.out.close()
        try:
            self.files.move(self.own, self.path)
        except OSError:  # where a move does not replace what an earlier attempt left
            self.files.delete_file(self.path)
            self.files.move(self.own, self.path)
        return self.final, self.records, self.size


def with_types(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """(name, url, html, refers_to, revisit): which pages are responses and which revisit them.

    Digests that occur once are not joined; those of groups of copies are few rows, broadcast when measured small.
    """
    text = F.coalesce(col(html), F.lit(""))
    rows = pages.select(col(id_col).alias("id"), col(url).cast("string").alias("url"), text.alias("html"), F.sha1(text).alias("digest"))
    groups = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(
        F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    groups = scratch_table(groups.select("digest", "first"), "copies")
    rows = rows.join(broadcast_measured(groups.withColumn("copied", F.lit(True)), 64), "digest", "left")
    revisit = F.coalesce(F.col("copied"), F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.select(F.col("id").cast("string").alias("name"), "url", "html",
                       F.when(revisit, F.col("first").cast("string")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one archive or more per task; the result is the written table (path, records, bytes) of them."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, archive, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if archive is None:
                    archive = _Archive(folder, f"part-{part:05d}-{number:05d}.warc.gz")
                archive.add(record(row.name, row.url, row.html.encode(), row.refers_to, row.revisit, date))
                if archive.size >= file_bytes:
                    done.append(archive.finish())
                    archive, number = None, number + 1
        if archive:
            done.append(archive.finish())
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    typed = with_types(pages, id_col, url, html, least_bytes)
    return scratch_table(typed.mapInPandas(write, "path string, records bigint, bytes bigint"), "archives")


class _Members:
    """Decompressed bytes of one gzip member after the other, a piece at a time."""

    def __init__(self, raw):
        self.raw, self.coming, self.ready, self.unpack = raw, b"", b"", None

    def next_member(self) -> bool:
        """To the start of the next member; False at the end of the file."""
        if self.unpack and (self.ready or self._more()):
            raise ValueError("bytes after the record in its member")
        self.coming = self.coming or self.raw.read(PIECE)
        self.unpack = zlib.decompressobj(31) if self.coming else None
        return bool(self.coming)

    def _more(self) -> bool:
        """Some more of this member; False at its end."""
        while not self.unpack.eof:
            self.coming = self.coming or self.raw.read(PIECE)
            if not self.coming:
                raise ValueError("archive ends inside a member")
            piece = self.unpack.decompress(self.coming, PIECE)
            self.coming = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if piece:
                self.ready += piece
                return True
        return False

    def head(self) -> bytes:
        """Bytes up to the next empty line, which is taken, too; however long, as an address may be."""
        held, seen = bytearray(), 0
        while True:
            held += self.ready
            self.ready = b""
            end = held.find(END, max(0, seen - len(END) + 1))
            if end >= 0:
                self.ready = bytes(held[end + len(END):])
                return bytes(held[:end])
            seen = len(held)
            if not self._more():
                raise ValueError("no end of header")

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes."""
        while n:
            if not self.ready and not self._more():
                raise ValueError("member ends before its Content-Length")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            yield piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def records(raw, with_payload: bool = True) -> Iterator[tuple]:
    """(name, url, type, refers_to, payload bytes, payload digest, payload) of an open archive, verified."""
    members = _Members(raw)
    while members.next_member():
        head = members.head()
        if not head.startswith(VERSION):
            raise ValueError("not a WARC record")
        f = _fields(head[len(VERSION):])
        of_block, of_payload, size, kept, inner = hashlib.sha1(), hashlib.sha1(), 0, [], b""
        in_payload = not f["content-type"].startswith("application/http")
        for piece in members.pieces(int(f["content-length"])):
            of_block.update(piece)
            if not in_payload:
                inner += piece
                if END not in inner:
                    continue
                inner, _, piece = inner.partition(END)
                in_payload = True
            of_payload.update(piece)
            size += len(piece)
            if with_payload:
                kept.append(piece)
        if b"".join(members.pieces(len(END))) != END:
            raise ValueError("record does not end with two line ends")
        if f["warc-type"] not in ("response", "revisit"):
            continue
        digest = f["warc-payload-digest"].removeprefix("sha1:")
        length = int(_fields(inner.partition(b"\r\n")[2])["content-length"])
        if f["warc-block-digest"] != "sha1:" + _base32(of_block.digest()):
            raise ValueError("block digest differs")
        revisit = f["warc-type"] == "revisit"
        if not revisit and (digest != _base32(of_payload.digest()) or length != size):
            raise ValueError("payload digest or length differs")
        yield (_name(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"], _name(f["warc-refers-to"]) if revisit else None,
               length, digest, b"".join(kept) if with_payload and not revisit else None)


def read_archives(archives: DataFrame, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """Records of the archives in column ``path``: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    One archive is read by one task, front to back. A revisit has no payload of its own.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for path in (p for batch in batches for p in batch["path"]):
            files, inner = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with files.open_input_stream(inner, compression=None) as raw:
                found = records(raw, with_payload)
                while True:
                    try:
                        r = next(found, None)
                    except (ValueError, KeyError, zlib.error) as e:
                        raise ValueError(f"{path}: {e}") from e
                    if r is not None:
                        rows.append(r)
                        size += 500 + len(r[-1] or b"")
                    if rows and (r is None or size > 1 << 24):
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                    if r is None:
                        break

    schema = ("page_id string, url string, record_type string, refers_to string, payload_bytes bigint, "
              "payload_digest string, payload binary")
    each = archives.select("path").repartition(max(1, archives.count()))
    read_back = each.mapInPandas(read, schema)
    return read_back.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive_folder(spark) -> str:
    """A new folder for archives in the shared folder."""
    return scratch_path(spark, "warc")
