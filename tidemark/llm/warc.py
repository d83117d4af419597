"""WARC archives: one gzip member per record, written by tasks and read back in sequence.

Written records have all fields that the format demands; the ids of pages stand in fields of their
own. The reader takes archives of any writer: digests are checked by the algorithm and encoding they
name, and only blocks that are HTTP messages are taken apart.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept

SMALLEST_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 18
LINE = b"\r\n"
# Names and profile of the WARC 1.1 format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPES = ("request", "response", "revisit")
PAGE_ID, REFERS_TO = "X-Page-ID", "X-Refers-To-Page-ID"
ALGORITHMS = ("md5", "sha1", "sha256", "sha384", "sha512")
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, path string, problem string"
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def revisits(pages: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """``(page_id, digest, refers_to, refers_url)`` of the rows whose payload a smaller page_id already has.

    Works on digests: first pages are found by a combined minimum, then joined back.
    """
    keyed = pages.select("page_id", "digest", "url").where(F.octet_length("payload") >= smallest)
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    first = keyed.groupBy("digest").agg(F.min(named).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = first.select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"))
    return keyed.drop("url").join(shared, "digest").where("page_id <> refers_to").distinct()


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)``; returns the stored manifest.

    The payload is the html in UTF-8, nothing for a null. Rows with equal payloads of at least
    100 bytes are revisits of the one with the smallest page_id; a null page_id is never one.
    Every attempt of a task writes new file names and the manifest names those of the attempt
    that ended, so a repeated or lost task leaves unnamed files only. An archive is closed when
    it passes ``archive_bytes``. Other columns are ignored.
    """
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    text = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    text = text.withColumn("digest", F.sha2("payload", 256))
    todo = text.join(revisits(text), ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, name, done, size = None, "", 0, 0
        closed: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in COLUMNS), strict=True):
                if out is None:
                    name, done, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                member = gzip_member(record(*(v.as_py() for v in row), date=date))
                out.write(member)
                done, size = done + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    closed.append((name, done, size))
                    out = None
        if out is not None:
            out.close()
            closed.append((name, done, size))
        if closed:
            names, counts, sizes = zip(*closed, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n in names]), pa.array(counts), pa.array(sizes)],
                names=["path", "records", "bytes"],
            )

    return kept(todo.select(*COLUMNS).mapInArrow(run, MANIFEST))


COLUMNS = ("page_id", "url", "payload", "digest", "refers_to", "refers_url")


def record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    refers_to: int | None,
    refers_url: str | None = None,
    date: str = "1970-01-01T00:00:00Z",
) -> bytes:
    """The bytes of one record before compression; its record id is new at every call.

    A revisit names the record it refers to by the digest, the address and the date, as ids of
    records that other tasks write are not known, and the id of its page.
    """
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": uuid.uuid4().urn.join("<>"),
        "WARC-Date": date,
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        head[PAGE_ID] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To-Date": date, REFERS_TO: str(refers_to)}
        head["WARC-Refers-To-Target-URI"] = " ".join((refers_url or "").split())
    lines = [VERSION, *(f"{k}: {v}" for k, v in head.items())]
    return "\r\n".join(lines).encode("utf-8", "replace") + LINE * 2 + block + LINE * 2


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    head: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    payload_bytes: int = 0
    payload_digest: str = ""
    problem: str | None = None


class _Members:
    """Decompressed bytes of a gzip file, member by member, a chunk at a time."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.buffer = stream, b"", bytearray()
        self.member: zlib._Decompress | None = None

    def next_member(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        if not self.raw:
            return False
        self.member, self.buffer = zlib.decompressobj(31), bytearray()
        return True

    def fill(self) -> bool:
        """Decompress some more of the current member; False at its end."""
        while not self.member.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise EOFError("the archive ends inside a member")
            more = self.member.decompress(self.raw, CHUNK)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            self.buffer += more
            if more:
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if seen > most:
                raise ValueError("a header is too long")
            if not self.fill():
                raise ValueError("a header does not end")
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n > 0:
            if not self.buffer and not self.fill():
                raise ValueError("a block is shorter than its Content-Length")
            part = bytes(self.buffer[:n])
            del self.buffer[: len(part)]
            n -= len(part)
            yield part


def _fields(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def records(stream: BinaryIO, keep_payload: bool = True) -> Iterator[Record]:
    """Read records in sequence with bounded memory; a damaged one carries its problem.

    After damage inside a member reading goes on with the next member; where the compressed
    stream itself is broken, the last record says so and reading ends.
    """
    members = _Members(stream)
    while True:
        rec = Record({})
        try:
            if not members.next_member():
                return
            first, *rest = members.until(LINE * 2).decode("utf-8", "replace").split("\r\n")
            rec.head = _fields(rest)
            if not first.startswith("WARC/"):
                raise ValueError("no WARC version line")
            _read_block(members, rec, keep_payload)
            tail = b"".join(members.exactly(4))
            if tail != LINE * 2 or members.buffer or members.fill():
                raise ValueError("the record does not end with its member")
        except ValueError as error:
            rec.problem = str(error)
            try:
                while members.fill():
                    members.buffer.clear()
            except (zlib.error, EOFError) as broken:
                rec.problem = f"{rec.problem}; {broken}"
                yield rec
                return
        except (zlib.error, EOFError) as error:
            rec.problem = str(error)
            yield rec
            return
        yield rec


def _read_block(members: _Members, rec: Record, keep_payload: bool) -> None:
    length = int(rec.head.get("content-length", "-1"))
    if length < 0:
        raise ValueError("no Content-Length")
    kind = rec.head.get("warc-type", "")
    content = rec.head.get("content-type", "")
    in_body = not (content.startswith("application/http") or not content and kind in HTTP_TYPES)
    told = {c: _Digest(rec.head.get(f"warc-{c}-digest")) for c in ("block", "payload")}
    digest, head, body = hashlib.sha256(), bytearray(), bytearray()
    for part in members.exactly(length):
        told["block"].update(part)
        if not in_body:
            head += part
            at = head.find(LINE * 2)
            if at < 0:
                continue
            in_body, part = True, bytes(head[at + 4 :])
            del head[at:]
        digest.update(part)
        told["payload"].update(part)
        rec.payload_bytes += len(part)
        if keep_payload:
            body += part
    rec.http = _fields(head.decode("utf-8", "replace").split("\r\n")[1:])
    if not told["block"].holds():
        raise ValueError("the block differs from its digest")
    if kind == "revisit":  # the payload stands in the record referred to
        said = rec.http.get("content-length", "")
        rec.payload_bytes, rec.payload_digest = int(said) if said.isdigit() else 0, told["payload"].plain()
        return
    rec.payload_digest = digest.hexdigest()
    rec.payload = bytes(body) if keep_payload else None
    if not told["payload"].holds():
        raise ValueError("the payload differs from its digest")


class _Digest:
    """A labelled digest as records have it, in base 16 or 32, and that of the bytes seen.

    One with an unknown label, or of a length that fits neither base, cannot be checked and holds.
    """

    def __init__(self, said: str | None):
        self.said = said or ""
        label, _, value = self.said.partition(":")
        name = label.strip().lower().replace("-", "")
        self.sum = hashlib.new(name, usedforsecurity=False) if name in ALGORITHMS else None
        self.expected = self._decoded(value.strip()) if self.sum else None

    def _decoded(self, value: str) -> bytes | None:
        size = self.sum.digest_size
        try:
            if len(value) == 2 * size:
                return bytes.fromhex(value)
            found = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
            return found if len(found) == size else None
        except ValueError:
            return None

    def update(self, data: bytes) -> None:
        if self.expected is not None:
            self.sum.update(data)

    def holds(self) -> bool:
        return self.expected is None or self.sum.digest() == self.expected

    def plain(self) -> str:
        """The digest in bare hexadecimal if it is a SHA-256, else as it stands."""
        return self.expected.hex() if self.expected is not None and self.sum.name == "sha256" else self.said


def read(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """One row per record of the archives that ``archives(path)`` names, each read by one task.

    A record that fails framing or a digest has its ``problem``; others have null there. A
    revisit has the size and digest of the payload it refers to and no payload of its own; a digest
    that is no SHA-256 stays as it stands there. Records of other writers have no page ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = _open(path)
                with fs.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for rec in records(stream, keep_payload):
                        rows.append(_row(rec, path))
                        size += len(rec.payload or b"") + 500
                        if size > 8 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    return archives.select("path").mapInArrow(run, RECORDS)


_KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string()]
_NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def _page(name: str | None) -> int | None:
    digits = (name or "").strip()
    return int(digits) if digits.removeprefix("-").isdecimal() else None


def _row(rec: Record, path: str) -> tuple:
    head = rec.head
    return (
        _page(head.get(PAGE_ID.lower())),
        head.get("warc-target-uri"),
        head.get("warc-type"),
        _page(head.get(REFERS_TO.lower())),
        rec.payload_bytes,
        rec.payload_digest,
        rec.payload,
        path,
        rec.problem,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)
