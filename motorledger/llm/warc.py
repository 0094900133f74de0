"""Web archives: records written as single gzip members, read back by a reader that salvages.

Writing is an ordinary Spark job with Spark's commit of files. Every record is one gzip member, as
archive tools expect. Members are written by the text writer, whose line end is the zero byte: the
last byte of a member is the highest of its length, zero below 16 MiB; longer records are followed
by an empty member, which ends in zeros.

The reader checks every record: the member's checksum, version line, length, the closing line ends,
the fields that every record has and the digests of block and payload. After a failed check it goes on at the place where the record
said it ends, if a valid record or the end of the file is there, or else at the next member or
version line that passes all checks. The bytes between are reported as a gap with the reason, so
records and gaps cover a file without overlap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorledger.llm.common import prepared
from motorledger.session import shared_folder

#: Equal payloads of at least so many bytes are stored once.
LEAST_REVISIT_BYTES = 100
#: Records of one archive file; a file is read back by one task.
RECORDS_PER_FILE = 10_000
#: A member that inflates to more is refused, so that a damaged or hostile one cannot fill the memory.
MOST_RECORD_BYTES = 1 << 30
_HEAD_BYTES = 1 << 16
_CHUNK = 1 << 16
_OUT_BYTES = 8 << 20
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")
_VERSION = re.compile(rb"WARC/\d+\.\d+")
_NEEDED = ("warc-type", "warc-record-id", "warc-date")
#: An empty gzip member: no data, checksum and length zero.
_NOTHING = _MAGIC + b"\0\0\0\0\0\0\xff\x03\0" + bytes(8)
_FOUND = (
    "path string, start long, length long, kind string, reason string, type string, record_id string, refers_to string, "
    "uri string, date string, payload_digest string, payload_bytes long, payload binary"
)


def _member(data: bytes) -> bytes:
    """One gzip member without time, so that equal records are equal bytes; its last byte is zero."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return _MAGIC + b"\0\0\0\0\0\0\xff" + body + tail + (_NOTHING if tail[-1] else b"")


def _line(name: str, value: bytes) -> bytes:
    """A header line; bytes that would break it are percent-encoded."""
    return name.encode() + b": " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], value) + b"\r\n"


def record(kind: str, name: bytes, uri: bytes | None, date: str, size: int, digest: str, payload: bytes | None, refers_to: bytes | None) -> bytes:
    """One record with an HTTP answer as block; a revisit holds the answer's head only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if refers_to is None:
        block += payload or b""
    head = b"WARC/1.1\r\nWARC-Type: " + kind.encode() + b"\r\n" + _line("WARC-Record-ID", name) + _line("WARC-Date", date.encode())
    if uri is not None:
        head += _line("WARC-Target-URI", uri)
    if refers_to is not None:
        head += _line("WARC-Refers-To", refers_to) + _line("WARC-Profile", _PROFILE)
    head += _line("WARC-Payload-Digest", b"sha256:" + digest.encode())
    head += _line("WARC-Block-Digest", b"sha256:" + hashlib.sha256(block).hexdigest().encode())
    head += b"Content-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
    return head + block + b"\r\n\r\n"


def _named(key: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if key is None else b"%d" % key)


def _writer(date: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, uri, payload, size, digest, first in zip(*[c.to_pylist() for c in batch.columns]):
                kind, refers = ("response", None) if first is None else ("revisit", _named(first))
                out.append(_member(record(kind, _named(key), uri, date, size, digest, payload, refers))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    return run


def write_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT_BYTES,
    per_file: int = RECORDS_PER_FILE, date: str = "1970-01-01T00:00:00Z", path: str | None = None,
) -> str:
    """Write a record per row and return the folder of the archive files.

    A null payload is empty. Of rows with equal payloads of ``least`` bytes or more, those with the
    least ``key`` become responses and the others revisits that refer to it; all others are responses.
    Rows that repeat the least key are responses each. A null key is no least key, so its row refers to
    the least one, and is a response where all keys of its payload are null. A null url has no header.
    Other columns are ignored; an empty table gives a folder without records.
    """
    spark = prepared(pages.sparkSession)
    path = path or shared_folder(spark, "archives")
    data = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").cast("binary").alias("uri"), data.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    groups = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    first = groups.filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    again = F.when(F.col("key").isNull() | (F.col("key") > F.col("first")), F.col("first"))
    joined = rows.join(first, "digest", "left").withColumn("again", again)
    made = joined.select("key", "uri", F.when(F.col("again").isNull(), F.col("payload")).alias("payload"), "size", "digest", "again")
    members = made.mapInArrow(_writer(date), "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", per_file).text(path)
    return path


@dataclass
class Found:
    """A record, or a gap with its ``reason``, at bytes ``start`` to ``end`` of a file."""

    start: int
    end: int
    reason: str | None = None
    fields: dict[str, str] | None = None
    payload: bytes = b""
    payload_bytes: int | None = None
    digest: str | None = None


def _digest_fits(said: str | None, data: bytes) -> bool:
    """Whether a digest header fits; other algorithms than those written here and SHA-1 are taken on trust."""
    name, _, value = (said or "").partition(":")
    if name.lower() == "sha256":
        return value.lower() == hashlib.sha256(data).hexdigest()
    if name.lower() == "sha1":
        real = hashlib.sha1(data).digest()
        return value.upper() == base64.b32encode(real).decode() or value.lower() == real.hex()
    return True


def _parsed(data: bytes, at: int) -> Found:
    """The record that starts at ``at``. A reason says that it failed; ``end`` is then where it claims to end."""
    close = data.find(b"\r\n\r\n", at, at + _HEAD_BYTES)
    if close < 0:
        return Found(at, at, "no end of the header")
    version, *lines = data[at:close].split(b"\r\n")
    if not _VERSION.fullmatch(version):
        return Found(at, at, "no version line")
    fields: dict[str, str] = {}
    last = ""
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if line[:1] in (b" ", b"\t") and last:
            fields[last] += " " + line.decode("utf-8", "replace").strip()
        elif not colon:
            return Found(at, at, "broken header line")
        else:
            last = name.strip().lower()
            if last in fields and last != "warc-concurrent-to":
                return Found(at, at, "a field twice")  # two headers run into each other
            fields[last] = value.strip()
    if not re.fullmatch(r"[0-9]{1,15}", fields.get("content-length", "")):
        return Found(at, at, "no length")
    stop = close + 4 + int(fields["content-length"])
    if stop + 4 > len(data):
        return Found(at, at, "cut off")
    if data[stop : stop + 4] != b"\r\n\r\n":
        return Found(at, at, "wrong length")
    end = stop + 4
    block = data[close + 4 : stop]
    if any(name not in fields for name in _NEEDED):
        return Found(at, end, "a field that every record has is missing")
    if not _digest_fits(fields.get("warc-block-digest"), block):
        return Found(at, end, "block digest differs")
    payload, size = block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        said = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,15})[ \t]*\r?$", head)
        if fields.get("warc-type") == "revisit" and said:
            size = int(said[1])
    digest = fields.get("warc-payload-digest")
    if fields.get("warc-type") != "revisit":
        if not _digest_fits(digest, payload):
            return Found(at, end, "payload digest differs")
        digest = digest or "sha256:" + hashlib.sha256(payload).hexdigest()
    return Found(at, end, None, fields, payload, size, digest)


def _inflated(data: bytes, at: int) -> tuple[bytes, int] | str:
    """The content and end of the member at ``at``, or what is wrong with it."""
    view, unpacker, out, size, place = memoryview(data), zlib.decompressobj(31), [], 0, at
    try:
        while not unpacker.eof:
            if place >= len(data):
                return "member cut off"
            out.append(unpacker.decompress(view[place : place + _CHUNK]))
            size += len(out[-1])
            place = min(place + _CHUNK, len(data))
            if size > MOST_RECORD_BYTES:
                return "member too long"
    except zlib.error:
        return "member damaged"
    return b"".join(out), place - len(unpacker.unused_data)


def _read_at(data: bytes, at: int) -> Found | None:
    """What stands at ``at``; an empty member is a record without fields."""
    if data.startswith(_MAGIC, at):
        got = _inflated(data, at)
        if isinstance(got, str):
            return Found(at, at, got)
        inner, end = got
        if not inner:
            return Found(at, end)
        found = _parsed(inner, 0)
        if found.reason is None and found.end != len(inner):
            found.reason = "more than a record in a member"
        found.start, found.end = at, end
        return found
    if data.startswith(b"WARC/", at):
        return _parsed(data, at)
    return Found(at, at, "no member or version line")


def salvaged(data: bytes) -> Iterator[Found]:
    """All records of one file in order, and a gap for each stretch of bytes that no valid record covers."""
    at, ready = 0, None
    while at < len(data):
        found = ready or _read_at(data, at)
        ready = None
        if found.reason is None:
            if found.fields is not None:
                yield found
            at = found.end
            continue
        after = len(data)
        if found.end > at and (found.end == len(data) or (ready := _valid(data, found.end))):
            after = found.end
        else:
            for spot in _NEXT.finditer(data, at + 1):
                if ready := _valid(data, spot.start()):
                    after = ready.start
                    break
        yield Found(at, after, found.reason)
        at = after


def _valid(data: bytes, at: int) -> Found | None:
    found = _read_at(data, at)
    return found if found.reason is None else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 8, pa.int64(), pa.binary()]
    names = [part.split()[0] for part in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


def _reader(with_payload: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for x in salvaged(content.as_py()):
                    f = x.fields or {}
                    held.append(
                        (path.as_py(), x.start, x.end - x.start, "record" if x.reason is None else "gap", x.reason, f.get("warc-type"),
                         f.get("warc-record-id"), f.get("warc-refers-to"), f.get("warc-target-uri"), f.get("warc-date"), x.digest,
                         x.payload_bytes, x.payload if with_payload and x.reason is None and f.get("warc-type") != "revisit" else None)
                    )
                    size += 500 + (len(x.payload) if with_payload else 0)
                    if size > _OUT_BYTES:
                        yield _batch(held)
                        held, size = [], 0
        if held:
            yield _batch(held)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record and per gap of all files below ``path``: compressed by member or plain.

    ``path``, ``start`` and ``length`` say where; ``kind`` is ``record`` or ``gap`` with its ``reason``.
    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for revisits as they say;
    revisits and gaps have a null ``payload``, an empty payload is empty. Records that occur twice are two
    rows; an empty file has no rows. A task holds one file at a time.
    """
    files = prepared(spark).read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_reader(with_payload), _FOUND)


def page_of(name: Column) -> Column:
    """The key in a record name that :func:`write_archives` gave; null for any other name."""
    return F.regexp_extract(name, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
