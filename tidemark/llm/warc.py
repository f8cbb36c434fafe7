"""WARC archives in Zstandard: one frame per record, with the dictionary in the leading skippable frame.

Archives are written by Spark's text writer, so its commit protocol decides which files count and any file system will
do: each row is one frame, and the separator it puts after a row is an empty skippable frame, which readers pass over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.store import stored
from tidemark.session import shared_folder

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: Payload bytes that go into one archive, about.
ARCHIVE_BYTES = 32 << 20
#: Payloads shorter than this are never written as revisits.
REVISIT_BYTES = 1000
DICTIONARY_BYTES = 32 << 10
#: Pages the dictionary is trained from at most (in expectation), and the longest of them.
DICTIONARY_PAGES, DICTIONARY_PAGE_BYTES = 400, 64 << 10
DATE = "2024-01-01T00:00:00Z"

_TEMPLATE = (
    b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:0>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: https://www.\r\n"
    b"Content-Type: application/http;msgtype=response\r\nWARC-Payload-Digest: sha1:\r\nContent-Length: \r\n\r\nHTTP/1.1 200 OK\r\n"
    b"Content-Type: text/html; charset=utf-8\r\nContent-Length: \r\n\r\n<!DOCTYPE html><html><head><title></title></head><body><p></p></body></html>\r\n\r\n"
)


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, whose block has the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    if refers_to is not None:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_urn(refers_to)}"]
    digest = base64.b32encode(sha1).decode()
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    """The page of a record id of :func:`record`; None for ids of other writers."""
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", urn)
    return int(found[1]) if found and -(1 << 63) <= int(found[1]) < 1 << 63 else None


def _sha1(digest: str | None) -> str | None:
    """The hex form of a SHA-1 header in base 32; None for other digests."""
    name, _, value = (digest or "").partition(":")
    if name.lower() != "sha1":
        return None
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def train_dictionary(pages: DataFrame, html_col: str, id_col: str) -> bytes:
    """A dictionary from a bounded sample of the pages; of too few pages, the fixed parts of a record."""
    usable = pages.where(F.octet_length(html_col).between(1, DICTIONARY_PAGE_BYTES))
    n = usable.count()
    few = usable.where(F.pmod(F.xxhash64(id_col, html_col), F.lit(1 << 30)) < int((1 << 30) * DICTIONARY_PAGES / max(n, DICTIONARY_PAGES)))
    samples = sorted(r[0].encode() for r in few.select(html_col).limit(2 * DICTIONARY_PAGES).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [_TEMPLATE + s for s in samples]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return _TEMPLATE


def _frames(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)
        yield pa.RecordBatch.from_arrays([pa.array([dictionary_frame(dictionary)], pa.binary())], ["frame"])
        for batch in batches:
            frames, size = [], 0
            for row in range(batch.num_rows):
                page_id, url, payload, sha1, refers_to = (c[row].as_py() for c in batch.columns)
                frames.append(packer.compress(record(page_id, url, payload, bytes.fromhex(sha1), refers_to)))
                size += len(frames[-1])
                if size > 4 << 20 or row + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
                    frames, size = [], 0

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write one record for each page and return the folder of the archives.

    Of pages with equal payloads of ``REVISIT_BYTES`` or more, that of the largest id is a response and the others
    revisit it; further rows of that same id are responses too. Pages without an id never hold a payload for others: if
    all equal pages lack one, all are responses. A null html is an empty payload, a null or empty url has no header.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).cast("binary").alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    size = F.octet_length("payload")
    total = rows.agg(F.sum(size).alias("n")).first()["n"] or 0
    same = rows.where(size >= REVISIT_BYTES).groupBy("sha1", size.alias("size")).agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    same = stored(same.where("n > 1 AND holder IS NOT NULL").select("sha1", "size", "holder"), "equal-payloads")
    joined = rows.withColumn("size", size).join(same, ["sha1", "size"], "left")
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("holder")), None).otherwise(F.col("holder"))
    records = joined.select("page_id", "url", "payload", "sha1", refers_to.alias("refers_to"))
    dictionary = train_dictionary(pages.select(id_col, html_col), html_col, id_col)
    frames = records.repartition(max(1, -(-total // ARCHIVE_BYTES))).mapInArrow(_frames(dictionary), "frame binary")
    folder = shared_folder(pages.sparkSession, "warc")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", SEPARATOR).text(folder)
    return folder


@dataclass
class Parsed:
    """A record, or what is wrong with it."""

    offset: int
    headers: dict[str, str]
    payload: bytes | None = None
    payload_bytes: int | None = None
    error: str | None = None


def frame_size(data: memoryview) -> int:
    """Compressed bytes of the frame that ``data`` starts with."""
    at = zstandard.frame_header_size(data)
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("the frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 * zstandard.get_frame_parameters(data).has_checksum
    if at > len(data):
        raise ValueError("the frame is cut off")
    return at


def read_archive(content: bytes) -> Iterator[Parsed]:
    """All records of one archive. A bad record is reported and the next frame read; a bad frame ends the archive."""
    data, at, unpacker = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            if len(data) - at < 8:
                raise ValueError("the frame is cut off")
            magic, size = struct.unpack_from("<II", data, at)
            if magic in SKIPPABLE_MAGICS:
                if at + 8 + size > len(data):
                    raise ValueError("the frame is cut off")
                if magic == DICTIONARY_MAGIC and at == 0:
                    own = bytes(data[8 : 8 + size])
                    own = zstandard.ZstdDecompressor().decompress(own) if own[:4] == FRAME_MAGIC else own
                    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own))
                at += 8 + size
                continue
            size = frame_size(data[at:])
            text = unpacker.decompress(data[at : at + size])
        except (ValueError, zstandard.ZstdError) as wrong:
            yield Parsed(at, {}, error=str(wrong))
            return
        yield _parse(at, text)
        at += size


def _parse(offset: int, text: bytes) -> Parsed:
    head, _, rest = text.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    out = Parsed(offset, headers)
    length = headers.get("content-length", "")
    if version not in ("WARC/1.0", "WARC/1.1"):
        out.error = "the version line is wrong"
    elif missing := [h for h in REQUIRED if h not in headers]:
        out.error = f"no {missing[0]} header"
    elif not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        out.error = "the block does not have the length in its header"
    else:
        _parse_block(out, rest[:-4])
    return out


def _parse_block(out: Parsed, block: bytes) -> None:
    """The payload: what follows the HTTP header, or the whole block of records that are not HTTP."""
    kind = out.headers["warc-type"]
    if kind not in ("response", "revisit") or "application/http" not in out.headers.get("content-type", "application/http").lower():
        out.payload, out.payload_bytes = block, len(block)
    else:
        http, _, payload = block.partition(b"\r\n\r\n")
        lengths = [v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
        told = int(lengths[0]) if lengths and re.fullmatch(rb"[0-9]{1,18}", lengths[0]) else None
        if lengths and told is None:
            out.error = "the HTTP header's length is not a number"
        if kind == "revisit":
            out.payload_bytes = told
            return
        out.payload, out.payload_bytes = payload, len(payload)
        if told is not None and told != len(payload):
            out.payload_bytes, out.error = told, "the payload does not have the length in its HTTP header"
    digest = _sha1(out.headers.get("warc-payload-digest"))
    if out.error is None and digest is not None and digest != hashlib.sha1(out.payload).hexdigest():
        out.error = "the payload does not have the digest in its header"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["archive", "offset", "record_type", "page_id", "refers_to", "url", "payload", "payload_bytes", "payload_digest", "error"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows, size = [], 0
            for r in read_archive(content.as_py()):
                digest = _sha1(r.headers.get("warc-payload-digest"))
                ids = _page(r.headers.get("warc-record-id", "")), _page(r.headers.get("warc-refers-to", ""))
                rows.append((path.as_py(), r.offset, r.headers.get("warc-type"), *ids, r.headers.get("warc-target-uri"), r.payload, r.payload_bytes, digest, r.error))
                size += len(r.payload or b"")
                if size > 4 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: ``archive, offset, record_type, page_id, refers_to, url, payload, payload_bytes,
    payload_digest`` (hex SHA-1) and ``error``, which says what a record fails, null if it is sound.

    Archives of other writers are read as well. Ids that are not those of :func:`record`, digests other than SHA-1 and
    headers that are missing give null fields; a response need not tell its HTTP length. Records that are not HTTP have
    their whole block as payload. An archive whose frames break off gives its records up to there and one with an error;
    an empty archive gives none. Records are held one at a time, whatever the size of the archive's payloads.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    schema = (
        "archive string, offset long, record_type string, page_id long, refers_to long, url string, payload binary, "
        "payload_bytes long, payload_digest string, error string"
    )
    return files.mapInArrow(_read, schema)
