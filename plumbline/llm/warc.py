"""Operator 3: WARC archives with deduplicating revisits, and a reader that salvages damaged files.

Writing: each task writes the pages of its partition to one archive, every record a gzip member of
its own. Equal payloads are found by digest before; one record is the response, the others revisit it.

Reading: a record is accepted only after its checks (gzip sums, version line, headers, length, block
and payload digest). After a failed check the reader searches for the next gzip member or version
line, accepts it only if a whole valid record starts there, and logs the bytes between as a
quarantined gap. Of a member with several records the valid ones are accepted, and the member is logged as
a gap as well. A member that is cut off or fails its own sums gives what could be unpacked of it: records
whose length holds and whose block digest is recorded and right. Their bytes belong to the gap, so their own
length is 0. Files are read through a window; one member or plain record is in memory at a time, of any size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import shared_folder, shipped, small, written
from plumbline.llm.shared_files import AtomicFile, open_random

#: Equal payloads of at least this many bytes are revisited.
LEAST_REVISIT = 1000
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_HEADER = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+:")
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Bytes read at once, and fed to the decompressor at once.
WINDOW = 1 << 20
STEP = 1 << 14
#: Archives are read by as many tasks as there are files, up to this; then a task reads several.
MOST_TASKS = 20_000


# ---------------------------------------------------------------- records


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def _sha1(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [*headers, ("WARC-Block-Digest", _sha1(hashlib.sha1(block).hexdigest())), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def page_record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object | None) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` with the same payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    uri = re.sub(r"[\x00-\x20\x7f]+", lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), url or "urn:none")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", _sha1(digest)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if refers_to is None:
        return record(headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    return record(headers, http)


# ---------------------------------------------------------------- salvage reader


class Damaged(Exception):
    """A check that failed; ``data`` is what could be unpacked of a member before it did."""

    def __init__(self, reason: str, data: bytes = b""):
        super().__init__(reason)
        self.data = data


@dataclass
class Found:
    """An accepted record, or a quarantined gap if ``reason`` is set."""

    offset: int
    length: int
    reason: str = ""
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


class Window:
    """Bytes of a file by position, kept in one buffer that moves along."""

    def __init__(self, file):
        self._file, self.size = file, file.size()
        self._start, self._data = 0, b""

    def get(self, at: int, n: int) -> memoryview:
        n = max(0, min(n, self.size - at))
        if at < self._start or at + n > self._start + len(self._data):
            self._data, self._start = self._file.read_at(min(max(n, WINDOW), self.size - at), at), at
        return memoryview(self._data)[at - self._start : at - self._start + n]


def _checked(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that starts at ``at`` of ``data``."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", version.end() - 2)
    if end < 0:
        raise Damaged("headers do not end")
    headers: dict[str, str] = {}
    for line in data[version.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise Damaged("malformed header")
        headers[name.decode().lower()] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isascii() or not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        raise Damaged("missing header")
    size = int(headers["content-length"])
    start, stop = end + 4, end + 4 + size
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    block = bytes(data[start:stop])
    _digest_check(headers.get("warc-block-digest"), block, "block digest")
    if headers["warc-type"] == "response":
        _digest_check(headers.get("warc-payload-digest"), payload_of(block), "payload digest")
    return headers, block, stop + 4


def _digest_check(given: str | None, data: bytes, name: str) -> None:
    if given and given.lower().startswith("sha1:") and given[5:].upper() != _sha1(hashlib.sha1(data).hexdigest())[5:]:
        raise Damaged(f"wrong {name}")


def payload_of(block: bytes) -> bytes:
    """The body behind the HTTP headers."""
    at = block.find(b"\r\n\r\n")
    return block[at + 4 :] if at >= 0 else b""


def _until_error(window: Window, at: int, pos: int) -> bytes:
    """What the piece at ``pos`` still gives before the member at ``at`` fails in it, byte by byte."""
    packer = zlib.decompressobj(31)
    for known in range(at, pos, STEP):
        packer.decompress(window.get(known, STEP))
    out = []
    try:
        for byte in bytes(window.get(pos, STEP)):
            out.append(packer.decompress(bytes([byte])))
    except zlib.error:
        pass
    return b"".join(out)


def _unpacked(window: Window, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at``, its sums checked, and where it ends."""
    packer, out, pos = zlib.decompressobj(31), [], at
    while not packer.eof:
        piece = window.get(pos, STEP)
        if not len(piece):
            raise Damaged("member is cut off", b"".join(out))
        try:
            data = packer.decompress(piece)
        except zlib.error as error:
            out.append(_until_error(window, at, pos))
            raise Damaged("gzip: " + str(error).rpartition(": ")[2], b"".join(out)) from None
        out.append(data)
        pos += len(piece)
    return b"".join(out), pos - len(packer.unused_data)


def _plain_head(window: Window, at: int) -> bytes:
    """Version line and headers at ``at`` with the blank line; read on only as long as lines look like headers."""
    n = STEP
    while True:
        head = bytes(window.get(at, n))
        end = head.find(b"\r\n\r\n")
        if end >= 0:
            return head[: end + 4]
        lines = head.split(b"\r\n")[1:]
        # The last line may be cut off before its colon.
        if len(head) < n or not lines or not all(_HEADER.match(x) for x in lines[:-1]) or not (_HEADER.match(lines[-1]) or len(lines[-1]) < 256):
            raise Damaged("headers do not end")
        n *= 4


def _plain(window: Window, at: int) -> tuple[bytes, int]:
    """The bytes of the uncompressed record at ``at``, as long as its headers say."""
    head = _plain_head(window, at)
    length = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*\r\n", head)
    end = len(head) - 4
    if not length:
        raise Damaged("headers do not end")
    size = end + 4 + int(length[1]) + 4
    if at + size > window.size:
        raise Damaged("record is cut off")
    return bytes(window.get(at, size)), at + size


def _records(data: bytes) -> tuple[list[tuple[dict[str, str], bytes]], Damaged | None]:
    """Headers and blocks of the valid records of ``data``, and the first check that failed."""
    found, pos, damage = [], 0, None
    while pos < len(data):
        try:
            headers, block, pos = _checked(data, pos)
        except Damaged as failed:
            damage = damage or failed
            following = _VERSION_LINE.search(data, pos + 1)
            pos = following.start() if following else len(data)
            continue
        found.append((headers, block))
    return found, damage


def _proved(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Records of a damaged member whose own digest vouches for them."""
    return [(h, block) for h, block in _records(data)[0] if h.get("warc-block-digest", "").lower().startswith("sha1:")]


def _at(window: Window, at: int) -> tuple[list[Found], int]:
    """The valid records of the member or plain record at ``at``, a gap if it has others as well, and where it ends."""
    start = bytes(window.get(at, 16))
    if start.startswith(GZIP):
        data, end = _unpacked(window, at)
    elif _VERSION_LINE.match(start):
        data, end = _plain(window, at)
    else:
        raise Damaged("no member or version line")
    records, damage = _records(data)
    if damage and not records:
        raise damage
    found = [Found(at, end - at, "", headers, block) for headers, block in records]
    return [*found, *([Found(at, end - at, str(damage))] if damage else [])], end


def _next_start(window: Window, at: int) -> int:
    """The next position from ``at`` that looks like a member or a version line; the file's size if none."""
    while at < window.size:
        data = bytes(window.get(at, WINDOW // 4))
        spots = [p for p in (data.find(GZIP), data.find(b"WARC/1.")) if p >= 0]
        if spots:
            return at + min(spots)
        at += max(1, len(data) - 8) if at + len(data) < window.size else len(data)
    return window.size


def salvage(file) -> Iterator[Found]:
    """All valid records of a file in order, and the gaps between them.

    What a damaged member still gives comes before its gap, at the gap's offset and with length 0.
    """
    window = Window(file)
    at, gap, reason = 0, None, ""
    while at < window.size:
        try:
            found, end = _at(window, at)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, str(damage)
            for headers, block in _proved(damage.data):
                yield Found(gap, 0, "", headers, block)
            at = _next_start(window, at + 1)
            continue
        if gap is not None:
            yield Found(gap, at - gap, reason)
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield Found(gap, window.size - gap, reason)


# ---------------------------------------------------------------- Spark jobs

RECORDS = (
    "file string, offset bigint, length bigint, gap string, record_type string, target_uri string, page_id string, "
    "payload_bytes bigint, payload_digest string, refers_to string, record_id string, refers_to_id string, payload binary"
)


def read(files: DataFrame, payloads: bool = False) -> DataFrame:
    """One row for each record and each gap of the archives named in ``files`` (column file).

    A gap has its reason in ``gap`` and NULL in the record's columns. The payload digest is that of
    the bytes read for a response and the recorded one for a revisit. ``payloads`` adds the bytes.
    An empty file has no rows.
    """

    def row(name: str, f: Found) -> tuple:
        if f.reason:
            return (name, f.offset, f.length, f.reason, *[None] * 9)
        kind = f.headers["warc-type"]
        if kind == "response":
            body = payload_of(f.block)
            digest, size = hashlib.sha1(body).hexdigest(), len(body)
        else:
            body, given = None, f.headers.get("warc-payload-digest", "")
            digest = base64.b32decode(given[5:]).hex() if given.startswith("sha1:") else None
            length = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]+)", f.block)
            size = int(length[1]) if length else None
        return (
            name, f.offset, f.length, None, kind, f.headers.get("warc-target-uri"), f.headers.get("x-page-id"),
            size, digest, f.headers.get("x-refers-to-page-id"),
            f.headers.get("warc-record-id"), f.headers.get("warc-refers-to"), body if payloads else None,
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in RECORDS.split(", ")]
        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[c.split(" ")[1]]) for n, c in zip(names, RECORDS.split(", "), strict=True)])

        def packed(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                with open_random(name) as file:
                    for found in salvage(file):
                        held.append(row(name, found))
                        size += len(found.block) if payloads else 256
                        if size >= WINDOW:
                            yield packed(held)
                            held, size = [], 0
                if held:
                    yield packed(held)

    names = files.select("file")
    return names.repartition(min(max(1, names.count()), MOST_TASKS)).mapInArrow(rows, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` of ``read`` with ``response_found``: for revisits, whether the response they name was read too.

    NULL for all other records and gaps; a revisit that names no response is not resolved. Only the ids
    that are named are looked for, each once; revisits of one response may be any share of the rows.
    """
    revisit = F.col("record_type") == "revisit"
    named = records.filter(revisit).select(F.col("refers_to_id").alias("record_id")).distinct()
    found = records.filter("record_type = 'response'").select("record_id").join(named, "record_id", "left_semi").distinct()
    found = written(found.select(F.col("record_id").alias("_found")), "responses")
    fits = small(found, "_found")
    # Without a small right side, revisits of one response are told apart by salts.
    salts = 1 if fits else 32
    right = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = F.broadcast(right) if fits else right
    left = records.withColumn("_key", F.when(revisit, F.col("refers_to_id"))).withColumn("_salt", F.spark_partition_id() % salts)
    joined = left.join(right, (F.col("_key") == F.col("_found")) & (left["_salt"] == right["_salt"]), "left")
    return joined.select(*records.columns, F.when(revisit, F.col("_found").isNotNull()).alias("response_found"))


def with_roles(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): NULL ``refers_to`` for responses.

    Only digests that occur more than once are joined back, so pages are shuffled only if these are many.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    given = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    marks = given.filter(F.octet_length("payload") >= LEAST_REVISIT).select("page_id", F.sha1("payload").alias("digest"))
    repeated = marks.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 and last is not null")
    repeated = written(repeated.select("digest", "last"), "repeated")
    right = F.broadcast(repeated) if small(repeated, "digest") else repeated
    joined = given.withColumn("digest", F.sha1("payload")).join(right, "digest", "left")
    refers = F.when(F.col("last").isNull() | F.col("page_id").eqNullSafe(F.col("last")), F.lit(None)).otherwise(F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder``; returns (file, records, bytes), one row an archive.

    NULL html is an empty payload, a NULL url is recorded as ``urn:none``. Of equal payloads of at
    least ``LEAST_REVISIT`` bytes the rows with the largest page_id are responses and all others
    revisits; rows without page_id revisit too. An empty table writes no file.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, n = None, 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = AtomicFile(folder, f"part-{TaskContext.get().partitionId():06d}.warc.gz")
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", "")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
                    out.write(member(record(info, b"format: WARC File Format 1.1\r\n")))
                out.write(member(page_record(page_id, url, payload, digest, refers_to)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [out.uri], "records": [n], "bytes": [out.size]})

    return written(with_roles(pages).mapInArrow(rows, "file string, records bigint, bytes bigint"), "archives")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in a new shared folder and read the records of pages back.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, file, offset); page ids in their own type.
    """
    kind = pages.schema["page_id"].dataType
    archives = write(pages, shared_folder(pages.sparkSession, "warc"))
    found = read(archives).filter("gap is null and record_type != 'warcinfo'")
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "file", "offset",
    )


def oracle() -> str:
    return f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= {LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to FROM m"""


shipped(__name__)
