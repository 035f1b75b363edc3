"""WARC archives: gzip members written by Spark's own text sink, read back in byte ranges.

Writing. Pages with equal payloads are found by digest; the one with the largest key becomes a response, the others revisit it.
Each record is a gzip member. A task joins members to long rows, and the text sink writes these bytes as they are, with an
empty member as line separator, so an archive is a plain sequence of gzip members in any store that Spark writes to, and a
lost task leaves nothing behind.

Reading. Spark's text source cuts the files into byte ranges and hands each task what lies between places of the three magic
bytes of gzip; a range owns what starts inside it. A task tells members from chance magic bytes: what follows a whole member is
the next one, and at the head of a range a candidate must decode to a WARC header. A member that has chance magic bytes
behind the end of its range is open there. Such rests, and what precedes the first member of a range, are joined in
file order in a second step. The names of archives must not end in .gz, as Spark would not split them.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yieldline.llm.columns import give_back
from yieldline.llm.components import discard, stored

MAGIC = b"\x1f\x8b\x08"
# gzip of nothing, with the header fields of RFC 1952 at 0 and an unknown system
EMPTY_MEMBER = MAGIC + bytes(6) + b"\xff\x03\x00" + bytes(8)
# Bytes of members that are one row of the text sink, unless one alone is longer.
ROW_BYTES = 16 << 20
# A payload that a large share of all pages have is looked up in so many parts.
SALTS = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_PREFIX = "urn:page-id:"
SCAN_SCHEMA = (
    "file string, start long, state string, whole boolean, raw binary, warc_type string, record_id string, "
    "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary, intact boolean"
)
_SCAN_TYPES = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.bool_()]
_SCAN_NAMES = [field.split()[0] for field in SCAN_SCHEMA.split(", ")]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Text for a header line; control characters, which would end it, are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed. A revisit has the HTTP headers of the payload and not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_PREFIX}{'' if key is None else key}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_header_value(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_PREFIX}{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _responses(pages: DataFrame, least: int) -> DataFrame:
    """sha, salt, response: for payloads that several pages have, the largest key among them.

    Counted per payload and salt first, and handed out again per payload and salt, so no payload gathers in one task.
    """
    parts = pages.where(F.col("size") >= least).groupBy("sha", "salt").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    parts = stored(parts, "payload-parts")
    whole = parts.groupBy("sha").agg(F.max("top").alias("response"), F.sum("n").alias("n")).where("n > 1 AND response IS NOT NULL")
    found = stored(parts.select("sha", "salt").join(whole.select("sha", "response"), "sha"), "responses")
    discard(parts)
    return found


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write a record for each page to archives in `folder`, with payload the html in UTF-8 (null: empty).

    Of pages with equal payloads of at least `least` bytes, those with the largest key are responses and the others revisit it;
    smaller payloads are all responses. A page without a key is a revisit where another page with its payload has a key, else
    a response. A page without a url has no target. `date` is each record's date, as the pages have none. Repeated rows have
    a record each. An empty table writes archives without records. Other columns are not read.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("long").alias("size"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    responses = _responses(rows.select("id", "sha", "size", "salt"), least)
    ready = rows.join(responses, ["sha", "salt"], "left")
    other = (F.col("size") >= least) & F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("id"))
    ready = ready.select("id", "url", F.col("payload").cast("binary").alias("payload"), F.when(other, F.col("response")).alias("refers_to"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(member(record(*(c[i].as_py() for c in batch.columns), date)))
                size += len(held[-1])
                if size >= ROW_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
        give_back()

    archives = ready.mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    archives.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(folder)
    discard(responses)


# reading -----------------------------------------------------------------------------------------


def parsed(data: bytes) -> dict | None:
    """The fields of a decoded record; None if it is no WARC record."""
    if not data.startswith(b"WARC/1."):
        return None
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get(b"content-length") or 0)]
    kind, digest = fields.get(b"warc-type"), (fields.get(b"warc-payload-digest") or "").removeprefix("sha1:") or None
    found = {
        "warc_type": kind,
        "record_id": (fields.get(b"warc-record-id") or "").strip("<>") or None,
        "refers_to": (fields.get(b"warc-refers-to") or "").strip("<>") or None,
        "target_uri": fields.get(b"warc-target-uri"),
        "payload_digest": digest,
    }
    if kind in ("response", "revisit") and block.startswith(b"HTTP/"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = [v.strip() for n, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:]) if n.strip().lower() == b"content-length"]
        found["payload_bytes"] = int(length[0]) if length and length[0].isdigit() else None
        if kind == "response":
            found |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": payload_digest(payload)}
            found["intact"] = digest in (None, found["payload_digest"])
    return found


class Range:
    """Members of one byte range. `add` takes what follows each place of the magic bytes, in order."""

    def __init__(self) -> None:
        self.records: list[bytes | None] = []  # decoded; None: a member that cannot be decoded
        self.orphans: list[bytes] = []
        self.open: list[bytes] = []
        self.known = False  # whether a member has been recognised, so that the next one's place is certain
        self._unpack = None
        self._out: list[bytes] = []

    def add(self, piece: bytes) -> None:
        todo = deque([MAGIC + piece])
        while todo:
            piece = todo.popleft()
            if self._unpack is None:
                self._unpack, self._out, self.open = zlib.decompressobj(31), [], []
            self.open.append(piece)
            try:
                self._out.append(self._unpack.decompress(piece))
            except zlib.error:
                failed, self.open, self._unpack = self.open, [], None
                if self.known:
                    # The member is damaged from here on; a next one may begin with this piece.
                    self.records.append(None)
                    todo.extendleft(failed[:0:-1][:1])
                    self.known = False
                else:
                    self.orphans.append(failed[0])
                    todo.extendleft(reversed(failed[1:]))
                continue
            if not self.known and self._recognised():
                self.known = True
            if self._unpack.eof:
                data = b"".join(self._out)
                if self.known:
                    self.records.append(data)
                else:
                    self.orphans += self.open
                self.open, self._unpack = [], None

    def _recognised(self) -> bool:
        start = b"".join(self._out)
        return start.startswith(b"WARC/1.") and b"\r\n\r\n" in start

    def close(self) -> None:
        """The range is over: an open member that is not recognised may belong to the one before."""
        if not self.known:
            self.orphans += self.open
            self.open = []


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in rows], t) for n, t in zip(_SCAN_NAMES, _SCAN_TYPES, strict=True)], names=_SCAN_NAMES
    )


def _records(found: list[bytes | None]) -> list[dict]:
    fields = [{"warc_type": "damaged"} if data is None else parsed(data) for data in found]
    return [f | {"state": "record"} for f in fields if f is not None]


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all byte ranges; for each range what precedes its first member (whole: it has none) and what is open at its end."""
    pieces = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(folder)
    pieces = pieces.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, None
        for batch in batches:
            files, starts = (batch.column(i).to_pylist() for i in range(2))
            out, size = [], 0
            for i in range(batch.num_rows):
                if at != (files[i], starts[i]):
                    out += rests(now, at) if now else []
                    now, at = Range(), (files[i], starts[i])
                    if starts[i] == 0:
                        continue  # what precedes the first magic bytes of a file; nothing in an archive
                now.add(batch.column(2)[i].as_py())
                out += _records(now.records)
                now.records = []
                size += sum(r.get("payload_bytes") or 0 for r in out[-1:])
                if size > 8 << 20:
                    yield _rows(out)
                    out, size = [], 0
            yield _rows(out)
        if now:
            yield _rows(rests(now, at))
        give_back()

    def rests(now: Range, at: tuple[str, int]) -> list[dict]:
        now.close()
        place = {"file": at[0], "start": at[1]}
        head = place | {"state": "head", "raw": b"".join(now.orphans), "whole": not now.known}
        return [head, *([place | {"state": "tail", "raw": b"".join(now.open)}] if now.open else [])]

    return pieces.mapInArrow(scan, SCAN_SCHEMA)


def _rejoined(rests: DataFrame) -> DataFrame:
    """Records whose bytes lie in several ranges: an open member and the heads of the ranges that follow, up to one that has a
    member of its own."""
    order = Window.partitionBy("file").orderBy("start", "state")
    ends = F.when(F.col("state") == "tail", F.col("start")).when(~F.col("whole"), F.lit(-1))
    before = F.last(ends, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    owner = F.when(F.col("state") == "tail", F.col("start")).otherwise(before)
    parts = F.sort_array(F.collect_list(F.struct("start", F.col("state") == "head", "raw")))
    members = rests.withColumn("owner", owner).where("owner >= 0").groupBy("file", "owner").agg(parts["raw"].alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([r for parts in batch.column(0).to_pylist() for r in _records(_decoded(b"".join(parts)))])

    return members.select("parts").mapInArrow(join, SCAN_SCHEMA)


def _decoded(data: bytes) -> list[bytes | None]:
    """The members one after the other; None for one that is cut off or damaged."""
    found: list[bytes | None] = []
    while data.startswith(MAGIC):
        unpack = zlib.decompressobj(31)
        try:
            out = unpack.decompress(data)
        except zlib.error:
            return [*found, None]
        if not unpack.eof:
            return [*found, None]
        found.append(out)
        data = unpack.unused_data
    return found


def read(spark: SparkSession, folder: str) -> DataFrame:
    """warc_type, record_id, refers_to, target_uri, payload_digest, payload_bytes, payload, intact of all records in `folder`.

    Any gzipped WARC files whose names do not end in .gz. A response's payload, digest and length are those of the bytes read;
    intact says whether its header has the same digest. A revisit has no payload; digest and length are its headers'. A member
    that cannot be decoded is a row of type "damaged"; members without a WARC header are passed over. The files are scanned
    once for rests of ranges and once for records, so that payloads are not stored in between.
    """
    scanned = _scanned(spark, folder)
    fields = _SCAN_NAMES[_SCAN_NAMES.index("warc_type") :]
    rests = stored(scanned.where("state <> 'record'").select("file", "start", "state", "whole", "raw"), "rests")
    return scanned.where("state = 'record'").select(*fields).unionByName(_rejoined(rests).select(*fields))


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records that `write` wrote."""

    def page(name: str):
        number = F.substring(F.col(name), len(RECORD_PREFIX) + 1, 20)
        return F.when(F.length(number) > 0, number).cast("long")

    return read(spark, folder).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to")
    )


def checking_sql() -> str:
    """The registered query in DuckDB. Base32 of a digest: the bits of its hexadecimal digits, five at a time."""
    return """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), hashed AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS response,
    list_aggregate(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001',
      '1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', substr(sha1(payload), CAST(i AS INTEGER), 1))]), 'string_agg', '') AS bits
  FROM p
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, CAST(5 * i + j + 1 AS INTEGER), 1) = '1' THEN CAST(pow(2, 4 - j) AS INTEGER) ELSE 0 END))
    AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM hashed
"""
