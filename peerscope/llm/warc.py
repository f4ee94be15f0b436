"""Operator 6 -- WARC archives: writer, and a sequential reader with digest checks.

Writing: every row becomes one record in one gzip member.  Of rows with equal payloads the one with the largest id is
a ``response``; the others are ``revisit`` records that name it and hold no payload.  The groups are found by the SHA-1
of the payload in a pre-aggregation (largest id per digest) that is joined back, so a payload that a third of all
rows share is combined on the map side and its rows may be split over tasks.

Archives are written by Spark's text source, which runs on any Hadoop file system: a gzip member ends
with the length of the record as four little-endian bytes, so its last byte is 0 for records under 16 MiB and
serves as the line separator (``\\0``).  A longer record is followed by one zero byte, which gzip readers skip as padding.
``records_per_archive`` and ``archive_bytes`` bound a file: pages of up to the latter over the former are written as many a file as
the former says, those up to 8 times as large an eighth as many, and so on, at last one a file.  Each class of sizes that occurs is
a write of its own; where there are several, the digests' table is stored first, so that a payload is hashed twice at most.

Reading: ``binaryFile`` gives each archive; ``WarcReader`` decompresses it in small pieces, frames the block by
Content-Length and checks block and payload digests.  One record's block need not be held.

Edge cases: a null payload is empty; null and odd URLs are left out or percent-encoded; a null id is kept as such and
never the target of a revisit unless all ids of its group are null (then all are responses); rows that
repeat the largest id of their group are all responses; an empty table gives an archive without records and
an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm.common import map_text, ship_package
from peerscope.session import ensure_checkpoint_dir, materialize

MIN_REVISIT_BYTES = 0
RECORDS_PER_ARCHIVE = 2000
ARCHIVE_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PIECE = 1 << 16
CHUNK_BYTES = 2 << 20


class WarcError(ValueError):
    """An archive that breaks the format, or a digest that does not match."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    value = record_id[len("<urn:page:"):-1]
    return None if value == "null" else int(value)


def _uri(url: str) -> str:
    return "".join(chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in url.encode())


def member(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One record as one gzip member."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(text.encode() + block + b"\r\n\r\n") + z.flush()


class WarcReader:
    """Records of one archive, in order.  ``pieces``: the archive's bytes in pieces of any size; each record is a
    dict of its header fields with ``payload_bytes`` and ``payload`` (None unless ``keep``)."""

    def __init__(self, pieces: Iterable[bytes], keep: bool = False):
        self.pieces, self.keep = iter(pieces), keep
        self.raw = b""

    def __iter__(self) -> Iterator[dict]:
        while True:
            self.raw = self.raw.lstrip(b"\0")
            if not self.raw:
                self.raw = next(self.pieces, None)
                if self.raw is None:
                    return
                continue
            yield self._record()

    def _record(self) -> dict:
        z = zlib.decompressobj(31)
        self.out = b""

        def more() -> bool:
            """Decompresses on; False at the member's end."""
            if z.eof:
                return False
            piece = z.unconsumed_tail
            if not piece:
                if not self.raw:
                    self.raw = next(self.pieces, None) or b""
                    if not self.raw:
                        raise WarcError("the archive ends inside a member")
                piece, self.raw = self.raw[:PIECE], self.raw[PIECE:]
            self.out += z.decompress(piece, PIECE)
            if z.eof:
                self.raw = z.unused_data + self.raw
            return True

        fields = self._head(more, b"WARC/1.0")
        left = int(fields["content-length"])
        block, payload = hashlib.sha1(), hashlib.sha1()
        kept: list[bytes] = []
        size, head, in_payload = 0, b"", False
        while left:
            if not self.out and not more():
                raise WarcError("a block is shorter than its Content-Length")
            part, self.out = self.out[:left], self.out[left:]
            left -= len(part)
            block.update(part)
            if not in_payload:
                head += part
                cut = head.find(b"\r\n\r\n")
                if cut < 0:
                    continue
                in_payload, part = True, head[cut + 4:]
                head = head[:cut]
            payload.update(part)
            size += len(part)
            if self.keep:
                kept.append(part)
        while more():
            pass
        if self.out != b"\r\n\r\n":
            raise WarcError("a record must end with two line ends")
        self._check(fields, "warc-block-digest", block)
        if fields["warc-type"] == "revisit":
            stated = [x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            size = int(stated[0])
        else:
            self._check(fields, "warc-payload-digest", payload)
        return {**fields, "payload_bytes": size, "payload": b"".join(kept) if self.keep else None}

    def _head(self, more: Callable[[], bool], first: bytes) -> dict[str, str]:
        while b"\r\n\r\n" not in self.out:
            if not more():
                raise WarcError("a record's head is cut off")
        head, self.out = self.out.split(b"\r\n\r\n", 1)
        lines = head.split(b"\r\n")
        if lines[0] != first:
            raise WarcError(f"not a record: {lines[0][:20]!r}")
        return {k.strip().lower(): v.strip() for k, v in (x.decode().split(":", 1) for x in lines[1:])}

    @staticmethod
    def _check(fields: dict[str, str], name: str, digest) -> None:
        if fields[name] != "sha1:" + base64.b32encode(digest.digest()).decode():
            raise WarcError(f"{name} of {fields['warc-record-id']} does not match")


def _own(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                       F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    return own.withColumn("digest", F.unhex(F.sha1("payload")))


def _groups(own: DataFrame) -> DataFrame:
    """Only what the groups need is read here: the payload is hashed in the scan and not shuffled."""
    return own.groupBy("digest").agg(F.max("page_id").alias("last"))


def _named(own: DataFrame, groups: DataFrame, min_revisit_bytes: int) -> DataFrame:
    both = own.join(groups, "digest")
    revisit = (F.length("payload") >= min_revisit_bytes) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return both.select("page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit"))


def records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """The pages with record_type and refers_to."""
    own = _own(pages, page_id, url, html)
    return _named(own, _groups(own), min_revisit_bytes)


def size_classes(records_per_archive: int = RECORDS_PER_ARCHIVE, archive_bytes: int = ARCHIVE_BYTES) -> list[tuple[int, int]]:
    """(largest payload, records a file) of each class but the last, whose payloads have no bound and a file each."""
    out, most = [], records_per_archive
    while most > 1:
        out.append((archive_bytes // most, most))
        most //= 8
    return out


def write_archives(pages: DataFrame, path: str, records_per_archive: int = RECORDS_PER_ARCHIVE, archive_bytes: int = ARCHIVE_BYTES,
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes one record per row of ``pages`` to gzip archives under ``path``."""
    def step(chunk: pa.RecordBatch) -> dict:
        out = []
        for p, u, b, r, again in zip(*(chunk.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit"))):
            m = member(p, u, b, sha1_base32(b), r, again)
            out.append(m[:-1] if m[-1] == 0 else m)     # the line separator is the last byte, or padding
        return {"value": out}

    classes = size_classes(records_per_archive, archive_bytes)
    size = F.coalesce(F.octet_length(F.col(html)), F.lit(0))
    place = sum((F.when(size > most, 1).otherwise(0) for most, _ in classes), F.lit(0))
    found = sorted(r["place"] for r in pages.select(place.alias("place")).distinct().collect()) or [0]      # a few numbers
    groups = _groups(_own(pages, page_id, url, html))
    if len(found) > 1:
        groups = materialize(groups, "warc_digests")
    for k, number in enumerate(found):
        own = _own(pages if len(found) == 1 else pages.where(place == number), page_id, url, html)
        made = map_text(_named(own, groups, min_revisit_bytes), step, "value binary", column="payload", max_bytes=CHUNK_BYTES)
        (made.select(F.col("value").cast("string").alias("value")).write.mode("append" if k else "errorifexists").option("lineSep", "\0")
         .option("maxRecordsPerFile", classes[number][1] if number < len(classes) else 1).text(path))


READ_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "archive string")


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``; a format error or a wrong digest fails the job."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive"] + ["payload"] * keep_payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * keep_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                view = memoryview(content.as_buffer())
                pieces = (bytes(view[a:a + PIECE]) for a in range(0, len(view), PIECE))
                rows, held = [], 0
                for r in WarcReader(pieces, keep_payload):
                    refers = r.get("warc-refers-to")
                    rows.append((_page_id(r["warc-record-id"]), r.get("warc-target-uri"), r["payload_bytes"],
                                 r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"],
                                 None if refers is None else _page_id(refers), name.as_py(), *[r["payload"]] * keep_payload))
                    held += r["payload_bytes"] if keep_payload else 0
                    if len(rows) >= 5000 or held > CHUNK_BYTES:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                yield _batch(rows, names, kinds)

    return files.mapInArrow(run, READ_SCHEMA + ", payload binary" * keep_payload)


def _batch(rows, names, kinds) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=names)


def round_trip(pages: DataFrame, path: str | None = None, **kw) -> DataFrame:
    """Writes the archives (to a new folder under the checkpoint folder unless ``path`` is given) and reads them back."""
    spark = pages.sparkSession
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/peerscope/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, **kw)
    return read_archives(spark, path)


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, payload_bytes, hex,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((strpos('0123456789abcdef', substr(hex, ((5 * i) // 4 + 1)::INT, 1)) - 1) * 16
        + strpos('0123456789abcdef', substr(hex, ((5 * i) // 4 + 2)::INT, 1)) - 1) // (1 << (3 - (5 * i) % 4)::INT) % 32 + 1)::INT, 1)
      for i in range(32)], '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex) AS last
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d
"""
