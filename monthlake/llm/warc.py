"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: payloads are digested; of equal payloads of at least ``MIN_REVISIT`` bytes the one with
the largest id becomes the response and the others revisit it. Each task appends its records to
archives of about ``ARCHIVE_BYTES`` in a shared folder, each under a name of its own attempt; the
manifest of the archives that finished tasks report is what counts, so a repeated task leaves
only files that nobody reads. Reading: Spark's ``binaryFile`` source loads the archives of the
manifest, the dictionary is taken from the leading frame, frames are walked by their block
headers, and each record's version, headers, lengths, end and payload digest are checked.

Only multi-copy payloads' digests are joined to the pages (a written table, so the planner knows
its size); a payload held by a third of all rows is one row of it.

Defined cases: null html is the empty payload; a null url is written as an empty target; rows
equal in id and payload are records each, and of a group all rows with its largest id are
responses; groups of null ids only have no reference and are all responses; payloads of any
length are written whole (a large one is an archive of its own); an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.llm.common import bit_filter, bounded_sample, open_store, ship_code, with_maybe, write_shared
from monthlake.session import scratch_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 32 << 10
DICTIONARY_PAGES = 400  # the dictionary is fitted on at most so many payloads of at most 64 KB
LEVEL = 3
# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """An archive or a record in it breaks the format."""


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the response's HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if " " < c < "\x7f" or c > "\xa0" else f"%{ord(c):02X}" for c in url or "")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode())]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Check a record and return ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] != VERSION:
        raise ArchiveError(f"not a record: {raw[:40]!r}")
    h = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise ArchiveError(f"not a header: {line[:80]!r}")
        h[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"):
        if name not in h:
            raise ArchiveError(f"{name} is missing")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError(f"{h['warc-record-id']}: its block has {len(rest) - 4} bytes, not {h['content-length']}")
    http, sep, payload = rest[:-4].partition(b"\r\n\r\n")
    sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not sep or not http.startswith(b"HTTP/1.1 ") or len(sizes) != 1 or not sizes[0].isdigit():
        raise ArchiveError(f"{h['warc-record-id']}: no HTTP header with a length")
    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:"))
    kind = h["warc-type"]
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"{h['warc-record-id']}: type {kind}")
    if kind == "response" and (len(payload) != int(sizes[0]) or hashlib.sha1(payload).digest() != digest):
        raise ArchiveError(f"{h['warc-record-id']}: its payload is not the one that its headers describe")
    if kind == "revisit" and (payload or "warc-refers-to" not in h):
        raise ArchiveError(f"{h['warc-record-id']}: a revisit has a reference and no payload")
    number = lambda x: None if x == "<urn:page:None>" else int(x.removeprefix("<urn:page:").removesuffix(">"))
    return {"page_id": number(h["warc-record-id"]), "payload_bytes": int(sizes[0]), "payload_digest": digest.hex(),
            "record_type": kind, "refers_to": number(h["warc-refers-to"]) if kind == "revisit" else None}


def frame_end(buf: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and block headers alone."""
    try:
        if struct.unpack_from("<I", buf, at)[0] != FRAME:
            raise ArchiveError(f"no frame at byte {at}")
        flags = buf[at + 4]
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = 0
        while not last:
            block = int.from_bytes(buf[at:at + 3], "little")
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            if kind == 3 or at + 3 > len(buf):
                raise ArchiveError(f"a broken block at byte {at}")
            at += 3 + (1 if kind == 1 else size)
        at += 4 * (flags >> 2 & 1)
    except (struct.error, IndexError) as e:
        raise ArchiveError("the archive ends inside a frame") from e
    if at > len(buf):
        raise ArchiveError("the archive ends inside a frame")
    return at


def read_archive(content: bytes) -> Iterator[dict]:
    """The checked records of one archive, decoded one at a time."""
    buf, at, dictionary = memoryview(content), 0, None
    if len(buf) >= 8 and struct.unpack_from("<I", buf)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", buf, 4)[0]
        if 8 + size > len(buf):
            raise ArchiveError("the archive ends inside its dictionary")
        dictionary, at = zstandard.ZstdCompressionDict(bytes(buf[8:8 + size])), 8 + size
    unpack = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {}))
    while at < len(buf):
        end = frame_end(buf, at)
        try:
            raw = unpack.decompress(buf[at:end])
        except zstandard.ZstdError as e:
            raise ArchiveError(f"the frame at byte {at} can't be decoded: {e}") from e
        yield parse_record(raw)
        at = end


def write_archive_head(dictionary: bytes | None) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""


def fit_dictionary(pages: DataFrame, at_most: int = DICTIONARY_PAGES) -> bytes | None:
    """A dictionary from a bounded sample of payloads; None where they are too few."""
    sample = pages.where(F.octet_length("html").between(1, 1 << 16)).select(F.encode("html", "UTF-8").alias("b"))
    sample = sorted(bounded_sample(sample, F.col("b"), at_most).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r.b) for r in sample]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return None


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page and return the manifest: ``path, records, bytes``."""
    spark = pages.sparkSession
    ship_code(spark)
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    p = pages.select("page_id", "url", payload.alias("payload"))
    key = F.when(F.octet_length("payload") >= MIN_REVISIT, F.sha2("payload", 256))
    # Equal payloads by their SHA-256; groups of one are dropped before the join.
    groups = p.select("page_id", key.alias("k")).where("k IS NOT NULL").groupBy("k").agg(
        F.count("*").alias("n"), F.max("page_id").alias("first")).where("n > 1").select("k", "first")
    groups = write_shared(groups, "warc-groups")
    # Only pages that the groups' bit filter marks are joined; short and single ones never leave their task.
    p = with_maybe(p.withColumn("key", key), bit_filter(groups, F.col("k")), F.col("key"), "maybe")
    copied = F.col("maybe") & F.col("key").isNotNull()
    first = dict(groups.dtypes)["first"]
    p = p.where(copied).join(groups, F.col("key") == F.col("k"), "left").select("page_id", "url", "payload", "first").unionByName(
        p.where(~copied).select("page_id", "url", "payload", F.lit(None).cast(first).alias("first")))
    dictionary = fit_dictionary(pages.select("html"))
    head = write_archive_head(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **({"dict_data": known} if known else {}))
        store, root = open_store(folder)
        out, path, records = None, "", 0

        def manifest() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64()),
                                               pa.array([size], pa.int64())], ["path", "records", "bytes"])

        for b in batches:
            for page_id, url, payload, first in zip(*b.columns, strict=True):
                if out is None:
                    path, records = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                    out.write(head)
                one, of = page_id.as_py(), first.as_py()
                out.write(pack.compress(record(one, url.as_py(), payload.as_py(), of, of is not None and one != of)))
                records += 1
                if out.tell() >= ARCHIVE_BYTES:
                    yield manifest()
                    out = None
        if out is not None:
            yield manifest()

    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    return write_shared(p.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """The records of the archives in a folder (those of a manifest, where one is given)."""
    ship_code(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    if manifest is not None:
        # What repeated tasks have left besides is seldom anything: a table that is small on disk.
        name = F.element_at(F.split("path", "/"), -1)
        stray = files.select("path").join(manifest.select(F.col("path").alias("m_path")), name == F.col("m_path"),
                                          "left_anti")
        files = files.join(write_shared(stray, "warc-stray"), "path", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                rows: list[dict] = []
                try:
                    for r in read_archive(content.as_buffer()):
                        rows.append(r)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows = []
                except ArchiveError as e:
                    raise ArchiveError(f"{path.as_py()}: {e}") from e
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return files.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                                 "refers_to bigint")


SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = os.path.join(scratch_path(pages.sparkSession, "llm-warc"))
    manifest = write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, manifest)
