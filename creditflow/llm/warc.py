"""Write web archives and read them back, one gzip member per record.

Pages with equal payloads of some size are written once: the page with the largest id is a response, the others are
revisits that refer to it. Tasks write archive files into a shared folder under names of their own; only files of
tasks that succeeded are listed, so a repeated task leaves no record twice. The reader goes through a file in
order with a small buffer: it inflates member by member, frames each block by its content length and checks the
length, both digests and the end of the record. Any mismatch raises ``WarcError``.

Null html counts as an empty payload; a null page id is written as an empty id and read back as null. Rows that
repeat page id and payload are alike: all responses or all revisits. An empty table gives no archive and an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage, staging_root

# Payloads of fewer bytes are always written in full.
LEAST_REVISIT_BYTES = 1000
# A task begins a new file after so many compressed bytes.
FILE_BYTES = 64 << 20
READ_BYTES = 64 << 10
COMPRESSION_LEVEL = 1
MOST_HEADER_BYTES = 1 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
WARC_DATE = "2024-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"

RECORDS = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long"


class WarcError(ValueError):
    """An archive that is not as the format asks."""


def record_id(page_id: int | None) -> str:
    return f"<{ID_PREFIX}{'' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    if identifier is None:
        return None
    number = identifier.strip("<>").removeprefix(ID_PREFIX)
    return int(number) if number else None


def sha1(data: bytes) -> str:
    return f"sha1:{hashlib.sha1(data).hexdigest()}"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """A record as one gzip member. A revisit has the digest of its payload and no block."""
    block = b"" if is_revisit else HTTP_HEAD + payload
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", WARC_DATE),
        ("WARC-Payload-Digest", sha1(payload)),
        ("WARC-Block-Digest", sha1(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%")))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    packer = zlib.compressobj(COMPRESSION_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(stream) -> Iterator[bytearray]:
    """The inflated content of each gzip member of ``stream``, in order; a member that is only begun is an error."""
    inflater, content, data, is_begun = zlib.decompressobj(31), bytearray(), b"", False
    while data or (data := stream.read(READ_BYTES)):
        is_begun = True
        try:
            content += inflater.decompress(data)
        except zlib.error as error:
            raise WarcError(f"damaged gzip member: {error}") from error
        data = b""
        if inflater.eof:
            yield content
            data = inflater.unused_data
            inflater, content, is_begun = zlib.decompressobj(31), bytearray(), False
        elif len(content) > MOST_HEADER_BYTES and not content.startswith(VERSION):
            raise WarcError("no record at the start of a member")
    if is_begun:
        raise WarcError("the archive ends inside a record")


def parse(content: bytearray) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record, both digests verified."""
    head, gap, _ = content.partition(b"\r\n\r\n")
    lines = bytes(head).split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError(f"no {VERSION.decode()} header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise WarcError(f"malformed header line: {line!r}")
        fields[name.strip().lower()] = value.strip()
    begin = len(head) + len(gap)
    try:
        end = begin + int(fields["content-length"])
    except (KeyError, ValueError) as error:
        raise WarcError("no valid content length") from error
    if len(content) != end + 4 or content[end:] != b"\r\n\r\n":
        raise WarcError(f"the block is not {end - begin} bytes long")
    block = bytes(content[begin:end])
    if fields.get("warc-block-digest") != sha1(block):
        raise WarcError("the block does not have its digest")
    if fields.get("warc-type") == "response" and fields.get("warc-payload-digest") != sha1(payload_of(block)):
        raise WarcError("the payload does not have its digest")
    return fields, block


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def open_at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def mark_revisits(pages: DataFrame, id_column: str, html_column: str, url_column: str) -> DataFrame:
    """``page_id, url, payload`` of every page, with ``keep_id`` where it is to be a revisit of that page.

    Which pages are revisits is decided on ids and digests alone. Payloads only move where a page may be one, found by
    a filter, and are then dealt by page, so that a payload that very many pages have is not brought together.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    # sha1 stands for the payload in the archive itself; small payloads have no entry and stay whole
    large = stage(rows.where(F.octet_length("payload") >= LEAST_REVISIT_BYTES).select("page_id", "digest"), "page-digests")
    repeated = large.groupBy("digest").agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n"))
    # staged, so that both sides of the join are shuffled and adaptive execution may split a digest of very many pages
    repeated = stage(repeated.where("n > 1 AND keep_id IS NOT NULL").select(F.col("digest").alias("of_digest"), "keep_id"), "page-groups")
    others = large.join(repeated, F.col("digest") == F.col("of_digest")).where("NOT page_id <=> keep_id")
    revisits = stage(others.select(F.col("page_id").alias("of_page"), "of_digest", "keep_id").distinct(), "page-revisits")
    flagged = common.with_membership(rows, revisits.select(F.col("of_page").alias("page_id"), F.col("of_digest").alias("digest")), "page_id", "digest")
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("digest") == F.col("of_digest"))
    found = flagged.where("may_be_in").join(revisits, same, "left").select("page_id", "url", "payload", "keep_id")
    plain = flagged.where("NOT may_be_in").select("page_id", "url", "payload", F.lit(None).cast("long").alias("keep_id"))
    return plain.unionByName(found)


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", html_column: str = "html", url_column: str = "url") -> DataFrame:
    """Write all pages into ``folder`` (shared by driver and executors); returns the list of files, ``path, records``."""

    def write(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        system, base = open_at(folder)
        stream, path, size, records, listed = None, "", 0, 0, []
        for batch in batches:
            for page_id, url, payload, keep_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    path, size, records = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = system.open_output_stream(f"{base}/{path}", compression=None)
                packed = member(page_id, url, payload, keep_id, keep_id is not None)
                stream.write(packed)
                size, records = size + len(packed), records + 1
                if size >= FILE_BYTES:
                    stream.close()
                    stream = None
                    listed.append((f"{folder}/{path}", records))
        if stream is not None:
            stream.close()
            listed.append((f"{folder}/{path}", records))
        yield pa.RecordBatch.from_pydict({"path": [x for x, _ in listed], "records": pa.array([n for _, n in listed], pa.int64())}, schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

    system, base = open_at(folder)
    system.create_dir(base, recursive=True)
    return stage(mark_revisits(pages, id_column, html_column, url_column).mapInArrow(write, "path string, records long"), "archive-list")


def read_archives(files: DataFrame) -> DataFrame:
    """One row per record of the listed files, see ``RECORDS``; a file must have as many records as were listed."""

    def read(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        names = [f.strip().split()[0] for f in RECORDS.split(",")]
        schema = pa.schema([(n, pa.string() if n in ("record_type", "payload_digest") else pa.int64()) for n in names])
        for batch in batches:
            for uri, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, path = open_at(uri)
                rows, found = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for fields, block in map(parse, members(stream)):
                        kind = fields["warc-type"]
                        rows.append((
                            page_of(fields["warc-record-id"]), kind, page_of(fields.get("warc-refers-to")),
                            fields["warc-payload-digest"].removeprefix("sha1:"), None if kind == "revisit" else len(payload_of(block)),
                        ))
                        found += 1
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                if found != listed:
                    raise WarcError(f"{uri} has {found} records, not {listed}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    # dealt in turn, one file a task
    return files.select("path", "records").repartition(max(1, files.count())).mapInArrow(read, RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload size of each revisit taken from the response it refers to."""
    responses = records.where("record_type = 'response'").select(
        F.col("page_id").alias("of_page"), F.col("payload_digest").alias("of_digest"), F.col("payload_bytes").alias("of_bytes")
    ).distinct()
    meant = (F.col("refers_to") == F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(responses, meant, "left")
    revisits = revisits.withColumnRenamed("of_bytes", "payload_bytes").select(records.columns)
    return records.where("record_type = 'response'").unionByName(revisits)


def round_trip(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", url_column: str = "url") -> DataFrame:
    """Write all pages as archives under the shared folder and return what the archives hold."""
    folder = f"{staging_root(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    files = write_archives(pages, folder, id_column, html_column, url_column)
    return resolve_revisits(stage(read_archives(files), "archive-records"))
