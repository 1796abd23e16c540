"""WARC archives: written with one gzip member per record, read sequentially.

Tasks write archives straight into a shared folder, over the file system that
its address names, and return a manifest. Reading goes over the manifest: a
task walks through an archive member by member, in small chunks, frames the
block by its content length and verifies the digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import scratch_folder, stored
from panelwright.llm.base import corpus_query, table

LEAST_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20  # an archive is closed once it has this many bytes
CHUNK = 1 << 16
GZIP = 31  # zlib's window bits for a gzip member
DATE = "1970-01-01T00:00:00Z"  # the tables have no fetch dates
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The upper half of a record's UUID; the lower half is its page id.
ID_HIGH, NO_ID_HIGH = 0x70616765_00004000, 0x6E6F6E65_00004000

MANIFEST = "archive string, records long, bytes long"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def record_id(page_id: int | None) -> str:
    high, low = (NO_ID_HIGH, 0) if page_id is None else (ID_HIGH, page_id % (1 << 64))
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | low)}>"


def page_id_of(record: str) -> int | None:
    number = uuid.UUID(record.strip("<>").rpartition(":")[2]).int
    if number >> 64 != ID_HIGH:
        return None
    low = number % (1 << 64)
    return low - (1 << 64) if low >> 63 else low


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    head += f"WARC-Block-Digest: {_sha1(block)}\r\nContent-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response with the payload, or a revisit without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _sha1(payload)),
    ]
    if url is not None:
        # A header ends with its line, so line ends in an address are written as %0D and %0A.
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is None:
        return _record(headers, http.encode() + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    return _record(headers, http.encode())


def info_record(name: str) -> bytes:
    headers = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _record(headers, b"format: WARC File Format 1.1\r\n")


def members(source) -> Iterator[bytes]:
    """The decompressed gzip members of a file-like object, one at a time."""
    data = source.read(CHUNK)
    while data:
        unpacker, out = zlib.decompressobj(GZIP), []
        while not unpacker.eof:
            if not data:
                raise ValueError("the archive ends within a gzip member")
            out.append(unpacker.decompress(data))
            data = unpacker.unused_data if unpacker.eof else source.read(CHUNK)
        yield b"".join(out)
        data = data or source.read(CHUNK)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers in lower case, block), framed by the content length. The block
    digest, and the payload digest of a response, must be right."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("a record does not begin with a WARC header")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    size = int(headers["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise ValueError(f"{headers.get('warc-record-id')}: the block is not of its content length")
    if _sha1(block) != headers["warc-block-digest"]:
        raise ValueError(f"{headers.get('warc-record-id')}: wrong block digest")
    if headers["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if _sha1(payload) != headers["warc-payload-digest"]:
            raise ValueError(f"{headers.get('warc-record-id')}: wrong payload digest")
    return headers, block


def http_parts(block: bytes) -> tuple[int, bytes]:
    """(content length that the HTTP header states, body)."""
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b": ")
        if name.lower() == b"content-length":
            return int(value), body
    raise ValueError("no content length in the HTTP header")


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to: of equal payloads of at least 1000
    bytes the largest page_id has none, the others refer to it."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    digest = F.when(F.octet_length("payload") >= LEAST_REVISIT_BYTES, F.sha1("payload"))
    firsts = (
        rows.select(digest.alias("digest"), "page_id")
        .where("digest is not null")
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return (
        rows.withColumn("digest", digest)
        .join(firsts, "digest", "left")
        .select("page_id", "url", "payload", refers_to.alias("refers_to"))
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page (page_id, url, html) into new archives in
    `folder`, an address that all executors reach; the manifest of those that
    count (a task that runs again writes new ones): archive, records, bytes.

    A null html is an empty payload and a null url no header. Rows with the
    same page_id each get a record. No page gives an empty manifest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = fs.FileSystem.from_uri(folder)
        store.create_dir(place, recursive=True)
        name, out, records, size = None, None, 0, 0
        for batch in batches:
            done = []
            whole = batch[["page_id", "refers_to"]].astype(object).where(batch[["page_id", "refers_to"]].notna(), None)
            for page, url, payload, refers in zip(
                whole["page_id"], batch["url"], batch["payload"], whole["refers_to"]
            ):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(f"{place}/{name}", compression=None), 0, 0
                    size += out.write(info_record(name))
                size += out.write(
                    page_record(None if page is None else int(page), url, payload, None if refers is None else int(refers))
                )
                records += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, records, size))
                    out = None
            yield pd.DataFrame(done, columns=["archive", "records", "bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(name, records, size)], columns=["archive", "records", "bytes"])

    return stored(with_revisits(pages).mapInPandas(run, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records of the archives in `manifest` (archive), see RECORD.

    payload_bytes and payload_digest (lower-case hex) are of the full payload,
    also for a revisit, whose payload is null; so is every payload if
    `payloads` is false. A record that breaks off, is not framed by its content
    length or has a wrong digest fails the read."""
    columns = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["archive"]:
                with store.open_input_stream(f"{place}/{name}", compression=None) as source:
                    rows, size = [], 0
                    for data in members(source):
                        headers, block = parse_record(data)
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        length, body = http_parts(block)
                        digest = base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
                        revisit = headers["warc-type"] == "revisit"
                        rows.append(
                            (
                                page_id_of(headers["warc-record-id"]),
                                headers.get("warc-target-uri"),
                                length,
                                digest,
                                headers["warc-type"],
                                page_id_of(headers["warc-refers-to"]) if revisit else None,
                                body if payloads and not revisit else None,
                            )
                        )
                        size += len(body) if payloads else 0
                        if len(rows) == 1000 or size > ARCHIVE_BYTES:
                            yield _frame(rows, columns)
                            rows, size = [], 0
                    yield _frame(rows, columns)

    archives = manifest.select("archive")
    # One archive per task where there are that many; a manifest is small.
    return archives.repartition(max(1, min(archives.count(), 10_000))).mapInPandas(run, RECORD)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


@corpus_query(
    "op6_warc",
    f"""
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
    f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
           CASE WHEN n >= {LEAST_REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= {LEAST_REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_folder(spark, "warc")
    manifest = write_archives(table(spark, folder, "pages"), archives)
    return read_archives(spark, archives, manifest, payloads=False).drop("url", "payload")
