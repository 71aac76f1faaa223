"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page, so every task writes a run of pages and rolls to a new file by
compressed size. Headers and digests are made anew from the payload, every record is a gzip member
of its own, files appear under their final name in one step, and a manifest names the files of the
archive. Nothing depends on time, attempt or host: a rerun writes the same bytes.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch, files, utf8, write_once
from ledgerlens.session import scratch_path

MIN_REVISIT_BYTES = 100
ROLL_BYTES = 32 << 20
# The archive's date is a parameter of the archive: nothing in the table tells when a page was taken.
WARC_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = (
    "file string, n_records long, n_bytes long, sha256 string, first_page long, last_page long")
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
    " refers_to long, payload binary, file string")


def record_id(page_id: int | None, digest: str) -> str:
    """A name-based identifier: the same page and payload always have the same."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}|{digest}'.encode()).digest()[:16], version=5)}>"


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def encode_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: gzip; its header holds no time
    return packer.compress(raw) + packer.flush()


def _headers(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw.decode().split("\r\n")[1:])}


def decode_records(data: bytes):
    """Yields ``headers, payload`` of each record; checks digests. Revisits have no payload."""
    view = memoryview(data)
    at = 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:  # in steps: what a member leaves unused is copied
            step = view[at:at + 16_384]
            if not len(step):
                raise ValueError("the last record is cut off")
            parts.append(unpacker.decompress(step))
            at += len(step) - len(unpacker.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        headers = _headers(head)
        block = rest[:int(headers["content-length"])]
        if hashlib.sha256(block).hexdigest() != headers["warc-block-digest"].removeprefix("sha256:"):
            raise ValueError(f"damaged record {headers['warc-record-id']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        headers["payload-length"] = _headers(http)["content-length"]
        yield headers, payload


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes`` as one row a page, and for every page
    of a repeated payload a row before it with ``first`` (the smallest page of that payload)."""
    plain = pages.select(
        "page_id", "url", utf8(F.col("html")).alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload").cast("long"))
    narrow = plain.filter(F.col("n") >= MIN_REVISIT_BYTES).select("page_id", "digest")
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("_c")).filter(
        "_c > 1").select(F.col("digest").alias("_d"), "first")
    roles = narrow.join(firsts, F.col("digest") == F.col("_d")).filter(
        "page_id <> first").select("page_id", "digest", "first").distinct()
    return plain.withColumn("first", F.lit(None).cast("long")).withColumn("kind", F.lit(1)).unionByName(
        roles.withColumn("kind", F.lit(0)), allowMissingColumns=True)


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, date: str = WARC_DATE) -> DataFrame:
    """Writes ``pages`` (``page_id, url, html``) to ``folder`` and returns the manifest.

    Null html is an empty payload. Of pages with equal payloads of at least 100 bytes the smallest id
    is the response and the others revisit it; a null id is never chosen to be revisited and its page
    is always a response, as are copies of the same id. An empty table gives an empty archive.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = with_roles(pages).repartitionByRange(parts, "page_id").sortWithinPartitions("page_id", "digest", "kind", "url")
    schema = arrow(MANIFEST)

    def write(batches):
        from pyspark import TaskContext

        part, rolled = TaskContext.get().partitionId(), 0
        chunks, size, first, last, count = [], 0, None, None, 0

        def close():
            nonlocal rolled, chunks, size, count
            name, data = f"part-{part:05d}-{rolled:05d}.warc.gz", b"".join(chunks)
            row = [name, count, len(data), write_once(f"{folder}/{name}", data), first, last]
            rolled, chunks, size, count = rolled + 1, [], 0, 0
            return batch(schema, *[[x] for x in row])

        role = None
        for b in batches:
            columns = [b.column(c) for c in ("page_id", "url", "payload", "digest", "first", "kind")]
            for i in range(b.num_rows):
                page, url, payload, digest, target, kind = (c[i].as_py() for c in columns)
                if kind == 0:
                    role = (page, digest, target)
                    continue
                revisit = role is not None and role[:2] == (page, digest)
                packed = encode_record(page, url, payload, digest, role[2] if revisit else None, revisit, date)
                first = page if not count else first
                chunks.append(packed)
                size, last, count = size + len(packed), page, count + 1
                if size >= roll_bytes:
                    yield close()
        if count:
            yield close()

    manifest = ordered.select("page_id", "url", "payload", "digest", "first", "kind").mapInArrow(write, MANIFEST)
    manifest.write.parquet(f"{folder}/_manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def read_archive(manifest: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """Records of the files that the manifest names; a file that differs from its entry is an error.

    ``payload_bytes`` and ``payload_digest`` of responses are of the bytes read; those of revisits are
    the response's, as their headers say.
    """
    schema = arrow(RECORDS)
    stored = files(manifest, folder, "*.warc.gz").join(manifest.select(F.col("file").alias("name"), "sha256"), "name")

    def read(batches):
        for b in batches:
            for name, content, sha in zip(*(b.column(c) for c in ("name", "content", "sha256"))):
                data, name = content.as_py(), name.as_py()
                if hashlib.sha256(data).hexdigest() != sha.as_py():
                    raise ValueError(f"{name} is not the file of the manifest")
                rows, size = [], 0
                for h, payload in decode_records(data):
                    revisit = h["warc-type"] == "revisit"
                    stated = h["warc-payload-digest"].removeprefix("sha256:")
                    rows.append((
                        int(h["x-page-id"]) if h["x-page-id"] else None, h["warc-target-uri"], h["warc-type"],
                        int(h["payload-length"]) if revisit else len(payload),
                        stated if revisit else hashlib.sha256(payload).hexdigest(),
                        int(h["x-refers-to-page-id"]) if revisit else None,
                        payload if keep_payload and not revisit else None, name))
                    size += len(payload)
                    if size > 16 << 20:
                        yield batch(schema, *map(list, zip(*rows)))
                        rows, size = [], 0
                if rows:
                    yield batch(schema, *map(list, zip(*rows)))

    return stored.mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes an archive to the shared folder and reads it back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archive(write_archive(pages, folder, roll_bytes), folder, keep_payload=False)
