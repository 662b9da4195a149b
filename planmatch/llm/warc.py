"""WARC archives: written with one gzip member a record, read back by byte ranges.

A reading task gets a byte range of a file.  It looks for gzip magic, takes a place as a member's start only
if decoding there gives a WARC header, and owns the records that start inside its range, reading past the
range's end to finish the last one.  Payloads that occur again become revisit records, which keep the HTTP
header block (with the payload's length) and the digest.

Null html counts as an empty payload, a null url as ``urn:x-page:<id>``.  Of equal payloads the smallest
page_id is the response; rows that repeat that page_id are responses too, rows with a null page_id are
revisits unless no row has an id.  An empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import hot_key_join, partitions, pick, read, saved, scratch
from planmatch.llm.files import shared, whole_file

FILE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
MIN_REVISIT_BYTES = 0
GZIP_LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
PROBE = 16 << 10  # compressed bytes decoded to validate a candidate
READ = 1 << 20


def page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record, compressed; a revisit of page ``first`` if that is given."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else page_urn(page_id)[1:-1]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = [f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_urn(first)}"]
    raw = "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``folder/*.warc.gz``; returns the manifest: path, records."""
    spark = pages.sparkSession
    rows = pick(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    again = F.octet_length("html") >= min_revisit_bytes
    firsts = (rows.filter(again).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null"))
    firsts = saved(firsts, "payloads")
    found = hot_key_join(rows, firsts, "digest", "n", max(1, rows.count()), "left")
    found = found.withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    found = found.select("page_id", "url", "html", "digest", "first")

    def write(batches):
        import pyarrow as pa

        part, seq, out, size, n = TaskContext.get().partitionId(), 0, [], 0, 0
        schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

        def flush():
            path = f"{folder}/part-{part:05d}-{seq:04d}.warc.gz"
            with whole_file(path) as f:
                f.write(b"".join(out))
            return pa.RecordBatch.from_pydict({"path": [path], "records": [n]}, schema)

        for batch in batches:
            for page_id, url, html, digest, first in zip(*[c.to_pylist() for c in batch.columns]):
                z = member(page_id, url, html.encode(), base64.b32encode(bytes.fromhex(digest)).decode(), first)
                out.append(z)
                size, n = size + len(z), n + 1
                if size >= file_bytes:
                    yield flush()
                    out, size, n, seq = [], 0, 0, seq + 1
        if out:
            yield flush()

    manifest = found.mapInArrow(write, "path string, records long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


# --------------------------------------------------------------------- reading


def parse(raw: bytes) -> dict:
    """Headers (lower-case names), the payload (none for a revisit) and the payload's length of a decoded record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    fields["http-length"] = int(length[1]) if length else len(payload)
    fields["payload"] = None if fields["warc-type"] == "revisit" else payload
    return fields


def is_record(start: bytes) -> bool:
    """Whether a WARC header decodes from these compressed bytes."""
    try:
        return zlib.decompressobj(31).decompress(start, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def records(file, size: int, start: int, end: int):
    """(offset, decoded record) for the members that start in [start, end) of a file of ``size`` bytes."""

    def at(offset: int, n: int) -> bytes:
        return file.read_at(min(n, size - offset), offset) if offset < size else b""

    def next_start(offset: int) -> int | None:
        while offset < min(end, size):
            block = at(offset, READ + 2)
            found = block.find(MAGIC)
            while found >= 0 and offset + found < end:
                if is_record(at(offset + found, PROBE)):
                    return offset + found
                found = block.find(MAGIC, found + 1)
            offset += READ
        return None

    offset = next_start(start)
    while offset is not None and offset < end:
        z, parts, here = zlib.decompressobj(31), [], offset
        while not z.eof:
            block = at(here, READ)
            if not block:
                raise ValueError(f"record at {offset} is cut off")
            parts.append(z.decompress(block))
            here += len(block)
        here -= len(z.unused_data)
        yield offset, b"".join(parts)
        offset = here if at(here, 3) == MAGIC and here < end and is_record(at(here, PROBE)) else next_start(here)


def read_warc(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """Records of ``folder/*.warc.gz``: path, at, record_type, record_id, target_uri, refers_to, payload_bytes, payload_digest, payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length").filter("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.repartition(partitions(spark), "path", "start")

    def rows(batches):
        import pyarrow as pa

        names = ["path", "at", "record_type", "record_id", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
        schema = pa.schema(list(zip(names, kinds)))
        for batch in batches:
            for path, length, start in zip(*[c.to_pylist() for c in batch.columns]):
                fs, inner = shared(path)
                out, held = [], 0
                with fs.open_input_file(inner) as file:
                    for at, raw in records(file, length, start, start + split_bytes):
                        r = parse(raw)
                        payload, digest = r["payload"], r["warc-payload-digest"].removeprefix("sha1:")
                        if payload is not None and (len(payload) != r["http-length"] or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{path} at {at}: payload does not match its digest")
                        out.append((path, at, r["warc-type"], r["warc-record-id"], r["warc-target-uri"], r.get("warc-refers-to"), r["http-length"], digest, payload if with_payload else None))
                        held += len(raw) if with_payload else 200
                        if held > READ * 4:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema=schema)
                            out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema=schema)

    return ranges.mapInArrow(rows, "path string, at long, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op4."""
    folder = scratch(spark, "warc")
    manifest = write_warc(read(spark, sf_dir, "pages"), folder)
    shape = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if not manifest.head(1):
        return spark.createDataFrame([], shape)
    back = read_warc(spark, folder, with_payload=False)
    number = lambda c: F.regexp_extract(c, r"<urn:x-page:(-?\d+)>", 1).try_cast("long")
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
