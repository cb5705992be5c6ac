"""WARC archives: writing deduplicated records and reading them back by boundary chains.

A page is a ``response`` record, or a ``revisit`` of the record with the smallest page_id among those
with the same payload, when the payload has at least a given number of bytes. A null html is an empty
payload; a null url has no target header. Repeated rows of the smallest page_id are all responses. A
null page_id never becomes the record that others refer to. Empty tables give empty archives. A page of
more than 1 MB is a file of its own, of at most 2 GB. Only page_id, url and html are read.

Reading does not trust the magic ``WARC/1.1``: every place where it stands gives a candidate edge from
the record to its successor, and only what pointer jumping reaches from the start of a file is a record.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, scratch, written

#: Rows of copies up to which the list of copies is broadcast (16 bytes each and their digest); beyond, it is joined by shuffling.
BROADCAST_ROWS = 200_000
#: Bytes of a page up to which so many records share a file: no file has more than about 100 MB but for one of a single larger record.
SHARED = ((1 << 14, 5000), (1 << 20, 100))
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MAGIC = re.compile(rb"WARC/1\.1\r\n")
FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")
RECORD = "file string, position long, successor long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, which has 160 bits and so needs no padding."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def plain(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and size (its bytes) of each page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn("size", F.octet_length("payload"))


def repeated(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """key (a digest) and first, the smallest page_id, of the payloads of at least min_bytes that several pages have."""
    rows = plain(pages).where(F.col("size") >= min_bytes).select(F.sha2(F.encode("payload", "UTF-8"), 256).alias("key"), "page_id")
    return rows.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("key", "first")


def records(pages: DataFrame, copies: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One column, value: the WARC record of each row of plain(), without the two line ends that close it; copies are of repeated()."""
    rows = pages.withColumn("key", F.sha2(F.encode("payload", "UTF-8"), 256))
    rows = rows.join(copies, "key", "left").withColumn("again", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    end = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "), F.col("size").cast("string"), F.lit(end + end))
    block = F.when(F.col("again"), http).otherwise(F.concat(http, F.col("payload")))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(end)), F.lit(""))

    named = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    return rows.withColumn("block", block).select(
        F.concat(
            F.lit(f"WARC/1.1{end}"),
            field("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
            field("WARC-Record-ID", named),
            field("WARC-Date", F.lit(date)),
            field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", "%0D%0A")),
            field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.encode("payload", "UTF-8")))),
            field("WARC-Refers-To", F.when(F.col("again"), F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
            field("WARC-Profile", F.when(F.col("again"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("Content-Type", F.lit("application/http; msgtype=response")),
            field("Content-Length", F.octet_length("block").cast("string")),
            F.lit(end),
            F.col("block"),
        ).alias("value")
    )


def write(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = 5000) -> None:
    """Archives in the folder path, written by Spark, so path may lie in any store. A file has a bounded number of records by the bytes of their pages, at most records_per_file."""
    copies = written(repeated(pages, min_bytes), "copies")
    near = F.broadcast(copies) if copies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else copies
    rows, least = plain(pages), -1
    for most, many in (*SHARED, (None, 1)):
        some = rows.where(F.col("size") > least) if most is None else rows.where((F.col("size") > least) & (F.col("size") <= most))
        done = records(some, near).write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", min(many, records_per_file))
        done.text(path)
        least = most
    discard(copies)


def header(data: bytes, start: int) -> tuple[dict[bytes, bytes], int] | None:
    """The fields after the line at start and the place where the block begins; None if no header ends there."""
    at, fields = data.index(b"\r\n", start) + 2, {}
    while found := FIELD.match(data, at):
        fields[found[1].lower()] = found[2]
        at = found.end()
    return (fields, at + 2) if data[at : at + 2] == b"\r\n" else None


def number(text: bytes | None, prefix: bytes = b"<urn:page:") -> int | None:
    digits = (text or b"").removeprefix(prefix).removesuffix(b">")
    return int(digits) if re.fullmatch(rb"-?\d+", digits) else None


def candidates(file: str, data: bytes) -> Iterator[tuple]:
    """Each place with the magic whose header gives a successor: the edge and what the record says."""
    for found in MAGIC.finditer(data):
        read = header(data, found.start())
        if read is None or not re.fullmatch(rb"\d{1,18}", read[0].get(b"content-length", b"")):
            continue
        fields, begin = read
        stop = begin + int(fields[b"content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            continue
        kind, size, digest = fields.get(b"warc-type", b"").decode("utf-8", "replace"), None, fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace")
        http = header(data, begin) if data.startswith(b"HTTP/", begin, stop) else None
        if http is not None and http[1] <= stop:
            if kind == "response":
                size = stop - http[1]
                digest = base64.b32encode(hashlib.sha1(memoryview(data)[http[1] : stop]).digest()).decode()
            else:
                size = number(http[0].get(b"content-length"))
        yield file, found.start(), stop + 4, number(fields.get(b"warc-record-id")), kind, number(fields.get(b"warc-refers-to")), size, digest


def reachable(position: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, int]:
    """Which candidates the chain from place 0 reaches, by pointer jumping, and the place where the chain ends."""
    order = np.argsort(position)
    places, after = position[order], successor[order]
    n = len(places)
    at = np.searchsorted(places, after)
    jump = np.append(np.where((at < n) & (places[np.minimum(at, n - 1)] == after), at, n), n)
    seen = np.zeros(n + 1, bool)
    seen[0] = places[0] == 0
    for _ in range(max(1, n.bit_length())):
        seen[jump[seen]] = True
        jump = jump[jump]
    out = np.zeros(n, bool)
    out[order] = seen[:n]
    return out, int(successor[out].max()) if out.any() else 0


def read(spark, path: str) -> DataFrame:
    """The records of the archives in path: file, position, successor and what each record says; payloads' digests are computed from their bytes.

    Tasks emit the candidate edges of their files; the edges of a file, without payloads, then meet in
    one group, whose size the writer bounds. A chain that does not end at the file's end raises.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, data in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), batch.column("content"), strict=True):
                found = list(candidates(file, data.as_py()))
                if size and not found:
                    raise ValueError(f"{file} has no record")
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) | {"length": size} for x in found], schema=kinds)

    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in [*RECORD.split(", "), "length long"]])

    def follow(rows: pa.Table) -> pa.Table:
        kept, end = reachable(rows["position"].to_numpy(), rows["successor"].to_numpy())
        if end != rows["length"][0].as_py():
            raise ValueError(f"{rows['file'][0]}: the chain of records ends at {end}")
        return rows.filter(pa.array(kept)).drop_columns(["length"])

    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    return files.mapInArrow(scan, f"{RECORD}, length long").groupBy("file").applyInArrow(follow, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, written to archives and read back."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(pages, path)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
