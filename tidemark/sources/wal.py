"""Write-ahead segments: reading them as a Spark data source, appending, sealing and promoting them.

A file is one input partition and is verified while it is read: header, entries, hash chain and, for a
sealed one, the trailer. ``mode=active`` takes a file without a trailer and stops at an entry that the
writer had not finished; nothing is ever repaired in place.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D

ENTRIES = "object_key string, object_sha256 binary, sequence decimal(20,0), receive_wall_s long, receive_monotonic_us decimal(20,0), previous_entry_hash binary, frame binary, batch_hash binary, entry_hash binary"
SEGMENTS = "object_key string, object_sha256 binary, file_bytes long, gateway_instance_id string, start_sequence decimal(20,0), last_sequence decimal(20,0), entry_count long, chain_start binary, chain_root binary, trailer_file_sha256 binary"


class IntegrityError(ValueError):
    """Bytes that contradict each other."""


@dataclass
class Entry:
    sequence: int
    receive_wall_s: int
    receive_monotonic_us: int
    previous_entry_hash: bytes
    frame: bytes
    batch_hash: bytes
    entry_hash: bytes


@dataclass
class Segment:
    gateway_instance_id: str
    start_sequence: int
    entries: list[Entry]
    sealed: bool
    file_sha256: bytes
    object_sha256: bytes
    file_bytes: int
    chain_start: bytes = D.ZERO
    chain_root: bytes = D.ZERO
    last_sequence: int = 0


def header(gateway: str, start: int, wall_s: int) -> bytes:
    name = gateway.encode()
    if len(name) > D.MAX_STRING:
        raise IntegrityError("gateway id is too long")
    return struct.pack("<4sHHQqIH", b"TWAL", 1, 30 + len(name), start, wall_s, 0, len(name)) + name


def encode_entry(sequence: int, previous: bytes, wall_s: int, mono_us: int, frame: bytes) -> tuple[bytes, bytes]:
    """The entry's bytes and its hash."""
    batch = C.batch_hash(frame)
    own = C.entry_hash(sequence, previous, wall_s, mono_us, batch, frame)
    body = struct.pack("<IHHQqQ32sI", 140 + len(frame), 1, 0, sequence, wall_s, mono_us, previous, len(frame)) + frame + batch + own + C.u32(D.COMMIT)
    return body + C.u32(C.crc32c(body)), own


def trailer(first: int, last: int, count: int, root: bytes, file_sha: bytes) -> bytes:
    body = struct.pack("<4sHHQQI32s32s", b"TWTR", 1, D.TRAILER, first, last, count, root, file_sha)
    return body + C.u32(C.crc32c(body))


def decode_entry(data: bytes, at: int, end: int) -> tuple[Entry, int]:
    """The entry at a place and the place after it; EOFError if the entries' bytes, which stop at end, stop inside it."""
    if at + 4 > end:
        raise EOFError
    size = struct.unpack_from("<I", data, at)[0]
    if not 140 + D.HEADER + 4 <= size <= 140 + D.MAX_FRAME:
        raise IntegrityError(f"entry length {size}")
    if at + size > end:
        raise EOFError
    _, version, flags, sequence, wall_s, mono_us, previous, length = struct.unpack_from("<IHHQqQ32sI", data, at)
    if version != 1 or flags or length != size - 140:
        raise IntegrityError(f"entry {sequence}: version, flags or frame length")
    body = at + 68 + length
    commit, crc = struct.unpack_from("<II", data, body + 64)
    if commit != D.COMMIT or C.crc32c(data[at : at + size - 4]) != crc:
        raise IntegrityError(f"entry {sequence}: commit marker or checksum")
    frame, batch, own = data[at + 68 : body], data[body : body + 32], data[body + 32 : body + 64]
    if C.batch_hash(frame) != batch or C.entry_hash(sequence, previous, wall_s, mono_us, batch, frame) != own:
        raise IntegrityError(f"entry {sequence}: hash")
    return Entry(sequence, wall_s, mono_us, previous, frame, batch, own), at + size


def parse(data: bytes, sealed: bool = True) -> Segment:
    """A whole segment, verified. An unsealed one may end inside an entry."""
    if len(data) < 30 or data[:4] != b"TWAL":
        raise IntegrityError("no segment header")
    _, version, size, start, _, flags, n = struct.unpack_from("<4sHHQqIH", data)
    if version != 1 or flags or n > D.MAX_STRING or size != 30 + n or len(data) < size:
        raise IntegrityError("segment header")
    end, seal = len(data), None
    if sealed:
        end -= D.TRAILER
        if end < size or data[end : end + 4] != b"TWTR":
            raise IntegrityError("no trailer")
        seal = struct.unpack_from("<4sHHQQI32s32sI", data, end)
        if seal[1:3] != (1, D.TRAILER) or C.crc32c(data[end:-4]) != seal[-1]:
            raise IntegrityError("trailer checksum")
    own = Segment(data[30:size].decode(), start, [], sealed, hashlib.sha256(data[:end]).digest(), hashlib.sha256(data).digest(), len(data))
    at = size
    while at < end:
        try:
            entry, at = decode_entry(data, at, end)
        except EOFError:
            if sealed:
                raise IntegrityError("the last entry is cut") from None
            break
        before = own.entries[-1] if own.entries else None
        if entry.sequence != (before.sequence + 1 if before else start) or before and entry.previous_entry_hash != before.entry_hash:
            raise IntegrityError(f"entry {entry.sequence} does not follow")
        own.entries.append(entry)
    if own.entries:
        own.chain_start, own.chain_root, own.last_sequence = own.entries[0].previous_entry_hash, own.entries[-1].entry_hash, own.entries[-1].sequence
    if seal is not None:
        first, last, count, root, file_sha = seal[3:8]
        if not own.entries or (first, last, count, root, file_sha) != (start, own.last_sequence, len(own.entries), own.chain_root, own.file_sha256):
            raise IntegrityError("the trailer contradicts the entries")
    return own


@dataclass
class Writer:
    """An active segment in memory: entries are chained as they are appended; a failure stops it for good."""

    gateway: str
    start: int = 1
    previous: bytes = D.ZERO
    wall_s: int = 0
    data: bytearray = field(default_factory=bytearray)
    poisoned: bool = False

    def __post_init__(self) -> None:
        self.next, self.first_root = self.start, self.previous
        self.data += header(self.gateway, self.start, self.wall_s)

    def append(self, frame: bytes, wall_s: int, mono_us: int) -> bytes:
        if self.poisoned:
            raise IntegrityError("an earlier append failed")
        if C.frame_error(frame):
            raise C.FormatError(C.frame_error(frame))
        try:
            body, own = encode_entry(self.next, self.previous, wall_s, mono_us, frame)
            self.data += body
        except Exception:
            self.poisoned = True
            raise
        self.next, self.previous = self.next + 1, own
        return own

    def seal(self) -> bytes:
        """The sealed file, verified; the writer goes on with the next segment of the chain."""
        if self.next == self.start:
            raise IntegrityError("nothing to seal")
        whole = bytes(self.data) + trailer(self.start, self.next - 1, self.next - self.start, self.previous, hashlib.sha256(self.data).digest())
        parse(whole)
        self.start, self.data = self.next, bytearray(header(self.gateway, self.next, self.wall_s))
        return whole


def _entries(batches: Iterator[pa.RecordBatch], mode: str) -> Iterator[pa.RecordBatch]:
    from decimal import Decimal

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            try:
                own = parse(content.as_py(), mode == "sealed")
            except IntegrityError as bad:
                raise IntegrityError(f"{path}: {bad}") from bad
            key = f"objects/raw/wal-{own.object_sha256.hex()}.rtw"
            for a in range(0, len(own.entries), 512):
                some = own.entries[a : a + 512]
                columns = [[key] * len(some), [own.object_sha256] * len(some), [Decimal(e.sequence) for e in some], [e.receive_wall_s for e in some], [Decimal(e.receive_monotonic_us) for e in some]]
                columns += [[getattr(e, n) for e in some] for n in ("previous_entry_hash", "frame", "batch_hash", "entry_hash")]
                kinds = [pa.string(), pa.binary(), pa.decimal128(20, 0), pa.int64(), pa.decimal128(20, 0), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in ENTRIES.split(", ")])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from decimal import Decimal

    for batch in batches:
        for content in batch.column("content"):
            own = parse(content.as_py())
            row = [f"objects/raw/wal-{own.object_sha256.hex()}.rtw", own.object_sha256, own.file_bytes, own.gateway_instance_id, Decimal(own.start_sequence), Decimal(own.last_sequence), len(own.entries), own.chain_start, own.chain_root, own.file_sha256]
            kinds = [pa.string(), pa.binary(), pa.int64(), pa.string(), pa.decimal128(20, 0), pa.decimal128(20, 0), pa.int64(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in SEGMENTS.split(", ")])


def files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "content")


def entries(spark: SparkSession, path: str, mode: str = "sealed") -> DataFrame:
    """The verified entries of every segment under path; a bad one fails the query."""
    return files(spark, path).mapInArrow(lambda b: _entries(b, mode), ENTRIES)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """One row for each sealed segment under path."""
    return files(spark, path).mapInArrow(_segments, SEGMENTS)


def ordered_segments(found: DataFrame) -> DataFrame:
    """Segments of each gateway in chain order; breaks is true where one does not follow the one before it."""
    order = Window.partitionBy("gateway_instance_id").orderBy("start_sequence", "object_sha256")
    follows = (F.col("start_sequence") == F.lag("last_sequence").over(order) + 1) & (F.col("chain_start") == F.lag("chain_root").over(order))
    return found.withColumn("breaks", ~F.coalesce(follows, F.lag("last_sequence").over(order).isNull()))


def promote(spark: SparkSession, found: DataFrame, folder: str) -> DataFrame:
    """key, sha256, bytes and created of each file (content), copied by the tasks under its content's name; one that exists must be equal byte for byte."""
    from tidemark.sources.store import put_all

    digest = F.sha2("content", 256)
    return put_all(found.select(F.concat(F.lit("objects/raw/wal-"), digest, F.lit(".rtw")).alias("key"), F.col("content").alias("data")), folder)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def register(spark: SparkSession) -> None:
    """Make spark.read.format("wal") read segments, one partition a file, from any store that pyarrow's file systems reach."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.path, self.mode = options["path"], options.get("mode", "sealed")

        def partitions(self) -> list[InputPartition]:
            store, base = opened(self.path)
            found = store.get_file_info(fs.FileSelector(base, recursive=True))
            return [InputPartition(i.path) for i in sorted(found, key=lambda i: i.path) if i.path.endswith(".rtw")] or [InputPartition("")]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            if partition.value:
                store, _ = opened(self.path)
                with store.open_input_stream(partition.value) as f:
                    batch = pa.RecordBatch.from_pydict({"path": [partition.value], "content": pa.array([f.read()], pa.binary())})
                yield from _entries(iter([batch]), self.mode)

    class Wal(DataSource):
        @classmethod
        def name(cls) -> str:
            return "wal"

        def schema(self) -> str:
            return ENTRIES

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    spark.dataSource.register(Wal)
