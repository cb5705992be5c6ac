"""Frames out of the bytes of connections as they land in files, as a streaming data source.

A connection is a folder; its files, in the order of their names, hold one stream of bytes, cut anywhere. A
frame may begin in one file and end in another, and bytes that are not yet a whole frame wait for what comes.
An offset says for each connection where its next frame begins, as a file and a byte in it, so a batch is a
range of whole frames and a restart goes on exactly there. To find it the driver reads 16 bytes a
frame, of new bytes only; frames themselves are read, checked and decoded by the tasks, in ranges of at most SPLIT bytes.

A header is judged as the live reader does: a length that is too short before one that is too long, then the magic
and the header's length. A bad header gives a row with its error and ends the connection: nothing says where the next
frame would begin. A whole frame that does not decode gives a row with its error, and the next one follows. The last
position is kept beside the data as a hint, so a new query need not walk files that are done with; a hint that is
missing or old only costs that walk.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.sources.wal import opened

FRAMES = "connection string, file string, byte long, kind string, error string, frame binary"
#: Bytes of frames that one task reads, and of a batch of rows.
SPLIT, ROWS = 16 << 20, 4 << 20
#: Bytes that a live reader looks at before it reads on.
PEEK = 16
HINT = "_read"


def header_error(header: bytes) -> str | None:
    """The first fault of a frame's first 16 bytes, in the live reader's order."""
    try:
        C.live_length(header)
    except C.FormatError as bad:
        return bad.code
    return None if header[:4] == b"TICK" and struct.unpack("<I", header[12:16])[0] == D.HEADER else "INVALID_FRAME"


@dataclass
class Landed:
    """The files of one connection as one stream of bytes."""

    store: fs.FileSystem
    files: list[tuple[str, int]]  # path and size, in order

    def read(self, index: int, byte: int, size: int) -> bytes | None:
        """size bytes from a place on, over file borders; None if there are not as many yet."""
        out = b""
        while len(out) < size:
            while index < len(self.files) and byte >= self.files[index][1]:
                byte, index = byte - self.files[index][1], index + 1
            if index == len(self.files):
                return None
            with self.store.open_input_file(self.files[index][0]) as f:
                f.seek(byte)
                some = f.read(min(size - len(out), self.files[index][1] - byte))
            out, byte = out + some, byte + len(some)
        return out

    def after(self, index: int, byte: int, size: int) -> tuple[int, int] | None:
        """The place size bytes on; None if that lies beyond what has landed."""
        byte += size
        while index < len(self.files) and byte > self.files[index][1]:
            byte, index = byte - self.files[index][1], index + 1
        return (index, byte) if index < len(self.files) else None


def connections(path: str) -> dict[str, Landed]:
    store, base = opened(path)
    out: dict[str, Landed] = {}
    for i in sorted(store.get_file_info(fs.FileSelector(base, recursive=True)), key=lambda i: i.path):
        parts = i.path[len(base) :].strip("/").split("/")
        if i.type == fs.FileType.File and len(parts) == 2 and not parts[1].startswith(("_", ".")):
            out.setdefault(parts[0], Landed(store, [])).files.append((i.path, i.size))
    return out


@dataclass
class Range(InputPartition):
    """Frames of a connection from a place on: how many, and whether the bytes after them are a bad header."""

    connection: str
    file: str
    byte: int
    frames: int
    bad: bool


class FrameReader(DataSourceStreamReader):
    """Offsets are {connection: [file, byte, ended]}: where the next frame begins, in the file that holds the byte before it or at the start of the first."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.most = options["path"], int(options.get("maxBytesPerTrigger", 1 << 30))
        self.at: dict[str, list[Any]] | None = None
        self.walked: dict[str, list[tuple[str, int, int, bool]]] = {}

    def initialOffset(self) -> dict:
        return {}

    def _hint(self) -> dict:
        store, base = opened(self.path)
        try:
            with store.open_input_stream(f"{base}/{HINT}") as f:
                return json.loads(f.read())
        except (OSError, ValueError):
            return {}

    @staticmethod
    def walk(own: Landed, start: list[Any] | None, most: int) -> Iterator[tuple[int, int, int, int, bool]]:
        """Each whole frame from start on, until most bytes: its place, the place after it and whether it is a bad header."""
        names = [f.rsplit("/", 1)[1] for f, _ in own.files]
        if start and start[2]:
            return
        index, byte = (names.index(start[0]), start[1]) if start else (0, 0)
        while most > 0:
            head = own.read(index, byte, PEEK)
            if head is None:
                return
            bad = header_error(head) is not None
            size = PEEK if bad else C.live_length(head)
            end = own.after(index, byte, size)
            if end is None:
                return
            yield index, byte, *end, bad
            if bad:
                return
            (index, byte), most = end, most - size

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._hint()
        for name, own in connections(self.path).items():
            for _, _, index, byte, bad in self.walk(own, self.at.get(name), self.most):
                self.at[name] = [own.files[index][0].rsplit("/", 1)[1], byte, bad]
        return json.loads(json.dumps(self.at))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out, found = [], connections(self.path)
        for name, stop in end.items():
            if start.get(name) == stop:
                continue
            own, size, one = found[name], 0, None
            names = [f.rsplit("/", 1)[1] for f, _ in own.files]
            for index, byte, to, after, bad in self.walk(own, start.get(name), 1 << 62):
                if one is None or size >= SPLIT:
                    one, size = Range(name, names[index], byte, 0, False), 0
                    out.append(one)
                one.frames, one.bad = one.frames + (not bad), bad
                size += after - byte if to == index else own.files[index][1] - byte + after
                if [names[to], after, bad] == stop:
                    break
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        own = connections(self.path)[partition.connection]
        names = [f.rsplit("/", 1)[1] for f, _ in own.files]
        index, byte, rows, size = names.index(partition.file), partition.byte, [], 0
        schema = pa.schema([("connection", pa.string()), ("file", pa.string()), ("byte", pa.int64()), ("kind", pa.string()), ("error", pa.string()), ("frame", pa.binary())])
        for k in range(partition.frames + partition.bad):
            head = own.read(index, byte, PEEK)
            kind, frame = None, head
            if k == partition.frames:
                error = header_error(head)
            else:
                frame = own.read(index, byte, C.live_length(head))
                try:
                    (kind, _), error = C.decode_message(frame), None
                except C.FormatError as bad:
                    error = bad.code
            rows.append({"connection": partition.connection, "file": names[index], "byte": byte, "kind": kind, "error": error, "frame": frame})
            index, byte = own.after(index, byte, len(frame))
            size += len(frame)
            if size >= ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def commit(self, end: dict) -> None:
        store, base = opened(self.path)
        temporary = f"{base}/{HINT}.new"
        with store.open_output_stream(temporary) as f:
            f.write(json.dumps(end).encode())
        store.move(temporary, f"{base}/{HINT}")


class Frames(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return FRAMES

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FrameReader(self.options)


def register(spark: SparkSession) -> None:
    """Make spark.readStream.format("frames").load(folder) read the frames of the connections below a folder."""
    spark.dataSource.register(Frames)
