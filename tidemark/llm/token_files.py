"""Token ids of documents as Arrow stream files of fixed-size lists, for random access without copying.

The ids of all documents, each closed by an end id, follow one another in ascending order of doc_id (null
first; texts that share an id in the order of a hash, repeated rows one after the other). They are cut into
sequences of equal length: ``ids``, unsigned 16-bit integers where the vocabulary allows it and 32-bit ones
otherwise, ``mask``, bits that are set but for padding, and ``first``, bits that are set at each document's first id.
A file is an Arrow stream whose record batches hold the same number of sequences, but for the last one. Without
compression such batches take the same number of bytes, so sequence k is found by one multiplication
(``Sequences``) and read in place. Beside each file stands a stream with the doc_id of its documents.

A task writes the files of one range of doc_ids, a text at a time; a file ends with the document that fills
it, and only a file's last sequence has padding. Names hold the attempt, and only files that a finished
attempt reports are listed, so lost executors and repeated tasks leave nothing that is read. The table of
files has one row a file. ``documents`` reads the files back as streams and raises where they contradict the list.

A null or empty text is the end id alone. Very long texts go on over as many sequences as they need. An
empty table has no files and an empty result. Only doc_id and text are read. The folder must be one that both Spark and
pyarrow's file systems can name (file, hdfs, s3, gs).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, slices, trimmed, written
from tidemark.llm.words import words

#: Ids of a sequence, sequences of a record batch, ids after which a file ends with the next document.
LENGTH, ROWS, FILE_IDS = 1024, 64, 1 << 24
FILES = "part int, number int, file string, docs long, ids long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class Shard:
    """One file under construction and the list of its documents; what is not yet a whole batch is kept."""

    def __init__(self, uri: str, dtype: np.dtype, length: int, rows: int):
        own, path = place(uri)
        self.length, self.size, self.docs, self.ids = length, length * rows, 0, 0
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length)), ("first", pa.list_(pa.bool_(), length))])
        self.sinks = [own.open_output_stream(path), own.open_output_stream(path + ".docs")]
        self.sequences, self.list = pa.ipc.new_stream(self.sinks[0], self.schema), pa.ipc.new_stream(self.sinks[1], pa.schema([("doc_id", pa.int64())]))
        self.rest = [np.zeros(0, dtype), np.zeros(0, bool)]

    def batch(self, ids: np.ndarray, first: np.ndarray) -> None:
        used, more = len(ids), -len(ids) % self.length
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(np.pad(x, (0, more))), self.length) for x in (ids, np.ones(used, bool), first)]
        self.sequences.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, first: np.ndarray) -> None:
        self.list.write_batch(pa.RecordBatch.from_arrays([doc_ids], names=["doc_id"]))
        self.docs, self.ids = self.docs + len(doc_ids), self.ids + len(ids)
        both = [np.concatenate(x) for x in zip(self.rest, (ids, first), strict=True)]
        whole = len(both[0]) // self.size * self.size
        for a in range(0, whole, self.size):
            self.batch(*(x[a : a + self.size] for x in both))
        self.rest = [x[whole:] for x in both]

    def close(self) -> None:
        if len(self.rest[0]):
            self.batch(*self.rest)
        for x in (self.sequences, self.list, *self.sinks):
            x.close()


def write(docs: DataFrame, path: str, tokenizer_path: str, end: int = 2, length: int = LENGTH, rows: int = ROWS, file_ids: int = FILE_IDS) -> DataFrame:
    """The files of docs in the folder path, and the table of them: part and number (their order), file, docs, ids and start, the ids in all files before."""
    place(path)[0].create_dir(place(path)[1])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = words(tokenizer_path), TaskContext.get()
        dtype, done, shard = np.dtype(np.uint16 if own.own.get_vocab_size() <= 1 << 16 else np.uint32), [], None

        def closed() -> None:
            shard.close()
            done.append((task.partitionId(), len(done), file, shard.docs, shard.ids))

        for batch in slices(batches, "text", 4 << 20):
            flat, lengths = own.encode_batch(batch.column("text"))
            stops = np.cumsum(lengths + 1)
            ids, first, inner = np.full(stops[-1], end, dtype), np.zeros(stops[-1], bool), np.ones(stops[-1], bool)
            inner[stops - 1] = False
            ids[inner] = flat
            first[np.concatenate([[0], stops[:-1]])] = True
            at = 0
            while at < batch.num_rows:
                if shard is None:
                    file = f"{path}/{task.partitionId():06d}-{len(done):04d}-{task.taskAttemptId()}.arrow"
                    shard = Shard(file, dtype, length, rows)
                before = stops[at - 1] if at else 0
                upto = min(int(np.searchsorted(stops, before + file_ids - shard.ids)) + 1, batch.num_rows)
                shard.add(batch.column("doc_id").slice(at, upto - at), ids[before : stops[upto - 1]], first[before : stops[upto - 1]])
                at = upto
                if shard.ids >= file_ids:
                    closed()
                    shard = None
        if shard is not None:
            closed()
        own.forget()
        trimmed()
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=[x.split()[0] for x in FILES.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.orderBy("doc_id", F.xxhash64("text"), F.monotonically_increasing_id())  # the last one lets equal rows be dealt to several tasks
    files = written(texts.mapInArrow(save, FILES), "token-files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one small row a file
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(file: str, start: int) -> Iterator[tuple]:
    """doc_id, start, n_tokens and ids_crc32 of each document of a file, from its sequences and bits; the file is read as a stream."""
    own, path = place(file)
    crc = count = 0
    with own.open_input_stream(path) as data, own.open_input_stream(path + ".docs") as names:
        ids_of = (x for batch in pa.ipc.open_stream(names) for x in batch.column(0).to_pylist())
        for batch in pa.ipc.open_stream(data):
            ids, mask, first = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "mask", "first"))
            used = int(np.count_nonzero(mask))
            if not mask[:used].all():
                raise ValueError(f"{file} has padding before its end")
            plain, firsts = memoryview(ids[:used].astype("<u4")).cast("B"), np.flatnonzero(first[:used]).tolist()
            at = 0
            for to in [*firsts, used]:
                crc, count = zlib.crc32(plain[4 * at : 4 * to], crc), count + to - at
                if to < used:
                    if count:
                        yield next(ids_of), start, count, crc
                    start, crc, count = start + count, 0, 0
                at = to
        if count:
            yield next(ids_of), start, count, crc
        if next(ids_of, file) is not file:
            raise ValueError(f"{file} has fewer documents than its list")


def documents(files: DataFrame) -> DataFrame:
    """DOCUMENTS of all files of the table that write() returned, one task a file."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4
        for batch in batches:
            for file, docs, ids, start in zip(*(batch.column(c).to_pylist() for c in ("file", "docs", "ids", "start")), strict=True):
                rows, seen, total = [], 0, 0
                for row in read(file, start):
                    rows.append(row)
                    seen, total = seen + 1, total + row[2]
                    if len(rows) == 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if (seen, total) != (docs, ids):
                    raise ValueError(f"{file} has {seen} documents of {total} ids, listed are {docs} of {ids}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        trimmed()

    names = [x.split()[0] for x in DOCUMENTS.split(", ")]
    many = max(1, files.count())
    return files.repartition(many).mapInArrow(load, DOCUMENTS)


class Sequences:
    """The sequences of one file, whose bytes may be a memory map: sequences[k] is (ids, mask, first), Arrow arrays that are views of those bytes."""

    def __init__(self, data: pa.Buffer):
        at = pa.BufferReader(data)
        self.data, self.schema = data, pa.ipc.read_schema(at)
        self.head = at.tell()
        self.rows = pa.ipc.read_record_batch(pa.ipc.read_message(at), self.schema).num_rows
        self.stride = at.tell() - self.head
        whole = (data.size - self.head) // self.stride
        rest = self.head + whole * self.stride
        self.count = whole * self.rows + (self.at(rest).num_rows if data.size - rest > 8 else 0)  # 8 bytes end a stream

    def at(self, start: int) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.ipc.read_message(pa.BufferReader(self.data.slice(start))), self.schema)

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, k: int) -> tuple[pa.Array, ...]:
        if not 0 <= k < self.count:
            raise IndexError(k)
        batch, row = self.at(self.head + k // self.rows * self.stride), k % self.rows
        return tuple(batch.column(c).slice(row, 1).flatten() for c in ("ids", "mask", "first"))


def stored(docs: DataFrame, tokenizer_path: str, end: int = 2) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of docs, written to files of the shared folder and read back."""
    return documents(write(docs, scratch(docs.sparkSession, "tokens"), tokenizer_path, end))
