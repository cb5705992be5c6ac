"""Reading sealed segments in byte ranges, so that one file is work for many tasks.

Every entry ends with a commit marker and a checksum, so behind each place where the marker stands an entry
may begin. Tasks emit such candidates of their ranges with the place of their successor and what their headers say;
a frame may hold the marker, so only what pointer jumping reaches from the end of the file's header is an entry. The chain of a
file's entries, without their frames, is checked against its trailer in one group, of about 100 bytes an entry. Then tasks read
and verify the entries that begin in their ranges: checksum, hashes and frame. The file's own hashes are
taken by a task that streams it. What contradicts the trailer fails the query; nothing is left out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.sources import wal
from tidemark.sources.wal import IntegrityError

#: Bytes of a range, and of a block that a file is streamed in.
SPLIT, BLOCK = 32 << 20, 4 << 20
MARK = C.u32(D.COMMIT)
#: Bytes of an entry before its frame and of the least frame.
HEAD, LEAST = 68, D.HEADER + 4
FACTS = "path string, first long, end long, start_sequence decimal(20,0), last_sequence decimal(20,0), entry_count long, chain_root binary, file_sha256 binary, object_sha256 binary"
EDGES = "path string, position long, successor long, sequence decimal(20,0), previous binary, own binary"


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "decimal(20,0)": pa.decimal128(20, 0)}
    names = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), names, strict=True)], names=[n for n, _ in names])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a file's header and trailer say, and its hashes, of which the trailer has one."""
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
            store, where = wal.opened(path)
            with store.open_input_file(where) as f:
                head = f.read(30 + D.MAX_STRING)
                if len(head) < 30 or head[:4] != b"TWAL":
                    raise IntegrityError(f"{path}: no segment header")
                _, version, first, start, _, flags, n = struct.unpack_from("<4sHHQqIH", head)
                end = size - D.TRAILER
                if version != 1 or flags or first != 30 + n or end < first:
                    raise IntegrityError(f"{path}: segment header")
                f.seek(end)
                tail = f.read(D.TRAILER)
                if tail[:4] != b"TWTR" or C.crc32c(tail[:-4]) != struct.unpack("<I", tail[-4:])[0]:
                    raise IntegrityError(f"{path}: trailer")
                begin, last, count, root, said = struct.unpack_from("<4sHHQQI32s32sI", tail)[3:8]
                f.seek(0)
                sha, left = hashlib.sha256(), end
                while left:
                    data = f.read(min(BLOCK, left))
                    sha.update(data)
                    left -= len(data)
                own = sha.digest()
                sha.update(tail)
                if own != said or begin != start:
                    raise IntegrityError(f"{path}: the trailer contradicts the file")
            yield _rows([(path, first, end, Decimal(start), Decimal(last), count, root, own, sha.digest())], FACTS)


def edges_of(path: str, start: int, stop: int, size: int) -> Iterator[tuple]:
    """The candidates that begin in a range: behind a marker and its checksum, or where a header may end."""
    store, where = wal.opened(path)
    with store.open_input_file(where) as f:

        def at(a: int, n: int) -> bytes:
            f.seek(a)
            return f.read(n)

        low = max(0, start - 8)
        data = at(low, stop - low + HEAD)
        places = [low + 8 + int(m) for m in _found(data, MARK)]
        if start == 0:
            places.append(30 + struct.unpack_from("<H", data, 28)[0] if len(data) >= 30 else 30)
        for place in sorted({p for p in places if start <= p < stop and p + HEAD <= size}):
            head = data[place - low : place - low + HEAD]
            length, version, flags, sequence, _, _, previous, n = struct.unpack_from("<IHHQqQ32sI", head)
            if version == 1 and not flags and n == length - 140 and LEAST <= n <= D.MAX_FRAME and place + length <= size:
                rest = place + length - 40 - low
                own = data[rest : rest + 32] if rest + 32 <= len(data) else at(place + length - 40, 32)
                yield path, place, place + length, Decimal(sequence), previous, own


def _found(data: bytes, mark: bytes) -> Iterator[int]:
    at = data.find(mark)
    while at >= 0:
        yield at
        at = data.find(mark, at + 1)


def reached(position: np.ndarray, successor: np.ndarray, first: int) -> np.ndarray:
    """Which candidates the chain from first reaches, by pointer jumping; positions ascend."""
    n = len(position)
    at = np.searchsorted(position, successor)
    jump = np.append(np.where((at < n) & (position[np.minimum(at, n - 1)] == successor), at, n), n)
    seen = np.append(position == first, False)
    for _ in range(max(1, n.bit_length())):
        seen[jump[seen]] = True
        jump = jump[jump]
    return seen[:n]


def _chain(rows: pa.Table) -> pa.Table:
    """The entries among a file's candidates; they must be what the trailer says."""
    rows = rows.sort_by("position")
    fact = rows.select([x.split()[0] for x in FACTS.split(", ")]).slice(0, 1).to_pylist()[0]
    rows = rows.filter(pa.array(reached(rows["position"].to_numpy(), rows["successor"].to_numpy(), fact["first"])))
    sequences, previous, own = ([*map(int, rows["sequence"].to_pylist())], rows["previous"].to_pylist(), rows["own"].to_pylist())
    good = len(own) == fact["entry_count"] and rows.num_rows and rows["successor"][-1].as_py() == fact["end"]
    good = good and sequences == list(range(int(fact["start_sequence"]), int(fact["last_sequence"]) + 1)) and previous[1:] == own[:-1] and own[-1] == fact["chain_root"]
    if not good:
        raise IntegrityError(f"{fact['path']}: the entries are not what the trailer says")
    return rows.select(["path", "object_sha256", "position", "successor"])


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, object_sha, places, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "object_sha256", "positions", "stop")), strict=True):
            store, where = wal.opened(path)
            key, rows, size = f"objects/raw/wal-{object_sha.hex()}.rtw", [], 0
            with store.open_input_file(where) as f:
                for place, after in zip(places, [*places[1:], stop], strict=True):
                    f.seek(place)
                    e, _ = wal.decode_entry(f.read(after - place), 0, after - place)
                    rows.append((key, object_sha, Decimal(e.sequence), e.receive_wall_s, Decimal(e.receive_monotonic_us), e.previous_entry_hash, e.frame, e.batch_hash, e.entry_hash))
                    size += after - place
                    if size >= BLOCK:
                        yield _rows(rows, wal.ENTRIES)
                        rows, size = [], 0
            if rows:
                yield _rows(rows, wal.ENTRIES)


def entries(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The verified entries of every sealed segment under path, as wal.entries() gives them; a file of several ranges is read by several tasks."""
    store, base = wal.opened(path)
    start = path[: len(path) - len(base)] if path.endswith(base) else "file://"
    found = [(start + i.path, i.size) for i in store.get_file_info(fs.FileSelector(base, recursive=True)) if i.type == fs.FileType.File and i.path.endswith(".rtw")]
    files = spark.createDataFrame(found, "path string, size long")
    facts = files.repartition(max(1, len(found))).mapInArrow(_facts, FACTS)
    many = sum(1 + size // split for _, size in found) or 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if rows := list(edges_of(row["path"], row["start"], min(row["start"] + split, row["size"]), row["size"])):
                    yield _rows(rows, EDGES)

    cut = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start")).repartition(many)
    edges = facts.join(cut.mapInArrow(scan, EDGES), "path", "left").na.fill(-1, ["position", "successor"])
    own = edges.select(*(x.split()[0] for x in FACTS.split(", ")), *(x.split()[0] for x in EDGES.split(", ")[1:])).groupBy("path").applyInArrow(_chain, "path string, object_sha256 binary, position long, successor long")
    dealt = own.groupBy("path", "object_sha256", F.floor(F.col("position") / split).alias("range")).agg(F.sort_array(F.collect_list("position")).alias("positions"), F.max("successor").alias("stop"))
    return dealt.repartition(many, "path", "range").mapInArrow(_decode, wal.ENTRIES)
