"""Live ingestion: accepting batches once, in order, with a cursor, as a batch fold and as a stateful stream.

Both run the same step, so a stream can be checked against a rerun over the log. The state of a scope is
one small record. The hash of every accepted batch is kept, however late its retry comes: in the fold in a
dictionary, in the stream as one entry a batch of keyed map state, of which only what a batch asks for is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, MutableMapping
from dataclasses import asdict, dataclass, field, replace
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import codec as C
from tidemark.functions import domains as D

ACKS = "scope string, arrival long, session string, batch_sequence long, sequence long, status int, cursor long, next_count long, digest string, entry_hash string"
#: Frames that a fold holds as Python values at once.
ROWS = 256
(ADVANCED, SAME, DUPLICATE, DENSE, UNRESOLVED, _, _, CONFLICT, LEASED) = range(1, 10)


def check_hello(hello: dict, identity: dict[str, str]) -> None:
    """Raise unless a producer names itself and its symbol, in the known schema, and is the one that identity (of any fields) expects."""
    if not all(hello[n] for n in ("producer_instance_id", "producer_session_id", "exact_source_symbol")) or hello["source_schema_id"] != D.SCHEMA_ID:
        raise C.FormatError("INVALID_FIELD", "producer, symbol or schema")
    if wrong := [n for n, want in identity.items() if want and hello[n] != want]:
        raise C.FormatError("INVALID_FIELD", f"{wrong[0]} is not the configured one")


@dataclass
class State:
    """What a gateway knows of a scope between batches."""

    cursor: int = 0
    digest: str = D.ZERO.hex()
    count: int = 128
    default_count: int = 128
    cap: int = 4096
    sequence: int = 0
    entry_hash: str = D.ZERO.hex()
    session: str = ""
    lease_until: int = 0
    lease_s: int = 30
    generation: int = 0
    accepted: MutableMapping[str, str] = field(default_factory=dict)

    def outcome(self, batch: dict) -> int:
        """Move the cursor for a batch that is new, and give its status."""
        records = batch["records"]
        if batch["copy_ticks_error"] or batch["returned_count"] < 0 or not records:
            return SAME
        newest = max(r["time_msc"] for r in records)
        if newest < self.cursor:
            return SAME
        full = batch["returned_count"] == batch["requested_count"] > 0
        if newest == self.cursor and full:  # a page full of one millisecond: ask for more, nothing is settled yet
            asked = max(self.count, batch["requested_count"])
            self.count = self.cap if asked >= self.cap else min(2 * asked, self.cap)
            return UNRESOLVED if asked >= self.cap else DENSE
        before = D.ZERO if newest > self.cursor else bytes.fromhex(self.digest)
        prints = [C.payload_fingerprint(r) for r in records if r["time_msc"] == newest]
        status = ADVANCED if newest > self.cursor else SAME
        self.cursor, self.digest, self.count = newest, C.boundary_digest(newest, before, prints).hex(), self.default_count
        return status

    def lease(self, session: str, now: int) -> bool:
        """Whether the session holds the scope: it does already, or nobody does any more."""
        if session != self.session and now < self.lease_until:
            return False
        self.session, self.lease_until = session, now + self.lease_s
        return True

    def resume(self, hello: dict, identity: dict[str, str], now: int, gateway: str, lease: str) -> tuple[dict[str, Any], int]:
        """The RESUME message for a producer's HELLO, and the generation of its session: an earlier generation's late release does nothing.

        It says what is durable of the session's batches and where to go on.
        """
        check_hello(hello, identity)
        session = hello["producer_session_id"]
        if not self.lease(session, now):
            raise C.FormatError("SESSION_LEASE_CONFLICT", "another session is active")
        self.generation = self.generation % (2**64 - 1) + 1
        last = self.accepted[f"{session}/"] if f"{session}/" in self.accepted else ""
        number, own = last.split(":") if last else ("0", D.ZERO.hex())
        message = {
            "accepted_protocol_version": 1, "gateway_instance_id": gateway, "session_lease_id": lease, "committed_cursor_msc": self.cursor, "committed_boundary_digest": bytes.fromhex(self.digest),
            "last_durable_batch_sequence": int(number), "last_durable_batch_hash": bytes.fromhex(own), "next_from_msc": self.cursor, "next_requested_count": self.count, "maximum_frame_bytes": D.MAX_FRAME,
            "maximum_records": D.MAX_RECORDS, "heartbeat_idle_timeout_ms": 1000 * self.lease_s,
        }
        return message, self.generation

    def release(self, session: str, generation: int) -> bool:
        """End a session's lease, if it is still the one of that generation."""
        if (session, generation) != (self.session, self.generation):
            return False
        self.session, self.lease_until = "", 0
        return True

    def accept(self, frame: bytes, now: int) -> dict[str, Any]:
        """Take one batch frame: retries of equal bytes are acknowledged again, different bytes of one number are a conflict."""
        _, batch = C.decode_message(frame)
        key, own = f"{batch['producer_session_id']}/{batch['batch_sequence']}", C.batch_hash(frame).hex()
        if not self.lease(batch["producer_session_id"], now):
            status = LEASED
        elif key in self.accepted:
            status = DUPLICATE if self.accepted[key] == own else CONFLICT
        else:
            status = self.outcome(batch)
            self.accepted[key] = own
            self.accepted[f"{batch['producer_session_id']}/"] = f"{batch['batch_sequence']}:{own}"  # the session's last one, for resume
            self.sequence += 1
            self.entry_hash = C.entry_hash(self.sequence, bytes.fromhex(self.entry_hash), now, 0, bytes.fromhex(own), frame).hex()
        return {"session": batch["producer_session_id"], "batch_sequence": batch["batch_sequence"], "sequence": self.sequence, "status": status, "cursor": self.cursor, "next_count": self.count, "digest": self.digest, "entry_hash": self.entry_hash}


def fold(frames: pd.DataFrame, state: State) -> pd.DataFrame:
    rows = [{"scope": r.scope, "arrival": r.arrival} | state.accept(bytes(r.frame), int(r.now)) for r in frames.sort_values("arrival").itertuples()]
    return pd.DataFrame(rows, columns=[x.split()[0] for x in ACKS.split(", ")])


def folded(scope: str, batches: Iterator[pa.RecordBatch], state: State) -> Iterator[pa.RecordBatch]:
    """Acknowledgements of a scope's frames, which are read in order of arrival as a stream; besides the state no more than ROWS of them are held."""
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ACKS.split(", "))])
    for batch in (some.slice(k, ROWS) for some in batches for k in range(0, some.num_rows, ROWS)):
        rows = zip(*(batch.column(c).to_pylist() for c in ("arrival", "now", "frame")), strict=True)
        yield pa.RecordBatch.from_pylist([{"scope": scope, "arrival": arrival} | state.accept(frame, now) for arrival, now, frame in rows], schema=schema)


def acknowledge(frames: DataFrame, **start: int) -> DataFrame:
    """Acknowledgements of frames (scope, arrival, now, frame), each scope folded in order of arrival."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from folded(key[0].as_py(), batches, State(**start))

    rows = frames.select("scope", "arrival", "now", "frame").repartition("scope").sortWithinPartitions("scope", "arrival")
    return rows.groupBy("scope").applyInArrow(run, ACKS)


class Hashes(MutableMapping):
    """Hashes of accepted batches in the map state of a stream."""

    def __init__(self, state: Any) -> None:
        self.state = state

    def __contains__(self, key: object) -> bool:
        return self.state.containsKey((key,))

    def __getitem__(self, key: str) -> str:
        if key not in self:
            raise KeyError(key)
        return self.state.getValue((key,))[0]

    def __setitem__(self, key: str, value: str) -> None:
        self.state.updateValue((key,), (value,))

    def __delitem__(self, key: str) -> None:
        self.state.removeKey((key,))

    def __iter__(self) -> Iterator[str]:
        return (key for (key,) in self.state.keys())

    def __len__(self) -> int:
        return sum(1 for _ in self)


class Gateway(StatefulProcessor):
    """The step of a stream: the small record of a scope is read and written whole, hashes one by one."""

    def __init__(self, start: dict[str, int]) -> None:
        self.start = start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.record = handle.getValueState("record", "state string")
        self.hashes = handle.getMapState("accepted", "batch string", "hash string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        own = State(**json.loads(self.record.get()[0]) if self.record.exists() else self.start)
        own.accepted = Hashes(self.hashes)
        yield fold(pd.concat(list(rows)), own)
        fields = asdict(replace(own, accepted={}))
        del fields["accepted"]
        self.record.update((json.dumps(fields),))

    def close(self) -> None:
        pass


def acknowledge_stream(frames: DataFrame, **start: int) -> DataFrame:
    """The same of a stream; the state of a scope survives in the stream's checkpoint. Sets the session's state store to RocksDB, which keyed map state needs."""
    frames.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return frames.groupBy("scope").transformWithStateInPandas(Gateway(start), ACKS, "append", "None")


def metrics(acks: DataFrame) -> DataFrame:
    """Number of acknowledgements of each status."""
    names = F.create_map(*(F.lit(x) for k, n in enumerate(D.STATUSES, 1) for x in (k, n)))
    return acks.groupBy(F.element_at(names, F.col("status")).alias("status")).count()


def recovered(entries: DataFrame, **start: int) -> DataFrame:
    """The journal as the log alone gives it: when it and the stored one differ, this one is right."""
    frames = entries.select(F.col("scope"), F.col("sequence").cast("long").alias("arrival"), F.col("receive_wall_s").alias("now"), "frame")
    return acknowledge(frames, **start)


def revisions_of(ticks: DataFrame, revisions_path: str, days: DataFrame) -> DataFrame:
    """New revisions of the days that a micro-batch touched, late records included; for foreachBatch.

    ticks is the whole log so far, of which only the touched days are read.
    """
    from tidemark.operators import selection

    spark = ticks.sparkSession
    known = spark.read.parquet(revisions_path)
    now = selection.day_selection(ticks.join(days.select("day").distinct(), "day", "left_semi"))
    now = now.withColumn("digest", F.sha2(F.to_json(F.struct(*sorted(now.columns))), 256))
    columns = [c for c in now.columns if c not in ("day", "digest")]
    return selection.next_revisions(now, known, ["day"], columns)


def segment_groups(entries: DataFrame, max_bytes: int, max_age_s: int | None = None) -> DataFrame:
    """entries (scope, sequence, bytes, wall_s) with the number of the segment in which they are sealed.

    A segment closes after the first entry with which it has max_bytes, or before one that comes max_age_s or later after its first
    one; the last stays open until it is sealed by force. Each cut depends on the one before it, so a scope is one group, which is read in order as a stream.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total, opened = 0, 0, None
        for batch in batches:
            out = []
            for size, wall in zip(batch.column("bytes").to_pylist(), batch.column("wall_s").to_pylist(), strict=True):
                if opened is not None and (total >= max_bytes or max_age_s is not None and wall - opened >= max_age_s):
                    number, total, opened = number + 1, 0, None
                opened = wall if opened is None else opened
                total += size
                out.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "segment"])

    rows = entries if "wall_s" in entries.columns else entries.withColumn("wall_s", F.lit(0).cast("long"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.repartition("scope").sortWithinPartitions("scope", "sequence").groupBy("scope").applyInArrow(run, f"{schema}, segment long").select(*entries.columns, "segment")
