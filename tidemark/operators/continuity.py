"""The continuity reducer: overlapping polls become one replay stream in which nothing is lost in silence.

A day's batches are read in log order. Records that provably repeat the end of what was emitted are left
out; whatever cannot be proven starts a new segment with a marker row that says why. All rows, markers
included, are numbered and bound by a hash chain. A day of a scope is one group: chains of different days
and scopes run in parallel.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.functions import codec as C
from tidemark.functions import domains as D

REPLAY = "scope string, day string, stream_sequence long, row_kind int, code string, detail string, segment string, sequence long, ordinal long, time_msc long, fingerprint binary, canonical_bytes long, previous_row_chain_hash string, row_chain_hash string, part_sequence long"

# The details of markers, which are part of what is hashed.
FIRST = "first accepted source occurrence"
GAP = "producer batch sequence gap"
ERROR = "copy_ticks_error={}"
BACK = "source time_msc moved backwards"
CHANGED = "one changed payload has exact surrounding fingerprint evidence"
NONE = "no uniquely provable suffix/prefix overlap"
MANY = "longest suffix/prefix candidate has multiple positions"


def borders(items: list) -> list[int]:
    """At each place the length of the longest proper prefix of items that ends there."""
    out, n = [0] * len(items), 0
    for k in range(1, len(items)):
        while n and items[k] != items[n]:
            n = out[n - 1]
        n += items[k] == items[n]
        out[k] = n
    return out


def overlap(tail: list, new: list) -> tuple[int, bool]:
    """How many of the new records repeat the tail's end: the longest match, and whether it also fits elsewhere in the tail. One pass over both."""
    if not tail or not new:
        return 0, False
    stop = object()  # equals no record
    ends = borders([*new, stop, *tail])[len(new) + 1 :]
    n = ends[-1]
    if not n:
        return 0, False
    inside = borders([*new[:n], stop, *tail])[n + 1 :]
    return (n, False) if inside.count(n) == 1 else (0, True)


def agreement(pattern: list, items: list) -> list[int]:
    """At each place of items how many records from there on agree with the beginning of pattern. One pass over both."""
    every = [*pattern, object(), *items]
    out, left, right = [0] * len(every), 0, 0
    for k in range(1, len(every)):
        n = min(right - k, out[k - left]) if k < right else 0
        while k + n < len(every) and every[n] == every[k + n]:
            n += 1
        out[k] = n
        if k + n > right:
            left, right = k, k + n
    return out[len(pattern) + 1 :]


def history_change(tail: list, new: list) -> int | None:
    """The place in the tail of a record that was altered since: the tail's end and the new start agree but for one inner record, and nowhere else.

    Two stretches of n records differ in exactly one if they agree up to it and after it for n - 1 records together. The longest such
    n is found, and where else it fits, by how far stretches agree from both ends, in one pass each.
    """
    known: dict = {}
    a, b = ([known.setdefault(x, len(known)) for x in some] for some in (tail, new))
    most = min(len(a), len(b))
    ahead = agreement(b, a)  # of the tail from each place on, with the beginning of the new ones
    back = agreement(a[::-1], b[::-1])  # of the new ones before each place, with the tail's end
    for n in range(most, 2, -1):
        at = ahead[len(a) - n]
        if 0 < at < n - 1 and at + back[len(b) - n] == n - 1:
            behind = agreement(b[:n][::-1], a[::-1])
            alike = sum(0 < min(ahead[j], n) < n - 1 and ahead[j] + min(behind[len(a) - j - n], n) == n - 1 for j in range(len(a) - n + 1))
            return len(a) - n + at if alike == 1 else None
    return None


@dataclass
class Reducer:
    """The state of one scope and day. feed() takes a batch and gives the rows that it adds."""

    scope: dict[str, Any]
    identity: dict[str, str]
    max_records: int = D.MAX_RECORDS
    rows: int = 0
    markers: int = 0
    segment: str = ""
    root: bytes = D.ZERO
    tail: list[bytes] = field(default_factory=list)
    places: list[dict] = field(default_factory=list)
    last: dict | None = None
    session: str | None = None
    batch: int = 0

    def _emit(self, row: dict, marker: bool) -> dict:
        data = C.row_bytes(self.scope, self.rows, self.segment, row, marker)
        before, self.root = self.root, C.chain_step(self.rows, self.root, data)
        out = row | {"stream_sequence": self.rows, "row_kind": 2 if marker else 1, "segment": self.segment, "canonical_bytes": len(data), "previous": before, "hash": self.root}
        self.rows += 1
        self.markers += marker
        return out

    def _mark(self, code: str, detail: str, batch: dict, reference: dict | None) -> dict:
        at = reference or {"gateway_ingest_sequence": batch["gateway_ingest_sequence"], "record_ordinal": 0}
        sequence, ordinal = at["gateway_ingest_sequence"], at["record_ordinal"]
        self.segment = C.segment_id(self.scope, sequence, ordinal, code, self.root)
        self.tail, self.places, self.last = [], [], None
        mark = {"marker_code": code, "reason": D.MARKERS[code], "marker_detail": detail, "reference_gateway_ingest_sequence": sequence, "reference_record_ordinal": ordinal, "predecessor_row_chain_hash": self.root, "continuity_segment_start_hash": self.root}
        return self._emit(mark | {k: batch[k] for k in ("raw_object_key", "raw_object_sha256")}, True)

    def feed(self, batch: dict, ordinals: list[int]) -> Iterator[dict]:
        """batch: the fields of a batch message, gateway_ingest_sequence, raw_object_key and raw_object_sha256; ordinals: the selected records."""
        own = {"producer_instance_id": self.identity["producer_instance_id"], "producer_session_id": batch["producer_session_id"]}
        lease = C.lease_id(own["producer_instance_id"], own["producer_session_id"], *(self.identity[k] for k in ("provider_id", "stable_feed_id", "broker_server_fingerprint", "exact_source_symbol")))
        if batch["source_schema_id"] != D.SCHEMA_ID or not own["producer_session_id"] or batch["session_lease_id"] != lease:
            raise C.FormatError("INVALID_FIELD", f"entry {batch['gateway_ingest_sequence']}: schema, session or lease")
        if not ordinals or len(batch["records"]) > self.max_records:
            raise C.FormatError("INVALID_FIELD", f"entry {batch['gateway_ingest_sequence']}: nothing selected or too many records")
        if self.session is None:
            yield self._mark("SEGMENT_START", FIRST, batch, None)
        elif self.session == own["producer_session_id"] and batch["batch_sequence"] != self.batch + 1:
            yield self._mark("GAP", GAP, batch, self.last)
        self.session, self.batch = own["producer_session_id"], batch["batch_sequence"]
        new = []
        for k in ordinals:
            if k < len(batch["records"]):
                new.append(batch["records"][k] | {"record_ordinal": k, "source_payload_fingerprint": C.payload_fingerprint(batch["records"][k])})
            elif batch["records"] or k:
                raise C.FormatError("INVALID_FIELD", f"entry {batch['gateway_ingest_sequence']}: no record {k}")
        if batch["copy_ticks_error"]:
            yield self._mark("SOURCE_ERROR", ERROR.format(batch["copy_ticks_error"]), batch, self.last)
            return
        if not new:
            return
        if self.last and new[0]["time_msc"] < self.last["time_msc"]:
            yield self._mark("TIMESTAMP_REGRESSION", BACK, batch, self.last)
        prints, skip = [r["source_payload_fingerprint"] for r in new], 0
        altered = history_change(self.tail, prints)
        if altered is not None and self.last:
            yield self._mark("SOURCE_HISTORY_CHANGED", CHANGED, batch, self.places[altered])
        else:
            skip, many = overlap(self.tail, prints)
            if many or not skip and self.tail:
                yield self._mark("AMBIGUOUS_OVERLAP", MANY if many else NONE, batch, self.last)
                skip = 0
        common = own | {k: batch[k] for k in ("raw_object_key", "raw_object_sha256", "gateway_ingest_sequence", "batch_sequence", "fetch_wall_start_s", "fetch_wall_end_s", "fetch_monotonic_start_us", "fetch_monotonic_end_us", "copy_ticks_error", "source_status_flags")}
        for r in new[skip:]:
            seen = C.observation_hash(common["producer_instance_id"], common["producer_session_id"], common["batch_sequence"], r["record_ordinal"], r["capture_sequence"], r["source_payload_fingerprint"])
            row = common | r | {"observation_hash": seen}
            yield self._emit(row, False)
            self.last = row
            self.tail.append(r["source_payload_fingerprint"])
            self.places.append({"gateway_ingest_sequence": row["gateway_ingest_sequence"], "record_ordinal": row["record_ordinal"]})
        del self.tail[: -self.max_records], self.places[: -self.max_records]


def pack(sizes: Iterable[int], max_rows: int, max_bytes: int) -> Iterator[int]:
    """The part of each row: a part is cut before a row that would pass either limit; a row above the limit alone is an error."""
    part, rows, total = 0, 0, 0
    for size in sizes:
        if size > max_bytes:
            raise C.FormatError("INVALID_FIELD", "a row is larger than a part")
        if rows and (rows >= max_rows or total + size > max_bytes):
            part, rows, total = part + 1, 0, 0
        rows, total = rows + 1, total + size
        yield part


def replay(batches: DataFrame, scope: dict[str, Any], identity: dict[str, str], max_rows: int = 1_000_000, max_bytes: int = 1 << 30) -> DataFrame:
    """The replay stream of batches (scope, day, sequence, frame, raw_object_key, raw_object_sha256, ordinals), packed into parts.

    scope and identity are what all groups share; dataset and date are those of the group.
    """

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict[str, Any]] = []
        part, rows, total = 0, 0, 0
        for own, x in reduced(group, scope, identity):
            size = x["canonical_bytes"]
            if size > max_bytes:
                raise C.FormatError("INVALID_FIELD", "a row is larger than a part")
            if rows and (rows >= max_rows or total + size > max_bytes):
                part, rows, total = part + 1, 0, 0
            rows, total = rows + 1, total + size
            out.append(
                {
                    "scope": own["dataset_id"], "day": own["date"], "stream_sequence": x["stream_sequence"], "row_kind": x["row_kind"], "code": x.get("marker_code"), "detail": x.get("marker_detail"), "segment": x["segment"],
                    "sequence": x.get("gateway_ingest_sequence", x.get("reference_gateway_ingest_sequence")), "ordinal": x.get("record_ordinal", x.get("reference_record_ordinal")), "time_msc": x.get("time_msc"),
                    "fingerprint": x.get("source_payload_fingerprint"), "canonical_bytes": size, "previous_row_chain_hash": x["previous"].hex(), "row_chain_hash": x["hash"].hex(), "part_sequence": part,
                }
            )
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=ARROW)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=ARROW)

    return in_order(batches).groupBy("scope", "day").applyInArrow(run, REPLAY)


def in_order(batches: DataFrame) -> DataFrame:
    """Batches dealt by scope and day, each in log order: a group can then be read as a stream, whatever its length."""
    return batches.repartition("scope", "day").sortWithinPartitions("scope", "day", "sequence")


def reduced(group: Iterator[pa.RecordBatch], scope: dict[str, Any], identity: dict[str, str]) -> Iterator[tuple[dict[str, Any], dict[str, Any]]]:
    """The scope and the rows of one group's batches, which come in log order; nothing but the reducer's state is kept."""
    own, reducer, last = None, None, None
    for batch in group:
        for start in range(0, batch.num_rows, 64):
            for r in batch.slice(start, 64).to_pylist():
                if own is None:
                    own = scope | {"dataset_id": r["scope"], "date": r["day"]}
                    reducer = Reducer(own, identity)
                if last is not None and r["sequence"] < last:
                    raise C.FormatError("INVALID_FIELD", "batches out of order")
                last = r["sequence"]
                _, message = C.decode_message(r["frame"])
                for row in reducer.feed(message | {"gateway_ingest_sequence": r["sequence"], "raw_object_key": r["raw_object_key"], "raw_object_sha256": r["raw_object_sha256"]}, r["ordinals"]):
                    yield own, row


KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
ARROW = pa.schema([(x.split()[0], KINDS[x.split()[1]]) for x in REPLAY.split(", ")])


def summary(stream: DataFrame) -> DataFrame:
    """Rows, markers, segments and root of each scope and day."""
    from pyspark.sql import functions as F

    return stream.groupBy("scope", "day").agg(
        F.count("*").alias("rows"), F.count(F.when(F.col("row_kind") == 2, 1)).alias("markers"), F.count_distinct("segment").alias("segments"), F.max_by("segment", "stream_sequence").alias("last_segment"), F.max_by("row_chain_hash", "stream_sequence").alias("root")
    )
