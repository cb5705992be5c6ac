"""Bytes of frames, messages, replay rows and canonical JSON, in Python.

Each message is declared once as a list of (name, kind); one encoder and one decoder walk the list.
Unsigned 64-bit values are Python integers; floats never occur, prices travel as their bit patterns.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
from typing import Any

import numpy as np

from tidemark.functions import domains as D


class FormatError(ValueError):
    """Bytes that the format rejects; code is one of domains.ERRORS."""

    def __init__(self, code: str, detail: str = ""):
        super().__init__(f"{code}: {detail}" if detail else code)
        self.code = code


#: Bytes that one step of the checksum takes.
CRC_BLOCK = 4096


@functools.cache
def _crc_table() -> np.ndarray:
    """At k * 256 + b what byte b adds to the checksum when k bytes of its block come before it."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(0x82F63B78), one >> 1)
    rows = [one]
    while len(rows) < CRC_BLOCK:
        rows.append(one[rows[-1] & 255] ^ rows[-1] >> 8)
    return np.concatenate(rows[::-1])


CRC_PLACES = np.arange(CRC_BLOCK) * 256
SCALARS = {"u8": "<B", "u16": "<H", "u32": "<I", "u64": "<Q", "i32": "<i", "i64": "<q"}
#: The fields of a record, in order.
RECORD = [("time", "i64"), ("bid_bits", "u64"), ("ask_bits", "u64"), ("last_bits", "u64"), ("volume", "u64"), ("time_msc", "i64"), ("flags", "u32"), ("volume_real_bits", "u64"), ("capture_sequence", "u64")]
#: The fields of each message, in order.
MESSAGES: dict[str, list[tuple[str, Any]]] = {
    "HELLO": [
        *((n, "str") for n in ("producer_instance_id", "producer_session_id", "producer_build_id", "mql_compiler_build", "terminal_build", "os_contract", "clock_api_id", "provider_id", "stable_feed_id", "broker_server_fingerprint", "exact_source_symbol", "source_schema_id")),
        ("acquisition_mode", "u8"), ("initial_from_msc", "i64"), ("capability_flags", "u32"),
    ],
    "RESUME": [
        ("accepted_protocol_version", "u16"), ("gateway_instance_id", "str"), ("session_lease_id", "str"), ("committed_cursor_msc", "i64"), ("committed_boundary_digest", "h32"), ("last_durable_batch_sequence", "u64"),
        ("last_durable_batch_hash", "h32"), ("next_from_msc", "i64"), ("next_requested_count", "u32"), ("maximum_frame_bytes", "u32"), ("maximum_records", "u32"), ("heartbeat_idle_timeout_ms", "u32"),
    ],
    "BATCH": [
        ("session_lease_id", "str"), ("producer_session_id", "str"), ("batch_sequence", "u64"), ("requested_from_msc", "i64"), ("requested_count", "u32"), ("fetch_wall_start_s", "i64"), ("fetch_wall_end_s", "i64"),
        ("fetch_monotonic_start_us", "u64"), ("fetch_monotonic_end_us", "u64"), ("returned_count", "i32"), ("copy_ticks_error", "i32"), ("source_status_flags", "u32"), ("source_schema_id", "str"), ("records", "records"),
    ],
    "ACK": [
        ("producer_session_id", "str"), ("batch_sequence", "u64"), ("gateway_batch_sha256", "h32"), ("gateway_ingest_sequence", "u64"), ("status", "u8"), ("committed_cursor_msc", "i64"), ("committed_boundary_digest", "h32"),
        ("next_from_msc", "i64"), ("next_requested_count", "u32"), ("retry_after_ms", "u32"),
    ],
    "ERROR": [("code", "u16"), ("retryable", "u8"), ("related_message_type", "u16"), ("related_batch_sequence", "u64"), ("message", "str")],
}


def crc32c(data: bytes) -> int:
    """CRC-32C (Castagnoli), not the polynomial of zlib. It is linear: each byte adds what its distance from the end of its block says."""
    table, state, n = _crc_table(), 0xFFFFFFFF, len(data)
    at = 0
    while at < n:
        stop = min(n, at + ((n - at) % CRC_BLOCK or CRC_BLOCK))
        block = np.frombuffer(data, np.uint8, stop - at, at).astype(np.int64)
        first = min(4, len(block))
        block[:first] ^= np.frombuffer(struct.pack("<I", state), np.uint8)[:first]
        added = int(np.bitwise_xor.reduce(table[CRC_PLACES[CRC_BLOCK - len(block) :] + block]))
        state = added if first == 4 else added ^ state >> 8 * first
        at = stop
    return state ^ 0xFFFFFFFF


def sha(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()


def u32(x: int) -> bytes:
    return struct.pack("<I", x)


def u64(x: int) -> bytes:
    return struct.pack("<Q", x)


def i64(x: int) -> bytes:
    return struct.pack("<q", x)


def lp(text: str) -> bytes:
    """A string after its length in two bytes."""
    data = text.encode()
    if len(data) > D.MAX_STRING:
        raise FormatError("INVALID_FIELD", "string too long")
    return struct.pack("<H", len(data)) + data


class Reader:
    """Takes fields from bytes and rejects what ends early."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise FormatError("INVALID_FIELD", "field ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def field(self, kind: str) -> Any:
        if kind in SCALARS:
            return struct.unpack(SCALARS[kind], self.take(struct.calcsize(SCALARS[kind])))[0]
        if kind == "h32":
            return self.take(32)
        if kind == "str":
            n = self.field("u16")
            if n > D.MAX_STRING:
                raise FormatError("INVALID_FIELD", "string too long")
            try:
                return self.take(n).decode()
            except UnicodeDecodeError as bad:
                raise FormatError("INVALID_FIELD", "string is not UTF-8") from bad
        n = self.field("u32")
        if n > D.MAX_RECORDS:
            raise FormatError("INVALID_FIELD", "too many records")
        return [{name: self.field(k) for name, k in RECORD} for _ in range(n)]


def _encoded(value: Any, kind: str) -> bytes:
    if kind in SCALARS:
        return struct.pack(SCALARS[kind], value)
    if kind == "h32":
        return value
    if kind == "str":
        return lp(value)
    return u32(len(value)) + b"".join(_encoded(r[name], k) for r in value for name, k in RECORD)


def _checked(kind: str, message: dict) -> dict:
    if kind == "BATCH" and len(message["records"]) != max(0, message["returned_count"]):
        raise FormatError("INVALID_FIELD", "record count differs from returned count")
    allowed = {"HELLO": ("acquisition_mode", range(1, 3)), "RESUME": ("accepted_protocol_version", range(1, 2)), "ACK": ("status", range(1, len(D.STATUSES) + 1)), "ERROR": ("retryable", range(2))}
    if kind in allowed and message[allowed[kind][0]] not in allowed[kind][1]:
        raise FormatError("INVALID_FIELD", allowed[kind][0])
    if kind == "ERROR" and not 1 <= message["code"] <= len(D.ERRORS):
        raise FormatError("INVALID_FIELD", "code")
    return message


def encode_message(kind: str, message: dict) -> bytes:
    """The frame of a message."""
    payload = b"".join(_encoded(_checked(kind, message)[name], k) for name, k in MESSAGES[kind])
    length = D.HEADER + len(payload) + 4
    if length > D.MAX_FRAME:
        raise FormatError("OVERSIZED_FRAME")
    head = struct.pack("<4sHHII", b"TICK", 1, D.MESSAGES.index(kind) + 1, length, D.HEADER) + payload
    return head + u32(crc32c(head))


def frame_error(frame: bytes) -> str | None:
    """The first reason to reject a frame, in the fixed order of checks; None for a valid one."""
    if len(frame) < D.HEADER:
        return "TRUNCATED_FRAME"
    magic, version, kind, length, header = struct.unpack("<4sHHII", frame[: D.HEADER])
    checks = (
        (length > D.MAX_FRAME, "OVERSIZED_FRAME"),
        (length < D.HEADER + 4, "INVALID_FRAME"),
        (len(frame) < length, "TRUNCATED_FRAME"),
        (len(frame) > length, "INVALID_FRAME"),
        (magic != b"TICK", "INVALID_FRAME"),
        (header != D.HEADER, "INVALID_FRAME"),
        (version != 1, "UNSUPPORTED_PROTOCOL_VERSION"),
        (not 1 <= kind <= len(D.MESSAGES), "UNKNOWN_MESSAGE_TYPE"),
    )
    for bad, code in checks:
        if bad:
            return code
    return None if crc32c(frame[:-4]) == struct.unpack("<I", frame[-4:])[0] else "CRC_MISMATCH"


def decode_message(frame: bytes) -> tuple[str, dict]:
    """The kind and the fields of a frame's message; bytes left over are rejected, and so is what does not encode to the same bytes."""
    if code := frame_error(frame):
        raise FormatError(code)
    kind = D.MESSAGES[struct.unpack("<H", frame[6:8])[0] - 1]
    reader = Reader(frame[D.HEADER : -4])
    message = {name: reader.field(k) for name, k in MESSAGES[kind]}
    if reader.at != len(reader.data):
        raise FormatError("INVALID_FIELD", "bytes after the message")
    return kind, _checked(kind, message)


def live_length(header: bytes) -> int:
    """The length of the frame that a stream's next 16 bytes announce; too short is rejected before too long."""
    length = struct.unpack("<I", header[8:12])[0]
    if length < D.HEADER + 4:
        raise FormatError("INVALID_FRAME")
    if length > D.MAX_FRAME:
        raise FormatError("OVERSIZED_FRAME")
    return length


def payload_fingerprint(record: dict) -> bytes:
    """Identity of a tick's content; capture_sequence is left out."""
    return sha(D.PAYLOAD, lp(D.SCHEMA_ID), *(_encoded(record[n], k) for n, k in RECORD[:-1]))


def observation_hash(producer: str, session: str, batch: int, ordinal: int, capture: int, fingerprint: bytes) -> bytes:
    return sha(D.OBSERVATION, lp(producer), lp(session), u64(batch), u32(ordinal), u64(capture), fingerprint)


def batch_hash(frame: bytes) -> bytes:
    return sha(D.BATCH, frame)


def entry_hash(sequence: int, previous: bytes, wall_s: int, mono_us: int, batch: bytes, frame: bytes) -> bytes:
    return sha(D.WAL_ENTRY, u64(sequence), previous, i64(wall_s), u64(mono_us), batch, frame)


def boundary_digest(cursor: int, previous: bytes, fingerprints: list[bytes]) -> bytes:
    return sha(D.BOUNDARY, i64(cursor), previous, u32(len(fingerprints)), *fingerprints)


def lease_id(*identity: str) -> str:
    """Of producer instance, session, provider, feed, broker fingerprint and symbol."""
    return "lease-" + sha(b"\0".join([D.LEASE, *(x.encode() for x in identity)])).hex()[:32]


SCOPE = ("dataset_id", "day_definition_id", "date", "replay_contract_id", "conversion_id")
#: The fields of a replay row of a tick and of a marker, in order.
DATA = [
    ("raw_object_key", "str"), ("raw_object_sha256", "h32"), ("gateway_ingest_sequence", "u64"), ("producer_instance_id", "str"), ("producer_session_id", "str"), ("batch_sequence", "u64"), ("record_ordinal", "u32"),
    ("capture_sequence", "u64"), *RECORD[:-1], ("source_payload_fingerprint", "h32"), ("observation_hash", "h32"), ("fetch_wall_start_s", "i64"), ("fetch_wall_end_s", "i64"),
    ("fetch_monotonic_start_us", "u64"), ("fetch_monotonic_end_us", "u64"), ("copy_ticks_error", "i32"), ("source_status_flags", "u32"),
]
MARK = [("marker_code", "str"), ("reason", "str"), ("marker_detail", "str"), ("reference_gateway_ingest_sequence", "u64"), ("reference_record_ordinal", "u32"), ("predecessor_row_chain_hash", "h32"), ("continuity_segment_start_hash", "h32")]


def segment_id(scope: dict, sequence: int, ordinal: int, code: str, predecessor: bytes) -> str:
    return sha(D.SEGMENT, *(lp(scope[n]) for n in SCOPE), lp(scope["raw_day_manifest_key"]), scope["raw_day_manifest_sha256"], u64(sequence), u32(ordinal), lp(code), predecessor).hex()


def row_bytes(scope: dict, sequence: int, segment: str, row: dict, marker: bool) -> bytes:
    """Canonical bytes of a replay row, of a tick or of a marker."""
    head = D.ROW + bytes([2 if marker else 1]) + u64(sequence) + b"".join(lp(scope[n]) for n in SCOPE) + lp(segment) + scope["raw_day_manifest_sha256"]
    if not marker:
        return head + b"".join(_encoded(row[n], k) for n, k in DATA)
    if D.MARKERS.get(row["marker_code"]) != row["reason"]:
        raise FormatError("INVALID_FIELD", "marker code and reason")
    if (row["raw_object_key"] == "") != (row["raw_object_sha256"] == D.ZERO):
        raise FormatError("INVALID_FIELD", "raw evidence is key and hash, or neither")
    return head + lp(row["raw_object_key"]) + row["raw_object_sha256"] + D.MARKER + b"".join(_encoded(row[n], k) for n, k in MARK)


def chain_step(sequence: int, previous: bytes, row: bytes) -> bytes:
    return sha(D.ROW_CHAIN, u64(sequence), previous, u32(len(row)), row)


def canonical_json(value: Any) -> bytes:
    """Sorted keys, integers only, no white space, ASCII with lower-case escapes."""

    def check(x: Any) -> None:
        if isinstance(x, bool) or x is None or isinstance(x, str):
            return
        if isinstance(x, int):
            if not -(2**63) <= x < 2**64:
                raise FormatError("INVALID_FIELD", "integer out of range")
        elif isinstance(x, dict):
            for k, v in x.items():
                if not isinstance(k, str):
                    raise FormatError("INVALID_FIELD", "key is not a string")
                check(v)
        elif isinstance(x, (list, tuple)):
            for v in x:
                check(v)
        else:
            raise FormatError("INVALID_FIELD", f"{type(x).__name__} has no canonical form")

    check(value)
    # keys are ordered by their UTF-8 bytes, which is the order of their code points
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()


def parse_canonical(data: bytes, keys: set[str] | None = None) -> Any:
    """Strict decoding: duplicate or unknown keys, floats and bytes that are not canonical are rejected."""

    def pairs(items: list[tuple[str, Any]]) -> dict:
        if len({k for k, _ in items}) != len(items):
            raise FormatError("INVALID_FIELD", "duplicate key")
        return dict(items)

    def refuse(text: str) -> Any:
        raise FormatError("INVALID_FIELD", f"number {text}")

    try:
        value = json.loads(data.decode("utf-8"), object_pairs_hook=pairs, parse_float=refuse, parse_constant=refuse)
    except FormatError:
        raise
    except ValueError as bad:
        raise FormatError("INVALID_FIELD", str(bad)) from bad
    if canonical_json(value) != data:
        raise FormatError("INVALID_FIELD", "bytes are not canonical")
    if keys is not None and (not isinstance(value, dict) or set(value) != keys):
        raise FormatError("INVALID_FIELD", "keys")
    return value


def digest(domain: bytes, value: Any) -> bytes:
    return sha(domain, canonical_json(value))


def raw_set_root(ranges: list[dict]) -> bytes:
    parts = [r["sha256"] + u64(r["bytes"]) + u64(r["start_ingest_sequence"]) + u64(r["end_ingest_sequence"]) + u32(r["first_record_ordinal"]) + u32(r["last_record_ordinal"]) for r in ranges]
    return sha(D.RAW_SET, u32(len(parts)), *parts)


def part_set_root(parts: list[dict]) -> bytes:
    """Zero for no parts."""
    if not parts:
        return D.ZERO
    return sha(D.PART_SET, u32(len(parts)), *(u32(len(p["key"].encode())) + p["key"].encode() + p["digest"] + u64(p["first_stream_sequence"]) + u64(p["last_stream_sequence"]) for p in parts))
