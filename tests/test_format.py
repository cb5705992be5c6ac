"""Published digests and rejected frames."""

import pytest

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.sources import wal

FRAME = bytes.fromhex(
    "5449434b01000300c6000000100000000a006c656173652d303030310c0073657373696f6e2d303030310800000000000000004cf1238e010000010000008087ec65000000008187ec6500000000a08601000000000094880100000000000100000000000000000000000e00"
    "6d74352e6d716c7469636b2e7631010000008087ec65000000008d976e1283c0f33f6ff085c954c1f33ffe43faedebc0f33f07000000000000007b4cf1238e010000030000000000000000001e402a00000000000000527ebfef"
)
WAL_HEADER = "5457414c0100230001000000000000009095ec650000000000000000050067772d3031"


def batch():
    return C.decode_message(FRAME)


def test_frame_round_trip():
    kind, message = batch()
    assert kind == "BATCH" and message["batch_sequence"] == 8 and message["records"][0]["capture_sequence"] == 42
    assert C.encode_message(kind, message) == FRAME


def test_published_digests():
    record = batch()[1]["records"][0]
    fingerprint = C.payload_fingerprint(record)
    assert fingerprint.hex() == "e8b919341d517820ecafac9745c7e6b1f2f11df979bca0ff8ff8c92f40c5a844"
    assert C.observation_hash("fake-01", "session-0001", 8, 0, 42, fingerprint).hex() == "b4c1e4f378d0e76b961061959c30e82131a7d01d9aed7aaf199f838e4d3eb71c"
    assert C.batch_hash(FRAME).hex() == "1ba4746d2bc8adf2ede232a52522ec7640b6df055efb160d78739525fd364d09"


@pytest.mark.parametrize(
    ("spoil", "code"),
    [
        (lambda f: f[:10], "TRUNCATED_FRAME"),
        (lambda f: f[:16] + bytes([f[16] ^ 1]) + f[17:], "CRC_MISMATCH"),
        (lambda f: f[:4] + b"\x02\x00" + f[6:], "UNSUPPORTED_PROTOCOL_VERSION"),
        (lambda f: f[:6] + b"\x63\x00" + f[8:], "UNKNOWN_MESSAGE_TYPE"),
        (lambda f: f[:8] + (1048577).to_bytes(4, "little") + f[12:], "OVERSIZED_FRAME"),
        (lambda f: f + b"\0", "INVALID_FRAME"),
        (lambda f: b"TOCK" + f[4:], "INVALID_FRAME"),
    ],
)
def test_rejected_frames(spoil, code):
    assert C.frame_error(spoil(FRAME)) == code


@pytest.mark.parametrize("data", [b'{"a":1,"a":2}', b'{"a":1.0}', b'{"b":1,"a":2}', b'{"a": 1}', b'\xef\xbb\xbf{"a":1}', b'{"a":01}', b'{"a":NaN}', b'{"a":18446744073709551616}', '{"a":"é"}'.encode(), b"\xff"])
def test_canonical_json_rejects(data):
    with pytest.raises(C.FormatError):
        C.parse_canonical(data)


def test_canonical_json():
    assert C.canonical_json({"b": [1, None], "a": "é\U0001f600\n"}) == b'{"a":"\\u00e9\\ud83d\\ude00\\n","b":[1,null]}'
    assert C.parse_canonical(b'{"a":18446744073709551615}') == {"a": 2**64 - 1}
    with pytest.raises(C.FormatError):
        C.canonical_json({"a": 1.5})


def writer(n=3):
    own = wal.Writer("gw-01", wall_s=0x65EC9590)
    assert bytes(own.data).hex() == WAL_HEADER
    for k in range(n):
        own.append(FRAME, 1710000000 + k, k)
    return own


def test_segment_round_trip():
    own = writer()
    first = wal.parse(own.seal())
    own.append(FRAME, 1, 1)
    second = wal.parse(own.seal())
    assert [e.sequence for e in first.entries] == [1, 2, 3] and second.start_sequence == 4
    assert second.chain_start == first.chain_root


def test_published_entry_hash_and_crc():
    assert C.crc32c(b"123456789") == 0xE3069283
    assert C.crc32c(FRAME[:-4]).to_bytes(4, "little") == FRAME[-4:]
    # the published trailer of a segment with one entry
    seal = bytes.fromhex("545754520100600001000000000000000100000000000000010000003b9183ff4ead26a1fa20f8b1b0756949901d7ee5772ad8fc336b86f99a8b8b3e8eddc01c06669354e6668da7f1885881e5b990248779e573cd5cbafabfe79c521b71487f")
    root, file_sha = bytes.fromhex("3b9183ff4ead26a1fa20f8b1b0756949901d7ee5772ad8fc336b86f99a8b8b3e"), bytes.fromhex("8eddc01c06669354e6668da7f1885881e5b990248779e573cd5cbafabfe79c52")
    assert wal.trailer(1, 1, 1, root, file_sha) == seal


def test_every_changed_byte_is_found():
    data = writer(1).seal()
    for at in range(0, len(data), 7):
        with pytest.raises((wal.IntegrityError, UnicodeDecodeError)):
            wal.parse(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])


def test_active_segment_may_end_inside_an_entry():
    own = writer()
    assert len(wal.parse(bytes(own.data)[:-5], sealed=False).entries) == 2
    with pytest.raises(wal.IntegrityError):
        wal.parse(own.seal()[:-5])


def test_poisoned_writer_stays_closed():
    own = writer(1)
    with pytest.raises(C.FormatError):
        own.append(b"x", 0, 0)
    own.append(FRAME, 0, 0)
    own.poisoned = True
    with pytest.raises(wal.IntegrityError):
        own.append(FRAME, 0, 0)


def test_lease_is_not_length_prefixed():
    assert C.lease_id("a", "b") != C.lease_id("ab", "") and len(C.lease_id("a", "b")) == 38


def test_roots_of_nothing():
    assert C.part_set_root([]) == D.ZERO


SCOPE = {"dataset_id": "demo", "day_definition_id": "utc-day-v1", "date": "2024-03-09", "replay_contract_id": "replay-v1", "conversion_id": "conversion-v1", "raw_day_manifest_key": "snapshots/raw/day-definition=utc-day-v1/date=2024-03-09/raw-day-1-demo.json", "raw_day_manifest_sha256": b"\x55" * 32}


def test_published_replay_chain():
    segment = C.segment_id(SCOPE, 1, 0, "SEGMENT_START", D.ZERO)
    assert segment == "4e84354e364ae621dc1ff4849b98f099a0246ea24bb84ac2039ae4c2b7a73c60"
    marker = {"raw_object_key": "", "raw_object_sha256": D.ZERO, "marker_code": "SEGMENT_START", "reason": "INITIAL", "marker_detail": "first accepted source occurrence", "reference_gateway_ingest_sequence": 1, "reference_record_ordinal": 0, "predecessor_row_chain_hash": D.ZERO, "continuity_segment_start_hash": D.ZERO}
    record = {"time": 1, "bid_bits": 2, "ask_bits": 3, "last_bits": 4, "volume": 5, "time_msc": 1000, "flags": 7, "volume_real_bits": 8, "capture_sequence": 1}
    fingerprint = C.payload_fingerprint(record)
    data = record | {"raw_object_key": f"objects/raw/wal-{'a' * 64}.rtw", "raw_object_sha256": b"\xaa" * 32, "gateway_ingest_sequence": 1, "producer_instance_id": "producer-1", "producer_session_id": "session-1", "batch_sequence": 1, "record_ordinal": 0, "source_payload_fingerprint": fingerprint, "observation_hash": C.observation_hash("producer-1", "session-1", 1, 0, 1, fingerprint), "fetch_wall_start_s": 10, "fetch_wall_end_s": 11, "fetch_monotonic_start_us": 100, "fetch_monotonic_end_us": 101, "copy_ticks_error": 0, "source_status_flags": 5}
    first, second = C.row_bytes(SCOPE, 0, segment, marker, True), C.row_bytes(SCOPE, 1, segment, data, False)
    assert (len(first), len(second)) == (400, 529)
    one = C.chain_step(0, D.ZERO, first)
    assert one.hex() == "f88e1980da4dcf0cb21d003cc526128992d36b00d52295df9b67f49e42151dc1"
    assert C.chain_step(1, one, second).hex() == "8114214929035cba63226e3c7c44d4a47dffbf353000826e06b8d4e394c6f4cf"


def test_published_manifests():
    from tidemark.operators import publication

    scope = SCOPE | {"raw_day_manifest_sha256": "5" * 64}
    conversion = {"converter_build_id": "converter-1", "dependency_lock_hash": "6" * 64, "writer_configuration_hash": "7" * 64, "target_platform_contract": "parquet-v1"}
    key = f"{publication.derivative_base(scope)}/parquet/0-1-{'1' * 64}.parquet"
    part = {"canonical_row_bytes": 929, "row_count": 2, "part_bytes": 123, "part_key": key, "part_sha256": "1" * 64, "first_stream_sequence": 0, "last_stream_sequence": 1, "previous_row_chain_hash": "0" * 64, "first_row_chain_hash": "f88e1980da4dcf0cb21d003cc526128992d36b00d52295df9b67f49e42151dc1", "last_row_chain_hash": "8114214929035cba63226e3c7c44d4a47dffbf353000826e06b8d4e394c6f4cf"}
    parts = publication.part_manifests(scope, conversion, [part])
    assert parts[0]["digest"] == "fa06b116cbff31a68517e1e3d2331b724d1ced57c05bdd6a196f4b1cf05651db"
    day = publication.replay_day_manifest(scope, conversion, parts, 1, None, "settled_snapshot")
    assert day["manifest"]["part_set_root"] == "8cc5b4de685bbceda59566816121bb3f6d052f589c61c17546b73399e504651c"
    assert C.digest(D.REPLAY_DAY, day["manifest"] | {"manifest_id": "replay-demo-r1"}).hex() == "1f439ad689b9d2bdfe4ad280fc635eee49f46200b4549500dd3b239c4633579d"
