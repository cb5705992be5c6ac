"""Truth tables of the reducer, of packing and of the cursor."""

import pytest

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import continuity
from tidemark.streaming.gateway import State

IDENTITY = {"producer_instance_id": "p", "provider_id": "v", "stable_feed_id": "f", "broker_server_fingerprint": "b", "exact_source_symbol": "s"}
SCOPE = {"dataset_id": "demo", "day_definition_id": "utc-day-v1", "date": "2024-03-09", "replay_contract_id": "replay-v1", "conversion_id": "conversion-v1", "raw_day_manifest_key": "k", "raw_day_manifest_sha256": bytes(32)}


def record(price, msc=1000, capture=0):
    return {n: 0 for n, _ in C.RECORD} | {"bid_bits": ord(price) if isinstance(price, str) else price, "time_msc": msc, "capture_sequence": capture}


def message(session, number, records, error=0, requested=0):
    lease = C.lease_id("p", session, "v", "f", "b", "s")
    fields = {n: 0 for n, k in C.MESSAGES["BATCH"] if k not in ("str", "records")}
    return fields | {"session_lease_id": lease, "producer_session_id": session, "batch_sequence": number, "returned_count": len(records), "requested_count": requested, "copy_ticks_error": error, "source_schema_id": D.SCHEMA_ID, "records": records}


def reduce(batches):
    own, rows = continuity.Reducer(dict(SCOPE), IDENTITY), []
    for k, (session, number, records, *error) in enumerate(batches, 1):
        batch = message(session, number, [record(x) if isinstance(x, str) else x for x in records], *error)
        rows += own.feed(batch | {"gateway_ingest_sequence": k, "raw_object_key": "objects/raw/x", "raw_object_sha256": bytes([1]) * 32}, list(range(max(1, len(records)))))
    return own, rows


T = lambda ms: record(1, ms)
CASES = {
    "exact overlap": ([("s", 1, "ab"), ("s", 2, "bc")], 3, ["SEGMENT_START"]),
    "ambiguous repeat": ([("s", 1, "aa"), ("s", 2, "a")], 3, ["SEGMENT_START", "AMBIGUOUS_OVERLAP"]),
    "longest unique with multiplicity": ([("s", 1, "aa"), ("s", 2, "aab")], 3, ["SEGMENT_START"]),
    "restart, changed payload": ([("s", 1, "x"), ("t", 1, "y")], 2, ["SEGMENT_START", "AMBIGUOUS_OVERLAP"]),
    "proven history change": ([("s", 1, "abc"), ("s", 2, "aBcd")], 7, ["SEGMENT_START", "SOURCE_HISTORY_CHANGED"]),
    "longest boundary wins": ([("s", 1, "aaaa"), ("s", 2, "axaa")], 8, ["SEGMENT_START", "SOURCE_HISTORY_CHANGED"]),
    "compatible elsewhere": ([("s", 1, "aaaa"), ("s", 2, "axa")], 7, ["SEGMENT_START", "AMBIGUOUS_OVERLAP"]),
    "interior only": ([("s", 1, "abcd"), ("s", 2, "axce")], 8, ["SEGMENT_START", "AMBIGUOUS_OVERLAP"]),
    "error, gap, regression": ([("s", 1, [T(1000)]), ("s", 2, [T(900)]), ("s", 3, [T(950)], 7), ("s", 5, [T(1100)])], 3, ["SEGMENT_START", "TIMESTAMP_REGRESSION", "SOURCE_ERROR", "GAP"]),
    "two disjoint batches": ([("s", 1, "a"), ("s", 2, "b")], 2, ["SEGMENT_START", "AMBIGUOUS_OVERLAP"]),
    "empty day": ([], 0, []),
    "empty batch": ([("s", 1, "")], 0, ["SEGMENT_START"]),
}


@pytest.mark.parametrize("name", CASES)
def test_reducer(name):
    batches, data, markers = CASES[name]
    own, rows = reduce(batches)
    assert [r["marker_code"] for r in rows if r["row_kind"] == 2] == markers
    assert sum(r["row_kind"] == 1 for r in rows) == data
    assert [r["stream_sequence"] for r in rows] == list(range(len(rows)))
    assert all(b["previous"] == a["hash"] for a, b in zip(rows, rows[1:]))
    assert own.root == (rows[-1]["hash"] if rows else D.ZERO)
    again = reduce(batches)[0]
    assert again.root == own.root


def test_reducer_rejects_a_foreign_lease():
    own = continuity.Reducer(dict(SCOPE), IDENTITY | {"provider_id": "other"})
    with pytest.raises(C.FormatError):
        list(own.feed(message("s", 1, [record("a")]) | {"gateway_ingest_sequence": 1, "raw_object_key": "", "raw_object_sha256": bytes(32)}, [0]))


def test_packing_restarts_at_each_cut():
    assert list(continuity.pack([5, 5, 5, 1, 9], 10, 10)) == [0, 0, 1, 1, 2]
    assert list(continuity.pack([1] * 5, 2, 100)) == [0, 0, 1, 1, 2]
    with pytest.raises(C.FormatError):
        list(continuity.pack([11], 10, 10))


def frame(*args, **more):
    return C.encode_message("BATCH", message(*args, **more))


def test_dense_boundary():
    state = State(cursor=1000, count=2, default_count=2, cap=4)
    one = state.accept(frame("s", 1, [record("a"), record("b")], requested=2), 0)
    two = state.accept(frame("s", 2, [record(x) for x in "abcd"], requested=4), 1)
    assert (one["status"], one["next_count"]) == (4, 4)
    assert (two["status"], two["next_count"]) == (5, 4)


def test_cursor():
    state = State(cursor=1000)
    assert state.accept(frame("s", 1, [record("a", 900)]), 0)["status"] == 2
    ack = state.accept(frame("s", 2, [record("a", 1000), record("b", 1001)]), 0)
    assert (ack["status"], ack["cursor"]) == (1, 1001)
    assert ack["digest"] == C.boundary_digest(1001, D.ZERO, [C.payload_fingerprint(record("b", 1001))]).hex()
    more = state.accept(frame("s", 3, [record("c", 1001)], requested=5), 0)
    assert more["status"] == 2 and more["digest"] == C.boundary_digest(1001, bytes.fromhex(ack["digest"]), [C.payload_fingerprint(record("c", 1001))]).hex()
    assert state.accept(frame("s", 4, [], error=4401), 0)["status"] == 2


def test_retries_conflicts_and_leases():
    state = State()
    sent = frame("s", 1, [record("a")])
    first, again = state.accept(sent, 0), state.accept(sent, 1)
    assert again["status"] == 3 and again["sequence"] == first["sequence"] == 1
    assert state.accept(frame("s", 1, [record("b")]), 2)["status"] == 8
    assert state.accept(frame("t", 1, [record("b")]), 3)["status"] == 9
    assert state.accept(frame("t", 1, [record("b", 2000)]), 99)["status"] == 1


def test_retries_of_any_age():
    state = State()
    sent = [frame("s", k, [record("a", 1000 + k)]) for k in range(1, 4200)]
    last = [state.accept(x, 0) for x in sent][-1]
    again, altered = state.accept(sent[0], 1), state.accept(frame("s", 2, [record("b", 9000)]), 2)
    assert (again["status"], altered["status"]) == (3, 8)
    assert all(x[n] == last[n] for x in (again, altered) for n in ("sequence", "cursor", "digest", "entry_hash"))
