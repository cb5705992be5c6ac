"""Raw days from sealed segments to a published, verified manifest; stores, publishers and what may go wrong with them."""

import copy
import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import archive, catalog, operations, publishing, retention, selection
from tidemark.plans import events as E
from tidemark.plans import raw_days as Q
from tidemark.sources import parts as P
from tidemark.sources import wal
from tidemark.sources.store import FolderStore, Layout, StoreError, classified, exact_component, put_all, relative_key
from tidemark.streaming import gateway

SF = "/root/testdata/sf0.001"


class Crash(Exception):
    pass


@pytest.fixture(scope="module")
def sealed(spark, tmp_path_factory):
    """Three sealed segments of one gateway over several days, under their contents' names."""
    folder = tmp_path_factory.mktemp("sealed")
    frames = E.frames(spark, SF).where("scope = 'view'").orderBy("day", "sequence").limit(30).collect()
    writer = wal.Writer("gateway")
    for k, r in enumerate(frames):
        writer.append(bytes(r["frame"]), 100 + k, k)
        if k % 12 == 11 or k == len(frames) - 1:
            data = writer.seal()
            where = folder / "objects" / "raw" / f"wal-{C.sha(data).hex()}.rtw"
            where.parent.mkdir(parents=True, exist_ok=True)
            where.write_bytes(data)
    return folder


def tables(spark, folder):
    rows, own = cli.chain(spark, str(folder))
    return archive.records(wal.entries(spark, str(folder))).withColumn("scope", F.lit("gateway")), rows, own


KNOWN = {}


def manifests(spark, folder):
    if folder not in KNOWN:
        found, _, own = tables(spark, folder)
        KNOWN[folder] = made(found, own)
    return copy.deepcopy(KNOWN[folder])


def made(found, own):
    return [archive.manifest_value(r.asDict(True), Q.configuration("view"), 1, None, "provisional", "synced", 0) for r in archive.raw_days(found, own, "scope").orderBy("day").collect()]


def test_days_of_sealed_segments(spark, sealed, capsys):
    values = manifests(spark, sealed)
    assert len(values) > 3 and all(set(v) == set(archive.DAY_KEYS) for v in values)
    rows, entries, own = tables(spark, sealed)
    assert sum(v["accepted_record_count"] for v in values) == rows.where("time_msc IS NOT NULL").count()
    documents = [("gateway", C.canonical_json(v)) for v in values]
    facts = archive.verify_days(archive.parsed(spark, documents), rows, entries, own, "scope").collect()
    assert len(facts) == len(values) and all(f["valid"] for f in facts)
    replayed = archive.verified_replay(archive.parsed(spark, documents[:2]), rows, entries, own, "scope")
    assert replayed.count() == sum(v["accepted_record_count"] for v in values[:2])
    wrong = values[1] | {"accepted_record_count": values[1]["accepted_record_count"] + 1}
    bad = archive.parsed(spark, [("gateway", C.canonical_json(wrong))])
    assert not archive.verify_days(bad, rows, entries, own, "scope").first()["valid"]
    with pytest.raises(Exception, match="does not verify"):
        archive.verified_replay(bad, rows, entries, own, "scope").count()
    one = sealed / "day.json"
    one.write_bytes(documents[0][1])
    assert cli.main(["verify-day", f"{sealed}/objects", str(one)], spark) == 0 and json.loads(capsys.readouterr().out)["valid"]
    one.write_bytes(C.canonical_json(wrong))
    assert cli.main(["verify-day", f"{sealed}/objects", str(one)], spark) == 1
    one.unlink()
    capsys.readouterr()
    assert cli.main(["verify-scope", str(sealed)], spark) == 0
    facts = json.loads(capsys.readouterr().out)
    assert facts["from_genesis"] and facts["entries"] == 30
    assert cli.main(["verify-scope", str(sealed), "f" * 64], spark) == 1
    first = min((sealed / "objects/raw").glob("*.rtw"), key=lambda p: wal.parse(p.read_bytes()).start_sequence)
    kept = first.read_bytes()
    first.unlink()
    try:
        assert cli.main(["verify-scope", str(sealed)], spark) == 1  # the beginning is missing
    finally:
        first.write_bytes(kept)


def test_slices_paths_and_limits(spark, sealed):
    _, entries, own = tables(spark, sealed)
    roots = {r["sequence"]: r for r in entries.collect()}
    slices = lambda a, b, root=None: spark.createDataFrame([("gateway", a, roots[a]["previous_hash"], b, root or roots[b]["entry_hash"])], "scope string, first_sequence long, start_root string, last_sequence long, end_root string")
    assert [r["sequence"] for r in archive.restored(entries, slices(4, 9), "scope").collect()] == list(range(4, 10))
    with pytest.raises(Exception, match="roots"):
        archive.restored(entries, slices(4, 9, "f" * 64), "scope").count()
    with pytest.raises(Exception, match="roots"):
        archive.restored(entries.where("sequence <> 6"), slices(4, 9), "scope").count()
    days = archive.parsed(spark, [("gateway", C.canonical_json(v)) for v in manifests(spark, sealed)])
    limits = {"max_objects": 3, "max_object_bytes": 1 << 20, "max_total_bytes": 1 << 22, "max_ranges": 10_000}
    assert archive.preflight(days, limits).count() == days.count()
    with pytest.raises(Exception, match="limits"):
        archive.preflight(days, limits | {"max_total_bytes": 10}).count()
    local = own.select("scope", "object_key", F.lit("/somewhere").alias("path"))
    assert archive.paths(days, local, "scope").count() >= days.count()
    with pytest.raises(Exception, match="path"):
        archive.paths(days, local.limit(1), "scope").count()
    segments = spark.createDataFrame([(1, 5), (6, 9)], "first_sequence long, last_sequence long")
    assert [selection.overlapping(segments, a, b).count() for a, b in ((0, 15), (5, 6), (0, 0), (6, 20), (10, 12))] == [0, 2, 0, 1, 0]
    assert selection.in_slice(entries, 0, 5).count() == 30 and selection.in_slice(entries, 2, 5).count() == 4


def test_successors(spark, sealed):
    first = manifests(spark, sealed)[0]
    digest = C.sha(D.RAW_DAY, C.canonical_json(first)).hex()
    later = first | {"revision": 2, "previous_manifest_sha256": digest, "accepted_record_count": first["accepted_record_count"] + 1}
    archive.succeeds(first, later)
    for change in ({"accepted_record_count": 0}, {"objects": first["objects"][1:]}, {"revision": 3}, {"chain_slice_start_root": "f" * 64}, {"publisher_id": "x"}, {"chain_slice_end_root": "f" * 64}):
        with pytest.raises(C.FormatError):
            archive.succeeds(first, later | change)
    for bad in ((0, None), (1, "a" * 64), (2, None)):
        with pytest.raises(C.FormatError):
            archive.manifest_value({}, Q.configuration("view"), *bad, "provisional", "synced", 0)


def test_store(spark, tmp_path):
    store = FolderStore(str(tmp_path / "s"))
    assert store.put_if_absent("a/b", b"1") and not store.put_if_absent("a/b", b"1") and store.get("a/b") == b"1" and store.get("a/c") is None
    with pytest.raises(StoreError, match="collision"):
        store.put_if_absent("a/b", b"2")
    with pytest.raises(StoreError, match="resource"):
        store.get("a/b", 0)
    with pytest.raises(StoreError, match="resource"):
        store.keys("a", 0)
    assert store.keys("a", 5) == [("a/b", 1)] and store.keys("none", 5) == []
    sha = C.sha(b"1").hex()
    assert [store.observe(*x) for x in (("a/b", sha, 1), ("a/b", "f" * 64, 1), ("a/x", sha, 1), ("a/b", sha, 1, 0))] == ["Exact", "Different", "Absent", "Oversized"]
    for key in ("", "/a", "a/../b", "a//b", "a\\b", "a\n"):
        with pytest.raises(StoreError):
            relative_key(key)

    def fault(step, key):
        if step == "published":
            raise OSError("lost")

    assert FolderStore(str(tmp_path / "s"), fault).put_if_absent("a/d", b"3") and store.get("a/d") == b"3"  # the outcome is found by looking
    assert not [k for k, _ in store.keys("", 100) if "tmp" in k]
    rows = spark.createDataFrame([("x/1", b"p"), ("x/2", b"q")], "key string, data binary")
    assert put_all(rows, f"file://{tmp_path}/t").where("created").count() == 2 and put_all(rows, f"file://{tmp_path}/t").where("created").count() == 0
    (tmp_path / "t/x/1").write_bytes(b"z")  # as long, other bytes
    with pytest.raises(Exception, match="collision"):
        put_all(rows, f"file://{tmp_path}/t").count()
    plan = spark.createDataFrame([("x/2", C.sha(b"q").hex(), 1)], "key string, sha256 string, bytes long")
    assert catalog.fetch(plan, f"{tmp_path}/t", f"{tmp_path}/u").count() == 1 and (tmp_path / "u/x/2").read_bytes() == b"q"
    with pytest.raises(Exception, match="budget"):
        catalog.fetch(plan, f"{tmp_path}/t", f"{tmp_path}/u", max_bytes=0).count()
    with pytest.raises(Exception, match="check_mismatch"):
        catalog.fetch(plan.withColumn("sha256", F.lit("f" * 64)), f"{tmp_path}/t", f"{tmp_path}/u").count()
    one = spark.range(1).select(*(N.exact_component(F.lit(x)).alias(k) for k, x in (("a", "EUR/USD é"), ("b", "a-_.*'()z"))), N.cache_identity(F.lit("raw"), F.lit("k"), F.lit("d")).alias("c")).first()
    assert [one["a"], one["b"]] == [exact_component("EUR/USD é"), "a-_.*'()z"] and one["c"] == "raw:k:d"
    assert [classified(x) for x in (StoreError("collision"), StoreError("check_mismatch"), PermissionError(), C.FormatError("INVALID_FIELD"), TimeoutError(), OSError())] == [
        ("collision", False), ("remote_integrity", False), ("permission", False), ("local_integrity", False), ("remote_timeout", True), ("remote_transient", True)]


def test_checked_arithmetic_and_days(spark):
    top = str(2**64 - 1)
    one = spark.createDataFrame([(top, "1", "4294967296")], "a string, b string, c string").select(*(F.col(x).cast("decimal(20,0)").alias(x) for x in "abc"))
    assert int(one.select(N.saturating_add(F.col("a"), F.col("b")).alias("x")).first()["x"]) == 2**64 - 1
    assert int(one.select(N.checked_add(F.col("b"), F.col("c")).alias("x")).first()["x"]) == 2**32 + 1
    assert int(one.select(N.checked_multiply(F.col("a"), F.col("b")).alias("x")).first()["x"]) == 2**64 - 1
    for bad in (N.checked_add(F.col("a"), F.col("b")), N.checked_multiply(F.col("c"), F.col("c"))):
        with pytest.raises(Exception, match="overflows"):
            one.select(bad).collect()
    days = spark.createDataFrame([(["2024-01-02", "2024-01-01", "2024-01-02"],)], "d array<string>").select(N.dates_json(F.col("d")).alias("j"))
    assert days.first()["j"] == '["2024-01-01","2024-01-02"]' and days.select(N.dates_of(F.col("j")).alias("d")).first()["d"] == ["2024-01-01", "2024-01-02"]
    for text in ('["2024-01-02","2024-01-01"]', '["x"]', "{}"):
        with pytest.raises(Exception, match="canonical"):
            spark.range(1).select(N.dates_of(F.lit(text))).collect()


STEPS = [f"{when}_{stage}" for stage in publishing.STAGES[1:] for when in ("before", "after")]


@pytest.mark.parametrize("step", [None, *STEPS])
def test_publisher_survives_a_crash_at_each_step(spark, sealed, tmp_path, step):
    value = manifests(spark, sealed)[0]
    local, remote = FolderStore(str(sealed)), FolderStore(str(tmp_path / "remote"))
    layout = Layout("immutable", Q.configuration("view"))
    journal = publishing.Journal(FolderStore(str(tmp_path / "journal")))
    publisher = lambda fault: publishing.Publisher(spark, FolderStore(str(sealed)), remote, layout, journal, str(tmp_path / "lock"), lambda: 7, fault)

    def crash(at):
        if at == step:
            raise Crash

    if step:
        with pytest.raises(Crash):
            publisher(crash).publish(value)
    receipt = json.loads(publisher(lambda at: None).publish(value))
    assert receipt["verification_complete"] and publisher(crash if step is None else lambda at: None).publish(value) == C.canonical_json(receipt)
    key = layout.raw_manifest(value["date"], 1, C.sha(D.RAW_DAY, C.canonical_json(value)).hex())
    assert receipt["manifest_key"] == key and remote.get(key) == C.canonical_json(value) and journal.stage(key) == "receipt_saved" and journal.unfinished() == []
    assert publishing.scopes(remote) == [Q.configuration("view")]
    seen = journal.remote(spark)
    assert seen.count() == len(value["chain_objects"]) and publishing.last_verified(seen) == 7
    found = publishing.bound_remotely(spark.createDataFrame([(value["chain_objects"][0]["key"],), ("other",)], "key string"), seen)
    assert {r["key"]: r["remote_verified"] for r in found.collect()} == {value["chain_objects"][0]["key"]: True, "other": False}
    (sealed / "receipts").exists() and __import__("shutil").rmtree(sealed / "receipts")
    assert local.keys("receipts", 10) == []


def test_publisher_refuses(spark, sealed, tmp_path):
    value = manifests(spark, sealed)[0]
    remote, layout = FolderStore(str(tmp_path / "remote")), Layout("immutable", Q.configuration("view"))
    publisher = lambda n: publishing.Publisher(spark, FolderStore(str(sealed)), remote, layout, publishing.Journal(FolderStore(f"{tmp_path}/j{n}")), str(tmp_path / "lock"))
    with publishing.lock(str(tmp_path / "lock")), pytest.raises(StoreError, match="held"):
        publisher(1).publish(value)
    o = value["chain_objects"][0]
    remote.put_if_absent(layout.raw_object(o["key"], o["sha256"]), b"other bytes")
    with pytest.raises(StoreError, match="collision"):
        publisher(2).publish(value)
    other = FolderStore(str(tmp_path / "claimed"))
    other.put_if_absent(layout.claim(), b"{}")
    with pytest.raises(StoreError, match="publisher_conflict"):
        publishing.Publisher(spark, FolderStore(str(sealed)), other, layout, publishing.Journal(FolderStore(f"{tmp_path}/j3")), str(tmp_path / "lock")).publish(value)
    assert layout.relative(layout.claim()) == "publisher-claims/epoch=1.json"
    with pytest.raises(StoreError):
        layout.relative("elsewhere/publisher-claims/epoch=1.json")


def test_replay_publisher(spark, tmp_path):
    remote = FolderStore(str(tmp_path))
    there = {"claim": b"c", "raw_manifest": b"m", "raw_object": b"o", "part_chain": b"pc", "replay_graph": b"g"}
    ours = {"parquet": [("p1", "k/p1", b"one"), ("p2", "k/p2", b"two")], "part_manifest": [("m1", "k/m1", b"m1")], "replay_manifest": [("r", "k/r", b"r")]}
    objects = {b: [(b, f"k/{b}", d)] for b, d in there.items()} | ours
    limits = {"max_parquet_object_bytes": 100, "max_metadata_object_bytes": 100, "max_observation_requests": 1000, "max_observation_bytes": 10_000, "max_publication_rounds": 6}
    events = publishing.Events(FolderStore(str(tmp_path / "events")))
    new = lambda **more: publishing.ReplayPublisher(spark, remote, objects, "a" * 64, limits | more, events)
    with pytest.raises(publishing.Stopped, match="claim_absent"):
        new().publish("receipt", "k/r")
    for b, d in there.items():
        remote.put_if_absent(f"k/{b}", d)
    with pytest.raises(publishing.Stopped, match="ResourceStop"):
        new(max_observation_requests=3).publish("receipt", "k/r")
    with pytest.raises(publishing.Stopped, match="rounds"):
        new(max_publication_rounds=2).publish("receipt", "k/r")
    receipt = new().publish("receipt", "k/r")
    assert json.loads(receipt)["manifest_key"] == "k/r" and all(remote.get(k) == d for some in ours.values() for _, k, d in some) and remote.get("receipt") == receipt
    table = events.table(spark)
    assert table.where("event_kind = 'action_finished' AND result_class = 'completed'").count() == 4 and table.select("event_id").distinct().count() > 6
    (tmp_path / "k/m1").write_bytes(b"xx")
    with pytest.raises(publishing.Stopped, match="IntegrityStop"):
        new().publish("receipt2", "k/r")


def test_pipeline_and_due_uploads(spark, sealed, tmp_path):
    frames = E.frames(spark, SF).where("scope = 'view'").orderBy("day", "sequence").limit(8).collect()
    local, remote = FolderStore(str(tmp_path / "local")), FolderStore(str(tmp_path / "remote"))
    pipe = publishing.Pipeline(spark, wal.Writer("gateway"), local, Q.configuration("view"), 1 << 30)
    assert pipe.process() == {"pending": 0, "objects": 0}
    for k, r in enumerate(frames[:5]):
        pipe.writer.append(bytes(r["frame"]), 100 + k, k)
    assert pipe.process()["objects"] == 0 and pipe.process(force=True)["objects"] == 1
    first = len(pipe.catalog)
    assert first > 0 and pipe.process(force=True)["pending"] == first  # nothing new
    catalog_rows = lambda: spark.createDataFrame([tuple(r[k] for k in ("date", "revision", "state", "attempts", "next_retry", "key")) for r in pipe.catalog], "date string, revision long, state string, attempts long, next_retry long, key string")
    publisher = publishing.Publisher(spark, local, remote, Layout("immutable", Q.configuration("view")), publishing.Journal(FolderStore(str(tmp_path / "j"))), str(tmp_path / "lock"))

    def lost(step):
        if step == "before_manifest_copied":
            raise OSError("no network")

    publisher.fault = lost
    after = publishing.publish_due(publisher, catalog_rows(), 100)
    states = sorted((r["state"], r["attempts"], r["next_retry"]) for r in after.collect())
    assert states[0] == ("retry_wait", 1, 105) and all(s == ("spooled", 0, 0) for s in states[1:])  # one failure ends the tick
    assert publishing.publish_due(publisher, after.where("state = 'retry_wait'"), 104).first()["attempts"] == 1
    publisher.fault = lambda step: None
    done = publishing.publish_due(publisher, after, 105)
    assert {r["state"] for r in done.collect()} == {"published"}
    for k, r in enumerate(frames[5:] + frames[:1]):  # the last one is of a day that has a manifest
        pipe.writer.append(bytes(r["frame"]), 200 + k, 100 + k)
    pipe.process(force=True)  # no predecessor is known to be published: its day waits
    assert all(r["revision"] == 1 for r in pipe.catalog)
    out = tuple(C.sha(D.RAW_DAY, local.get(r["key"])).hex() for r in pipe.catalog)
    pipe.process(published=out)
    again = [r for r in pipe.catalog if r["revision"] == 2]
    assert len(again) >= 1 and C.parse_canonical(local.get(again[0]["key"]))["previous_manifest_sha256"] in out


def test_plannable_days(spark):
    days = spark.createDataFrame([("a",), ("b",), ("c",)], "day string")
    revisions = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("b", 1, "r")], "day string, revision long, digest string")
    published = spark.createDataFrame([("p",), ("r",)], "digest string")
    assert sorted(r["day"] for r in publishing.plannable(days, revisions, published).collect()) == ["b", "c"]


def test_state_tables(spark, tmp_path):
    tables = publishing.StateTables(spark, str(tmp_path))
    rows = lambda *x: spark.createDataFrame([(k,) for k in x], "n long")
    assert publishing.journal_batch(tables, 0, rows(1, 2), rows(10)) and not publishing.journal_batch(tables, 0, rows(9), rows(99))
    rows(5).write.parquet(f"{tmp_path}/batches/commit=1")  # a commit that a crash left without its marker
    assert tables.appended("batches").count() == 2
    assert publishing.journal_batch(tables, 1, rows(3), rows(11))
    assert sorted(r["n"] for r in tables.appended("batches").collect()) == [1, 2, 3] and tables.latest("state").first()["n"] == 11


def test_resume_and_release(spark):
    frames = [bytes(r["frame"]) for r in E.frames(spark, SF).where("scope = 'view'").orderBy("day", "sequence").limit(3).collect()]
    state = gateway.State()
    acks = [state.accept(f, 10) for f in frames]
    last = max(k for k, a in enumerate(acks) if a["status"] not in (gateway.DUPLICATE, gateway.CONFLICT))  # numbers begin anew each day
    hello = {"producer_instance_id": "producer", "producer_session_id": "session-view", "exact_source_symbol": "symbol", "source_schema_id": D.SCHEMA_ID, "provider_id": "provider"}
    message, generation = state.resume(hello, {"provider_id": "provider"}, 20, "gateway", "lease")
    assert message["last_durable_batch_sequence"] == acks[last]["batch_sequence"] and message["last_durable_batch_hash"] == C.batch_hash(frames[last]) and message["committed_cursor_msc"] == state.cursor
    assert C.decode_message(C.encode_message("RESUME", message)) == ("RESUME", message)
    with pytest.raises(C.FormatError, match="LEASE"):
        state.resume(hello | {"producer_session_id": "other"}, {}, 21, "gateway", "lease")
    _, later = state.resume(hello, {}, 22, "gateway", "lease")
    assert not state.release("session-view", generation) and state.release("session-view", later)
    assert state.resume(hello | {"producer_session_id": "other"}, {}, 23, "gateway", "lease")[0]["last_durable_batch_sequence"] == 0
    for change in ({"exact_source_symbol": ""}, {"source_schema_id": "x"}, {"provider_id": "x"}):
        with pytest.raises(C.FormatError):
            gateway.check_hello(hello | change, {"provider_id": "provider"})


def test_segments_close_at_their_first_full_entry(spark):
    rows = spark.createDataFrame([("s", k, 60, k * 10) for k in range(8)], "scope string, sequence long, bytes long, wall_s long")
    got = lambda *a: [r["segment"] for r in gateway.segment_groups(rows, *a).orderBy("sequence").collect()]
    assert got(100) == [0, 0, 1, 1, 2, 2, 3, 3] and got(10**9, 30) == [0, 0, 0, 1, 1, 1, 2, 2] and got(10**9) == [0] * 8


def test_retention_records(spark, tmp_path):
    store = FolderStore(str(tmp_path))
    assert retention.wall_clock(store) is None and retention.wall_clock(store, 5) == 5 == retention.wall_clock(store) and retention.wall_clock(store, 5) == 5 and retention.wall_clock(store, 9) == 9
    with pytest.raises(C.FormatError):
        retention.wall_clock(store, 8)
    assert retention.anchor([]) == (0, D.ZERO.hex()) and retention.anchor([{"end_sequence": 4, "retained_chain_root": "r"}]) == (4, "r")
    trash = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, sha256 string")
    assert [r["name"] for r in retention.unexpected(trash, spark.createDataFrame([("1",)], "segment_sha256 string")).collect()] == ["b"]
    checkpoints = spark.createDataFrame([("x", 1, 4, "r4"), ("y", 1, 2, "s2")], "g string, checkpoint long, last_sequence long, chain_root string")
    kept = spark.createDataFrame([("x", 5, 6, "r4", "r6"), ("x", 7, 8, "r6", "r8"), ("y", 4, 5, "s2", "s5")], "g string, first_sequence long, last_sequence long, chain_start string, chain_root string")
    assert {(r["g"], r["first_sequence"]): r["breaks"] for r in retention.retained_from(checkpoints, kept, "g").collect()} == {("x", 5): False, ("x", 7): False, ("y", 4): True}


def test_prune_run(spark, tmp_path):
    (tmp_path / "sealed").mkdir()
    for k in (1, 2, 3):
        (tmp_path / "sealed" / f"{k}.rtw").write_bytes(b"s" * k)
    rows = [(f"a{k}", f"/wal/{k}", "wal", k, k, k == 3, True, True, True, True, "f" * 64, True, f"a{k}", 100, 200, False) for k in (1, 2, 3)]
    schema = "artifact_id string, path string, kind string, first_sequence long, last_sequence long, active boolean, recovered boolean, fresh boolean, covered boolean, remote_verified boolean, proof_sha256 string, limits_match boolean, proof_artifact string, observed_at long, grace_not_before long, recovery_floor boolean"
    candidates = spark.createDataFrame(rows, schema)
    actions = spark.createDataFrame([(f"a{k}", f"{k}.rtw", k, k, "c" * 64, C.sha(b"s" * k).hex()) for k in (1, 2, 3)], "artifact_id string, name string, start_sequence long, end_sequence long, retained_chain_root string, segment_sha256 string")
    policy = retention.Policy(now=300, durable_now=300, grace=100, expected_start=1, max_candidates=5, remote_required=True)
    own, clock = retention.Executor(spark, f"file://{tmp_path}"), FolderStore(str(tmp_path / "state"))
    assert retention.prune(candidates, policy, own, clock, actions) == ["a1", "a2"] and [p.name for p in (tmp_path / "sealed").glob("*.rtw")] == ["3.rtw"]
    assert retention.wall_clock(clock) == 300
    with pytest.raises(C.FormatError, match="regressed"):
        retention.prune(candidates, retention.Policy(now=299, durable_now=299, grace=100, expected_start=1, max_candidates=5), own, clock, actions)


def test_proofs(spark):
    own = spark.createDataFrame([("s", "o1"), ("s", "o2"), ("t", "o1")], "scope string, object_key string")
    coverage = spark.createDataFrame([("s", "d", "m", "o1", True), ("s", "d", "m", "o2", False), ("t", "d", "n", "o1", True)], "scope string, day string, manifest_sha256 string, object_key string, covered boolean")
    days = spark.createDataFrame([("s", "d", "m", True), ("t", "d", "n", False)], "scope string, day string, manifest_sha256 string, valid boolean")
    got = retention.proofs(own, coverage, days, own, own.select("scope").limit(1).distinct(), "scope").collect()
    assert {(r["scope"], r["object_key"]): (r["covered"], r["proof_sha256"] is not None) for r in got} == {("s", "o1"): (True, True), ("s", "o2"): (False, False), ("t", "o1"): (False, False)}


def test_limits_and_inventory(spark):
    limits = {k: 5 for k in operations.LIMIT_KEYS} | {"limits_version": "m4-operational-limits-v1"}
    assert operations.resource_limits(C.canonical_json(limits))["max_proof_bytes"] == 5
    for change in ({"max_proof_bytes": 0}, {"extra": 1}, {"limits_version": "x"}):
        with pytest.raises(C.FormatError):
            operations.resource_limits(C.canonical_json(limits | change))
    scope = lambda n, **more: {k: f"/{k}/{n}" for k in operations.SCOPE_KEYS} | {"scope": n} | more
    document = lambda *rows: C.canonical_json({"inventory_version": "scope-inventory-v1", "scopes": list(rows)})
    found = operations.scope_inventory(spark, document(scope("a"), scope("b")))
    assert found.count() == 2
    for rows in ((scope("b"), scope("a")), (scope("a"), scope("a")), (scope("a"), scope("b", listener="/listener/a")), (scope("a", scope_key=""),), ()):
        with pytest.raises(C.FormatError):
            operations.scope_inventory(spark, document(*rows))
    running = spark.createDataFrame([("b",), ("c",)], "scope string")
    assert [tuple(r) for r in operations.supervisor_plan(found, running).collect()] == [("a", "start"), ("b", "keep"), ("c", "stop")]


def test_http(spark):
    scopes = spark.createDataFrame([("s", "demo", "v", "x")], "scope_key string, dataset_id string, provider_id string, symbol string")
    part = "array<struct<key:string,sha256:string,bytes:long>>"
    raw = spark.createDataFrame([("a" * 64, "demo", "2024-03-09", 1, "raw", [("k", "s", 5)])], f"digest string, dataset_id string, date string, revision long, path string, objects {part}")
    own = catalog.Archive(scopes, raw, spark.createDataFrame([("b" * 64, "demo", "2024-03-09", 1, "m", "raw", ["p"])], "digest string, dataset_id string, date string, revision long, manifest_id string, path string, part_manifest_keys array<string>"), spark.createDataFrame([("p", "d", "pk", "ps", 7)], "key string, digest string, part_key string, part_sha256 string, part_bytes long"))
    limits = {"max_api_response_items": 10, "max_api_request_bytes": 200, "max_concurrent_requests": 1, "request_timeout_ms": 60_000}
    hold, entered = threading.Event(), threading.Event()

    def health():
        entered.set()
        hold.wait(20)
        return {"status": "healthy"}

    handle = catalog.http(own, limits, health)
    body = lambda kind, digest: json.dumps({"kind": kind, "selector": {"manifest": digest}}).encode()
    assert handle("GET", "/v1/datasets/demo/scopes", {})[1]["items"][0]["symbol"] == "x"
    q = {"dataset": ["demo"], "source": ["v"], "symbol": ["x"]}
    assert handle("GET", "/v1/snapshots/raw", q)[1]["items"][0]["digest"] == "a" * 64 and handle("GET", "/v1/snapshots/raw", q | {"symbol": ["y"]})[0] == 404
    assert handle("GET", "/v1/snapshots/replay", q)[0] == 400 and len(handle("GET", "/v1/snapshots/replay", q | {"date": ["2024-03-09"], "stream": ["r"], "conversion": ["c"]})[1]["items"]) == 1
    assert handle("POST", "/v1/fetch-plans", {}, body("raw", "a" * 64))[1]["items"] == [{"key": "k", "at": 0, "sha256": "s", "bytes": 5, "cache_identity": "raw:k:s"}]
    assert handle("POST", "/v1/fetch-plans", {}, body("replay", "b" * 64))[1]["items"][0]["cache_identity"] == "replay:pk:ps"
    refused = [("GET", "/v1/fetch-plans", b"", 405), ("POST", "/v1/datasets", b"", 405), ("POST", "/v1/fetch-plans", b"{}", 400), ("POST", "/v1/fetch-plans", body("raw", "c" * 64), 404), ("POST", "/v1/fetch-plans", body("replay", "a" * 64), 404), ("POST", "/v1/fetch-plans", b" " * 300, 413), ("GET", "/v1/scopes", b"", 404)]
    assert [handle(m, p, {}, b)[0] for m, p, b, _ in refused] == [s for *_, s in refused]
    first = threading.Thread(target=handle, args=("GET", "/v1/health", {}))
    first.start()
    entered.wait(20)
    assert handle("GET", "/v1/datasets", {})[0] == 429
    hold.set()
    first.join()
    hold.clear()
    slow = catalog.http(own, limits | {"request_timeout_ms": 50}, health)
    assert slow("GET", "/v1/health", {})[0] == 504
    hold.set()
    server = catalog.serve(handle)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    try:
        with urllib.request.urlopen(f"{base}/v1/datasets") as answer:
            assert json.load(answer)["items"] == [{"dataset_id": "demo"}]
        with pytest.raises(urllib.error.HTTPError) as missing:
            urllib.request.urlopen(f"{base}/v1/manifests/{'c' * 64}")
        assert missing.value.code == 404
    finally:
        server.shutdown()


def test_replay_day_facts(spark):
    built = P.build(E.frames(spark, SF).where("scope = 'view'").limit(2), E.SCOPE, E.IDENTITY).limit(1)
    rows = built.withColumn("key", F.concat(F.lit("m/"), F.col("part_sequence").cast("string"))).withColumn("digest", F.sha2(F.col("key"), 256)).collect()
    parts = spark.createDataFrame(rows)
    items = [{"key": r["key"], "digest": bytes.fromhex(r["digest"]), "first_stream_sequence": r["first_stream_sequence"], "last_stream_sequence": r["last_stream_sequence"]} for r in rows]
    from tidemark.operators import continuity

    one = rows[0]
    stream = continuity.replay(E.frames(spark, SF).where((F.col("scope") == one["scope"]) & (F.col("day") == one["day"])).join(spark.createDataFrame([(one["scope"], one["day"])], "scope string, day string"), ["scope", "day"]).limit(10**6), E.SCOPE, E.IDENTITY)
    manifest = {"raw_day_manifest_sha256": "r" * 64, "part_set_root": C.part_set_root(items).hex(), "root": one["last_row_chain_hash"]}
    days = spark.createDataFrame([("r" * 64, True)], "manifest_sha256 string, valid boolean")
    facts = catalog.verify_replay_day(stream.where(F.col("stream_sequence") <= one["last_stream_sequence"]), parts, manifest, days)
    assert len(facts) == 9 and facts["raw_bound"] and facts["raw_valid"] and facts["parts_valid"] and facts["part_set_root_matches"] and facts["parts_linked"]
    spoiled = parts.withColumn("content", F.concat(F.col("content"), F.lit(b"x")))
    bad = catalog.verify_replay_day(stream, spoiled, manifest | {"part_set_root": "0" * 64}, days.where("false"))
    assert not bad["parts_valid"] and not bad["part_set_root_matches"] and not bad["raw_bound"] and not bad["valid"]


def test_small_checks(spark):
    from tidemark.operators import chains

    days = spark.createDataFrame([("d", 1, "a", None, "r1"), ("d", 2, "b", "a", "r2"), ("d", 3, "c", "b", "r2")], "day string, revision long, digest string, previous string, raw_digest string")
    assert [r["breaks"] for r in selection.replay_breaks(days, "day").orderBy("revision").collect()] == [False, False, True]
    ranges = spark.createDataFrame([("d", 1, 0, 1, 5), ("d", 1, 6, 2, 0), ("d", 2, 0, 3, 1), ("d", 5, 4, 5, 3)], "day string, start long, first_ordinal long, end long, last_ordinal long")
    assert sorted((r["start"], r["first_ordinal"]) for r in selection.not_ascending(ranges, "day").collect()) == [(2, 0), (5, 4)]
    asked = spark.createDataFrame([("s", 1), ("s", 2), ("s", 3)], "session string, batch_sequence long")
    known = lambda *rows: spark.createDataFrame(rows, "session string, batch_sequence long, hash string")
    got = {r["batch_sequence"]: (r["hash"], r["found_in"]) for r in chains.looked_up(asked, known(("s", 1, "j")), known(("s", 1, "w"), ("s", 2, "w"))).collect()}
    assert got == {1: ("j", "journal"), 2: ("w", "log"), 3: (None, None)}
    parts = spark.createDataFrame([("d", str(2**63)), ("d", str(2**63 - 1))], "day string, n string").select("day", F.col("n").cast("decimal(20,0)").alias("row_count"))
    assert int(chains.total_rows(parts, "day").first()["row_count"]) == 2**64 - 1
    with pytest.raises(Exception, match="overflows"):
        chains.total_rows(parts.union(parts), "day").collect()
