"""Operators on small tables: decisions, retention, health, reading, streaming."""

import random
import re
from zlib import crc32

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import catalog, chains, operations, publication, retention, selection
from tidemark.plans import catalogue, ingest, oracle, raw_days, raw_days_oracle  # noqa: F401
from tidemark.plans import events as E
from tidemark.sources import wal
from tidemark.streaming import gateway

SF = "/root/testdata/sf0.001"


ORACLE = oracle.ORACLE | raw_days_oracle.ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, compare, name):
    compare(catalogue.QUERIES[name](spark, SF), ORACLE[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(ORACLE)))
def test_queries_without_sql_run(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_queries_without_sql_by_value(spark):
    run = lambda name: catalogue.QUERIES[name](spark, SF)
    frames = [r.asDict() for r in E.frames(spark, SF).collect()]
    stream = run("continuity_replay").collect()
    groups = {}
    for r in stream:
        groups.setdefault((r["scope"], r["day"]), []).append(r)
    chained = 0
    for rows in groups.values():
        rows.sort(key=lambda r: r["stream_sequence"])
        assert [r["stream_sequence"] for r in rows] == list(range(len(rows))) and rows[0]["previous_row_chain_hash"] == D.ZERO.hex() and rows[0]["code"] == "SEGMENT_START"
        chained += sum(b["previous_row_chain_hash"] == a["row_chain_hash"] for a, b in zip(rows, rows[1:], strict=False))
    assert chained == len(stream) - len(groups) and len(groups) == len({(f["scope"], f["day"]) for f in frames})
    # each captured payload comes out, and none that no frame holds
    held = {}
    for f in frames:
        message = C.decode_message(f["frame"])[1]
        if not message["copy_ticks_error"]:
            held.setdefault((f["scope"], f["day"]), set()).update(C.payload_fingerprint(r) for r in message["records"])
    assert {k: {bytes(r["fingerprint"]) for r in rows if r["row_kind"] == 1} for k, rows in groups.items()} == {k: held.get(k, set()) for k in groups}
    for r in run("replay_summary").collect():
        rows = groups[r["scope"], r["day"]]
        assert (r["rows"], r["markers"], r["segments"], r["last_segment"], r["root"]) == (len(rows), sum(x["row_kind"] == 2 for x in rows), len({x["segment"] for x in rows}), rows[-1]["segment"], rows[-1]["row_chain_hash"])
    parts = {}
    for r in run("part_packing").collect():
        parts.setdefault((r["scope"], r["day"]), []).append(r)
    for k, own in parts.items():
        own.sort(key=lambda r: r["part_sequence"])
        rows, cut, size = groups[k], [[]], 0
        for x in rows:
            if cut[-1] and (len(cut[-1]) >= 40 or size + x["canonical_bytes"] > 16_000):
                cut.append([])
                size = 0
            cut[-1].append(x)
            size += x["canonical_bytes"]
        assert [(r["row_count"], r["canonical_row_bytes"], r["first_stream_sequence"], r["last_row_chain_hash"]) for r in own] == [(len(c), sum(x["canonical_bytes"] for x in c), c[0]["stream_sequence"], c[-1]["row_chain_hash"]) for c in cut]
    for r in run("frame_decode").collect():
        first = next(f for f in frames if (f["scope"], f["day"], f["sequence"]) == (r["scope"], r["day"], r["sequence"]))
        message = C.decode_message(first["frame"])[1]
        want = {0: (None, "TRUNCATED_FRAME", None), 1: (None, "CRC_MISMATCH", None)}.get(r["sequence"] % 5, ("BATCH", None, len(message["records"])))
        assert (r["kind"], r["error"], r["records"]) == want and (want[0] is None or r["fingerprint"] == C.payload_fingerprint(message["records"][0]).hex())
    scanned = run("wal_scan").collect()
    assert len(scanned) == len(frames) and all(r["agrees"] for r in scanned)
    # acknowledgements against a plain account of what was seen first, scope by scope
    acks = {(r["scope"], r["arrival"]): r for r in run("cursor_outcomes").collect()}
    for scope in {f["scope"] for f in frames}:
        seen, cursor, number, root = {}, 0, 0, D.ZERO
        for f in sorted((f for f in frames if f["scope"] == scope), key=lambda f: f["arrival"]):
            message, own = C.decode_message(f["frame"])[1], C.batch_hash(f["frame"])
            ack, key = acks[scope, f["arrival"]], (message["producer_session_id"], message["batch_sequence"])
            if key in seen:
                assert D.STATUSES[ack["status"] - 1] == ("DUPLICATE" if seen[key] == own else "SOURCE_STATE_CONFLICT")
            else:
                seen[key], number = own, number + 1
                root = C.entry_hash(number, root, f["now"], 0, own, f["frame"])
                if not message["copy_ticks_error"]:
                    cursor = max(cursor, *(r["time_msc"] for r in message["records"])) if ack["status"] not in (4, 5) else cursor
            assert (ack["sequence"], ack["cursor"], ack["entry_hash"]) == (number, cursor, root.hex())


def test_queries_cover_the_whole_table(spark):
    events = [(r["event_type"], r["event_id"]) for r in spark.read.parquet(f"{SF}/events.parquet").select("event_type", "event_id").collect()]
    found = catalogue.QUERIES["selected_ranges_by_symbol"](spark, SF)
    assert found.agg(F.sum(F.col("last_ordinal") - F.col("first_ordinal") + 1)).first()[0] == len(events) and found.select("symbol").distinct().count() == len({s for s, _ in events}) > 1
    bound = catalogue.QUERIES["raw_binding_all"](spark, SF)
    assert bound.count() == catalogue.QUERIES["list_raw_snapshots"](spark, SF).count()
    assert bound.where("bound").count() == bound.select("day").distinct().count()
    want = set()
    for symbol, event in events:
        h = crc32(f"object-{event}".encode())
        kind = "orphan" if not h % 7 and h % 5 else "missing" if h % 7 and not h % 5 else "duplicate" if h % 7 and not h % 11 else None
        want |= {(symbol, f"object-{event}", kind)} if kind else set()
    assert set(map(tuple, catalogue.QUERIES["orphan_missing_objects"](spark, SF).select("symbol", "object_id", "kind").collect())) == want


def test_selected_ranges_are_those_of_every_symbol(spark):
    ticks = [(r["symbol"], r["day"], r["sequence"], r["ordinal"]) for r in E.ticks(spark, SF).select("symbol", "day", "sequence", "ordinal").collect()]
    want, at = [], None
    for symbol, day, sequence, ordinal in sorted(ticks):
        if at == (symbol, day, sequence, ordinal - 1):
            want[-1][-1] = ordinal
        else:
            want.append([symbol, day, sequence, ordinal, ordinal])
        at = (symbol, day, sequence, ordinal)
    got = catalogue.QUERIES["selected_ranges"](spark, SF).select("symbol", "day", "sequence", "first_ordinal", "last_ordinal").collect()
    assert sorted(map(list, got)) == want and len({r[0] for r in want}) > 1


def test_native_matches_codec(spark):
    values = [0, 1, 255, 2**31, 2**63 - 1, -1, -(2**63)]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", N.little(F.col("v"), 8).alias("b"), N.little(F.col("v"), 4).alias("c")).collect()
    assert all(bytes(r["b"]) == C.i64(r["v"]) and bytes(r["c"]) == C.i64(r["v"])[:4] for r in rows)
    big = spark.createDataFrame([(str(v),) for v in (2**63, 2**64 - 1, 5)], "v string").select(F.col("v").cast("decimal(20,0)").alias("v")).select("v", N.u64(F.col("v")).alias("b"))
    assert all(bytes(r["b"]) == C.u64(int(r["v"])) for r in big.collect())
    assert [int(r["x"]) for r in big.select(N.from_little(F.col("b")).alias("x")).collect()] == [2**63, 2**64 - 1, 5]
    one = spark.range(1).select(N.lease(F.lit("a"), F.lit("é")).alias("l"), N.utc_day(F.lit(-1)).alias("d"), N.is_day(F.lit("2024-02-30")).alias("x"), N.is_relative_path(F.lit("a/../b")).alias("p")).first()
    assert one["l"] == C.lease_id("a", "é") and one["d"] == "1969-12-31" and not one["x"] and not one["p"]


def test_native_boundary_and_segment(spark):
    prints = [C.sha(bytes([k])) for k in range(3)]
    one = spark.range(1).select(
        N.hexed(N.boundary(F.lit(5), N.raw(D.ZERO), F.array(*(N.raw(p) for p in prints)))).alias("b"),
        N.segment_id([F.lit(x) for x in "abcde"], F.lit("k"), N.raw(D.ZERO), F.lit(1), F.lit(2), F.lit("GAP"), N.raw(D.ZERO)).alias("s"),
    ).first()
    assert one["b"] == C.boundary_digest(5, D.ZERO, prints).hex()
    scope = dict(zip(C.SCOPE, "abcde", strict=True)) | {"raw_day_manifest_key": "k", "raw_day_manifest_sha256": D.ZERO}
    assert one["s"] == C.segment_id(scope, 1, 2, "GAP", D.ZERO)


TRUTH = [
    ("claim", "Absent", "IntegrityStop", "claim_absent"), ("claim", "Unavailable", "Retry", "claim_unavailable"), ("claim", "Different", "IntegrityStop", "claim_not_exact"), ("claim", "Oversized", "ResourceStop", "claim_oversized"),
    ("raw_manifest", "Absent", "IntegrityStop", "raw_manifest_absent"), ("raw_object", "Absent", "IntegrityStop", "raw_object_absent"), ("raw_object", "Unavailable", "Retry", "raw_object_Unavailable"),
    ("parquet", "Absent", "Execute", "parquet_upload"), ("parquet", "Different", "IntegrityStop", "parquet_Different"), ("parquet", "Oversized", "ResourceStop", "parquet_Oversized"), ("part_manifest", "Absent", "Execute", "part_manifest_upload"),
    ("part_chain", "Ambiguous", "IntegrityStop", "part_chain_not_exact"), ("part_chain", "Absent", "IntegrityStop", "part_chain_absent"), ("replay_manifest", "Absent", "Execute", "replay_manifest_upload"),
    ("replay_graph", "Ambiguous", "IntegrityStop", "replay_graph_not_exact"), (None, None, "ReadyForReceipt", "complete"),
]


def test_reconciler(spark):
    names = [b for b, _, _ in publication.BARRIERS]
    bundle = [(b, f"{b}-1") for b in names]
    pubs = spark.createDataFrame([(str(k), True, True, True, bundle) for k in range(len(TRUTH))], "publication string, digest_ok boolean, within_budget boolean, complete boolean, bundle array<struct<barrier:string,object_id:string>>")
    seen = spark.createDataFrame([(str(k), b, f"{b}-1", kind if b == barrier else "Exact") for k, (barrier, kind, _, _) in enumerate(TRUTH) for b in names], "publication string, barrier string, object_id string, class string")
    got = {r["publication"]: (r["decision"], r["reason"]) for r in publication.reconcile(pubs, seen).collect()}
    assert got == {str(k): t[2:] for k, t in enumerate(TRUTH)}


def candidates(spark, rows):
    base = {"kind": "wal", "active": False, "recovered": True, "fresh": True, "covered": True, "remote_verified": True, "proof_sha256": "a" * 64, "limits_match": True, "observed_at": 100, "grace_not_before": 200, "recovery_floor": False}
    full = [base | {"artifact_id": f"a{k}", "path": f"/{k}", "first_sequence": k, "last_sequence": k, "proof_artifact": f"a{k}"} | more for k, more in rows]
    return spark.createDataFrame(full)


def planned(spark, rows, **policy):
    own = retention.Policy(**({"now": 300, "durable_now": 300, "grace": 100, "expected_start": 1, "max_candidates": 10} | policy))
    return [tuple(r) for r in retention.plan(candidates(spark, rows), own).collect()]


def test_prune_plan(spark):
    two = planned(spark, [(1, {}), (2, {})])
    assert two == planned(spark, [(2, {}), (1, {})]) and [r[1] for r in two] == ["prune", "prune"]
    assert retention.plan_digest(two) == retention.plan_digest(two[::-1])
    assert [r[2] for r in planned(spark, [(1, {}), (2, {})], now=299)] == ["clock_regression"] * 2
    assert planned(spark, [(1, {"grace_not_before": 301})])[0][2] == "grace_not_elapsed"
    assert planned(spark, [(1, {"remote_verified": False})], remote_required=True)[0][2] == "remote_verified_missing"
    assert [r[2] for r in planned(spark, [(1, {}), (3, {}), (4, {})])] == [None, "wal_prefix_gap", "wal_prefix_blocked"]
    assert planned(spark, [(1, {"kind": "replay_outbox"})])[0][2] == "artifact_policy_unimplemented"
    assert [r[2] for r in planned(spark, [(1, {}), (2, {})], max_candidates=1)] == [None, "max_prune_candidates"]
    with pytest.raises(Exception, match="duplicate"):
        planned(spark, [(1, {}), (2, {"path": "/1"})])


def test_disk_and_readiness(spark):
    policy = {"critical": 250, "max_pending": 5, "max_pending_bytes": 100}
    rows = spark.createDataFrame([(300, False, 0, 0), (200, False, 0, 0), (800, True, 0, 0), (None, False, 0, 0), (800, False, 5, 0)], "free long, poisoned boolean, n long, b long")
    got = rows.select(N.disk_class(F.col("free"), 500, 250, 100), operations.ready(F.col("free"), F.col("poisoned"), F.col("n"), F.col("b"), policy)).collect()
    assert [tuple(r) for r in got] == [("high", True), ("critical", False), ("normal", False), ("emergency", False), ("normal", False)]


def test_sentinel_and_disjoint_ordinals(spark):
    rows = [("d", 1, 0, 100, 1, 0), ("e", 1, 1, 100, 2, 0), ("d", 1, 2, 300, 3, 0), ("d", 2, 0, None, None, 4)]
    ticks = spark.createDataFrame(rows, "day string, sequence long, ordinal long, time_msc long, capture_sequence long, error int").withColumn("previous_hash", F.col("sequence") - 1).withColumn("entry_hash", F.col("sequence"))
    day = selection.day_selection(ticks).where("day = 'd'").first()
    assert (day["accepted"], day["errors"], day["first_sequence"], day["last_sequence"], day["source_watermark"]) == (2, 1, 1, 2, 300)
    found = sorted((r["sequence"], r["first_ordinal"], r["last_ordinal"]) for r in selection.ranges(ticks).where("day = 'd'").collect())
    assert found == [(1, 0, 0), (1, 2, 2), (2, 0, 0)]


def test_revisions_only_for_what_changed(spark):
    now = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "day string, n long, digest string")
    known = spark.createDataFrame([("a", 1, 1, "p"), ("b", 1, 4, "q")], "day string, revision long, n long, digest string")
    got = sorted((r["day"], r["revision"], r["previous"]) for r in selection.next_revisions(now.drop("digest").withColumn("digest", F.lit("d")), known, ["day"], ["n"]).collect())
    assert got == [("b", 2, "q"), ("c", 1, None)]


def test_wal_files_and_data_source(spark, tmp_path):
    rows = E.segments(spark, SF).limit(3).collect()
    for k, r in enumerate(rows):
        (tmp_path / f"{k}.rtw").write_bytes(bytes(r["content"]))
    entries = wal.entries(spark, str(tmp_path))
    wal.register(spark)
    again = spark.read.format("wal").option("path", str(tmp_path)).load()
    assert entries.count() == again.count() > 0
    assert wal.segments(spark, str(tmp_path)).count() == 3
    store = wal.promote(spark, wal.files(spark, str(tmp_path)), f"file://{tmp_path}/store")
    assert store.count() == 3 == wal.promote(spark, wal.files(spark, str(tmp_path)).where("path not like '%store%'"), f"file://{tmp_path}/store").count()
    one = store.agg(F.min("key")).first()[0]
    plan = store.withColumn("bytes", F.col("bytes") + F.when(F.col("key") == one, 1).otherwise(0))
    assert sorted(r["state"] for r in catalog.fetched(plan, spark, f"{tmp_path}/store").collect()) == ["different", "exact", "exact"]
    bad = bytearray(bytes(rows[0]["content"]))
    bad[200] ^= 1
    (tmp_path / "0.rtw").write_bytes(bytes(bad))
    with pytest.raises(Exception, match="Integrity|checksum|hash"):
        wal.entries(spark, str(tmp_path)).count()


def test_stream_equals_batch(spark, tmp_path):
    frames = E.frames(spark, SF).select("scope", "arrival", "now", "frame")
    frames.repartition(1).sortWithinPartitions("arrival").write.parquet(f"{tmp_path}/in")
    expected = gateway.acknowledge(spark.read.parquet(f"{tmp_path}/in"), lease_s=10**9)
    stream = gateway.acknowledge_stream(spark.readStream.schema(frames.schema).parquet(f"{tmp_path}/in"), lease_s=10**9)
    q = stream.writeStream.format("memory").queryName("acks").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("acks").collect())) == sorted(map(tuple, expected.collect()))
    assert gateway.metrics(expected).count() >= 1


def test_stream_knows_batches_of_any_age(spark, tmp_path):
    """Retries and an altered resend, each in a later micro-batch, after more batches than the stream once remembered."""
    row = {"time": 1, "volume": 1, "flags": 0, "capture_sequence": 1} | {n: 1 for n in ("bid_bits", "ask_bits", "last_bits", "volume_real_bits")}
    base = C.decode_message(bytes(E.frames(spark, SF).first()["frame"]))[1]
    send = lambda k, more=0: C.encode_message("BATCH", base | {"batch_sequence": k, "returned_count": 1, "copy_ticks_error": 0, "records": [row | {"time_msc": 1000 + k + more}]})
    numbers = [(k, 0) for k in range(1, 4200)]
    for n, some in enumerate((numbers, [(1, 0), (4199, 0)], [(2, 9000)])):
        rows = [("s", 10_000 * n + i, 0, bytearray(send(k, more))) for i, (k, more) in enumerate(some)]
        spark.createDataFrame(rows, "scope string, arrival long, now long, frame binary").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema("scope string, arrival long, now long, frame binary").parquet(f"{tmp_path}/in")
        q = gateway.acknowledge_stream(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out")
    want = gateway.acknowledge(spark.read.parquet(f"{tmp_path}/in"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [r["status"] for r in got.orderBy("arrival").collect()][-3:] == [3, 3, 8]


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_roots_do_not_depend_on_partitions(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = {r["user_id"]: r["root"] for r in catalogue.row_chain_root(spark, SF).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert {r["user_id"]: r["root"] for r in catalogue.row_chain_root(spark, SF).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_manifests_and_reader(spark, tmp_path):
    scope = {"dataset_id": "demo", "day_definition_id": "utc-day-v1", "date": "2024-03-09", "replay_contract_id": "replay-v1", "conversion_id": "conversion-v1", "raw_day_manifest_key": "k", "raw_day_manifest_sha256": "a" * 64}
    conversion = {k: "b" * 64 for k in ("converter_build_id", "dependency_lock_hash", "writer_configuration_hash", "target_platform_contract")}
    part = lambda a, b, before, last: {"canonical_row_bytes": 9, "row_count": b - a + 1, "part_bytes": 5, "part_key": f"p{a}", "part_sha256": "c" * 64, "first_stream_sequence": a, "last_stream_sequence": b, "previous_row_chain_hash": before, "first_row_chain_hash": "d" * 64, "last_row_chain_hash": last}
    parts = publication.part_manifests(scope, conversion, [part(0, 4, D.ZERO.hex(), "1" * 64), part(5, 9, "1" * 64, "2" * 64)])
    with pytest.raises(C.FormatError):
        publication.part_manifests(scope, conversion, [part(0, 4, D.ZERO.hex(), "1" * 64), part(6, 9, "1" * 64, "2" * 64)])
    day = publication.replay_day_manifest(scope, conversion, parts, 1, None, "provisional")
    assert set(day["manifest"]) == publication.DAY_KEYS
    later = publication.replay_day_manifest(scope, conversion, parts, 2, day["digest"], "provisional")
    for d in (day, later):
        (tmp_path / d["key"].rsplit("/", 1)[-1]).write_bytes(d["bytes"])
    replay = catalog.manifests(spark, str(tmp_path), D.REPLAY_DAY)
    own = spark.createDataFrame([(p["key"], p["digest"]) for p in parts], "key string, digest string")
    scopes = spark.createDataFrame([("s", "demo", "v", "x")], "scope_key string, dataset_id string, provider_id string, symbol string")
    archive = catalog.Archive(scopes, replay, replay, own)
    assert archive.resolve_replay("demo", "2024-03-09")["revision"] == 2
    assert archive.resolve_replay("demo", "2024-03-09", revision=1)["digest"] == day["digest"]
    assert [r["part"] for r in archive.replay_plan(archive.resolve_replay("demo", "2024-03-09")).collect()] == [0, 1]
    assert archive.revision_faults().count() == 0
    with pytest.raises(catalog.ReadError) as missing:
        archive.resolve("demo", "e" * 64)
    assert missing.value.status == 404
    handle = catalog.api(archive, most=1)
    assert handle("/v1/datasets", {}) == (200, {"items": [{"dataset_id": "demo"}], "next_cursor": None})
    assert handle("/v1/snapshots/replay", {"dataset": ["demo"]})[0] == 413
    assert handle("/v1/scopes", {})[0] == 400 and handle("/x", {})[0] == 404
    (tmp_path / f"replay-day-3-{'f' * 64}.json").write_bytes(day["bytes"])
    with pytest.raises(Exception, match="digest"):
        catalog.manifests(spark, str(tmp_path), D.REPLAY_DAY).count()


def test_manifest_by_digest_and_health(spark):
    table = lambda *rows: spark.createDataFrame(rows, "digest string, path string")
    a, b, c = ("a" * 64, "b" * 64, "c" * 64)
    archive = catalog.Archive(table(("s", "p")), table((a, "raw"), (b, "x"), (b, "y")), table((a, "replay"), (b, "replay"), (c, "replay")))
    handle = catalog.api(archive, health=lambda: {"status": "healthy"})
    of = lambda d, q=None: handle(f"/v1/manifests/{d}", q or {})
    assert [of(d)[1]["items"][0]["path"] for d in (a, c)] == ["raw", "replay"]
    assert [of(b)[0], of("d" * 64)[0], of("d")[0], of("0" * 64)[0], of(a, {"x": ["1"]})[0]] == [409, 404, 400, 400, 400]
    assert handle("/v1/health", {}) == (200, {"items": [{"status": "healthy"}], "next_cursor": None})
    assert handle("/v1/health", {"x": ["1"]})[0] == 400 and catalog.api(archive)("/v1/health", {})[0] == 502


def test_rank_without_one_task(spark):
    rows = spark.range(0, 300_000, 3)
    got = chains.ranked(rows, "id", "rank", width=1000)
    assert got.where("rank <> id div 3 + 1").count() == 0 and got.count() == 100_000


def test_rank_in_groups_without_one_task_a_group(spark):
    rows = [(s, k * 37 + j) for j, s in enumerate(("a", "b", None)) for k in range(300)]
    got = chains.ranked(spark.createDataFrame(rows, "s string, id long").repartition(5), "id", "rank", width=100, by=("s",)).collect()
    assert sorted((r["s"] or "", r["id"], r["rank"]) for r in got) == sorted((s or "", k, 1 + (k // 37)) for s, k in rows)


def test_entries_are_chained_as_a_stream():
    frames = [(k + 1, 1000 + k, bytes([k % 251]) * 60) for k in range(3000)]
    taken, want, root = [], [], D.ZERO

    def batches():
        for k in range(0, 3000, 1500):
            taken.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*(("s", *f) for f in frames[k : k + 1500]), strict=True)], names=["symbol", "sequence", "wall", "frame"])

    for sequence, wall, frame in frames:
        before, root = root, C.entry_hash(sequence, root, wall, sequence, C.batch_hash(frame), frame)
        want.append(("s", sequence, before.hex(), root.hex()))
    out = raw_days.chained((pa.scalar("s"),), batches())
    first = next(out)
    assert taken == [0] and first.num_rows <= 1500  # what is done is given on before more is read
    assert [tuple(r.values()) for b in (first, *out) for r in b.to_pylist()] == want


def ticks_of(n, size):
    rows = [{"symbol": "s", "day": "2024-01-01", "time": k // 1000, "time_msc": k, "bid": 7 * k, "volume": k, "capture_sequence": k + 1} for k in range(n)]
    return [pa.RecordBatch.from_pylist(rows[k : k + size]) for k in range(0, n, size)]


@pytest.mark.parametrize("n", [1, 16, 17, 48, 63, 64, 65, 80, 81, 111, 112, 113, 160, 161, 1000])
def test_polls_do_not_depend_on_batches(n):
    found = [[f for b in E.polled((pa.scalar("s"), pa.scalar("2024-01-01")), iter(ticks_of(n, size))) for f in b.to_pylist()] for size in (7, 64, 2000)]
    assert found[0] == found[1] == found[2]
    starts = list(range(0, max(1, n - E.POLL + E.STEP), E.STEP))
    assert [f["arrival"] - 1 for f in found[0]] == starts and [f["sequence"] for f in found[0]] == list(range(1, len(starts) + 1))
    for f, start in zip(found[0], starts, strict=True):
        assert [r["time_msc"] for r in C.decode_message(f["frame"])[1]["records"]] == list(range(start, min(n, start + E.POLL))) and len(f["ordinals"]) == min(n - start, E.POLL)


def test_frames_and_acknowledgements_are_streams():
    taken = []

    def watched(batches):
        for k, b in enumerate(batches):
            taken.append(k)
            yield b

    frames = E.polled((pa.scalar("s"), pa.scalar("2024-01-01")), watched(ticks_of(40_000, 10_000)))
    assert next(frames).num_rows and taken == [0]  # what is done is given on before more is read
    rest = list(frames)
    taken.clear()
    acks = gateway.folded("s", watched(rest), gateway.State(lease_s=10**9))
    first = next(acks)
    assert taken == [0] and first.num_rows == rest[0].num_rows
    state = gateway.State(lease_s=10**9)
    want = [state.accept(f["frame"], f["now"]) for b in rest for f in b.to_pylist()]
    got = [r for b in (first, *acks) for r in b.to_pylist()]
    assert [{k: v for k, v in r.items() if k not in ("scope", "arrival")} for r in got] == want


def test_regressions_of_runs_are_those_of_lists(spark):
    rng, lists = random.Random(5), [[], [0], [0, 1], [0, 1, 2, 5], [0, 1, 2, 5, 6], [0, 1, 2, 5, 6, 9], [0, 1, 2], [0, 1, 2, 4], [1, 2], [3, 1], [3, 1, 2], None, [0, 2]]
    rows = [(s, k + 1 + (k > 7), 10 + k - 3 * (k % 11 == 5), 10 + k, rng.choice(lists)) for s in range(40) for k in range(15)]

    def runs(numbers):
        out = []
        for x in numbers or []:
            if out and out[-1][1] == x - 1:
                out[-1] = (out[-1][0], x)
            else:
                out.append((x, x))
        return None if numbers is None else out

    names = "s long, revision long, source_watermark long, capture_watermark long"
    listed = selection.watermark_regressions(spark.createDataFrame(rows, f"{names}, ranges array<long>"), "s")
    packed = selection.watermark_regressions(spark.createDataFrame([(*r[:4], runs(r[4])) for r in rows], f"{names}, runs array<struct<first:long,last:long>>"), "s")
    want = {}
    for (s, n, at, _, now), (_, _, was, _, old) in zip(rows[1:], rows, strict=False):
        want[s, n] = n > 1 and (at < was or bool(old) and now is not None and now[: len(old)] != old)
    for got in (listed, packed):
        assert {(r["s"], r["revision"]): r["regression"] for r in got.collect()} == want | {(0, 1): False}


def test_regressions_do_not_sort_whole_lists(spark):
    plan = catalogue.QUERIES["watermark_regressions"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0" not in plan  # no list a revision, whose sizes add up to the square of their number
    assert "row_number() windowspecdefinition(symbol" in plan and not re.search(r"row_number\(\) windowspecdefinition\(symbol#\d+, \w+#\d+L? ASC", plan)  # nor one sort a symbol


@pytest.mark.parametrize("made", [ingest.logged, raw_days.records])
def test_records_are_numbered_without_one_sort_a_symbol(spark, made):
    plan = made(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(symbol" in plan and not re.search(r"row_number\(\) windowspecdefinition\(symbol#\d+, \w+#\d+L? ASC", plan)


def test_segments_are_cut_across_batches(spark):
    rows = spark.createDataFrame([(s, k, 60, k * 10) for s in ("s", "t") for k in range(50)], "scope string, sequence long, bytes long, wall_s long").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = sorted((r["scope"], r["sequence"], r["segment"]) for r in gateway.segment_groups(rows, 150).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(s, k, k // 3) for s in ("s", "t") for k in range(50)]


def test_health(spark):
    rows = spark.createDataFrame([("a", ["healthy"]), ("b", ["degraded", "failed"])], "scope string, states array<string>")
    assert [tuple(r) for r in operations.scope_health(rows).collect()] == [("a", "healthy"), ("b", "failed")]
    with pytest.raises(Exception, match="twice"):
        operations.scope_health(rows.union(rows)).count()
