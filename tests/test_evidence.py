"""Proofs and plans to the contract's bytes, spellings of addresses and paths, linkage and budgets in ranges, altered history."""

import copy
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import bundles, chains, continuity, operations, proofs, retention
from tidemark.plans import evidence as Q

SF = "/root/testdata/sf0.001"
LIMITS = {"max_proof_objects": 10, "max_proof_bytes": 1000, "max_manifest_nodes": 10}


def proof(**more):
    h = lambda c: f"{ord(c):02x}" * 32
    return {
        "artifact_kind": "wal_segment", "bytes": 12, "content_sha256": h("2"), "covering_manifest_digest": h("4"), "covering_manifest_key": "immutable/snapshots/raw/day-1.json", "grace_not_before_unix_ms": 200,
        "limits": dict(LIMITS), "observed_wall_time_unix_ms": 100, "proof_version": "retention-proof-v1", "remote_observation": {"bytes": 12, "class": "Exact", "full_key": "immutable/raw/segment-22", "sha256": h("2")},
        "replay_identity": None, "scope_config_hash": h("s"), "trusted_relative_path": "sealed/segment-1.wal", "verification_report_digest": h("5"),
        "wal_range": {"end_chain_root": h("1"), "end_sequence": 1, "start_chain_root": "0" * 64, "start_sequence": 1},
    } | more


def test_proofs_need_exact_fresh_evidence():
    assert len(proofs.proof_digest(proof())) == 64
    seen = proof()["remote_observation"]
    bad = [
        {"remote_observation": seen | {"class": "Different"}}, {"remote_observation": seen | {"bytes": 13}}, {"bytes": 0}, {"grace_not_before_unix_ms": 99}, {"trusted_relative_path": "/abs"}, {"trusted_relative_path": "a//b"},
        {"covering_manifest_key": "a/../b"}, {"content_sha256": "0" * 64}, {"scope_config_hash": "ABC"}, {"wal_range": None}, {"wal_range": proof()["wal_range"] | {"end_sequence": 0}}, {"wal_range": proof()["wal_range"] | {"start_chain_root": "1" * 64}},
        {"limits": LIMITS | {"max_proof_bytes": 0}}, {"proof_version": "retention-proof-v2"}, {"extra": 1},
    ]
    for change in bad:
        with pytest.raises(C.FormatError):
            proofs.proof_digest(proof(**change))


def test_checkpoints_are_bound_to_their_proof():
    own = proofs.checkpoint(proof(), "0" * 64)
    proofs.check_checkpoint(own)
    assert C.parse_canonical(C.canonical_json(own), set(proofs.CHECKPOINT_KEYS)) == own
    for name, value in (("last_segment_sha256", "0" * 64), ("retained_chain_root", "9" * 64), ("end_sequence", 2), ("retention_proof_digest", "7" * 64), ("checkpoint_version", "x")):
        with pytest.raises(C.FormatError):
            proofs.check_checkpoint(own | {name: value})
    other = copy.deepcopy(own)
    other["retention_proof"]["bytes"] = 13
    with pytest.raises(C.FormatError):
        proofs.check_checkpoint(other)


def test_the_executor_writes_checkpoints_with_proofs(spark, tmp_path):
    root = f"file://{tmp_path}"
    (tmp_path / "sealed").mkdir()
    first, second = proof(), proof(wal_range=proof()["wal_range"] | {"start_sequence": 2, "end_sequence": 5, "start_chain_root": "31" * 32, "end_chain_root": "61" * 32})
    actions = []
    for k, p in enumerate((first, second)):
        (tmp_path / f"sealed/s{k}").write_bytes(b"x")
        own = p["wal_range"]
        actions.append({"artifact_id": f"a{k}", "name": f"s{k}", "start_sequence": own["start_sequence"], "end_sequence": own["end_sequence"], "retained_chain_root": own["end_chain_root"], "segment_sha256": p["content_sha256"], "proof": p})
    executor = retention.Executor(spark, root)
    assert executor.execute(actions) == ["a0", "a1"] and not list((tmp_path / "sealed").iterdir())
    found = executor.checkpoints()
    assert [c["end_sequence"] for c in found] == [1, 5] and found[1]["previous_checkpoint_digest"] == found[0]["digest"]
    data = json.loads((tmp_path / "checkpoints" / f"{5:020d}.json").read_bytes())
    assert data["retention_proof"] == second and data["retention_proof_digest"] == proofs.proof_digest(second)
    with pytest.raises(C.FormatError, match="another segment"):
        executor.execute([actions[1] | {"start_sequence": 6, "end_sequence": 9}])


def test_spark_proofs_are_the_contracts_documents(spark):
    rows = Q.artifacts(spark, SF).drop("k")
    row = rows.first()
    every = spark.createDataFrame([row], rows.schema)
    claims = spark.createDataFrame([(row["symbol"], "c" * 64, 10, "c" * 64)], "symbol string, claim_sha256 string, claim_bytes long, expected_sha256 string")
    objects = every.select("object_key", "sha256", "bytes")
    manifests = every.select("symbol", "day", F.lit(1).alias("revision"), F.lit("d" * 64).alias("digest"), F.lit(None).cast("string").alias("previous"), F.lit(7).alias("bytes"), F.lit("m/k.json").alias("key"), F.lit(99).cast("long").alias("closed_s"))
    coverage = every.select("symbol", "day", "object_key", F.lit(1).alias("revision"), F.lit(0).alias("others"), F.lit(0).alias("other_bytes"))
    limits = LIMITS | {"max_proof_bytes": 1 << 30}
    seen = proofs.observed(every, claims, objects, manifests, coverage, limits, "symbol")
    got = proofs.retention_proofs(seen, limits, 5, 11).first()
    value = C.parse_canonical(got["proof"].encode(), set(proofs.PROOF_KEYS))
    assert got["class"] == "Exact" and proofs.proof_digest(value) == got["proof_sha256"] == C.digest(D.PROOF, value).hex()
    assert value["observed_wall_time_unix_ms"] == 99_000 and value["grace_not_before_unix_ms"] == 99_011
    for left_out in (claims.limit(0), objects.limit(0), manifests.limit(0)):
        tables = [left_out if x.columns == left_out.columns else x for x in (claims, objects, manifests)]
        assert proofs.observed(every, *tables, coverage, limits, "symbol").first()["class"] == "Absent"
    assert proofs.observed(every, claims, objects, manifests, coverage.limit(0), limits, "symbol").first()["class"] == "Ambiguous"
    assert proofs.observed(every, claims, objects, manifests, coverage, limits | {"max_proof_objects": 2}, "symbol").first()["class"] == "Oversized"


def test_plan_documents(spark):
    action = {"artifact_id": "b", "artifact_kind": "wal_segment", "bytes": 1, "content_sha256": "1" * 64, "proof_digest": "2" * 64, "trusted_path": "p", "wal_end_sequence": 2, "wal_start_sequence": 1}
    facts = {"active_recovery_floor": 0, "current_wall_time_unix_ms": 5, "disk_class": "high", "durable_wall_time_unix_ms": 4, "grace_ms": 1, "require_remote_verified": True, "wal_expected_start": 1}
    one = proofs.plan_document([action, action | {"artifact_id": "a"}], [("z", "x"), ("c", "y")], **facts)
    two = proofs.plan_document([action | {"artifact_id": "a"}, action], [("c", "y"), ("z", "x")], **facts)
    assert proofs.plan_digest(one) == proofs.plan_digest(two) == C.digest(D.PRUNE_PLAN, one).hex() and one["plan_version"] == "prune-plan-v2"
    with pytest.raises(C.FormatError):
        proofs.plan_document([], [], grace_ms=1)
    base = {"active": False, "recovered": True, "fresh": True, "covered": True, "remote_verified": True, "proof_sha256": "a" * 64, "limits_match": True, "observed_at": 100, "grace_not_before": 200, "recovery_floor": False, "kind": "wal"}
    rows = [base | {"artifact_id": i, "path": f"/{i}", "proof_artifact": i, "first_sequence": k, "last_sequence": k} for k, i in enumerate("cab", 1)]
    policy = retention.Policy(now=300, durable_now=300, grace=100, expected_start=1, max_candidates=2)
    assert [tuple(r)[:2] for r in retention.plan(spark.createDataFrame(rows), policy).collect()] == [("a", "prune"), ("b", "prune"), ("c", "blocked")]  # by id, not by sequence


@pytest.mark.parametrize(
    ("value", "want"),
    [("127.0.0.1:80", "127.0.0.1 80"), ("localhost:80", "127.0.0.1 80"), (" LOCALHOST.:080 ", "127.0.0.1 80"), (":80", "* 80"), ("0.0.0.0:80", "* 80"), ("[::]:80", "* 80"), ("[0:0::1]:80", "::1 80"), ("[::ffff:10.0.0.1]:5", "10.0.0.1 5"), ("Host.Example.:9", "host.example 9"), ("host", "host"), ("h:0", "h:0"), ("h:70000", "h:70000"), ("[::1:80", "[::1:80"), (None, None)],
)
def test_addresses(value, want):
    assert operations.address(value) == want


def test_collisions_however_they_are_spelled(spark):
    names = "scope string, scope_key string, listener string, publisher_id string, credential_id string, wal_dir string, spool_dir string"
    scope = lambda n, listener, wal, spool="": (n, f"k{n}", listener, f"p{n}", f"c{n}", wal, spool or f"/s/{n}")
    rows = [scope("a", "127.0.0.1:80", "/w/a"), scope("b", "localhost:80", "/w//a/x"), scope("c", "[::1]:80", "/w/ab"), scope("d", "host:81", "/w/q/../d"), scope("e", "0.0.0.0:81", "w/d/./"), scope("f", "x:82", "/f", "/z/../s/a/y"), scope("g", ":80", "/g")]
    got = {(r["left"], r["right"], r["shared"]) for r in operations.collisions(spark.createDataFrame(rows, names)).collect()}
    assert got == {("a", "b", "listener"), ("a", "g", "listener"), ("b", "g", "listener"), ("c", "g", "listener"), ("d", "e", "listener"), ("a", "b", "path"), ("d", "e", "path"), ("a", "f", "path")}
    root = [scope("r", "r:1", "/"), scope("s", "s:2", "/deep/er")]
    assert {(r["left"], r["right"], r["shared"]) for r in operations.collisions(spark.createDataFrame(root, names)).collect()} == {("r", "s", "path")}


@pytest.mark.parametrize("width", [3, 1 << 16])
def test_linkage_in_ranges(spark, monkeypatch, width):
    monkeypatch.setattr(chains, "RANGE", width)
    rng = random.Random(width)
    rows = []
    for s in "ab":
        before = "0"
        for n in range(1, 40):
            own = f"{s}{n}"
            if rng.random() < 0.1:
                continue  # a lost entry
            rows.append((s, n, "bad" if rng.random() < 0.1 else before, own))
            before = own
    table = spark.createDataFrame(rows, "s string, n long, p string, h string").repartition(3)
    got = sorted((r["s"], r["n"], r["place"], r["faults"]) for r in chains.linked_in_ranges(table, ["s"], "n", "p", "h").collect())
    want = []
    for s in "ab":
        last, faults = None, 0
        for place, (_, n, p, h) in enumerate([r for r in rows if r[0] == s], 1):
            faults += last is not None and not (n == last[0] + 1 and p == last[1])
            want.append((s, n, place, faults))
            last = n, h
    assert got == want and any(f for *_, f in got)


@pytest.mark.parametrize("width", [4, 1 << 16])
def test_shared_budgets(spark, monkeypatch, width):
    monkeypatch.setattr(chains, "RANGE", width)
    rng = random.Random(1)
    rows = [(n, rng.randrange(5), rng.randrange(9)) for n in range(60)]
    table = spark.createDataFrame(rows, "n long, a long, b long").repartition(3)
    for limits in ({"a": 40, "b": 100}, {"a": 100, "b": 60}, {"a": 0, "b": 0}, {"a": 10**6, "b": 10**6}):
        total, stop, want = {"a": 0, "b": 0}, None, []
        for n, a, b in rows:
            total = {"a": total["a"] + a, "b": total["b"] + b}
            stop = stop or next((c for c in "ab" if total[c] > limits[c]), None)
            want.append((n, stop))
        assert sorted((r["n"], r["stopped_by"]) for r in chains.shared_budget(table, "n", limits).collect()) == want


def changed_by_trying(tail, new):
    """Every length and every place, compared record by record."""
    for n in range(min(len(tail), len(new)), 2, -1):
        differ = [k for k in range(n) if tail[len(tail) - n + k] != new[k]]
        if len(differ) == 1 and 0 < differ[0] < n - 1:
            fits = 0
            for j in range(len(tail) - n + 1):
                other = [k for k in range(n) if tail[j + k] != new[k]]
                fits += len(other) == 1 and 0 < other[0] < n - 1
            return len(tail) - n + differ[0] if fits == 1 else None
    return None


def test_altered_history_in_linear_time():
    rng, found = random.Random(7), 0
    for _ in range(4000):
        letters = "ab" if rng.random() < 0.5 else "abcdefgh"
        tail = rng.choices(letters, k=rng.randrange(0, 14))
        new = tail[rng.randrange(len(tail) + 1) :] + rng.choices(letters, k=rng.randrange(0, 5))
        if new and rng.random() < 0.7:
            new[rng.randrange(len(new))] = rng.choice(letters)
        got = continuity.history_change(tail, new)
        assert got == changed_by_trying(tail, new)
        found += got is not None
    assert found > 100
    tail = [bytes([k % 251]) * 8 + k.to_bytes(4, "big") for k in range(4096)]
    new = tail[1000:] + [b"new"] * 1000
    new[1500] = b"altered"
    began = time.process_time()
    assert continuity.history_change(tail, new) == 2500
    assert time.process_time() - began < 0.5
    same = [b"x"] * 4096  # the worst case of comparing slices
    began = time.process_time()
    assert continuity.history_change(same, [b"x"] * 2000 + [b"y"] + [b"x"] * 2095) == 2000
    assert time.process_time() - began < 0.5


def test_bundles_are_sealed_if_every_fact_holds(spark):
    """Each spoiled fact names itself, in the contract's order; bundles without parts fail."""
    part = lambda b, n, **more: {"b": b, "part_sequence": n, "key": f"k{b}{n}", "digest": f"{n:064x}", "row_count": 2, "first_stream_sequence": 2 * n, "last_stream_sequence": 2 * n + 1, "previous_row_chain_hash": f"{n:064x}", "last_row_chain_hash": f"{n + 1:064x}", "bytes": 10, "verified": True} | more
    names = ("good", "many", "late", "shut", "other", "torn", "raw", "before", "rows", "root", "big", "empty")
    files, said = [], []
    for b in names[:-1]:
        own = [part(b, n) for n in range(4 if b == "big" else 2)]
        said += own[:-1] if b == "many" else [own[0], own[1] | {"row_count": 3}] if b == "other" else own
        if b == "late":
            own = [p | {"part_sequence": p["part_sequence"] + 1} for p in own]
        if b == "shut":
            own[1]["verified"] = False
        if b == "torn":
            own[1] = own[1] | {"previous_row_chain_hash": "f" * 64}
            said[-1] = own[1]
        files += own
    types = "b string, part_sequence long, key string, digest string, row_count long, first_stream_sequence long, last_stream_sequence long, previous_row_chain_hash string, last_row_chain_hash string, bytes long, verified boolean"
    parts, manifests = (spark.createDataFrame(x, types) for x in (files, said))
    roots = {r["b"]: r["part_set_root"] for r in chains.part_set_root(manifests, ["b"]).collect()}
    rows = [(b, 2 if b == "before" else 1, "x" * 64 if b == "before" else None, f"raw-{b}", 9 if b == "rows" else 8 if b == "big" else 4, "0" * 64 if b == "root" else roots.get(b, "")) for b in names]
    table = spark.createDataFrame(rows, "b string, revision int, previous string, raw_digest string, row_count long, part_set_root string")
    raws = table.where("b <> 'raw'").select("b", "raw_digest")
    known = spark.createDataFrame([("before", 1, "y" * 64)], "b string, revision int, digest string")
    got = {r["b"]: r["fault"] for r in bundles.bundle_faults(table, parts, manifests, raws, known, {"max_parts": 3, "max_total_parquet_bytes": 1000}, "b").collect()}
    want = {"good": None, "many": "part_count", "late": "part_sequence", "shut": "part_object", "other": "part_manifest", "torn": "part_graph", "raw": "raw_manifest", "before": "predecessor", "rows": "replay_manifest", "root": "replay_manifest", "big": "limits", "empty": "part_count"}
    assert got == want
