"""Why a local artifact may be deleted, as canonical documents: retention proofs, checkpoints that hold them, and plans.

A proof is made of what was observed now: the publisher's claim, the object, the day's manifests from the
first revision on, and every object of the covering manifest's chain. All candidates are observed in one plan. Each
step has a class, and the first one that is not Exact is the candidate's; what the steps would read is
counted against the limits of objects, bytes and manifest nodes in the order of the steps, so a candidate that would
read more is Oversized. The documents are the contract's, to the byte; their digests are made by the JVM.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import selection

#: The fields of the contract's documents.
PROOF_KEYS = (
    "artifact_kind", "bytes", "content_sha256", "covering_manifest_digest", "covering_manifest_key", "grace_not_before_unix_ms", "limits", "observed_wall_time_unix_ms", "proof_version", "remote_observation",
    "replay_identity", "scope_config_hash", "trusted_relative_path", "verification_report_digest", "wal_range",
)
LIMIT_KEYS = ("max_manifest_nodes", "max_proof_bytes", "max_proof_objects")
RANGE_KEYS = ("end_chain_root", "end_sequence", "start_chain_root", "start_sequence")
REMOTE_KEYS = ("bytes", "class", "full_key", "sha256")
CHECKPOINT_KEYS = ("checkpoint_version", "end_sequence", "last_segment_sha256", "previous_checkpoint_digest", "retained_chain_root", "retention_proof", "retention_proof_digest")
ACTION_KEYS = ("artifact_id", "artifact_kind", "bytes", "content_sha256", "proof_digest", "trusted_path", "wal_end_sequence", "wal_start_sequence")
PROOF_VERSION, CHECKPOINT_VERSION, PLAN_VERSION = "retention-proof-v1", "prune-checkpoint-v1", "prune-plan-v2"
ZERO = D.ZERO.hex()


def _require(good: bool, what: str) -> None:
    if not good:
        raise C.FormatError("INVALID_FIELD", what)


def _hash(value: Any) -> bool:
    return isinstance(value, str) and len(value) == 64 and all(c in "0123456789abcdef" for c in value) and value != ZERO


def _path(value: Any) -> bool:
    return isinstance(value, str) and 0 < len(value.encode()) <= D.MAX_PATH and not any(c in value for c in "\\\r\n") and all(p not in ("", ".", "..") for p in value.split("/"))


def _count(value: Any, least: int = 1) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and least <= value < 2**64


def check_proof(p: dict[str, Any]) -> None:
    """Raise unless a proof is whole and says what it must: exact evidence of one identity, within limits, not before its time."""
    _require(set(p) == set(PROOF_KEYS) and p["proof_version"] == PROOF_VERSION and bool(p["artifact_kind"]), "proof fields or version")
    _require(_path(p["trusted_relative_path"]) and _path(p["covering_manifest_key"]), "proof path")
    _require(_count(p["bytes"]) and _count(p["observed_wall_time_unix_ms"]) and _count(p["grace_not_before_unix_ms"], p["observed_wall_time_unix_ms"]), "proof size or time")
    _require(all(_hash(p[k]) for k in ("content_sha256", "scope_config_hash", "covering_manifest_digest", "verification_report_digest")), "proof hash")
    seen, own, limits = p["remote_observation"], p["wal_range"], p["limits"]
    _require(set(seen) == set(REMOTE_KEYS) and seen["class"] == "Exact" and (seen["bytes"], seen["sha256"]) == (p["bytes"], p["content_sha256"]) and _path(seen["full_key"]), "the observation is not exact")
    _require((own is None) != (p["replay_identity"] is None), "a proof has one identity")
    if own is not None:
        _require(set(own) == set(RANGE_KEYS) and _count(own["start_sequence"]) and _count(own["end_sequence"], own["start_sequence"]) and _hash(own["end_chain_root"]), "WAL range")
        _require(own["start_chain_root"] == ZERO if own["start_sequence"] == 1 else _hash(own["start_chain_root"]), "root before the WAL range")
    _require(set(limits) == set(LIMIT_KEYS) and all(_count(limits[k]) for k in LIMIT_KEYS), "proof limits")


def proof_digest(p: dict[str, Any]) -> str:
    check_proof(p)
    return C.digest(D.PROOF, p).hex()


def checkpoint(p: dict[str, Any], previous: str) -> dict[str, Any]:
    """The checkpoint of a WAL segment's proof after the checkpoint with the digest previous (zeros for the first one)."""
    return {
        "checkpoint_version": CHECKPOINT_VERSION, "end_sequence": p["wal_range"]["end_sequence"], "last_segment_sha256": p["content_sha256"], "previous_checkpoint_digest": previous,
        "retained_chain_root": p["wal_range"]["end_chain_root"], "retention_proof": p, "retention_proof_digest": proof_digest(p),
    }


def check_checkpoint(c: dict[str, Any]) -> None:
    """Raise unless a checkpoint is bound to the WAL segment that its proof is about."""
    _require(set(c) == set(CHECKPOINT_KEYS) and c["checkpoint_version"] == CHECKPOINT_VERSION and _count(c["end_sequence"]), "checkpoint identity")
    p = c["retention_proof"]
    _require(all(_hash(c[k]) for k in ("retained_chain_root", "last_segment_sha256", "retention_proof_digest")) and proof_digest(p) == c["retention_proof_digest"], "checkpoint hash")
    own = p["wal_range"]
    _require(p["artifact_kind"] == "wal_segment" and own is not None and (own["end_sequence"], own["end_chain_root"], p["content_sha256"]) == (c["end_sequence"], c["retained_chain_root"], c["last_segment_sha256"]), "the proof is of another segment")


def plan_document(actions: list[dict[str, Any]], blocked: list[tuple[str, str]], **facts: Any) -> dict[str, Any]:
    """A plan's document. facts are active_recovery_floor, current_wall_time_unix_ms, disk_class, durable_wall_time_unix_ms, grace_ms, require_remote_verified and wal_expected_start."""
    names = {"active_recovery_floor", "current_wall_time_unix_ms", "disk_class", "durable_wall_time_unix_ms", "grace_ms", "require_remote_verified", "wal_expected_start"}
    _require(set(facts) == names and all(set(a) == set(ACTION_KEYS) for a in actions), "plan fields")
    waits = [{"artifact_id": i, "reason": r} for i, r in sorted(blocked)]
    return facts | {"actions": sorted(actions, key=lambda a: a["artifact_id"]), "blocked": waits, "plan_version": PLAN_VERSION}


def plan_digest(document: dict[str, Any]) -> str:
    return C.digest(D.PRUNE_PLAN, document).hex()


def _json(**fields: Column) -> Column:
    return F.struct(*(fields[k].alias(k) for k in sorted(fields)))


def graphs(manifests: DataFrame, *by: str) -> DataFrame:
    """Per day (by): nodes and graph_bytes of its manifests (revision, digest, previous, bytes), and whether they are one chain from the first revision."""
    rows = selection.revision_breaks(manifests, *by)
    return rows.groupBy(*by).agg(F.count("*").alias("nodes"), F.sum("bytes").alias("graph_bytes"), (~F.max("breaks")).alias("sound"))


def observed(candidates: DataFrame, claims: DataFrame, objects: DataFrame, manifests: DataFrame, coverage: DataFrame, limits: dict[str, int], *scopes: str) -> DataFrame:
    """candidates (scopes, day, object_key, sha256, bytes) with class, and of the Exact ones manifest_key, manifest_digest and closed_s.

    claims are what the store has of each scope (claim_sha256, claim_bytes, and expected_sha256, what it must be); objects what it has of
    each key (object_key, sha256, bytes); manifests of each day the revisions (revision, digest, previous, bytes, key, closed_s);
    coverage of each day and object_key the revision that covers it, and the number and bytes of the other objects of its chain.
    """
    days = [*scopes, "day"]
    there = objects.select("object_key", F.col("sha256").alias("_sha"), F.col("bytes").alias("_bytes"))
    newest = manifests.select(*days, "revision", F.col("key").alias("manifest_key"), F.col("digest").alias("manifest_digest"), "closed_s")
    rows = candidates.join(claims, list(scopes), "left").join(there, "object_key", "left").join(graphs(manifests, *days), days, "left").join(coverage, [*days, "object_key"], "left").join(newest, [*days, "revision"], "left")
    spent = {"objects": F.lit(0), "bytes": F.lit(0)}
    steps: list[tuple[Column, str]] = [(F.col("bytes") > limits["max_proof_bytes"], "Oversized")]

    def read(n: Column, size: Column) -> None:
        spent["objects"], spent["bytes"] = spent["objects"] + n, spent["bytes"] + F.coalesce(size, F.lit(0))
        steps.append(((spent["objects"] > limits["max_proof_objects"]) | (spent["bytes"] > limits["max_proof_bytes"]), "Oversized"))

    steps.append((F.col("claim_sha256").isNull(), "Absent"))
    read(F.lit(1), F.col("claim_bytes"))
    steps.append((F.col("claim_sha256") != F.col("expected_sha256"), "Different"))
    steps.append((F.col("_sha").isNull(), "Absent"))
    read(F.lit(1), F.col("_bytes"))
    steps.append(((F.col("_sha") != F.col("sha256")) | (F.col("_bytes") != F.col("bytes")), "Different"))
    steps.append((F.col("nodes").isNull(), "Absent"))
    steps.append((F.col("nodes") > limits["max_manifest_nodes"], "Oversized"))
    read(F.col("nodes"), F.col("graph_bytes"))
    steps.append((~F.col("sound") | F.col("manifest_key").isNull(), "Ambiguous"))
    read(F.col("others"), F.col("other_bytes"))
    steps.append((~(F.col("closed_s") > 0), "Ambiguous"))
    own = F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), name) for bad, name in steps), F.lit("Exact"))
    return rows.withColumn("class", own).select(*candidates.columns, "class", *(F.when(F.col("class") == "Exact", F.col(c)).alias(c) for c in ("manifest_key", "manifest_digest", "closed_s", "nodes")))


def retention_proofs(seen: DataFrame, limits: dict[str, int], now_ms: int, grace_ms: int) -> DataFrame:
    """seen, of observed(), with proof, the canonical document, and proof_sha256 of what is Exact.

    seen has also kind, path, full_key, scope_hash, start_sequence, end_sequence, start_root and end_root. The time of observation
    is the day's logical close or now, whichever is later; what was verified is bound by the digest of its facts.
    """
    time = F.greatest(F.col("closed_s") * 1000, F.lit(now_ms).cast("long"))
    facts = F.to_json(_json(class_=F.col("class"), content=F.col("sha256"), manifest=F.col("manifest_digest"), nodes=F.col("nodes")), {"ignoreNullFields": "false"})
    report = N.hexed(N.sha(N.raw(D.VERIFICATION), F.encode(facts, "UTF-8")))
    own = _json(
        artifact_kind=F.col("kind"), bytes=F.col("bytes"), content_sha256=F.col("sha256"), covering_manifest_digest=F.col("manifest_digest"), covering_manifest_key=F.col("manifest_key"), grace_not_before_unix_ms=time + grace_ms,
        limits=_json(**{k: F.lit(limits[k]).cast("long") for k in LIMIT_KEYS}), observed_wall_time_unix_ms=time, proof_version=F.lit(PROOF_VERSION),
        remote_observation=F.struct(F.col("bytes"), F.col("class"), F.col("full_key"), F.col("sha256")), replay_identity=F.lit(None).cast("string"), scope_config_hash=F.col("scope_hash"), trusted_relative_path=F.col("path"),
        verification_report_digest=report, wal_range=_json(end_chain_root=F.col("end_root"), end_sequence=F.col("end_sequence"), start_chain_root=F.col("start_root"), start_sequence=F.col("start_sequence")),
    )
    text = F.when(F.col("class") == "Exact", F.to_json(own, {"ignoreNullFields": "false"}))
    return seen.withColumn("proof", text).withColumn("proof_sha256", N.hexed(N.sha(N.raw(D.PROOF), F.encode("proof", "UTF-8"))))
