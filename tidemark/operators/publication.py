"""Manifests of parts and days, what was observed of them remotely, and the one action that follows.

Decisions are columns over observations, so any number of publications is reconciled in one query.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D

#: Barriers in their order; whether what is absent there must be there already, and whether it is a set of objects.
BARRIERS = (("claim", True, False), ("raw_manifest", True, False), ("raw_object", True, True), ("parquet", False, True), ("part_manifest", False, True), ("part_chain", True, False), ("replay_manifest", False, False), ("replay_graph", True, False))
#: The fields of a part manifest and of a replay day manifest.
PART_KEYS = {
    "canonical_row_bytes", "conversion_id", "converter_build_id", "dataset_id", "date", "day_definition_id", "dependency_lock_hash", "first_row_chain_hash", "first_stream_sequence", "format_id", "last_row_chain_hash",
    "last_stream_sequence", "manifest_version", "part_bytes", "part_key", "part_sequence", "part_sha256", "previous_manifest_sha256", "previous_row_chain_hash", "raw_day_manifest_key", "raw_day_manifest_sha256", "replay_contract_id",
    "row_count", "target_platform_contract", "writer_configuration_hash",
}
DAY_KEYS = {
    "manifest_version", "manifest_id", "dataset_id", "day_definition_id", "date", "revision", "raw_day_manifest_key", "raw_day_manifest_sha256", "replay_contract_id", "format_id", "conversion_id", "converter_build_id",
    "dependency_lock_hash", "writer_configuration_hash", "target_platform_contract", "completeness_status", "part_manifest_keys", "part_set_root", "canonical_stream_row_chain_root", "previous_manifest_sha256",
}


def part_manifests(scope: dict[str, Any], conversion: dict[str, Any], parts: list[dict]) -> list[dict]:
    """Manifest, canonical bytes, digest and key of each part in order; parts have count, bytes, sequences and anchors, key, size and hash."""
    base = {k: scope[k] for k in ("dataset_id", "day_definition_id", "date", "replay_contract_id", "conversion_id", "raw_day_manifest_key", "raw_day_manifest_sha256")}
    base |= {k: conversion[k] for k in ("converter_build_id", "dependency_lock_hash", "writer_configuration_hash", "target_platform_contract")} | {"format_id": D.FORMAT_ID, "manifest_version": "part-manifest-v1"}
    out, previous = [], None
    for k, part in enumerate(parts):
        manifest = base | part | {"part_sequence": k, "previous_manifest_sha256": previous}
        if set(manifest) != PART_KEYS or part["part_bytes"] < 1 or (k == 0) != (part["previous_row_chain_hash"] == D.ZERO.hex()):
            raise C.FormatError("INVALID_FIELD", f"part {k}")
        if out and (part["first_stream_sequence"] != out[-1]["manifest"]["last_stream_sequence"] + 1 or part["previous_row_chain_hash"] != out[-1]["manifest"]["last_row_chain_hash"]):
            raise C.FormatError("INVALID_FIELD", f"part {k} does not follow")
        data = C.canonical_json(manifest)
        previous = C.sha(D.PART, data).hex()
        out.append({"manifest": manifest, "bytes": data, "digest": previous, "key": f"{derivative_base(scope)}/manifests/part-{k:08d}-{previous}.json"})
    return out


def derivative_base(scope: dict[str, Any]) -> str:
    of = lambda x: C.sha(x.encode()).hex()
    return f"derivatives/stream={of(scope['replay_contract_id'])}/format={D.FORMAT_ID}/conversion={of(scope['conversion_id'])}/day-definition={of(scope['day_definition_id'])}/date={scope['date']}"


def replay_day_manifest(scope: dict[str, Any], conversion: dict[str, Any], parts: list[dict], revision: int, previous: str | None, completeness: str) -> dict:
    """Manifest, canonical bytes, digest and key of a day's replay over the results of part_manifests()."""
    if completeness not in D.COMPLETENESS or (revision == 1) != (previous is None):
        raise C.FormatError("INVALID_FIELD", "completeness or predecessor")
    items = [{"key": p["key"], "digest": bytes.fromhex(p["digest"])} | {k: p["manifest"][k] for k in ("first_stream_sequence", "last_stream_sequence")} for p in parts]
    names = ("converter_build_id", "dependency_lock_hash", "writer_configuration_hash", "target_platform_contract")
    identity = {k: scope[k] for k in ("dataset_id", "day_definition_id", "date", "replay_contract_id", "conversion_id")} | {k: conversion[k] for k in names} | {"format_id": D.FORMAT_ID}
    manifest = {k: scope[k] for k in ("dataset_id", "day_definition_id", "date", "raw_day_manifest_key", "raw_day_manifest_sha256", "replay_contract_id", "conversion_id")}
    manifest |= {k: conversion[k] for k in ("converter_build_id", "dependency_lock_hash", "writer_configuration_hash", "target_platform_contract")}
    manifest |= {
        "manifest_version": "replay-day-manifest-v1", "manifest_id": "replay-" + C.digest(D.REPLAY_IDENTITY, identity).hex()[:32], "revision": revision, "format_id": D.FORMAT_ID, "completeness_status": completeness,
        "part_manifest_keys": [p["key"] for p in parts], "part_set_root": C.part_set_root(items).hex(),
        "canonical_stream_row_chain_root": parts[-1]["manifest"]["last_row_chain_hash"] if parts else D.ZERO.hex(), "previous_manifest_sha256": previous,
    }
    data = C.canonical_json(manifest)
    own = C.sha(D.REPLAY_DAY, data).hex()
    return {"manifest": manifest, "bytes": data, "digest": own, "key": f"{derivative_base(scope)}/replay-day-{revision}-{own}.json"}


def observe(expected: DataFrame, inventory: DataFrame, max_bytes: int) -> DataFrame:
    """expected (publication, barrier, object_id, sha256, bytes) with the class of what inventory (object_id, sha256, bytes, available) has."""
    seen = inventory.groupBy("object_id").agg(F.count("*").alias("_n"), F.max("bytes").alias("_bytes"), F.min("sha256").alias("_sha"), F.min("available").alias("_ok"))
    kind = (
        F.when(F.col("_n").isNull(), "Absent").when(~F.col("_ok"), "Unavailable").when(F.col("_n") > 1, "Ambiguous").when(F.col("_bytes") > max_bytes, "Oversized")
        .when((F.col("_sha") == F.col("sha256")) & (F.col("_bytes") == F.col("bytes")), "Exact").otherwise("Different")
    )
    return expected.join(seen, "object_id", "left").withColumn("class", kind).drop("_n", "_bytes", "_sha", "_ok")


def _single(kind: Column, name: str, must: bool) -> Column:
    absent = F.struct(F.lit("IntegrityStop" if must else "Execute").alias("decision"), F.lit(f"{name}_absent" if must else f"{name}_upload").alias("reason"))
    pick = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    return F.when(kind == "Unavailable", pick("Retry", f"{name}_unavailable")).when(kind == "Oversized", pick("ResourceStop", f"{name}_oversized")).when(kind.isin("Different", "Ambiguous"), pick("IntegrityStop", f"{name}_not_exact")).when(kind == "Absent", absent)


def _several(has: Column, name: str, must: bool) -> Column:
    """has: an array of the classes and faults that were seen."""
    pick = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    seen = lambda c: F.array_contains(has, c)
    out = F.when(seen("orphan"), pick("IntegrityStop", f"{name}_candidate_or_orphan")).when(seen("duplicate"), pick("IntegrityStop", f"{name}_duplicate_observation")).when(seen("missing"), pick("IntegrityStop", f"{name}_observation_incomplete"))
    for kind, decision in (("Oversized", "ResourceStop"), ("Different", "IntegrityStop"), ("Ambiguous", "IntegrityStop"), ("Unavailable", "Retry")):
        out = out.when(seen(kind), pick(decision, f"{name}_{kind}"))
    return out.when(seen("Absent"), pick("IntegrityStop", f"{name}_absent") if must else pick("Execute", f"{name}_upload"))


def reconcile(publications: DataFrame, observations: DataFrame) -> DataFrame:
    """decision and reason for each publication: the first barrier that is not satisfied wins.

    publications: publication, digest_ok, within_budget, complete, and bundle: an array of the ids
    (barrier, object_id) that it must have. observations: publication, barrier, object_id, class. The
    ids to upload, in order, are actions.
    """
    wanted = publications.select("publication", F.explode("bundle").alias("x")).select("publication", "x.barrier", "x.object_id")
    seen = observations.groupBy("publication", "barrier", "object_id").agg(F.count("*").alias("n"), F.max("class").alias("class"))
    both = wanted.withColumn("w", F.lit(True)).join(seen, ["publication", "barrier", "object_id"], "full_outer")
    fault = F.when(F.col("w").isNull(), "orphan").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").otherwise(F.col("class"))
    both = both.withColumn("fault", fault)
    per = both.groupBy("publication").agg(
        *(F.collect_set(F.when(F.col("barrier") == name, F.col("fault"))).alias(name) for name, _, _ in BARRIERS),
        *(F.array_sort(F.collect_set(F.when((F.col("barrier") == name) & (F.col("fault") == "Absent"), F.col("object_id")))).alias(f"{name}_absent") for name, must, _ in BARRIERS if not must),
    )
    rows = publications.drop("bundle").join(per, "publication", "left")
    pick = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    first = F.when(~F.col("digest_ok"), pick("IntegrityStop", "bundle_digest_mismatch")).when(~F.col("within_budget"), pick("ResourceStop", "observation_budget_exhausted"))
    steps = [first, *(_several(F.col(name), name, must) if many else _single(F.get(F.array_remove(F.col(name), "Exact"), F.lit(0)), name, must) for name, must, many in BARRIERS)]
    steps.append(F.when(~F.col("complete"), pick("IntegrityStop", "final_observation_incomplete")))
    rows = rows.withColumn("x", F.coalesce(*steps, pick("ReadyForReceipt", "complete")))
    actions = F.when(F.col("x.decision") == "Execute", F.coalesce(*(F.when(F.col("x.reason") == f"{n}_upload", F.col(f"{n}_absent")) for n, must, _ in BARRIERS if not must)))
    return rows.select("publication", "x.decision", "x.reason", actions.alias("actions"))


def required_rounds(parts: Column) -> Column:
    """Each approved action has a fresh observation: two for each part, and two."""
    return parts * 2 + 2


def merged(catalog: DataFrame, fresh: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """catalog with the rows of fresh: keep columns stay as the catalog has them, others are replaced."""
    a, b = catalog.alias("a"), fresh.alias("b")
    joined = a.join(b, by, "full_outer")
    rest = [c for c in catalog.columns if c not in by]
    known = F.col(f"a.{rest[0]}").isNotNull()
    return joined.select(*by, *(F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) if c in keep else F.when(known & F.col(f"b.{c}").isNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in rest))


def pending_stats(segments: DataFrame, manifests: DataFrame) -> DataFrame:
    """Backlog of both tables: rows, bytes, attempts, and the oldest change; an unknown change (0) is ignored."""
    one = lambda t, size: t.where("state <> 'published'").select(size.cast("long").alias("bytes"), "attempts", F.nullif("updated", F.lit(0).cast("long")).alias("updated"))
    both = one(segments, F.col("bytes")).unionByName(one(manifests, F.lit(0)))
    return both.agg(F.count("*").alias("pending"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts"), F.min("updated").alias("oldest"))


def due(manifests: DataFrame, now: int) -> DataFrame:
    """Manifests whose turn has come."""
    retry = F.nullif("next_retry", F.lit(0).cast("long"))
    return manifests.where(F.col("state").isin("spooled", "retry_wait") & (retry.isNull() | (retry <= now)))
