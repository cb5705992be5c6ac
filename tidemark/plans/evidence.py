"""The driver's queries on what must be shown before something is deleted: proofs, and the budgets of what is read for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import bundles, chains, operations, proofs
from tidemark.plans import events as E
from tidemark.plans.catalogue import _parts, query

LIMITS = {"max_manifest_nodes": 2, "max_proof_bytes": 200_000, "max_proof_objects": 7}
NOW_MS, GRACE_MS = 1_704_412_800_000, 86_400_000
#: Requests that all candidates may make together, and bytes of each kind of event that they may read.
REQUESTS, KIND_BYTES = 4_000, 9_000_000


def artifacts(spark, sf) -> DataFrame:
    """An artifact a symbol and day."""
    rows = E.ticks(spark, sf).groupBy("symbol", "day").agg((F.count("*") * 60).alias("bytes"), F.min("capture_sequence").alias("start_sequence"), F.max("capture_sequence").alias("end_sequence"))
    name = F.concat_ws("/", "symbol", "day")
    hashed = lambda prefix: F.sha2(F.concat(F.lit(prefix), name), 256)
    return rows.select(
        "symbol", "day", F.concat(F.lit("objects/"), name).alias("object_key"), hashed("object/").alias("sha256"), "bytes", F.lit("wal_segment").alias("kind"), F.concat(F.lit("sealed/"), name).alias("path"), F.concat(F.lit("immutable/objects/"), name).alias("full_key"),
        F.sha2("symbol", 256).alias("scope_hash"), "start_sequence", "end_sequence", F.when(F.col("start_sequence") == 1, proofs.ZERO).otherwise(hashed("start/")).alias("start_root"), hashed("end/").alias("end_root"), F.dayofmonth(F.col("day").cast("date")).alias("k"),
    )


@query
def retention_proofs(spark, sf):
    """Proofs of artifacts of which some lack a claim, an object, a manifest, a cover or a close, differ in bytes, have a broken graph, or would read too much."""
    every = E.stored(artifacts(spark, sf), "artifacts")
    k, name = F.col("k"), F.concat_ws("/", "symbol", "day")
    expected = F.sha2(F.concat(F.lit("claim/"), F.col("symbol")), 256)
    claims = every.select("symbol").distinct().select("symbol", F.when(F.octet_length("symbol") % 8 == 0, F.lit("f" * 64)).otherwise(expected).alias("claim_sha256"), F.lit(100).alias("claim_bytes"), expected.alias("expected_sha256"))
    objects = every.where(k % 7 != 1).select("object_key", "sha256", F.when(k % 7 == 2, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"))
    digest = lambda r: F.sha2(F.concat_ws("/", name, r.cast("string")), 256)
    last = 1 + k % 3
    graph = every.where(k % 7 != 4).select("*", F.explode(F.sequence(F.lit(1), last)).alias("revision"))
    r = F.col("revision")
    previous = F.when((k % 7 == 3) & (r == last), F.lit("e" * 64)).when(r > 1, digest(r - 1))
    close = F.when(k % 11 == 5, 0).otherwise((F.unix_date(F.col("day").cast("date")) + 1) * 86_400).cast("long")
    manifests = graph.select("symbol", "day", "revision", digest(r).alias("digest"), previous.alias("previous"), (r * 1000).alias("bytes"), F.concat(F.lit("snapshots/"), name, F.lit("-"), r.cast("string"), F.lit(".json")).alias("key"), close.alias("closed_s"))
    coverage = every.where(k % 7 != 5).select("symbol", "day", "object_key", last.alias("revision"), (k % 5).alias("others"), (k % 5 * 50_000).alias("other_bytes"))
    seen = proofs.observed(every.drop("k"), claims, objects, manifests, coverage, LIMITS, "symbol")
    return proofs.retention_proofs(seen, LIMITS, NOW_MS, GRACE_MS).select("symbol", "day", "class", "proof_sha256")


@query
def shared_budget(spark, sf):
    """What all events charge together, one request each and their bytes by kind, and which budget stops them."""
    kinds = ("click", "error", "purchase", "view")
    amounts = [F.when(F.col("symbol") == s, F.col("bid")).otherwise(0).cast("long").alias(f"bytes_{s}") for s in kinds]
    charges = E.ticks(spark, sf).select("event_id", "capture_sequence", F.lit(1).cast("long").alias("requests"), *amounts)
    limits = {"requests": REQUESTS} | {f"bytes_{s}": KIND_BYTES for s in kinds}
    return chains.shared_budget(charges, "capture_sequence", limits).select("event_id", "stopped_by")


@query
def bundle_faults(spark, sf):
    """A bundle a user, of which by the user's number a raw manifest, a part, a part manifest, the predecessor or the replay manifest is spoiled."""
    parts = E.stored(_parts(spark, sf).withColumn("bytes", F.col("row_count") * 60), "parts")
    n = F.col("user_id") % 9
    roots = chains.part_set_root(parts, ["user_id"])
    rows = parts.groupBy("user_id").agg(F.sum("row_count").alias("row_count")).join(roots, "user_id")
    name = lambda p: F.sha2(F.concat(F.lit(p), F.col("user_id").cast("string")), 256)
    every = rows.select(
        "user_id", F.lit(2).alias("revision"), F.when(n == 7, F.lit("f" * 64)).otherwise(name("first-")).alias("previous"), name("raw-").alias("raw_digest"), F.when(n == 5, F.col("row_count") + 1).otherwise(F.col("row_count")).alias("row_count"),
        F.when(n == 6, F.lit("e" * 64)).otherwise(F.col("part_set_root")).alias("part_set_root"),
    )
    last = parts.groupBy("user_id").agg(F.max("part_sequence").alias("_last"))
    said = parts.join(last, "user_id").where((n != 1) | (F.col("part_sequence") != F.col("_last"))).withColumn("digest", F.when((n == 2) & (F.col("part_sequence") == 0), F.lit("d" * 64)).otherwise(F.col("digest")))
    own = parts.withColumn("part_sequence", F.when(n == 3, F.col("part_sequence") + 1).otherwise(F.col("part_sequence"))).withColumn("verified", (n != 4) | (F.col("part_sequence") != 0))
    raws = rows.where(n != 8).select("user_id", name("raw-").alias("raw_digest"))
    known = rows.select("user_id", F.lit(1).alias("revision"), name("first-").alias("digest"))
    return bundles.bundle_faults(every, own, said, raws, known, {"max_parts": 5, "max_total_parquet_bytes": 1 << 40}, "user_id").select("user_id", "fault")


@query
def application_status(spark, sf):
    """An application an entry, whose ingest, publication and disk say what the entry's number makes them say."""
    n = F.col("sequence")
    errors = F.array(*(F.lit(x) for x in ("", "remote_timeout", "", "collision", "", "strange", "", "permission")))
    rows = E.ticks(spark, sf).groupBy("sequence").agg(F.count("*").alias("records"), F.max("error").alias("error"))
    found = rows.select(
        "sequence", (n % 13 != 5).alias("ready_for_ack"), (n % 17 != 3).alias("disk_ready"), F.when(n % 19 != 7, True).alias("ack_allowed"), F.when(n % 5 == 1, "high").otherwise("normal").alias("disk_class"), (n % 23 == 4).alias("worker_priority"),
        (F.col("error") == 0).alias("remote_available"), F.element_at(errors, (n % 8 + 1).cast("int")).alias("last_error_class"), F.when(n % 3 == 0, F.col("records")).otherwise(0).alias("pending_bytes"), F.lit(0).alias("pending_manifests"),
    )
    return operations.application_status(found).select("sequence", "last_error_class", "overall")


@query
def supervisor_units(spark, sf):
    scopes = E.ticks(spark, sf).select("symbol").distinct().select(F.sha2("symbol", 256).alias("scope_key"), F.concat(F.lit("127.0.0.1:"), (F.octet_length("symbol") + 9000).cast("string")).alias("listener"), F.concat(F.col("symbol"), F.lit(".toml")).alias("gateway_config_path"), F.concat(F.col("symbol"), F.lit(".set")).alias("mql_config_path"))
    return operations.supervisor_units(scopes)
