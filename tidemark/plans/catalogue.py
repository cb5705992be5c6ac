"""The driver's queries over the events table, one or more for each group of operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import chains, continuity, operations, publication, retention, selection
from tidemark.plans import events as E
from tidemark.sources import wal
from tidemark.streaming import gateway

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def day_selection(spark, sf):
    return selection.day_selection(E.ticks(spark, sf))


@query
def selected_ranges(spark, sf):
    """What of each entry and day each symbol selects: the ranges of every symbol, of which none goes on in another's."""
    return selection.ranges(E.ticks(spark, sf), "symbol")


@query
def selected_ranges_by_symbol(spark, sf):
    """The rows of selected_ranges, under the name that they had while it did not cover every symbol."""
    return selection.ranges(E.ticks(spark, sf), "symbol").select("symbol", "day", "sequence", "first_ordinal", "last_ordinal")


@query
def payload_fingerprint(spark, sf):
    return E.fingerprints(spark, sf).select("event_id", N.hexed(F.col("fingerprint")).alias("fingerprint"))


@query
def observation_hash(spark, sf):
    session = F.concat(F.lit("session-"), F.col("volume").cast("string"))
    own = N.observation(F.lit("producer"), session, F.col("sequence"), F.col("ordinal"), F.col("capture_sequence"), F.col("fingerprint"))
    return E.fingerprints(spark, sf).select("event_id", N.hexed(own).alias("observation"))


@query
def batch_sha256(spark, sf):
    rows = E.fingerprints(spark, sf).groupBy("sequence").agg(F.array_sort(F.collect_list(F.struct("ordinal", "record"))).alias("r"))
    joined = F.aggregate(F.transform("r", lambda x: x["record"]), N.raw(b""), lambda a, x: F.concat(a, x))
    return rows.select("sequence", N.hexed(N.batch_hash(joined)).alias("batch_sha256"))


@query
def row_chain_root(spark, sf):
    rows = E.fingerprints(spark, sf).withColumn("n", (F.row_number().over(Window.partitionBy("volume").orderBy("capture_sequence")) - 1).cast("long"))
    return chains.row_chain_root(rows.withColumnRenamed("volume", "user_id"), ["user_id"], "n", "record")


def _day_ranges(spark, sf):
    found = selection.ranges(E.ticks(spark, sf))
    key = F.unhex(F.sha2(F.concat(F.lit("object-"), F.floor((F.col("sequence") - 1) / E.SEGMENT).cast("string")), 256))
    return found.select("day", key.alias("sha256"), (F.col("sequence") * 100).alias("bytes"), F.col("sequence").alias("start"), F.col("sequence").alias("end"), "first_ordinal", "last_ordinal")


@query
def raw_set_root(spark, sf):
    return selection.raw_set_root(_day_ranges(spark, sf), "day")


def _parts(spark, sf):
    """Each user's rows in parts of twenty, as manifests with made-up digests."""
    rows = E.ticks(spark, sf).withColumn("n", F.row_number().over(Window.partitionBy("volume").orderBy("capture_sequence")) - 1)
    rows = rows.groupBy(F.col("volume").alias("user_id"), F.floor(F.col("n") / 20).cast("long").alias("part_sequence")).agg(F.min("n").cast("long").alias("first_stream_sequence"), F.max("n").cast("long").alias("last_stream_sequence"), F.count("*").alias("row_count"), F.min("time_msc").alias("first_msc"))
    name = F.concat_ws("-", F.lit("part"), F.col("user_id").cast("string"), F.col("part_sequence").cast("string"))
    rows = rows.withColumn("digest", F.sha2(name, 256)).withColumn("key", F.concat(F.lit("manifests/part-"), F.lpad(F.col("part_sequence").cast("string"), 8, "0"), F.lit("-"), F.col("digest"), F.lit(".json")))
    last = F.sha2(F.concat(name, F.lit("-end")), 256)
    rows = rows.withColumn("last_row_chain_hash", last)
    before = F.lag("last_row_chain_hash").over(Window.partitionBy("user_id").orderBy("part_sequence"))
    # every seventh user's second part has lost its predecessor
    lost = (F.col("user_id") % 7 == 0) & (F.col("part_sequence") == 1)
    return rows.withColumn("previous_row_chain_hash", F.when(lost, F.lit("f" * 64)).otherwise(F.coalesce(before, F.lit(D.ZERO.hex()))))


@query
def part_set_root(spark, sf):
    return chains.part_set_root(_parts(spark, sf), ["user_id"])


@query
def part_graph(spark, sf):
    return chains.part_graph(_parts(spark, sf), ["user_id"]).select("user_id", "part_sequence", "breaks")


@query
def ordered_part_keys(spark, sf):
    keys = _parts(spark, sf).groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("part_sequence", "key"))), lambda x: x["key"]).alias("part_manifest_keys"))
    return keys.select("user_id", F.posexplode("part_manifest_keys").alias("part", "key")).join(_parts(spark, sf).select("key", "row_count"), "key")


@query
def affected_days(spark, sf):
    return selection.affected_days(E.ticks(spark, sf), "segment").select("segment", F.array_join("days", ",").alias("days"))


def _segments(spark, sf):
    """Segments with their chain; every ninth one lost its first entry."""
    rows = E.ticks(spark, sf).groupBy("segment").agg(F.min("sequence").alias("first_sequence"), F.max("sequence").alias("last_sequence"), F.count("*").alias("records"))
    rows = rows.withColumn("first_sequence", F.when(F.col("segment") % 9 == 8, F.col("first_sequence") + 1).otherwise(F.col("first_sequence")))
    return rows.select("*", E.entry(F.col("first_sequence") - 1).alias("chain_start"), E.entry(F.col("last_sequence")).alias("chain_root"), F.lit("gateway").alias("gateway_instance_id"), F.sha2(F.col("segment").cast("string"), 256).alias("object_sha256"))


@query
def segment_contiguity(spark, sf):
    rows = wal.ordered_segments(_segments(spark, sf).withColumnRenamed("first_sequence", "start_sequence"))
    return rows.select("segment", F.col("start_sequence").alias("first_sequence"), "last_sequence", "breaks")


@query
def interval_overlap_segments(spark, sf):
    return selection.overlapping(_segments(spark, sf), 20, 75).select("segment", "first_sequence", "last_sequence")


def _revisions(spark, sf):
    """Revisions of each day: one for each started hundred records, the third of every fifth day missing."""
    rows = E.ticks(spark, sf).groupBy("day", F.floor(F.col("capture_sequence") / 100).cast("long").alias("h")).agg(F.count("*").alias("records"), F.max("time_msc").alias("source_watermark"))
    rows = rows.withColumn("revision", F.row_number().over(Window.partitionBy("day").orderBy("h")).cast("long")).drop("h")
    rows = rows.withColumn("digest", F.sha2(F.concat_ws("/", "day", F.col("revision").cast("string")), 256))
    rows = rows.withColumn("previous", F.when(F.col("revision") > 1, F.sha2(F.concat_ws("/", "day", (F.col("revision") - 1).cast("string")), 256)))
    return rows.where(~((F.dayofmonth(F.col("day").cast("date")) % 5 == 0) & (F.col("revision") == 3)))


@query
def revision_gap_check(spark, sf):
    return selection.revision_breaks(_revisions(spark, sf), "day").select("day", "revision", "breaks")


@query
def latest_revision(spark, sf):
    return selection.latest(_revisions(spark, sf), "day").select("day", "revision", "records", "digest")


def _user_batches(spark, sf):
    """Each user's events as batches of one, of which every tenth number was never used."""
    rows = E.ticks(spark, sf).withColumn("n", F.row_number().over(Window.partitionBy("volume").orderBy("capture_sequence")))
    return rows.select(F.concat(F.lit("session-"), F.col("volume").cast("string")).alias("session"), (F.col("n") + F.floor(F.col("n") / 10)).cast("long").alias("batch_sequence"), F.col("capture_sequence").alias("sequence"), "time_msc", "bid", "event_id")


@query
def batch_gap_markers(spark, sf):
    return chains.batch_gaps(_user_batches(spark, sf)).select("session", "batch_sequence", "expected")


@query
def timestamp_regressions(spark, sf):
    late = F.when(F.col("sequence") % 10 == 0, F.max("time_msc") - 86_400_000).otherwise(F.max("time_msc"))
    rows = E.ticks(spark, sf).groupBy("symbol", "sequence").agg(F.min("time_msc").alias("first_msc"), late.alias("last_msc"))
    rows = rows.withColumn("first_msc", F.when(F.col("sequence") % 15 == 0, F.col("first_msc") - 172_800_000).otherwise(F.col("first_msc")))
    return chains.regressions(rows, "symbol").select("symbol", "sequence", "first_msc", "previous_last")


@query
def last_batch_per_session(spark, sf):
    return _user_batches(spark, sf).groupBy("session").agg(F.max("batch_sequence").alias("batch_sequence"), F.max_by("event_id", "batch_sequence").alias("event_id"))


@query
def duplicate_or_conflict(spark, sf):
    rows = E.ticks(spark, sf)
    again = rows.where("capture_sequence % 5 = 0").select("*", (F.col("capture_sequence") + 1_000_000).alias("arrival"), F.when(F.col("capture_sequence") % 15 == 0, F.col("bid") + 1).otherwise(F.col("bid")).alias("seen"))
    both = rows.select("*", F.col("capture_sequence").alias("arrival"), F.col("bid").alias("seen")).unionByName(again)
    both = both.select(F.concat(F.lit("session-"), F.col("volume").cast("string")).alias("session"), F.col("capture_sequence").alias("batch_sequence"), "arrival", F.sha2(F.col("seen").cast("string"), 256).alias("hash"))
    return chains.duplicate_or_conflict(both).select("session", "batch_sequence", "arrival", "status")


@query
def boundary_records(spark, sf):
    rows = E.ticks(spark, sf).groupBy("symbol", "day").agg(F.max("time").alias("cursor"), F.collect_list(F.struct("time", "event_id")).alias("r"))
    at = F.array_sort(F.transform(F.filter("r", lambda x: x["time"] == F.col("cursor")), lambda x: x["event_id"]))
    return rows.select("symbol", "day", "cursor", F.array_join(at.cast("array<string>"), ",").alias("records"))


@query
def range_join_selection(spark, sf):
    rows = E.ticks(spark, sf).withColumn("key", F.col("segment"))
    found = rows.groupBy("key").agg((F.min("sequence") + 2).alias("start"), (F.min("sequence") + 9).alias("end"), F.lit(10).cast("long").alias("first_ordinal"), F.lit(20).cast("long").alias("last_ordinal"))
    return selection.in_ranges(rows.select("key", "sequence", "ordinal", "event_id"), found).select("event_id", "sequence", "ordinal")


@query
def exactly_one_binding(spark, sf):
    objects = _segments(spark, sf).select(F.col("segment").cast("string").alias("key"), F.col("object_sha256").alias("sha256"), F.col("records").alias("bytes"), F.col("first_sequence").alias("start"), F.col("last_sequence").alias("end"))
    found = selection.ranges(E.ticks(spark, sf).withColumn("key", F.col("segment").cast("string")), "key")
    own = found.join(objects.select("key", "sha256", "bytes"), "key").select(F.concat_ws("/", "day", F.col("sequence").cast("string"), F.col("first_ordinal").cast("string")).alias("id"), "key", "sha256", "bytes", F.col("sequence").alias("start"), F.col("sequence").alias("end"))
    return selection.bound_once(own, objects)


@query
def orphan_missing_objects(spark, sf):
    rows = E.ticks(spark, sf).select("symbol", F.concat(F.lit("object-"), F.col("event_id").cast("string")).alias("object_id")).distinct()
    expected = rows.where(F.crc32(F.col("object_id").cast("binary")) % 7 != 0)
    observed = rows.where(F.crc32(F.col("object_id").cast("binary")) % 5 != 0)
    twice = observed.where(F.crc32(F.col("object_id").cast("binary")) % 11 == 0)
    return chains.set_difference(expected, observed.unionByName(twice), ["symbol", "object_id"])


@query
def journal_differences(spark, sf):
    log = E.ticks(spark, sf).groupBy("sequence").agg(F.max("entry_hash").alias("entry_hash"), F.count("*").alias("records"))
    journal = log.where("sequence % 13 <> 0").withColumn("records", F.when(F.col("sequence") % 17 == 0, F.col("records") + 1).otherwise(F.col("records")))
    return chains.reconciled(journal, log.where("sequence % 19 <> 0"), ["sequence"], ["entry_hash", "records"])


def _bound(revisions, replays):
    raw = selection.latest(revisions, "day").select("day", F.col("digest").alias("raw_digest"))
    replay = replays.select("day", F.col("revision").alias("replay_revision"), F.col("digest").alias("raw_digest"))
    return replay.join(raw.withColumn("bound", F.lit(True)), ["day", "raw_digest"], "left").select("day", "replay_revision", F.coalesce("bound", F.lit(False)).alias("bound"))


@query
def raw_binding(spark, sf):
    return _bound(_revisions(spark, sf), _revisions(spark, sf))


QUERIES["raw_binding_all"] = raw_binding  # the name it had while raw_binding read two revisions a day


@query
def scope_collisions(spark, sf):
    users = E.ticks(spark, sf).select(F.col("volume").alias("u")).distinct()
    word = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    u = F.col("u")
    port = F.concat(F.lit(":"), (F.floor(u / 6) + 10_000).cast("string"))
    hosts = F.array(*(F.lit(h) for h in ("127.0.0.1", "localhost", " LocalHost.", "[::1]", "[0:0:0:0:0:0:0:1]")), word("host-", u))
    listener = F.when(u % 36 == 5, port).when(u % 72 == 17, F.concat(F.lit("0.0.0.0"), port)).otherwise(F.concat(F.element_at(hosts, (u % 6 + 1).cast("int")), port))
    folder = F.when(u % 60 == 7, F.concat(F.lit("/data//5/./"), u.cast("string"))).when(u % 60 == 8, F.concat(F.lit("/data/x/../6/"), u.cast("string"), F.lit("/"))).otherwise(word("/data/", u))
    scopes = users.select(
        word("scope-", u).alias("scope"), word("key-", F.when(u % 40 == 0, F.lit(0)).otherwise(u)).alias("scope_key"), listener.alias("listener"), word("pub-", F.when(u % 50 == 3, F.lit(3)).otherwise(u)).alias("publisher_id"),
        word("cred-", u).alias("credential_id"), folder.alias("wal_dir"), word("/spool/", u).alias("spool_dir"),
    )
    return operations.collisions(scopes)


def _work(spark, sf):
    """A row a batch, as the catalog of what is to be published."""
    rows = E.ticks(spark, sf).groupBy("sequence").agg(F.min("day").alias("date"), F.count("*").alias("bytes"), F.max("time").alias("updated"))
    state = F.element_at(F.array(*(F.lit(x) for x in ("sealed", "spooled", "retry_wait", "published", "uploading"))), (F.col("sequence") % 5 + 1).cast("int"))
    return rows.select("*", state.alias("state"), (F.col("sequence") % 6).alias("attempts"), F.when(F.col("sequence") % 4 == 0, 0).otherwise(F.col("sequence") * 10).cast("long").alias("next_retry"), F.col("sequence").alias("revision"))


@query
def pending_stats(spark, sf):
    rows = _work(spark, sf).withColumn("updated", F.when(F.col("sequence") == 1, 0).otherwise(F.col("updated")).cast("long"))
    return publication.pending_stats(rows.where("sequence % 2 = 0"), rows.where("sequence % 2 = 1"))


@query
def due_manifests(spark, sf):
    return publication.due(_work(spark, sf), 700).select("sequence", "date", "state")


@query
def retry_delay(spark, sf):
    return _work(spark, sf).select("sequence", N.retry_delay(F.col("attempts"), 5, 60).alias("delay_s"))


def _candidates(spark, sf):
    rows = _segments(spark, sf)
    n = F.col("segment")
    return rows.select(
        F.concat(F.lit("artifact-"), F.substring(F.sha2(n.cast("string"), 256), 1, 12)).alias("artifact_id"), F.concat(F.lit("/wal/"), n.cast("string")).alias("path"), F.when(n % 10 == 9, "replay_outbox").otherwise("wal").alias("kind"),
        "first_sequence", "last_sequence", (n == 8).alias("active"), F.lit(True).alias("recovered"), (n % 11 != 7).alias("fresh"), F.lit(True).alias("covered"), (n % 6 != 5).alias("remote_verified"),
        F.when(n % 13 != 12, F.sha2(n.cast("string"), 256)).alias("proof_sha256"), F.lit(True).alias("limits_match"), F.concat(F.lit("artifact-"), F.substring(F.sha2(n.cast("string"), 256), 1, 12)).alias("proof_artifact"),
        F.lit(100).cast("long").alias("observed_at"), F.when(n == 4, 999).otherwise(200).cast("long").alias("grace_not_before"), F.lit(False).alias("recovery_floor"),
    )


POLICY = retention.Policy(now=300, durable_now=300, grace=100, expected_start=1, max_candidates=3, remote_required=True)


@query
def prune_eligibility(spark, sf):
    return _candidates(spark, sf).select("artifact_id", retention.reason(POLICY).alias("reason"))


@query
def prune_plan(spark, sf):
    return retention.plan(_candidates(spark, sf), POLICY)


@query
def budget_first_exceed(spark, sf):
    rows = E.ticks(spark, sf).select("symbol", "event_id", F.col("bid").alias("amount"))
    return chains.first_exceed(rows, ["symbol"], "event_id", "amount", 1_000_000).where("exceeds").select("symbol", "event_id", "total")


@query
def list_datasets(spark, sf):
    return E.ticks(spark, sf).select(F.concat(F.lit("dataset-"), F.col("symbol")).alias("dataset_id")).distinct().orderBy("dataset_id")


@query
def list_scopes(spark, sf):
    rows = E.ticks(spark, sf).select(F.concat(F.lit("provider-"), (F.col("volume") % 3).cast("string")).alias("provider_id"), "symbol").distinct()
    return rows.select("provider_id", "symbol", N.scope_path_key(F.col("provider_id"), F.col("symbol")).alias("scope_key")).orderBy("provider_id", "symbol")


@query
def list_raw_snapshots(spark, sf):
    return _revisions(spark, sf).select("day", "revision", "digest").orderBy("day", "revision")


@query
def reconcile_decision(spark, sf):
    """A publication a batch: all is exact but for what its number changes."""
    names = [b for b, _, _ in publication.BARRIERS]
    rows = E.ticks(spark, sf).select(F.col("sequence").alias("publication")).distinct()
    n = F.col("publication")
    ids = F.array(*(F.struct(F.lit(b).alias("barrier"), F.lit(f"{b}-1").alias("object_id")) for b in names), F.struct(F.lit("parquet").alias("barrier"), F.lit("parquet-2").alias("object_id")))
    pubs = rows.select("publication", (n % 50 != 1).alias("digest_ok"), (n % 50 != 2).alias("within_budget"), (n % 50 != 3).alias("complete"), ids.alias("bundle"))
    seen = rows.withColumn("x", F.explode(ids)).select("publication", "x.*").withColumn("at", F.pmod(F.crc32(F.col("object_id").cast("binary")), F.lit(9)))
    kind = F.element_at(F.array(*(F.lit(x) for x in ("Absent", "Unavailable", "Different", "Ambiguous", "Oversized"))), (F.floor(n / 10) % 5 + 1).cast("int"))
    seen = seen.withColumn("class", F.when(F.col("at") == n % 10, kind).otherwise("Exact"))
    return publication.reconcile(pubs, seen.select("publication", "barrier", "object_id", "class")).select("publication", "decision", "reason", F.array_join("actions", ",").alias("actions"))


@query
def overall_status(spark, sf):
    states = F.array(*(F.element_at(F.array(*(F.lit(x) for x in ("healthy", "healthy", "degraded", "healthy", "blocked", "healthy", "failed"))), (F.floor(F.col("sequence") / k) % 7 + 1).cast("int")) for k in (1, 7, 49)))
    rows = E.ticks(spark, sf).select(F.col("sequence").alias("scope")).distinct()
    return operations.scope_health(rows.withColumn("sequence", F.col("scope")).select("scope", states.alias("states")))


@query
def disk_class(spark, sf):
    return E.ticks(spark, sf).select("event_id", N.disk_class(F.col("bid") % 700, 500, 250, 100).alias("disk_class"))


@query
def object_keys(spark, sf):
    base = N.derivative_base(F.lit("replay-v1"), F.lit("conversion-v1"), F.lit("utc-day-v1"), F.col("day"))
    rows = _revisions(spark, sf)
    return rows.select("day", "revision", N.raw_object_key(F.col("digest")).alias("raw_key"), N.replay_manifest_key(base, F.col("revision"), F.col("digest")).alias("replay_key"), N.lease(F.lit("producer"), F.col("day"), F.lit("feed")).alias("lease"))


@query
def continuity_replay(spark, sf):
    return continuity.replay(E.frames(spark, sf), E.SCOPE, E.IDENTITY)


@query
def replay_summary(spark, sf):
    return continuity.summary(continuity_replay(spark, sf))


@query
def part_packing(spark, sf):
    stream = continuity.replay(E.frames(spark, sf), E.SCOPE, E.IDENTITY, max_rows=40, max_bytes=16_000)
    return chains.part_summary(stream, ["scope", "day"])


@query
def frame_decode(spark, sf):
    schema = "sequence long, scope string, day string, kind string, error string, records int, fingerprint string"

    def run(batches):
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                try:
                    kind, message = C.decode_message(x["frame"])
                    out.append({"kind": kind, "error": None, "records": len(message["records"]), "fingerprint": C.payload_fingerprint(message["records"][0]).hex()})
                except C.FormatError as bad:
                    out.append({"kind": None, "error": bad.code, "records": None, "fingerprint": None})
                out[-1] |= {k: x[k] for k in ("sequence", "scope", "day")}
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("sequence", pa.int64()), ("scope", pa.string()), ("day", pa.string()), ("kind", pa.string()), ("error", pa.string()), ("records", pa.int32()), ("fingerprint", pa.string())]))

    frames = E.frames(spark, sf).select("sequence", "scope", "day", "frame")
    spoiled = F.when(F.col("sequence") % 5 == 0, F.substring("frame", 1, 10)).when(F.col("sequence") % 5 == 1, F.concat(F.substring("frame", 1, 16), F.unhex(F.lit("FF")), F.substring("frame", 18, 1 << 20))).otherwise(F.col("frame"))
    return frames.withColumn("frame", spoiled).mapInArrow(run, schema)


@query
def wal_scan(spark, sf):
    rows = E.segments(spark, sf).mapInArrow(lambda b: wal._entries(b, "sealed"), wal.ENTRIES)
    return rows.select("object_key", F.col("sequence").cast("long"), N.hexed(F.col("entry_hash")).alias("entry_hash"), (N.entry_hash(F.col("sequence"), F.col("previous_entry_hash"), F.col("receive_wall_s"), F.col("receive_monotonic_us"), N.batch_hash(F.col("frame")), F.col("frame")) == F.col("entry_hash")).alias("agrees"))


@query
def cursor_outcomes(spark, sf):
    return gateway.acknowledge(E.frames(spark, sf).select("scope", "arrival", "now", "frame"), lease_s=10**9)


@query
def canonical_json(spark, sf):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            text = [C.canonical_json({"revision": r["revision"], "date": r["day"], "sha256": r["digest"]}).decode() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("day"), batch.column("revision"), pa.array(text, pa.string())], names=["day", "revision", "json"])

    return _revisions(spark, sf).select("day", "revision", "digest").mapInArrow(run, "day string, revision long, json string")
