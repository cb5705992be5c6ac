"""Raw days: manifests made of sealed segments, and the proof that a manifest says what the segments hold.

Records are one row each (scope columns, object_key, sequence, ordinal, day, time_msc, capture_sequence,
error, previous_hash, entry_hash; an entry without records has one row, its sentinel, with a null
time_msc, on the day that was asked for). Entries are one row each (scope columns, sequence,
previous_hash, entry_hash), segments too (scope columns, object_key, object_sha256, file_bytes,
start_sequence, last_sequence, chain_start, chain_root). Hashes are hexadecimal. Everything is grouped
or joined by scope and a number, so any number of days and manifests is proved in one query.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import chains, selection

RECORDS = "object_key string, sequence long, ordinal long, day string, time_msc long, capture_sequence long, error int, previous_hash string, entry_hash string"
#: The fields of a raw day's manifest and of its objects.
DAY_KEYS = (
    "accepted_record_count", "chain_objects", "chain_slice_end_root", "chain_slice_end_sequence", "chain_slice_start_root", "chain_slice_start_sequence", "completeness_status", "config_hash", "dataset_id", "date",
    "day_definition_id", "error_count", "logical_close_time_s", "manifest_id", "manifest_version", "objects", "observed_through_capture_sequence", "observed_through_source_msc", "previous_manifest_sha256",
    "protocol_version", "publisher_epoch", "publisher_id", "raw_set_root", "revision", "settle_policy", "source_schema_id", "terminal_sync_status", "wal_schema_id",
)
OBJECT_KEYS = ("bytes", "end_ingest_sequence", "first_record_ordinal", "key", "last_record_ordinal", "sha256", "start_ingest_sequence")
CHAIN_KEYS = ("bytes", "end_ingest_sequence", "key", "sha256", "start_ingest_sequence")
#: The same in the order in which raw_days() has them, by which it sorts.
OBJECT_ORDER = ("start_ingest_sequence", "first_record_ordinal", "bytes", "end_ingest_sequence", "key", "last_record_ordinal", "sha256")
CHAIN_ORDER = ("start_ingest_sequence", "end_ingest_sequence", "bytes", "key", "sha256")
#: The fields of a scope's configuration.
CONFIG_KEYS = (
    "broker_server_fingerprint", "dataset_id", "day_definition_id", "exact_source_symbol", "gateway_build_identity", "producer_build_identity", "protocol_limits", "protocol_version", "provider_id", "publisher_epoch",
    "publisher_id", "settle_policy", "stable_feed_id",
)


def records(entries: DataFrame) -> DataFrame:
    """The records of verified entries (object_key, sequence, previous_entry_hash, entry_hash, frame); a frame that is no batch fails the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORDS.split(", ")])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out: list[list[Any]] = [[] for _ in names]
                for row in batch.slice(start, 256).to_pylist():
                    kind, message = C.decode_message(row["frame"])
                    if kind != "BATCH":
                        raise C.FormatError("INVALID_FIELD", f"entry {row['sequence']} is no batch")
                    some = message["records"] or [{"time_msc": None, "capture_sequence": None}]
                    for k, record in enumerate(some):
                        msc = message["requested_from_msc"] if record["time_msc"] is None else record["time_msc"]
                        values = (row["object_key"], int(row["sequence"]), k, day_of(msc), record["time_msc"], record["capture_sequence"], message["copy_ticks_error"], row["previous_entry_hash"].hex(), row["entry_hash"].hex())
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(out, names, strict=True)], schema=schema)

    return entries.select("object_key", "sequence", "previous_entry_hash", "entry_hash", "frame").mapInArrow(run, RECORDS)


def day_of(msc: int) -> str:
    """The UTC day of milliseconds, floored for negative ones."""
    import datetime

    return (datetime.date(1970, 1, 1) + datetime.timedelta(days=msc // 86_400_000)).isoformat()


def covering(scopes: list[str], days: DataFrame, segments: DataFrame, first: str, last: str) -> DataFrame:
    """days with each segment from the one that holds entry first to the one that holds entry last.

    Segments of a scope are numbered; a day's numbers are looked up by the keys of its end segments, so the interval join is two
    equi-joins. A day without an entry has no segment.
    """
    number = F.row_number().over(Window.partitionBy(*scopes).orderBy("start_sequence"))
    numbered = segments.withColumn("_no", number)
    ends = numbered.select(*scopes, "object_key", "_no")
    from_ = ends.select(*scopes, F.col("object_key").alias(first), F.col("_no").alias("_from"))
    to = ends.select(*scopes, F.col("object_key").alias(last), F.col("_no").alias("_to"))
    spread = days.join(from_, [*scopes, first]).join(to, [*scopes, last]).withColumn("_no", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
    return spread.join(numbered, [*scopes, "_no"]).drop("_no")


def raw_days(found: DataFrame, segments: DataFrame, *scopes: str) -> DataFrame:
    """For each scope and day of records what its manifest binds: counts, watermarks, slice, ordered objects and chain_objects, and the root over the objects."""
    by = [*scopes, "day"]
    days = selection.day_selection(found, *scopes)
    ends = found.groupBy(*by).agg(F.min_by("object_key", "sequence").alias("first_key"), F.max_by("object_key", "sequence").alias("last_key"))
    runs = selection.ranges(found, *scopes, "object_key").join(segments.select(*scopes, "object_key", "object_sha256", "file_bytes"), [*scopes, "object_key"])
    own = F.struct(
        F.col("sequence").alias("start_ingest_sequence"), F.col("first_ordinal").cast("long").alias("first_record_ordinal"), F.col("file_bytes").alias("bytes"), F.col("sequence").alias("end_ingest_sequence"),
        F.col("object_key").alias("key"), F.col("last_ordinal").cast("long").alias("last_record_ordinal"), F.col("object_sha256").alias("sha256"),
    )
    objects = runs.groupBy(*by).agg(F.array_sort(F.collect_list(own)).alias("objects"))
    held = covering(list(scopes), ends, segments, "first_key", "last_key")
    part = F.struct(F.col("start_sequence").alias("start_ingest_sequence"), F.col("last_sequence").alias("end_ingest_sequence"), F.col("file_bytes").alias("bytes"), F.col("object_key").alias("key"), F.col("object_sha256").alias("sha256"))
    chain = held.groupBy(*by).agg(F.array_sort(F.collect_list(part)).alias("chain_objects"))
    flat = objects.select(*by, F.explode("objects").alias("o")).select(
        *by, F.unhex("o.sha256").alias("sha256"), F.col("o.bytes").alias("bytes"), F.col("o.start_ingest_sequence").alias("start"), F.col("o.end_ingest_sequence").alias("end"), F.col("o.first_record_ordinal").alias("first_ordinal"), F.col("o.last_record_ordinal").alias("last_ordinal")
    )
    roots = selection.raw_set_root(flat, *by)
    return days.join(objects, by).join(chain, by).join(roots, by)


def config_hash(config: dict[str, Any]) -> str:
    """Digest of a scope's configuration."""
    if set(config) != set(CONFIG_KEYS):
        raise C.FormatError("INVALID_FIELD", "configuration keys")
    return C.digest(D.CONFIG, config).hex()


def manifest_id(provider: str, symbol: str, date: str, revision: int) -> str:
    part = lambda x: C.u64(len(x.encode())) + x.encode()
    return f"raw-{C.sha(D.SCOPE_KEY, part(provider), part(symbol)).hex()[:16]}-{date}-r{revision}"


def manifest_value(day: dict[str, Any], config: dict[str, Any], revision: int, previous: str | None, completeness: str, sync: str, closed_s: int) -> dict[str, Any]:
    """The manifest of a row of raw_days()."""
    if completeness not in D.COMPLETENESS or not sync or revision < 1 or (revision == 1) != (previous is None):
        raise C.FormatError("INVALID_FIELD", "status or revision")
    pick = lambda o, names: {n: o[n] for n in names}
    return {
        "accepted_record_count": day["accepted"], "chain_objects": [pick(o, CHAIN_KEYS) for o in day["chain_objects"]], "chain_slice_end_root": day["end_root"], "chain_slice_end_sequence": day["last_sequence"],
        "chain_slice_start_root": day["start_root"], "chain_slice_start_sequence": day["first_sequence"], "completeness_status": completeness, "config_hash": config_hash(config), "dataset_id": config["dataset_id"],
        "date": day["day"], "day_definition_id": config["day_definition_id"], "error_count": day["errors"], "logical_close_time_s": closed_s,
        "manifest_id": manifest_id(config["provider_id"], config["exact_source_symbol"], day["day"], revision), "manifest_version": "raw-day-manifest-v1", "objects": [pick(o, OBJECT_KEYS) for o in day["objects"]],
        "observed_through_capture_sequence": day["capture_watermark"], "observed_through_source_msc": day["source_watermark"], "previous_manifest_sha256": previous, "protocol_version": config["protocol_version"],
        "publisher_epoch": config["publisher_epoch"], "publisher_id": config["publisher_id"], "raw_set_root": day["raw_set_root"], "revision": revision, "settle_policy": config["settle_policy"],
        "source_schema_id": D.SCHEMA_ID, "terminal_sync_status": sync, "wal_schema_id": "gateway-wal-v1",
    }


def succeeds(previous: dict[str, Any], current: dict[str, Any]) -> None:
    """Raise unless current may follow previous: same scope, nothing taken away or changed, no count, watermark or slice end moved back."""
    same = ("dataset_id", "day_definition_id", "date", "publisher_id", "publisher_epoch", "config_hash", "chain_slice_start_sequence", "chain_slice_start_root")
    grows = ("accepted_record_count", "error_count", "observed_through_source_msc", "observed_through_capture_sequence", "chain_slice_end_sequence")
    kept = all(current[n][: len(previous[n])] == previous[n] for n in ("objects", "chain_objects"))
    stands = current["chain_slice_end_sequence"] != previous["chain_slice_end_sequence"] or current["chain_slice_end_root"] == previous["chain_slice_end_root"]
    if any(current[n] != previous[n] for n in same) or any(current[n] < previous[n] for n in grows) or not kept or not stands or current["revision"] != previous["revision"] + 1:
        raise C.FormatError("INVALID_FIELD", "the manifest does not succeed the one before it")


def manifest_key(day_definition: str, date: str, revision: int, digest: str) -> str:
    """Where a raw day's manifest lies below its scope."""
    return f"snapshots/raw/day-definition={C.sha(day_definition.encode()).hex()}/date={date}/raw-day-{revision}-{digest}.json"


def with_manifests(days: DataFrame, configs: dict[str, dict[str, Any]], scope: str, completeness: str = "provisional", sync: str = "synced", closed_s: int = 0) -> DataFrame:
    """First revisions of raw_days(): manifest (canonical JSON) and manifest_sha256 of each day; configs has the configuration of each value of the column scope."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [C.canonical_json(manifest_value(row, configs[row[scope]], 1, None, completeness, sync, closed_s)) for row in batch.to_pylist()]
            columns = [*batch.columns, pa.array([t.decode() for t in texts], pa.string()), pa.array([C.sha(D.RAW_DAY, t).hex() for t in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "manifest", "manifest_sha256"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in days.schema)
    return days.mapInArrow(run, f"{schema}, manifest string, manifest_sha256 string")


def parsed(spark: SparkSession, documents: list[tuple[str, bytes]]) -> DataFrame:
    """Manifests (scope, canonical bytes) as rows like those of raw_days(), with manifest_sha256 and revision."""
    kinds = lambda keys: ", ".join(f"{k}:{'string' if k in ('key', 'sha256') else 'long'}" for k in keys)
    fields = {
        "day": "date", "accepted": "accepted_record_count", "errors": "error_count", "source_watermark": "observed_through_source_msc", "capture_watermark": "observed_through_capture_sequence", "first_sequence": "chain_slice_start_sequence",
        "last_sequence": "chain_slice_end_sequence", "start_root": "chain_slice_start_root", "end_root": "chain_slice_end_root", "raw_set_root": "raw_set_root", "revision": "revision",
    }
    rows = []
    for scope, data in documents:
        value = C.parse_canonical(data, set(DAY_KEYS))
        rows.append((scope, C.sha(D.RAW_DAY, data).hex(), *(value[n] for n in fields.values()), [tuple(o[k] for k in OBJECT_ORDER) for o in value["objects"]], [tuple(o[k] for k in CHAIN_ORDER) for o in value["chain_objects"]]))
    text = ("day", "start_root", "end_root", "raw_set_root")
    schema = "scope string, manifest_sha256 string, " + ", ".join(f"{n} {'string' if n in text else 'long'}" for n in fields)
    return spark.createDataFrame(rows, f"{schema}, objects array<struct<{kinds(OBJECT_ORDER)}>>, chain_objects array<struct<{kinds(CHAIN_ORDER)}>>")


def linked(entries: DataFrame, *scopes: str) -> DataFrame:
    """entries with place (their number in the scope) and faults: how many entries up to here do not follow the one before them by number and hash."""
    return chains.linked_in_ranges(entries, list(scopes), "sequence", "previous_hash", "entry_hash")


def slice_holds(slices: DataFrame, entries: DataFrame, *scopes: str) -> DataFrame:
    """slices (scopes, first_sequence, start_root, last_sequence, end_root) with anchored: whether the entries lead from the one root to the other without a gap.

    Running counts of faults make it two equi-joins, whatever the number and length of slices.
    """
    rows = linked(entries, *scopes)
    first = rows.select(*scopes, F.col("sequence").alias("first_sequence"), F.col("place").alias("_p1"), F.col("faults").alias("_f1"), F.col("previous_hash").alias("_before"))
    last = rows.select(*scopes, F.col("sequence").alias("last_sequence"), F.col("place").alias("_p2"), F.col("faults").alias("_f2"), F.col("entry_hash").alias("_after"))
    joined = slices.join(first, [*scopes, "first_sequence"], "left").join(last, [*scopes, "last_sequence"], "left")
    whole = (F.col("_p2") - F.col("_p1") == F.col("last_sequence") - F.col("first_sequence")) & (F.col("_f1") == F.col("_f2"))
    good = whole & (F.col("_before") == F.col("start_root")) & (F.col("_after") == F.col("end_root"))
    return joined.withColumn("anchored", F.coalesce(good, F.lit(False))).drop("_p1", "_p2", "_f1", "_f2", "_before", "_after")


def verify_scope(entries: DataFrame, roots: DataFrame, *scopes: str) -> DataFrame:
    """roots (scopes, root) with from_genesis (the first entry is number 1 after the zero hash), unbroken (up to the root's entry) and reached (some entry has the root)."""
    rows = linked(entries, *scopes)
    at = roots.join(rows.select(*scopes, F.col("entry_hash").alias("root"), F.col("place").alias("_place"), F.col("faults").alias("_faults"), F.col("sequence").alias("_sequence")), [*scopes, "root"], "left")
    start = rows.where("place = 1").select(*scopes, ((F.col("sequence") == 1) & (F.col("previous_hash") == D.ZERO.hex())).alias("from_genesis"))
    unbroken = F.coalesce((F.col("_faults") == 0) & (F.col("_place") == F.col("_sequence")), F.lit(False))
    return at.join(start, list(scopes), "left").select(*scopes, "root", F.coalesce("from_genesis", F.lit(False)).alias("from_genesis"), unbroken.alias("unbroken"), F.col("_sequence").isNotNull().alias("reached"))


#: What of a manifest must be what its slice of the segments gives.
SELECTED = ("accepted", "errors", "source_watermark", "capture_watermark", "first_sequence", "last_sequence", "start_root", "end_root")


def verify_days(manifests: DataFrame, found: DataFrame, entries: DataFrame, segments: DataFrame, *scopes: str) -> DataFrame:
    """manifests (rows as of raw_days() with manifest_sha256) with the facts that the segments prove of each, and valid.

    present: each chain object is there with its size, hash and ends. contiguous: they follow each other.
    anchored: the entries lead from the slice's first root to its last. selected: counts and watermarks
    are those of the slice's records. ranges: so are the objects, chain_objects and the root over them.
    """
    by = [*scopes, "day", "manifest_sha256"]
    named = manifests.select(*by, F.col("first_sequence").alias("_first"), F.col("last_sequence").alias("_last"))
    own = found.join(named, [*scopes, "day"]).where(F.col("sequence").between(F.col("_first"), F.col("_last"))).drop("_first", "_last")
    keyed = segments.select(*scopes, "object_key", "object_sha256", "file_bytes", "start_sequence", "last_sequence", "chain_start", "chain_root")
    again = raw_days(own, keyed.join(named.select(*scopes, "manifest_sha256").distinct(), list(scopes)), *scopes, "manifest_sha256")
    again = again.select(*by, F.struct(*SELECTED).alias("_selected"), F.struct("objects", "chain_objects", "raw_set_root").alias("_ranges"))
    parts = manifests.select(*by, F.posexplode("chain_objects").alias("at", "o"))
    same = keyed.withColumnRenamed("object_key", "key")
    parts = parts.withColumn("key", F.col("o.key")).join(same, [*scopes, "key"], "left")
    order = Window.partitionBy(*by).orderBy("at")
    there = (F.col("o.sha256") == F.col("object_sha256")) & (F.col("o.bytes") == F.col("file_bytes")) & (F.col("o.start_ingest_sequence") == F.col("start_sequence")) & (F.col("o.end_ingest_sequence") == F.col("last_sequence"))
    follows = F.when(F.col("at") == 0, True).otherwise((F.col("start_sequence") == F.lag("last_sequence").over(order) + 1) & (F.col("chain_start") == F.lag("chain_root").over(order)))
    facts = parts.select(*by, F.coalesce(there, F.lit(False)).alias("there"), F.coalesce(follows, F.lit(False)).alias("follows")).groupBy(*by).agg(F.min("there").alias("present"), F.min("follows").alias("contiguous"))
    rows = slice_holds(manifests, entries, *scopes).join(again, by, "left").join(facts, by, "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    rows = rows.select(
        *by, no(F.col("present")).alias("present"), no(F.col("contiguous")).alias("contiguous"), "anchored", no(F.struct(*SELECTED) == F.col("_selected")).alias("selected"),
        no(F.struct("objects", "chain_objects", "raw_set_root") == F.col("_ranges")).alias("ranges"),
    )
    return rows.withColumn("valid", F.col("present") & F.col("contiguous") & F.col("anchored") & F.col("selected") & F.col("ranges"))


def segment_coverage(manifests: DataFrame, found: DataFrame, segments: DataFrame, *scopes: str) -> DataFrame:
    """Each chain object of each manifest with covered: whether the manifest's ranges of it are those that its records give for the day."""
    by = [*scopes, "day", "manifest_sha256", "object_key"]
    chain = manifests.select(*by[:-1], F.explode("chain_objects").alias("o")).select(*by[:-1], F.col("o.key").alias("object_key"))
    said = manifests.select(*by[:-1], F.explode("objects").alias("o")).groupBy(*by[:-1], F.col("o.key").alias("object_key")).agg(F.array_sort(F.collect_list(F.struct("o.start_ingest_sequence", "o.first_record_ordinal", "o.last_record_ordinal"))).alias("said"))
    runs = selection.ranges(found, *scopes, "object_key").groupBy(*scopes, "day", "object_key").agg(F.array_sort(F.collect_list(F.struct("sequence", "first_ordinal", "last_ordinal"))).alias("held"))
    joined = chain.join(segments.select(*scopes, "object_key", F.lit(True).alias("known")), [*scopes, "object_key"], "left").join(said, by, "left").join(runs, [*scopes, "day", "object_key"], "left")
    plain = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: F.array(*(x[k].cast("long") for k in ("a", "b", "c"))))
    said_ = plain(F.col("said").cast("array<struct<a:long,b:long,c:long>>"))
    held_ = plain(F.col("held").cast("array<struct<a:long,b:long,c:long>>"))
    return joined.select(*by, (F.coalesce("known", F.lit(False)) & (said_ == held_)).alias("covered"))


def compact(found: DataFrame, *scopes: str) -> DataFrame:
    """Ranges of consecutive places of an object that belong to a day: start, first_ordinal, end and last_ordinal; entries between are whole."""
    keyed = [*scopes, "object_key"]
    order = Window.partitionBy(*keyed).orderBy("sequence", "ordinal")
    rows = found.withColumn("_at", F.row_number().over(order))
    run = F.col("_at") - F.row_number().over(Window.partitionBy(*keyed, "day").orderBy("sequence", "ordinal"))
    ends = rows.withColumn("_run", run).groupBy(*keyed, "day", "_run").agg(F.min(F.struct("sequence", "ordinal")).alias("a"), F.max(F.struct("sequence", "ordinal")).alias("b"))
    return ends.select(*keyed, "day", F.col("a.sequence").alias("start"), F.col("a.ordinal").alias("first_ordinal"), F.col("b.sequence").alias("end"), F.col("b.ordinal").alias("last_ordinal"))


def equivalence(ranges: DataFrame, found: DataFrame, *scopes: str) -> DataFrame:
    """For each scope and day how many of its places the compact ranges lack, and how many places of other days they take; equal if neither."""
    by = [*scopes, "object_key", "sequence"]
    spread = ranges.withColumn("sequence", F.explode(F.sequence("start", "end")))
    low = F.when(F.col("sequence") == F.col("start"), F.col("first_ordinal")).otherwise(0)
    high = F.when(F.col("sequence") == F.col("end"), F.col("last_ordinal")).otherwise(F.lit(2**31 - 1))
    spread = spread.select(*by, F.col("day").alias("range_day"), low.alias("low"), high.alias("high"))
    taken = found.join(spread, by).where(F.col("ordinal").between(F.col("low"), F.col("high"))).select(*by, "ordinal", F.col("range_day").alias("day")).distinct().withColumn("taken", F.lit(True))
    both = found.select(*by, "ordinal", "day").distinct().withColumn("own", F.lit(True)).join(taken, [*by, "ordinal", "day"], "full_outer")
    per = both.groupBy(*scopes, "day").agg(F.count(F.when(F.col("taken").isNull(), 1)).alias("missing"), F.count(F.when(F.col("own").isNull(), 1)).alias("extra"))
    return per.withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0))


def restored(entries: DataFrame, slices: DataFrame, *scopes: str) -> DataFrame:
    """The entries of each slice in order; a slice that its roots do not anchor fails the query."""
    sound = selection.fail_unless(slice_holds(slices, entries, *scopes), F.col("anchored"), "the slice's roots do not hold")
    ends = sound.select(*scopes, F.explode(F.sequence("first_sequence", "last_sequence")).alias("sequence")).distinct()
    return entries.join(ends, [*scopes, "sequence"], "left_semi").orderBy(*scopes, "sequence")


def preflight(manifests: DataFrame, limits: dict[str, int]) -> DataFrame:
    """manifests, as long as each stays within the limits (max_objects, max_object_bytes, max_total_bytes, max_ranges); nothing but metadata is read."""
    size = lambda o: o["bytes"]
    total = F.aggregate(F.transform("chain_objects", size), F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)"))
    within = (F.size("chain_objects") <= limits["max_objects"]) & (F.coalesce(F.array_max(F.transform("chain_objects", size)), F.lit(0)) <= limits["max_object_bytes"]) & (total <= limits["max_total_bytes"]) & (F.size("objects") <= limits["max_ranges"])
    return selection.fail_unless(manifests, within, "resource limits")


def verified_replay(manifests: DataFrame, found: DataFrame, entries: DataFrame, segments: DataFrame, *scopes: str) -> DataFrame:
    """The records of each manifest in chain order, after the whole manifest has been proved; one that does not hold fails the query."""
    facts = selection.fail_unless(verify_days(manifests, found, entries, segments, *scopes), F.col("valid"), "the day does not verify")
    by = [*scopes, "day", "manifest_sha256"]
    places = manifests.join(facts.select(*by), by).select(*by, F.explode("objects").alias("o"))
    places = places.select(*by, F.col("o.key").alias("object_key"), F.explode(F.sequence("o.start_ingest_sequence", "o.end_ingest_sequence")).alias("sequence"), F.col("o.first_record_ordinal").alias("low"), F.col("o.last_record_ordinal").alias("high"))
    chosen = found.join(places, [*scopes, "day", "object_key", "sequence"]).where(F.col("ordinal").between(F.col("low"), F.col("high"))).drop("low", "high")
    return chosen.orderBy(*scopes, "day", "manifest_sha256", "sequence", "ordinal")


def paths(manifests: DataFrame, local: DataFrame, *scopes: str) -> DataFrame:
    """Chain objects of manifests with the path of local (scopes, object_key, path) that has each; one without a path fails the query."""
    wanted = manifests.select(*scopes, "manifest_sha256", F.posexplode("chain_objects").alias("at", "o")).select(*scopes, "manifest_sha256", "at", F.col("o.key").alias("object_key"))
    return selection.fail_unless(wanted.join(local, [*scopes, "object_key"], "left"), F.col("path").isNotNull(), "no local path")


def newest_cover(artifacts: DataFrame, manifests: DataFrame, coverage: DataFrame, *scopes: str) -> DataFrame:
    """artifacts (scopes, object_key) with the newest revision of a manifest that covers each whole; null where none does."""
    by = [*scopes, "day", "manifest_sha256"]
    good = coverage.where("covered").join(manifests.select(*by, "revision"), by)
    best = good.groupBy(*scopes, "object_key").agg(F.max_by(F.struct("day", "revision", "manifest_sha256"), F.struct("revision", "day", "manifest_sha256")).alias("cover"))
    return artifacts.join(best, [*scopes, "object_key"], "left").select(*artifacts.columns, "cover.day", "cover.revision", "cover.manifest_sha256")


def only_day(found: DataFrame, day: str | Column, *scopes: str) -> DataFrame:
    """Objects with whether all their records, sentinels included, are of one day."""
    return found.groupBy(*scopes, "object_key").agg(F.min(F.col("day") == day).alias("only"))
