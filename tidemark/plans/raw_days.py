"""The driver's queries on raw days: a real chain of entries for each symbol, manifests made of it, and their proof."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import archive, chains, publication, selection
from tidemark.plans import events as E
from tidemark.plans.catalogue import query
from tidemark.streaming import gateway, incremental

#: Entries of an object, every so many entries an error, and a symbol's configuration but for its names.
OBJECT, ERRORS = 8, 7
#: Batches in which objects arrive.
TICKS = 10
#: Entries of a chain that a worker holds as Python values at once.
ROWS = 1024
CONFIG = {
    "broker_server_fingerprint": "broker", "day_definition_id": "utc-day-v1", "gateway_build_identity": "gateway", "producer_build_identity": "producer", "protocol_limits": {"max_frame_bytes": 1048576, "max_records": 4096, "max_string_bytes": 255},
    "protocol_version": 1, "provider_id": "provider", "publisher_epoch": 1, "publisher_id": "publisher", "settle_policy": "settle", "stable_feed_id": "feed",
}


def configuration(symbol: str) -> dict:
    return CONFIG | {"dataset_id": f"dataset-{symbol}", "exact_source_symbol": symbol}


def records(spark, sf) -> DataFrame:
    """Each symbol's ticks in entries of E.BATCH records: symbol, sequence, ordinal, record and what the selection needs."""
    rows = chains.ranked(E.fingerprints(spark, sf), "event_id", "n", by=("symbol",)).select("symbol", "time_msc", "time", "day", "capture_sequence", "record", (F.col("n") - 1).alias("n"))
    sequence = (F.floor(F.col("n") / E.BATCH) + 1).cast("long")
    rows = rows.select("*", sequence.alias("sequence"), (F.col("n") % E.BATCH).cast("long").alias("ordinal"), F.floor((sequence - 1) / OBJECT).cast("long").alias("object"))
    name = F.sha2(F.concat_ws("/", "symbol", F.col("object").cast("string")), 256)
    error = F.when(F.col("sequence") % ERRORS == 0, E.ERROR).otherwise(0)
    return rows.select("symbol", "sequence", "ordinal", "day", "time", "time_msc", "capture_sequence", "record", "object", name.alias("object_sha256"), N.raw_object_key(name).alias("object_key"), error.alias("error"))


def chained(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A symbol's entries with their digests, read in order as a stream, of any length."""
    previous = D.ZERO
    for batch in (some.slice(k, ROWS) for some in batches for k in range(0, some.num_rows, ROWS)):
        before, own = [], []
        for sequence, wall, frame in zip(*(batch.column(c).to_pylist() for c in ("sequence", "wall", "frame")), strict=True):
            before.append(previous.hex())
            previous = C.entry_hash(sequence, previous, wall, sequence, C.batch_hash(frame), frame)
            own.append(previous.hex())
        symbol = pa.array([key[0].as_py()] * len(own), pa.string())
        yield pa.RecordBatch.from_arrays([symbol, batch.column("sequence"), pa.array(before, pa.string()), pa.array(own, pa.string())], names=["symbol", "sequence", "previous_hash", "entry_hash"])


def entries(rows: DataFrame) -> DataFrame:
    """symbol, sequence, previous_hash and entry_hash: each symbol's chain from the zero hash, with the format's digests of the records' bytes."""
    frames = rows.groupBy("symbol", "sequence").agg(F.array_sort(F.collect_list(F.struct("ordinal", "record"))).alias("r"), F.max("time").alias("wall"))
    frames = frames.select("symbol", "sequence", "wall", F.aggregate(F.transform("r", lambda x: x["record"]), N.raw(b""), lambda a, x: F.concat(a, x)).alias("frame"))
    return frames.repartition("symbol").sortWithinPartitions("symbol", "sequence").groupBy("symbol").applyInArrow(chained, "symbol string, sequence long, previous_hash string, entry_hash string")


def segments(found: DataFrame) -> DataFrame:
    """Objects of each symbol; a record counts for 60 bytes."""
    return found.groupBy("symbol", "object_key", "object_sha256").agg(
        (F.count("*") * 60).alias("file_bytes"), F.min("sequence").alias("start_sequence"), F.max("sequence").alias("last_sequence"), F.min_by("previous_hash", "sequence").alias("chain_start"), F.max_by("entry_hash", "sequence").alias("chain_root")
    )


def tables(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, entries and segments, as an archive has them."""
    rows = records(spark, sf)
    chain = E.stored(entries(rows), "entries")
    found = E.stored(rows.drop("record", "time").join(chain, ["symbol", "sequence"]), "records")
    return found, chain, E.stored(segments(found), "segments")


def configurations(spark, sf) -> dict[str, dict]:
    names = [r[0] for r in spark.read.parquet(f"{sf}/events.parquet").select("event_type").distinct().limit(1001).collect()]
    if len(names) > 1000:
        raise ValueError("more symbols than configurations")
    return {s: configuration(s) for s in names}


def manifests(spark, sf, found: DataFrame, own: DataFrame) -> DataFrame:
    return E.stored(archive.with_manifests(archive.raw_days(found, own, "symbol"), configurations(spark, sf), "symbol"), "manifests")


def summary(rows: DataFrame) -> DataFrame:
    return rows.select("symbol", "day", "accepted", "errors", "first_sequence", "start_root", "last_sequence", "end_root", F.size("objects").cast("long").alias("ranges"), F.size("chain_objects").cast("long").alias("chain"), "raw_set_root", "manifest_sha256")


def spoiled(days: DataFrame) -> DataFrame:
    """Manifests of which some do not say what the segments hold: by the day of the month a count, a root, a lost range or a wrong object."""
    n = F.dayofmonth(F.col("day").cast("date"))
    wrong = F.transform("chain_objects", lambda o: o.withField("bytes", o["bytes"] + 1))
    return (
        days.withColumn("accepted", F.when(n % 6 == 1, F.col("accepted") + 1).otherwise(F.col("accepted")))
        .withColumn("end_root", F.when(n % 6 == 2, F.lit("f" * 64)).otherwise(F.col("end_root")))
        .withColumn("objects", F.when(n % 6 == 3, F.slice("objects", 2, 2**31 - 1)).otherwise(F.col("objects")))
        .withColumn("chain_objects", F.when(n % 6 == 4, wrong).otherwise(F.col("chain_objects")))
    )


@query
def entry_chain(spark, sf):
    return entries(records(spark, sf))


@query
def raw_day_manifest(spark, sf):
    found, _, own = tables(spark, sf)
    return summary(manifests(spark, sf, found, own))


@query
def incremental_days(spark, sf):
    """The same manifests from the states of days: each symbol's objects come in TICKS batches, of which each is folded from its own records alone."""
    found, _, own = tables(spark, sf)
    many = own.groupBy("symbol").agg(F.count("*").alias("objects"))
    batch = F.floor(F.floor((F.col("start_sequence") - 1) / OBJECT) * TICKS / F.col("objects")).cast("int")
    dealt = own.join(many, "symbol").select("symbol", "object_key", batch.alias("batch"))
    records, objects = (E.stored(x.join(dealt, ["symbol", "object_key"]).select(*x.columns, "batch"), "ticks", "batch") for x in (found, own))
    days = incremental.DayTables(spark, E.place(spark, "days"), ("symbol",))
    for k in range(TICKS):
        days.fold(k, records.where(F.col("batch") == k).drop("batch"), objects.where(F.col("batch") == k).drop("batch"))
    return summary(archive.with_manifests(days.days(), configurations(spark, sf), "symbol"))


@query
def verify_day(spark, sf):
    found, chain, own = tables(spark, sf)
    days = spoiled(manifests(spark, sf, found, own))
    return archive.verify_days(days, found, chain, own, "symbol").drop("manifest_sha256")


@query
def segment_coverage(spark, sf):
    found, _, own = tables(spark, sf)
    days = spoiled(manifests(spark, sf, found, own))
    return archive.segment_coverage(days, found, own, "symbol").select("symbol", "day", "object_key", "covered")


@query
def verify_scope(spark, sf):
    """Each symbol's chain up to the roots of its entries with number 1, 5, 10, ...; every tenth entry of one symbol in two is lost, and of one root in ten nothing is known."""
    chain = E.stored(entries(records(spark, sf)), "entries")
    lossy = F.octet_length("symbol") % 2 == 0
    roots = chain.where("sequence = 1 OR sequence % 5 = 0").select("symbol", F.when(F.col("sequence") % 50 == 25, F.lit("e" * 64)).otherwise(F.col("entry_hash")).alias("root")).distinct()
    return archive.verify_scope(chain.where(~(lossy & (F.col("sequence") % 10 == 7))), roots, "symbol")


@query
def restore_entries(spark, sf):
    """The entries of each symbol from its second to its ninth."""
    chain = E.stored(entries(records(spark, sf)), "entries")
    slices = chain.where("sequence BETWEEN 2 AND 9").groupBy("symbol").agg(F.min("sequence").alias("first_sequence"), F.max("sequence").alias("last_sequence"), F.min_by("previous_hash", "sequence").alias("start_root"), F.max_by("entry_hash", "sequence").alias("end_root"))
    return archive.restored(chain, slices, "symbol").select("symbol", "sequence", "entry_hash")


@query
def compact_ranges(spark, sf):
    found, _, _ = tables(spark, sf)
    return archive.compact(found, "symbol").select("symbol", "day", "object_key", "start", "first_ordinal", "end", "last_ordinal")


@query
def full_day_equivalence(spark, sf):
    """Compact ranges against the records of their days; those of every fourth day start one record late and every fifth day's take the whole of their last entry."""
    found, _, _ = tables(spark, sf)
    n = F.dayofmonth(F.col("day").cast("date"))
    ranges = archive.compact(found, "symbol").withColumn("first_ordinal", F.when(n % 4 == 0, F.col("first_ordinal") + 1).otherwise(F.col("first_ordinal"))).withColumn("last_ordinal", F.when(n % 5 == 0, E.BATCH).otherwise(F.col("last_ordinal")))
    return archive.equivalence(ranges, found, "symbol")


@query
def verified_replay(spark, sf):
    found, chain, own = tables(spark, sf)
    return archive.verified_replay(manifests(spark, sf, found, own), found, chain, own, "symbol").select("symbol", "day", "sequence", "ordinal", "capture_sequence")


@query
def newest_cover(spark, sf):
    """For each object the day whose sound manifest covers it last; revisions are made of the days' order."""
    found, _, own = tables(spark, sf)
    days = spoiled(manifests(spark, sf, found, own)).withColumn("revision", F.unix_date(F.col("day").cast("date")).cast("long"))
    return archive.newest_cover(own.select("symbol", "object_key"), days, archive.segment_coverage(days, found, own, "symbol"), "symbol").select("symbol", "object_key", "day", "revision")


@query
def only_day_objects(spark, sf):
    found, _, _ = tables(spark, sf)
    day = F.min("day").over(Window.partitionBy("symbol", "object_key"))
    return archive.only_day(found.withColumn("first_day", day), F.col("first_day"), "symbol")


@query
def manifest_preflight(spark, sf):
    """Manifests within limits that are those of the largest one."""
    found, _, own = tables(spark, sf)
    days = archive.raw_days(found, own, "symbol")
    return archive.preflight(days, {"max_objects": 2**31, "max_object_bytes": 2**40, "max_total_bytes": 2**50, "max_ranges": 2**31}).select("symbol", "day", F.size("objects").cast("long").alias("ranges"))


@query
def overlapping_slices(spark, sf):
    """Objects of each symbol that share an entry with the slice from 3 to 12."""
    found, _, own = tables(spark, sf)
    rows = own.withColumnRenamed("start_sequence", "first_sequence")
    return selection.overlapping(rows, 3, 12).select("symbol", "object_key", "first_sequence", "last_sequence")


@query
def segment_rotation(spark, sf):
    """Each symbol's entries in segments of 20,000 bytes or 40 hours."""
    rows = records(spark, sf).groupBy("symbol", "sequence").agg((F.count("*") * 60 + 140).alias("bytes"), F.max("time").alias("wall_s"))
    return gateway.segment_groups(rows.withColumnRenamed("symbol", "scope"), 20_000, 144_000).select("scope", "sequence", "segment")


@query
def boundary_digest(spark, sf):
    """Of each symbol and day: the digest over the fingerprints of the records at its newest millisecond, in the order of capture."""
    rows = E.fingerprints(spark, sf).withColumn("cursor", F.max("time_msc").over(Window.partitionBy("symbol", "day"))).where("time_msc = cursor")
    prints = rows.groupBy("symbol", "day", "cursor").agg(F.transform(F.array_sort(F.collect_list(F.struct("capture_sequence", "fingerprint"))), lambda x: x["fingerprint"]).alias("prints"))
    return prints.select("symbol", "day", "cursor", F.size("prints").cast("long").alias("records"), N.hexed(N.boundary(F.col("cursor"), N.raw(D.ZERO), F.col("prints"))).alias("digest"))


@query
def segment_ids(spark, sf):
    """A continuity segment a symbol and day, at its first record."""
    rows = E.ticks(spark, sf).groupBy("symbol", "day").agg(F.min(F.struct("sequence", "ordinal")).alias("at"))
    scope = [F.concat(F.lit("dataset-"), F.col("symbol")), F.lit("utc-day-v1"), F.col("day"), F.lit("replay-v1"), F.lit("conversion-v1")]
    own = N.segment_id(scope, F.lit("manifests/raw-day"), N.raw(E.SCOPE["raw_day_manifest_sha256"]), F.col("at.sequence"), F.col("at.ordinal"), F.lit("SEGMENT_START"), N.raw(D.ZERO))
    return rows.select("symbol", "day", own.alias("segment_id"))


@query
def late_revisions(spark, sf):
    """Days whose first revision lacks every tenth entry: what arrives late makes a second one, days without such entries stay."""
    rows = E.ticks(spark, sf)
    columns = ["accepted", "source_watermark", "capture_watermark", "last_sequence"]
    known = selection.day_selection(rows.where("sequence % 10 <> 0")).select("day", *columns, F.lit(1).cast("long").alias("revision"), F.sha2("day", 256).alias("digest"))
    now = selection.day_selection(rows).select("day", *columns)
    return selection.next_revisions(now, known, ["day"], columns).select("day", "accepted", "revision", "previous")


@query
def watermark_regressions(spark, sf):
    """Revisions of each symbol, one a hundred records, of which every third lost records: watermarks or ranges go back. A revision's ranges are numbered from 0, so they are one run."""
    rows = chains.ranked(E.ticks(spark, sf), "event_id", "n", by=("symbol",)).withColumn("n", F.col("n") - 1)
    marks = rows.groupBy("symbol", F.floor(F.col("n") / 100).cast("long").alias("k")).agg(F.max("time_msc").alias("source_watermark"), F.max("capture_sequence").alias("capture_watermark"))
    lost = F.col("k") % 3 == 2
    upto = F.when(lost, F.greatest(F.col("k") - 2, F.lit(0))).otherwise(F.col("k"))
    marks = marks.select("symbol", (F.col("k") + 1).alias("revision"), "source_watermark", F.when(lost, F.col("capture_watermark") - 100_000).otherwise(F.col("capture_watermark")).alias("capture_watermark"), F.array(F.struct(F.lit(0).cast("long").alias("first"), upto.alias("last"))).alias("runs"))
    return selection.watermark_regressions(marks, "symbol").select("symbol", "revision", "regression")


@query
def observation_classes(spark, sf):
    """What a store has of an object an entry: by its number exact, absent, different, doubled, oversized or out of reach."""
    rows = E.ticks(spark, sf).groupBy("sequence").agg(F.count("*").alias("bytes"))
    name, sha = F.concat(F.lit("object-"), F.col("sequence").cast("string")), F.sha2(F.col("sequence").cast("string"), 256)
    expected = rows.select(F.lit(1).alias("publication"), F.lit("parquet").alias("barrier"), name.alias("object_id"), sha.alias("sha256"), "bytes")
    n = F.col("sequence") % 6
    seen = rows.where(n != 1).select(name.alias("object_id"), F.when(n == 2, F.lit("0" * 64)).otherwise(sha).alias("sha256"), F.when(n == 4, 1000).otherwise(F.col("bytes")).alias("bytes"), (n != 5).alias("available"), n.alias("n"))
    return publication.observe(expected, seen.unionByName(seen.where("n = 3")), 900).select("object_id", "class")


@query
def supplied_objects(spark, sf):
    """Descriptors of the objects of raw days against what is supplied: every fifth is missing, every seventh of another size, every eleventh there twice."""
    found, _, own = tables(spark, sf)
    wanted = own.select(F.col("object_key").alias("key"), F.col("object_sha256").alias("sha256"), F.col("file_bytes").alias("bytes"), "start_sequence")
    n = F.floor((F.col("start_sequence") - 1) / OBJECT)
    there = wanted.where(n % 5 != 4).withColumn("bytes", F.when(n % 7 == 6, F.col("bytes") + 1).otherwise(F.col("bytes")))
    return chains.supplied(wanted.drop("start_sequence"), there.unionByName(there.where(n % 11 == 10)).select("key", "sha256", "bytes")).select("key", "state")
