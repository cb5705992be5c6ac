"""The driver's queries on lookups, merges, orders and predicates of the archive's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import native as N
from tidemark.operators import chains, operations, publication, publishing, retention, selection
from tidemark.plans import events as E
from tidemark.plans.catalogue import _parts, _revisions, _segments, _work, query

POLICY = {"critical": 3000, "max_pending": 5, "max_pending_bytes": 4000}


@query
def batch_lookup(spark, sf):
    """Every batch of each session, looked up in a journal that lost every third entry, then in a log that lost every fifth."""
    key = ["session", "batch_sequence"]
    rows = E.ticks(spark, sf).select(F.concat(F.lit("session-"), (F.col("volume") % 20).cast("string")).alias("session"), F.col("sequence").alias("batch_sequence")).distinct()
    named = lambda p: rows.withColumn("hash", F.sha2(F.concat(F.lit(p), F.col("session"), F.lit("/"), F.col("batch_sequence").cast("string")), 256))
    return chains.looked_up(rows, named("journal/").where("batch_sequence % 3 <> 0"), named("log/").where("batch_sequence % 5 <> 0")).select(*key, "hash", "found_in")


@query
def catalog_merge(spark, sf):
    """A catalog of three quarters of the entries, with fresh rows of every second one: what was done stays, what was measured is replaced."""
    rows = _work(spark, sf).select("sequence", "state", "attempts", "bytes", "date")
    fresh = rows.where("sequence % 2 = 0").select("sequence", F.lit("sealed").alias("state"), F.lit(0).cast("long").alias("attempts"), (F.col("bytes") + 1).alias("bytes"), "date")
    return publication.merged(rows.where("sequence % 4 <> 0"), fresh, ["sequence"], ["state", "attempts"])


@query
def replay_revision_breaks(spark, sf):
    """Replay revisions, of which each even one of a day binds the raw day of the one before it."""
    rows = _revisions(spark, sf).withColumn("raw_digest", F.sha2(F.concat_ws("/", F.lit("raw"), "day", F.floor((F.col("revision") + 1) / 2).cast("string")), 256))
    return selection.replay_breaks(rows, "day").select("day", "revision", "breaks")


@query
def unexpected_trash(spark, sf):
    rows = _segments(spark, sf)
    trash = rows.select(F.concat(F.lit("segment-"), F.col("segment").cast("string")).alias("name"), F.col("object_sha256").alias("sha256"))
    return retention.unexpected(trash, rows.where("segment % 4 <> 1").select(F.col("object_sha256").alias("segment_sha256"))).select("name", "sha256")


@query
def ranges_not_ascending(spark, sf):
    """A range an entry and day; every seventh reaches into the next entry, every eleventh ends before it starts."""
    rows = E.ticks(spark, sf).groupBy("day", "sequence").agg(F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"))
    end = F.col("sequence") + F.when(F.col("sequence") % 7 == 3, 1).when(F.col("sequence") % 11 == 5, -1).otherwise(0)
    found = rows.select("day", F.col("sequence").alias("start"), "first_ordinal", end.alias("end"), "last_ordinal")
    return selection.not_ascending(found, "day").select("day", "start", "first_ordinal", "end", "last_ordinal")


@query
def plannable_days(spark, sf):
    """Days whose next revision may be planned, where the store has the last manifests of even days, and every fifth day has none."""
    n = F.dayofmonth(F.col("day").cast("date"))
    days = E.ticks(spark, sf).select("day").distinct()
    revisions = _revisions(spark, sf).where(n % 5 != 1).select("day", "revision", "digest")
    return publishing.plannable(days, revisions, revisions.where(n % 2 == 0).select("digest")).select("day")


@query
def ack_readiness(spark, sf):
    """Whether each entry may be acknowledged, given what its number says of room, failed appends and backlog."""
    n = F.col("sequence")
    rows = E.ticks(spark, sf).groupBy("sequence").agg((F.count("*") * 60).alias("bytes"))
    free = F.when(n % 13 != 6, F.col("bytes") + n % 3 * 700)
    return rows.select("sequence", operations.ready(free, n % 17 == 4, n % 7, F.col("bytes") + n % 5 * 50, POLICY).alias("ready"))


@query
def escaped_components(spark, sf):
    """Path components of names with signs and letters beyond ASCII."""
    name = F.concat(F.col("symbol"), F.lit("/é '"), F.col("volume").cast("string"), F.lit("~漢.x"))
    return E.ticks(spark, sf).select(name.alias("name")).distinct().select("name", N.exact_component(F.col("name")).alias("component"))


@query
def valid_days(spark, sf):
    """Spellings of the events' days and whether they are days."""
    forms = F.array(F.col("day"), F.concat(F.substring("day", 1, 8), F.lit("31")), F.concat(F.substring("day", 1, 5), F.lit("02-"), F.substring("day", 9, 2)), F.replace(F.col("day"), F.lit("-"), F.lit("/")), F.substring("day", 1, 9), F.concat(F.col("day"), F.lit(" ")))
    return E.ticks(spark, sf).select("day").distinct().select("day", F.posexplode(forms).alias("form", "value")).select("value", "form", "day", N.is_day(F.col("value")).alias("valid"))


@query
def observation_rounds(spark, sf):
    """How many observations the parts of each user need."""
    return _parts(spark, sf).groupBy("user_id").agg(F.count("*").alias("parts")).select("user_id", publication.required_rounds(F.col("parts")).alias("rounds"))


@query
def affected_dates(spark, sf):
    """The days of each segment as the catalog keeps them."""
    return E.ticks(spark, sf).groupBy("segment").agg(F.collect_list("day").alias("days")).select("segment", N.dates_json(F.col("days")).alias("affected_dates_json"))
