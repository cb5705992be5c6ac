"""Which records of a day belong to its manifest, and the roots and revisions that bind them.

Input are ticks: one row a record, with day, sequence (of the log entry), ordinal, time_msc,
capture_sequence, error and the entry's hashes. An entry without records has one row with a null
time_msc, its sentinel, on the day that was asked for. Everything is grouped by day and entry, so
nothing is ordered across the whole input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import domains as D
from tidemark.functions import native as N


def day_selection(ticks: DataFrame, *scope: str) -> DataFrame:
    """For each day: accepted records, entries with an error, watermarks, and the ends of the chain slice.

    Watermarks are the largest values seen and drop nothing; a day of sentinels only has the watermark 0.
    """
    real = F.col("time_msc").isNotNull()
    return ticks.groupBy(*scope, "day").agg(
        F.count(F.when(real, 1)).alias("accepted"),
        F.count_distinct(F.when(F.col("error") != 0, F.col("sequence"))).alias("errors"),
        F.coalesce(F.max("time_msc"), F.lit(0)).cast("long").alias("source_watermark"),
        F.coalesce(F.max("capture_sequence"), F.lit(0)).cast("long").alias("capture_watermark"),
        F.min("sequence").alias("first_sequence"),
        F.max("sequence").alias("last_sequence"),
        F.min_by("previous_hash", "sequence").alias("start_root"),
        F.max_by("entry_hash", "sequence").alias("end_root"),
    )


def ranges(ticks: DataFrame, *scope: str) -> DataFrame:
    """Runs of consecutive selected ordinals of each entry and day."""
    entry = [*scope, "day", "sequence"]
    place = F.row_number().over(Window.partitionBy(*entry).orderBy("ordinal"))
    return ticks.withColumn("run", F.col("ordinal") - place).groupBy(*entry, "run").agg(F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal")).drop("run")


def expand(found: DataFrame) -> DataFrame:
    """The (sequence, ordinal) places of ranges, each once."""
    return found.select(*(c for c in found.columns if not c.endswith("_ordinal")), F.explode(F.sequence("first_ordinal", "last_ordinal")).alias("ordinal")).distinct()


def in_ranges(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Records of entries that lie in ranges (key, start, end, first_ordinal, last_ordinal): a range join made an equi-join on (key, sequence).

    The first and the last entry of a range are cut at its ordinals, entries between are whole.
    """
    spread = found.withColumn("sequence", F.explode(F.sequence("start", "end")))
    low = F.when(F.col("sequence") == F.col("start"), F.col("first_ordinal")).otherwise(0)
    high = F.when(F.col("sequence") == F.col("end"), F.col("last_ordinal")).otherwise(F.lit(2**31 - 1))
    spread = spread.select("key", "sequence", low.alias("low"), high.alias("high"))
    return entries.join(spread, ["key", "sequence"]).where(F.col("ordinal").between(F.col("low"), F.col("high"))).drop("low", "high").distinct()


def overlapping(found: DataFrame, start: int | Column, end: int | Column) -> DataFrame:
    """Segments that share a sequence with [start, end]; an end that is 0 bounds no slice, and none do."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    return found.where((start != 0) & (end != 0) & (F.col("last_sequence") >= start) & (F.col("first_sequence") <= end))


def in_slice(entries: DataFrame, start: int, end: int) -> DataFrame:
    """Entries with a sequence from start to end; a start of 0 means all."""
    return entries.where(F.col("sequence").between(start, end)) if start else entries


def affected_days(ticks: DataFrame, *by: str) -> DataFrame:
    """The days that each segment touches, in order."""
    return ticks.groupBy(*by).agg(F.array_sort(F.collect_set("day")).alias("days"))


def raw_set_root(found: DataFrame, *by: str) -> DataFrame:
    """The root over the ordered ranges of each group: count, then hash, bytes and ends of each."""
    item = F.concat("sha256", N.u64(F.col("bytes")), N.u64(F.col("start")), N.u64(F.col("end")), N.little(F.col("first_ordinal"), 4), N.little(F.col("last_ordinal"), 4))
    order = F.struct("start", "first_ordinal", item.alias("item"))
    grouped = found.groupBy(*by).agg(F.array_sort(F.collect_list(order)).alias("items"))
    joined = F.aggregate(F.transform("items", lambda x: x["item"]), N.raw(b""), lambda a, x: F.concat(a, x))
    return grouped.select(*by, N.hexed(N.sha(N.raw(D.RAW_SET), N.little(F.size("items"), 4), joined)).alias("raw_set_root"))


def bound_once(found: DataFrame, objects: DataFrame) -> DataFrame:
    """Each range with the number of chain objects of the same key, hash and size that hold it; other than 1 is an integrity error."""
    inside = (F.col("r.start") >= F.col("o.start")) & (F.col("r.end") <= F.col("o.end"))
    same = [F.col(f"r.{c}") == F.col(f"o.{c}") for c in ("key", "sha256", "bytes")]
    joined = found.alias("r").join(objects.withColumn("hit", F.lit(1)).alias("o"), same[0] & same[1] & same[2] & inside, "left")
    return joined.groupBy("r.id").agg(F.count("o.hit").alias("matches"))


def fail_unless(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df, whose rows raise where condition does not hold: verification never filters in silence."""
    return df.where(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def latest(revisions: DataFrame, *by: str) -> DataFrame:
    """The row of the highest revision of each group, without sorting groups."""
    rest = [c for c in revisions.columns if c not in by]
    return revisions.groupBy(*by).agg(F.max_by(F.struct(*rest), "revision").alias("x")).select(*by, "x.*")


def revision_breaks(revisions: DataFrame, *by: str) -> DataFrame:
    """Revisions with whether they break their chain: they start at 1 without a predecessor, have no gap, and name the digest before them."""
    order = Window.partitionBy(*by).orderBy("revision")
    first = F.row_number().over(order) == 1
    good = F.when(first, (F.col("revision") == 1) & F.col("previous").isNull()).otherwise((F.col("revision") == F.lag("revision").over(order) + 1) & F.col("previous").eqNullSafe(F.lag("digest").over(order)))
    return revisions.withColumn("breaks", ~F.coalesce(good, F.lit(False)))


def branches(revisions: DataFrame, *by: str) -> DataFrame:
    """Digests that more than one revision names as predecessor."""
    return revisions.where("previous IS NOT NULL").groupBy(*by, "previous").count().where("count > 1")


def watermark_regressions(revisions: DataFrame, *by: str) -> DataFrame:
    """Revisions whose watermarks fall or whose ranges do not begin with those of the revision before.

    The lists of ranges are arrays (ranges), or (runs) arrays of the longest runs of ranges that are numbered one after the
    other, each with its first and last number: a revision that names all before it is then one run, however long its list is.
    """
    held = "runs" if "runs" in revisions.columns else "ranges"
    order = Window.partitionBy(*by).orderBy("revision")
    before = {c: F.lag(c).over(order) for c in ("source_watermark", "capture_watermark", held)}
    falls = (F.col("source_watermark") < before["source_watermark"]) | (F.col("capture_watermark") < before["capture_watermark"])
    begins = _runs_begin if held == "runs" else lambda now, old: F.slice(now, F.lit(1), F.greatest(F.size(old), F.lit(1))) == old
    kept = F.coalesce(begins(F.col(held), before[held]), F.lit(True))
    return revisions.withColumn("regression", F.coalesce(falls, F.lit(False)) | ~(kept | (F.size(before[held]) == 0)))


def _runs_begin(now: Column, old: Column) -> Column:
    """Whether a list of runs begins with an old one: the last old run may go on, those before it are the same."""
    n = F.size(old)
    last, same = F.get(old, n - 1), F.get(now, n - 1)
    whole = F.greatest(n - 1, F.lit(0))
    return (F.size(now) >= n) & (F.slice(now, F.lit(1), whole) == F.slice(old, F.lit(1), whole)) & (same["first"] == last["first"]) & (same["last"] >= last["last"])


def changed(now: DataFrame, before: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows of now that are new or differ from before: only these become revisions."""
    old = before.select(*by, F.struct(*columns).alias("_old"))
    return now.join(old, by, "left").where(~F.struct(*columns).eqNullSafe(F.col("_old"))).drop("_old")


def next_revisions(now: DataFrame, revisions: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """New revisions of days whose selection changed, late data included: nothing of the past is altered."""
    last = latest(revisions, *by)
    fresh = changed(now, last, by, columns)
    return fresh.join(last.select(*by, F.col("revision").alias("_r"), F.col("digest").alias("previous")), by, "left").withColumn("revision", F.coalesce(F.col("_r"), F.lit(0)) + 1).drop("_r")


def replay_breaks(revisions: DataFrame, *by: str) -> DataFrame:
    """revision_breaks() of replay days (raw_digest, too): a successor must also bind another raw revision than the one before it."""
    order = Window.partitionBy(*by).orderBy("revision")
    again = F.coalesce(F.col("raw_digest") == F.lag("raw_digest").over(order), F.lit(False))
    return revision_breaks(revisions.withColumn("_again", again), *by).withColumn("breaks", F.col("breaks") | F.col("_again")).drop("_again")


def not_ascending(found: DataFrame, *by: str) -> DataFrame:
    """Ranges (start, first_ordinal, end, last_ordinal) that end before they start or do not lie after the one before them."""
    order = Window.partitionBy(*by).orderBy("start", "first_ordinal", "end", "last_ordinal")
    before = F.lag(F.struct("end", "last_ordinal")).over(order)
    first, last = F.struct(F.col("start").alias("end"), F.col("first_ordinal").alias("last_ordinal")), F.struct("end", "last_ordinal")
    return found.withColumn("_bad", (last < first) | F.coalesce(first <= before, F.lit(False))).where("_bad").drop("_bad")
