"""Raw days from new segments only: each day has a small state that merges with what a micro-batch adds.

Counts add up, watermarks take the larger value, the ends of a day's slice are its first and last entry,
and runs of records, which never cross an entry, are added. So a tick reads the records of its own
segments and the states of the days these touch, never an older segment, and days that nothing touched are not
read at all. A commit of all tables makes a tick's work visible, once for each number. A scope's segments
must continue its chain: one that does not follow the last one known fails the tick.

From the tables, the rows that ``archive.raw_days`` makes of all segments are put together for the days that are
wanted: a segment has a number in its scope, so a day's chain objects are an equi-join on numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import selection
from tidemark.sources.commits import Commits

#: Where a state's first and last entry stand; no is the number of the segment in its scope.
FIRST, LAST = "struct<sequence:long,root:string,no:long>", "struct<sequence:long,root:string,no:long>"
STATES = f"day string, accepted long, errors long, source_watermark long, capture_watermark long, first {FIRST}, last {LAST}, tick long"
RUNS = "day string, start_ingest_sequence long, first_record_ordinal long, bytes long, end_ingest_sequence long, key string, last_record_ordinal long, sha256 string"
SEGMENTS = "object_key string, object_sha256 string, file_bytes long, start_sequence long, last_sequence long, no long"
TAILS = "last_sequence long, chain_root string, no long"


@dataclass
class DayTables:
    """States of days, runs of records and segments of the scopes, in the tables of a folder."""

    spark: SparkSession
    folder: str
    scopes: tuple[str, ...] = ("scope",)
    log: Commits = field(init=False)

    def __post_init__(self) -> None:
        self.log = Commits(self.spark, self.folder)

    def _schema(self, columns: str) -> str:
        return ", ".join([*(f"{s} string" for s in self.scopes), columns])

    def _numbered(self, segments: DataFrame) -> DataFrame:
        """New segments with their numbers; one that does not continue its scope's chain raises."""
        order = Window.partitionBy(*self.scopes).orderBy("start_sequence")
        tails = self.log.table("tails", self._schema(TAILS)).select(*self.scopes, F.col("last_sequence").alias("_end"), F.col("chain_root").alias("_root"), F.col("no").alias("_no"))
        rows = segments.withColumn("_place", F.row_number().over(order)).join(tails, list(self.scopes), "left")
        end, root = (F.coalesce(F.lag(c).over(order), F.col(t)) for c, t in (("last_sequence", "_end"), ("chain_root", "_root")))
        follows = (F.col("start_sequence") == end + 1) & (F.col("chain_start") == root)
        rows = rows.withColumn("no", (F.coalesce("_no", F.lit(0)) + F.col("_place")).cast("long")).withColumn("_follows", end.isNull() | follows)
        return selection.fail_unless(rows, F.col("_follows"), "a segment does not continue its scope's chain").drop("_place", "_end", "_root", "_no", "_follows")

    def fold(self, number: int, found: DataFrame, segments: DataFrame, writer: str = "ticks") -> bool:
        """Take in the records of new segments and the segments, as archive.raw_days() takes them; whether this tick is new."""
        by = [*self.scopes, "day"]
        if self.log.known().tokens.get(writer, -1) >= number:
            return False
        known = self._numbered(segments)
        rows = found.join(known.select(*self.scopes, "object_key", "no"), [*self.scopes, "object_key"])
        end = lambda root: F.struct("sequence", F.col(root).alias("root"), "no")
        fresh = rows.withColumns({"first": end("previous_hash"), "last": end("entry_hash")})
        real = F.col("time_msc").isNotNull()
        fresh = fresh.groupBy(*by).agg(
            F.count(F.when(real, 1)).alias("accepted"), F.count_distinct(F.when(F.col("error") != 0, F.col("sequence"))).alias("errors"), F.coalesce(F.max("time_msc"), F.lit(0)).cast("long").alias("source_watermark"),
            F.coalesce(F.max("capture_sequence"), F.lit(0)).cast("long").alias("capture_watermark"), F.min("first").alias("first"), F.max("last").alias("last"),
        )
        low, high = found.agg(F.min("day"), F.max("day")).first()
        if low is not None:
            touched = self.states(low, high).drop("tick").join(found.select(*by).distinct(), by, "left_semi")
            fresh = fresh.unionByName(touched)
        merged = fresh.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("accepted", "errors")), *(F.max(c).alias(c) for c in ("source_watermark", "capture_watermark")), F.min("first").alias("first"), F.max("last").alias("last"))
        runs = selection.ranges(found, *self.scopes, "object_key").join(segments.select(*self.scopes, "object_key", "object_sha256", "file_bytes"), [*self.scopes, "object_key"])
        runs = runs.select(
            *by, F.col("sequence").alias("start_ingest_sequence"), F.col("first_ordinal").cast("long").alias("first_record_ordinal"), F.col("file_bytes").alias("bytes"), F.col("sequence").alias("end_ingest_sequence"),
            F.col("object_key").alias("key"), F.col("last_ordinal").cast("long").alias("last_record_ordinal"), F.col("object_sha256").alias("sha256"),
        )
        last = known.groupBy(*self.scopes).agg(F.max_by(F.struct("last_sequence", "chain_root", "no"), "start_sequence").alias("t")).select(*self.scopes, "t.*")
        old = self.log.table("tails", self._schema(TAILS)).join(last.select(*self.scopes), list(self.scopes), "left_anti")
        tables = {
            "states": merged.withColumn("tick", F.lit(number).cast("long")).sortWithinPartitions("day"),
            "runs": runs.sortWithinPartitions("day"),
            "segments": known.select(*self.scopes, *(x.split()[0] for x in SEGMENTS.split(", "))).sortWithinPartitions("no"),
            "tails": last.unionByName(old).coalesce(1),
        }
        return self.log.commit(tables, (writer, number), replaced=["tails"], bounds={"states": "day", "runs": "day", "segments": "no"}) is not None

    def states(self, low: str | None = None, high: str | None = None) -> DataFrame:
        """The newest state of each scope's days from low to high; what has no such day is not opened."""
        rows = self.log.table("states", self._schema(STATES), low, high)
        if low is not None:
            rows = rows.where(F.col("day").between(low, high))
        return selection_of_newest(rows, [*self.scopes, "day"])

    def days(self, since: int | None = None, low: str | None = None, high: str | None = None) -> DataFrame:
        """Rows like those of archive.raw_days(), of all days from low to high or of those that ticks from since on touched."""
        by = [*self.scopes, "day"]
        states = self.states(low, high)
        if since is not None:
            states = states.where(F.col("tick") >= since)
        from_, to = states.agg(F.min("day"), F.max("day")).first() if since is not None else (low, high)
        least, most = states.agg(F.min("first.no"), F.max("last.no")).first()
        runs = self.log.table("runs", self._schema(RUNS), from_, to)
        item = F.struct(*(x.split()[0] for x in RUNS.split(", ")[1:]))
        objects = runs.join(states.select(*by), by, "left_semi").groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("objects"))
        part = F.struct(F.col("start_sequence").alias("start_ingest_sequence"), F.col("last_sequence").alias("end_ingest_sequence"), F.col("file_bytes").alias("bytes"), F.col("object_key").alias("key"), F.col("object_sha256").alias("sha256"))
        held = states.select(*by, F.explode(F.sequence("first.no", "last.no")).alias("no")).join(self.log.table("segments", self._schema(SEGMENTS), least, most), [*self.scopes, "no"])
        chain = held.groupBy(*by).agg(F.array_sort(F.collect_list(part)).alias("chain_objects"))
        flat = objects.select(*by, F.explode("objects").alias("o")).select(
            *by, F.unhex("o.sha256").alias("sha256"), F.col("o.bytes").alias("bytes"), F.col("o.start_ingest_sequence").alias("start"), F.col("o.end_ingest_sequence").alias("end"), F.col("o.first_record_ordinal").alias("first_ordinal"), F.col("o.last_record_ordinal").alias("last_ordinal")
        )
        ends = states.select(
            *by, "accepted", "errors", "source_watermark", "capture_watermark", F.col("first.sequence").alias("first_sequence"), F.col("last.sequence").alias("last_sequence"), F.col("first.root").alias("start_root"), F.col("last.root").alias("end_root")
        )
        return ends.join(objects, by).join(chain, by).join(selection.raw_set_root(flat, *by), by)


def selection_of_newest(states: DataFrame, by: list[str]) -> DataFrame:
    """The state of the last tick of each day."""
    rest = [c for c in states.columns if c not in by]
    return states.groupBy(*by).agg(F.max_by(F.struct(*rest), "tick").alias("x")).select(*by, "x.*")


def fold_stream(tables: DayTables, found: DataFrame, segments_of) -> None:
    """Fold a stream of records, micro-batch by micro-batch; segments_of makes the segments of a batch of records, which must hold all of a segment's. Runs until the stream has no more."""

    def tick(batch: DataFrame, number: int) -> None:
        tables.fold(number, batch, segments_of(batch))

    found.writeStream.foreachBatch(tick).option("checkpointLocation", f"{tables.folder}/stream").trigger(availableNow=True).start().awaitTermination()
