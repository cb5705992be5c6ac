"""Hash chains, linkage, set comparison and the ordered checks that the format makes of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N


def _of_group(rows: DataFrame, other: DataFrame, by: tuple[str, ...], at: str) -> DataFrame:
    """rows with the columns of other that have the same at and group, null groups included."""
    named = other.select(F.col(at).alias("_at"), *(F.col(c).alias(f"_by_{c}") for c in by), *(c for c in other.columns if c not in (at, *by)))
    same = F.col(at) == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return rows.join(named, same).drop("_at", *(f"_by_{c}" for c in by))


def ranked(df: DataFrame, key: str, out: str, width: int = 1 << 16, by: tuple[str, ...] = ()) -> DataFrame:
    """df with the rank from 1 of its integer key over all rows, or over those of its group by, without sorting them in one task.

    Keys are cut into ranges of a fixed width, and those into ranges of ranges. Rows are ranked within
    their range, after the rows in the ranges before, which are running sums over one small row a range and
    over one a range of ranges.
    """
    cut, group = F.floor(F.col(key) / width).cast("long"), F.floor(F.col("_cut") / width).cast("long")
    sizes = df.groupBy(*by, cut.alias("_cut")).agg(F.count("*").alias("_n")).withColumn("_group", group)
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = sizes.groupBy(*by, "_group").agg(F.sum("_n").alias("_n")).select(*by, "_group", earlier(Window.partitionBy(*by).orderBy("_group")).alias("_start"))
    offsets = sizes.withColumn("_before", earlier(Window.partitionBy(*by, "_group").orderBy("_cut")))
    offsets = _of_group(offsets, groups, by, "_group").select(*by, "_cut", (F.col("_before") + F.col("_start")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_cut").orderBy(key))
    return _of_group(df.withColumn("_cut", cut), offsets, by, "_cut").withColumn(out, (F.col("_before") + inside).cast("long")).drop("_cut", "_before")


def row_chain_root(rows: DataFrame, by: list[str], sequence: str, data: str) -> DataFrame:
    """rows and root of each group's rows. A group is one chain, whose steps depend on each other; it is read in order as a stream, of any length, and parallelism comes from groups."""
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("rows", T.LongType()), T.StructField("root", T.StringType())])

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, count = D.ZERO, 0
        for batch in batches:
            for s, d in zip(batch.column("_s").to_pylist(), batch.column("_d").to_pylist(), strict=True):
                root = C.chain_step(s, root, d)
            count += batch.num_rows
        yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()], k.type) for k in key), pa.array([count], pa.int64()), pa.array([root.hex()])], names=[*by, "rows", "root"])

    some = rows.select(*by, F.col(sequence).cast("long").alias("_s"), F.col(data).alias("_d"))
    return some.repartition(*by).sortWithinPartitions(*by, "_s").groupBy(*by).applyInArrow(run, schema)


def unlinked(df: DataFrame, by: list[str], order: str, previous: str, own: str) -> DataFrame:
    """df with breaks: whether a row does not follow the one before it in its group, by number and by hash."""
    w = Window.partitionBy(*by).orderBy(order)
    good = F.lag(order).over(w).isNull() | ((F.col(order) == F.lag(order).over(w) + 1) & F.col(previous).eqNullSafe(F.lag(own).over(w)))
    return df.withColumn("breaks", ~F.coalesce(good, F.lit(False)))


#: Numbers of a range in which a long chain is read.
RANGE = 1 << 16


def linked_in_ranges(df: DataFrame, by: list[str], order: str, previous: str, own: str) -> DataFrame:
    """df with place, the row's number in its group, and faults, how many rows up to it do not follow the one before them by number and hash.

    A group's rows are read in ranges of RANGE numbers. What a range begins with meets the end of the one before it, and its counts
    are added up, over one small row a range, so no group has to lie in one task.
    """
    inside, over = Window.partitionBy(*by, "_cut").orderBy(order), Window.partitionBy(*by).orderBy("_cut")
    rows = df.withColumn("_cut", F.floor(F.col(order) / RANGE).cast("long"))
    before, root = F.lag(order).over(inside), F.lag(own).over(inside)
    good = before.isNull() | ((F.col(order) == before + 1) & F.col(previous).eqNullSafe(root))
    rows = rows.withColumns({"_in": (~F.coalesce(good, F.lit(False))).cast("long"), "_no": F.row_number().over(inside)})
    ends = rows.groupBy(*by, "_cut").agg(
        F.count("*").alias("_n"), F.sum("_in").alias("_f"), F.min_by(F.struct(F.col(order).alias("at"), F.col(previous).alias("h")), order).alias("_first"), F.max_by(F.struct(F.col(order).alias("at"), F.col(own).alias("h")), order).alias("_last")
    )
    last = F.lag("_last").over(over)
    follows = last.isNull() | ((F.col("_first.at") == last["at"] + 1) & F.col("_first.h").eqNullSafe(last["h"]))
    ends = ends.withColumn("_open", (~F.coalesce(follows, F.lit(False))).cast("long"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*by, "_cut", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_places"), (F.coalesce(F.sum(F.col("_f") + F.col("_open")).over(earlier), F.lit(0)) + F.col("_open")).alias("_faults"))
    done = rows.join(ends, [*by, "_cut"])
    so_far = F.sum("_in").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return done.withColumns({"place": (F.col("_places") + F.col("_no")).cast("long"), "faults": F.col("_faults") + so_far}).drop("_cut", "_in", "_no", "_places", "_faults")


def shared_budget(charges: DataFrame, order: str, limits: dict[str, int]) -> DataFrame:
    """charges with stopped_by, the category whose limit an earlier charge or this one passes first, or null while all are within their limits.

    order numbers the charges of all candidates; limits name columns of amounts, one a category. The first charge that passes any
    limit (of several at once the first name) stops it and all that follow. Sums are made of ranges of RANGE numbers, so no task has all charges.
    """
    names = sorted(limits)
    rows = charges.withColumn("_cut", F.floor(F.col(order) / RANGE).cast("long"))
    group = F.floor(F.col("_cut") / RANGE).cast("long")
    sums = rows.groupBy("_cut").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names)).withColumn("_group", group)
    earlier = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("decimal(38,0)"))
    groups = sums.groupBy("_group").agg(*(F.sum(c).alias(c) for c in names))
    groups = groups.select("_group", *(earlier(Window.orderBy("_group"), c).alias(f"_g_{c}") for c in names))  # one row a range of ranges
    starts = sums.select("_cut", "_group", *(earlier(Window.partitionBy("_group").orderBy("_cut"), c).alias(f"_s_{c}") for c in names)).join(groups, "_group")
    starts = starts.select("_cut", *((F.col(f"_s_{c}") + F.col(f"_g_{c}")).alias(f"_s_{c}") for c in names))
    inside = Window.partitionBy("_cut").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(starts, "_cut")
    passed = F.coalesce(*(F.when(F.sum(F.col(c).cast("decimal(38,0)")).over(inside) + F.col(f"_s_{c}") > limits[c], c) for c in names))
    rows = rows.withColumn("_passed", passed)
    first = rows.where("_passed IS NOT NULL").agg(F.min(F.struct(F.col(order).alias("at"), F.col("_passed").alias("by"))).alias("stop"))
    stop = rows.withColumn("_stop", first.scalar())
    return stop.select(*charges.columns, F.when(F.col(order) >= F.col("_stop.at"), F.col("_stop.by")).alias("stopped_by"))


def part_graph(parts: DataFrame, by: list[str]) -> DataFrame:
    """Parts with breaks: part 0 starts at row 0 from the zero hash, each other where the one before it ends."""
    w = Window.partitionBy(*by).orderBy("part_sequence")
    before = {c: F.lag(c).over(w) for c in ("part_sequence", "last_stream_sequence", "last_row_chain_hash")}
    first = before["part_sequence"].isNull()
    start = (F.col("part_sequence") == 0) & (F.col("first_stream_sequence") == 0) & (F.col("previous_row_chain_hash") == D.ZERO.hex())
    follows = (F.col("part_sequence") == before["part_sequence"] + 1) & (F.col("first_stream_sequence") == before["last_stream_sequence"] + 1) & (F.col("previous_row_chain_hash") == before["last_row_chain_hash"])
    return parts.withColumn("breaks", ~F.coalesce(F.when(first, start).otherwise(follows), F.lit(False)))


def part_set_root(parts: DataFrame, by: list[str]) -> DataFrame:
    """The root over each group's ordered part manifests (key, digest, first and last row)."""
    item = F.concat(N.little(F.octet_length("key"), 4), F.encode("key", "UTF-8"), F.unhex("digest"), N.u64(F.col("first_stream_sequence")), N.u64(F.col("last_stream_sequence")))
    grouped = parts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("part_sequence", item.alias("item")))).alias("items"))
    joined = F.aggregate(F.transform("items", lambda x: x["item"]), N.raw(b""), lambda a, x: F.concat(a, x))
    return grouped.select(*by, N.hexed(N.sha(N.raw(D.PART_SET), N.little(F.size("items"), 4), joined)).alias("part_set_root"))


def part_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """Count, bytes, first and last row, and chain anchors of each part."""
    return rows.groupBy(*by, "part_sequence").agg(
        F.count("*").alias("row_count"),
        F.sum("canonical_bytes").alias("canonical_row_bytes"),
        F.min("stream_sequence").alias("first_stream_sequence"),
        F.max("stream_sequence").alias("last_stream_sequence"),
        F.min_by("previous_row_chain_hash", "stream_sequence").alias("previous_row_chain_hash"),
        F.min_by("row_chain_hash", "stream_sequence").alias("first_row_chain_hash"),
        F.max_by("row_chain_hash", "stream_sequence").alias("last_row_chain_hash"),
    )


def batch_gaps(batches: DataFrame) -> DataFrame:
    """Batches that do not follow the one before them in their session by one."""
    w = Window.partitionBy("session").orderBy("sequence")
    return batches.withColumn("expected", F.lag("batch_sequence").over(w) + 1).where(F.col("expected").isNotNull() & (F.col("batch_sequence") != F.col("expected")))


def regressions(batches: DataFrame, *by: str) -> DataFrame:
    """Batches whose first time is before the last of the batch before them."""
    w = Window.partitionBy(*by).orderBy("sequence")
    return batches.withColumn("previous_last", F.lag("last_msc").over(w)).where(F.col("first_msc") < F.col("previous_last"))


def prefix_holds(candidates: DataFrame, expected: str, by: list[str]) -> DataFrame:
    """Ordered candidates with prefix: whether they and all before them are eligible and contiguous from the expected start."""
    w = Window.partitionBy(*by).orderBy("first_sequence")
    starts = F.coalesce(F.lag("last_sequence").over(w) + 1, F.col(expected))
    marked = candidates.withColumn("gap", F.col("first_sequence") != starts).withColumn("sound", F.col("eligible") & ~F.col("gap"))
    until = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return marked.withColumn("prefix", F.min("sound").over(until)).withColumn("before", F.coalesce(F.min("sound").over(earlier), F.lit(True)))


def first_exceed(charges: DataFrame, by: list[str], order: str, amount: str, limit: int | Column) -> DataFrame:
    """Charges with their running total, and exceeds at the first that passes the limit; refused charges still count."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.col(amount).cast("decimal(38,0)")).over(w)
    out = charges.withColumn("total", total.cast("long"))
    return out.withColumn("exceeds", (F.col("total") > limit) & (F.col("total") - F.col(amount) <= limit))


def set_difference(expected: DataFrame, observed: DataFrame, by: list[str]) -> DataFrame:
    """Keys that only one side has, or that the observed side has more than once: missing, orphan or duplicate."""
    e = expected.select(*by).distinct().withColumn("_e", F.lit(True))
    o = observed.groupBy(*by).agg(F.count("*").alias("_o"))
    kind = F.when(F.col("_e").isNull(), "orphan").when(F.col("_o").isNull(), "missing").when(F.col("_o") > 1, "duplicate")
    return e.join(o, by, "full_outer").withColumn("kind", kind).where("kind IS NOT NULL").select(*by, "kind")


def reconciled(journal: DataFrame, log: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Keys whose rows in the journal and in the log differ; a journal row without a log entry, or the other way round, differs."""
    j, w = (x.select(*by, F.struct(*columns).alias(n)) for x, n in ((journal, "_j"), (log, "_w")))
    return j.join(w, by, "full_outer").where(~F.col("_j").eqNullSafe(F.col("_w"))).select(*by, F.when(F.col("_w").isNull(), "journal_only").when(F.col("_j").isNull(), "log_only").otherwise("differs").alias("difference"))


def duplicate_or_conflict(arrivals: DataFrame) -> DataFrame:
    """Arrivals (session, batch_sequence, hash, arrival) with their status: the first is accepted, equal ones are duplicates, others conflicts."""
    first = arrivals.groupBy("session", "batch_sequence").agg(F.min(F.struct("arrival", "hash")).alias("first"))
    status = F.when(F.col("arrival") == F.col("first.arrival"), "ACCEPTED").when(F.col("hash") == F.col("first.hash"), "DUPLICATE").otherwise("SOURCE_STATE_CONFLICT")
    return arrivals.join(first, ["session", "batch_sequence"]).withColumn("status", status).drop("first")


def supplied(descriptors: DataFrame, objects: DataFrame) -> DataFrame:
    """descriptors (key, sha256, bytes) with state: exact, different (hash or size), absent, or twice if objects has the key several times."""
    seen = objects.groupBy("key").agg(F.count("*").alias("_n"), F.min("sha256").alias("_sha"), F.min("bytes").alias("_bytes"))
    same = (F.col("_sha") == F.col("sha256")) & (F.col("_bytes") == F.col("bytes"))
    state = F.when(F.col("_n").isNull(), "absent").when(F.col("_n") > 1, "twice").when(same, "exact").otherwise("different")
    return descriptors.join(seen, "key", "left").withColumn("state", state).drop("_n", "_sha", "_bytes")


def looked_up(asked: DataFrame, journal: DataFrame, log: DataFrame) -> DataFrame:
    """asked (session, batch_sequence) with the hash that the journal has, else the log, and which of them had it."""
    by = ["session", "batch_sequence"]
    j, w = (x.select(*by, F.col("hash").alias(n)).dropDuplicates(by) for x, n in ((journal, "_j"), (log, "_w")))
    rows = asked.join(j, by, "left").join(w, by, "left")
    return rows.select(*asked.columns, F.coalesce("_j", "_w").alias("hash"), F.when(F.col("_j").isNotNull(), "journal").when(F.col("_w").isNotNull(), "log").alias("found_in"))


def total_rows(parts: DataFrame, *by: str) -> DataFrame:
    """The rows of all parts; a sum that is no unsigned 64-bit number raises."""
    total = F.sum(F.col("row_count").cast("decimal(38,0)"))
    fits = F.when(F.col("total") < F.lit(str(2**64)).cast("decimal(38,0)"), F.col("total").cast("decimal(20,0)")).otherwise(F.raise_error(F.lit("row count overflows")).cast("decimal(20,0)"))
    return parts.groupBy(*by).agg(total.alias("total")).select(*by, fits.alias("row_count"))
