"""Recovery of a journal from the log: find where they part, and fold again only what follows.

Entries and journal rows of a scope are numbered from 1. Ranges of WIDTH numbers have a checksum, ranges of
ranges the checksum of theirs, up to one for the scope. Two such trees are compared from the top: of each scope
only the children of the first node that differs are looked at, so it takes as many small joins as there are levels and
one of the rows of one range. The journal is derived: where it parts from the log, the log is right. The state at that
place is what the last row before it says, and of the batches before it only the hashes that the tail asks for are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.streaming import gateway

#: Numbers of a range, and children of a node.
WIDTH = 256


def sums(rows: DataFrame, columns: list[str]) -> DataFrame:
    """scope, node, n and two exclusive-ors of hashes of each range of rows (scope, sequence and columns): the leaves of a tree."""
    values = [F.col(c) for c in ("sequence", *columns)]
    return rows.select("scope", F.floor(F.col("sequence") / WIDTH).cast("long").alias("node"), F.xxhash64(*values).alias("x"), F.xxhash64(F.lit(1), *values).alias("y")).groupBy("scope", "node").agg(F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))


def above(level: DataFrame) -> DataFrame:
    """The next level of a tree."""
    return level.groupBy("scope", F.floor(F.col("node") / WIDTH).cast("long").alias("node")).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))


def divergence(journal: DataFrame, log: DataFrame, columns: list[str], trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """scope and sequence of the first row that journal and log (scope, sequence, columns) do not both have, of scopes that differ; trees are the stored sums() of both."""
    left, right = trees or (sums(journal, columns), sums(log, columns))
    levels = [(left, right)]
    most = max((r[0] or 0) for r in (x.agg(F.max("node")).first() for x in levels[0]))
    while most > 0:
        levels.append(tuple(above(x) for x in levels[-1]))
        most //= WIDTH
    at = None
    for left, right in reversed(levels):
        pair = [x if at is None else x.withColumn("_up", F.floor(F.col("node") / WIDTH).cast("long")).join(at, (x["scope"] == at["_scope"]) & (F.col("_up") == at["_node"])).select("scope", "node", "n", "x", "y") for x in (left, right)]
        a, b = (x.select("scope", "node", F.struct("n", "x", "y").alias(s)) for x, s in zip(pair, ("a", "b"), strict=True))
        other = a.join(b, ["scope", "node"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        at = other.groupBy(F.col("scope").alias("_scope")).agg(F.min("node").alias("_node"))
    rows = []
    for x, s in ((journal, "a"), (log, "b")):
        inside = x.join(at, (x["scope"] == at["_scope"]) & (F.floor(x["sequence"] / WIDTH) == at["_node"]))
        rows.append(inside.select("scope", "sequence", F.struct(*columns).alias(s)))
    other = rows[0].join(rows[1], ["scope", "sequence"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return other.groupBy("scope").agg(F.min("sequence").alias("sequence"))


TAIL = "scope string, sequence long, now long, frame binary, session string, batch_sequence long"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        named = [C.decode_message(f.as_py())[1] for f in batch.column("frame")]
        columns = [*batch.columns, pa.array([m["producer_session_id"] for m in named]), pa.array([m["batch_sequence"] for m in named], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in TAIL.split(", ")])


def recovered(entries: DataFrame, journal: DataFrame, **start: int) -> tuple[DataFrame, DataFrame]:
    """The journal as the log gives it, and of it the rows that were folded again.

    entries are the log's (scope, sequence, receive_wall_s, frame, entry_hash as hexadecimal text), journal has the ACKS of what was
    accepted with hash, the batch's, and now. Rows before the first difference stay; the scope's state there is what its last row
    says, with the lease of that row's session.
    """
    own = entries.select("scope", F.col("sequence").cast("long").alias("sequence"), F.col("receive_wall_s").alias("now"), "frame", "entry_hash")
    first = divergence(journal.select("scope", "sequence", "entry_hash"), own.select("scope", "sequence", "entry_hash"), ["entry_hash"]).select("scope", F.col("sequence").alias("_first"))
    kept = journal.join(first, "scope", "left").where(F.col("_first").isNull() | (F.col("sequence") < F.col("_first"))).drop("_first")
    tail = own.join(first, "scope").where(F.col("sequence") >= F.col("_first")).select("scope", "sequence", "now", "frame").mapInArrow(_keys, TAIL)
    known = kept.select("scope", "session", "batch_sequence", F.col("hash").alias("known"))
    tail = tail.join(known, ["scope", "session", "batch_sequence"], "left")
    last = kept.join(first.select("scope"), "scope", "left_semi").groupBy("scope").agg(F.max_by(F.struct("sequence", "cursor", "digest", "next_count", "entry_hash", "session", "now"), "sequence").alias("state"))

    def fold(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, names = None, [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None:
                    old = row["state"]
                    state = gateway.State(**start)
                    if old:
                        state.cursor, state.digest, state.count, state.sequence, state.entry_hash = (old[c] for c in ("cursor", "digest", "next_count", "sequence", "entry_hash"))
                        state.session, state.lease_until = old["session"], old["now"] + state.lease_s
                if row["known"]:
                    state.accepted[f"{row['session']}/{row['batch_sequence']}"] = row["known"]
                ack = state.accept(row["frame"], row["now"])
                out.append({"scope": key[0].as_py(), "arrival": row["sequence"], "hash": C.batch_hash(row["frame"]).hex(), "now": row["now"], **ack})
            columns = {n: [r[n] for r in out] for n in names}
            kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[x.split()[1]]) for n, x in zip(names, schema.split(", "), strict=True)], names=names)

    schema = f"{gateway.ACKS}, hash string, now long"
    rows = tail.join(last, "scope", "left").repartition("scope").sortWithinPartitions("scope", "sequence")
    again = rows.groupBy("scope").applyInArrow(fold, schema)
    return kept.select(*again.columns).unionByName(again), again


def derived(entries: DataFrame, **start: int) -> DataFrame:
    """The whole journal that a log gives, with hash and now."""
    nothing = entries.sparkSession.createDataFrame([], f"{gateway.ACKS}, hash string, now long")
    return recovered(entries, nothing, **start)[1]
