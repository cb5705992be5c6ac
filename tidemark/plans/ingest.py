"""The driver's queries on taking frames in: sessions and their leases, the journal and its recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import chains, recovery
from tidemark.plans import events as E
from tidemark.plans.catalogue import query
from tidemark.streaming import leases

#: Seconds between two events, connections of a scope.
PACE, CONNECTIONS = 3, 3


def session_events(spark, sf) -> DataFrame:
    """What the connections of each symbol do: every event is a frame, now and then a HELLO or a CLOSE."""
    n = F.col("capture_sequence")
    kind = F.when(F.floor(n / 7) % 4 == 0, "HELLO").when(n % 11 == 5, "CLOSE").otherwise("FRAME")
    own = (F.col("volume") % CONNECTIONS).cast("string")
    return E.ticks(spark, sf).select(F.col("symbol").alias("scope"), (n * PACE).alias("at"), n.alias("n"), F.concat(F.lit("c"), own).alias("connection"), F.concat(F.lit("s"), own).alias("session"), kind.alias("kind"))


@query
def lease_outcomes(spark, sf):
    return leases.lease_outcomes(session_events(spark, sf)).select("scope", "at", "connection", "session", "generation", "outcome")


def logged(spark, sf) -> DataFrame:
    """The log's entries of each symbol, numbered from 1, with a hash of what they hold."""
    rows = chains.ranked(E.ticks(spark, sf), "event_id", "n", by=("symbol",))
    rows = rows.select(F.col("symbol").alias("scope"), "capture_sequence", (F.floor((F.col("n") - 1) / E.BATCH) + 1).cast("long").alias("sequence"))
    rows = rows.groupBy("scope", "sequence").agg(F.count("*").alias("n"), F.max("capture_sequence").alias("last"))
    return rows.select("scope", "sequence", F.sha2(F.concat_ws("/", "scope", F.col("sequence").cast("string"), F.col("n").cast("string"), F.col("last").cast("string")), 256).alias("entry_hash"))


@query
def journal_divergence(spark, sf):
    """Where journals part from the log: by the length of a symbol's name nowhere, at an altered row in the middle, or where the last quarter is lost."""
    log = E.stored(logged(spark, sf), "log")
    most = log.groupBy("scope").agg(F.max("sequence").alias("most"))
    fault = F.octet_length("scope") % 3
    journal = log.join(most, "scope").withColumn("entry_hash", F.when((fault == 1) & (F.col("sequence") == F.floor(F.col("most") / 2) + 1), F.lit("f" * 64)).otherwise(F.col("entry_hash")))
    journal = E.stored(journal.where((fault != 2) | (F.col("sequence") * 4 <= F.col("most") * 3)).drop("most"), "journal")
    return recovery.divergence(journal, log, ["entry_hash"])
