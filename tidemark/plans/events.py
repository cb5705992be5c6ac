"""The events table as ticks, log entries, batch frames and segments: the input of the driver's queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import chains
from tidemark.sources import wal

#: Records of a batch and of a segment; one batch in ERRORS reports an error.
BATCH, SEGMENT, ERRORS, ERROR = 64, 16, 97, 4401
#: Polls of POLL records that move on by STEP.
POLL, STEP = 64, 48
#: Rows that a worker holds as Python values at once.
ROWS = 1024
IDENTITY = {"producer_instance_id": "producer", "provider_id": "provider", "stable_feed_id": "feed", "broker_server_fingerprint": "broker", "exact_source_symbol": "symbol"}
SCOPE: dict[str, Any] = {"day_definition_id": "utc-day-v1", "replay_contract_id": "replay-v1", "conversion_id": "conversion-v1", "raw_day_manifest_key": "manifests/raw-day", "raw_day_manifest_sha256": bytes(range(32))}


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an event: time_msc, time, day, bid, volume, symbol, capture_sequence, sequence, ordinal, error and the entry's hashes."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    rows = chains.ranked(events, "event_id", "capture_sequence")
    msc = F.unix_millis(F.col("ts").cast("timestamp_ntz").cast("timestamp")) if dict(events.dtypes)["ts"] == "timestamp" else F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")) / 1000).cast("long")
    sequence = F.floor((F.col("capture_sequence") - 1) / BATCH).cast("long") + 1
    rows = rows.select("event_id", msc.alias("time_msc"), F.round(F.col("value") * 100).cast("long").alias("bid"), F.col("user_id").alias("volume"), F.col("event_type").alias("symbol"), "capture_sequence", sequence.alias("sequence"))
    return rows.select(
        "*", F.floor(F.col("time_msc") / 1000).cast("long").alias("time"), N.utc_day(F.col("time_msc")).alias("day"), ((F.col("capture_sequence") - 1) % BATCH).alias("ordinal"),
        F.when(F.col("sequence") % ERRORS == 0, ERROR).otherwise(0).alias("error"), entry(F.col("sequence")).alias("entry_hash"), entry(F.col("sequence") - 1).alias("previous_hash"),
        F.floor((F.col("sequence") - 1) / SEGMENT).cast("long").alias("segment"),
    )


def place(spark: SparkSession, name: str) -> str:
    """A path that nothing uses yet, in the folder that executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:  # in one process a temporary folder will do
        alone = spark.sparkContext.master.split("[")[0] == "local"
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-") if alone else spark.conf.get("spark.sql.warehouse.dir") + "/tidemark-tables"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """df as a table of files, as an archive has it, in folders by the columns of by: what reads it several times does not make it again."""
    path = place(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def entry(sequence):
    return F.sha2(F.concat(F.lit("entry-"), sequence.cast("string")), 256)


def tick_columns() -> dict:
    bid = F.col("bid")
    return {"time": F.col("time"), "bid_bits": bid, "ask_bits": bid, "last_bits": bid, "volume": F.col("volume"), "time_msc": F.col("time_msc"), "flags": F.lit(3), "volume_real_bits": bid}


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir)
    return rows.withColumn("record", N.record_bytes(tick_columns())).withColumn("fingerprint", N.fingerprint(F.col("record")))


FRAMES = "scope string, day string, sequence long, arrival long, now long, frame binary, raw_object_key string, raw_object_sha256 binary, ordinals array<long>"
ARROW = pa.schema([("scope", pa.string()), ("day", pa.string()), ("sequence", pa.int64()), ("arrival", pa.int64()), ("now", pa.int64()), ("frame", pa.binary()), ("raw_object_key", pa.string()), ("raw_object_sha256", pa.binary()), ("ordinals", pa.list_(pa.int64()))])


def polled(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frames of a symbol and day, whose ticks are read in order as a stream, of any length."""
    symbol, day = (k.as_py() for k in key)
    lease = C.lease_id(IDENTITY["producer_instance_id"], f"session-{symbol}", *(IDENTITY[k] for k in ("provider_id", "stable_feed_id", "broker_server_fingerprint", "exact_source_symbol")))
    own = C.sha(f"{symbol}/{day}".encode())
    k, number, open_ = 0, 0, []

    def frame() -> dict[str, Any]:
        nonlocal k, number, open_
        number += 2 if k and k % 13 == 0 else 1
        some = [{n: r["bid"] for n in ("bid_bits", "ask_bits", "last_bits", "volume_real_bits")} | {n: r[n] for n in ("time", "volume", "time_msc", "capture_sequence")} | {"flags": 3} for r in open_[:POLL]]
        if k and k % 7 == 0 and len(some) > 4:
            some[4] = some[4] | {"volume": some[4]["volume"] + 1}
        message = {
            "session_lease_id": lease, "producer_session_id": f"session-{symbol}", "batch_sequence": number, "requested_from_msc": some[0]["time_msc"], "requested_count": POLL, "fetch_wall_start_s": some[0]["time"],
            "fetch_wall_end_s": some[-1]["time"], "fetch_monotonic_start_us": k, "fetch_monotonic_end_us": k + 1, "returned_count": len(some), "copy_ticks_error": ERROR if k and k % 11 == 0 else 0, "source_status_flags": 0,
            "source_schema_id": D.SCHEMA_ID, "records": some,
        }
        k, open_ = k + 1, open_[STEP:]
        return {"scope": symbol, "day": day, "sequence": k, "arrival": some[0]["capture_sequence"], "now": some[0]["time"], "frame": C.encode_message("BATCH", message), "raw_object_key": f"objects/raw/wal-{own.hex()}.rtw", "raw_object_sha256": own, "ordinals": list(range(len(some)))}

    for batch in (some.slice(j, ROWS) for some in batches for j in range(0, some.num_rows, ROWS)):
        out, open_ = [], open_ + batch.to_pylist()
        while len(open_) >= POLL:
            out.append(frame())
        yield pa.RecordBatch.from_pylist(out, schema=ARROW)
    if not k or len(open_) > POLL - STEP:  # the last poll is a short one, unless the one before it has all of it
        yield pa.RecordBatch.from_pylist([frame()], schema=ARROW)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch frames of each symbol and day: overlapping polls, every eleventh an error, every thirteenth number skipped, every seventh with one altered record."""
    rows = ticks(spark, sf_dir).select("symbol", "day", "time", "time_msc", "bid", "volume", "capture_sequence")
    return rows.repartition("symbol", "day").sortWithinPartitions("symbol", "day", "capture_sequence").groupBy("symbol", "day").applyInArrow(polled, FRAMES)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path and content of one sealed segment a symbol and day."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scope, day = (k.as_py() for k in key)
        writer = wal.Writer(scope)
        for batch in (some.slice(j, ROWS) for some in batches for j in range(0, some.num_rows, ROWS)):
            for frame, now, sequence in zip(*(batch.column(c).to_pylist() for c in ("frame", "now", "sequence")), strict=True):
                writer.append(frame, now, sequence)
        yield pa.RecordBatch.from_arrays([pa.array([f"{scope}/{day}.rtw"]), pa.array([writer.seal()], pa.binary())], names=["path", "content"])

    rows = frames(spark, sf_dir).select("scope", "day", "sequence", "now", "frame")
    return rows.repartition("scope", "day").sortWithinPartitions("scope", "day", "sequence").groupBy("scope", "day").applyInArrow(run, "path string, content binary")
