"""Leases that end by time, in a fold and in a stream with a clock turned by hand; recovery of a journal from its first difference."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.operators import recovery
from tidemark.plans import events as E
from tidemark.streaming import gateway, leases

SF = "/root/testdata/sf0.001"
EVENTS = "scope string, at long, n long, connection string, session string, kind string"


def outcomes(rows):
    return sorted((r["scope"], r["at"], r["connection"], r["session"], r["generation"], r["outcome"]) for r in rows)


def folded(spark, rows):
    return outcomes(leases.lease_outcomes(spark.createDataFrame(rows, EVENTS)).collect())


def test_a_lease_ends_without_another_frame(spark):
    rows = [("s", 0, 0, "a", "A", "HELLO"), ("s", 10, 1, "a", "A", "FRAME"), ("s", 39, 2, "b", "B", "HELLO"), ("s", 40, 3, "b", "B", "HELLO"), ("s", 41, 4, "a", "A", "FRAME"), ("s", 45, 5, "a", "A", "CLOSE")]
    assert folded(spark, rows) == sorted([
        ("s", 0, "a", "A", 1, "granted"), ("s", 10, "a", "A", 1, "renewed"), ("s", 39, "b", "B", 1, "conflict"), ("s", 40, "a", "A", 1, "expired"), ("s", 40, "b", "B", 2, "granted"),
        ("s", 41, "a", "A", 1, "lost"), ("s", 45, "a", "A", 0, "closed"), ("s", 70, "b", "B", 2, "expired"), ("s", 100, "b", "B", 2, "idle"),
    ])


def test_an_earlier_generation_releases_nothing(spark):
    rows = [("s", 0, 0, "a", "A", "HELLO"), ("s", 31, 1, "b", "B", "HELLO"), ("s", 32, 2, "a", "A", "CLOSE"), ("s", 33, 3, "b", "B", "FRAME"), ("s", 34, 4, "b", "B", "CLOSE"), ("s", 35, 5, "c", "C", "HELLO"), ("s", 35, 6, "c", "C", "HELLO")]
    got = folded(spark, rows)
    assert [x[1:] for x in got if x[5] in ("stale", "renewed", "released")] == [(32, "a", "A", 1, "stale"), (33, "b", "B", 2, "renewed"), (34, "b", "B", 2, "released"), (35, "c", "C", 3, "released")]
    assert ("s", 35, "c", "C", 4, "granted") in got and ("s", 65, "c", "C", 4, "expired") in got
    assert folded(spark, []) == []


def test_leases_of_a_stream_whose_clock_others_turn(spark, tmp_path):
    """Timers fire as the watermark passes, in a scope that no event reaches any more; all outcomes are those of the fold."""
    rng, rows, now = random.Random(5), [], 0
    for n in range(160):
        now += rng.choice((1, 4, 9, 25, 40) if n % 40 else (90,))
        rows.append((rng.choice("pq"), now, n, f"c{rng.randrange(3)}", "x", rng.choice(("HELLO", "FRAME", "FRAME", "FRAME", "CLOSE"))))
    want = folded(spark, rows)
    assert {x[5] for x in want} == {"granted", "renewed", "conflict", "closed", "lost", "released", "stale", "expired", "idle"}
    source, out = tmp_path / "in", tmp_path / "out"
    batches = [rows[k : k + 20] for k in range(0, 160, 20)] + [[("clock", now + more, 999, "c", "x", "CLOSE")] for more in (1000, 2000)]
    for batch in batches:
        spark.createDataFrame(batch, EVENTS).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(EVENTS).parquet(str(source)).withColumn("time", F.timestamp_seconds("at")).withWatermark("time", "0 seconds")
        query = leases.lease_stream(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start(str(out))
        query.awaitTermination()
        if batch is batches[0]:
            assert spark.read.parquet(str(out)).count() > 0
    assert [x for x in outcomes(spark.read.parquet(str(out)).collect()) if x[0] != "clock"] == want


@pytest.fixture(scope="module")
def log(spark):
    """Accepted entries of three scopes, numbered on over their days."""
    rows = E.frames(spark, SF).where("scope IN ('view', 'click', 'purchase')").orderBy("scope", "day", "sequence").select("scope", "day", "frame").collect()
    out = []
    for scope in ("view", "click", "purchase"):
        state = gateway.State()
        own = [C.decode_message(bytes(r["frame"]))[1] for r in rows if r["scope"] == scope]
        frames = [C.encode_message("BATCH", m | {"batch_sequence": k + 1}) for k, m in enumerate(own)]
        for k, frame in enumerate(frames[:1] + frames[:1] + frames[1:]):  # the first one comes twice
            ack = state.accept(frame, 100 + k)
            if ack["status"] not in (gateway.DUPLICATE, gateway.CONFLICT, gateway.LEASED):
                out.append((scope, ack["sequence"], 100 + k, bytearray(frame), ack["entry_hash"], ack["cursor"], ack["digest"], ack["status"]))
    return spark.createDataFrame(out, "scope string, sequence long, receive_wall_s long, frame binary, entry_hash string, cursor long, digest string, status int")


def same(a, b):
    key = lambda df: sorted(map(tuple, df.select("scope", "sequence", "session", "batch_sequence", "status", "cursor", "next_count", "digest", "entry_hash", "hash", "now").collect()))
    return key(a) == key(b)


def test_the_log_gives_the_journal(spark, log):
    got = recovery.derived(log.drop("cursor", "digest", "status"))
    assert sorted(map(tuple, got.select("scope", "sequence", "cursor", "digest", "status", "entry_hash").collect())) == sorted(map(tuple, log.select("scope", "sequence", "cursor", "digest", "status", "entry_hash").collect()))
    assert recovery.derived(log.limit(0)).count() == 0


def test_only_the_tail_is_folded_again(spark, log):
    whole = recovery.derived(log)
    whole = E.stored(whole, "journal")
    most = {r["scope"]: r["m"] for r in log.groupBy("scope").agg(F.max("sequence").alias("m")).collect()}
    assert min(most.values()) > 3
    cut = most["click"] - 1
    bad = whole.where(~((F.col("scope") == "click") & (F.col("sequence") >= cut)))
    bad = bad.withColumn("entry_hash", F.when((F.col("scope") == "purchase") & (F.col("sequence") == 2), F.lit("0" * 64)).otherwise(F.col("entry_hash")))
    fixed, again = recovery.recovered(log, bad)
    assert same(fixed, whole)
    assert {(r["scope"], r["sequence"]) for r in again.collect()} == {("click", s) for s in range(cut, most["click"] + 1)} | {("purchase", s) for s in range(2, most["purchase"] + 1)}
    fixed, again = recovery.recovered(log, whole)
    assert same(fixed, whole) and again.count() == 0


@pytest.mark.parametrize("width", [9, 256])
def test_divergence_descends_to_the_first_difference(spark, monkeypatch, width):
    monkeypatch.setattr(recovery, "WIDTH", width)
    rng = random.Random(width)
    log = [(f"s{k}", n, f"h{k}-{n}") for k in range(12) for n in range(1, 60 + k)]
    journal, want = [], {}
    for k in range(12):
        own = [r for r in log if r[0] == f"s{k}"]
        at = rng.randrange(len(own))
        if k % 4 == 1:
            own[at] = (*own[at][:2], "other")
            own[-1] = (*own[-1][:2], "other")
        elif k % 4 == 2:
            del own[at]
        elif k % 4 == 3:
            own = own[:at]
        journal += own
        if k % 4:
            want[f"s{k}"] = at + 1
    journal.append(("new", 7, "x"))
    frames = [spark.createDataFrame(x, "scope string, sequence long, h string").repartition(3) for x in (journal, log)]
    got = {r["scope"]: r["sequence"] for r in recovery.divergence(*frames, ["h"]).collect()}
    assert got == want | {"new": 7}
    trees = tuple(recovery.sums(x, ["h"]) for x in frames)
    assert {r["scope"]: r["sequence"] for r in recovery.divergence(*frames, ["h"], trees).collect()} == got
    assert recovery.divergence(frames[1], frames[1], ["h"]).count() == 0
