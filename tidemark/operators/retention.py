"""Which local artifacts may be pruned, and why others may not."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.functions import native as N
from tidemark.operators import chains
from tidemark.operators import proofs as contract
from tidemark.sources.store import FolderStore


@dataclass(frozen=True)
class Policy:
    now: int
    durable_now: int
    grace: int
    expected_start: int
    max_candidates: int
    remote_required: bool = False


def reason(policy: Policy) -> Column:
    """The first rule that a candidate breaks; null for an eligible one."""
    elapsed = (F.col("observed_at") + policy.grace <= policy.now) & (F.col("grace_not_before") <= policy.now) & (F.col("grace_not_before") >= F.col("observed_at") + policy.grace)
    rules = (
        (F.col("active"), "active_artifact"),
        (~F.col("kind").isin("wal", "raw_outbox"), "artifact_policy_unimplemented"),
        (~F.col("recovered"), "recovery_required"),
        (~F.col("fresh"), "fresh_observation_missing"),
        (~F.col("covered"), "manifest_coverage_missing"),
        (F.lit(policy.remote_required) & ~F.col("remote_verified"), "remote_verified_missing"),
        (F.col("proof_sha256").isNull(), "retention_proof_missing"),
        (~F.col("proof_sha256").rlike("^[0-9a-f]{64}$"), "retention_proof_invalid"),
        (~F.col("limits_match"), "retention_proof_limits_mismatch"),
        (F.col("proof_artifact") != F.col("artifact_id"), "retention_identity_mismatch"),
        (F.col("observed_at") > policy.now, "observation_from_future"),
        (~elapsed, "grace_not_elapsed"),
        (F.col("recovery_floor"), "active_recovery_floor"),
    )
    return F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), name) for bad, name in rules))


def plan(candidates: DataFrame, policy: Policy) -> DataFrame:
    """artifact_id, action (prune or blocked) and reason, ordered by artifact_id.

    A clock that ran backwards blocks all. Segments must go as a prefix of the log without a gap: the first
    break says so, what follows waits. Of what may go, the first max_candidates by artifact_id go, the rest waits too. Twice the same
    id or path is an error.
    """
    order = lambda c: Window.partitionBy(c)
    twice = (F.count("*").over(order("artifact_id")) > 1) | (F.count("*").over(order("path")) > 1)
    rows = candidates.withColumn("twice", twice)
    rows = rows.where(F.when(~F.col("twice"), True).otherwise(F.raise_error(F.lit("duplicate artifact")).cast("boolean")))
    if policy.now < policy.durable_now:
        return rows.select("artifact_id", F.lit("blocked").alias("action"), F.lit("clock_regression").alias("reason")).orderBy("artifact_id")
    rows = rows.withColumn("own", reason(policy)).withColumn("eligible", F.col("own").isNull()).withColumn("expected", F.lit(policy.expected_start).cast("long"))
    wal = chains.prefix_holds(rows.where("kind = 'wal'"), "expected", ["kind"])
    broken = F.when(F.col("before"), F.when(F.col("gap"), "wal_prefix_gap").otherwise(F.col("own"))).otherwise("wal_prefix_blocked")
    wal = wal.select("artifact_id", "first_sequence", broken.alias("reason"))
    other = rows.where("kind <> 'wal'").select("artifact_id", "first_sequence", F.col("own").alias("reason"))
    every = wal.unionByName(other)
    first = every.where("reason IS NULL").orderBy("artifact_id").limit(policy.max_candidates).select("artifact_id", F.lit(True).alias("_first"))
    every = every.join(F.broadcast(first), "artifact_id", "left")  # a plan has at most max_candidates actions
    every = every.withColumn("reason", F.when(F.col("reason").isNull() & F.col("_first").isNull(), "max_prune_candidates").otherwise(F.col("reason")))
    return every.select("artifact_id", F.when(F.col("reason").isNull(), "prune").otherwise("blocked").alias("action"), "reason").orderBy("artifact_id")


def plan_digest(rows: list[tuple[str, str, str | None]]) -> str:
    """Digest of a collected plan; a plan has at most max_candidates actions."""
    return C.digest(D.PRUNE_PLAN, [{"action": a, "artifact_id": i, "reason": r} for i, a, r in sorted(rows, key=lambda x: (x[0], x[1], x[2] or ""))]).hex()


def within_budget(inventory: DataFrame, max_objects: int, max_bytes: int) -> DataFrame:
    """inventory (path, length) as long as both budgets hold, by path; passing either is an error, nothing is cut off."""
    total = inventory.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b"))
    fits = F.when((F.col("n") <= max_objects) & (F.col("b") <= max_bytes), True).otherwise(F.raise_error(F.lit("inventory budget exceeded")).cast("boolean"))
    return inventory.where(total.select(fits.alias("fits")).scalar()).orderBy("path")


def retained_from(checkpoints: DataFrame, segments: DataFrame, *scopes: str) -> DataFrame:
    """Retained segments with breaks: the first of a scope must follow the scope's last checkpoint, each other the one before it."""
    keys = scopes or ("_all",)
    if not scopes:
        checkpoints, segments = (x.withColumn("_all", F.lit(1)) for x in (checkpoints, segments))
    last = checkpoints.groupBy(*keys).agg(F.max_by(F.struct("last_sequence", "chain_root"), "checkpoint").alias("_c"))
    w = Window.partitionBy(*keys).orderBy("first_sequence")
    rows = segments.join(last, list(keys), "left")
    before, root = F.coalesce(F.lag("last_sequence").over(w), F.col("_c.last_sequence"), F.lit(0)), F.coalesce(F.lag("chain_root").over(w), F.col("_c.chain_root"))
    return rows.withColumn("breaks", ~((F.col("first_sequence") == before + 1) & (root.isNull() | (F.col("chain_start") == root)))).drop("_c", "_all")


def proofs(candidates: DataFrame, coverage: DataFrame, days: DataFrame, remote: DataFrame, claims: DataFrame, *scopes: str) -> DataFrame:
    """candidates (scopes, object_key) with what a retention proof must hold, and proof_sha256, the digest of it all, where it does.

    coverage and days are of archive.segment_coverage() and archive.verify_days(), remote has the objects (scopes, object_key) that lie
    verified in the store, claims the scopes whose claim does.
    """
    by = [*scopes, "day", "manifest_sha256"]
    sound = coverage.where("covered").join(days.where("valid").select(*by), by)
    best = sound.groupBy(*scopes, "object_key").agg(F.max_by(F.struct("day", "manifest_sha256"), F.struct("day", "manifest_sha256")).alias("_m"))
    known, claimed = remote.select(*scopes, "object_key").distinct().withColumn("_r", F.lit(True)), claims.select(*scopes).distinct().withColumn("_c", F.lit(True))
    rows = candidates.join(best, [*scopes, "object_key"], "left").join(known, [*scopes, "object_key"], "left").join(claimed, list(scopes), "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    rows = rows.withColumn("covered", F.col("_m").isNotNull()).withColumn("remote_verified", yes("_r")).withColumn("claimed", yes("_c"))
    text = F.concat_ws("/", *scopes, "object_key", "_m.day", "_m.manifest_sha256")
    digest = F.sha2(F.concat(N.raw(D.PROOF), F.encode(text, "UTF-8")), 256)
    return rows.withColumn("proof_sha256", F.when(F.col("covered") & F.col("remote_verified") & F.col("claimed"), digest)).drop("_m", "_r", "_c")


def unexpected(trash: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Files of the trash (name, sha256) that no checkpoint (segment_sha256) covers: nothing else may lie there."""
    return trash.join(checkpoints.select(F.col("segment_sha256").alias("sha256")), "sha256", "left_anti")


def wall_clock(store: FolderStore, observed_ms: int | None = None) -> int | None:
    """The latest recorded wall clock; with an observation, which must not be earlier, after recording it."""
    names = [k for k, _ in store.keys("wall-clock", 1 << 20)]
    latest = None
    if names:
        value = C.parse_canonical(store.get(names[-1]), {"observed_wall_time_unix_ms", "version"})
        latest = value["observed_wall_time_unix_ms"]
        if names[-1] != f"wall-clock/{latest:020d}.json":
            raise C.FormatError("INVALID_FIELD", names[-1])
    if observed_ms is None:
        return latest
    if observed_ms < 1 or latest is not None and observed_ms < latest:
        raise C.FormatError("INVALID_FIELD", "wall clock regressed")
    store.put_if_absent(f"wall-clock/{observed_ms:020d}.json", C.canonical_json({"observed_wall_time_unix_ms": observed_ms, "version": "retention-wall-clock-v1"}))
    return observed_ms


def anchor(checkpoints: list[dict]) -> tuple[int, str]:
    """Where a log that was pruned begins: the sequence and the hash that its first retained entry must follow."""
    return (checkpoints[-1]["end_sequence"], checkpoints[-1]["retained_chain_root"]) if checkpoints else (0, D.ZERO.hex())


def prune(candidates: DataFrame, policy: Policy, executor: Executor, clock: FolderStore, actions: DataFrame) -> list[str]:
    """One run: what a crash left is finished, the clock is recorded and must not run backwards, the plan is made and carried out.

    actions has what the executor needs of each artifact_id; at most policy.max_candidates of them are collected.
    """
    executor.recover()
    wall_clock(clock, policy.now)
    chosen = plan(candidates, policy).where("action = 'prune'").join(actions, "artifact_id")
    return executor.execute([r.asDict() for r in chosen.collect()])


@dataclass
class Executor:
    """Carries out a plan's log prefix in a store that Spark reaches: a checkpoint is durable before its segment moves to the trash, and
    the segment is deleted last, so that whatever a crash leaves can be finished. fault is called at each step, for tests."""

    spark: SparkSession
    root: str
    fault: Callable[[str, str], None] = lambda step, artifact: None

    def __post_init__(self) -> None:
        self.path = self.spark._jvm.org.apache.hadoop.fs.Path
        self.store = self.path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _where(self, *parts: str):
        return self.path("/".join([self.root, *parts]))

    def checkpoints(self) -> list[dict]:
        """The chain of checkpoints, verified: each names the digest of the one before it and starts where that ended."""
        folder = self._where("checkpoints")
        if not self.store.exists(folder):
            return []
        rows = self.spark.read.format("binaryFile").load(f"{self.root}/checkpoints").select("path", "content").collect()
        out: list[dict] = []
        for row in sorted(rows, key=lambda r: r["path"]):
            value = self._parsed(bytes(row["content"]))
            before = out[-1] if out else {"digest": D.ZERO.hex(), "end_sequence": value["start_sequence"] - 1}
            if value["previous_checkpoint_digest"] != before["digest"] or value["start_sequence"] != before["end_sequence"] + 1:
                raise C.FormatError("INVALID_FIELD", f"{row['path']} does not follow")
            out.append(value)
        return out

    @staticmethod
    def _parsed(data: bytes) -> dict:
        """A checkpoint's facts and digest; one that holds a proof must be bound to it."""
        if b'"checkpoint_version"' not in data:
            value = C.parse_canonical(data, {"end_sequence", "previous_checkpoint_digest", "retained_chain_root", "segment_sha256", "start_sequence"})
            return value | {"digest": C.digest(D.CHECKPOINT, value).hex()}
        value = C.parse_canonical(data, set(contract.CHECKPOINT_KEYS))
        contract.check_checkpoint(value)
        own = {k: value[k] for k in ("end_sequence", "previous_checkpoint_digest", "retained_chain_root")} | {"segment_sha256": value["last_segment_sha256"], "start_sequence": value["retention_proof"]["wal_range"]["start_sequence"]}
        return own | {"digest": C.digest(D.CHECKPOINT, value).hex()}

    def _publish(self, action: dict) -> None:
        from tidemark.sources.parts import put_if_absent

        chain = self.checkpoints()
        if any(c["end_sequence"] == action["end_sequence"] and c["segment_sha256"] == action["segment_sha256"] for c in chain):
            return
        last = chain[-1] if chain else None
        if last and action["start_sequence"] != last["end_sequence"] + 1:
            raise C.FormatError("INVALID_FIELD", "the plan does not follow the last checkpoint")
        before = last["digest"] if last else D.ZERO.hex()
        if action.get("proof"):  # the contract's document, which holds the proof
            value = contract.checkpoint(action["proof"], before)
            contract.check_checkpoint(value)
            if (value["end_sequence"], value["last_segment_sha256"], value["retained_chain_root"]) != (action["end_sequence"], action["segment_sha256"], action["retained_chain_root"]):
                raise C.FormatError("INVALID_FIELD", "the proof is of another segment")
        else:
            value = {k: action[k] for k in ("start_sequence", "end_sequence", "retained_chain_root", "segment_sha256")} | {"previous_checkpoint_digest": before}
        put_if_absent(self.spark, f"{self.root}/checkpoints/{action['end_sequence']:020d}.json", C.canonical_json(value))

    def execute(self, actions: list[dict]) -> list[str]:
        """Prune segments (artifact_id, name, start_sequence, end_sequence, retained_chain_root, segment_sha256; proof, the retention proof) in order; the ids that are done."""
        done = []
        for action in sorted(actions, key=lambda a: a["start_sequence"]):
            name, own = action["name"], action["artifact_id"]
            if "/" in name or name in ("", ".", ".."):
                raise C.FormatError("INVALID_FIELD", "path")
            here, trash = self._where("sealed", name), self._where("trash", name)
            self.fault("before_checkpoint", own)
            self._publish(action)
            self.fault("after_checkpoint", own)
            if self.store.exists(here):
                self.store.mkdirs(self._where("trash"))
                if not self.store.rename(here, trash):
                    raise OSError(f"cannot move {name}")
            self.fault("after_trash", own)
            self.store.delete(trash, False)
            self.fault("after_delete", own)
            done.append(own)
        return done

    def recover(self) -> list[str]:
        """Finish what a crash left: segments in the trash go if a checkpoint covers them, else they return."""
        covered = {c["segment_sha256"] for c in self.checkpoints()}
        trash = self._where("trash")
        if not self.store.exists(trash):
            return []
        finished = []
        rows = self.spark.read.format("binaryFile").load(f"{self.root}/trash")
        for row in rows.select("path", F.sha2("content", 256).alias("sha")).collect():
            name = row["path"].rsplit("/", 1)[-1]
            if row["sha"] in covered:
                self.store.delete(self._where("trash", name), False)
                finished.append(name)
            else:
                self.store.rename(self._where("trash", name), self._where("sealed", name))
        return finished
