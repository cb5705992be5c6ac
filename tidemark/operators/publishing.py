"""Publishing to an immutable store: a journal of stages, a lock, raw days, replay days, and the loops that run them.

The store decides: whatever is durable there is found again, and every step is done only if it is not
done yet, so a publication that was interrupted at any point is finished by running it again. What a
step needs is bounded by a manifest; nothing here grows with the data.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import archive, publication, selection
from tidemark.sources.commits import NAMES, Commits
from tidemark.sources.parts import claim as claim_of
from tidemark.sources.parts import receipt as receipt_of
from tidemark.sources.store import FolderStore, Layout, StoreError, classified
from tidemark.streaming.incremental import DayTables

#: The stages of a publication, in order.
STAGES = ("intent", "claimed", "objects_copied", "objects_verified", "manifest_copied", "manifest_verified", "receipt_saved")
#: The kinds of an event.
EVENTS = ("bundle_registered", "observation_completed", "action_planned", "action_started", "action_finished", "receipt_saved")
EVENT_KEYS = ("action_kind", "action_plan_digest", "bundle_digest", "error_class", "event_kind", "object_id", "observation_digest", "result_class")


class Stopped(Exception):
    """A publication that may not go on. decision is Retry, IntegrityStop or ResourceStop."""

    def __init__(self, decision: str, reason: str):
        super().__init__(f"{decision}: {reason}")
        self.decision, self.reason = decision, reason


def action_plan_digest(bundle: str, decision: str, reason: str, stop_class: str, actions: list[tuple[str, str]]) -> str:
    """Digest of what a reconciler decided: actions are (kind, object_id)."""
    if any(not i for _, i in actions):
        raise C.FormatError("INVALID_FIELD", "object id")
    return C.digest(D.ACTION_PLAN, {"actions": [{"kind": k, "object_id": i} for k, i in actions], "bundle_digest": bundle, "decision_kind": decision, "reason_code": reason, "stop_class": stop_class}).hex()


def event(kind: str, bundle: str, **more: str) -> dict[str, str]:
    """An event and its id, which is the digest of what it says; digests that are not given are zero."""
    value = {k: "" for k in EVENT_KEYS} | {k: D.ZERO.hex() for k in EVENT_KEYS if k.endswith("_digest")} | {"bundle_digest": bundle, "event_kind": kind, "error_class": "none"} | more
    if kind not in EVENTS or set(value) != set(EVENT_KEYS):
        raise C.FormatError("INVALID_FIELD", "event")
    return value | {"event_id": C.digest(D.EVENT, value).hex()}


@dataclass
class Events:
    """Diagnostic events, appended and never relied on: losing them changes no decision."""

    store: FolderStore
    folder: str = "events"

    def append(self, one: dict[str, str]) -> None:
        number = len(self.store.keys(self.folder, 1 << 20))
        self.store.put_if_absent(f"{self.folder}/{number:020d}-{one['event_id']}.json", C.canonical_json(one))

    def table(self, spark: SparkSession) -> DataFrame:
        """The events in order."""
        keys = self.store.keys(self.folder, 1 << 20)
        rows = [(n, *(C.parse_canonical(self.store.get(k), {*EVENT_KEYS, "event_id"})[c] for c in (*EVENT_KEYS, "event_id"))) for n, (k, _) in enumerate(keys)]
        return spark.createDataFrame(rows, "number long, " + ", ".join(f"{c} string" for c in (*EVENT_KEYS, "event_id")))


@dataclass
class Journal:
    """Durable intents and the stages that they reached; a stage is a file of its own, so none is ever taken back."""

    store: FolderStore
    folder: str = "journal"

    def _where(self, identity: str, name: str) -> str:
        return f"{self.folder}/{C.sha(identity.encode()).hex()}/{name}"

    def intent(self, identity: str, data: bytes) -> str:
        """The stage of a publication, which begins with its first call; the intent of an identity never changes."""
        self.store.put_if_absent(self._where(identity, "intent.json"), data)
        self.advance(identity, STAGES[0])
        return self.stage(identity)

    def advance(self, identity: str, stage: str) -> None:
        self.store.put_if_absent(self._where(identity, f"stage-{STAGES.index(stage)}"), stage.encode())

    def stage(self, identity: str) -> str:
        """The furthest stage."""
        return max((STAGES[int(k.rsplit("-", 1)[1])] for k, _ in self.store.keys(self._where(identity, "").rstrip("/"), 100) if "/stage-" in k), key=STAGES.index)

    def verified(self, identity: str, key: str, at: int) -> None:
        """Record that an object was verified remotely."""
        self.store.put_if_absent(self._where(identity, f"verified-{C.sha(key.encode()).hex()}.json"), C.canonical_json({"key": key, "remote_verified_at": at}))

    def unfinished(self, most: int = 100_000) -> list[bytes]:
        """The intents without a receipt, in the order of their identities' digests."""
        keys = {k for k, _ in self.store.keys(self.folder, most)}
        done = f"/stage-{len(STAGES) - 1}"
        return [self.store.get(k) for k in sorted(keys) if k.endswith("/intent.json") and k.removesuffix("/intent.json") + done not in keys]

    def remote(self, spark: SparkSession, most: int = 100_000) -> DataFrame:
        """Objects that were verified remotely: key and remote_verified_at."""
        rows = [C.parse_canonical(self.store.get(k), {"key", "remote_verified_at"}) for k, _ in self.store.keys(self.folder, most) if "/verified-" in k]
        return spark.createDataFrame([(r["key"], r["remote_verified_at"]) for r in rows], "key string, remote_verified_at long")


def last_verified(remote: DataFrame) -> int | None:
    """When an object was last verified remotely."""
    return remote.agg(F.max("remote_verified_at")).first()[0]


def bound_remotely(candidates: DataFrame, remote: DataFrame) -> DataFrame:
    """Candidates (key) with remote_verified: whether a durable record says that their object was verified."""
    known = remote.select("key").distinct().withColumn("_seen", F.lit(True))
    return candidates.join(known, "key", "left").withColumn("remote_verified", F.coalesce("_seen", F.lit(False))).drop("_seen")


@contextmanager
def lock(path: str) -> Iterator[None]:
    """One publication of a scope at a time on this host: the file must not exist; it goes when the work is done, and stays if the process dies."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    try:
        handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o600)
    except FileExistsError:
        raise StoreError("publisher_conflict", f"{path} is held") from None
    try:
        os.write(handle, str(os.getpid()).encode())
        yield
    finally:
        os.close(handle)
        os.unlink(path)


def ensure_descriptor(store: FolderStore, layout: Layout) -> bytes:
    """The scope's descriptor, written if it is not there; another one in its place is a collision."""
    data = C.canonical_json({"config": layout.config, "descriptor_version": "scope-descriptor-v1"})
    store.put_if_absent(layout.descriptor(), data)
    return data


def scopes(store: FolderStore, root: str = "", most: int = 10_000) -> list[dict[str, Any]]:
    """The configurations of all scope descriptors below root, in order; two of one scope are an integrity error."""
    out: dict[str, dict[str, Any]] = {}
    for key, _ in store.keys(root, most):
        if key.endswith("/scope-descriptor-v1.json"):
            value = C.parse_canonical(store.get(key), {"config", "descriptor_version"})
            archive.config_hash(value["config"])
            own = C.canonical_json([value["config"]["provider_id"], value["config"]["exact_source_symbol"]]).decode()
            if own in out:
                raise StoreError("integrity", f"two descriptors of {own}")
            out[own] = value["config"]
    return [out[k] for k in sorted(out)]


@dataclass
class Publisher:
    """Publishes raw days: claim, descriptor, objects, manifest, receipt; every one verified in the store after it was written."""

    spark: SparkSession
    local: FolderStore
    remote: FolderStore
    layout: Layout
    journal: Journal
    lock_path: str
    clock: Callable[[], int] = lambda: 0
    fault: Callable[[str], None] = lambda step: None

    def publish(self, manifest: dict[str, Any]) -> bytes:
        """The receipt's bytes of a raw day's manifest, whose objects lie in the local store under their keys."""
        data = C.canonical_json(manifest)
        digest = C.sha(D.RAW_DAY, data).hex()
        identity = self.layout.raw_manifest(manifest["date"], manifest["revision"], digest)
        claim, claim_digest = claim_of({"config_hash": manifest["config_hash"], "publisher_epoch": manifest["publisher_epoch"], "publisher_id": manifest["publisher_id"]})
        with lock(self.lock_path):
            self.journal.intent(identity, data)
            self._step("claimed", identity, lambda: self._put(self.layout.claim(), claim, "publisher_conflict"))
            ensure_descriptor(self.remote, self.layout)
            self._step("objects_copied", identity, lambda: [self._copy(o) for o in manifest["chain_objects"]])
            self._step("objects_verified", identity, lambda: [self._check(o, identity) for o in manifest["chain_objects"]])
            for o in manifest["chain_objects"]:  # whatever an earlier run has verified is looked at once more before the manifest names it
                self._check(o, identity)
            self._succeeds(manifest)
            self._step("manifest_copied", identity, lambda: self.remote.put_if_absent(identity, data))
            self._step("manifest_verified", identity, lambda: self.remote.verify(identity, data))
            out = C.canonical_json({"claim_hash": claim_digest, "manifest_key": identity, "manifest_sha256": digest, "raw_objects": manifest["chain_objects"], "receipt_version": "publication-verification-receipt-v1", "scope_config_hash": manifest["config_hash"], "verification_complete": True})
            self._step("receipt_saved", identity, lambda: self.local.put_if_absent(f"receipts/raw-day/date={manifest['date']}/receipt-{manifest['revision']:020d}-{digest}.json", out))
        return out

    def _step(self, stage: str, identity: str, run: Callable[[], object]) -> None:
        self.fault(f"before_{stage}")
        run()
        self.journal.advance(identity, stage)
        self.fault(f"after_{stage}")

    def _put(self, key: str, data: bytes, otherwise: str) -> None:
        try:
            self.remote.put_if_absent(key, data)
        except StoreError as bad:
            raise StoreError(otherwise if bad.kind == "collision" else bad.kind, key) from bad

    def _copy(self, o: dict[str, Any]) -> None:
        key = self.layout.raw_object(o["key"], o["sha256"])
        if self.remote.observe(key, o["sha256"], o["bytes"]) == "Exact":
            return
        if self.local.observe(o["key"], o["sha256"], o["bytes"]) != "Exact":
            raise StoreError("local_changed", o["key"])
        self.remote.put_if_absent(key, self.local.get(o["key"]))

    def _check(self, o: dict[str, Any], identity: str) -> None:
        key = self.layout.raw_object(o["key"], o["sha256"])
        if self.remote.observe(key, o["sha256"], o["bytes"]) != "Exact":
            raise StoreError("check_mismatch", key)
        self.journal.verified(identity, o["key"], self.clock())

    def _succeeds(self, manifest: dict[str, Any]) -> None:
        """The revisions of the day in the store are a chain that this one continues, or already holds."""
        folder = archive.manifest_key(manifest["day_definition_id"], manifest["date"], 1, "").rsplit("/", 1)[0]
        known = [C.parse_canonical(self.remote.get(k), set(archive.DAY_KEYS)) for k, _ in self.remote.keys(self.layout.key(folder), 100_000)]
        digests = {k["revision"]: C.sha(D.RAW_DAY, C.canonical_json(k)).hex() for k in known}
        if len(digests) != len(known) or sorted(digests) != list(range(1, len(known) + 1)):
            raise StoreError("integrity", "revisions of the day")
        own = C.sha(D.RAW_DAY, C.canonical_json(manifest)).hex()
        if digests.get(manifest["revision"], own) != own or manifest["previous_manifest_sha256"] != digests.get(manifest["revision"] - 1) or manifest["revision"] > len(known) + 1:
            raise StoreError("collision", "another revision of the day")


@dataclass
class ReplayPublisher:
    """Publishes a replay day: what is there is observed, one absent object is written, and all is observed again, until nothing is missing.

    objects: of each barrier the (object_id, key, bytes) that the bundle must have; what the bundle relies
    on but does not write (claim, raw manifest and objects, graph) must be there already.
    """

    spark: SparkSession
    remote: FolderStore
    objects: dict[str, list[tuple[str, str, bytes]]]
    bundle_digest: str
    limits: dict[str, int]
    events: Events | None = None
    spent: dict[str, int] = field(default_factory=lambda: {"requests": 0, "bytes": 0})

    def observe(self) -> list[tuple[str, str, str]]:
        """(barrier, object_id, class) of every object; what an observation asks for and reads counts against the budget, refused or not."""
        out = []
        for barrier, some in self.objects.items():
            for object_id, key, data in some:
                self.spent["requests"] += 1
                kind = self.remote.observe(key, C.sha(data).hex(), len(data), self.limits["max_parquet_object_bytes" if barrier == "parquet" else "max_metadata_object_bytes"])
                self.spent["bytes"] += len(data) if kind in ("Exact", "Different") else 0
                out.append((barrier, object_id, kind))
        return out

    def within(self) -> bool:
        return self.spent["requests"] <= self.limits["max_observation_requests"] and self.spent["bytes"] <= self.limits["max_observation_bytes"]

    def publish(self, receipt_key: str, manifest_key: str) -> bytes:
        """The receipt's bytes, saved under receipt_key when every barrier is satisfied; Stopped says why it cannot be."""
        ids = [(b, i) for b, some in self.objects.items() for i, _, _ in some]
        self._event("bundle_registered")
        for _ in range(self.limits["max_publication_rounds"]):
            seen = self.observe()
            observed = C.sha(C.canonical_json([list(x) for x in sorted(seen)])).hex()
            self._event("observation_completed", observation_digest=observed)
            pubs = self.spark.createDataFrame([(1, True, self.within(), True, ids)], "publication long, digest_ok boolean, within_budget boolean, complete boolean, bundle array<struct<barrier:string,object_id:string>>")
            rows = self.spark.createDataFrame([(1, *x) for x in seen], "publication long, barrier string, object_id string, class string")
            found = publication.reconcile(pubs, rows).first()
            if found["decision"] == "ReadyForReceipt":
                out = receipt_of(self.bundle_digest, observed, manifest_key)
                self.remote.put_if_absent(receipt_key, out)
                self._event("receipt_saved", observation_digest=observed)
                return out
            if found["decision"] != "Execute":
                raise Stopped(found["decision"], found["reason"])
            barrier, object_id = found["reason"].removesuffix("_upload"), found["actions"][0]
            digest = action_plan_digest(self.bundle_digest, "Execute", found["reason"], "Absent", [(f"upload_{barrier}", i) for i in found["actions"]])
            self._event("action_started", action_plan_digest=digest, action_kind=f"upload_{barrier}", object_id=object_id, observation_digest=observed)
            result = self.execute(barrier, object_id)
            self._event("action_finished", action_plan_digest=digest, action_kind=f"upload_{barrier}", object_id=object_id, result_class=result)
            if result != "completed":
                raise Stopped("IntegrityStop" if result == "different" else "Retry", result)
        raise Stopped("ResourceStop", "rounds")

    def execute(self, barrier: str, object_id: str) -> str:
        """Write the one object that was approved, and look at it: completed, different or unavailable."""
        key, data = next((k, d) for i, k, d in self.objects[barrier] if i == object_id)
        try:
            self.remote.put_if_absent(key, data)
            self.remote.verify(key, data)
        except StoreError as bad:
            return "different" if bad.kind in ("collision", "check_mismatch") else "unavailable"
        except OSError:
            return "unavailable"
        return "completed"

    def _event(self, kind: str, **more: str) -> None:
        if self.events is not None:
            try:
                self.events.append(event(kind, self.bundle_digest, **more))
            except (StoreError, OSError):  # events decide nothing
                return


@dataclass
class StateTables:
    """Tables that change together, one numbered batch after the other (``sources.commits``).

    For foreachBatch: a batch that is run again finds its number committed and changes nothing. Several gateways may write; two
    that are about the same scope at the same time conflict.
    """

    spark: SparkSession
    folder: str

    @property
    def log(self) -> Commits:
        return Commits(self.spark, self.folder)

    def commit(self, number: int, tables: dict[str, DataFrame], replaced: tuple[str, ...] = (), names: list[str] | None = None, writer: str = "batches") -> bool:
        """Write the tables of a commit; whether it is new."""
        return self.log.commit(tables, (writer, number), replaced, names or ()) is not None

    def appended(self, name: str) -> DataFrame:
        """All rows of a table that commits add to."""
        return self.log.table(name)

    def latest(self, name: str) -> DataFrame:
        """A table that each commit replaces."""
        return self.spark.read.parquet(self.log.paths(name)[-1])

    def count(self, name: str) -> int:
        """Rows that commits added to a table, from what they say of it."""
        return self.log.count(name)


def journal_batch(tables: StateTables, number: int, acks: DataFrame, state: DataFrame) -> bool:
    """A micro-batch's accepted batches and the gateway's state after it, in one commit; a gateway that took in the same scope meanwhile is a conflict."""
    scopes = [r[0] for r in acks.select("scope").distinct().limit(NAMES + 1).collect()] if "scope" in acks.columns else []
    return tables.commit(number, {"batches": acks, "state": state}, ("state",), scopes)


def plannable(days: DataFrame, revisions: DataFrame, published: DataFrame) -> DataFrame:
    """days (day) whose next revision may be planned: they have none yet, or their last one (day, revision, digest) is among published (digest)."""
    last = selection.latest(revisions, "day").select("day", "digest")
    known = published.select("digest").distinct().withColumn("_out", F.lit(True))
    rows = days.join(last, "day", "left").join(known, "digest", "left")
    return rows.where(F.col("digest").isNull() | F.coalesce("_out", F.lit(False))).select(*days.columns)


def spool(store: FolderStore, manifest: dict[str, Any]) -> str:
    """A manifest's canonical bytes under a key of its own in the spool; another manifest in its place is a collision."""
    data = C.canonical_json(manifest)
    key = f"spool/raw-day/date={manifest['date']}/manifest-{manifest['revision']:020d}-{C.sha(D.RAW_DAY, data).hex()}.json"
    store.put_if_absent(key, data)
    return key


def publish_due(publisher: Publisher, catalog: DataFrame, now: int, least: int = 5, most: int = 600) -> DataFrame:
    """catalog (date, revision, state, attempts, next_retry, key) after one tick: due manifests are published in order of day and revision.

    The first failure that may pass is scheduled for later and ends the tick; one that may not is raised.
    What an interrupted run left goes first, for it is due like any other.
    """
    done = []
    for r in publication.due(catalog, now).orderBy("date", "revision").toLocalIterator():
        try:
            publisher.publish(C.parse_canonical(publisher.local.get(r["key"]), set(archive.DAY_KEYS)))
        except Exception as bad:
            kind, again = classified(bad)
            if not again:
                raise StoreError("integrity" if kind == "local_integrity" else kind, str(bad)) from bad
            done.append((r["date"], r["revision"], "retry_wait", r["attempts"] + 1, now + min(most, least * 2 ** min(r["attempts"], 40))))
            break
        done.append((r["date"], r["revision"], "published", r["attempts"], 0))
    names = ("state", "attempts", "next_retry")
    fresh = publisher.spark.createDataFrame(done, "date string, revision long, _state string, _attempts long, _next_retry long")  # what this tick did, no more
    rows = catalog.join(F.broadcast(fresh), ["date", "revision"], "left")
    return rows.select(*(F.when(F.col("_state").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).cast(catalog.schema[c].dataType).alias(c) if c in names else c for c in catalog.columns))


SPOOLED = "date string, revision long, key string, state string"


def spooled(days: DataFrame, folder: str, config: dict[str, Any], last: dict[str, tuple[int, str, bool]]) -> DataFrame:
    """date, revision, key and state of each of days, whose manifests the tasks write to the spool of the store at folder.

    last has revision and key of a day's last manifest and whether it is published. A day waits for that, and a day whose manifest
    would say the same as the last one is left alone: state is spooled, waiting or same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, schema = FolderStore(folder), pa.schema([("date", pa.string()), ("revision", pa.int64()), ("key", pa.string()), ("state", pa.string())])
        for batch in batches:
            for row in range(batch.num_rows):
                day = batch.slice(row, 1).to_pylist()[0]
                revision, key, published = last.get(day["day"], (0, "", True))
                out = {"date": day["day"], "revision": revision, "key": key, "state": "waiting"}
                if published:
                    old = C.parse_canonical(store.get(key), set(archive.DAY_KEYS)) if key else None
                    value = archive.manifest_value(day, config, revision + 1, C.sha(D.RAW_DAY, C.canonical_json(old)).hex() if old else None, "provisional", "synced", 0)
                    out["state"] = "same"
                    if old is None or any(value[k] != old[k] for k in value if k not in ("revision", "manifest_id", "previous_manifest_sha256")):
                        if old is not None:
                            archive.succeeds(old, value)
                        out |= {"revision": revision + 1, "key": spool(store, value), "state": "spooled"}
                yield pa.RecordBatch.from_pylist([out], schema=schema)

    return days.mapInArrow(run, SPOOLED)


@dataclass
class Pipeline:
    """One gateway's local work between capture and publication: seal, promote, fold, spool, measure.

    A tick reads the segments that came since the last one; days are states that they are folded into (``streaming.incremental``).
    """

    spark: SparkSession
    writer: Any  # wal.Writer
    store: FolderStore
    config: dict[str, Any]
    max_bytes: int
    catalog: list[dict[str, Any]] = field(default_factory=list)
    #: Days that changed since their last manifest.
    open_days: set[str] = field(default_factory=set)
    started: bool = False

    @property
    def days(self) -> DayTables:
        return DayTables(self.spark, f"{self.store.folder}/days")

    def _new_keys(self, sealed: str | None) -> list[str]:
        """Stored segments that no tick has taken in: the one just sealed, and at the start what an interrupted run left."""
        if self.started:
            return [sealed] if sealed else []
        self.started = True
        listed = self.spark.createDataFrame([(k,) for k, _ in self.store.keys("objects/raw", 1 << 20)], "object_key string")
        known = self.days.log.table("segments", "scope string, object_key string").select("object_key")
        self.open_days |= {r["day"] for r in self.days.states().select("day").distinct().collect()} - {r["date"] for r in self.catalog}
        return sorted(r["object_key"] for r in listed.join(known, "object_key", "left_anti").collect())

    def process(self, force: bool = False, published: tuple[str, ...] = ()) -> dict[str, int]:
        """Seal the active segment if it is large enough or force is set, store it under its content's name, and spool the manifests of days that changed.

        A day whose last manifest is not published yet waits. Returns the backlog.
        """
        from tidemark.sources import wal

        key = None
        if self.writer.next > self.writer.start and (force or len(self.writer.data) >= self.max_bytes):
            data = self.writer.seal()
            key = f"objects/raw/wal-{C.sha(data).hex()}.rtw"
            self.store.put_if_absent(key, data)
        if new := self._new_keys(key):
            files = wal.files(self.spark, [f"{self.store.folder}/{k}" for k in new])
            found = archive.records(files.mapInArrow(lambda b: wal._entries(b, "sealed"), wal.ENTRIES)).withColumn("scope", F.lit("scope"))
            own = files.mapInArrow(wal._segments, wal.SEGMENTS)
            own = own.select(F.lit("scope").alias("scope"), "object_key", F.lower(F.hex("object_sha256")).alias("object_sha256"), F.col("file_bytes"), *(F.col(c).cast("long").alias(c) for c in ("start_sequence", "last_sequence")), *(F.lower(F.hex(c)).alias(c) for c in ("chain_start", "chain_root")))
            number = self.days.log.known().tokens.get("ticks", -1) + 1
            self.days.fold(number, found, own)
            self.open_days |= {r["day"] for r in self.days.states().where(F.col("tick") == number).select("day").collect()}
        if self.open_days:
            last = {r["date"]: (r["revision"], r["key"], r["key"][-69:-5] in published) for r in self.catalog if r["date"] in self.open_days}
            days = self.days.days(low=min(self.open_days), high=max(self.open_days)).where(F.col("day").isin(sorted(self.open_days)))
            for r in spooled(days, self.store.folder, self.config, last).orderBy("date").collect():  # one small row an open day
                if r["state"] == "spooled":
                    self.catalog.append({"date": r["date"], "revision": r["revision"], "state": "spooled", "attempts": 0, "next_retry": 0, "key": r["key"]})
                if r["state"] != "waiting":
                    self.open_days.discard(r["date"])
        return {"pending": sum(r["state"] != "published" for r in self.catalog), "objects": self.days.log.count("segments")}
