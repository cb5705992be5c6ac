"""The read side: manifests as tables, snapshots by selector, plans of what to fetch, and checks of what was fetched."""

from __future__ import annotations

import json
import re
import threading
import urllib.parse
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import chains

RAW_RANGE = "struct<key:string,sha256:string,bytes:long,start_ingest_sequence:long,end_ingest_sequence:long,first_record_ordinal:long,last_record_ordinal:long>"
MANIFEST = f"path string, bytes long, digest string, manifest_id string, dataset_id string, day_definition_id string, date string, revision long, raw_day_manifest_sha256 string, part_manifest_keys array<string>, part_set_root string, root string, previous string, objects array<{RAW_RANGE}>"


class ReadError(Exception):
    """What a reader was asked for and could not give. code is one of CODES."""

    def __init__(self, code: str, detail: str = ""):
        super().__init__(f"{code}: {detail}")
        self.code, self.status = code, CODES[code]


# Error codes with their HTTP status.
CODES = {"invalid_request": 400, "unauthorized": 401, "forbidden": 403, "not_found": 404, "method_not_allowed": 405, "conflict": 409, "too_large": 413, "too_many_requests": 429, "integrity": 502, "unavailable": 502, "timeout": 504}
DIGEST, DAY, IDENTITY = re.compile(r"[0-9a-f]{64}"), re.compile(r"\d{4}-\d{2}-\d{2}"), re.compile(r"[A-Za-z0-9][A-Za-z0-9._:-]{0,127}")


def strict_query(query: dict[str, list[str]], required: set[str], optional: set[str] = frozenset()) -> dict[str, str]:
    """One non-empty value for each allowed key, of the right form."""
    if not required <= set(query) <= required | optional or any(len(v) != 1 or not v[0] for v in query.values()):
        raise ReadError("invalid_request", "query keys")
    flat = {k: v[0] for k, v in query.items()}
    forms = {"date": DAY, "manifest": DIGEST}
    if any(not forms.get(k, IDENTITY).fullmatch(v) for k, v in flat.items()) or set(flat.get("manifest", "1")) == {"0"}:
        raise ReadError("invalid_request", "query values")
    return flat


def manifests(spark: SparkSession, path: str, domain: bytes, pattern: str = "*.json", exact: bool = True) -> DataFrame:
    """Manifests under path, decoded strictly: canonical bytes, a name that holds their digest, and, if exact, the fields of their kind and no others."""
    from tidemark.operators import archive, publication

    keys = {D.RAW_DAY: set(archive.DAY_KEYS), D.REPLAY_DAY: publication.DAY_KEYS, D.PART: publication.PART_KEYS}.get(domain) if exact else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                value = C.parse_canonical(content, keys)
                own = C.sha(domain, content).hex()
                if own not in p.rsplit("/", 1)[-1]:
                    raise C.FormatError("INVALID_FIELD", f"{p} does not name its digest")
                row = {"path": p, "bytes": len(content), "digest": own, "root": value.get("canonical_stream_row_chain_root"), "previous": value.get("previous_manifest_sha256")}
                rows.append(row | {k: value.get(k) for k in ("manifest_id", "dataset_id", "day_definition_id", "date", "revision", "raw_day_manifest_sha256", "part_manifest_keys", "part_set_root", "objects")})
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return files.mapInArrow(run, MANIFEST)


def part_manifests(spark: SparkSession, root: str, exact: bool = True) -> DataFrame:
    """Part manifests below a scope's root, decoded like manifests(): key (below the root), digest, part_key, part_sha256 and part_bytes."""
    from tidemark.operators import publication

    schema = pa.schema([(n, pa.string()) for n in ("key", "digest", "part_key", "part_sha256")] + [("part_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                value, own = C.parse_canonical(content, publication.PART_KEYS if exact else None), C.sha(D.PART, content).hex()
                if own not in p.rsplit("/", 1)[-1]:
                    raise C.FormatError("INVALID_FIELD", f"{p} does not name its digest")
                rows.append({"key": p[p.index("derivatives/stream=") :], "digest": own} | {k: value[k] for k in ("part_key", "part_sha256", "part_bytes")})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.json").load(root).select("path", "content")
    return files.mapInArrow(run, "key string, digest string, part_key string, part_sha256 string, part_bytes long")


RANGE = pa.struct([(x.split(":")[0], pa.string() if x.endswith("string") else pa.int64()) for x in RAW_RANGE[7:-1].split(",")])
ARROW = pa.schema(
    [(n, pa.string()) for n in ("path",)] + [("bytes", pa.int64())] + [(n, pa.string()) for n in ("digest", "manifest_id", "dataset_id", "day_definition_id", "date")]
    + [("revision", pa.int64()), ("raw_day_manifest_sha256", pa.string()), ("part_manifest_keys", pa.list_(pa.string())), ("part_set_root", pa.string()), ("root", pa.string()), ("previous", pa.string()), ("objects", pa.list_(RANGE))]
)


@dataclass
class Archive:
    """Tables of an archive: scopes (scope_key, dataset_id, provider_id, symbol), raw and replay manifests, part manifests."""

    scopes: DataFrame
    raw: DataFrame
    replay: DataFrame | None = None
    parts: DataFrame | None = None

    def datasets(self) -> DataFrame:
        return self.scopes.select("dataset_id").distinct().orderBy("dataset_id")

    def list_scopes(self, dataset: str) -> DataFrame:
        return self.scopes.where(F.col("dataset_id") == dataset).orderBy("provider_id", "symbol")

    def raw_snapshots(self, dataset: str, date: str | None = None) -> DataFrame:
        rows = self.raw.where(F.col("dataset_id") == dataset)
        return (rows.where(F.col("date") == date) if date else rows).orderBy("date", "revision")

    def replay_snapshots(self, dataset: str) -> DataFrame:
        return self.replay.where(F.col("dataset_id") == dataset).orderBy("manifest_id", "revision", "path")

    def resolve(self, dataset: str, selector: str) -> dict[str, Any]:
        """The one raw manifest of a digest or a key."""
        by = "digest" if DIGEST.fullmatch(selector) else "path"
        return only(self.raw.where((F.col("dataset_id") == dataset) & (F.col(by) == selector)))

    def resolve_any(self, dataset: str, selector: str, kind: str = "auto") -> tuple[str, dict[str, Any]]:
        """raw or replay, and the one manifest of a digest or a key: of the kind that is asked for, or what the key says, else raw before replay."""
        if kind == "auto" and "/replay-day-" in selector:
            kind = "replay"
        if kind != "replay":
            try:
                return "raw", self.resolve(dataset, selector)
            except ReadError as bad:
                if kind == "raw" or bad.code != "not_found" or self.replay is None:
                    raise
        by = F.col("digest") == selector if DIGEST.fullmatch(selector) else F.endswith(F.col("path"), F.lit(selector))
        return "replay", only(self.replay.where((F.col("dataset_id") == dataset) & by))

    def manifest(self, digest: str) -> dict[str, Any]:
        """The manifest of a digest: raw first, then replay. Several raw ones are a conflict, which a replay one does not mask."""
        try:
            return only(self.raw.where(F.col("digest") == digest))
        except ReadError as bad:
            if bad.code != "not_found" or self.replay is None:
                raise
        return only(self.replay.where(F.col("digest") == digest))

    def resolve_replay(self, dataset: str, date: str, revision: int | None = None, digest: str | None = None) -> dict[str, Any]:
        """The replay manifest of a revision or of a digest, not both, else the newest."""
        if revision is not None and digest is not None:
            raise ReadError("invalid_request", "revision and digest")
        rows = self.replay.where((F.col("dataset_id") == dataset) & (F.col("date") == date))
        if revision is not None:
            return only(rows.where(F.col("revision") == revision))
        if digest is not None:
            return only(rows.where(F.col("digest") == digest))
        newest = rows.agg(F.max_by(F.struct(*rows.columns), "revision").alias("x")).first()["x"]
        if newest is None:
            raise ReadError("not_found", date)
        return newest.asDict(True)

    def fetch_plan(self, *chosen: dict[str, Any]) -> DataFrame:
        """Objects of raw manifests in the order in which these are named, each once: key, at (its place), sha256 and bytes. Conflicting sizes are an error."""
        order = F.array_position(F.array(*(F.lit(m["digest"]) for m in chosen)), F.col("digest"))
        rows = self.raw.where(F.col("digest").isin([m["digest"] for m in chosen])).select(order.alias("no"), F.posexplode("objects").alias("n", "o")).select(F.shiftleft(F.col("no") - 1, 32).bitwiseOR(F.col("n").cast("long")).alias("at"), "o")
        plan = rows.groupBy("o.key").agg(F.min("at").alias("at"), F.min("o.sha256").alias("sha256"), F.min("o.bytes").alias("bytes"), F.count_distinct("o.sha256", "o.bytes").alias("n"))
        return plan.where(F.when(F.col("n") == 1, True).otherwise(F.raise_error(F.lit("conflicting descriptors")).cast("boolean"))).orderBy("at").drop("n")

    def replay_plan(self, manifest: dict[str, Any]) -> DataFrame:
        """Part manifests of a replay manifest in order; one that is missing is an error."""
        keys = self.replay.where(F.col("digest") == manifest["digest"]).select(F.posexplode("part_manifest_keys").alias("part", "key"))
        joined = keys.join(self.parts, "key", "left")
        return joined.where(F.when(F.col("digest").isNotNull(), True).otherwise(F.raise_error(F.lit("part manifest is missing")).cast("boolean"))).orderBy("part")

    def bindings(self) -> DataFrame:
        """Replay manifests with whether exactly one raw manifest has the digest that they name."""
        raw = self.raw.groupBy(F.col("digest").alias("raw_day_manifest_sha256")).agg(F.count("*").alias("n"))
        return self.replay.join(raw, "raw_day_manifest_sha256", "left").withColumn("bound", F.coalesce(F.col("n") == 1, F.lit(False))).drop("n")

    def revision_faults(self) -> DataFrame:
        """Raw manifests that break their day's revision chain."""
        from tidemark.operators import selection

        return selection.revision_breaks(self.raw, "dataset_id", "date").where("breaks")


def only(rows: DataFrame) -> dict[str, Any]:
    """The single row; none or several are errors."""
    found = rows.take(2)
    if len(found) != 1:
        raise ReadError("conflict" if found else "not_found")
    return found[0].asDict(True)


def items(rows: DataFrame, most: int) -> list[dict[str, Any]]:
    """At most most rows: more are refused, never cut off."""
    found = rows.take(most + 1)
    if len(found) > most:
        raise ReadError("too_large", f"more than {most} items")
    return [r.asDict(True) for r in found]


def fetched(plan: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """plan with state: exact, different or absent, for the files of a folder by their key."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    seen = files.select(F.regexp_extract("path", r"(objects/raw/[^/]+)$", 1).alias("key"), F.sha2("content", 256).alias("_sha"), F.col("length").alias("_n"))
    same = (F.col("_sha") == F.col("sha256")) & (F.col("_n") == F.col("bytes"))
    return plan.join(seen, "key", "left").withColumn("state", F.when(F.col("_sha").isNull(), "absent").when(same, "exact").otherwise("different")).drop("_sha", "_n")


def fetch(plan: DataFrame, store: str, into: str, max_objects: int = 1 << 20, max_bytes: int = 1 << 46) -> DataFrame:
    """The plan's objects copied from one folder to another, with created; every one is checked on both sides.

    The plan's own sums must be within the limits before an object is opened.
    """
    from tidemark.operators.retention import within_budget
    from tidemark.sources.store import fetch_all

    fits = within_budget(plan.select(F.col("key").alias("path"), F.col("bytes").alias("length"), "key", "sha256", "bytes"), max_objects, max_bytes)
    return fetch_all(fits.select("key", "sha256", "bytes"), store, into)


def fetch_replay(archive: Archive, manifest: dict[str, Any], store: str, into: str, **limits: int) -> DataFrame:
    """The part files of a replay manifest, copied likewise: parts have part_key, part_sha256 and part_bytes."""
    plan = archive.replay_plan(manifest).select(F.col("part_key").alias("key"), F.col("part_sha256").alias("sha256"), F.col("part_bytes").alias("bytes"))
    return fetch(plan, store, into, **limits)


def verify_replay_day(stream: DataFrame, parts: DataFrame, manifest: dict[str, Any], raw_days: DataFrame) -> dict[str, bool]:
    """All facts of a replay day, valid last: its raw day (raw_days: manifest_sha256, valid) is bound and proved, its part files hold what their rows say
    (parts as of sources.parts.build(), with key and digest of their manifests), rows and parts are chained, counts and roots are the manifest's."""
    from tidemark.sources import parts as P

    bound = raw_days.where(F.col("manifest_sha256") == manifest["raw_day_manifest_sha256"]).agg(F.count("*").alias("n"), F.coalesce(F.min(F.col("valid").cast("int")), F.lit(0)).alias("v")).first()
    try:
        held = P.checked(parts).count() == parts.count()
    except Exception as bad:  # a part that does not hold fails the job with the format's error
        if "INVALID_FIELD" not in str(bad):
            raise
        held = False
    items = parts.select("part_sequence", "key", "digest", "first_stream_sequence", "last_stream_sequence").orderBy("part_sequence").collect()
    root = C.part_set_root([r.asDict() | {"digest": bytes.fromhex(r["digest"])} for r in items]).hex()
    facts = {"raw_bound": bound["n"] == 1, "raw_valid": bound["v"] == 1, "parts_valid": held, "part_set_root_matches": root == manifest["part_set_root"]} | verify_replay(stream, parts, manifest)
    return facts | {"valid": all(facts.values())}


def verify_replay(stream: DataFrame, parts: DataFrame, manifest: dict[str, Any]) -> dict[str, bool]:
    """What holds of a replay day: rows are numbered without gap and chained, parts follow each other, roots and counts are the manifest's."""
    rows = chains.unlinked(stream, ["scope", "day"], "stream_sequence", "previous_row_chain_hash", "row_chain_hash")
    facts = rows.agg(F.count("*").alias("n"), F.min("stream_sequence").alias("first"), F.coalesce(F.max(F.col("breaks").cast("int")), F.lit(0)).alias("breaks"), F.max_by("row_chain_hash", "stream_sequence").alias("root")).first()
    graph = chains.part_graph(parts, ["scope", "day"]).agg(F.coalesce(F.max(F.col("breaks").cast("int")), F.lit(0)).alias("breaks"), F.sum("row_count").alias("n")).first()
    return {
        "rows_contiguous": facts["breaks"] == 0 and (facts["n"] == 0 or facts["first"] == 0),
        "root_matches": (facts["root"] or D.ZERO.hex()) == manifest["root"],
        "parts_linked": graph["breaks"] == 0,
        "counts_match": (graph["n"] or 0) == facts["n"],
    }


def api(archive: Archive, most: int = 1000, health: Callable[[], dict[str, Any]] | None = None) -> Callable[[str, dict[str, list[str]]], tuple[int, dict]]:
    """A request handler (path, query) -> (status, body) over an archive; a server of any kind can call it. health gives its state."""
    routes: dict[str, tuple[set[str], set[str], Callable[[dict[str, str]], DataFrame]]] = {
        "/v1/datasets": (set(), set(), lambda q: archive.datasets()),
        "/v1/scopes": ({"dataset"}, set(), lambda q: archive.list_scopes(q["dataset"])),
        "/v1/snapshots/raw": ({"dataset"}, {"date"}, lambda q: archive.raw_snapshots(q["dataset"], q.get("date")).drop("objects")),
        "/v1/snapshots/replay": ({"dataset"}, set(), lambda q: archive.replay_snapshots(q["dataset"])),
        "/v1/fetch-plan": ({"dataset", "manifest"}, set(), lambda q: archive.fetch_plan(archive.resolve(q["dataset"], q["manifest"]))),
    }

    def handle(path: str, query: dict[str, list[str]]) -> tuple[int, dict]:
        try:
            if path.startswith("/v1/manifests/"):
                digest = strict_query({"manifest": [path.removeprefix("/v1/manifests/")]}, {"manifest"})["manifest"]
                strict_query(query, set())
                return 200, {"items": [archive.manifest(digest)], "next_cursor": None}
            if path == "/v1/health":
                strict_query(query, set())
                if health is None:
                    raise ReadError("unavailable", "no health source")
                return 200, {"items": [health()], "next_cursor": None}
            if path not in routes:
                raise ReadError("not_found", path)
            required, optional, rows = routes[path]
            return 200, {"items": items(rows(strict_query(query, required, optional)), most), "next_cursor": None}
        except ReadError as bad:
            return bad.status, {"error": bad.code}

    return handle


def http(archive: Archive, limits: dict[str, int], health: Callable[[], dict[str, Any]] | None = None) -> Callable[[str, str, dict[str, list[str]], bytes], tuple[int, dict]]:
    """A request handler (method, path, query, body) -> (status, body) with the published routes.

    GET /v1/datasets, /v1/datasets/DATASET/scopes, /v1/snapshots/raw, /v1/snapshots/replay, /v1/manifests/DIGEST, /v1/health; POST /v1/fetch-plans
    with {"kind": "raw" or "replay", "selector": {"manifest": DIGEST}}. At most max_concurrent_requests run at a time; one that takes longer than
    request_timeout_ms is given up, and its Spark jobs are cancelled.
    """
    inner = api(archive, limits["max_api_response_items"], health)
    slots = threading.BoundedSemaphore(limits["max_concurrent_requests"])
    workers = ThreadPoolExecutor(limits["max_concurrent_requests"])
    spark = archive.scopes.sparkSession

    def scoped(rows: DataFrame, q: dict[str, str]) -> DataFrame:
        """The rows of the query's scope; a scope that is none of the dataset's is not found."""
        only(archive.list_scopes(q["dataset"]).where((F.col("provider_id") == q["source"]) & (F.col("symbol") == q["symbol"])).select("scope_key"))
        for name in ("provider_id", "symbol"):
            if name in rows.columns:
                rows = rows.where(F.col(name) == q["source" if name == "provider_id" else name])
        return rows

    def answer(path: str, query: dict[str, list[str]], body: bytes, method: str) -> tuple[int, dict]:
        try:
            parts = path.split("/")
            if path == "/v1/fetch-plans":
                if method != "POST":
                    raise ReadError("method_not_allowed")
                strict_query(query, set())
                if len(body) > limits["max_api_request_bytes"]:
                    raise ReadError("too_large")
                try:
                    value = json.loads(body)
                    kind, digest = value["kind"], value["selector"]["manifest"]
                    good = set(value) == {"kind", "selector"} and set(value["selector"]) == {"manifest"} and kind in ("raw", "replay")
                except (ValueError, TypeError, KeyError):
                    good, digest = False, ""
                if not good or not isinstance(digest, str) or not DIGEST.fullmatch(digest):
                    raise ReadError("invalid_request", "body")
                manifest = archive.manifest(digest)
                raw = archive.raw.where(F.col("digest") == digest).limit(1).count() == 1
                if raw != (kind == "raw"):
                    raise ReadError("not_found", digest)
                plan = archive.fetch_plan(manifest) if raw else archive.replay_plan(manifest).select(F.col("part_key").alias("key"), F.col("part_sha256").alias("sha256"), F.col("part_bytes").alias("bytes"))
                found = [r | {"cache_identity": f"{kind}:{r['key']}:{r['sha256']}"} for r in items(plan, limits["max_api_response_items"])]
                return 200, {"items": found, "next_cursor": None}
            if method != "GET":
                raise ReadError("method_not_allowed")
            if len(parts) == 5 and path.startswith("/v1/datasets/") and parts[4] == "scopes":
                strict_query(query, set())
                dataset = strict_query({"dataset": [parts[3]]}, {"dataset"})["dataset"]
                return 200, {"items": items(archive.list_scopes(dataset), limits["max_api_response_items"]), "next_cursor": None}
            if path == "/v1/snapshots/raw":
                q = strict_query(query, {"dataset", "source", "symbol"}, {"date"})
                return 200, {"items": items(scoped(archive.raw_snapshots(q["dataset"], q.get("date")).drop("objects"), q), limits["max_api_response_items"]), "next_cursor": None}
            if path == "/v1/snapshots/replay":
                q = strict_query(query, {"dataset", "source", "symbol", "date", "stream", "conversion"}, {"day_definition"})
                rows = scoped(archive.replay_snapshots(q["dataset"]).where(F.col("date") == q["date"]), q)
                for name, column in (("stream", "replay_contract_id"), ("conversion", "conversion_id"), ("day_definition", "day_definition_id")):
                    if name in q and column in rows.columns:
                        rows = rows.where(F.col(column) == q[name])
                return 200, {"items": items(rows, limits["max_api_response_items"]), "next_cursor": None}
            if path in ("/v1/scopes", "/v1/fetch-plan"):
                raise ReadError("not_found", path)
            return inner(path, query)
        except ReadError as bad:
            return bad.status, {"error": bad.code}

    def handle(method: str, path: str, query: dict[str, list[str]], body: bytes = b"") -> tuple[int, dict]:
        if not slots.acquire(blocking=False):
            return CODES["too_many_requests"], {"error": "too_many_requests"}
        group = f"request-{uuid.uuid4().hex}"

        def run() -> tuple[int, dict]:
            try:
                spark.sparkContext.setJobGroup(group, path, True)
                return answer(path, query, body, method)
            finally:
                slots.release()

        try:
            return workers.submit(run).result(limits["request_timeout_ms"] / 1000)
        except TimeoutError:
            spark.sparkContext.cancelJobGroup(group)
            return CODES["timeout"], {"error": "timeout"}

    return handle


def serve(handle: Callable[[str, str, dict[str, list[str]], bytes], tuple[int, dict]], port: int = 0, max_body: int = 1 << 20) -> ThreadingHTTPServer:
    """An HTTP server on this host for a handler; call serve_forever() and shutdown() on it."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self) -> None:
            where = urllib.parse.urlsplit(self.path)
            size = int(self.headers.get("Content-Length") or 0)
            body = self.rfile.read(min(size, max_body + 1))
            status, value = handle(self.command, urllib.parse.unquote(where.path), urllib.parse.parse_qs(where.query, keep_blank_values=True), body)
            data = json.dumps(value, sort_keys=True, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = do_PUT = do_DELETE = _answer

        def log_message(self, *_: object) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
