"""Health of scopes, status of the whole, and scopes that would get into each other's way."""

from __future__ import annotations

import contextlib
import ipaddress
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec as C

#: What two scopes may not share, and paths that may not lie in one another.
EXCLUSIVE, PATHS = ("scope_key", "listener", "publisher_id", "credential_id"), ("wal_dir", "spool_dir")


def overall(status: Column) -> Column:
    """Of an array of states: the worst one counts."""
    return F.when(F.array_contains(status, "failed"), "failed").when(F.array_contains(status, "blocked"), "blocked").when(F.array_contains(status, "degraded"), "degraded").otherwise("healthy")


def address(value: str | None) -> str | None:
    """A listener in one spelling, host and port with a blank between: a wildcard host is *, localhost its address, IP addresses are written shortest. What has no valid port stays as it is."""
    host, colon, port = (value or "").strip().rpartition(":")
    if not colon or not re.fullmatch(r"[0-9]{1,5}", port) or not 0 < int(port) < 65536 or host.startswith("[") != host.endswith("]"):
        return value
    host = host.removeprefix("[").removesuffix("]").removesuffix(".").lower()
    if host in ("", "0.0.0.0", "::"):
        host = "*"
    elif host == "localhost":
        host = "127.0.0.1"
    else:
        with contextlib.suppress(ValueError):
            ip = ipaddress.ip_address(host)
            host = str(getattr(ip, "ipv4_mapped", None) or ip)
    return f"{host} {int(port)}"


def _addresses(values: pd.Series) -> pd.Series:
    return values.map(address)


def clean_path(path: Column, folder: str = "/") -> Column:
    """The absolute path without empty, . and .. steps; a relative one lies in folder."""
    whole = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path))

    def step(kept: Column, part: Column) -> Column:
        return F.when(part.isin("", "."), kept).when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(part)))

    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(whole, "/"), F.array().cast("array<string>"), step), "/"))


def collisions(scopes: DataFrame, folder: str = "/") -> DataFrame:
    """left, right and what they share, however it is spelled. Equal values meet in an equi-join, a listener on all hosts meets those of its port,
    nested paths meet by the folders above them: scopes are never all paired. Relative paths lie in folder."""
    found = []
    scopes = scopes.select("*", *(clean_path(F.col(c), folder).alias(f"_{c}") for c in PATHS)).withColumn("listener", F.pandas_udf(_addresses, "string")("listener"))
    for column in EXCLUSIVE:
        a, b = scopes.select(F.col("scope").alias("left"), F.col(column).alias("v")), scopes.select(F.col("scope").alias("right"), F.col(column).alias("v"))
        found.append(a.join(b, "v").where("left < right").select("left", "right", F.lit(column).alias("shared")))
    ports = scopes.select("scope", F.split("listener", " ").alias("v")).where(F.size("v") == 2).select("scope", F.col("v")[0].alias("host"), F.col("v")[1].alias("port"))
    every_host = ports.where("host = '*'").select(F.col("scope").alias("a"), "port").join(ports.select(F.col("scope").alias("b"), "port"), "port").where("a <> b")
    found.append(every_host.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), F.lit("listener").alias("shared")))
    every = scopes.select("scope", F.explode(F.array(*(f"_{c}" for c in PATHS))).alias("path"))
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    above = every.select(F.col("scope").alias("a"), F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/")))).alias("path"))
    nested = above.join(every.withColumnRenamed("scope", "b"), "path").where("a <> b")
    found.append(nested.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), F.lit("path").alias("shared")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def scope_health(health: DataFrame) -> DataFrame:
    """One row a scope with its overall state, in order; a scope that reports twice is an error."""
    rows = health.groupBy("scope").agg(F.count("*").alias("n"), F.first("states").alias("states"))
    rows = rows.where(F.when(F.col("n") == 1, True).otherwise(F.raise_error(F.lit("a scope reports twice")).cast("boolean")))
    return rows.select("scope", overall(F.col("states")).alias("status")).orderBy("scope")


def ready(free: Column, poisoned: Column, pending: Column, pending_bytes: Column, policy: dict[str, int]) -> Column:
    """Whether data may be acknowledged: there is room, no append has failed, and the backlog is within limits."""
    room = F.coalesce(free >= policy["critical"], F.lit(False))
    full = F.lit(bool(policy.get("max_pending"))) & ((pending >= policy.get("max_pending", 0)) | (pending_bytes >= policy.get("max_pending_bytes", 0)))
    return room & ~poisoned & ~full


#: The fields of the resource limits, and of a scope of the inventory.
LIMIT_KEYS = ("limits_version", "max_api_request_bytes", "max_api_response_items", "max_concurrent_requests", "max_manifest_nodes", "max_proof_bytes", "max_proof_objects", "max_prune_candidates", "request_timeout_ms")
SCOPE_KEYS = ("credential_id", "listener", "publisher_id", "scope", "scope_key", "spool_dir", "wal_dir")


def resource_limits(data: bytes) -> dict[str, int]:
    """The limits of a canonical document: every field, none else, all positive."""
    value = C.parse_canonical(data, set(LIMIT_KEYS))
    if value.pop("limits_version") != "m4-operational-limits-v1" or not all(isinstance(v, int) and not isinstance(v, bool) and v > 0 for v in value.values()):
        raise C.FormatError("INVALID_FIELD", "resource limits")
    return value


def scope_inventory(spark: SparkSession, data: bytes, most: int = 10_000) -> DataFrame:
    """The scopes of a canonical inventory, which names each once; scopes that would get into each other's way are an error."""
    value = C.parse_canonical(data, {"inventory_version", "scopes"})
    rows = value["scopes"]
    if value["inventory_version"] != "scope-inventory-v1" or not 0 < len(rows) <= most or any(set(r) != set(SCOPE_KEYS) or not all(isinstance(v, str) and v for v in r.values()) for r in rows):
        raise C.FormatError("INVALID_FIELD", "inventory")
    names = [r["scope"] for r in rows]
    if names != sorted(set(names)):
        raise C.FormatError("INVALID_FIELD", "scopes are not sorted and distinct")
    found = spark.createDataFrame([tuple(r[k] for k in SCOPE_KEYS) for r in rows], ", ".join(f"{k} string" for k in SCOPE_KEYS))
    if clash := collisions(found).take(1):
        raise C.FormatError("INVALID_FIELD", f"{clash[0]['left']} and {clash[0]['right']} share {clash[0]['shared']}")
    return found


def supervisor_plan(scopes: DataFrame, running: DataFrame) -> DataFrame:
    """What is to be done for each scope: start what is not running (scope), stop what is no scope any more, keep the rest."""
    want, have = scopes.select("scope").distinct().withColumn("_w", F.lit(True)), running.select("scope").distinct().withColumn("_h", F.lit(True))
    action = F.when(F.col("_h").isNull(), "start").when(F.col("_w").isNull(), "stop").otherwise("keep")
    return want.join(have, "scope", "full_outer").select("scope", action.alias("action")).orderBy("scope")


#: Classes of the last error of a publication, those after which nothing may go on, and those that pass.
ERRORS = ("remote_transient", "remote_timeout", "permission", "collision", "local_integrity", "remote_integrity")
FATAL, PASSING = ("collision", "local_integrity", "remote_integrity"), ("remote_transient", "remote_timeout", "permission")
#: What the names of a scope's services begin with.
SERVICES = {"gateway_service_name": "tick-gateway-", "mql_service_name": "tick-mql-"}


def application_status(found: DataFrame) -> DataFrame:
    """found, what ingest, publication and disk of each application say, with last_error_class as it may be shown, and overall.

    An error of integrity has failed, whatever else is said. Then what may not acknowledge is blocked, and what is short of disk, has
    work that waits, cannot reach its store or met an error that passes is degraded. What is not known counts against it.
    """
    sure = lambda c: F.coalesce(F.col(c), F.lit(False))
    error = F.coalesce(F.col("last_error_class"), F.lit(""))
    shown = F.when(error.isin("", *ERRORS), error).otherwise("unknown")
    slow = (F.coalesce(F.col("disk_class"), F.lit("high")) == "high") | F.coalesce(F.col("worker_priority"), F.lit(True))
    waits = (F.coalesce(F.col("pending_bytes"), F.lit(1)) != 0) | (F.coalesce(F.col("pending_manifests"), F.lit(1)) != 0)
    overall_of = F.when(shown.isin(*FATAL), "failed").when(~(sure("ready_for_ack") & sure("disk_ready") & sure("ack_allowed")), "blocked").when(slow | ~sure("remote_available") | shown.isin(*PASSING) | waits, "degraded").otherwise("healthy")
    return found.withColumns({"last_error_class": shown, "overall": overall_of})


def supervisor_units(scopes: DataFrame) -> DataFrame:
    """One unit a scope, in the order of scope_key (64 hexadecimal digits): the names of its services, its listener and configurations."""
    names = {n: F.concat(F.lit(start), F.substring("scope_key", 1, 16)) for n, start in SERVICES.items()}
    rows = scopes.select("scope_key", *(v.alias(n) for n, v in names.items()), F.col("listener").alias("listen_address"), "gateway_config_path", "mql_config_path")
    good = F.when(F.col("scope_key").rlike("^[0-9a-f]{64}$"), True).otherwise(F.raise_error(F.lit("a scope key is no hash")).cast("boolean"))
    return rows.where(good).orderBy("scope_key")
