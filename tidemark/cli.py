"""Command line: what an archive holds, what must be fetched, and whether it verifies.

python -m tidemark.cli --config reader.toml datasets | scopes DATASET | snapshots DATASET [--replay]
    | fetch-plan DATASET SELECTOR | fetch DATASET SELECTOR STORE INTO | verify-day PATH MANIFEST | verify-scope PATH [ROOT]
"""

from __future__ import annotations

import argparse
import json
import sys
import tomllib
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import archive, catalog
from tidemark.sources import wal


@dataclass(frozen=True)
class Config:
    """Where an archive lies and how much of it may be read; unknown keys are rejected. With exact, so are manifests that lack a field or have one more."""

    raw_manifests: str
    scopes: str
    replay_manifests: str = ""
    part_manifests: str = ""
    max_items: int = 1000
    exact: bool = False

    @classmethod
    def load(cls, text: str) -> Config:
        values = tomllib.loads(text)
        known = {f.name: f for f in fields(cls)}
        if unknown := set(values) - set(known):
            raise ValueError(f"unknown keys: {', '.join(sorted(unknown))}")
        own = cls(**values)
        if not own.raw_manifests or not own.scopes or own.max_items < 1:
            raise ValueError("raw_manifests, scopes and a positive max_items are needed")
        return own


def opened(spark: SparkSession, config: Config) -> catalog.Archive:
    replay = catalog.manifests(spark, config.replay_manifests, D.REPLAY_DAY, "replay-day-*.json", config.exact) if config.replay_manifests else None
    parts = catalog.part_manifests(spark, config.part_manifests, config.exact) if config.part_manifests else None
    return catalog.Archive(spark.read.json(config.scopes), catalog.manifests(spark, config.raw_manifests, D.RAW_DAY, exact=config.exact), replay, parts)


def fetched(own: catalog.Archive, dataset: str, selector: str, store: str, into: str, kind: str = "auto") -> DataFrame:
    """The objects of a raw day or the part files of a replay day, copied and checked on both sides."""
    found, manifest = own.resolve_any(dataset, selector, kind)
    if found == "raw":
        return catalog.fetch(own.fetch_plan(manifest), store, into)
    if own.parts is None:
        raise catalog.ReadError("not_found", "part manifests")
    return catalog.fetch_replay(own, manifest, store, into)


def chain(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entries and segments under path by their gateway as scope, every byte verified, hashes in hexadecimal."""
    hexed = lambda *names: (F.lower(F.hex(c)).alias(c) for c in names)
    own = wal.segments(spark, path).select(F.col("gateway_instance_id").alias("scope"), "object_key", "file_bytes", *(F.col(c).cast("long").alias(c) for c in ("start_sequence", "last_sequence")), *hexed("object_sha256", "chain_start", "chain_root"))
    rows = wal.entries(spark, path).join(own.select("scope", "object_key"), "object_key").select("scope", "object_key", F.col("sequence").cast("long").alias("sequence"), F.lower(F.hex("previous_entry_hash")).alias("previous_hash"), F.lower(F.hex("entry_hash")).alias("entry_hash"))
    return rows, own


def verify_scope(spark: SparkSession, path: str, root: str | None = None) -> dict[str, Any]:
    """Facts of all segments under path: every byte is verified; chained: each gateway's from number 1 after the zero hash without a break up to the root, which is its last one unless given."""
    rows, own = chain(spark, path)
    last = own.groupBy("scope").agg(F.count("*").alias("segments"), F.sum(F.col("last_sequence") - F.col("start_sequence") + 1).alias("entries"), F.max_by("chain_root", "start_sequence").alias("root"))
    roots = last.select("scope", (F.lit(root) if root else F.col("root")).alias("root"))
    facts = archive.verify_scope(rows, roots, "scope").agg(*(F.min(F.col(k).cast("int")).alias(k) for k in ("from_genesis", "unbroken", "reached"))).first()
    found = {k: facts[k] == 1 for k in ("from_genesis", "unbroken", "reached")}
    total = last.agg(F.coalesce(F.sum("segments"), F.lit(0)).alias("segments"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), F.max("root").alias("root")).first()
    return {"segments": total["segments"], "entries": total["entries"], "root": root or total["root"] or D.ZERO.hex(), **found, "chained": all(found.values())}


def verify_day(spark: SparkSession, path: str, manifest_path: str) -> dict[str, Any]:
    """Facts of a raw day's manifest (a file) against one gateway's segments under path; the chain is proved from the manifest's own first root, not from its beginning."""
    with open(manifest_path, "rb") as f:
        data = f.read()
    value = C.parse_canonical(data, set(archive.DAY_KEYS))
    rows, own = chain(spark, path)
    gateways = [r[0] for r in own.select("scope").distinct().limit(2).collect()]
    if len(gateways) != 1:
        raise catalog.ReadError("conflict", "segments of one gateway are needed")
    found = archive.records(wal.entries(spark, path)).withColumn("scope", F.lit(gateways[0]))
    facts = archive.verify_days(archive.parsed(spark, [(gateways[0], data)]), found, rows, own, "scope").first()
    return {"genesis_verified": False, "date": value["date"], "revision": value["revision"], "manifest_sha256": C.sha(D.RAW_DAY, data).hex()} | {k: bool(facts[k]) for k in ("present", "contiguous", "anchored", "selected", "ranges", "valid")}


def main(arguments: list[str], spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--config")
    parser.add_argument("command", choices=["datasets", "scopes", "snapshots", "fetch-plan", "fetch", "verify-day", "verify-scope"])
    parser.add_argument("values", nargs="*")
    parser.add_argument("--replay", action="store_true")
    parser.add_argument("--kind", choices=["auto", "raw", "replay"], default="auto")
    given = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName("tidemark").getOrCreate()
    try:
        if given.command.startswith("verify"):
            facts = (verify_day if given.command == "verify-day" else verify_scope)(spark, *given.values)
            print(json.dumps(facts, sort_keys=True))
            return 0 if facts.get("chained", facts.get("valid")) else 1
        with open(given.config) as f:
            config = Config.load(f.read())
        own = opened(spark, config)
        rows = {
            "datasets": lambda: own.datasets(),
            "scopes": lambda: own.list_scopes(*given.values),
            "snapshots": lambda: (own.replay_snapshots if given.replay else own.raw_snapshots)(*given.values),
            "fetch-plan": lambda: own.fetch_plan(own.resolve(*given.values[:2])),
            "fetch": lambda: fetched(own, *given.values, kind=given.kind),
        }[given.command]()
        print(json.dumps({"items": catalog.items(rows, config.max_items)}, sort_keys=True, default=str))
        return 0
    except catalog.ReadError as bad:
        print(json.dumps({"error": bad.code}), file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
