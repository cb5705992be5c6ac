"""Replay parts: Parquet files with the contract's exact types, written row by row from the reducer and verified after reading.

Unsigned and fixed-length types are beyond Spark's own writer, so pyarrow makes the bytes of a part inside
the task that reduces the day. A part is bounded by its limits; the file's hash names it. Equality with
other writers is logical: rows, chain and roots, not file bytes.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import continuity
from tidemark.operators.publication import derivative_base

KINDS = {"u8": pa.uint8(), "u16": pa.uint16(), "u32": pa.uint32(), "u64": pa.uint64(), "i32": pa.int32(), "i64": pa.int64(), "str": pa.string(), "h32": pa.binary(32)}
HEAD = [("row_kind", "u8"), ("stream_sequence", "u64"), *((n, "str") for n in ("dataset_id", "day_definition_id", "date", "replay_contract_id", "conversion_id", "raw_day_manifest_key")), ("raw_day_manifest_sha256", "h32"), ("continuity_segment_id", "str"), ("previous_row_chain_hash", "h32"), ("row_chain_hash", "h32")]
MARK = [("raw_object_key", "str"), ("raw_object_sha256", "h32"), *C.MARK]
SCHEMA = pa.schema([pa.field(n, KINDS[k], False) for n, k in HEAD] + [pa.field("data", pa.struct([pa.field(n, KINDS[k], False) for n, k in C.DATA])), pa.field("marker", pa.struct([pa.field(n, KINDS[k], False) for n, k in MARK]))])
PARTS = (
    "scope string, day string, part_sequence long, part_key string, part_sha256 string, part_bytes long, row_count long, canonical_row_bytes long, first_stream_sequence long, last_stream_sequence long, "
    "previous_row_chain_hash string, first_row_chain_hash string, last_row_chain_hash string, content binary"
)
ARROW = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in PARTS.split(", ")])


def parquet_row(scope: dict[str, Any], row: dict[str, Any]) -> dict[str, Any]:
    """A reducer's row as a row of the file: one of data and marker is set, as row_kind says."""
    head = {n: scope[n] for n, _ in HEAD if n in scope} | {"row_kind": row["row_kind"], "stream_sequence": row["stream_sequence"], "continuity_segment_id": row["segment"], "previous_row_chain_hash": row["previous"], "row_chain_hash": row["hash"]}
    data = row["row_kind"] == 1
    return head | {"data": {n: row[n] for n, _ in C.DATA} if data else None, "marker": None if data else {n: row[n] for n, _ in MARK}}


def part_bytes(rows: list[dict[str, Any]]) -> bytes:
    out = io.BytesIO()
    pq.write_table(pa.Table.from_pylist(rows, schema=SCHEMA), out, compression="none", use_dictionary=False, data_page_version="1.0", write_statistics=True, data_page_size=1 << 18)
    return out.getvalue()


def verify(content: bytes, sha256: str, first: int, previous: bytes) -> tuple[int, int, bytes]:
    """Rows, canonical bytes and last hash of a part; raises unless hash, schema, numbers and chain hold."""
    if hashlib.sha256(content).hexdigest() != sha256:
        raise C.FormatError("INVALID_FIELD", "part hash")
    table = pq.read_table(io.BytesIO(content))
    if not table.schema.equals(SCHEMA):
        raise C.FormatError("INVALID_FIELD", "part schema")
    total = 0
    for k, row in enumerate(table.to_pylist()):
        marker = row["row_kind"] == 2
        if row["row_kind"] not in (1, 2) or (row["data"] is None) != marker or (row["marker"] is None) == marker or row["stream_sequence"] != first + k or row["previous_row_chain_hash"] != previous:
            raise C.FormatError("INVALID_FIELD", f"row {first + k}")
        body = row["marker"] if marker else row["data"]
        if not marker and C.payload_fingerprint(body) != body["source_payload_fingerprint"]:
            raise C.FormatError("INVALID_FIELD", f"row {first + k}: fingerprint")
        data = C.row_bytes(row, row["stream_sequence"], row["continuity_segment_id"], body, marker)
        previous = C.chain_step(row["stream_sequence"], previous, data)
        if previous != row["row_chain_hash"]:
            raise C.FormatError("INVALID_FIELD", f"row {first + k}: chain")
        total += len(data)
    return table.num_rows, total, previous


def build(batches: DataFrame, scope: dict[str, Any], identity: dict[str, str], max_rows: int = 1_000_000, max_bytes: int = 1 << 26) -> DataFrame:
    """The parts of each scope and day, verified, with their bytes; input as for continuity.replay(). A task holds the rows of one part."""

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, []

        def closed(own: dict[str, Any]) -> pa.RecordBatch:
            content = part_bytes([parquet_row(own, r) for r in held])
            digest, first = hashlib.sha256(content).hexdigest(), held[0]["stream_sequence"]
            n, total, last = verify(content, digest, first, held[0]["previous"])
            if last != held[-1]["hash"]:
                raise C.FormatError("INVALID_FIELD", "part chain")
            row = {
                "scope": own["dataset_id"], "day": own["date"], "part_sequence": number, "part_key": f"{derivative_base(own)}/parquet/{first}-{held[-1]['stream_sequence']}-{digest}.parquet", "part_sha256": digest, "part_bytes": len(content),
                "row_count": n, "canonical_row_bytes": total, "first_stream_sequence": first, "last_stream_sequence": held[-1]["stream_sequence"], "previous_row_chain_hash": held[0]["previous"].hex(),
                "first_row_chain_hash": held[0]["hash"].hex(), "last_row_chain_hash": last.hex(), "content": content,
            }
            return pa.RecordBatch.from_pylist([row], schema=ARROW)

        size, own = 0, None
        for own, row in continuity.reduced(group, scope, identity):
            if row["canonical_bytes"] > max_bytes:
                raise C.FormatError("INVALID_FIELD", "a row is larger than a part")
            if held and (len(held) >= max_rows or size + row["canonical_bytes"] > max_bytes):
                yield closed(own)
                number, size, held = number + 1, 0, []
            held.append(row)
            size += row["canonical_bytes"]
        if held:
            yield closed(own)

    return continuity.in_order(batches).groupBy("scope", "day").applyInArrow(run, PARTS)


def checked(parts: DataFrame) -> DataFrame:
    """Parts read back, each verified against its row of facts; a wrong one fails the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, total, last = verify(r["content"], r["part_sha256"], r["first_stream_sequence"], bytes.fromhex(r["previous_row_chain_hash"]))
                if (n, total, last.hex()) != (r["row_count"], r["canonical_row_bytes"], r["last_row_chain_hash"]):
                    raise C.FormatError("INVALID_FIELD", r["part_key"])
            yield batch.drop_columns(["content"])

    schema = PARTS.rsplit(", ", 1)[0]
    return parts.select(*(x.split()[0] for x in PARTS.split(", "))).mapInArrow(run, schema)


def put_if_absent(spark, where: str, data: bytes) -> bool:
    """Write a file that must not exist yet, in any store that Spark reaches; an existing one must have the same bytes. Whether it was written.

    The bytes get their name by a rename when they are whole, so a crash leaves no short file under it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def same() -> bool:
        old = spark.read.format("binaryFile").load(where).select("content").first()["content"]
        if bytes(old) != data:
            raise C.FormatError("INVALID_FIELD", f"{where} exists with other bytes")
        return True

    if store.exists(path):
        return not same()
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{where}.tmp-{uuid.uuid4().hex}")
    stream = store.create(temporary, False)
    stream.write(data)
    stream.close()
    moved = store.rename(temporary, path)
    if not moved:
        store.delete(temporary, False)
    same()
    return bool(moved)


def store(parts: DataFrame, folder: str) -> int:
    """Parts under their keys, written by the tasks; the number that is new."""
    from pyspark.sql import functions as F

    from tidemark.sources.store import put_all

    return put_all(parts, folder, "part_key", "content").agg(F.count(F.when(F.col("created"), 1))).first()[0]


def claim(scope: dict[str, Any]) -> tuple[bytes, str]:
    """Canonical bytes and digest of a publisher's claim of a scope."""
    data = C.canonical_json(scope)
    return data, C.sha(D.CLAIM, data).hex()


def receipt(bundle_digest: str, observation_digest: str, manifest_key: str) -> bytes:
    """Canonical bytes of the receipt of a verified publication; all three must be bound."""
    if any(len(x) != 64 or set(x) == {"0"} for x in (bundle_digest, observation_digest)):
        raise C.FormatError("INVALID_FIELD", "receipt digests")
    return C.canonical_json({"bundle_digest": bundle_digest, "final_observation_digest": observation_digest, "manifest_key": manifest_key, "verification_complete": True})


def bundle(value: dict[str, Any], limits: dict[str, int]) -> tuple[bytes, str]:
    """Canonical bytes and digest of a publication bundle; its limits must be nonzero, consistent and enough for its parts."""
    names = {"max_metadata_object_bytes", "max_total_metadata_bytes", "max_parquet_object_bytes", "max_total_parquet_bytes", "max_list_objects", "max_graph_nodes", "max_parts", "max_observation_bytes", "max_observation_requests", "max_publication_rounds"}
    parts = len(value["part_manifests"])
    good = set(limits) == names and all(limits[n] > 0 for n in names) and limits["max_metadata_object_bytes"] <= limits["max_total_metadata_bytes"] and limits["max_parquet_object_bytes"] <= limits["max_total_parquet_bytes"]
    if not good or parts > limits["max_parts"] or 2 * parts + 2 > limits["max_publication_rounds"]:
        raise C.FormatError("INVALID_FIELD", "bundle limits")
    data = C.canonical_json(value | {"limits": limits})
    return data, C.sha(D.BUNDLE, data).hex()


def final_observation(value: dict[str, Any]) -> tuple[bytes, str]:
    """Canonical bytes and digest of a complete observation."""
    if value.get("complete") is not True:
        raise C.FormatError("INVALID_FIELD", "observation is not complete")
    data = C.canonical_json(value)
    return data, C.sha(D.FINAL_OBSERVATION, data).hex()
