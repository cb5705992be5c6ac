"""A store of immutable objects in a folder that tasks and the driver reach: put if absent, bounded reading and listing, verification.

The folder is a URI or path that pyarrow's file systems know (local, HDFS, S3, GCS). An object is written
under a temporary name, read back, published without replacing anything, and read back again; whatever
happens in between, the outcome is found by looking. Nothing is ever overwritten.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from tidemark.functions import codec as C
from tidemark.functions import domains as D

#: The bytes that stay as they are in an exact path component.
PLAIN = re.compile(rb"[A-Za-z0-9\-_.*'()]")


class StoreError(Exception):
    """What went wrong with an object; kind decides whether it is tried again."""

    def __init__(self, kind: str, detail: str = ""):
        super().__init__(f"{kind}: {detail}")
        self.kind = kind


#: Classes of publication failures, and those that are tried again.
CLASSES = {"collision": "collision", "publisher_conflict": "collision", "check_mismatch": "remote_integrity", "permission": "permission", "integrity": "local_integrity", "local_changed": "local_integrity", "resource_limit": "local_integrity", "timeout": "remote_timeout"}
AGAIN = ("remote_timeout", "remote_transient")


def classified(error: BaseException) -> tuple[str, bool]:
    """The class of a failed publication, and whether it is tried again."""
    if isinstance(error, StoreError):
        name = CLASSES.get(error.kind, "remote_transient")
    elif isinstance(error, PermissionError):
        name = "permission"
    elif isinstance(error, TimeoutError):
        name = "remote_timeout"
    elif isinstance(error, (C.FormatError, ValueError)):
        name = "local_integrity"
    else:
        name = "remote_transient"
    return name, name in AGAIN


def exact_component(value: str) -> str:
    """value as one component of a path: each byte that is not plain as ! and two digits, so nothing is folded or lost."""
    return "".join(chr(b) if PLAIN.match(bytes([b])) else f"!{b:02X}" for b in value.encode())


def relative_key(key: str) -> str:
    """key, if it is a path below the root without anything that leads out of it."""
    parts = key.split("/")
    if not key or len(key.encode()) > D.MAX_PATH or "\\" in key or any(p in ("", ".", "..") for p in parts) or any(ord(c) < 32 or ord(c) == 127 for c in key):
        raise StoreError("integrity", f"key {key!r}")
    return key


@dataclass(frozen=True)
class Layout:
    """Where a scope's objects lie: below an immutable root, by provider and symbol."""

    root: str
    config: dict[str, Any]

    def __post_init__(self) -> None:
        if not self.root or any(c in self.root for c in "\\\r\n") or self.root.startswith("//"):
            raise StoreError("integrity", "remote root")

    @property
    def prefix(self) -> str:
        return f"source={exact_component(self.config['provider_id'])}/symbol={exact_component(self.config['exact_source_symbol'])}"

    def key(self, relative: str) -> str:
        return "/".join(x for x in (self.root.strip("/"), self.prefix, relative_key(relative)) if x)

    def descriptor(self) -> str:
        return self.key("scope-descriptor-v1.json")

    def claim(self) -> str:
        return self.key(f"publisher-claims/epoch={self.config['publisher_epoch']}.json")

    def raw_object(self, key: str, sha256: str) -> str:
        if key != f"objects/raw/wal-{sha256}.rtw":
            raise StoreError("integrity", "raw object key does not match its hash")
        return self.key(key)

    def raw_manifest(self, date: str, revision: int, digest: str) -> str:
        from tidemark.operators.archive import manifest_key

        return self.key(manifest_key(self.config["day_definition_id"], date, revision, digest))

    def relative(self, full: str) -> str:
        """The scope's own key of a full one; a full key of another root or scope is an integrity error."""
        start = self.key("_")[:-1]
        if not full.startswith(start):
            raise StoreError("integrity", f"{full} lies outside the layout")
        return relative_key(full[len(start) :])


@dataclass
class FolderStore:
    """Objects by key below a folder. fault is called at each step, for tests."""

    folder: str
    fault: Callable[[str, str], None] = lambda step, key: None

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.folder or self.folder.startswith("file:"):
            return fs.FileSystem.from_uri(self.folder)
        return fs.LocalFileSystem(), self.folder

    def get(self, key: str, most: int = 1 << 31) -> bytes | None:
        """The object's bytes, or None; one of more than most bytes is refused before it is read."""
        store, base = self._open()
        info = store.get_file_info(f"{base}/{relative_key(key)}")
        if info.type != fs.FileType.File:
            return None
        if info.size > most:
            raise StoreError("resource_limit", f"{key} has {info.size} bytes")
        with store.open_input_stream(info.path) as stream:
            return stream.read()

    def keys(self, prefix: str, most: int) -> list[tuple[str, int]]:
        """Key and size of each object below prefix, in order; more than most are refused, not cut off."""
        store, base = self._open()
        where = f"{base}/{relative_key(prefix.rstrip('/'))}" if prefix else base
        found = [(i.path[len(base) :].lstrip("/"), i.size) for i in store.get_file_info(fs.FileSelector(where, allow_not_found=True, recursive=True)) if i.type == fs.FileType.File and ".tmp-" not in i.base_name]
        if len(found) > most:
            raise StoreError("resource_limit", f"more than {most} objects below {prefix!r}")
        return sorted(found)

    def observe(self, key: str, sha256: str, size: int, most: int = 1 << 31) -> str:
        """The class of what is stored under key: Exact, Absent, Different, Oversized or Unavailable."""
        try:
            data = self.get(key, most)
        except StoreError as bad:
            if bad.kind == "resource_limit":
                return "Oversized"
            raise
        except OSError:
            return "Unavailable"
        if data is None:
            return "Absent"
        return "Exact" if len(data) == size and hashlib.sha256(data).hexdigest() == sha256 else "Different"

    def verify(self, key: str, data: bytes) -> None:
        """Raise unless the object has exactly these bytes."""
        if self.get(key) != data:
            raise StoreError("check_mismatch", key)

    def put_if_absent(self, key: str, data: bytes) -> bool:
        """Publish an object that must not exist yet, or exist with the same bytes; whether it is new."""
        store, base = self._open()
        old = self.get(key)
        if old is not None:
            if old != data:
                raise StoreError("collision", key)
            return False
        where = f"{base}/{key}"
        temporary = f"{where}.tmp-{uuid.uuid4().hex}"
        store.create_dir(where.rsplit("/", 1)[0], recursive=True)
        try:
            with store.open_output_stream(temporary) as stream:
                stream.write(data)
            self.fault("written", key)
            with store.open_input_stream(temporary) as stream:
                if stream.read() != data:
                    raise StoreError("check_mismatch", f"{key} after writing")
            new = self._publish(store, temporary, where)
            self.fault("published", key)
        except StoreError:
            raise
        except Exception:
            if self.get(key) == data:  # the outcome was unknown: it is there
                return True
            raise
        finally:
            if store.get_file_info(temporary).type == fs.FileType.File:
                store.delete_file(temporary)
        old = self.get(key)
        if old != data:
            raise StoreError("collision" if old is not None and not new else "check_mismatch", key)
        return new

    def _publish(self, store: fs.FileSystem, temporary: str, where: str) -> bool:
        """Give the file its name unless another has it: by a link where the file system has links, else by a move after a last look."""
        if isinstance(store, fs.LocalFileSystem):
            try:
                os.link(temporary, where)
                return True
            except FileExistsError:
                return False
        if store.get_file_info(where).type == fs.FileType.File:
            return False
        store.move(temporary, where)
        return True


def put_all(objects: DataFrame, folder: str, key: str = "key", data: str = "data") -> DataFrame:
    """Publish each row's bytes from the tasks: key, sha256, bytes and created of each. It happens when the rows are read, and may happen again."""
    schema = pa.schema([("key", pa.string()), ("sha256", pa.string()), ("bytes", pa.int64()), ("created", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = FolderStore(folder)
        for batch in batches:
            for k, value in zip(batch.column("key").to_pylist(), batch.column("data"), strict=True):
                content = value.as_py()
                new = store.put_if_absent(k, content)
                yield pa.RecordBatch.from_pylist([{"key": k, "sha256": hashlib.sha256(content).hexdigest(), "bytes": len(content), "created": new}], schema=schema)

    return objects.selectExpr(f"`{key}` AS key", f"`{data}` AS data").mapInArrow(run, "key string, sha256 string, bytes long, created boolean")


def fetch_all(plan: DataFrame, folder: str, into: str) -> DataFrame:
    """Copy the plan's objects (key, sha256, bytes) from one store to another from the tasks; each is verified on both sides, one that differs fails the query."""
    schema = pa.schema([("key", pa.string()), ("sha256", pa.string()), ("bytes", pa.int64()), ("created", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, there = FolderStore(folder), FolderStore(into)
        for batch in batches:
            for row in batch.to_pylist():
                data = here.get(row["key"], row["bytes"])
                if data is None or len(data) != row["bytes"] or hashlib.sha256(data).hexdigest() != row["sha256"]:
                    raise StoreError("check_mismatch", row["key"])
                yield pa.RecordBatch.from_pylist([row | {"created": there.put_if_absent(row["key"], data)}], schema=schema)

    return plan.select("key", "sha256", "bytes").mapInArrow(run, "key string, sha256 string, bytes long, created boolean")
