"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode`` adds the ids of every whole text, ``decode`` turns ids back into bytes. A null text is an
empty text: no ids, no bytes. A text of any length is cut at safe boundaries only, so that its ids
are those of the uncut text; a stretch without a single blank or line end is encoded whole, whatever its
length. Repeated rows are encoded each on their own, an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices

#: Texts of more characters are cut before they are encoded.
LONG = 1 << 16
#: A single blank between two other characters that are no white space: no match of the pattern spans the place before it,
#: for a blank only starts a match and nothing that ends before it looks further. Likewise the place after a single line end.
SAFE = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])|(?<=[^\s\x1c-\x1f\x85]\n)(?=[^\s\x1c-\x1f\x85])")


@functools.lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str):
    """The tiktoken encoding of a rank file, and the bytes of each id."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), {v: k for k, v in ranks.items()}


def cut(text: str, size: int = LONG) -> list[str]:
    """text in pieces of about size characters, cut where the pattern's matches end; a stretch without such a place stays whole."""
    pieces, start = [], 0
    while len(text) - start > size:
        place = SAFE.search(text, start + size)
        if place is None:
            break
        pieces.append(text[start : place.start()])
        start = place.start()
    return [*pieces, text[start:]]


def ids_of(text: str, ranks_path: str, pattern: str) -> np.ndarray:
    own, _ = encoding(ranks_path, pattern)
    if len(text) <= LONG:
        return own.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([own.encode_to_numpy(piece, disallowed_special=()) for piece in cut(text)])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with the column ids (array of int): each match of the pattern encoded by the ranks, no special tokens."""
    schema = T.StructType([*(f for f in docs.schema if f.name != ids), T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    keep = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            found = [ids_of(x or "", ranks_path, pattern) for x in batch.column(text).to_pylist()]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) for x in found], out=offsets[1:])
            values = pa.array(np.concatenate(found).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], names=[*keep, ids])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """encoded with the column out (binary): the bytes of the ids, joined; they need not be valid UTF-8."""
    schema = T.StructType([*(f for f in encoded.schema if f.name != out), T.StructField(out, T.BinaryType(), False)])
    keep = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, of = encoding(ranks_path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch.column(ids)
                values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                texts = [b"".join(map(of.__getitem__, values[a:b].tolist())) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.binary())], names=[*keep, out])

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text."""
    ids = encode(docs.select("doc_id", "text"), ranks_path, pattern).drop("text")
    ids = ids.select("doc_id", "ids", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"))
    done = decode(ids, ranks_path, pattern)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
