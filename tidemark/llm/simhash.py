"""SimHash near-duplicates with pigeonring filtering of the candidates.

A fingerprint has 64 bits, cut into a ring of segments. If two fingerprints differ in few bits, some
segment starts a chain along the ring in which, for every length l, the first l segments differ in at
most l/m of the allowed bits (the pigeonring principle). The first two lengths are part of the join
key, the others prune candidates before the full Hamming check.

A null text is an empty text. A text without words has fingerprint zero, linked like any other. Rows
without an id get a fingerprint but link with nothing; rows that repeat an id are one node. Copies of
a fingerprint are compared once. Empty tables give empty results; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, discard, local_components, slices, unused, written

#: Widths of the ring's segments, from the lowest bit up.
WIDTHS = (13, 13, 13, 13, 12)
KEYS = "key long, probe int, fp long, rep long"
EDGES = "src long, dst long"
#: Pairs that are compared at a time; rows of a key beyond which it is cut into blocks, of which each pair is compared on its own.
PAIRS, BLOCK = 1 << 20, 1 << 15


def fingerprint(text: bytes, size: int, seed: int) -> np.ndarray:
    """Hashes of the shingles of size words, repeats included."""
    import xxhash

    words = text.lower().split()  # bytes: lowers A-Z and splits at 0x20 and 0x09-0x0D only
    if not words:
        return np.zeros(0, np.uint64)
    joined, of = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([of(joined, seed)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    return np.array([of(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed 64-bit integer."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 4, seed: int = 42, extra: str = "") -> DataFrame:
    """doc_id and fp, the SimHash of the whole text's word shingles hashed with XXH64; and a column more, a long, if extra names one."""
    names = ["doc_id", *([extra] if extra else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = pa.array([majority(fingerprint(x or b"", size, seed)) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), found], names=[*names, "fp"])

    return docs.select(F.col("doc_id").cast("long"), *names[1:], "text").mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


def ring() -> list[tuple[int, int]]:
    """Offset and width of each segment."""
    return [(sum(WIDTHS[:k]), w) for k, w in enumerate(WIDTHS)]


def keys_of(fp: np.ndarray, rep: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """key, probe, fp and rep: for each segment its bits and the next one's, and probes with one unset bit of the next one set.

    Of two fingerprints whose next segments differ in one bit, the one without the bit probes for the
    other. The budget of the first segment is below one bit, that of the first two below two.
    """
    parts = ring()
    if not most * 2 < 2 * len(parts) or most >= len(parts):
        raise ValueError(f"at most {len(parts) - 1} differing bits with {len(parts)} segments")
    bits = fp.view(np.uint64)
    for k, (at, width) in enumerate(parts):
        after, wide = parts[(k + 1) % len(parts)]
        own = bits >> np.uint64(at) & np.uint64((1 << width) - 1)
        follow = bits >> np.uint64(after) & np.uint64((1 << wide) - 1)
        base = np.uint64(k << 26) | own << np.uint64(13)
        yield (base | follow).view(np.int64), np.zeros(len(fp), np.int32), fp, rep
        if 2 * most // len(parts) >= 1:
            for b in range(wide):
                bit = np.uint64(1 << b)
                no = np.flatnonzero(follow & bit == 0)
                yield (base[no] | follow[no] | bit).view(np.int64), np.ones(len(no), np.int32), fp[no], rep[no]


def chains(most: int) -> list[list[tuple[np.uint64, int]]]:
    """For each first segment the masks of the chains of three and more segments, and their budgets."""
    parts, out = ring(), []
    for k in range(len(parts)):
        mask, own = 0, []
        for length in range(1, len(parts) + 1):
            at, width = parts[(k + length - 1) % len(parts)]
            mask |= ((1 << width) - 1) << at
            if length > 2:
                own.append((np.uint64(mask), length * most // len(parts)))
        out.append(own)
    return out


def links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key, blocks and probe; the links of a run of one key and pair of blocks, as stars."""
    budget = chains(most)

    def compare(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, rep: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        own = np.add.reduceat((probe == 0).astype(np.int64), starts)
        first = np.repeat(starts, sizes)
        partners = np.minimum(np.arange(len(key)) - first, np.repeat(own, sizes))  # an indexed row meets those before it, a probe all
        todo = np.flatnonzero(partners)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        ends = np.cumsum(partners[todo])
        done = 0
        while done < len(todo):
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
            rows = todo[done:stop]
            count = partners[rows]
            a = np.repeat(rows, count)
            b = np.repeat(first[rows], count) + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
            done = stop
            differ = (fp[a] ^ fp[b]).view(np.uint64)
            start = key[a] >> 26
            for k in np.unique(start):
                at = np.flatnonzero(start == k)
                for mask, most_here in budget[int(k)]:
                    at = at[np.bitwise_count(differ[at] & mask) <= most_here]
                if len(at):
                    found.append(local_components(rep[a[at]], rep[b[at]]))
        if not found:
            return None
        src, dst = local_components(*(np.concatenate(c) for c in zip(*found, strict=True)))
        use = src != dst
        return pa.RecordBatch.from_arrays([pa.array(src[use]), pa.array(dst[use])], names=["src", "dst"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "probe", "fp", "rep", "lo", "hi")]
        if held is not None:
            rows = [np.concatenate(c) for c in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        changes = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[4]) != 0) | (np.diff(rows[5]) != 0))
        cut = int(changes[-1]) + 1 if len(changes) else 0
        held = [c[cut:] for c in rows]
        if cut and (out := compare(*(c[:cut] for c in rows))) is not None:
            yield out
    if held is not None and (out := compare(*held)) is not None:
        yield out


def reached(reps: DataFrame, most: int) -> DataFrame:
    """node and component, the smallest rep that links reach, of the reps (distinct fp; rep, a number of its own) that have a link.

    A run of one key holds distinct fingerprints only. Its links leave as one star edge a fingerprint, not as pairs.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                fp, rep = (whole.slice(start, 4096).column(c).to_numpy() for c in ("fp", "rep"))
                columns = [np.concatenate(c) for c in zip(*keys_of(fp, rep, most), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "probe", "fp", "rep"])

    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = reps.mapInArrow(spread, KEYS)
    large = written(rows.groupBy("key").count().where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).alias("blocks")), "large")
    dealt = rows.withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.lit(0).cast("long"))
    if not large.isEmpty():
        cut = rows.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long"))).withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        dealt = cut.select(*rows.columns, F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    dealt = dealt.repartition(parts, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "probe")
    found = components(dealt.mapInArrow(lambda batches: links(batches, most), EDGES))
    discard(large)
    return found


def groups(prints: DataFrame, most: int = 4) -> DataFrame:
    """fp, rep (its smallest doc_id) and component (the smallest doc_id that links of most differing bits or fewer reach)."""
    reps = prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = reached(reps, most)
    return reps.join(found, reps["rep"] == found["node"], "left").select("fp", "rep", F.coalesce("component", "rep").alias("component"))


def near_duplicates(docs: DataFrame, size: int = 4, most: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    prints = written(fingerprints(docs, size), "prints")
    found = groups(prints, most).select("fp", "component")
    return prints.join(found, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    )


def without_copies(docs: DataFrame, size: int = 4, most: int = 4) -> DataFrame:
    """The documents less all but one of each group: the row with the smallest doc_id, one of them if it repeats. Rows without an id stay."""
    kept = near_duplicates(docs, size, most).where("doc_id = component_id").select("doc_id").distinct()
    known = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).join(kept, "doc_id", "left_semi")
    return known.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def one_of_each(docs: DataFrame, size: int = 4, most: int = 4) -> DataFrame:
    """The documents less all but one of each group of near copies; texts that share an id and are not alike all stay.

    Here a fingerprint is a node, not an id. Of a group the text with the smallest doc_id stays, of its
    texts the one with the smallest hash, of equal rows any one. Rows without an id stay. Other columns
    pass unchanged, whatever their names.
    """
    own, th = unused(docs, "row_id"), unused(docs, "text_hash")
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash.alias("th"))
    prints = written(fingerprints(rows, size, extra="th"), "prints")
    nodes = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "th")).alias("best"))
    group = reached(nodes.select("fp", F.col("fp").alias("rep")), most)
    best = nodes.join(group, nodes["fp"] == group["node"], "left").groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("best").alias("best"))
    best = best.select(F.col("best.doc_id").alias(own), F.col("best.th").alias(th + "_kept"))
    stay = docs.withColumn(th, text_hash).join(best, (F.col("doc_id") == F.col(own)) & (F.col(th) == F.col(th + "_kept")), "left_semi").dropDuplicates(["doc_id", th]).drop(th)
    return stay.unionByName(docs.where("doc_id IS NULL"))
