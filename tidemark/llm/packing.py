"""Best-fit packing of token pieces into sequences, improved by a swap-based local search.

``pieces`` tokenises whole texts and cuts only what is longer than a sequence; ``pack`` gives each
piece a sequence and an offset. A null or empty text is the end token alone. Ties and repeated rows
are separate pieces. Empty tables give empty results; other columns are not carried.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, trimmed, written
from tidemark.llm.words import Words, words  # noqa: F401 (Words is part of this module, too)

PIECES = "doc_id long, piece int, start long, length long, ids binary"
def pieces(docs: DataFrame, tokenizer_path: str, end: int, size: int) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of each document's pieces.

    A document is its ids and the end id. One of more than size ids is cut into pieces of size ids, of
    which the first may be shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], "<u4").tobytes()
        own = words(tokenizer_path)
        for batch in slices(batches, "text", 1 << 20):
            flat, lengths = own.encode_batch(batch.column("text"))
            data, at, out = flat.astype("<u4").tobytes(), 0, []
            for doc, n in zip(batch.column("doc_id").to_pylist(), (lengths + 1).tolist(), strict=True):
                ids = data[at : at + 4 * n - 4] + last
                at += 4 * n - 4
                first = n if n <= size else n % size or size
                for k, start in enumerate([0, *range(first, n, size)]):
                    stop = first if k == 0 else start + size
                    out.append((doc, k, start, stop - start, ids[4 * start : 4 * stop]))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids"])
        own.forget()
        trimmed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of row numbers: the longest first, each where it leaves the smallest gap."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    open_gaps = 0
    for row in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[row])
        fits = open_gaps >> need
        if fits:
            gap = need + (fits & -fits).bit_length() - 1
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
            bins[at].append(row)
        else:
            gap, at = size, len(bins)
            bins.append([row])
        if gap > need:
            by_gap[gap - need].append(at)
            open_gaps |= 1 << (gap - need)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """The bins after moves and one-for-one and two-for-one swaps between underfull bins.

    Each step takes from the emptiest bin and makes a fuller one fuller, so the sum of squared fills
    grows with every step and the search ends. It stops when no step is left or when as few bins are
    left as their sum allows. Swaps try every piece and every pair of the donor, by the lengths of both sides.
    """
    total = int(lengths.sum())
    least = -(-total // size)
    full = [b for b in bins if int(lengths[b].sum()) == size]
    work = [list(b) for b in bins if int(lengths[b].sum()) < size]
    fill = np.array([int(lengths[b].sum()) for b in work], np.int64)
    flat = [(int(lengths[r]), k, r) for k, b in enumerate(work) for r in b]
    item, home, rows = (np.array(x, np.int64) for x in zip(*flat, strict=True)) if flat else (np.zeros(0, np.int64),) * 3
    place = {int(r): i for i, r in enumerate(rows)}
    alive, stuck, stepped = len(work), np.zeros(len(work), bool), False

    def put(i: int, to: int) -> None:
        frm = int(home[i])
        fill[frm] -= item[i]
        fill[to] += item[i]
        work[frm].remove(int(rows[i]))
        work[to].append(int(rows[i]))
        home[i] = to

    while alive + len(full) > least:
        ready = np.flatnonzero((fill > 0) & ~stuck)
        if not len(ready):
            if not stepped:
                break
            stuck[:], stepped = False, False  # once more round: a step may have made room for a stuck donor
            continue
        donor = int(ready[np.argmin(fill[ready])])
        own = sorted((place[r] for r in work[donor]), key=lambda i: -item[i])
        gap = np.where((fill > 0) & (np.arange(len(fill)) != donor), size - fill, 0)
        richer = fill >= fill[donor]
        done = False
        for i in own:  # move: the tightest gap that takes it
            fits = np.flatnonzero((gap >= item[i]) & richer)
            if len(fits):
                put(i, int(fits[np.argmin(gap[fits])]))
                done = True
                break
        if not done:
            others = richer[home] & (home != donor)
            room = np.zeros(size + 1, np.int64)  # the most room of a bin that holds a piece of each length
            np.maximum.at(room, item[others], gap[home[others]])
            groups: dict[int, tuple[int, ...]] = {}
            for n in (1, 2):
                for group in itertools.combinations(own, n):
                    groups.setdefault(sum(int(item[i]) for i in group), group)
            sums, kinds = np.array(sorted(groups), np.int64), np.flatnonzero(room)
            gain = sums[:, None] - kinds
            gain[(gain <= 0) | (gain > room[kinds])] = 0
            if gain.any():
                s, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
                j = int(np.flatnonzero(others & (item == kinds[k]) & (gap[home] >= gain[s, k]))[0])
                to = int(home[j])
                put(j, donor)
                for i in groups[int(sums[s])]:
                    put(i, to)
                done = True
        if not done:
            stuck[donor] = True
            continue
        stepped = True
        alive -= int(fill[donor] == 0)
    return full + [b for b in work if b]


def pack(parts: DataFrame, size: int, group: int = 16_384) -> DataFrame:
    """parts with sequence_id and offset: no sequence holds more than size, offsets have no gaps.

    Full pieces are a sequence each. The others are dealt evenly into groups of about group pieces,
    whatever their documents, and each group is packed in one task; so a task's memory is bounded and
    a group costs at most about one sequence more than packing all at once would.
    """
    parts = written(parts, "pieces")
    rest = parts.where(F.col("length") < size)
    groups = max(1, -(-rest.count() // group))
    rest = rest.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "length")])
        lengths = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, members in enumerate(improve(best_fit(lengths, size), lengths, size)):
            members.sort()
            sequence[members] = k
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        number = (rows["grp"].to_numpy().astype(np.int64) << 32) + sequence
        return rows.drop_columns(["grp"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    whole = parts.where(F.col("length") >= size).withColumn("sequence_id", -F.monotonically_increasing_id() - 1).withColumn("offset", F.lit(0).cast("long"))
    return rest.groupBy("grp").applyInArrow(run, schema).unionByName(whole)


def packed(docs: DataFrame, tokenizer_path: str, end: int = 2, size: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of docs."""
    parts = pieces(docs, tokenizer_path, end, size)
    return pack(parts.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), size)
