"""Katz backoff language model: Good-Turing discounted n-gram counts, exactly normalised backoff weights.

A text is its words (lower-cased A-Z, between ASCII white space) and one end, after as many start marks
as the order needs. With r the training count of an n-gram and c that of its history, a token's
probability is d(r) r / c if r > 0; else, if c > 0, the history's backoff weight times the probability
after the history less its first word, and so on down to single tokens; an unknown token has what the
discounts of the single tokens leave. The weight is what a history's discounts leave over what its
followers leave of the shorter history, so each history's distribution sums to one. Counts up to GOOD
have the discounts of Good and Turing (where the counts of counts give none between 0 and 1, a count
loses a half); larger ones have none. A history that would leave nothing, for all its followers are
frequent, counts itself once more (c + 1), as toolkits do.

A null text is an empty one; a null doc_id is never held out. Each row is scored on its own, so rows
that repeat have the same figures. Without training rows all tokens are unknown and the score is 0.
Only doc_id and text are read. An empty table gives an empty result. A text is held whole by one task;
there is no other limit on its length. Words and n-grams are told apart by 64-bit hashes.

Texts are tokenised once, into a table of blocks of documents. Then the orders are counted one after
the other. Each block asks, at the partition of each history, for the counts of its distinct n-grams;
the partition adds up all blocks' training counts and answers with the totals, which are written as
the table of that order, partitioned by history, and joined back to the blocks. With the answers of
the orders below, a block knows each history's count before it asks, so n-grams of a frequent history
are dealt by themselves, and what its followers add up to is summed afterwards; nothing is collected
but counts of counts. At last each block evaluates its tokens from the highest order down.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, slices, trimmed, written

#: Words of an n-gram; largest count that Good and Turing discount.
ORDER, GOOD = 3, 5
#: N-grams that a group of a partition gets, about; tokens after a history from which its n-grams are dealt by themselves.
ENTRIES, HOT = 1_000_000, 200_000
#: Passes over the blocks for an order beyond the first, each for a share of the partitions; no more than that share is dealt at a time.
PASSES = 2
#: Bytes of text and rows of a block; shares of the blocks that take in their answers at a time, each of which replaces its own files.
BLOCK, ROWS, SLICES = 5 << 20, 60_000, 3
END, START = np.uint64(1), np.uint64(2)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
ONE, TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
#: Of a history's followers: how many have the count 1 to GOOD, the sum of the larger counts; the same of their counts in the order below.
SUMS = 2 * (GOOD + 1)
BLOCKS = "block long, tokens long, started long, wants array<long>, data binary"
ANSWER = "kind int, block long, p int, h long, sums array<long>, data binary"
REPLY, TYPES, PART = range(3)
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * TWO
    return h ^ (h >> np.uint64(29))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token, hash of the one before it, and the number of its text; texts in order."""
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    data = LOWER[np.frombuffer(b" ".join(texts) + b" " * 9, np.uint8)]
    word = ~WHITE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word]).astype(np.int8)))
    starts, stops = edges[0::2], edges[1::2]
    sizes = stops - starts
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = mixed((sizes.astype(np.uint64) + np.uint64(11)) * ONE)
    at, left = np.arange(len(starts)), sizes.copy()
    for step in range(0, 128, 8):
        h[at] = mixed((h[at] ^ (eight[starts[at] + step] & MASKS[np.minimum(left, 8)])) * ONE)
        keep = left > 8
        at, left = at[keep], left[keep] - 8
        if not len(at):
            break
    if len(at):  # the few very long words
        import xxhash

        h[at] = [xxhash.xxh64_intdigest(data[a:b].tobytes(), 1) for a, b in zip(starts[at], stops[at], strict=True)]
    doc = np.searchsorted(ends_at, starts, "right")
    many = np.bincount(doc, minlength=len(texts))
    total = many + 1
    first = np.cumsum(total) - total
    w = np.empty(int(total.sum()), np.uint64)
    last = first + many
    inside = np.ones(len(w), bool)
    inside[last] = False
    w[inside], w[last] = h, END
    before = np.empty_like(w)
    before[1:] = w[:-1]
    before[first] = START
    return w, before, np.repeat(np.arange(len(texts)), total)


def held_out(column: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def small(x: np.ndarray) -> np.ndarray:
    """x, not negative, in the smallest unsigned type that holds it."""
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def packed(arrays: list[np.ndarray]) -> bytes:
    """Unsigned arrays as bytes: how many, the number of elements and of bytes of each, then the elements."""
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.dtype.itemsize))], "<u4").tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


def unpacked(data: bytes) -> list[np.ndarray]:
    many = int(np.frombuffer(data, "<u4", 1)[0])
    out, at = [], 4 + 8 * many
    for n, size in np.frombuffer(data, "<u4", 2 * many, 4).reshape(-1, 2).tolist():
        out.append(np.frombuffer(data, f"<u{size}", n, at))
        at += n * size
    return out


def squeezed(arrays: list[np.ndarray]) -> bytes:
    """packed() and compressed, each array's lowest bytes first, then its next ones, which compress better."""
    data = packed([a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.ravel().view(a.dtype) for a in arrays])
    return np.array([len(data)], "<u8").tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def spread(data: bytes) -> list[np.ndarray]:
    arrays = unpacked(pa.decompress(data[8:], int(np.frombuffer(data, "<u8", 1)[0]), codec="zstd", asbytes=True))
    return [np.ascontiguousarray(a.view(np.uint8).reshape(a.dtype.itemsize, -1).T).view(a.dtype).ravel() for a in arrays]


def unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and the place of each value among them."""
    width = len(values).bit_length()
    if not len(values) or int(values.max()) >= 1 << 62 - width:
        return np.unique(values, return_inverse=True)
    both = np.sort(values << width | np.arange(len(values)))  # several times as fast as sorting places
    value = both >> width
    new = np.append(True, value[1:] != value[:-1])
    of = np.empty(len(values), np.int64)
    of[both & ((1 << width) - 1)] = np.cumsum(new) - 1
    return value[new], of


def bits(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, bitorder="little")


def unbits(data: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(data, count=n, bitorder="little").astype(bool)


def place(hashes: np.ndarray, parts: int) -> np.ndarray:
    p = (mixed(hashes * ONE) >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)
    return p.astype(np.uint16 if parts <= 1 << 16 else np.int64)


@dataclass
class Level:
    """A block's distinct n-grams of one order, sorted by history. of: of each token; suffix: of each, that of the order below."""

    of: np.ndarray
    grams: np.ndarray
    suffix: np.ndarray
    run: np.ndarray  # the history of each, as a place in heads
    heads: np.ndarray
    back: np.ndarray  # of each history one more than its n-gram in the order below, 0 for the start marks


@dataclass
class Known:
    """Answers for a Level: the n-grams' counts, which histories count themselves once more, and the sums of those that some token backs off from."""

    count: np.ndarray
    once_more: np.ndarray
    runs: np.ndarray
    sums: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [small(self.count), bits(self.once_more), small(self.runs), small(self.sums.ravel())]


class Block:
    """Documents' ids and tokens, and what is known of their n-grams. A token is a place in the sorted hashes of the block's words."""

    def __init__(self, data: bytes):
        held, null, ids, many, steps, stream, *rest = spread(data)
        self.fixed = [held, null, ids, many, steps, stream]
        self.words = np.cumsum(steps, dtype=np.uint64)
        self.mixed = mixed(self.words)
        self.held, self.null, self.ids = unbits(held, len(many)), unbits(null, len(many)), ids.view(np.int64)
        self.many, self.stream = many.astype(np.int64), stream.astype(np.int64)
        self.first = np.zeros(len(stream), bool)
        self.first[np.cumsum(self.many) - self.many] = True
        self.doc = np.repeat(np.arange(len(many)), self.many)
        zero = np.zeros(len(self.words), np.int64)
        self.levels = [Level(self.stream, self.words, zero, zero, np.zeros(1, np.uint64), np.zeros(1, np.int64))]
        self.known: list[Known] = []
        for k in range(0, len(rest), 4):
            count, more, runs, sums = rest[k : k + 4]
            self.grow(k // 4 + 1)
            self.known.append(Known(count.astype(np.int64), unbits(more, len(self.levels[k // 4].heads)), runs.astype(np.int64), sums.astype(np.int64).reshape(-1, SUMS)))

    def data(self) -> bytes:
        return squeezed(self.fixed + [a for k in self.known for a in k.arrays()])

    def grow(self, order: int) -> None:
        """Have the levels up to order."""
        while len(self.levels) < order:
            below, size = self.levels[-1], max(1, len(self.words))
            history = np.zeros(len(self.stream), np.int64)
            history[1:] = below.of[:-1] + 1
            history[self.first] = 0
            found, of = unique(history * size + self.stream)
            suffix = np.empty(len(found), np.int64)
            suffix[of] = below.of
            before, word = found // size, found % size
            new = np.append(True, before[1:] != before[:-1])[: len(found)]
            back = before[new]
            heads = np.append(mixed(np.array([len(self.levels)], np.uint64) * ONE ^ START), below.grams)[back]
            run = np.cumsum(new) - 1
            self.levels.append(Level(of, mixed(((heads + TWO) * ONE)[run] ^ self.mixed[word]), suffix, run, heads, back))

    def histories(self, order: int, total: int, started: int) -> np.ndarray:
        """The training count of each history of a level."""
        if order == 1:
            return np.full(1, total, np.int64)
        return np.append(started, self.known[order - 2].count)[self.levels[order - 1].back]

    def hot_heads(self, order: int, total: int, started: int) -> list[int]:
        """The histories of the next order whose n-grams are dealt by themselves."""
        self.grow(order)
        return self.levels[order - 1].heads[self.histories(order, total, started) > HOT].view(np.int64).tolist()

    def dealt(self, order: int, parts: int, first: int, last: int, total: int, started: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The level's n-grams that belong to the partitions from first to last - 1, ordered by partition, the partition of each, and which histories' n-grams are dealt by themselves."""
        own = self.levels[order - 1]
        hot = self.histories(order, total, started) > HOT if order > 1 else np.ones(1, bool)
        p = place(own.heads, parts)[own.run]
        if hot.any():
            alone = np.flatnonzero(hot[own.run])
            p[alone] = place(own.grams[alone], parts)
        if first or last < parts:
            some = np.flatnonzero((p >= first) & (p < last))
            turn = some[np.argsort(p[some], kind="stable")]
        else:
            turn = np.argsort(p, kind="stable")
        return turn, p[turn], hot

    def asked(self, order: int, parts: int, first: int, last: int, total: int, started: int) -> Iterator[tuple[int, bytes]]:
        self.grow(order)
        own = self.levels[order - 1]
        trained = np.bincount(own.of[~self.held[self.doc]], minlength=len(own.grams))
        below = self.known[order - 2].count[own.suffix] if order > 1 else np.ones(len(own.grams), np.int64)
        turn, p, hot = self.dealt(order, parts, first, last, total, started)
        run = own.run[turn]
        edge = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (p[1:] != p[:-1]))[: len(run)])
        runs = run[edge]
        heads, sizes, alone, grams, trained, below = own.heads[runs], np.diff(np.append(edge, len(run))), hot[runs], own.grams[turn], trained[turn], below[turn]
        cuts = np.searchsorted(p, np.arange(first, last + 1))
        run_cuts = np.searchsorted(edge, cuts)
        for k in np.flatnonzero(np.diff(cuts)):
            some, their = slice(cuts[k], cuts[k + 1]), slice(run_cuts[k], run_cuts[k + 1])
            yield first + int(k), packed([heads[their], small(sizes[their]), bits(alone[their]), grams[some], small(trained[some]), small(below[some])])

    def told(self, order: int, parts: int, total: int, started: int, replies: list[bytes], hot_sums: dict[int, list[int]]) -> None:
        """Take in the answers of all partitions that were asked, in their order, and the sums of hot histories."""
        self.grow(order)
        own = self.levels[order - 1]
        turn, p, hot = self.dealt(order, parts, 0, parts, total, started)
        run = own.run[turn]
        edge = np.append(True, (run[1:] != run[:-1]) | (p[1:] != p[:-1]))[: len(run)]
        runs = run[edge]
        ends = np.searchsorted(p[edge], np.unique(p), "right")
        counts, more, which, sums, at = [], [], [], [], 0
        for end, data in zip(ends.tolist(), replies, strict=True):
            count, flags, wanted, found = unpacked(data)
            counts.append(count.astype(np.int64))
            more.append(unbits(flags, end - at))
            which.append(runs[at:end][wanted])
            sums.append(found.astype(np.int64).reshape(-1, SUMS))
            at = end
        count = np.empty(len(turn), np.int64)
        count[turn] = np.concatenate([*counts, np.zeros(0, np.int64)])
        once_more = np.zeros(len(own.heads), bool)
        once_more[runs] = np.concatenate([*more, np.zeros(0, bool)])
        once_more[hot] = False
        if order > 1 and hot.any():
            at = np.flatnonzero(hot)
            of = np.array([hot_sums[int(h)] for h in own.heads[at].view(np.int64)], np.int64).reshape(-1, SUMS)
            once_more[at] = (of[:, :GOOD].sum(axis=1) == 0) & (of[:, GOOD] > 0)
            which.append(at)
            sums.append(of)
        self.known.append(Known(count, once_more, np.concatenate([*which, np.zeros(0, np.int64)]), np.concatenate([*sums, np.zeros((0, SUMS), np.int64)])))


def tokenised(docs: DataFrame) -> DataFrame:
    """Blocks of documents."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("d"), held_out(F.col("doc_id")).alias("held"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in slices(batches, "text", BLOCK):
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
                ids = batch.column("d")
                w, _, doc = tokens(batch.column("text").to_pylist())
                words, stream = np.unique(w, return_inverse=True)
                data = squeezed([bits(held), bits(ids.is_null().to_numpy(zero_copy_only=False)), ids.fill_null(0).to_numpy().view(np.uint64), small(np.bincount(doc, minlength=len(held))), np.diff(words, prepend=np.uint64(0)), small(stream)])
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (number, len(w), int((~held).sum()))] + [pa.nulls(1, pa.list_(pa.int64())), pa.array([data], pa.binary())], names=["block", "tokens", "started", "wants", "data"])
                number += 1
        trimmed()

    return rows.mapInArrow(run, BLOCKS)


def followers(run: np.ndarray, counts: np.ndarray, runs: int) -> np.ndarray:
    """For each run how many counts are 1 to GOOD, and the sum of the larger ones."""
    width = GOOD + 1
    out = np.bincount(run * width + np.minimum(counts, width) - 1, minlength=runs * width).reshape(runs, width)
    large = np.flatnonzero(counts > GOOD)
    out[:, GOOD] = np.bincount(run[large], weights=counts[large], minlength=runs)
    return out


def answered(group: pa.Table) -> pa.Table:
    """For each asking block the training counts of its n-grams, whole histories' sums; counts of counts; partial sums of histories whose n-grams are dealt by themselves."""
    p = group["p"][0].as_py()
    blocks = group["block"].to_pylist()
    read = [unpacked(x) for x in group["data"].to_pylist()]
    sizes = [x[1].astype(np.int64) for x in read]
    alone = [unbits(x[2], len(x[0])) for x in read]
    head = np.repeat(np.concatenate([x[0] for x in read]), np.concatenate(sizes))
    gram = np.concatenate([x[3] for x in read])
    turn = np.argsort(gram)
    new = np.append(True, np.diff(gram[turn]) != 0)
    of = np.empty(len(turn), np.int64)
    of[turn] = np.cumsum(new) - 1
    first = turn[new]
    heads, run = np.unique(head[first], return_inverse=True)
    del turn, gram, new
    count = np.bincount(of, weights=np.concatenate([x[4] for x in read], dtype=np.float64)).astype(np.int64)
    below = np.concatenate([x[5] for x in read])[first].astype(np.int64)
    hot = np.zeros(len(heads), bool)
    hot[run] = np.repeat(np.concatenate(alone), np.concatenate(sizes))[first]
    seen = np.flatnonzero(count)
    sums = np.concatenate([followers(run[seen], x[seen], len(heads)) for x in (count, below)], axis=1)
    once_more = (sums[:, :GOOD].sum(axis=1) == 0) & (sums[:, GOOD] > 0)
    open_runs = (sums[:, : GOOD + 1].sum(axis=1) > 0) & ~hot
    types = [*np.bincount(np.minimum(count, GOOD + 2), minlength=GOOD + 3)[1 : GOOD + 2].tolist(), len(seen), int(count[count > GOOD].sum())]
    out = [(TYPES, 0, p, 0, types, None)]
    out += [(PART, 0, p, int(h), s, None) for h, s in zip(heads[hot].view(np.int64), sums[hot].tolist(), strict=True)]
    at = 0
    for block, size in zip(blocks, sizes, strict=True):
        mine = of[at : at + int(size.sum())]
        at += len(mine)
        starts = np.cumsum(size) - size
        runs = run[mine[starts]]
        wanted = np.flatnonzero(open_runs[runs] & (np.add.reduceat((count[mine] == 0).astype(np.int64), starts) > 0))
        out.append((REPLY, block, p, 0, None, packed([small(count[mine]), bits(once_more[runs]), small(wanted), small(sums[runs[wanted]].ravel())])))
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary())
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in ANSWER.split(", ")])


class Discounts:
    """Good-Turing discounts from the numbers of types that were seen 1, 2, ... times."""

    def __init__(self, types: dict[int, int]):
        n = [0, *(types.get(r, 0) for r in range(1, GOOD + 2))]
        top = (GOOD + 1) * n[GOOD + 1] / n[1] if n[1] else 1.0
        self.of = np.ones(GOOD + 2)
        for r in range(1, GOOD + 1):
            d = ((r + 1) * n[r + 1] / (n[r] * r) - top) / (1 - top) if n[r] and top != 1 else 0.0
            self.of[r] = d if 0 < d < 1 else (r - 0.5) / r

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """d(r) r of counts above zero."""
        return self.of[np.minimum(counts, GOOD + 1)] * counts

    def total(self, sums: np.ndarray) -> np.ndarray:
        """d(r) r over all followers, from how many have each count and the sum of the larger ones."""
        return sums[:, :GOOD] @ (self.of[1 : GOOD + 1] * np.arange(1, GOOD + 1)) + sums[:, GOOD]


@dataclass
class Model:
    """What all blocks need to evaluate their tokens: training tokens, types and documents, and each order's discounts."""

    total: int
    kinds: int
    started: int
    discounts: list[Discounts]
    singles: np.ndarray  # the sums of the empty history

    def scores(self, block: Block) -> dict[str, np.ndarray]:
        first = self.singles[:GOOD].sum() == 0 and self.total > 0  # single tokens, too, must leave something
        whole = self.total + int(first)
        unknown = (whole - float(self.discounts[0].total(self.singles[None])[0])) / whole if whole else 1.0
        count = block.known[0].count[block.stream]
        score, left = np.zeros(len(count)), np.arange(len(count))
        for order in range(len(self.discounts), 1, -1):
            level, known, discount, below = block.levels[order - 1], block.known[order - 1], self.discounts[order - 1], self.discounts[order - 2]
            history = block.histories(order, self.total, self.started) + known.once_more
            gram = level.of[left]
            r, c = known.count[gram], history[level.run[gram]]
            seen = r > 0
            score[left[seen]] += np.log10(discount.mass(r[seen]) / c[seen])
            # the weights of this block's histories, from the sums over their followers
            shorter = np.full(len(level.heads), whole, np.int64)
            if order > 2:
                lower = block.levels[order - 2]
                shorter = (block.histories(order - 1, self.total, self.started) + block.known[order - 2].once_more)[lower.run][level.suffix]
                of = np.empty(len(level.heads), np.int64)
                of[level.run] = shorter  # all n-grams of a history have the same shorter one
                shorter = of
            weight = np.zeros(len(level.heads))
            own, rest = history[known.runs], shorter[known.runs]
            weight[known.runs] = np.log10((own - discount.total(known.sums[:, : GOOD + 1])) / own) - np.log10((rest - below.total(known.sums[:, GOOD + 1 :])) / rest)
            back = left[~seen]
            score[back] += np.where(c[~seen] > 0, weight[level.run[gram[~seen]]], 0.0)
            left = back
        r = count[left]
        score[left] += np.log10(np.where(r > 0, self.discounts[0].mass(np.maximum(r, 1)) / max(whole, 1), unknown))
        base = np.log10(count + 0.1) - np.log10(self.total + 0.1 * (self.kinds + 1))
        some = lambda x: np.bincount(block.doc, weights=x, minlength=len(block.many))
        return {"n_tokens": block.many, "n_known": some(count > 0).astype(np.int64), "train_tokens": np.full(len(block.many), self.total), "base_score": some(base), "score": some(score)}


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    spark = docs.sparkSession
    blocks = [written(tokenised(docs), "blocks", compression="none")]
    every, started = blocks[0].agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("started"), F.lit(0))).first()
    parts = max(PASSES, min(1 << 24, -(-every // ENTRIES)))
    discounts, singles, total, kinds = [], np.zeros(SUMS, np.int64), 0, 0

    for level in range(1, order + 1):
        answers = []
        for k in range(PASSES if level > 1 else 1):  # what is dealt at a time is a share of the partitions
            answers.append(_answers(_all(blocks), level, parts, parts * k // PASSES if level > 1 else 0, parts * (k + 1) // PASSES if level > 1 else parts, total, started))
        table = _all(answers)
        types = table.where(F.col("kind") == TYPES).agg(*(F.coalesce(F.sum(F.get("sums", F.lit(k))), F.lit(0)) for k in range(GOOD + 3))).first()
        discounts.append(Discounts(dict(enumerate(types[: GOOD + 1], 1))))
        if level == 1:
            kinds = types[GOOD + 1]
            total = sum(r * n for r, n in enumerate(types[:GOOD], 1)) + types[GOOD + 2]
            singles = np.array([*types[:GOOD], types[GOOD + 2]], np.int64)
        # what the blocks want to know of hot histories, from the partitions' parts of their sums
        parts_of = table.where(F.col("kind") == PART).groupBy("h").agg(F.array(*(F.sum(F.get("sums", F.lit(k))) for k in range(SUMS))).alias("sums"))
        replies = table.where(F.col("kind") == REPLY).select("block", "p", F.lit(None).cast("long").alias("h"), F.lit(None).cast("array<long>").alias("sums"), "data")
        model = Model(total, kinds, started, discounts, singles) if level == order else None
        tell, done = _teller(level, parts, total, started, model), []
        for k in range(SLICES):
            slice_of = F.pmod(F.xxhash64("block"), F.lit(SLICES)) == k
            own = blocks[k] if len(blocks) > 1 else blocks[0].where(slice_of)
            hot = own.select("block", F.explode("wants").alias("h")).join(parts_of, "h").select("block", F.lit(None).cast("int").alias("p"), "h", "sums", F.lit(None).cast("binary").alias("data"))
            rows = replies.where(slice_of).unionByName(hot) if level > 1 else replies.where(slice_of)
            own = own.select("block", F.lit(-1).alias("p"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("array<long>").alias("sums"), "data")
            done.append(written(own.unionByName(rows).groupBy("block").applyInArrow(tell, SCORES if model else BLOCKS), "scores" if model else "blocks", compression="zstd" if model else "none"))
            if len(blocks) > 1:
                discard(blocks[k])
        for old in (*(blocks if len(blocks) == 1 else ()), *answers):
            discard(old)
        blocks = done
    return _all(blocks)


def _all(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def _answers(blocks: DataFrame, level: int, parts: int, first: int, last: int, total: int, started: int) -> DataFrame:
    """The written table of an order's counts, for a range of its partitions."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
                found = list(Block(data.as_py()).asked(level, parts, first, last, total, started))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([number] * len(found), pa.int64()), pa.array([d for _, d in found], pa.binary())], names=["p", "block", "data"])
        trimmed()

    def answer(group: pa.Table) -> pa.Table:
        found = answered(group)
        trimmed()
        return found

    asks = blocks.select("block", "data").mapInArrow(ask, "p int, block long, data binary")
    return written(asks.repartition(min(last - first, 10_000), "p").groupBy("p").applyInArrow(answer, ANSWER), f"counts-{level}")


def _teller(level: int, parts: int, total: int, started: int, model: Model | None):
    """Joins the answers to a block; with a model the block's documents are scored."""

    def tell(group: pa.Table) -> pa.Table:
        number = group["block"][0].as_py()
        own, replies, hot = None, [], {}
        for p, h, sums, data in zip(group["p"].to_pylist(), group["h"].to_pylist(), group["sums"].to_pylist(), group["data"].to_pylist(), strict=True):
            if p is None:
                hot[h] = sums
            elif p < 0:
                own = data
            else:
                replies.append((p, data))
        block = Block(own)
        block.told(level, parts, total, started, [d for _, d in sorted(replies, key=lambda x: x[0])], hot)
        if model is None:
            out = pa.table({"block": [number], "tokens": [len(block.stream)], "started": [int((~block.held).sum())], "wants": pa.array([block.hot_heads(level + 1, total, started)], pa.list_(pa.int64())), "data": pa.array([block.data()], pa.binary())})
        else:
            out = pa.table({"doc_id": pa.array(block.ids, mask=block.null), "held_out": block.held} | model.scores(block))
        del group, block, replies
        trimmed()
        return out

    return tell
