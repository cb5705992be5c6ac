"""Token ids of whole texts by the tokenizers library, a batch of texts at a time, each distinct word once.

A text is cut before each single blank, and on both sides of each single line end, between characters
that are no white space. The tokenizer's own pattern ends a match there whatever stands around, so the
ids of the parts, joined, are the ids of the text. Arrow cuts the texts and finds the distinct parts of a
batch; only those that are not remembered reach the tokenizer; numpy puts the ids together. What is
remembered is held in Arrow arrays of at most REMEMBERED bytes and never changes a result.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and ids that a worker remembers, and characters of the longest word that it remembers.
REMEMBERED, SHORT = 24 << 20, 64
#: A word without white space but for a blank before it.
PLAIN = re.compile(r" ?\S+").fullmatch
#: White space besides blanks and line ends, and what else keeps a text from being cut at each of these.
BLANK, OTHER, BESIDE = re.compile(r"[^\S \n]|\x00").search, "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\0", ("  ", " \n", "\n ", "\n\n")
NO_WORDS = pa.array([], pa.string())


class Words:
    """Ids by one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        self.line_end = self.own.encode("\n", add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.known, self.ids, self.lengths = NO_WORDS, np.zeros(0, np.uint32), np.zeros(0, np.int64)

    @staticmethod
    def marked(text: str) -> str:
        """The text, which has no \\0, with a \\0 at each cut."""
        if text and not (any(c in text for c in OTHER) if text.isascii() else BLANK(text)):
            if text[0] not in " \n" and text[-1] not in " \n" and not any(c in text for c in BESIDE):  # no blank or line end is first, last or beside another
                return text.replace(" ", "\0 ").replace("\n", "\0\n\0")
        words = text.split(" ")
        out = [words[0]]
        for before, w in zip(words, words[1:], strict=False):
            out.append("\0 " if before and w and not before[-1].isspace() and not w[0].isspace() else " ")
            out.append(w)
        return "".join(out)

    def fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, joined, and how many each has; words without white space inside share a call, with line ends between them."""
        plain = [bool(PLAIN(w)) for w in words] if len(self.line_end) == 1 else [False] * len(words)
        some, rest = [w for w, p in zip(words, plain, strict=True) if p], [w for w, p in zip(words, plain, strict=True) if not p]
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a in range(0, len(some), 8192):
            groups = ["\n".join(some[i : min(i + 128, a + 8192)]) + "\n" for i in range(a, min(a + 8192, len(some)), 128)]
            flat = np.concatenate([np.array(done.ids, np.uint32) for done in self.own.encode_batch_fast(groups, add_special_tokens=False)])
            ends = flat == self.line_end[0]
            lengths.append(np.diff(np.flatnonzero(ends), prepend=-1) - 1)
            ids.append(flat[~ends])
        each = [np.array(done.ids, np.uint32) for a in range(0, len(rest), 1024) for done in self.own.encode_batch_fast(rest[a : a + 1024], add_special_tokens=False)]
        flat, sizes = np.concatenate([*ids, *each]), np.concatenate([*lengths, [len(x) for x in each]]).astype(np.int64)
        order = np.empty(len(words), np.int64)  # where each word's ids were put
        order[np.flatnonzero(plain)] = np.arange(len(some))
        order[np.flatnonzero(~np.array(plain, bool))] = len(some) + np.arange(len(rest))
        return gathered(flat, np.cumsum(sizes) - sizes, sizes, order), sizes[order]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, joined, and how many each has; a null text has none."""
        plain = pc.fill_null(texts.cast(pa.string()), "").to_pylist()
        whole = {k: x for k, x in enumerate(plain) if "\0" in x}  # such texts are not cut
        cut = pc.split_pattern(pa.array(["" if k in whole else self.marked(x) for k, x in enumerate(plain)], pa.string()), "\0")
        parts = cut.flatten().dictionary_encode()
        words, at = parts.dictionary, parts.indices.to_numpy()
        place = pc.index_in(words, value_set=self.known)
        missing = np.flatnonzero(pc.is_null(place).to_numpy(zero_copy_only=False))
        new = words.take(pa.array(missing))
        new_ids, new_lengths = self.fresh(new.to_pylist())
        row = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row[missing] = len(self.lengths) + np.arange(len(missing))
        pool, lengths = np.concatenate([self.ids, new_ids]), np.concatenate([self.lengths, new_lengths])
        starts = np.cumsum(lengths) - lengths
        ids = gathered(pool, starts, lengths, row[at])
        ends = np.concatenate([[0], np.cumsum(lengths[row[at]])])
        bounds = ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()] if len(plain) else np.zeros(1, np.int64)
        self.remember(new, new_ids, new_lengths)
        if not whole:
            return ids, np.diff(bounds)
        alone = [np.array(self.own.encode(whole[k], add_special_tokens=False).ids, np.uint32) if k in whole else ids[bounds[k] : bounds[k + 1]] for k in range(len(plain))]
        return np.concatenate(alone), np.array([len(x) for x in alone], np.int64)

    def remember(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        short = pc.less_equal(pc.utf8_length(words), SHORT).to_numpy(zero_copy_only=False)
        if self.known.nbytes + self.ids.nbytes + self.lengths.nbytes + words.nbytes + ids.nbytes + lengths.nbytes > REMEMBERED:
            self.forget()
        if words.nbytes + ids.nbytes + lengths.nbytes <= REMEMBERED:
            self.known = pa.concat_arrays([self.known, words.filter(pa.array(short))])
            self.ids, self.lengths = np.concatenate([self.ids, ids[np.repeat(short, lengths)]]), np.concatenate([self.lengths, lengths[short]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, lengths = self.encode_batch(pa.array(texts, pa.string()))
        data, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths).tolist()
        return [data[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The stretches of pool that rows name, one after the other."""
    many = lengths[rows]
    shift = starts[rows] - (np.cumsum(many) - many)
    return pool[np.repeat(shift, many) + np.arange(int(many.sum()))]


@functools.lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)
