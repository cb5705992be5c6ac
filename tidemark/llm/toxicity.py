"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

A text is read as words in lower case, with separators inside words dropped, digits that stand for
letters turned back, and spelled-out words ("i d i o t") joined. The kernel of two words compares their
subsequences of three characters, gaps allowed and discounted, so that inserted characters cost little.
Its Nyström features on a bounded set of landmark words feed a linear support vector machine, and a
logistic function of a document's strongest words gives its score.

Words are learned from labelled sentences: those that stand in many different contexts of toxic
documents and in few of others. A null or empty text has the score of a text without any such word.
Documents without a label, or with a null one, are not learned from; of repeated labels the largest
counts. If nothing can be learned the score is the share of toxic labels. Ties do not arise.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, trimmed, unused

#: The sample that is learned from: documents of either label, and characters of a text that may be in it.
TOXIC, CLEAN, LONGEST = 1500, 3000, 50_000
#: Landmarks and training words of either kind, at most.
LANDMARKS, POSITIVE, NEGATIVE = 64, 200, 1500
#: Words of other documents among which those to train against are looked for, the most frequent first.
CONSIDERED = 30_000
#: Discount of a skipped character, and the steps between the three characters.
DISCOUNT = 0.6
STEPS = ((1, 1), (1, 2), (2, 1), (1, 3), (2, 2), (3, 1))
#: Characters of a window: a longer word is read as overlapping windows. Words that a worker remembers.
WINDOW, REMEMBERED = 22, 150_000
#: Decisions below this do not tell documents apart.
FLOOR = -0.5
#: Characters that stand for letters, characters that separate words, characters that are dropped inside words.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
SEPARATES = ",;:/\\|()[]{}<>\"?=&%#+"
DROPPED = ".-_*'`~^"
FOLD = str.maketrans(STANDS_FOR | {c: " " for c in SEPARATES} | {c: None for c in DROPPED})
ENDING = re.compile(r"!+(?=\s|$)")
SPELLED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
#: a-z, the marks and other ASCII characters have codes below 32, all others are their own codes after them.
CODE = np.array([0] + [c - 96 if 97 <= c <= 122 else 29 + c % 3 if c < 128 else c for c in range(1, 0x3000)], np.int64)
CODE[ord("^")], CODE[ord("|")] = 27, 28
#: Places of subsequences: of codes below 32 each has its own, those with a larger one are hashed to a quarter as many more.
PLAIN_PLACES, SIZE = 1 << 15, (1 << 15) + (1 << 13)


def units(text: str) -> list[str]:
    """The words of a text, in order, and after them the spelled-out ones."""
    plain = ENDING.sub(" ", text.lower()).translate(FOLD)
    return plain.split() + ["".join(m[0].split()) for m in SPELLED.finditer(plain)]


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the characters, with a mark before and after each word; and the number of codes."""
    packed = np.array(["^" + w + "|" for w in words], dtype=f"U{WINDOW + 2}").view(np.uint32).reshape(len(words), -1)
    codes = np.where(packed < len(CODE), CODE[np.minimum(packed, len(CODE) - 1)], packed.astype(np.int64))
    return codes, (codes > 0).sum(axis=1)


def places(x: np.ndarray, y: np.ndarray, z: np.ndarray, plain: bool) -> np.ndarray:
    """Where subsequences of three codes belong; plain: no code is above 31."""
    exact = x << 10 | y << 5 | z
    if plain:
        return exact
    mixed = PLAIN_PLACES + ((x * 0x9E3779B1 ^ y * 0x85EBCA77 ^ z * 0xC2B2AE3D) >> 9) % (SIZE - PLAIN_PLACES)
    return np.where((x | y | z) < 32, exact, np.where(z > 0, mixed, 0))


def length_norm(n: np.ndarray) -> np.ndarray:
    """The length of a word's features if no subsequence repeats."""
    squares = sum(DISCOUNT ** (2 * (a + b - 2)) * np.maximum(n - a - b, 0) for a, b in STEPS)
    return np.sqrt(np.maximum(squares, 1e-9))


def dense(words: list[str]) -> np.ndarray:
    """Features of few words: a row each, of discounted subsequences, divided by length_norm."""
    codes, n = coded([w[:WINDOW] for w in words])
    out = np.zeros((len(words), SIZE))
    rows = np.arange(len(words))[:, None]
    for a, b in STEPS:
        span = codes.shape[1] - a - b
        if span > 0:
            x, y, z = codes[:, :span], codes[:, a : a + span], codes[:, a + b : a + b + span]
            np.add.at(out, (np.broadcast_to(rows, x.shape), places(x, y, z, False)), np.where(z > 0, DISCOUNT ** (a + b - 2), 0.0))
    return out / length_norm(n)[:, None]


def inner(words: list[str], against: np.ndarray) -> np.ndarray:
    """The kernel's inner products of words with a combination of feature rows; a long word has its best window's."""
    out = np.full(len(words), -np.inf)
    for first in range(0, len(words), 20_000):
        part = words[first : first + 20_000]
        wide = [(i, w[s : s + WINDOW]) for i, w in enumerate(part) if len(w) > WINDOW for s in range(0, len(w) - WINDOW // 2, WINDOW // 2)]
        codes, n = coded([w[:WINDOW] for w in part] + [w for _, w in wide])
        total = np.zeros(len(codes))
        high = (codes > 31).any(axis=1)
        for own, plain in ((np.flatnonzero(~high), True), (np.flatnonzero(high), False)):
            some = codes[own] if len(own) < len(codes) else codes
            for a, b in STEPS:
                span = codes.shape[1] - a - b
                if span > 0 and len(own):
                    values = against[places(some[:, :span], some[:, a : a + span], some[:, a + b : a + b + span], plain)]
                    total[own] += DISCOUNT ** (a + b - 2) * (values.sum(axis=1) if plain else np.where(some[:, a + b : a + b + span] > 0, values, 0.0).sum(axis=1))
        total /= length_norm(n)
        np.maximum.at(out, np.concatenate([np.arange(len(part)), np.array([i for i, _ in wide], np.int64)]) + first, total)
    return out


@dataclass
class Model:
    """weights: of subsequences; bias: of the decision; logistic: constant and weights of the strongest decision and of the number of words found."""

    weights: np.ndarray
    bias: float
    logistic: np.ndarray

    def __post_init__(self) -> None:
        self.known: set[str] = set()
        self.found: dict[str, float] = {}

    def learn(self, words: Iterable[set[str]]) -> None:
        """Decide on the words that were not met before."""
        fresh = list(set().union(*words) - self.known - self.found.keys())
        if fresh:
            decisions = inner(fresh, self.weights) + self.bias
            self.found.update((fresh[i], float(decisions[i])) for i in np.flatnonzero(decisions > FLOOR))
            self.known.update(fresh)

    def features(self, texts: list[str | None]) -> np.ndarray:
        words = [set(units(x)) if x else set() for x in texts]
        if len(self.known) > REMEMBERED or len(self.found) > REMEMBERED:
            self.known.clear()
            self.found.clear()
        self.learn(words)
        out = np.zeros((len(texts), 3))
        out[:, 0], out[:, 1] = 1, FLOOR
        for i, own in enumerate(words):
            some = [self.found[w] for w in own & self.found.keys()]
            if some:
                out[i, 1:] = min(max(some), 1.5), min(sum(x > 0 for x in some), 4)
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.logistic, -30, 30)))


def counted(texts: list[str]) -> Counter[str]:
    """How often each word stands in the texts."""
    out: Counter[str] = Counter()
    for text in texts:
        out.update(units(text))
    return out


def contexts(texts: list[str], words: set[str]) -> dict[str, int]:
    """For each of the words the number of different pairs of neighbours: copies of a text add nothing."""
    seen: dict[str, set[int]] = {w: set() for w in words}
    for text in texts:
        own = units(text)
        for before, word, after in zip(["", *own], own, [*own[1:], ""], strict=False):
            if word in seen:
                seen[word].add(hash((before, after)))
    return {w: len(c) for w, c in seen.items()}


def machine(features: np.ndarray, sign: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, the last being the bias, by Newton's method."""
    x = np.hstack([features, np.ones((len(features), 1))])
    share = cost * np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())) * len(sign)
    weights, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    active = np.ones(len(x), bool)
    for _ in range(50):
        own = x[active]
        weights = np.linalg.solve(ridge + own.T @ (own * share[active, None]), own.T @ (share[active] * sign[active]))
        now = sign * (x @ weights) < 1
        if (now == active).all():
            break
        active = now
    return weights


def logistic(features: np.ndarray, label: np.ndarray, share: np.ndarray) -> np.ndarray:
    weights = np.zeros(features.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (share * (label - p)) - 1e-2 * weights
        curve = features.T @ (features * (share * p * (1 - p))[:, None]) + 1e-2 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def spelled_wrong(words: list[str]) -> list[str]:
    """Each word with one character inserted at each inner place, one in turn of a fixed few, and with a letter doubled."""
    out = []
    for w in words:
        out += [w[:i] + "xqzj"[i % 4] + w[i:] for i in range(1, len(w))] + [w[:i] + w[i - 1] + w[i:] for i in range(1, len(w), 2)]
    return out


def train(toxic: list[str], clean: list[str], counts: tuple[int, int]) -> Model:
    """The model of two samples of texts; counts are the numbers of labels of either kind that they stand for."""
    prior = np.log((counts[0] + 0.5) / (counts[1] + 0.5))
    nothing = Model(np.zeros(SIZE), -1.0, np.array([prior, 0.0, 0.0]))
    if not toxic or not clean:
        return nothing
    bad, good = counted(toxic), counted(clean)
    times = sum(bad.values()) / max(1, sum(good.values()))
    expected = {w: (good[w] + 0.5) * times for w, c in bad.items() if c >= 3 and 3 <= len(w) <= WINDOW and c >= 4 * (good[w] + 0.5) * times}
    strong = {w: (c - expected[w]) / np.sqrt(expected[w] + 1) for w, c in contexts(toxic, set(expected)).items() if c >= 3 and c >= 4 * expected[w]}
    # where there are words that stand out, weak ones are chance
    least = max(2.5, min(4.5, 0.2 * max(strong.values(), default=0.0)))
    mined = sorted((w for w in strong if strong[w] >= least), key=lambda w: (-strong[w], w))[:LANDMARKS]
    if not mined:
        return nothing
    base = dense(mined)
    near = lambda words: np.max([inner(words, row) for row in base], axis=0)
    only = sorted(w for w in bad if w not in good and w not in mined and 4 <= len(w) <= WINDOW)
    variants = [w for w, k in zip(only, near(only), strict=True) if k >= 0.7][: POSITIVE - len(mined)] if only else []
    rest = sorted((w for w in good if w not in strong), key=lambda w: (-good[w], zlib.crc32(w.encode())))[:CONSIDERED]
    close = near(rest) if rest else np.zeros(0)
    # a rare word that is very close may be an insult in a text that is labelled wrong
    order = [i for i in np.argsort(-close, kind="stable") if close[i] < 0.7 or good[rest[i]] >= 3]
    spread = order[NEGATIVE:: max(1, (len(order) - NEGATIVE) // NEGATIVE)][:NEGATIVE] if len(order) > NEGATIVE else []
    negatives = [rest[i] for i in [*order[:NEGATIVE], *spread]]
    positives = mined + variants + spelled_wrong([w for w in mined if 4 * strong[w] >= strong[mined[0]]])
    landmarks = mined + negatives[: LANDMARKS // 2] + negatives[-(LANDMARKS // 2) :] if negatives else mined
    own = dense(landmarks)
    values, vectors = np.linalg.eigh(own @ own.T)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T * 1.0
    words = positives + negatives
    kernel = np.stack([inner(words, row) for row in own], axis=1)
    weights = machine(kernel @ root, np.array([1.0] * len(positives) + [-1.0] * len(negatives)))
    model = Model(own.T @ (root @ weights[:-1]), float(weights[-1]), np.zeros(3))
    features = model.features(toxic + clean)
    share = np.array([counts[0] / len(toxic)] * len(toxic) + [counts[1] / len(clean)] * len(clean))
    model.logistic = logistic(features, np.array([1.0] * len(toxic) + [0.0] * len(clean)), share / share.mean())
    model.known, model.found = set(), {}
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """The model of a bounded sample of the documents whose label is known and for whose label's row learn holds.

    It is trained in one task, and only the model goes to the driver, which needs its memory for what it knows of all tasks.
    """
    own = labels.where(learn & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n = (counts.get(1, 0), counts.get(0, 0))
    share = F.when(F.col("toxic") == 1, min(1.0, TOXIC / max(1, n[0]))).otherwise(min(1.0, CLEAN / max(1, n[1])))
    place = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    some = F.broadcast(own.where(place < share))
    texts = docs.where(F.col("text").isNotNull() & (F.length("text") <= LONGEST)).select("doc_id", "text").join(some, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text")), strict=True))
        model = train([t for _, x, t in rows if x == 1], [t for _, x, t in rows if x == 0], n)
        del rows
        trimmed()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    done = texts.select("doc_id", "toxic", "text").orderBy(F.xxhash64(F.lit("row"), "doc_id", "text"), "doc_id", "text").limit(2 * (TOXIC + CLEAN)).coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(done[0]["model"]) if done else train([], [], n)


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """docs with a column more, name: the model's probability for the whole text; a column of that name is replaced."""
    keep = [c for c in docs.columns if c != name]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(model.score(batch.column("text").to_pylist()))], names=[*keep, name])
        model.known.clear()
        model.found.clear()
        trimmed()

    return docs.select(*(F.col(f"`{c}`") for c in keep)).mapInArrow(run, schema)


def remainder(of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


def scored(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted; labels of rows whose crc32(doc_id) mod 4 is 2 are not learned from."""
    held = F.coalesce(remainder(4) == 2, F.lit(False))
    model = fit(docs, labels, ~held)
    done = score(docs.select("doc_id", "text"), model)
    return done.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= least).cast("int").alias("predicted"))


def harmless(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents with a score below least. All columns pass unchanged."""
    model = fit(docs, labels, ~F.coalesce(remainder(4) == 2, F.lit(False)))
    name = unused(docs, "toxicity")
    return score(docs, model, name).where(F.col(name) < least).drop(name)
